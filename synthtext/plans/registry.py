"""Registry of queries over the driver's tables, each with its DuckDB oracle.

Every query reads the given parquet tables (or data Spark derives from them)
in full. Computed columns are aliased and cast identically on both sides
(BIGINT counts, doubles rounded to 6 places) so the results compare by value.
Query groups live in ``queries_*`` modules and register themselves on import.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GROUPS = (
    "synthtext.plans.queries_text",
    "synthtext.plans.queries_prompts",
    "synthtext.plans.queries_metrics",
    "synthtext.plans.queries_generation",
    "synthtext.plans.queries_io",
    "synthtext.plans.queries_checks",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def r6(col):
    """Round to 6 places as the oracle's ``round(x, 6)`` does for doubles:
    half away from zero on ``x * 1e6`` (Spark's ``round`` is HALF_UP on the
    decimal form, which differs on exact halves such as 8.3696875)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.signum(c) * F.floor(F.abs(c) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def _load() -> None:
    for g in GROUPS:
        importlib.import_module(g)


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
