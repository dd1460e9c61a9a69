"""Records and metric events of all runs in one table each (K6, K8, K9).

    <out>/all_records/run_id=<run>/attempt=<try>
    <out>/all_events/run_id=<run>/attempt=<try>
    <out>/manifest/run_id=<run>           one row: the try that counts, and the run's settings

A try writes its own partitions (dynamic partition overwrite: a repeated write of the same
try replaces it, other runs are left alone); its manifest row comes last. Readers
join the manifest, so a run that was killed is invisible, and a finished run stays as it was
while a later try of it is under way or after that one was killed.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS, EVENTS, MANIFEST = "all_records", "all_events", "manifest"
_MANIFEST = "run_id string, attempt string, config_json string"


def write_attempt(df: DataFrame, out: str, name: str, run_id: str, attempt: str) -> None:
    """``df`` as the partition of one try in the table ``name``."""
    own = df.drop("run_id", "attempt").withColumns({"run_id": F.lit(run_id), "attempt": F.lit(attempt)})
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "attempt").parquet(
        f"{out.rstrip('/')}/{name}")


def read_attempt(spark: SparkSession, out: str, name: str, run_id: str, attempt: str) -> DataFrame:
    """What a try wrote, finished or not (a pruned scan of its partition)."""
    return _table(spark, out, name).where((F.col("run_id") == run_id) & (F.col("attempt") == attempt)).drop("run_id", "attempt")


def finish_run(spark: SparkSession, out: str, run_id: str, attempt: str, config: dict) -> None:
    """The manifest row of a run: from now on its readers see this try."""
    row = spark.createDataFrame([(run_id, attempt, json.dumps(config, sort_keys=True))], _MANIFEST)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(
        f"{out.rstrip('/')}/{MANIFEST}")


def _table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A shared table; run and try are texts whatever they look like ('007' stays so)."""
    path = f"{out.rstrip('/')}/{name}"
    found = spark.read.parquet(path)
    keys = {"run_id": "string", "attempt": "string"}
    schema = ", ".join(f"`{f.name}` {keys.get(f.name, f.dataType.simpleString())}" for f in found.schema.fields)
    return spark.read.schema(schema).parquet(path)


def finished_runs(spark: SparkSession, out: str) -> DataFrame:
    """``(run_id, attempt, config_json)`` of finished runs; empty before the first."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{out.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def read_finished(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The rows of finished runs in a shared table, with ``run_id``."""
    own = finished_runs(spark, out).select("run_id", "attempt")
    return _table(spark, out, name).join(own, ["run_id", "attempt"], "left_semi").drop("attempt")
