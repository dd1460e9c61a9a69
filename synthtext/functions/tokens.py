"""Token operators on Columns (T1, T2, T4) and the tokenizer hook.

The default tokenizer is native: split on whitespace runs and drop empty
pieces (Python's ``str.split()``). A user tokenizer (any ``str -> list[int]``
callable, e.g. a BPE encoder) is wrapped in an Arrow-batched pandas UDF and
built once per Python worker.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthtext.functions.text import WS_RUN, _c


def tokenize(col: Column | str) -> Column:
    """T1 (native): whitespace tokens, ``ARRAY<STRING>``."""
    return F.filter(F.split(_c(col), WS_RUN), lambda x: x != "")


def tokenize_clean(col: Column | str) -> Column:
    """T1 for whitespace-cleaned text (X1 output): a plain split on U+0020,
    which skips the regular-expression engine. Same tokens as ``tokenize``
    on such text."""
    return F.filter(F.split(_c(col), " "), lambda x: x != "")


def truncate_tokens(tokens: Column | str, max_tokens: int, side: str = "right") -> Column:
    """Keep ``max_tokens`` tokens; ``right`` cuts the tail, ``left`` the head."""
    t = _c(tokens)
    if side == "right":
        return F.slice(t, 1, max_tokens)
    if side == "left":
        return F.slice(t, F.greatest(F.size(t) - max_tokens, F.lit(0)) + 1, max_tokens)
    raise ValueError(f"truncation side must be 'left' or 'right', not {side!r}")


def count_tokens(col: Column | str, tokenizer: Callable[[Column], Column] = tokenize) -> Column:
    """T4: tokens per text as BIGINT."""
    return F.size(tokenizer(col)).cast("long")


_WORKER_TOKENIZERS: dict[str, Callable[[str], list[int]]] = {}


def udf_tokenizer(factory: Callable[[], Callable[[str], list[int]]]) -> Callable[[Column], Column]:
    """T1 with a user tokenizer: ``factory()`` builds an encoder once per worker.

    Returns a Column function producing ``ARRAY<INT>`` token ids through an
    Arrow-batched pandas UDF (never a row-at-a-time UDF).
    """
    from synthtext.operators.backends import factory_digest

    key = factory_digest(factory)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _encode(texts: pd.Series) -> pd.Series:
        enc = _WORKER_TOKENIZERS.get(key)
        if enc is None:
            enc = _WORKER_TOKENIZERS[key] = factory()
        return texts.map(lambda t: None if t is None else list(enc(t)))

    from pyspark.sql import SparkSession

    from synthtext.session import ship_package

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    return lambda col: _encode(_c(col))
