"""Responses put together from streamed pieces (ST2 with state).

A backend may hand on only the text that is new since its last chunk. The pieces of one
response, keyed by ``(request_id, seq_index)``, then arrive in several micro-batches and in any
order, and the response is whole when every piece up to the finished one is there.
``assemble_responses`` keeps the pieces of open responses as keyed state:

* a response that is whole is emitted at once and its state dropped;
* pieces that come again (a replayed source, a repeated row) replace themselves;
* a response that stays open is emitted when the watermark passes the event time of its
  latest piece by ``timeout``: its pieces up to the first gap, ``complete`` false;
* pieces of a response that was emitted already start an open one again, which
  leaves with ``complete`` false, unless they are older than the watermark and dropped.

State is one small row and one entry a piece for each open response, in RocksDB and its
checkpoint, so it is spread by key and survives a restart; a key's pieces are joined
only when it is emitted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RESPONSE = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("seq_index", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("n_pieces", T.LongType()),
    T.StructField("complete", T.BooleanType())])


class Assembler(StatefulProcessor):
    """Pieces of one response: a list of ``(seq, text)``, one entry a piece, and (latest event
    time, number of the last piece or -1, numbers held, time of its timer).

    Every call of the state goes to the executor's JVM and back, so an epoch makes few of them,
    however many pieces it has: new pieces are appended at once, and a timer that comes before
    the response is due is set again only then."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getListState("pieces", "seq long, text string")
        self.seen = handle.getValueState("seen", "latest long, last long, held array<long>, timer long")

    def _response(self, key, got: dict[int, str], complete: bool) -> Row:
        n = next(i for i in range(len(got) + 1) if i not in got)
        return Row(request_id=key[0], seq_index=key[1], text="".join(got[i] for i in range(n)), n_pieces=n,
                   complete=complete)

    def _held(self) -> dict[int, str]:
        """The pieces of an open response."""
        return {seq: text for seq, text in self.pieces.get()}

    def _closed(self) -> dict[int, str]:
        """The pieces of an open response, which is closed."""
        got = self._held()
        self.pieces.clear()
        self.seen.clear()
        return got

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[int, str] = {}
        latest, last = 0, -1
        mark = timerValues.getCurrentWatermarkInMs()
        for r in rows:
            if r["at_ms"] < mark:  # Spark itself drops late rows one epoch later
                continue
            new[r["seq"]] = "" if r["text"] is None else r["text"]
            latest = max(latest, r["at_ms"])
            if r["finished"]:
                last = r["seq"]
        if not new:
            return
        # numbers start at 0, and a response has none beyond its last piece
        seen = self.seen.get()
        if seen is None:
            if last >= 0 and len(new) == last + 1:  # all of it in one micro-batch: no state
                yield self._response(key, new, True)
                return
            self.pieces.put(list(new.items()))
            timer = latest + self.timeout_ms
            self.seen.update((latest, last, list(new), timer))
            self.handle.registerTimer(timer)
            return
        before, old_last, held, timer = seen
        all_held = set(held).union(new)
        last = max(last, old_last)
        if last >= 0 and len(all_held) == last + 1:
            self.handle.deleteTimer(timer)
            yield self._response(key, {**self._closed(), **new}, True)
            return
        if len(all_held) < len(held) + len(new):  # some come again
            self.pieces.put(list({**self._held(), **new}.items()))
        else:
            self.pieces.appendList(list(new.items()))
        self.seen.update((max(latest, before), last, list(all_held), timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        seen = self.seen.get()
        if seen is None:
            return
        latest, last, held, _ = seen
        due = latest + self.timeout_ms
        if due < timerValues.getCurrentWatermarkInMs():
            yield self._response(key, self._closed(), False)
        else:  # pieces came since the timer was set
            self.seen.update((latest, last, list(held), due))
            self.handle.registerTimer(due)

    def close(self) -> None:
        pass


def assemble_responses(pieces: DataFrame, delay: str = "10 minutes", timeout_ms: int = 600_000,
                       time_col: str = "event_time") -> DataFrame:
    """ST2: ``request_id, seq_index, text, n_pieces, complete`` of a stream of
    ``(request_id, seq_index, seq, text, finished, <time_col>)`` pieces.

    ``delay`` is how late pieces may come; ``timeout_ms`` of event time without a new
    piece end a response. Rows without a key, number or time are dropped. The session's
    state store must be RocksDB (``STATE_STORE``); it is set where nothing else is.
    """
    spark = pieces.sparkSession
    # Spark builds the processor once in a worker beside the driver, which has no shipped
    # files: the class travels by value
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    keyed = pieces.where(F.col("request_id").isNotNull() & F.col("seq_index").isNotNull() & (F.col("seq") >= 0)
                         & F.col(time_col).isNotNull())
    rows = keyed.select(
        F.col("request_id").cast("long"), F.col("seq_index").cast("long"), F.col("seq").cast("long"), "text",
        F.coalesce("finished", F.lit(False)).alias("finished"), F.col(time_col).alias("__time"),
        F.unix_millis(time_col).alias("at_ms")).withWatermark("__time", delay)
    return rows.groupBy("request_id", "seq_index").transformWithState(
        Assembler(timeout_ms), RESPONSE, "append", "EventTime")


def finalize_assembled(responses: DataFrame, pp) -> DataFrame:
    """The post-processing of ST2 on whole responses; open ones keep their raw text."""
    from synthtext.streaming.generate import finalize_responses

    return finalize_responses(responses.withColumnRenamed("complete", "finished"), pp).withColumnRenamed(
        "finished", "complete")


def attach_outputs_stream(prompts: DataFrame, outputs: DataFrame, key: str = "prompt_id", time_col: str = "event_time",
                          delay: str = "10 minutes", within: str = "1 hour") -> DataFrame:
    """B3 on streams: prompts with their output, which may come epochs later.

    ``outputs`` are matched by ``key`` if their time is at most ``within`` after the prompt's; a
    prompt without one leaves with null outputs once the watermarks of both sides
    (``delay``) say that none can come. Both sides' open rows are state, spread by key, and
    dropped by the same rule. Columns other than key and time need names of their own.
    """
    p = prompts.withWatermark(time_col, delay)
    o = outputs.withColumnsRenamed({key: "__key", time_col: "__at"}).withWatermark("__at", delay)
    match = (F.col(key) == F.col("__key")) & (F.col("__at") >= F.col(time_col)) & (
        F.col("__at") <= F.col(time_col) + F.expr(f"INTERVAL {within}"))
    return p.join(o, match, "left_outer").drop("__key", "__at")
