"""ST2 with state: pieces over several epochs, restarts, open responses."""

import time

from pyspark.sql import functions as F

from synthtext.config import PostProcessing
from synthtext.streaming.responses import RESPONSE, assemble_responses, finalize_assembled

SCHEMA = "request_id long, seq_index long, seq long, text string, finished boolean, event_time timestamp"


def put(spark, path, rows):
    df = spark.createDataFrame([(*r[:5], f"2024-01-01 {r[5]}") for r in rows], SCHEMA.replace("timestamp", "string"))
    df.withColumn("event_time", F.to_timestamp("event_time")).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)  # files are taken in order of their times


def drain(spark, root, options=None):
    feed = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    q = assemble_responses(feed, **(options or {})).writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted(tuple(r) for r in spark.read.schema(RESPONSE).parquet(f"{root}/out").collect())


def test_pieces_out_of_order_over_a_restart(spark, scratch):
    src = f"{scratch}/in"
    put(spark, src, [(1, 0, 0, "a", False, "00:00:01"), (1, 0, 0, "a", False, "00:00:01"),  # a repeated row
                     (2, 0, 1, "y", True, "00:00:02"), (3, 0, 0, "whole", True, "00:00:02"),
                     (4, 0, 1, "lost start", False, "00:00:02"), (5, 0, 0, "open", False, "00:00:03"),
                     (6, 1, 0, None, True, "00:00:03"), (None, 0, 0, "no key", True, "00:00:03")])
    put(spark, src, [(1, 0, 2, "c", True, "00:00:04"), (5, 0, 1, " end", False, "00:00:05")])
    assert drain(spark, scratch) == [(3, 0, "whole", 1, True), (6, 1, "", 1, True)]
    # another query goes on from the checkpoint
    put(spark, src, [(1, 0, 1, "b", False, "00:00:06"), (2, 0, 0, "x", False, "00:00:06"), (5, 0, 1, " end", False, "00:00:07")])
    assert drain(spark, scratch) == [(1, 0, "abc", 3, True), (2, 0, "xy", 2, True), (3, 0, "whole", 1, True), (6, 1, "", 1, True)]
    put(spark, src, [(9, 0, 0, "later", True, "06:00:00")])
    put(spark, src, [(5, 0, 2, "too late", True, "00:00:08"), (10, 0, 0, "now", True, "06:00:01")])
    assert drain(spark, scratch) == [
        (1, 0, "abc", 3, True), (2, 0, "xy", 2, True), (3, 0, "whole", 1, True), (4, 0, "", 0, False),
        (5, 0, "open end", 2, False), (6, 1, "", 1, True), (9, 0, "later", 1, True), (10, 0, "now", 1, True)]


def test_whole_responses_are_post_processed(spark):
    df = spark.createDataFrame([(1, 0, "Hi. Hi. x", 3, True), (2, 0, "Hi. Hi. x", 3, False)], RESPONSE)
    got = {r.request_id: (r.text, r.complete) for r in finalize_assembled(df, PostProcessing(
        max_length=2048, complete_sentences=True, deduplicate=True)).collect()}
    assert got == {1: ("Hi.", True), 2: ("Hi. Hi. x", False)}


def test_outputs_that_come_epochs_later(spark, scratch):
    from synthtext.streaming.responses import attach_outputs_stream

    def row(side, i, text, at):
        df = spark.createDataFrame([(i, text, f"2024-01-01 {at}")], f"prompt_id long, {side} string, event_time string")
        df.withColumn("event_time", F.to_timestamp("event_time")).coalesce(1).write.mode("append").parquet(f"{scratch}/{side}")
        time.sleep(1.1)

    def drain_join():
        sides = [spark.readStream.schema(f"prompt_id long, {s} string, event_time timestamp").option(
            "maxFilesPerTrigger", 1).parquet(f"{scratch}/{s}") for s in ("prompt", "output")]
        j = attach_outputs_stream(*sides).select("prompt_id", "prompt", "output")
        j.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck").trigger(
            availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(j.schema).parquet(f"{scratch}/out").collect())

    row("prompt", 1, "one", "00:00:01")
    row("prompt", 2, "two", "00:00:02")
    row("output", 9, "no prompt", "00:00:03")
    assert drain_join() == []
    row("output", 1, "ONE", "00:20:00")
    assert drain_join() == [(1, "one", "ONE")]  # after a restart, epochs later
    row("prompt", -1, "", "09:00:00")
    row("output", -1, "", "09:00:01")
    assert drain_join() == [(-1, "", ""), (1, "one", "ONE"), (2, "two", None)]
