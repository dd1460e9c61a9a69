"""Tables given as one file or as a folder of part files."""

import pytest

import __spark_entry__ as E

ROWS = [(1, 0, "user", "One two. Three"), (1, 1, "assistant", None), (2, 0, "user", ""), (2, 1, "user", "One two. Three")]


@pytest.mark.parametrize("name, rows", [
    ("q_stream_prompts", 6), ("q_stream_finalize", 3), ("q_stream_chunks", 3), ("q_stream_callback", 3),
    ("q_stream_chunk_callback", 3), ("q_stream_metrics", 1)])
def test_streams_read_a_folder_as_they_read_a_file(spark, scratch, tmp_path, name, rows):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string")
    df.repartition(2).write.parquet(f"{scratch}/conversations.parquet")
    df.toPandas().to_parquet(tmp_path / "conversations.parquet")
    folder, file = (sorted(map(str, E.queries()[name](spark, d).collect())) for d in (scratch, str(tmp_path)))
    assert folder == file and len(file) == rows
