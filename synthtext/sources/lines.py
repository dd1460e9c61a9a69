"""Lines of files by byte range (S3, S10): ``file, offset, value``.

Spark lists the files (in a stream with its own log of what was taken) and knows their
lengths; nothing of them is read for that. Each file is dealt into ranges of ``SPLIT``
bytes, the ranges over tasks, and a task reads the lines that start in its range, so a
file of any size is never one row or one task. A line's byte offset in its file is
its place: it does not depend on how files are cut, so ids made from it are equal after
a replay, and equal lines have ids of their own.

Files are opened where Spark's tasks run, through Arrow's file systems (local, HDFS, S3,
GCS). Lines end with LF, CRLF or CR; bytes that are not UTF-8 become U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synthtext.session import ship_package

SPLIT = 32 << 20
#: bytes read at once and handed on at once
_READ = 4 << 20
SCHEMA = "file string, offset bigint, value string"
#: of Spark's binaryFile source, which a stream has to be told
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")


def reachable(path: str) -> bool:
    """Whether the path's scheme (none: the default one) is one that Arrow opens."""
    return ":/" not in path or path.split(":/", 1)[0].lower() in SCHEMES


def file_system(uri: str):
    """Arrow's file system of ``uri`` and the path in it."""
    from urllib.parse import unquote

    from pyarrow import fs

    uri = "s3" + uri[3:] if uri.startswith("s3a:") else uri
    if uri.startswith("file:"):  # file:/x and file:///x alike
        return fs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _open(uri: str):
    where, path = file_system(uri)
    return where.open_input_file(path)


def range_lines(handle, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines whose first byte lies in ``start`` .. ``end - 1``."""
    at = start
    if start:  # the line that holds the byte before belongs to the range before
        at = start - 1
    handle.seek(at)
    held, skip = b"", start > 0
    while at < end:
        raw = handle.read(_READ)
        parts = (held + raw).split(b"\n")
        last = not raw
        held = b"" if last else parts.pop()
        for line in parts:
            if at >= end:
                return
            if not skip and not (last and not line):
                own = line[:-1] if line.endswith(b"\r") else line
                if b"\r" in own:
                    place = at
                    for one in own.split(b"\r"):
                        yield place, one
                        place += len(one) + 1
                else:
                    yield at, own
            skip = False
            at += len(line) + 1
        if last:
            return


def _read(batches):
    for batch in batches:
        for uri, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "end"))):
            offsets, values, size = [], [], 0

            def table():
                return pa.record_batch([pa.array([uri] * len(values)), pa.array(offsets, pa.int64()),
                                        pa.array(values, pa.string())], names=["file", "offset", "value"])

            with _open(uri) as handle:
                for at, line in range_lines(handle, start, end):
                    offsets.append(at)
                    values.append(line.decode("utf-8", "replace"))
                    size += len(line) + 16
                    if size >= _READ:
                        yield table()
                        offsets, values, size = [], [], 0
            if values:
                yield table()


def lines_of(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """``SCHEMA`` rows of ``files(path, length)``, as Spark's ``binaryFile`` source gives them in
    batch and in streams; its ``content`` is not read."""
    ship_package(files.sparkSession)
    ranges = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(SPLIT).cast("bigint"))).alias("start")).select(
        F.col("path").alias("file"), "start", F.least(F.col("start") + SPLIT, F.col("length")).alias("end"))
    n = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n, "file", "start").mapInArrow(_read, SCHEMA)
