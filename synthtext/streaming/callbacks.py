"""ST4 for every chunk: a user's consumer called on the executors as chunks arrive.

``foreachBatch`` hands a whole micro-batch to the driver's code; a consumer that wants each
chunk as it comes is called here instead, row by row, by Spark's ``foreach`` sink, where the
chunk was made. The chunks of a request come in the order of their ``seq``: a request lies
in one partition and nothing moves between generation and sink.

A partition of an epoch that was consumed to its end leaves a mark in a folder that all
executors reach. An epoch that is replayed after a failure skips the marked partitions, so
their chunks are handed over once. A partition that failed half-way is handed over again
from its start (its consumer was closed with the error): a consumer shows what it got at
``close`` and lets go of it after an error, as ``JsonLines`` does.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery

from synthtext.session import ship_package
from synthtext.sources.lines import file_system


class Consumer(Protocol):
    """One partition of one epoch."""

    def chunk(self, row: Row) -> None: ...

    def close(self, error: Exception | None) -> None: ...


class _Writer:
    def __init__(self, make: Callable[[int, int], Consumer], marks: str):
        self.make, self.marks = make, marks
        self.consumer = None

    def open(self, partition: int, epoch: int) -> bool:
        from pyarrow import fs

        self.consumer = None
        self.mark = f"{self.marks}/epoch={epoch}/partition={partition}"
        where, path = file_system(self.mark)
        if where.get_file_info(path).type != fs.FileType.NotFound:
            return False
        self.consumer = self.make(partition, epoch)
        return True

    def process(self, row: Row) -> None:
        self.consumer.chunk(row)

    def close(self, error: Exception | None) -> None:
        if self.consumer is None:  # skipped, or never made
            return
        self.consumer.close(error)
        if error is None:
            write_file(self.mark, b"")


def write_file(uri: str, data: bytes) -> None:
    """A file of ``data``, its folder made where the store has folders."""
    where, path = file_system(uri)
    where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with where.open_output_stream(path) as f:
        f.write(data)


#: characters of lines that a consumer holds before it writes them
HELD_CHARS = 1 << 20


class JsonLines:
    """A consumer that leaves a file of JSON lines for each partition of each epoch, in the
    order of the calls (``n``). Lines are written as they come, to a name that readers skip;
    the file gets its own name at the end. ``compression`` as Arrow's streams name it."""

    def __init__(self, folder: str, columns: list[str], partition: int, epoch: int, compression: str | None = None):
        end = {None: "", "gzip": ".gz", "bz2": ".bz2"}[compression]
        self.path, self.columns = f"{folder}/epoch={epoch}/partition={partition}/part.json{end}", columns
        self.compression = compression
        self.lines: list[str] = []
        self.n = self.held = 0
        self.file = None

    def chunk(self, row: Row) -> None:
        line = json.dumps({"n": self.n, **{c: row[c] for c in self.columns}})
        self.lines.append(line)
        self.n, self.held = self.n + 1, self.held + len(line)
        if self.held >= HELD_CHARS:
            self._write()

    def _write(self) -> None:
        if self.file is None:
            self.where, to = file_system(self.path)
            folder, _, name = to.rpartition("/")
            self.to, self.open = to, f"{folder}/_{name}.open"
            self.where.create_dir(folder, recursive=True)
            self.file = self.where.open_output_stream(self.open, compression=self.compression)
        self.file.write("".join(f"{x}\n" for x in self.lines).encode())
        self.lines, self.held = [], 0

    def close(self, error: Exception | None) -> None:
        if error is None and self.lines:
            self._write()
        if self.file is None:
            return
        self.file.close()
        if error is None:
            self.where.move(self.open, self.to)
        else:  # the partition comes again from its start
            self.where.delete_file(self.open)


def consume_stream(chunks: DataFrame, make: Callable[[int, int], Consumer], marks: str, checkpoint: str) -> StreamingQuery:
    """ST4: ``make(partition, epoch)`` gives the consumer of a partition; ``marks`` is a folder
    that every executor reaches, kept as long as ``checkpoint``."""
    ship_package(chunks.sparkSession)
    return chunks.writeStream.foreach(_Writer(make, marks.rstrip("/"))).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
