"""Arrow batch files: rows are written by the tasks that hold them, and only their paths come back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import BatchSettings
from ..shipping import ship


class FileWriter:
    """Gathers record batches until a file's rows are reached; a file may overshoot by one batch."""

    def __init__(self, stem: str, rows: int):
        self.stem, self.rows, self.held, self.count, self.files = stem, rows, [], 0, 0

    def add(self, batch) -> tuple[str, int] | None:
        """The file that this batch completed, if any; empty batches are passed over."""
        if not batch.num_rows:
            return None
        self.held.append(batch)
        self.count += batch.num_rows
        return self.flush() if self.count >= self.rows else None

    def flush(self) -> tuple[str, int] | None:
        """Writes what is held; nothing if there is nothing."""
        if not self.held:
            return None
        import pyarrow as pa

        path = f"{self.stem}-{self.files:05d}.arrow"
        with pa.OSFile(path, "wb") as out, pa.ipc.new_file(out, self.held[0].schema) as writer:
            for batch in self.held:
                writer.write_batch(batch)
        written = (path, self.count)
        self.held, self.count, self.files = [], 0, self.files + 1
        return written


def write_files(df: DataFrame, settings: BatchSettings, stream: str) -> DataFrame:
    """One row for each file: path, rows, and the partition it came from, in the order of partitions.

    The folder has to be one that driver and executors share.  A task that runs again writes files of another
    name, and only the paths of the attempt that counted are reported.
    """
    ship(df.sparkSession)
    safe = "".join(c if c.isalnum() or c in "-_" else "_" for c in stream)
    root, rows, run = settings.root.rstrip("/"), settings.rows, uuid.uuid4().hex

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        writer = FileWriter(f"{root}/{safe}-{run}-{context.partitionId():05d}-{context.taskAttemptId()}", rows)

        def report(done):
            return pa.RecordBatch.from_pydict({"path": [f"file://{done[0]}"], "rows": pa.array([done[1]], pa.int64()), "partition": pa.array([context.partitionId()], pa.int32())})

        for batch in batches:
            if done := writer.add(batch):
                yield report(done)
        if done := writer.flush():
            yield report(done)

    return df.mapInArrow(write, "path string, rows long, partition int")


def assign(batches: DataFrame, rows: int, order: str, size: str) -> DataFrame:
    """The file that each of a row of equal batches goes to, and whether it is the one that fills it.

    A file takes whole batches until it has at least ``rows``; with equal batches that is every
    ``ceil(rows / size)`` of them.
    """
    place = F.row_number().over(Window.orderBy(order)) - 1  # a row for each batch, not for each record
    each = F.ceil(F.lit(rows) / F.col(size))
    return batches.withColumn("_place", place).withColumn("file", F.floor(F.col("_place") / each).cast("bigint")).withColumn("fills", (F.col("_place") + 1) % each == 0).drop("_place")
