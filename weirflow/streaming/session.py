"""A streaming session over a change log: every micro-batch is decoded, written, and then counted as processed."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import table_list
from ..operators import changelog, messages
from ..operators.changelog import LogStream
from ..plans.state import State
from ..sources import change_log

log_of_session = logging.getLogger(__name__)

#: Advances of the processed position between saved states (fixed value).
ADVANCES = 10_000


class Drift(RuntimeError):
    """Rows carry names that a stream doesn't know; its schema has to be read again."""

    def __init__(self, names: dict[tuple[str, str], list[str]]):
        super().__init__(f"unknown columns: {names}")
        self.names = names


@dataclass
class LogSession:
    """Positions of a session, and what each micro-batch does to them.

    ``write`` gets a batch's record lines in order of position; ``emit`` gets other messages.
    Unreadable payloads are counted in ``unreadable``, warned of, and kept below ``dead_letters``, a folder for each batch.
    """

    streams: Sequence[LogStream]
    state: State
    extracted_at: str
    write: Callable[[DataFrame], int]
    emit: Callable[[dict[str, Any]], None]
    end_lsn: int | None = None
    debug_lsn: bool = False
    refresh: Callable[[dict[tuple[str, str], list[str]]], Sequence[LogStream]] | None = None
    committed: int | None = None
    processed: int | None = None
    complete: int | None = None
    advances: int = 0
    dead_letters: str | None = None
    unreadable: int = 0
    rows: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.committed = self.state.committed([s.stream_id for s in self.streams])

    def take(self, batch: DataFrame, batch_id: int = 0) -> None:
        """One micro-batch: parse, route, decode, write; then positions move."""
        spark = batch.sparkSession
        log = batch.select("lsn", "payload", *[c for c in ("seq",) if c in batch.columns])
        if self.end_lsn is not None:
            log = changelog.until(log, self.end_lsn)
        events = changelog.parse(log).persist()
        try:
            self._refresh_known(spark, events)
            table = spark.createDataFrame([(s.schema, s.table) for s in self.streams], "schema string, `table` string")
            routed = changelog.route(events, table)
            met = {(r["schema"], r["table"]): r for r in changelog.counts(routed).collect()}  # a row for each stream
            lines = [self._lines(routed, s) for s in self.streams if (s.schema, s.table) in met]
            if lines:  # all streams in one pass, so that records leave in the order of the log
                self.write(reduce(DataFrame.unionByName, lines).orderBy("_order_0", "_order_1"))
            for s in self.streams:
                if got := met.get((s.schema, s.table)):
                    self.rows[s.stream_id] = self.rows.get(s.stream_id, 0) + got["n"]
                    self.state.put(s.stream_id, lsn=got["last"])
            self._bury(events, batch_id)
            self._advance(events)
        finally:
            events.unpersist()

    def _lines(self, routed: DataFrame, s: LogStream) -> DataFrame:
        decoded = changelog.assemble(routed, s, self.extracted_at, self.debug_lsn)
        names = [*s.selected, changelog.DELETED_AT, *([changelog.POSITION] if self.debug_lsn else [])]
        return messages.record_messages(decoded, f"{s.schema}-{s.table}", s.version, self.extracted_at, {n: F.col(f"`{n}`") for n in names}, ["_lsn", "_seq"], F.col("_present"))

    def _bury(self, events: DataFrame, batch_id: int) -> None:
        dead = changelog.unreadable(events)
        n = dead.count()
        if not n:
            return
        if self.dead_letters is not None:  # a batch that is tried again writes its folder again
            dead.write.mode("overwrite").parquet(f"{self.dead_letters}/batch={batch_id}")
        self.unreadable += n
        log_of_session.warning("%d unreadable payloads in batch %d, kept in %s", n, batch_id, self.dead_letters or "no place")

    def _refresh_known(self, spark: SparkSession, events: DataFrame) -> None:
        known = spark.createDataFrame([(s.schema, s.table, sorted(s.known | set(s.selected))) for s in self.streams], "schema string, `table` string, names array<string>")
        new: dict[tuple[str, str], list[str]] = {}
        for r in changelog.drift(events, known).collect():  # distinct new names: as many as columns were added
            new.setdefault((r["schema"], r["table"]), []).append(r["name"])
        if new:
            if self.refresh is None:
                raise Drift(new)
            self.streams = list(self.refresh(new))

    def _advance(self, events: DataFrame) -> None:
        positions = events.select("lsn").distinct()
        got = positions.agg(F.count("*").alias("n"), F.max("lsn").alias("top"), F.min("lsn").alias("low")).first()
        if not got["n"]:
            return
        below = positions.where(F.col("lsn") < got["top"]).agg(F.max("lsn")).first()[0]
        before = self.processed
        self.advances += got["n"] - (1 if before is None or got["low"] <= before else 0)
        if below is not None and (before is None or below > before):
            self.complete = below
        elif before is not None and got["top"] > before:
            self.complete = before
        self.processed = max(got["top"], before or got["top"])
        if self.advances >= ADVANCES and self.complete is not None:
            self.advances %= ADVANCES
            self._put_all(self.complete)
            self.emit(messages.state_message(self.state.value))

    def _put_all(self, lsn: int) -> None:
        for s in self.streams:
            self.state.put(s.stream_id, lsn=lsn)

    def finish(self) -> None:
        """Leaves every stream at the last complete position, never below what was committed."""
        position = changelog.final_position(self.complete, self.committed)
        if position is not None:
            self._put_all(position)
        self.emit(messages.state_message(self.state.value))


def run(spark: SparkSession, session: LogSession, path: str, checkpoint: str, confirm_path: str | None = None, state_path: str | None = None, max_seconds: float | None = None, idle_seconds: float | None = None, continuous: bool = False) -> LogSession:
    """Consumes the log up to the session's end position (or on and on, until the time or the quiet is over)."""
    change_log.register(spark)
    if session.dead_letters is None:
        session.dead_letters = f"{checkpoint.rstrip('/')}-dead-letters"
    start = session.state.committed([s.stream_id for s in session.streams])
    options = {"path": path, "startLsn": str(-1 if start is None else start - 1), "streams": ",".join(s.stream_id for s in session.streams)}
    options["addTables"] = table_list([(s.schema, s.table) for s in session.streams])
    for key, value in (("endLsn", session.end_lsn), ("confirmPath", confirm_path), ("statePath", state_path)):
        if value is not None:
            options[key] = str(value)
    log = spark.readStream.format(change_log.NAME).options(**options).load()
    writer = log.writeStream.foreachBatch(session.take).option("checkpointLocation", checkpoint)
    query = (writer.trigger(processingTime="1 second") if continuous else writer.trigger(availableNow=True)).start()
    began = quiet = time.monotonic()
    seen = session.processed
    try:
        while not query.awaitTermination(1):
            now = time.monotonic()
            if session.processed != seen:
                seen, quiet = session.processed, now
            if (max_seconds is not None and now - began > max_seconds) or (idle_seconds is not None and now - quiet > idle_seconds):
                query.stop()
    finally:
        if query.isActive:
            query.stop()
        session.finish()
    if confirm_path and session.processed is not None:
        change_log.confirm(confirm_path, session.processed, change_log.committed_in(state_path, [s.stream_id for s in session.streams]))
    return session
