"""A change log as a Spark data source, for batch and streaming reads.

The log is a folder of JSON lines, each with an ``lsn`` and a ``payload``, that driver and executors share;
``seq`` is a line's place among them, which orders lines that share a position.
As a stream its offsets are positions; ``commit`` confirms a position to the log's owner by writing it to a
file, and never confirms more than what the consumer has committed.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from ..functions.names import read_table_list

SCHEMA = "lsn bigint, seq bigint, schema string, `table` string, action string, payload string"
NAME = "weirflow_change_log"


class Span(InputPartition):
    """Lines of one file, the ``place``-th, whose positions lie above ``after`` and not above ``upto``."""

    def __init__(self, path: str, place: int, after: int, upto: int | None):
        super().__init__((path, place, after, upto))
        self.path, self.place, self.after, self.upto = path, place, after, upto


#: What a position without a change of the wanted tables carries: it is counted, and routed nowhere.
NO_CHANGE = "{}"


def _lines(path: str, at: int = 0) -> Iterator[tuple[int, int, Any]]:
    """The bytes read, the position and the payload of each line from byte ``at`` on.

    A last line without an end counts only once it can be read: its owner may still be writing it.
    """
    with open(path, "rb") as f:
        f.seek(at)
        for line in f:
            at += len(line)
            if not line.strip():
                continue
            try:
                row = json.loads(line)
            except ValueError:
                if line.endswith(b"\n"):
                    raise
                return
            yield at, int(row["lsn"]), row["payload"]


def _rows(span: Span, wanted: dict[str, frozenset], tables: frozenset[tuple[str, str]] | None = None) -> Iterator[tuple]:
    for n, (_, lsn, payload) in enumerate(_lines(span.path)):
        if lsn <= span.after or (span.upto is not None and lsn > span.upto):
            continue
        try:
            event = json.loads(payload)
        except (TypeError, ValueError):
            event = None
        parts = event if isinstance(event, dict) else {}
        row = {k: parts.get(k) for k in ("schema", "table", "action")}
        if tables is not None and event is not None and (row["schema"], row["table"]) not in tables:
            row, payload = dict.fromkeys(row), NO_CHANGE
        if all(row[k] in v for k, v in wanted.items()):
            yield lsn, (span.place << 40) + n, row["schema"], row["table"], row["action"], payload


class _Files:
    def __init__(self, options: dict):
        self.path = options["path"]

    def files(self) -> list[str]:
        return sorted(str(p) for p in Path(self.path).glob("*.json*") if not p.name.startswith(("_", ".")))


class LogReader(_Files, DataSourceReader):
    """Batch reads; filters on schema, table and action are taken over from Spark."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.after = int(options.get("startLsn", -1))
        self.upto = int(options["endLsn"]) if options.get("endLsn") else None
        self.wanted: dict[str, frozenset] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if values is None or name not in ("schema", "table", "action"):
                yield f
                continue
            self.wanted[name] = self.wanted.get(name, frozenset(values)) & frozenset(values)

    def partitions(self) -> Sequence[InputPartition]:
        return [Span(f, k, self.after, self.upto) for k, f in enumerate(self.files())]

    def read(self, partition: Span) -> Iterator[tuple]:
        return _rows(partition, self.wanted)


@dataclass(frozen=True)
class Seen:
    """What is known of a file: the bytes that were read, and the bounds of their positions."""

    size: int = 0
    low: int | None = None
    high: int | None = None

    def meets(self, after: int, upto: int) -> bool:
        return self.low is None or self.high is None or (self.low <= upto and self.high > after)


class LogStreamReader(_Files, DataSourceStreamReader):
    """Streaming reads by position, up to the end position of the run if one is given.

    Each byte of the log is looked at once on the driver, for the positions only, and a batch reads the files that
    may hold its positions.  Of ``addTables``, where given, whole events come; of others nothing but their positions.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.start = int(options.get("startLsn", -1))
        self.end = int(options["endLsn"]) if options.get("endLsn") else None
        self.confirm, self.state = options.get("confirmPath"), options.get("statePath")
        self.streams = [s for s in options.get("streams", "").split(",") if s]
        self.tables = read_table_list(options["addTables"]) if options.get("addTables") else None
        self.seen: dict[str, Seen] = {}

    def initialOffset(self) -> dict:
        return {"lsn": self.start}

    def latestOffset(self) -> dict:
        for f in self.files():
            seen = self.seen.get(f, Seen())
            for at, lsn, _ in _lines(f, seen.size):
                seen = Seen(at, lsn if seen.low is None else min(seen.low, lsn), lsn if seen.high is None else max(seen.high, lsn))
            self.seen[f] = seen
        top = max((s.high for s in self.seen.values() if s.high is not None), default=self.start)
        return {"lsn": max(self.start, top if self.end is None else min(top, self.end))}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """The files that may hold positions of the batch; one that hasn't been looked at may."""
        out = [Span(f, k, start["lsn"], end["lsn"]) for k, f in enumerate(self.files()) if self.seen.get(f, Seen()).meets(start["lsn"], end["lsn"])]
        return out or [Span(os.devnull, 0, start["lsn"], end["lsn"])]

    def read(self, partition: Span) -> Iterator[tuple]:
        return _rows(partition, {}, self.tables)

    def commit(self, end: dict) -> None:
        if self.confirm:
            confirm(self.confirm, end["lsn"], committed_in(self.state, self.streams))


def server_facts(path: str) -> dict[str, Any] | None:
    """What the log's owner says of its server in ``_server.json``: ``version``, a number, and ``slots``, names."""
    try:
        return json.loads((Path(path) / "_server.json").read_text())
    except FileNotFoundError:
        return None


def committed_in(path: str | None, streams: Sequence[str]) -> int | None:
    """The smallest position that the consumer's state file has for the streams; unreadable files have none."""
    if not path:
        return None
    try:
        bookmarks = json.loads(Path(path).read_text())["bookmarks"]
        found = [bookmarks[s]["lsn"] for s in streams if bookmarks.get(s, {}).get("lsn") is not None]
    except (OSError, ValueError, KeyError, TypeError, AttributeError):
        return None
    return min(found, default=None)


def confirm(path: str, processed: int, committed: int | None) -> int | None:
    """Confirms what is processed and committed; positions never go back."""
    if committed is None:
        return None
    target = Path(path)
    try:
        before = int(target.read_text())
    except (OSError, ValueError):
        before = None
    position = min(processed, committed)
    if before is not None and position <= before:
        return before
    part = target.with_suffix(".part")
    part.write_text(str(position))
    os.replace(part, target)
    return position


class ChangeLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str | StructType:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return LogReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LogStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with filters pushed into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChangeLog)
