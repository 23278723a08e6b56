"""A run: which streams are read, by which method, in which order, and what is said on the way."""

from __future__ import annotations

import datetime
import logging
import time
from collections.abc import Callable, Mapping, Sequence
from types import MappingProxyType
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..config import Settings
from ..functions import convert
from ..functions.names import ref
from ..operators import batches, incremental, messages, snapshot
from ..operators.changelog import LogStream
from .catalog import Stream, discover, refresh
from .state import State, StateError, resolve_method

LOG = logging.getLogger(__name__)
Emit = Callable[[str], None]


def now() -> str:
    return datetime.datetime.now(datetime.timezone.utc).isoformat()


def new_version() -> int:
    """Milliseconds since the epoch."""
    return int(time.time() * 1000)


class Run:
    """One run over a source.

    ``emit`` gets each message as a line; data always comes before the state behind it.  ``log`` consumes the
    change log of some streams: it gets them, the state, the end position, ``emit``, and what to call when rows
    carry new columns (see ``streaming.runner``).
    """

    def __init__(self, spark: SparkSession, source: Any, settings: Settings, emit: Emit, log: Callable[..., None] | None = None, current_lsn: Callable[[], int] | None = None, current_xid: Callable[[], int] | None = None):
        self.spark, self.source, self.settings, self.emit = spark, source, settings, emit
        self.log, self.current_lsn, self.current_xid = log, current_lsn, current_xid
        self.extracted_at = now()

    def _say(self, message: dict[str, Any]) -> None:
        self.emit(messages.dumps(message))

    def _state(self, state: State) -> None:
        self._say(messages.state_message(state.value))

    def _schema(self, stream: Stream, bookmarks: Sequence[str]) -> None:
        self._say(messages.schema_message(stream.destination, stream.entry["schema"], stream.keys, bookmarks))

    # -- discovery --------------------------------------------------------------------------------

    def discovered(self, schemas: Sequence[str] | None = None, tables: Sequence[tuple[str, str]] | None = None) -> list[dict[str, Any]]:
        only = None if tables is None else self.spark.createDataFrame(list(tables), "schema_name string, table_name string")
        return discover(self.source.scan(), self.settings.dbname, schemas or self.settings.schemas, only)

    # -- reading ----------------------------------------------------------------------------------

    def sync(self, catalog: dict[str, Any], state: State) -> State:
        """All selected streams: copies and incremental reads first, then the log."""
        streams = [s for s in map(Stream, catalog.get("streams", [])) if s.is_selected]
        if not streams:
            LOG.info("no stream is selected")
            return state
        for s in streams:
            s.normalize()
        streams.sort(key=lambda s: s.id)
        methods = {s.id: resolve_method(s["replication-method"], self.settings.default_method, s.id) for s in streams}
        end_lsn = None
        if "LOG_BASED" in methods.values():
            if self.current_lsn is None:
                raise StateError("log-based streams need a log")
            end_lsn = self.current_lsn()
        refresh(streams, self.discovered(tables=[(s.schema_name, s.table) for s in streams]))
        for s in streams:
            if s.is_view and methods[s.id] == "LOG_BASED":
                raise StateError(f"{s.id} is a view, which has no log")
            state.reset(s.id, methods[s.id], s.replication_key)
        from_log = [s for s in streams if methods[s.id] == "LOG_BASED" and state.work(s.id) == "logical"]
        rest = [s for s in streams if s not in from_log]
        if state.current:
            if state.current not in methods:
                LOG.warning("stream %s was being read, but is no longer selected", state.current)
            rest.sort(key=lambda s: (s.id != state.current, s.id))
        for s in rest:
            self._one(s, methods[s.id], state, end_lsn)
        if from_log:
            self._from_log(from_log, state, end_lsn, set(methods))
        self._state(state)
        return state

    def _one(self, stream: Stream, method: str, state: State, end_lsn: int | None) -> None:
        columns = stream.columns
        if not columns:
            LOG.warning("stream %s has no selected column", stream.id)
            return
        state.current = stream.id
        if method == "INCREMENTAL":
            self._incremental(stream, state, columns)
        else:
            if method == "LOG_BASED" and state.get(stream.id, "lsn") is None:
                state.put(stream.id, lsn=end_lsn)
            self._full(stream, state, columns, as_records=method == "LOG_BASED")
        state.current = None
        self._state(state)

    def _converted(self, rows: DataFrame, stream: Stream, columns: Sequence[str]) -> dict[str, Any]:
        """Columns as records hold them.  A date has become a timestamp when it is read."""
        stored = dict(rows.dtypes)
        return {c: convert.snapshot_value(ref(c), "timestamp without time zone" if stream.datatype(c) == "date" else stream.datatype(c) or "text", stored.get(c, "string")) for c in columns}

    def _full(self, stream: Stream, state: State, columns: Sequence[str], as_records: bool) -> None:
        first = state.get(stream.id, "version") is None
        bookmark = state.get(stream.id, "xmin")
        version = state.get(stream.id, "version") if bookmark is not None and not first else new_version()
        state.put(stream.id, version=version)
        self._state(state)
        self._schema(stream, [])
        if first:
            self._say(messages.activate_message(stream.destination, version))
        df = self.source.rows(stream.schema_name, stream.table)
        watermark = None if stream.is_view else self.source.fact(stream.table).watermark
        xid = self.current_xid() if self.current_xid and bookmark is not None else None
        rows = snapshot.full_table(df, {c: stream.datatype(c) for c in columns}, watermark, bookmark, xid)
        order = [snapshot.WATERMARK] if watermark else []
        if self.settings.batch and not as_records:
            if watermark:
                last = snapshot.last_watermark(rows).first()["xmin"]
                rows = rows.drop(snapshot.WATERMARK)
            if self._files(rows, stream) and watermark and last is not None:
                state.put(stream.id, xmin=last)
                self._state(state)
        else:
            for n, row in enumerate(self._records(rows, stream, version, columns, order), 1):
                if watermark:
                    state.put(stream.id, xmin=row["_order_0"])
                    if n % snapshot.FULL_EVERY == 0:
                        self._state(state)
        state.clear(stream.id, "xmin")
        self._say(messages.activate_message(stream.destination, version))

    def _incremental(self, stream: Stream, state: State, columns: Sequence[str]) -> None:
        key = stream.replication_key
        if not key:
            raise StateError(f"stream {stream.id} has no replication-key")
        if key not in columns:
            raise StateError(f"the replication key {key} of stream {stream.id} isn't selected")
        state.check_incremental(stream.id)
        version = state.get(stream.id, "version") or new_version()
        state.put(stream.id, version=version, replication_key=key)
        self._state(state)
        self._schema(stream, [key])
        self._say(messages.activate_message(stream.destination, version))
        df = self.source.rows(stream.schema_name, stream.table)
        bookmark, limit = state.get(stream.id, "replication_key_value"), self.settings.limit
        kind = dict(df.dtypes)[key]
        ties = [k for k in stream.keys if k != key]
        rows = incremental.incremental(df, {c: stream.datatype(c) for c in columns}, key, bookmark, kind, limit, ties)
        shown = self._converted(rows, stream, [key])[key]
        if self.settings.batch:
            top = incremental.next_bookmark(rows.select(shown.alias(key)), key).first()["replication_key_value"]
            if self._files(rows, stream) and top is not None:
                state.put(stream.id, replication_key_value=top)
                self._state(state)
            return
        for n, row in enumerate(self._records(rows, stream, version, columns, [key]), 1):
            if row["_order_0"] is not None:
                state.put(stream.id, replication_key_value=_plain(row["_order_0"]))
            if n % snapshot.INCREMENTAL_EVERY == 0:
                self._state(state)

    def _records(self, rows: DataFrame, stream: Stream, version: int, columns: Sequence[str], order: Sequence[str]):
        """Emits the records in order, partition by partition; gives each row after its line is out."""
        shown = self._converted(rows, stream, columns)
        if order and order[0] in shown:
            rows = rows.withColumn("_key", shown[order[0]])
            order = ["_key"]
        lines = messages.record_messages(rows, stream.destination, version, self.extracted_at, shown, order)
        for row in lines.toLocalIterator(prefetchPartitions=True):
            self.emit(messages.record_line(row))
            yield row

    def _files(self, rows: DataFrame, stream: Stream) -> int:
        """Writes Arrow files on the executors and names them, in the order of their partitions."""
        written = batches.write_files(rows, self.settings.batch, stream.destination)
        done = written.orderBy("partition", "path").collect()  # a row for each file
        for f in done:
            self._say(messages.batch_message(stream.destination, [f["path"]]))
        return sum(f["rows"] for f in done)

    def _from_log(self, streams: Sequence[Stream], state: State, end_lsn: int, selected: set[str]) -> None:
        for gone in state.drop_deselected(selected):
            LOG.info("forgot the log position of %s, which is no longer selected", gone)
        if self.log is None:
            raise StateError("log-based streams need a log")
        databases: dict[str, list[Stream]] = {}
        for s in streams:
            databases.setdefault(s["database-name"] or self.settings.dbname, []).append(s)
        for _, group in sorted(databases.items()):
            for s in group:
                s.add_automatic(self.settings.debug_lsn)
                self._schema(s, ["lsn"])
            self.log(self._log_streams(group, state), state, end_lsn, self.emit, lambda new, group=group: self._drifted(group, state, new))

    def _log_streams(self, streams: Sequence[Stream], state: State, seen: Mapping[tuple[str, str], Sequence[str]] = MappingProxyType({})) -> list[LogStream]:
        """What a session has to know of its streams; ``seen`` names columns that have been looked for."""
        out = []
        for s in streams:
            known = frozenset(s.entry["schema"]["properties"]) | frozenset(seen.get((s.schema_name, s.table), ()))
            out.append(LogStream(s.id, s.schema_name, s.table, state.get(s.id, "version"), {c: self._typed(s, c) for c in s.columns}, known))
        return out

    @staticmethod
    def _typed(stream: Stream, column: str) -> str:
        """A column's type; changes can't be read without it."""
        datatype = stream.datatype(column)
        if not datatype:
            raise ValueError(f"no type is known for column {column} of {stream.id}")
        return datatype

    def _drifted(self, streams: Sequence[Stream], state: State, new: Mapping[tuple[str, str], Sequence[str]]) -> list[LogStream]:
        """Reads the schemas of the tables that have grown again, and says them before their next record."""
        grown = [s for s in streams if (s.schema_name, s.table) in new]
        refresh(grown, self.discovered(tables=list(new)))
        for s in grown:
            s.add_automatic(self.settings.debug_lsn)
            self._schema(s, ["lsn"])
        return self._log_streams(streams, state, new)


def _plain(value: Any) -> Any:
    """A key as the state can hold it."""
    return value if isinstance(value, (int, float, str, bool)) else str(value)
