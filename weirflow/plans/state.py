"""The saved state: bookmarks, their reset, and the work that follows from them."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import METHODS
from ..operators.incremental import BOOKMARK_KEYS


class StateError(ValueError):
    """The state can't be gone on from."""


class State:
    """The state object and the rules of its bookmarks."""

    def __init__(self, value: dict[str, Any] | None = None):
        self.value = value if value is not None else {}
        self.value.setdefault("bookmarks", {})

    def get(self, stream: str, key: str) -> Any:
        return self.value["bookmarks"].get(stream, {}).get(key)

    def put(self, stream: str, **bookmarks: Any) -> None:
        self.value["bookmarks"].setdefault(stream, {}).update(bookmarks)

    def clear(self, stream: str, key: str) -> None:
        self.value["bookmarks"].get(stream, {}).pop(key, None)

    @property
    def current(self) -> str | None:
        return self.value.get("currently_syncing")

    @current.setter
    def current(self, stream: str | None) -> None:
        self.value["currently_syncing"] = stream

    def reset(self, stream: str, method: str, key: str | None) -> None:
        """Forgets a stream's bookmarks if its method, or its replication key, is another; notes the method."""
        was, was_key = self.get(stream, "last_replication_method"), self.get(stream, "replication_key")
        other_key = method == "INCREMENTAL" and was_key is not None and was_key != key
        if (was is not None and was != method) or other_key:
            self.value["bookmarks"][stream] = {}
        self.put(stream, last_replication_method=method)

    def check_incremental(self, stream: str) -> None:
        odd = sorted(set(self.value["bookmarks"].get(stream, {})) - set(BOOKMARK_KEYS))
        if odd:
            raise StateError(f"stream {stream} has bookmarks that an incremental one can't have: {', '.join(odd)}")

    def work(self, stream: str) -> str:
        """Whether a log-based stream is to be copied (again) or goes on from the log."""
        copying, position = self.get(stream, "xmin") is not None, self.get(stream, "lsn") is not None
        if copying and not position:
            raise StateError(f"stream {stream} has an xmin but no lsn")
        return "logical" if position and not copying else "snapshot"

    def drop_deselected(self, selected: set[str]) -> list[str]:
        """Forgets log positions of streams that are no longer selected; they would hold the log back."""
        gone = [s for s, b in self.value["bookmarks"].items() if s not in selected and "lsn" in b]
        for s in gone:
            del self.value["bookmarks"][s]
        return gone

    def committed(self, streams: list[str]) -> int | None:
        return min((p for p in (self.get(s, "lsn") for s in streams) if p is not None), default=None)


def resolve_method(given: str | None, default: str | None, stream: str) -> str:
    method = given or default
    if method not in METHODS:
        raise StateError(f"stream {stream} has replication method {method!r}; known ones are {', '.join(METHODS)}")
    return method


# The same rules over many streams at once, as columns.


def classified(xmin: Column, lsn: Column) -> Column:
    return F.when(xmin.isNotNull() & lsn.isNull(), "inconsistent").when(lsn.isNotNull() & xmin.isNull(), "logical").otherwise("snapshot")


def is_reset(was: Column, method: Column, was_key: Column, key: Column) -> Column:
    """Whether a stream's bookmarks are wiped."""
    other_method = F.coalesce(was != method, F.lit(False))
    return other_method | ((method == "INCREMENTAL") & was_key.isNotNull() & ~was_key.eqNullSafe(key))


def scheduled(streams: DataFrame, current: str | None) -> DataFrame:
    """Streams by id, the interrupted one first."""
    return streams.orderBy(F.col("stream") != F.lit(current or ""), "stream")


def odd_keys(bookmarks: DataFrame) -> DataFrame:
    """Bookmark keys of incremental streams that they can't have."""
    allowed = F.array(*[F.lit(k) for k in BOOKMARK_KEYS])
    return bookmarks.select("stream", F.array_sort(F.array_except("keys", allowed)).alias("odd")).where(F.size("odd") > 0)


def deselected(bookmarks: DataFrame, selected: DataFrame) -> DataFrame:
    """Streams whose log position is to be dropped."""
    return bookmarks.where("lsn is not null").join(selected, "stream", "left_anti")
