"""Reads bounded by a replication key, and the bookmark that follows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import ref
from . import snapshot

#: The bookmark keys of an incremental stream; any other is an error (fixed values).
BOOKMARK_KEYS = ("replication_key", "replication_key_value", "version", "last_replication_method")


def incremental(df: DataFrame, datatypes: Mapping[str, str | None], key: str, bookmark: Any = None, bookmark_type: str | None = None, limit: int | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Rows from the bookmark on (itself included), by key, nulls last; all rows if there is no bookmark.

    Once there is a bookmark, rows without a key drop out.  ``ties`` make the order total, which a limit
    needs to give the same rows each time.  The bound stays on the raw column, so that it reaches the scan.
    """
    rows = df
    if bookmark is not None:
        literal = F.lit(bookmark)
        rows = rows.where(ref(key) >= (literal.cast(bookmark_type) if bookmark_type else literal))
    order = [ref(key).asc_nulls_last(), *[ref(t).asc_nulls_last() for t in ties]]
    rows = rows.orderBy(*order)
    if limit is not None:
        rows = rows.limit(limit)
    return snapshot.project(rows, datatypes)


def next_bookmark(rows: DataFrame, key: str) -> DataFrame:
    """The highest key that isn't null: what the next read starts from."""
    return rows.agg(F.max(ref(key)).alias("replication_key_value"))


def stalled(rows: DataFrame, key: str, bookmark: Any, limit: int | None) -> bool:
    """Whether a limited read ended on the value it began with, so that the next would give the same rows."""
    if limit is None or bookmark is None:
        return False
    got = rows.agg(F.count("*").alias("n"), F.max(ref(key)).alias("top")).first()
    return got["n"] >= limit and got["top"] == bookmark
