"""Change events: parsing, routing, assembly of records, drift, and positions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import log_values

#: The actions that are taken (fixed values): insert, update, delete.
ACTIONS = ("I", "U", "D")
DELETED_AT, POSITION = "_sdc_deleted_at", "_sdc_lsn"
ENTRIES = "array<struct<name string, value variant>>"


@dataclass(frozen=True)
class LogStream:
    """A stream of a session: where its changes come from, its selected columns and all known ones."""

    stream_id: str
    schema: str
    table: str
    version: int | None
    selected: Mapping[str, str]
    known: frozenset[str] = frozenset()


def parse(log: DataFrame) -> DataFrame:
    """``lsn`` and ``payload`` with the event's parts; ``readable`` is false where the payload isn't JSON.

    A payload that is JSON but no object has no parts, and is routed nowhere.
    """
    v = F.try_parse_json("payload")
    rows = log.select("*", v.alias("_v"))
    part = {c: F.try_variant_get("_v", f"$.{c}", "string").alias(c) for c in ("action", "schema", "table")}
    lists = [F.try_variant_get("_v", f"$.{c}", ENTRIES).alias(c) for c in ("columns", "identity")]
    return rows.select(*log.columns, F.col("_v").isNotNull().alias("readable"), *part.values(), *lists)


def unreadable(events: DataFrame) -> DataFrame:
    """The dead letters: never skipped without notice, though their positions count as processed."""
    return events.where(~F.col("readable")).select("lsn", "payload")


def until(events: DataFrame, end_lsn: int) -> DataFrame:
    """Events up to the end position of the run; the first one beyond ends a session unprocessed."""
    return events.where(F.col("lsn") <= end_lsn)


def route(events: DataFrame, streams: DataFrame) -> DataFrame:
    """Events of the session's streams; an action that isn't known fails, but only on those.

    ``streams`` has schema, table and what belongs to a stream; a session's streams are few, and Spark
    broadcasts them by their measured size.
    """
    routed = events.where("readable").join(streams, ["schema", "table"])
    known = F.col("action").isin(*ACTIONS)
    checked = F.when(known, F.col("action")).otherwise(F.raise_error(F.concat(F.lit("unsupported action "), F.coalesce("action", F.lit("null")))).cast("string"))
    return routed.withColumn("action", checked)


def _value(entries: Column, name: str) -> Column:
    """The last value of a name among the entries."""
    return F.try_element_at(F.filter(entries, lambda e: e["name"] == name), F.lit(-1))["value"]


def entries() -> Column:
    """What a record is made from: the row's columns, or the identity of a deleted row."""
    return F.when(F.col("action") == "D", F.col("identity")).otherwise(F.col("columns"))


def assemble(events: DataFrame, stream: LogStream, extracted_at: str, debug_lsn: bool = False) -> DataFrame:
    """Typed rows of one stream's routed events, in columns of its selected names.

    ``_seq`` orders rows that share a position.  ``_present`` lists the names that the event carries: others are not null but absent.
    """
    if stream.version is None:
        raise ValueError(f"stream {stream.stream_id} has no version")
    rows = events.where((F.col("schema") == stream.schema) & (F.col("table") == stream.table)).withColumn("_entries", entries())
    values = [log_values.decode(_value(F.col("_entries"), n), stream.selected[n]).alias(n) for n in sorted(stream.selected)]
    extra = [F.when(F.col("action") == "D", F.lit(extracted_at)).alias(DELETED_AT)]
    if debug_lsn:
        extra.append(F.col("lsn").cast("string").alias(POSITION))
    present = F.transform(F.coalesce(F.col("_entries"), F.array().cast(ENTRIES)), lambda e: e["name"]).alias("_present")
    place = F.col("seq") if "seq" in events.columns else F.lit(0).cast("bigint")
    return rows.select(F.col("lsn").alias("_lsn"), place.alias("_seq"), F.col("action").alias("_action"), present, *values, *extra)


def drift(events: DataFrame, known: DataFrame) -> DataFrame:
    """Names that inserted or updated rows carry and their stream doesn't know.

    ``known`` has schema, table and ``names``, an array.
    """
    carried = events.where("readable and action in ('I', 'U')").select("schema", "table", F.transform("columns", lambda e: e["name"]).alias("carried"))
    new = carried.join(known, ["schema", "table"]).select("schema", "table", F.explode(F.array_except("carried", "names")).alias("name"))
    return new.distinct()


def counts(routed: DataFrame) -> DataFrame:
    """How many changes each stream has and its last position, a row for each stream."""
    return routed.groupBy("schema", "table").agg(F.count("*").alias("n"), F.max("lsn").alias("last"))


def committed(positions: DataFrame) -> DataFrame:
    """The smallest committed position of a session's streams; streams without one don't count."""
    return positions.agg(F.min("lsn").alias("committed_lsn"))


def first_flush(committed_lsn: int | None, first_lsn: int) -> int:
    """What is confirmed on the first message: never beyond what the consumer has."""
    return first_lsn if committed_lsn is None else min(committed_lsn, first_lsn)


def next_flush(committed_lsn: int | None, processed: int | None, flushed: int | None) -> int | None:
    """The position to confirm now, or None: the consumer's, if it isn't ahead of us and is news."""
    if committed_lsn is None or (processed is not None and committed_lsn > processed) or (flushed is not None and committed_lsn <= flushed):
        return None
    return committed_lsn


def final_position(complete: int | None, committed_lsn: int | None) -> int | None:
    """Where a session's streams stand at its end; None leaves them where they are."""
    if complete is None:
        return None
    return complete if committed_lsn is None else max(complete, committed_lsn)
