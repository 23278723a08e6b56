"""What a consumer makes of the output: the latest state by key, and the active version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import ref


def latest_state(rows: DataFrame, keys: Sequence[str], position: str, deleted: str, ties: Sequence[str] = ()) -> DataFrame:
    """The last row of every key by position, without keys whose last row is a delete.

    One row for each key leaves a task: the maximum is aggregated before rows move, so a key with a large
    share of the changes costs one row a task.
    """
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(ref(position), *[ref(t) for t in ties])
    last = rows.groupBy(*[ref(k) for k in keys]).agg(F.max_by(F.struct(*[ref(c) for c in rest]), order).alias("_last"))
    out = last.select(*[ref(k) for k in keys], *[F.col("_last")[c].alias(c) for c in rest])
    return out.where(ref(deleted).isNull()).select(*[ref(c) for c in rows.columns])


def active(rows: DataFrame, stream: str = "stream", version: str = "version") -> DataFrame:
    """Rows of each stream's highest version: what is left once that version is activated."""
    top = rows.groupBy(ref(stream)).agg(F.max(ref(version)).alias(version))
    return rows.join(top, [stream, version])


def merged(snapshot: DataFrame, log: DataFrame, keys: Sequence[str], snapshot_lsn: int, position: str = "_lsn", deleted: str = "_sdc_deleted_at") -> DataFrame:
    """A snapshot overlaid with its change log; overlap is settled by position."""
    base = snapshot.withColumn(position, F.lit(snapshot_lsn).cast("bigint"))
    return latest_state(base.unionByName(log, allowMissingColumns=True), keys, position, deleted)
