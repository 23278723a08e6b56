"""What a server's version allows, and which replication slot to use."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Oldest version; version lines with a known log bug, and where it is mended (fixed values).
OLDEST = 90400
FAULTY = ((90400, 90421), (90500, 90516), (90600, 90612), (100000, 100007), (110000, 110002))
#: From these on: the newer name of the position function, and the sender timeout.
NEW_POSITION_NAME, SENDER_TIMEOUT_FROM, SENDER_TIMEOUT_MS = 100000, 120000, 10_800_000


class ServerError(RuntimeError):
    """The server can't be used for log-based replication."""


def verdict(version: int) -> str:
    if version < OLDEST:
        return "unsupported"
    return "faulty" if any(a <= version < b for a, b in FAULTY) else "ok"


def require(version: int) -> None:
    if (found := verdict(version)) != "ok":
        raise ServerError(f"server version {version} is {found} for log-based replication")


def position_query(version: int) -> str:
    require(version)
    return "SELECT pg_current_wal_lsn()" if version >= NEW_POSITION_NAME else "SELECT pg_current_xlog_location()"


def sender_option(version: int) -> str | None:
    return f"-c wal_sender_timeout={SENDER_TIMEOUT_MS}" if version >= SENDER_TIMEOUT_FROM else None


def gated(spark: SparkSession, versions: DataFrame) -> DataFrame:
    """Rows (version) with their verdict, by a range join with the faulty lines."""
    lines = spark.createDataFrame(list(FAULTY), "low int, fixed int")
    hit = versions.join(F.broadcast(lines), (F.col("version") >= F.col("low")) & (F.col("version") < F.col("fixed")), "left")  # five rows
    return hit.select("version", F.when(F.col("version") < OLDEST, "unsupported").when(F.col("low").isNotNull(), "faulty").otherwise("ok").alias("verdict"))


def first_slot(candidates: Sequence[str], slots: Iterable[str]) -> str:
    """The first candidate that exists; a missing slot is made by an operator, never here."""
    there = frozenset(slots)
    for name in candidates:
        if name in there:
            return name
    raise ServerError(f"none of the replication slots {', '.join(candidates)} exists")


def slot_of(candidates: DataFrame, slots: DataFrame) -> DataFrame:
    """The first candidate, by its place, that exists."""
    return candidates.join(slots, "name", "left_semi").groupBy("dbname").agg(F.min_by("name", "place").alias("name"))
