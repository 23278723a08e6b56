"""Log positions: text and integer forms, and what follows from their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LOW = 0xFFFFFFFF


def to_int(text: Column) -> Column:
    """``file/offset`` in hexadecimal as one integer; null and the empty text give null."""
    parts = F.split(text, "/")
    high, low = (F.conv(parts.getItem(k), 16, 10).cast("decimal(20,0)").cast("bigint") for k in (0, 1))
    return F.when(text.isNotNull() & (text != ""), F.shiftleft(high, 32).bitwiseOR(low))


def to_text(position: Column) -> Column:
    """The upper-case ``file/offset`` form of an integer position."""
    return F.concat(F.hex(F.shiftrightunsigned(position, 32)), F.lit("/"), F.hex(position.bitwiseAND(F.lit(LOW))))


def parse(text: str | None) -> int | None:
    """As ``to_int``, on the driver."""
    if not text:
        return None
    high, _, low = text.partition("/")
    return int(high, 16) * (LOW + 1) + int(low, 16)


def show(position: int | None) -> str | None:
    return None if position is None else "%X/%X" % divmod(position, LOW + 1)


def fully_processed(changes: DataFrame, lsn: str = "lsn", span: int = 1 << 20) -> DataFrame:
    """Each distinct position with the one before it: what is complete once it has been seen.

    Several changes may share a position, so it is only complete when a higher one arrives.  The position
    before is looked up within a span of positions; the first of a span takes the last of the span before.
    """
    positions = changes.select(lsn).distinct().withColumn("_span", F.floor(F.col(lsn) / span))
    inner = F.lag(lsn).over(Window.partitionBy("_span").orderBy(lsn))
    tops = positions.groupBy("_span").agg(F.max(lsn).alias("_top"))
    last = tops.select("_span", F.lag("_top").over(Window.orderBy("_span")).alias("_last"))  # a row for each span
    found = positions.withColumn("_inner", inner).join(last, "_span")
    return found.select(lsn, F.coalesce("_inner", "_last").alias("fully_processed"))


def last_complete(changes: DataFrame, lsn: str = "lsn") -> DataFrame:
    """One row: the highest position (``last``) and the highest below it (``complete``), without a sort of all:
    each task keeps its two highest, and the highest two of those are taken.
    """
    top = changes.select(lsn).distinct().orderBy(F.desc(lsn)).limit(2)
    return top.agg(F.max(lsn).alias("last"), F.when(F.count("*") > 1, F.min(lsn)).alias("complete"))
