"""Full-table reads: typed projection, transaction order, resume, and the watermark that follows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import temporal, types
from ..functions.names import ref

#: The column of transaction ids that goes beside the projection and is dropped from records.
WATERMARK = "_watermark"
#: Rows between two saved positions of a full copy, and of an incremental read (fixed values).
FULL_EVERY, INCREMENTAL_EVERY = 1_000, 10_000
WRAP = 2**32


def select_expression(column: str, datatype: str | None) -> Column:
    """A column as it is read: scalar timestamps are clamped, scalar dates become timestamps."""
    c = ref(column)
    if datatype in types.TIMESTAMPS:
        return temporal.clamp(c).alias(column)
    if datatype == "date":
        return temporal.midnight(c).alias(column)
    return c.alias(column)


def project(df: DataFrame, datatypes: Mapping[str, str | None]) -> DataFrame:
    """The chosen columns in alphabetical order."""
    return df.select(*[select_expression(c, datatypes[c]) for c in sorted(datatypes)])


def age(xid: Column, current: int) -> Column:
    """How many transactions ago an id was given out; ids wrap around at 2**32."""
    return F.pmod(F.lit(current) - F.pmod(xid, F.lit(WRAP)), F.lit(WRAP))


def full_table(df: DataFrame, datatypes: Mapping[str, str | None], watermark: str | None = None, bookmark: int | None = None, current: int | None = None) -> DataFrame:
    """A table's snapshot in the text order of its transaction ids, from a bookmark's age on if one is given.

    Where the current id isn't known, ids are compared as they wrap: the half circle after the bookmark is newer.
    Without a watermark column (a view) rows come in no order.
    """
    if watermark is None:
        return project(df, datatypes)
    rows = df
    if bookmark is not None:
        if current is None:
            current = (int(bookmark) + WRAP // 2 - 1) % WRAP
        rows = rows.where(age(ref(watermark), current) <= age(F.lit(bookmark), current))
    columns = [select_expression(c, datatypes[c]) for c in sorted(datatypes)]
    return rows.select(ref(watermark).alias(WATERMARK), *columns).orderBy(F.col(WATERMARK).cast("string"))


def last_watermark(rows: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """The id that the last row in text order has: an aggregate, whatever order rows arrive in."""
    return rows.agg(F.max_by(F.col(watermark), F.col(watermark).cast("string")).alias("xmin"))


def after_key(df: DataFrame, keys: Sequence[str], last: Sequence | None) -> DataFrame:
    """Rows whose key tuple is above the last one copied, in key order: an exact resume where a key exists."""
    if last is not None:
        above = F.lit(False)
        equal = F.lit(True)
        for k, v in zip(keys, last, strict=True):
            above = above | (equal & (ref(k) > F.lit(v)))
            equal = equal & (ref(k) == F.lit(v))
        df = df.where(above)
    return df.orderBy(*[ref(k).asc() for k in keys])


def numbered(rows: DataFrame, order: Sequence[Column], bucket: Column, name: str = "seq") -> DataFrame:
    """Rows with their place from 1 in a total order, without moving all of them to one task.

    ``bucket`` never falls along the order.  Rows are ranked within their bucket, and the sizes of the
    buckets before it, one number each, are added.  As it depends on values alone, a task that runs again
    gives the same places.
    """
    marked = rows.withColumn("_bucket", bucket)
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    sizes = marked.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.col("_bucket").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row for each bucket
    joined = marked.withColumn("_local", local).join(offsets, F.col("_bucket").eqNullSafe(F.col("_of")))
    return joined.withColumn(name, (F.col("_before") + F.col("_local")).cast("bigint")).drop("_bucket", "_of", "_local", "_before")


def cadence(numbered_rows: DataFrame, every: int, seq: str = "seq") -> DataFrame:
    """The rows after which a position is saved."""
    return numbered_rows.where(F.col(seq) % every == 0)
