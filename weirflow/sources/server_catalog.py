"""Discovery from a server's own catalog tables: small reads over JDBC, joined and resolved by Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import catalog

#: What is read of each catalog table (fixed names of the server).  Only it knows which columns the user may read.
READS = {
    "classes": "select oid, relnamespace as namespace, relname as name, cast(relkind as varchar) as kind, cast(reltuples as bigint) as row_count from pg_catalog.pg_class",
    "namespaces": "select oid, nspname as schema_name from pg_catalog.pg_namespace",
    "attributes": "select attrelid as relation, attnum as number, attname as name, atttypid as type, atttypmod as mods from pg_catalog.pg_attribute where attnum > 0 and not attisdropped and has_column_privilege(attrelid, attnum, 'SELECT')",
    "kinds": "select oid, format_type(oid, null) as name, typbasetype as base, case when typcategory = 'A' then typelem else 0 end as element, cast(typtype as varchar) as category, typtypmod as mods from pg_catalog.pg_type",
    "keys": "select indrelid as relation, cast(indkey as varchar) as numbers from pg_catalog.pg_index where indisprimary",
}
CURRENT_ID = "select mod(txid_current(), 4294967296) as xid"

Read = Callable[[str], DataFrame]


def scan(read: Read) -> DataFrame:
    """The columns that the user may read, one row each; ``read`` gives the rows of a query."""
    parts = {name: read(sql) for name, sql in READS.items()}
    parts["keys"] = parts["keys"].withColumn("numbers", F.split("numbers", " ").cast("array<int>"))
    rows = catalog.resolved_types(**parts)
    return rows.select("schema_name", "table_name", "kind", "row_count", "column_name", "type", "is_array", "is_enum", *_sizes(F.col("type"), F.col("mods")), "is_key")


def _sizes(kind, mods):
    """Length, precision and scale as a type modifier has them; -1 says that none are declared."""
    text, bits = kind.isin("character varying", "character"), kind.isin("bit", "bit varying")
    length = F.when(mods < 0, None).when(text, mods - 4).when(bits, mods)
    declared = (kind == "numeric") & (mods >= 4)
    packed = mods - 4
    return [
        length.cast("int").alias("length"),
        F.when(declared, F.shiftright(packed, 16).bitwiseAND(F.lit(0xFFFF))).cast("int").alias("precision"),
        F.when(declared, packed.bitwiseAND(F.lit(0xFFFF))).cast("int").alias("scale"),
    ]
