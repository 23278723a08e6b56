"""Where a stream's rows come from: a Parquet path, a table or view of the session, or a JDBC relation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.names import quote_spark, ref
from ..functions.types import is_safe_datatype
from ..plans.catalog import Relation, column_scan
from . import jdbc, server_catalog


class Source(Protocol):
    """Gives the columns of a database's relations, and each one's rows."""

    def scan(self) -> DataFrame: ...

    def rows(self, schema: str, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class Fact:
    """What a file can't say of its relation: key, transaction-id column, whether it is a view."""

    keys: tuple[str, ...] = ()
    watermark: str | None = None
    is_view: bool = False


@dataclass
class ParquetSource:
    """Tables that lie as ``<root>/<name>.parquet``, all in one schema."""

    spark: SparkSession
    root: str
    names: tuple[str, ...]
    schema: str = "public"
    facts: Mapping[str, Fact] = field(default_factory=dict)
    #: Whether discovery counts rows: a scan without columns, which reads the files' footers.
    counted: bool = False

    def rows(self, schema: str, table: str) -> DataFrame:
        if schema != self.schema or table not in self.names:
            raise LookupError(f"{schema}.{table} is not there")
        return self.spark.read.parquet(f"{self.root}/{table}.parquet")

    def relations(self) -> list[Relation]:
        out = []
        for name in self.names:
            fact = self.facts.get(name, Fact())
            rows = self.rows(self.schema, name)
            out.append(Relation(self.schema, name, rows, fact.keys, "v" if fact.is_view else "r", rows.count() if self.counted else 0))
        return out

    def scan(self) -> DataFrame:
        return column_scan(self.spark, self.relations())

    def fact(self, table: str) -> Fact:
        return self.facts.get(table, Fact())


@dataclass
class SessionSource:
    """Tables and views that the session's catalog knows."""

    spark: SparkSession
    databases: tuple[str, ...] = ("default",)
    facts: Mapping[str, Fact] = field(default_factory=dict)

    def rows(self, schema: str, table: str) -> DataFrame:
        return self.spark.table(f"`{schema}`.`{table}`" if self.spark.catalog.tableExists(f"`{schema}`.`{table}`") else f"`{table}`")

    def relations(self) -> list[Relation]:
        out = []
        for database in self.databases:
            for t in self.spark.catalog.listTables(database):
                schema = t.namespace[-1] if t.namespace else database
                fact = self.facts.get(t.name, Fact())
                kind = "v" if t.tableType in ("VIEW", "TEMPORARY") or fact.is_view else "r"
                out.append(Relation(schema, t.name, self.rows(schema, t.name), fact.keys, kind))
        return out

    def scan(self) -> DataFrame:
        return column_scan(self.spark, self.relations())

    def fact(self, table: str) -> Fact:
        return self.facts.get(table, Fact())


@dataclass(frozen=True)
class Split:
    """A numeric or date column by whose values a relation is read in ``parts`` parallel ranges."""

    column: str
    parts: int


@dataclass
class JdbcSource:
    """Relations of a server: those that are named, with columns as the driver types them, or, where no name is
    given, all that its catalog has.

    ``splits`` has the tables that are read in parallel; a table without one is read by one task.  ``types`` has
    for a table the Spark types of columns that the driver would give another.
    """

    spark: SparkSession
    settings: Settings
    names: tuple[tuple[str, str], ...]
    facts: Mapping[str, Fact] = field(default_factory=dict)
    dbname: str | None = None
    override: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split] = field(default_factory=dict)
    types: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def rows(self, schema: str, table: str) -> DataFrame:
        given = {**jdbc.options(self.settings, schema, table, dbname=self.dbname), **self.override}
        custom = self._types(table)
        whole = jdbc.read(self.spark, given, custom_schema=custom)
        split = self.splits.get(table)
        if split is None:
            return whole
        # the server answers with one row; Spark's first and last range are open, so no row is beyond the bounds
        low, high = whole.agg(F.min(ref(split.column)), F.max(ref(split.column))).first()
        if low is None or low == high:
            return whole
        return jdbc.read(self.spark, given, split.column, low, high, split.parts, custom)

    def scan(self) -> DataFrame:
        if self.names:
            return column_scan(self.spark, self.relations())
        return server_catalog.scan(self.query)

    def query(self, sql: str) -> DataFrame:
        """The rows of a query, which the server runs."""
        given = {**jdbc.options(self.settings, "", "", dbname=self.dbname), **self.override}
        given.pop("dbtable")
        return jdbc.read(self.spark, given | {"query": sql})

    def current_xid(self) -> int:
        """The server's transaction id, as rows hold it: without its epoch."""
        return int(jdbc.scalar(self.query(server_catalog.CURRENT_ID)))

    def _types(self, table: str) -> str | None:
        given = self.types.get(table, {})
        unsafe = [t for t in given.values() if not is_safe_datatype(t)]
        if unsafe:
            raise ValueError(f"not a type: {unsafe[0]!r}")
        return ", ".join(f"{quote_spark(c)} {t}" for c, t in given.items()) or None

    def relations(self) -> list[Relation]:
        return [Relation(s, t, self.rows(s, t), self.fact(t).keys, "v" if self.fact(t).is_view else "r") for s, t in self.names]

    def fact(self, table: str) -> Fact:
        return self.facts.get(table, Fact())
