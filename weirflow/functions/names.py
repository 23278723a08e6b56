"""Names: quoting, replication slots and the escapes of the change stream's table list."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Slots are named ``<prefix>_<dbname>[_<pipeline id>]``; operators create them by hand.
SLOT_PREFIX = "weirflow"


def quoted(name: Column) -> Column:
    """An identifier in double quotes, those within it doubled."""
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def qualified(schema: str, table: str) -> str:
    return f"{quote(schema)}.{quote(table)}"


def quote_spark(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """A column of a DataFrame by its exact name."""
    return F.col(quote_spark(name))


def slot_name(dbname: Column, pipeline: Column | None = None, prefix: str = SLOT_PREFIX) -> Column:
    """A slot's name; a null or empty pipeline id gives the plain form."""
    plain = F.concat_ws("_", F.lit(prefix), dbname)
    raw = plain if pipeline is None else F.when(F.coalesce(pipeline, F.lit("")) == "", plain).otherwise(F.concat_ws("_", plain, pipeline))
    return F.regexp_replace(F.lower(raw), "[^a-z0-9_]", "_")


def slot(dbname: str, pipeline: str | None = None, prefix: str = SLOT_PREFIX) -> str:
    return re.sub("[^a-z0-9_]", "_", "_".join(x for x in (prefix, dbname, pipeline) if x).lower())


def slot_candidates(dbname: str, pipeline: str | None = None, prefixes: tuple[str, ...] = (SLOT_PREFIX,)) -> list[str]:
    """Names in the order they are looked for: for each prefix without the pipeline id, then with it."""
    return [slot(dbname, p, prefix) for prefix in prefixes for p in ([None, pipeline] if pipeline else [None])]


_SPECIAL = r"([\\ ',.*])"


def escaped(name: Column) -> Column:
    """A name in the change stream's table list: special characters take a backslash."""
    return F.regexp_replace(name, _SPECIAL, r"\\$1")


def escape(name: str) -> str:
    return re.sub(_SPECIAL, r"\\\1", name)


def table_list(tables: list[tuple[str, str]]) -> str:
    return ",".join(f"{escape(s)}.{escape(t)}" for s, t in tables)


def read_table_list(text: str) -> frozenset[tuple[str, str]]:
    """The schemas and tables of a ``table_list``; an escaped character is the character itself."""
    parts = [re.sub(r"\\(.)", r"\1", p) for p in re.findall(r"(?:[^\\.,]|\\.)*", text) if p]
    return frozenset(zip(parts[::2], parts[1::2]))
