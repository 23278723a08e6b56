"""Conversion of column values to what records hold, chosen by type when the plan is made."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import temporal, types


class ConversionError(TypeError):
    """A column's type has no conversion."""


def finite(c: Column) -> Column:
    """A float that isn't NaN or infinite, else null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def not_nan(text: Column) -> Column:
    """A numeric's text, null for NaN in any case; infinities pass."""
    return F.when(F.lower(F.trim(text)) != "nan", text)


def bit(text: Column) -> Column:
    return text == "1"


def parsed(text: Column) -> Column:
    """JSON text as a variant; text that isn't JSON fails."""
    return F.parse_json(text)


def elements(array: Column, convert: Callable[[Column], Column]) -> Column:
    return F.transform(array, lambda x: convert(x))


def snapshot_value(c: Column, datatype: str, stored: str | None = None) -> Column:
    """A value of a snapshot as records hold it; ``stored`` is the Spark type it arrives in, where that matters."""
    element, is_array = types.split_array(datatype)
    if is_array:
        inner = stored[len("array<") : -1] if stored and stored.startswith("array<") else None
        return elements(c, lambda x: snapshot_value(x, element, inner))
    kind = element.split("(")[0].strip()
    if kind in types.TIMESTAMPS:
        return temporal.iso_timestamp(c)
    if kind == "date":
        return temporal.iso_date(c)
    if kind == "time without time zone":
        return temporal.plain_time(c)
    if kind == "time with time zone":
        return temporal.utc_time(c)
    if kind == "bit":
        return c if stored == "boolean" else bit(c)
    if kind in types.FLOATS:
        return finite(c)
    if kind in types.NUMERICS:
        return not_nan(c) if stored in (None, "string") else c
    if kind in types.JSON:
        return parsed(c) if stored == "string" else c
    if kind in types.INTEGERS or kind in types.STRINGS or kind in types.SIZED_STRINGS or kind in ("boolean", "hstore"):
        return c
    if stored in ("string", "boolean", "bigint", "int", "smallint"):
        return c  # enums and other types that arrive as plain values
    raise ConversionError(f"no conversion for a value of type {datatype}")
