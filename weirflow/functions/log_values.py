"""Decoding of change-event values, chosen by type when the plan is made.

A payload's values are variants: a number keeps its digits up to 38, a text stays a text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import convert, literals, temporal, types



def text_of(value: Column) -> Column:
    """The value as text, whatever JSON kind it has."""
    return F.try_variant_get(value, "$", "string")


def decode(value: Column, datatype: str) -> Column:
    """One value by its column's type; null stays null.  Arrays come as variants.

    An object or a list where the type has none fails.
    """
    element, is_array = types.split_array(datatype)
    if is_array:
        return _array(value, element)
    text = text_of(value)
    kind = element.split("(")[0].strip()
    if kind in types.TIMESTAMPS:
        return temporal.log_timestamp(text)
    if kind == "date":
        return temporal.log_date(text)
    if kind == "time with time zone":
        return temporal.utc_time(text)
    if kind == "time without time zone":
        return temporal.plain_time(text)
    if kind == "bit":
        return F.when(text.isNotNull(), F.lower(text).isin("1", "true"))
    if kind == "boolean":
        return F.when(text.isNotNull(), F.lower(text).isin("t", "true", "1"))
    if kind in types.NUMERICS:
        return numeric(text, element)
    if kind in types.INTEGERS:
        return text.cast({16: "smallint", 32: "int", 64: "bigint"}[types.INTEGERS[kind]])
    if kind in types.FLOATS:
        return convert.finite(text.cast("double"))
    if kind in types.JSON:
        return F.when(F.schema_of_variant(value) == "STRING", F.parse_json(text)).otherwise(value)
    if kind == "hstore":
        return F.when(_is(value, "OBJECT"), F.try_variant_get(value, "$", "map<string,string>")).otherwise(literals.hstore(text))
    failed = F.raise_error(F.concat(F.lit(f"can't read this value of type {datatype}: "), text)).cast("string")
    return F.when(_is(value, "OBJECT") | _is(value, "ARRAY"), failed).otherwise(text)


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _array(value: Column, element: str) -> Column:
    """A list, or the literal of one, with its items read by their type; below two dimensions they stay as they are.

    Literals of one dimension are read by DataFrame functions; only others go to Python.
    """
    text = F.when(~_is(value, "ARRAY"), text_of(value))
    flat = literals.is_flat(text)
    plain = F.to_json(literals.flat_array(F.when(flat, text)), {"ignoreNullFields": "false"})
    read = F.parse_json(F.coalesce(plain, literals.array_json(F.when(~flat, text), element)))
    whole = F.when(_is(value, "ARRAY"), value).otherwise(read)
    rows = F.try_variant_get(whole, "$", "array<variant>")
    nested = F.exists(rows, lambda x: _is(x, "ARRAY"))
    deep = F.exists(rows, lambda x: F.exists(F.try_variant_get(x, "$", "array<variant>"), lambda y: _is(y, "ARRAY")))
    one = F.transform(F.when(~nested, rows), lambda x: decode(x, element))
    two = F.transform(F.when(nested & ~deep, rows), lambda x: F.transform(F.try_variant_get(x, "$", "array<variant>"), lambda y: decode(y, element)))
    return F.coalesce(F.to_variant_object(one), F.to_variant_object(two), whole)


def numeric(text: Column, element: str = "numeric") -> Column:
    """A decimal where its precision is declared and fits, else exact text; NaN is null, other text fails."""
    clean = convert.not_nan(text)
    declared = element[element.find("(") + 1 : -1] if element.endswith(")") else ""
    if declared:
        precision, scale = [int(x) for x in (declared + ",0").split(",")[:2]]
        if precision <= types.SPARK_PRECISION:
            return clean.cast(f"decimal({precision},{scale})")
    number = clean.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$") | F.lower(F.trim(clean)).rlike("^[+-]?inf(inity)?$")
    failed = F.raise_error(F.concat(F.lit("can't read the numeric "), clean)).cast("string")
    return F.when(clean.isNull(), clean).when(number, clean).otherwise(failed)
