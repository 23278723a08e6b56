"""Array and key-value literals of change events, read on the executors without asking a server."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import ship


def _finite(text: str) -> float | None:
    number = float(text)
    return number if math.isfinite(number) else None


#: Elements that keep a type of their own; all others are read as text (fixed values).
NATIVE = {"smallint": int, "integer": int, "real": _finite, "double precision": _finite, "boolean": lambda x: x.lower() in ("t", "true", "1")}


class LiteralError(ValueError):
    """A literal that can't be read."""


def _tokens(text: str) -> Iterator[tuple[str, str | None]]:
    """Braces, commas and items; an unquoted NULL is an item of value None."""
    at, n = 0, len(text)
    while at < n:
        c = text[at]
        if c in "{},":
            yield c, None
            at += 1
        elif c.isspace():
            at += 1
        elif c == '"':
            out, at = [], at + 1
            while at < n and text[at] != '"':
                at += text[at] == "\\"
                out.append(text[at : at + 1])
                at += 1
            if at >= n:
                raise LiteralError(f"a quote isn't closed: {text!r}")
            at += 1
            yield "item", "".join(out)
        else:
            start, raw = at, []
            while at < n and text[at] not in "{},":
                at += text[at] == "\\"
                raw.append(text[at : at + 1])
                at += 1
            word = "".join(raw).rstrip()
            yield "item", None if word.upper() == "NULL" and "\\" not in text[start:at] else word


def read_array(text: str, element: str = "text") -> list:
    """A nested list of an array literal of any depth; a bounds prefix such as [0:1]= is passed over."""
    body = text.strip()
    if body.startswith("["):
        body = body[body.index("=") + 1 :].lstrip()
    make = NATIVE.get(element, str)
    root: list = []
    stack = [root]
    for kind, value in _tokens(body):
        if kind == "{":
            new: list = []
            stack[-1].append(new)
            stack.append(new)
        elif kind == "}":
            stack.pop()
            if not stack:
                raise LiteralError(f"braces don't match: {text!r}")
        elif kind == "item":
            if len(stack) == 1:
                raise LiteralError(f"not an array literal: {text!r}")
            stack[-1].append(None if value is None else make(value))
    if len(stack) != 1 or len(root) != 1:
        raise LiteralError(f"not an array literal: {text!r}")
    return root[0]


def array_json(literals: Column, element: str) -> Column:
    """The JSON of array literals of any depth, in batches; numbers of numeric elements keep their digits."""
    kind = element.split("(")[0]
    ship()

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps(read_array(t, kind), ensure_ascii=False))

    return run(literals)


def is_flat(literal: Column) -> Column:
    """Whether ``flat_array`` can read a literal: one dimension, and outside of quotes no escape and no space at a border."""
    bare = F.regexp_replace(literal, r'"(?:[^"\\]|\\.)*"', "")
    return bare.rlike(r'^(?:\[[^=]*\]=)?\{[^{}"\\]*\}$') & ~bare.rlike(r"[{,]\s|\s[,}]")


def flat_array(literal: Column) -> Column:
    """The items of a one-dimensional literal as text, in DataFrame functions only."""
    item = r'"((?:[^"\\]|\\.)*)"|([^,{}"]+)'
    inner = F.regexp_replace(literal, r"^\s*(?:\[[^=]*\]=)?\{|\}\s*$", "")
    raw = F.regexp_extract_all(inner, F.lit(item), F.lit(0))
    return F.transform(raw, _item)


def _item(raw: Column) -> Column:
    quoted = raw.startswith('"')
    plain = F.regexp_replace(F.when(quoted, F.substring(raw, 2, F.length(raw) - 2)).otherwise(F.trim(raw)), r"\\(.)", "$1")
    return F.when(~quoted & (F.upper(F.trim(raw)) == "NULL"), F.lit(None).cast("string")).otherwise(plain)


_PAIR = r'"((?:[^"\\]|\\.)*)"\s*=>\s*(NULL|"(?:[^"\\]|\\.)*")|([^\s,"=>]+)\s*=>\s*(NULL|"(?:[^"\\]|\\.)*"|[^\s,"]+)'


def hstore(literal: Column) -> Column:
    """A map of a key-value literal; null values stay, and the last of equal keys wins."""
    pairs = F.regexp_extract_all(literal, F.lit(f"(?i){_PAIR}"), F.lit(0))

    def unquoted(x: Column) -> Column:
        inner = F.when(x.startswith('"'), F.substring(x, 2, F.length(x) - 2)).otherwise(x)
        return F.regexp_replace(inner, r"\\(.)", "$1")

    def entry(pair: Column) -> Column:
        key = F.regexp_extract(pair, r'^("(?:[^"\\]|\\.)*"|[^\s,"=>]+)\s*=>', 1)
        value = F.regexp_extract(pair, r'=>\s*((?:"(?:[^"\\]|\\.)*")|[^\s,"]+)$', 1)
        return F.struct(unquoted(key).alias("key"), F.when(F.upper(value) == "NULL", F.lit(None).cast("string")).otherwise(unquoted(value)).alias("value"))

    entries = F.transform(pairs, entry)
    # of equal keys only the last stays
    last = F.filter(F.transform(entries, lambda e, i: F.struct(e.alias("e"), i.alias("i"))), lambda x: ~F.exists(F.slice(entries, x["i"] + 2, F.size(entries)), lambda y: y["key"] == x["e"]["key"]))
    return F.map_from_entries(F.transform(last, lambda x: x["e"]))
