"""Messages: records as JSON in a total order, and the parts of the other kinds."""

from __future__ import annotations

import copy
import json
from collections.abc import Iterator, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import ref


class _Exact(json.JSONEncoder):
    """Decimals are written with all their digits."""

    def iterencode(self, o: Any, _one_shot: bool = False) -> Iterator[str]:
        numbers: dict[str, str] = {}

        def swap(x: Any) -> Any:
            if isinstance(x, Decimal):
                mark = f"\u0001{len(numbers)}\u0001"
                numbers[json.dumps(mark)] = format(x, "f")
                return mark
            if isinstance(x, dict):
                return {k: swap(v) for k, v in x.items()}
            return [swap(v) for v in x] if isinstance(x, (list, tuple)) else x

        text = "".join(super().iterencode(swap(o), _one_shot))
        for mark, number in numbers.items():
            text = text.replace(mark, number, 1)
        yield text


def dumps(value: Any, **how: Any) -> str:
    return "".join(_Exact(ensure_ascii=False, **how).iterencode(value))


def record_json(columns: dict[str, Column], present: Column | None = None) -> Column:
    """A record's JSON with its columns in alphabetical order; nulls are written, absent names are not."""
    if present is None:
        return F.to_json(F.struct(*[columns[n].alias(n) for n in sorted(columns)]), {"ignoreNullFields": "false"})
    members = []
    for n in sorted(columns):
        text = F.to_json(F.struct(columns[n].alias(n)), {"ignoreNullFields": "false"})
        member = F.substring(text, 2, F.length(text) - 2)
        members.append(member if n.startswith("_sdc_") else F.when(F.array_contains(present, n), member))
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}"))


def record_messages(rows: DataFrame, stream: str, version: int, extracted_at: str, columns: dict[str, Column], order: Sequence[str], present: Column | None = None) -> DataFrame:
    """RECORD messages of rows that are sorted by ``order``, which stays beside them."""
    return rows.select(*[ref(o).alias(f"_order_{k}") for k, o in enumerate(order)], F.lit("RECORD").alias("type"), F.lit(stream).alias("stream"), F.lit(version).cast("bigint").alias("version"), F.lit(extracted_at).alias("time_extracted"), record_json(columns, present).alias("record"))


def record_line(row: Any) -> str:
    """The line of a collected RECORD row."""
    head = {"type": "RECORD", "stream": row["stream"]}
    tail = {"version": row["version"], "time_extracted": row["time_extracted"]}
    return dumps(head)[:-1] + ', "record": ' + row["record"] + ", " + dumps(tail)[1:]


def schema_message(stream: str, schema: dict[str, Any], keys: Sequence[str], bookmarks: Sequence[str]) -> dict[str, Any]:
    return {"type": "SCHEMA", "stream": stream, "schema": schema, "key_properties": list(keys), "bookmark_properties": list(bookmarks)}


def state_message(state: dict[str, Any]) -> dict[str, Any]:
    """The whole state as it is now."""
    return {"type": "STATE", "value": copy.deepcopy(state)}


def activate_message(stream: str, version: int) -> dict[str, Any]:
    return {"type": "ACTIVATE_VERSION", "stream": stream, "version": version}


def batch_message(stream: str, paths: Sequence[str], format: str = "arrow") -> dict[str, Any]:
    return {"type": "BATCH", "stream": stream, "encoding": {"format": format}, "manifest": list(paths)}
