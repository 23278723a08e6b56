from decimal import Decimal

import pytest
from pyspark.sql import types as T

from weirflow.functions import types
from weirflow.functions.types import ColumnInfo


def schema(kind, definitions=None, **more):
    return types.json_schema(ColumnInfo("c", kind, **more), {} if definitions is None else definitions)


@pytest.mark.parametrize("kind,bits", [("smallint", 16), ("integer", 32), ("bigint", 64)])
def test_integers_have_bounds(kind, bits):
    assert schema(kind) == {"type": ["null", "integer"], "minimum": -(2 ** (bits - 1)), "maximum": 2 ** (bits - 1) - 1}


def test_keys_are_not_nullable():
    assert schema("text", is_key=True) == {"type": ["string"]}


def test_numeric_bounds_are_exact():
    got = schema("numeric", precision=100, scale=38)
    assert got["multipleOf"] == Decimal(1).scaleb(-38) and got["exclusiveMaximum"] == Decimal(10) ** 62 and got["exclusiveMinimum"] == -(Decimal(10) ** 62)


def test_precision_is_capped(caplog):
    assert types.capped(None, None) == (100, 38)
    assert types.capped(120, 50) == (100, 38)
    assert "cut" in caplog.text
    assert types.capped(12, 3) == (12, 3)


@pytest.mark.parametrize("kind,more,expected", [
    ("bit", {"length": 1}, {"type": ["null", "boolean"]}), ("bit", {}, {"type": ["null", "boolean"]}), ("bit", {"length": 5}, {}),
    ("character varying", {"length": 33}, {"type": ["null", "string"], "maxLength": 33}), ("character varying", {}, {"type": ["null", "string"]}),
    ("jsonb", {}, {"type": ["null", "object", "array"]}), ("hstore", {}, {"type": ["null", "object"], "properties": {}}), ("date", {}, {"type": ["null", "string"], "format": "date-time"}),
    ("time with time zone", {}, {"type": ["null", "string"], "format": "time"}), ("mood", {"is_enum": True}, {"type": ["null", "string"]}), ("interval", {}, {}), ("bytea", {}, {}), ("real", {}, {"type": ["null", "number"]}),
])
def test_scalar_types(kind, more, expected):
    assert schema(kind, **more) == expected


@pytest.mark.parametrize("kind,family", [("integer", "integer"), ("real", "number"), ("bit", "boolean"), ("jsonb", "object"), ("hstore", "object"), ("date", "timestamp"), ("interval", "string"), ("uuid", "string")])
def test_arrays_refer_to_a_family(kind, family):
    assert schema(kind, is_array=True)["items"] == {"$ref": f"#/definitions/sdc_recursive_{family}_array"}


def test_numeric_arrays_add_a_definition():
    definitions = types.array_definitions()
    assert len(definitions) == 6
    got = schema("numeric", definitions, is_array=True, precision=12, scale=3)
    name = "sdc_recursive_decimal_12_3_array"
    assert got["items"]["$ref"].endswith(name) and definitions[name]["items"] == got["items"] and definitions[name]["multipleOf"] == Decimal("0.001")
    assert all(d["items"]["$ref"] == f"#/definitions/{n}" for n, d in definitions.items())


def test_published_names():
    assert ColumnInfo("c", "bit", length=5).datatype == "bit(5)"
    assert ColumnInfo("c", "integer", is_array=True).datatype == "integer[]"
    assert ColumnInfo("c", "numeric", precision=5, scale=2).datatype == "numeric"


def test_spark_types():
    assert types.spark_type(ColumnInfo("c", "numeric", precision=10, scale=2)) == T.DecimalType(10, 2)
    assert types.spark_type(ColumnInfo("c", "numeric")) == T.StringType()
    assert types.spark_type(ColumnInfo("c", "numeric", precision=50, scale=2)) == T.StringType()
    assert types.spark_type(ColumnInfo("c", "bytea")) is None
    assert types.spark_type(ColumnInfo("c", "bigint", is_array=True)) == T.ArrayType(T.LongType(), True)


@pytest.mark.parametrize("kind", [T.LongType(), T.DoubleType(), T.TimestampNTZType(), T.BooleanType(), T.StringType(), T.DecimalType(12, 3), T.ArrayType(T.IntegerType())])
def test_spark_types_come_back(kind):
    assert types.spark_type(types.of_spark("c", kind)) == kind


@pytest.mark.parametrize("name,safe", [("numeric(10, 2)[]", True), ('my."Type"', True), ("int; drop table t", False), ("text'", False), ("", False), ("1x", False)])
def test_datatypes_in_sql(name, safe):
    assert types.is_safe_datatype(name) is safe
