import json
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weirflow.functions import convert, literals, log_values, lsn, names, temporal

TOP = temporal.TOP_TIMESTAMP


def test_times(values):
    assert values(temporal.plain_time, "24:00:00", "10:24:24.5", "00:00:01", None) == ["00:00:00", "10:24:24", "00:00:01", None]
    assert values(temporal.utc_time, "12:00:00+02", "01:00:00.5+02:30", "23:30:00-01", "24:00:00+00", "10:00:00", "10:00:00Z", None) == ["10:00:00", "22:30:00", "00:30:00", "00:00:00", "10:00:00", "10:00:00", None]
    for read, text in ((temporal.plain_time, "garbage"), (temporal.plain_time, "25:00:00"), (temporal.utc_time, "25:61:99+02"), (temporal.utc_time, "garbage")):
        with pytest.raises(Exception, match="can't read the time"):
            values(read, text)


@pytest.mark.parametrize("given,expected", [
    ("2020-01-01 10:00:00", "2020-01-01T10:00:00+00:00"), ("2020-01-01 10:00:00.123456", "2020-01-01T10:00:00.123456+00:00"), ("2020-01-01T10:00:00.1+00", "2020-01-01T10:00:00.100000+00:00"),
    ("2020-01-01 10:00:00+05:30", "2020-01-01T10:00:00+05:30"), ("2020-01-01 10:00:00-08", "2020-01-01T10:00:00-08:00"), ("0001-01-01 00:00:00", "0001-01-01T00:00:00+00:00"), ("9999-12-31 23:59:59.999", "9999-12-31T23:59:59.999000+00:00"),
    ("9999-12-31 23:59:59.999001", TOP), ("10000-01-01 00:00:00", TOP), ("9999-12-31 23:59:59-01", TOP), ("0001-01-01 00:00:00+01", TOP), ("0044-03-15 10:00:00 BC", TOP), ("infinity", TOP), ("-infinity", TOP), ("", TOP), ("2020-13-01 00:00:00", TOP),
])
def test_log_timestamps(values, given, expected):
    assert values(temporal.log_timestamp, given) == [expected]


def test_log_dates(values):
    assert values(temporal.log_date, "2020-02-29", "10000-01-01", None) == ["2020-02-29T00:00:00+00:00", temporal.TOP_DATE, None]
    for bad in ("infinity", "2020-02-30", "0044-03-15 BC"):
        with pytest.raises(PySparkException):
            values(temporal.log_date, bad)


def test_clamp_goes_up_on_both_sides(spark):
    got = spark.sql("select timestampadd(YEAR, n, timestamp_ntz'2020-01-01 00:00:00') t from values (-2500), (0), (9000) v(n)").select(temporal.iso_timestamp(temporal.clamp(F.col("t"))))
    assert [r[0] for r in got.collect()] == ["9999-12-31T23:59:59.999000+00:00", "2020-01-01T00:00:00+00:00", "9999-12-31T23:59:59.999000+00:00"]


def test_floats_and_numerics(values):
    assert values(convert.finite, float("nan"), float("inf"), float("-inf"), 1.5, None, kind="double") == [None, None, None, 1.5, None]
    assert values(convert.not_nan, "NaN", "1.50", "Infinity", None) == [None, "1.50", "Infinity", None]


def test_snapshot_values(values, spark):
    assert values(lambda c: convert.snapshot_value(c, "bit", "string"), "1", "0", None) == [True, False, None]
    assert values(lambda c: convert.snapshot_value(c, "double precision[]", "array<double>"), [1.0, float("nan"), None], None, kind="array<double>") == [[1.0, None, None], None]
    assert values(lambda c: convert.snapshot_value(c, "numeric(10,2)", "decimal(10,2)").cast("string"), Decimal("1.50"), kind="decimal(10,2)") == ["1.50"]
    with pytest.raises(convert.ConversionError):
        convert.snapshot_value(F.lit(1), "interval", "interval")


def test_json_is_parsed_once(values):
    assert values(lambda c: F.to_json(convert.snapshot_value(c, "jsonb", "string")), '{"a": [1, {"b": null}]}', "{}", None) == ['{"a":[1,{"b":null}]}', "{}", None]
    with pytest.raises((PySparkException, Py4JJavaError)):
        values(lambda c: convert.snapshot_value(c, "json", "string").cast("string"), "{oops")


@pytest.mark.parametrize("text,element,expected", [
    ("{1,2,3}", "integer", [1, 2, 3]), ("{{1,2},{3,NULL}}", "integer", [[1, 2], [3, None]]), ("{{{1}},{{2}}}", "integer", [[[1]], [[2]]]), ("{}", "text", []), ('{"a,b","c\\"d",NULL,"NULL",\\N}', "text", ["a,b", 'c"d', None, "NULL", "N"]),
    ("[0:1]={t,f}", "boolean", [True, False]), ("{1.5,2.5}", "double precision", [1.5, 2.5]), ('{ a b , "" }', "text", ["a b", ""]), ("{1.10}", "numeric", ["1.10"]),
])
def test_array_literals(text, element, expected):
    assert literals.read_array(text, element) == expected


@pytest.mark.parametrize("text", ["1,2", "{1", '{"a}', "{1}}"])
def test_broken_array_literals(text):
    with pytest.raises(literals.LiteralError):
        literals.read_array(text)


def test_flat_arrays_and_batches(values):
    assert values(literals.flat_array, '{a,"b,c",NULL,"x\\"y"}', "{}", None) == [["a", "b,c", None, 'x"y'], [], None]
    assert [json.loads(x) for x in values(lambda c: literals.array_json(c, "integer"), "{{1},{2}}")] == [[[1], [2]]]


def test_hstore(values):
    got = values(literals.hstore, 'k1=>v1,k2=>NULL', '"a b"=>"c\\"d, e=>f", x=>"NULL"', "", 'k=>1, k=>2', None)
    assert got == [{"k1": "v1", "k2": None}, {"a b": 'c"d, e=>f', "x": "NULL"}, {}, {"k": "2"}, None]


@pytest.mark.parametrize("payload,datatype,expected", [
    ('"t"', "boolean", True), ("true", "boolean", True), ('"no"', "boolean", False), ('"1"', "bit", True), ("12", "integer", 12), ('"12"', "bigint", 12), ('"NaN"', "real", None), ('"2.5"', "double precision", 2.5),
    ("1234567890.123456789012345678", "numeric(38,18)", Decimal("1234567890.123456789012345678")), ('"1e5"', "numeric", "1e5"), ('"NaN"', "numeric", None), ('"$1,000.50"', "money", "$1,000.50"), ("null", "text", None), ('"24:00:00"', "time without time zone", "00:00:00"),
])
def test_log_values(values, payload, datatype, expected):
    assert values(lambda c: log_values.decode(F.parse_json(c), datatype), payload) == [expected]


def test_log_json_and_arrays(values):
    show = lambda kind: lambda c: F.to_json(log_values.decode(F.parse_json(c), kind))
    assert values(show("jsonb"), '"{\\"a\\": 1}"', '{"a": 1}') == ['{"a":1}', '{"a":1}']
    assert values(show("integer[]"), '"{{1,2},{3,4}}"') == ["[[1,2],[3,4]]"]
    with pytest.raises(PySparkException):
        values(lambda c: log_values.decode(F.parse_json(c), "numeric"), '"twelve"')
    for payload, kind in (('{"a": 1}', "text"), ("[1]", "uuid"), ('"{1"', "text[]"), ('"{\\"a}"', "text[]"), ('"{x}"', "time without time zone[]")):
        with pytest.raises(PySparkException):
            values(lambda c, kind=kind: log_values.decode(F.parse_json(c), kind), payload)
    assert values(lambda c: log_values.decode(F.parse_json(c), "hstore"), '{"a": "1", "b": null}', '"c=>2"') == [{"a": "1", "b": None}, {"c": "2"}]


@pytest.mark.parametrize("payload,kind,expected", [
    ('"{9007199254740993,NULL}"', "bigint[]", "[9007199254740993,null]"), ('"{2024-01-31 12:30:45+02,infinity}"', "timestamp with time zone[]", '["2024-01-31T12:30:45+02:00","9999-12-31T23:59:59.999+00:00"]'),
    ('"{2024-01-31,10000-01-01}"', "date[]", None), ('"{1.50,NaN}"', "numeric(10,2)[]", "[1.5,null]"), ('"{t,f}"', "boolean[]", "[true,false]"), ('"{}"', "text[]", "[]"), ("null", "text[]", None),
    ('"{1.5,NaN,Infinity}"', "real[]", "[1.5,null,null]"), ('"{{1.5},{NaN}}"', "real[]", "[[1.5],[null]]"), ('"{{{1}},{{2}}}"', "integer[]", "[[[1]],[[2]]]"), ('["a", null, "b"]', "text[]", '["a",null,"b"]'), ('[[1, 2], [3, 4]]', "bigint[]", "[[1,2],[3,4]]"),
    ('"{a, \\"b,c\\", \\\\N}"', "text[]", '["a","b,c","N"]'), ('"{\\"{\\\\\\"k\\\\\\": 1}\\"}"', "jsonb[]", '[{"k":1}]'), ('"[0:1]={24:00:00,01:02:03.5}"', "time without time zone[]", '["00:00:00","01:02:03"]'),
])
def test_items_of_arrays(values, payload, kind, expected):
    """Items are read as values of their type, whether a literal or a list holds them."""
    got = values(lambda c: F.to_json(log_values.decode(F.parse_json(c), kind)), payload)[0]
    if kind == "date[]":
        assert json.loads(got)[0] == "2024-01-31T00:00:00+00:00" and json.loads(got)[1].startswith("9999-12-31")
    else:
        assert got == expected or json.loads(got) == json.loads(expected)


def test_flat_literals_agree_with_the_reader(values):
    texts = ["{}", "{a}", '{"a b",c d,NULL,"NULL",null}', '{"x\\y","","{}"}', "[2:3]={p,q}", r'{"a,b","c\"d"}']
    assert values(literals.is_flat, *texts, "{{a}}", "{ a}", r"{a\,b}", "{a", None) == [True] * len(texts) + [False] * 4 + [None]
    assert values(literals.flat_array, *texts) == [literals.read_array(t) for t in texts]


@pytest.mark.parametrize("text,number", [("16/B374D848", 97500059720), ("0/0", 0), ("FFFFFFF/FFFFFFFF", (0xFFFFFFF << 32) + 0xFFFFFFFF), (None, None), ("", None)])
def test_positions(values, text, number):
    assert lsn.parse(text) == number and values(lsn.to_int, text) == [number]
    if text:
        assert lsn.show(number) == text and values(lsn.to_text, number, kind="long") == [text]


def test_names(values):
    assert names.quote('a"b') == '"a""b"' and values(names.quoted, 'a"b') == ['"a""b"']
    assert names.qualified("s x", 't"y') == '"s x"."t""y"'
    assert names.slot("My-DB", "Tap 1") == "weirflow_my_db_tap_1" and names.slot("db") == "weirflow_db" and names.slot("db", "") == "weirflow_db"
    assert names.slot_candidates("db", "x", ("a", "b")) == ["a_db", "a_db_x", "b_db", "b_db_x"]
    assert names.table_list([("pub lic", "a.b"), ("s", "c'd,*")]) == r"pub\ lic.a\.b,s.c\'d\,\*"
    assert values(names.escaped, "a b.c\\") == [r"a\ b\.c" + "\\\\"]


def test_a_copy_resumes_beyond_the_wrap_of_ids(spark):
    from weirflow.operators import snapshot

    df = spark.createDataFrame([(4294967000, "a"), (4294967200, "b"), (100, "c"), (900, "d")], "xid long, v string")
    kept = lambda **k: [r["v"] for r in snapshot.full_table(df, {"v": "text"}, "xid", 4294967100, **k).collect()]
    assert sorted(kept()) == sorted(kept(current=1000)) == ["b", "c", "d"]
