import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weirflow.config import ConfigError, Settings, flag, schema_list
from weirflow.functions.types import ColumnInfo
from weirflow.operators import changelog, messages
from weirflow.plans import catalog, servers
from weirflow.plans.catalog import CatalogError, Relation, Stream
from weirflow.plans.state import State, StateError, resolve_method
from weirflow.sources import jdbc, server_catalog
from weirflow.sources.relations import JdbcSource, Split

CONFIG = {"host": "h", "port": 5432, "user": "u@x", "password": "p/w", "dbname": "d b"}


def test_settings():
    s = Settings.of(CONFIG | {"filter_schemas": "a, b ,c", "itersize": 0, "ssl": "true", "break_at_end_lsn": "false", "batch_config": {}})
    assert s.schemas == ("a", "b", "c") and s.fetch_rows == 20000 and s.ssl and not s.break_at_end and s.batch.rows == 500000
    assert Settings.of(CONFIG).break_at_end and Settings.of(CONFIG).batch is None
    assert flag("TRUE") and not flag("yes") and flag(1) and flag(None, True) and schema_list(" , ") is None


@pytest.mark.parametrize("change", [{"host": None}, {"default_replication_method": "SOME"}, {"use_secondary": True}, {"batch_config": {"batch_size": 0}}, {"batch_config": {"encoding": {"format": "csv"}}}, {"batch_config": {"storage": {"root": "/no/such"}}}])
def test_bad_settings(change):
    with pytest.raises(ConfigError):
        Settings.of(CONFIG | change)


def test_endpoints():
    s = Settings.of(CONFIG | {"use_secondary": True, "secondary_host": "r", "secondary_port": 1, "ssl": True})
    assert jdbc.endpoint(s) == ("r", 1) and jdbc.endpoint(s, primary=True) == ("h", 5432)
    assert jdbc.uri(s) == "postgresql://u%40x:p%2Fw@r:1/d%20b?application_name=weirflow&connect_timeout=30&sslmode=require"
    given = jdbc.options(s, "sch", 'ta"b', primary=True)
    assert given["dbtable"] == '"sch"."ta""b"' and given["url"] == "jdbc:postgresql://h:5432/d%20b" and given["fetchsize"] == "20000" and given["sslmode"] == "require"
    assert jdbc.parameters(s, options="-c x=1")["options"] == "-c x=1"


def test_jdbc_read_is_pushed_and_split(spark):
    url = "jdbc:derby:memory:weir;create=true"
    rows = spark.range(1000).selectExpr("cast(id as int) id", "cast(id as string) name")
    rows.write.format("jdbc").option("url", url).option("dbtable", "numbers").option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").mode("overwrite").save()
    df = jdbc.read(spark, {"url": url, "dbtable": "numbers", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, "id", 0, 1000, 3)
    assert df.rdd.getNumPartitions() == 3
    assert df.where("id >= 990").select("id").count() == 10
    assert jdbc.scalar(df.where("id = 7").select("name")) == "7"
    with pytest.raises(LookupError):
        jdbc.scalar(df.where("id < 0"))


def test_jdbc_source_splits_and_types(spark):
    driver, url = "org.apache.derby.iapi.jdbc.AutoloadedDriver", "jdbc:derby:memory:split;create=true"
    spark.range(500).selectExpr("cast(id as int) id", "cast(id as string) name").write.format("jdbc").options(url=url, dbtable="spread", driver=driver).mode("overwrite").save()
    given = {"url": url, "dbtable": "spread", "driver": driver, "user": "APP", "password": "app"}
    source = JdbcSource(spark, Settings.of(CONFIG), (("APP", "spread"),), override=given, splits={"spread": Split("id", 4)}, types={"spread": {"id": "bigint"}})
    rows = source.rows("APP", "spread")
    assert rows.rdd.getNumPartitions() == 4 and dict(rows.dtypes)["id"] == "bigint"
    assert rows.agg(F.count("*"), F.sum("id")).first()[:] == (500, 499 * 250)
    source.types = {"spread": {"id": "int; drop table t"}}
    with pytest.raises(ValueError):
        source.rows("APP", "spread")


def test_discovery_from_the_catalog_of_a_server(spark):
    """Sizes of columns and of domains, arrays, enums, keys, system schemas; a table without statistics."""
    frames = {
        "pg_class": spark.createDataFrame([(100, 1, "t", "r", -1), (101, 1, "v", "v", 0), (102, 2, "pg_class", "r", 9), (103, 1, "i", "i", 3)], "oid long, namespace long, name string, kind string, row_count long"),
        "pg_namespace": spark.createDataFrame([(1, "public"), (2, "pg_catalog")], "oid long, schema_name string"),
        "pg_attribute": spark.createDataFrame([(100, 1, "id", 23, -1), (100, 2, "price", 1700, (10 << 16) + 2 + 4), (100, 3, "code", 50, -1), (100, 4, "moods", 61, -1), (100, 5, "flags", 1560, 3), (100, 6, "any", 1700, -1), (101, 1, "id", 23, -1), (102, 1, "oid", 23, -1), (103, 1, "id", 23, -1)], "relation long, number int, name string, type long, mods int"),
        "pg_type": spark.createDataFrame([(23, "integer", 0, 0, "b", -1), (1700, "numeric", 0, 0, "b", -1), (1043, "character varying", 0, 0, "b", -1), (50, "code", 1043, 0, "d", 12), (61, "mood[]", 0, 70, "b", -1), (70, "mood", 0, 0, "e", -1), (1560, "bit", 0, 0, "b", -1)], "oid long, name string, base long, element long, category string, mods int"),
        "pg_index": spark.createDataFrame([(100, "1 3")], "relation long, numbers string"),
    }
    scan = server_catalog.scan(lambda sql: frames[sql.split(" from pg_catalog.")[1].split()[0]])
    rows = {(r["table_name"], r["column_name"]): r for r in scan.where("schema_name = 'public'").collect()}
    look = lambda c: tuple(rows["t", c][k] for k in ("type", "is_array", "is_enum", "length", "precision", "scale", "is_key"))
    assert look("id") == ("integer", False, False, None, None, None, True) and look("price") == ("numeric", False, False, None, 10, 2, False)
    assert look("code") == ("character varying", False, False, 8, None, None, True) and look("moods") == ("mood", True, True, None, None, None, False)
    assert look("flags") == ("bit", False, False, 3, None, None, False) and look("any")[3:6] == (None, None, None)
    found = catalog.discover(scan, "db")
    facts = {e["tap_stream_id"]: e["metadata"][0]["metadata"] for e in found}
    assert set(facts) == {"public-t", "public-v"} and facts["public-t"]["table-key-properties"] == ["code", "id"] and facts["public-t"]["row-count"] == -1 and facts["public-v"]["is-view"]
    assert [e["tap_stream_id"] for e in catalog.discover(scan, "db", ["other"])] == []


def entry(**stream):
    columns = [ColumnInfo("id", "integer", is_key=True), ColumnInfo("at", "timestamp without time zone"), ColumnInfo("blob", "bytea"), ColumnInfo("name", "text")]
    e = catalog.stream_entry("public", "t", False, 3, "db", columns)
    e["metadata"][0]["metadata"].update({"selected": True, **stream})
    return e


def test_stream_entry():
    e = entry()
    assert e["tap_stream_id"] == "public-t" and e["schema"]["properties"]["blob"] == {}
    by = {tuple(m["breadcrumb"]): m["metadata"] for m in e["metadata"]}
    assert by[("properties", "blob")] == {"sql-datatype": "bytea", "inclusion": "unsupported", "selected-by-default": False}
    assert by[("properties", "id")]["inclusion"] == "automatic" and by[()]["table-key-properties"] == ["id"]
    assert catalog.stream_entry("s", "v", True, 0, "db", [ColumnInfo("id", "integer", is_key=True)])["metadata"][0]["metadata"]["table-key-properties"] == []


def test_selection():
    s = Stream(entry())
    assert s.columns == ["at", "id", "name"] and s.keys == ["id"] and s.destination == "public-t" and s.is_selected
    s._facts(("properties", "name"))["selected"] = "false"
    s._facts(("properties", "id"))["selected"] = False
    assert s.columns == ["at", "id"]


def test_normalize():
    e = {"tap_stream_id": "my-schema-t", "stream": "t", "schema": {"properties": {}}}
    Stream(e).normalize()
    assert e["table_name"] == "t" and Stream(e).schema_name == "my-schema"
    for bad in ({"stream": "t"}, {"tap_stream_id": "x", "stream": "t", "schema": {"properties": {}}}, {"tap_stream_id": "a-t", "stream": "t"}, {"tap_stream_id": "-t", "stream": "t", "schema": {"properties": {}}}):
        with pytest.raises(CatalogError):
            Stream(bad).normalize()


def test_discovery(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], "id int, `select` string, `Mixed Case` double")
    relations = [Relation("public", "b", df, ("id",)), Relation("public", "a", df, kind="v", readable=frozenset({"id"})), Relation("information_schema", "x", df), Relation("other", "c", df)]
    found = catalog.discover(catalog.column_scan(spark, relations), "db")
    assert [e["tap_stream_id"] for e in found] == ["other-c", "public-a", "public-b"]
    assert list(found[1]["schema"]["properties"]) == ["id"] and list(found[2]["schema"]["properties"]) == ["Mixed Case", "id", "select"]
    only = spark.createDataFrame([("public", "b")], "schema_name string, table_name string")
    assert [e["stream"] for e in catalog.discover(catalog.column_scan(spark, relations), "db", tables=only)] == ["b"]
    assert [e["stream"] for e in catalog.discover(catalog.column_scan(spark, relations), "db", ["other"])] == ["c"]
    assert json.loads(catalog.catalog_json(found))["streams"][0]["stream"] == "c"
    with pytest.raises(CatalogError):
        catalog.catalog_json([])


def test_catalog_keeps_digits():
    e = catalog.stream_entry("s", "t", False, 0, "d", [ColumnInfo("n", "numeric")])
    assert '"multipleOf": 0.' + "0" * 37 + "1" in catalog.catalog_json([e]) and '"exclusiveMaximum": 1' + "0" * 62 in catalog.catalog_json([e])
    assert messages.dumps({"a": [Decimal("1.10")]}) == '{"a": [1.10]}'


def test_refresh_keeps_what_consumers_added():
    old, fresh = entry(**{"replication-method": "FULL_TABLE"}), entry(selected=None)
    old["metadata"][4]["metadata"]["selected"] = False
    fresh["metadata"].pop(2)
    fresh["metadata"][0]["metadata"] = {**fresh["metadata"][0]["metadata"], "row-count": 99}
    s = Stream(old)
    catalog.refresh([s], [fresh])
    assert s["row-count"] == 99 and s["replication-method"] == "FULL_TABLE" and s["selected"] is True
    assert s.columns == ["id"]
    with pytest.raises(CatalogError):
        catalog.refresh([s], [])


@pytest.mark.parametrize("was,now", [(a, b) for a in ("FULL_TABLE", "INCREMENTAL", "LOG_BASED") for b in ("FULL_TABLE", "INCREMENTAL", "LOG_BASED")])
def test_method_change_wipes(was, now):
    s = State({"bookmarks": {"t": {"last_replication_method": was, "version": 1, "replication_key": "k"}}})
    s.reset("t", now, "k")
    assert (s.get("t", "version") == 1) is (was == now) and s.get("t", "last_replication_method") == now


def test_key_change_wipes():
    s = State({"bookmarks": {"t": {"last_replication_method": "INCREMENTAL", "replication_key": "a", "replication_key_value": 5}}})
    s.reset("t", "INCREMENTAL", "b")
    assert s.get("t", "replication_key_value") is None


def test_state_rules():
    s = State({"bookmarks": {"a": {"xmin": 1, "lsn": 2}, "b": {"lsn": 5}, "c": {"xmin": 1}, "d": {"version": 1, "xmin": 2}}})
    assert s.work("a") == "snapshot" and s.work("b") == "logical" and s.work("new") == "snapshot" and s.committed(["a", "b", "new"]) == 2
    with pytest.raises(StateError):
        s.work("c")
    with pytest.raises(StateError):
        s.check_incremental("d")
    assert s.drop_deselected({"b"}) == ["a"] and s.get("c", "xmin") == 1
    with pytest.raises(StateError):
        resolve_method(None, None, "t")
    assert resolve_method(None, "FULL_TABLE", "t") == "FULL_TABLE"


def test_servers():
    assert servers.verdict(90300) == "unsupported" and servers.verdict(90420) == "faulty" and servers.verdict(110002) == "ok"
    assert "wal_lsn" in servers.position_query(120000) and "xlog" in servers.position_query(90612)
    assert servers.sender_option(120000) and servers.sender_option(110002) is None
    with pytest.raises(servers.ServerError):
        servers.require(100006)


def test_flush_rules():
    assert changelog.first_flush(None, 5) == 5 and changelog.first_flush(3, 5) == 3 and changelog.first_flush(9, 5) == 5
    assert changelog.next_flush(4, 5, 3) == 4 and changelog.next_flush(6, 5, 3) is None and changelog.next_flush(3, 5, 3) is None and changelog.next_flush(None, 5, 3) is None
    assert changelog.final_position(None, 9) is None and changelog.final_position(5, None) == 5 and changelog.final_position(5, 9) == 9
