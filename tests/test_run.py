import io
import json

import pyarrow as pa
import pytest

from weirflow import cli
from weirflow.config import Settings
from weirflow.operators import apply, incremental, snapshot
from weirflow.operators.batches import FileWriter
from weirflow.operators.changelog import LogStream
from weirflow.plans import run as runs
from weirflow.plans.run import Run
from weirflow.plans.servers import ServerError
from weirflow.plans.state import State, StateError
from weirflow.sources import change_log
from weirflow.sources.relations import Fact, ParquetSource, SessionSource
from weirflow.streaming import session as sessions
from weirflow.streaming.runner import LogRunner

CONFIG = {"host": "h", "port": 1, "user": "u", "password": "p", "dbname": "d"}


@pytest.fixture
def source(spark, tmp_path):
    rows = "select * from values (1, timestamp_ntz'2024-01-01 00:00:00', 'a', 1.5D), (2, timestamp_ntz'2024-01-02 00:00:00.5', 'b', double('NaN')), (3, null, 'c', null) t(id, updated_at, name, x)"
    spark.sql(rows).write.parquet(f"{tmp_path}/people.parquet")
    return ParquetSource(spark, str(tmp_path), ("people",), facts={"people": Fact(("id",), "id")})


def sync(spark, source, method, state=None, config=None, **metadata):
    lines = []
    job = Run(spark, source, Settings.of(CONFIG | (config or {})), lambda line: lines.append(json.loads(line)), current_lsn=lambda: 77)
    catalog = {"streams": job.discovered()}
    catalog["streams"][0]["metadata"][0]["metadata"].update({"selected": True, "replication-method": method, **metadata})
    out = job.sync(catalog, State(state))
    return lines, out


def kinds(lines):
    return [m["type"] for m in lines]


def test_full_table(spark, source):
    lines, state = sync(spark, source, "FULL_TABLE")
    assert kinds(lines) == ["STATE", "SCHEMA", "ACTIVATE_VERSION", "RECORD", "RECORD", "RECORD", "ACTIVATE_VERSION", "STATE", "STATE"]
    assert [m["record"] for m in lines if m["type"] == "RECORD"] == [
        {"id": 1, "name": "a", "updated_at": "2024-01-01T00:00:00+00:00", "x": 1.5},
        {"id": 2, "name": "b", "updated_at": "2024-01-02T00:00:00.500000+00:00", "x": None},
        {"id": 3, "name": "c", "updated_at": None, "x": None},
    ]
    assert lines[1]["key_properties"] == ["id"] and lines[3]["stream"] == "public-people" and lines[3]["version"] == state.get("public-people", "version")
    assert state.get("public-people", "xmin") is None and state.current is None
    again, later = sync(spark, source, "FULL_TABLE", state.value)
    assert kinds(again)[:3] == ["STATE", "SCHEMA", "RECORD"] and later.get("public-people", "version") >= lines[3]["version"]


def test_interrupted_copy_keeps_its_version(spark, source):
    lines, state = sync(spark, source, "FULL_TABLE", {"bookmarks": {"public-people": {"last_replication_method": "FULL_TABLE", "version": 5, "xmin": 2}}})
    assert {m["version"] for m in lines if m["type"] == "RECORD"} == {5}
    assert [m["record"]["id"] for m in lines if m["type"] == "RECORD"] == [2, 3]


def test_incremental(spark, source):
    lines, state = sync(spark, source, "INCREMENTAL", **{"replication-key": "updated_at"})
    assert kinds(lines) == ["STATE", "SCHEMA", "ACTIVATE_VERSION", "RECORD", "RECORD", "RECORD", "STATE", "STATE"]
    assert lines[1]["bookmark_properties"] == ["updated_at"] and state.get("public-people", "replication_key_value") == "2024-01-02T00:00:00.500000+00:00"
    again, later = sync(spark, source, "INCREMENTAL", state.value, **{"replication-key": "updated_at"})
    assert [m["record"]["id"] for m in again if m["type"] == "RECORD"] == [2]
    assert later.get("public-people", "version") == state.get("public-people", "version")


def test_incremental_needs_a_key(spark, source):
    for more in ({}, {"replication-key": "nothing"}):
        with pytest.raises(StateError):
            sync(spark, source, "INCREMENTAL", **more)
    odd = {"bookmarks": {"public-people": {"last_replication_method": "INCREMENTAL", "xmin": 5}}}
    with pytest.raises(StateError):
        sync(spark, source, "INCREMENTAL", odd, **{"replication-key": "id"})


def test_batches_agree_with_records(spark, source, tmp_path):
    root = tmp_path / "files"
    root.mkdir()
    lines, state = sync(spark, source, "INCREMENTAL", config={"batch_config": {"batch_size": 2, "storage": {"root": str(root)}}}, **{"replication-key": "updated_at"})
    files = [m["manifest"][0].removeprefix("file://") for m in lines if m["type"] == "BATCH"]
    read = pa.concat_tables([pa.ipc.open_file(f).read_all() for f in files])
    assert sorted(read["id"].to_pylist()) == [1, 2, 3] and read.schema.names == ["id", "name", "updated_at", "x"]
    assert state.get("public-people", "replication_key_value") == "2024-01-02T00:00:00.500000+00:00"
    last = max(k for k, m in enumerate(lines) if m["type"] == "BATCH")
    assert all("replication_key_value" not in m["value"]["bookmarks"]["public-people"] for m in lines[:last] if m["type"] == "STATE")
    full, _ = sync(spark, source, "FULL_TABLE", config={"batch_config": {"storage": {"root": str(root)}}})
    assert kinds(full) == ["STATE", "SCHEMA", "ACTIVATE_VERSION", "BATCH", "STATE", "ACTIVATE_VERSION", "STATE", "STATE"]


def test_file_writer(tmp_path):
    w = FileWriter(str(tmp_path / "x"), 25_000)
    batch = lambda n: pa.RecordBatch.from_pydict({"a": list(range(n))})
    assert w.flush() is None and w.add(batch(0)) is None
    sizes = [done[1] for _ in range(7) if (done := w.add(batch(10_000)))]
    assert sizes == [30_000, 30_000] and w.flush()[1] == 10_000 and w.flush() is None


def test_log_based_begins_with_a_copy(spark, source):
    lines, state = sync(spark, source, "LOG_BASED")
    assert state.get("public-people", "lsn") == 77 and "RECORD" in kinds(lines)
    assert state.work("public-people") == "logical"


def test_schedule_and_selection(spark, tmp_path):
    for t in ("a", "b", "c"):
        spark.range(1).write.parquet(f"{tmp_path}/{t}.parquet")
    lines = []
    job = Run(spark, ParquetSource(spark, str(tmp_path), ("a", "b", "c")), Settings.of(CONFIG | {"default_replication_method": "FULL_TABLE"}), lambda x: lines.append(json.loads(x)))
    streams = job.discovered()
    for s in streams[1:]:
        s["metadata"][0]["metadata"]["selected"] = "true"
    job.sync({"streams": streams}, State({"currently_syncing": "public-c"}))
    assert [m["stream"] for m in lines if m["type"] == "SCHEMA"] == ["public-c", "public-b"]
    before = len(lines)
    job.sync({"streams": streams[:1]}, State())
    assert len(lines) == before


def test_views_have_no_log(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/people.parquet")
    with pytest.raises(StateError):
        sync(spark, ParquetSource(spark, str(tmp_path), ("people",), facts={"people": Fact(is_view=True)}), "LOG_BASED")


def test_session_source(spark):
    spark.range(3).createOrReplaceTempView("seen_rows")
    found = {r.name: r.kind for r in SessionSource(spark).relations()}
    assert found["seen_rows"] == "v" and SessionSource(spark).rows("default", "seen_rows").count() == 3


def test_numbered_and_keyset(spark):
    df = spark.range(1000).selectExpr("id", "cast(id as string) t")
    got = {r["id"]: r["seq"] for r in snapshot.numbered(df, [df["t"]], df["t"].substr(1, 2)).collect()}
    assert [got[int(t)] for t in sorted(map(str, range(1000)))] == list(range(1, 1001))
    assert [r["id"] for r in snapshot.after_key(spark.range(5), ["id"], [2]).collect()] == [3, 4]


def test_stalled_limit(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "id int, k int")
    page = incremental.incremental(df, {"id": "integer", "k": "integer"}, "k", 5, "int", 2, ["id"])
    assert incremental.stalled(page, "k", 5, 2) and not incremental.stalled(page, "k", 4, 2)


def test_pushdown_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id k", "cast(id as string) wide").write.parquet(f"{tmp_path}/t.parquet")
    page = incremental.incremental(spark.read.parquet(f"{tmp_path}/t.parquet"), {"id": "bigint", "k": "bigint"}, "k", 50, "bigint", 5)
    plan = page._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(k,50)" in plan and "TakeOrderedAndProject" in plan and "wide" not in plan.split("ReadSchema")[1]


def test_latest_state(spark):
    rows = spark.createDataFrame([(1, 1, "a", None), (1, 3, "b", None), (2, 2, "c", None), (2, 4, "d", "x"), (None, 1, "n", None)], "id int, lsn int, v string, gone string")
    got = apply.latest_state(rows, ["id"], "lsn", "gone").collect()
    assert sorted((r["id"] or 0, r["v"]) for r in got) == [(0, "n"), (1, "b")]


# --- the log -------------------------------------------------------------------------------------


def event(lsn, action="I", table="t", **row):
    part = "identity" if action == "D" else "columns"
    return {"lsn": lsn, "payload": json.dumps({"action": action, "schema": "public", "table": table, part: [{"name": k, "value": v} for k, v in row.items()]})}


def write_log(path, *events):
    path.mkdir(exist_ok=True)
    with open(path / f"{len(list(path.iterdir())):04d}.json", "w") as f:
        f.writelines(json.dumps(e) + "\n" for e in events)


STREAM = LogStream("public-t", "public", "t", 9, {"id": "integer", "note": "text"}, frozenset({"id", "note"}))


def make(spark, state=None, **more):
    said, lines = [], []

    def write(df):
        got = df.collect()
        lines.extend(json.loads(r["record"]) for r in got)
        return len(got)

    s = sessions.LogSession([STREAM], State(state or {"bookmarks": {"public-t": {"lsn": 100}}}), "2024-01-01T00:00:00+00:00", write, said.append, **more)
    return s, lines, said


def test_log_session_keeps_dead_letters(spark, tmp_path, caplog):
    log = tmp_path / "log"
    write_log(log, event(100, id=1), {"lsn": 115, "payload": "junk"}, event(120, id=2))
    s, lines, _ = make(spark)
    sessions.run(spark, s, str(log), str(tmp_path / "checkpoint"))
    kept = spark.read.parquet(str(tmp_path / "checkpoint-dead-letters"))
    assert [(r["lsn"], r["payload"]) for r in kept.collect()] == [(115, "junk")]
    assert s.unreadable == 1 and s.processed == 120 and len(lines) == 2 and "1 unreadable payloads" in caplog.text


def test_log_session(spark, tmp_path):
    log = tmp_path / "log"
    write_log(log, event(90, id=0), event(100, id=1, note="a"), event(110, "U", id=1, note=None), event(110, table="other", id=5), {"lsn": 115, "payload": "junk"}, event(120, "D", id=1), event(130, id=2), event(999, id=3))
    s, lines, said = make(spark, end_lsn=500, debug_lsn=True)
    sessions.run(spark, s, str(log), str(tmp_path / "checkpoint"))
    assert lines == [
        {"_sdc_deleted_at": None, "_sdc_lsn": "100", "id": 1, "note": "a"},
        {"_sdc_deleted_at": None, "_sdc_lsn": "110", "id": 1, "note": None},
        {"_sdc_deleted_at": "2024-01-01T00:00:00+00:00", "_sdc_lsn": "120", "id": 1},
        {"_sdc_deleted_at": None, "_sdc_lsn": "130", "id": 2},
    ]
    assert s.processed == 130 and s.complete == 120 and s.state.get("public-t", "lsn") == 120 and said[-1]["type"] == "STATE" and s.rows == {"public-t": 4}


def test_confirmation_waits_for_the_consumer(tmp_path):
    target, state = tmp_path / "confirmed", tmp_path / "state.json"
    assert change_log.confirm(str(target), 500, change_log.committed_in(str(state), ["a"])) is None and not target.exists()
    state.write_text(json.dumps({"bookmarks": {"a": {"lsn": 200}, "b": {"lsn": 150}}}))
    assert change_log.confirm(str(target), 500, change_log.committed_in(str(state), ["a", "b"])) == 150
    assert change_log.confirm(str(target), 100, 900) == 150 and target.read_text() == "150"
    assert change_log.confirm(str(target), 180, 900) == 180
    state.write_text("{oops")
    assert change_log.committed_in(str(state), ["a"]) is None


def test_drift_stops_or_refreshes(spark):
    df = spark.createDataFrame([(int(e["lsn"]), e["payload"]) for e in (event(101, id=1, extra=2),)], "lsn long, payload string")
    s, _, _ = make(spark)
    with pytest.raises(sessions.Drift):
        s.take(df)
    wider = LogStream("public-t", "public", "t", 9, {"id": "integer", "extra": "integer"}, frozenset({"id", "extra"}))
    s, lines, _ = make(spark, refresh=lambda new: [wider])
    s.take(df)
    assert lines == [{"_sdc_deleted_at": None, "extra": 2, "id": 1}]


def test_copy_then_log_then_drift(spark, source, tmp_path):
    """A stream's life: copied at first, then from the log, and a column that comes while it is read."""
    log, lines = tmp_path / "log", []
    write_log(log, event(50, table="people", id=1, name="a"))
    settings = Settings.of(CONFIG | {"default_replication_method": "LOG_BASED"})
    reader = LogRunner(spark, settings, str(log), str(tmp_path / "checkpoints"), str(tmp_path / "confirmed"), str(tmp_path / "state.json"))
    job = Run(spark, source, settings, lambda x: lines.append(json.loads(x)), reader, reader.current_lsn)
    catalog = {"streams": job.discovered()}
    catalog["streams"][0]["metadata"][0]["metadata"]["selected"] = True
    state = job.sync(catalog, State())
    assert state.get("public-people", "lsn") == 50 and kinds(lines).count("RECORD") == 3
    (tmp_path / "state.json").write_text(json.dumps(state.value))
    del lines[:]
    write_log(log, event(60, "U", table="people", id=1, name="b"), event(60, "D", table="people", id=3), event(70, table="people", id=9, name="n", x=2.5, updated_at="2024-05-05 10:00:00"))
    state = job.sync(catalog, state)
    records = [m["record"] for m in lines if m["type"] == "RECORD"]
    assert [r["id"] for r in records] == [1, 1, 3, 9] and records[2]["_sdc_deleted_at"] and records[3] == {"_sdc_deleted_at": None, "id": 9, "name": "n", "updated_at": "2024-05-05T10:00:00+00:00", "x": 2.5}
    assert "_sdc_deleted_at" in lines[0]["schema"]["properties"] and state.get("public-people", "lsn") == 60 and (tmp_path / "confirmed").read_text() == "50"
    del lines[:]
    spark.sql("select 1 id, 'z' name, 1 more, timestamp_ntz'2024-01-01 00:00:00' updated_at, 1.0D x").write.parquet(f"{source.root}/people.parquet", mode="overwrite")
    catalog["streams"][0]["metadata"] = [m for m in catalog["streams"][0]["metadata"] if m["breadcrumb"] != ["properties", "more"]]
    write_log(log, event(80, table="people", id=10, more=7, gone=1))
    job.sync(catalog, state)
    last = [m for m in lines if m["type"] in ("SCHEMA", "RECORD")][-1]
    assert last["record"] == {"_sdc_deleted_at": None, "id": 10, "more": 7} and "more" in [m for m in lines if m["type"] == "SCHEMA"][-1]["schema"]["properties"]


def test_odd_action_fails_only_on_own_tables(spark):
    from pyspark.errors import PySparkException

    frame = lambda *e: spark.createDataFrame([(x["lsn"], x["payload"]) for x in e], "lsn long, payload string")
    s, lines, _ = make(spark)
    s.take(frame(event(101, "T", table="foreign"), event(102, id=1)))
    assert len(lines) == 1
    with pytest.raises(PySparkException):
        s.take(frame(event(103, "T")))


def test_log_reads_in_batch(spark, tmp_path):
    log = tmp_path / "log"
    write_log(log, event(1, id=1), event(2, table="x", id=2), {"lsn": 3, "payload": "junk"}, event(9, id=4))
    change_log.register(spark)
    df = spark.read.format(change_log.NAME).option("endLsn", 5).load(str(log))
    assert sorted(r["lsn"] for r in df.collect()) == [1, 2, 3]
    assert [r["lsn"] for r in df.where("`table` = 'x' and lsn > 0").collect()] == [2]


def test_streams_share_the_order_of_the_log(spark, tmp_path):
    """Records of several streams leave in the order of the log; other tables' payloads stay where they are."""
    log, lines = tmp_path / "log", []
    other = LogStream("public-b,x", "public", "b,x", 4, {"id": "integer"}, frozenset({"id"}))
    write_log(log, event(101, id=1), event(102, table="b,x", id=2), event(103, id=3), event(104, table="b,x", id=4), event(105, table="foreign", id=5))

    def write(df):
        lines.extend((r["stream"], json.loads(r["record"])["id"]) for r in df.toLocalIterator())
        return len(lines)

    s = sessions.LogSession([STREAM, other], State({"bookmarks": {"public-t": {"lsn": 100}, "public-b,x": {"lsn": 100}}}), "2024-01-01T00:00:00+00:00", write, lambda _: None)
    sessions.run(spark, s, str(log), str(tmp_path / "checkpoint"))
    assert lines == [("public-t", 1), ("public-b,x", 2), ("public-t", 3), ("public-b,x", 4)]
    assert s.processed == 105 and s.unreadable == 0 and s.rows == {"public-t": 2, "public-b,x": 2}


def test_log_is_looked_at_once(tmp_path):
    """Positions come from new bytes only; a batch reads the files that hold its positions; half a line waits."""
    log = tmp_path / "log"
    write_log(log, event(10, id=1), event(30, id=2))
    write_log(log, event(40, id=3))
    (log / "_server.json").write_text('{"version": 160000}')
    reader = change_log.LogStreamReader({"path": str(log), "addTables": "public.t"})
    assert reader.latestOffset() == {"lsn": 40} and [len(reader.partitions({"lsn": a}, {"lsn": b})) for a, b in ((-1, 40), (30, 40), (10, 30))] == [2, 1, 1]
    last = log / "0001.json"
    with open(last, "a") as f:
        f.write(json.dumps(event(50, id=4))[:20])
    assert reader.latestOffset() == {"lsn": 40}
    with open(last, "a") as f:
        f.write(json.dumps(event(50, id=4))[20:] + "\n" + json.dumps(event(45, table="x", id=9)) + "\n" + json.dumps({"lsn": 60, "payload": "junk"}))
    before = reader.seen[str(last)].size
    assert reader.latestOffset() == {"lsn": 60} and reader.seen[str(last)].size > before
    got = [r for p in reader.partitions({"lsn": 40}, {"lsn": 60}) for r in reader.read(p)]
    assert [(r[0], r[3], r[5] if r[3] is None else "") for r in got] == [(50, "t", ""), (45, None, "{}"), (60, None, "junk")]
    assert [r for p in reader.partitions({"lsn": 70}, {"lsn": 80}) for r in reader.read(p)] == []


def test_servers_of_a_log(spark, tmp_path):
    log = tmp_path / "log"
    write_log(log, event(10, id=1))
    settings = Settings.of(CONFIG | {"tap_id": "eu", "slot_prefixes": ["old"]})
    reader = LogRunner(spark, settings, str(log), str(tmp_path / "checkpoints"))
    assert reader.slot() is None and reader.current_lsn() == 10
    for version, slots, found in ((160003, ["old_d", "weirflow_d_eu"], "weirflow_d_eu"), (160003, ["old_d_eu"], "old_d_eu"), (160003, ["other"], None), (110001, ["weirflow_d"], None), (90300, ["weirflow_d"], None)):
        (log / "_server.json").write_text(json.dumps({"version": version, "slots": slots}))
        if found:
            assert reader.slot() == found and reader.current_lsn() == 10
        else:
            with pytest.raises(ServerError):
                reader.current_lsn()


# --- the command line ----------------------------------------------------------------------------


def test_command_line(spark, source, tmp_path):
    config = tmp_path / "config.json"
    config.write_text(json.dumps(CONFIG | {"parquet_root": source.root, "tables": ["people"], "default_replication_method": "FULL_TABLE", "facts": {"people": {"keys": ["id"], "watermark": "id"}}, "current_xid": 9}))
    assert cli.run(["-c", str(config)], spark) is None
    out = io.StringIO()
    cli.run(["-c", str(config), "--discover"], spark, out)
    catalog = json.loads(out.getvalue())
    catalog["streams"][0]["metadata"][0]["metadata"]["selected"] = True
    chosen = tmp_path / "catalog.json"
    chosen.write_text(json.dumps(catalog))
    out = io.StringIO()
    state = cli.run(["-c", str(config), "--catalog", str(chosen)], spark, out)
    assert out.getvalue().count('"RECORD"') == 3 and state.get("public-people", "version")
    assert [m["key_properties"] for m in map(json.loads, out.getvalue().splitlines()) if m["type"] == "SCHEMA"] == [["id"]]
    bookmark = tmp_path / "state.json"
    bookmark.write_text(json.dumps({"bookmarks": {"public-people": {"version": 5, "xmin": 2, "last_replication_method": "FULL_TABLE"}}}))
    out = io.StringIO()
    cli.run(["-c", str(config), "--catalog", str(chosen), "--state", str(bookmark)], spark, out)
    assert [m["record"]["id"] for m in map(json.loads, out.getvalue().splitlines()) if m["type"] == "RECORD"] == [2, 3]
    assert runs.new_version() > 10**12
