"""The queries of the engine's own operators, and the SQL each is held against.

A query applies its operators to the whole of its tables.  Where the tables lack a case (nulls, infinities,
years out of range), it is put in by an expression that the SQL has too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import convert, literals, lsn, names, temporal, types
from .operators import apply, batches, changelog, incremental, messages, snapshot
from .operators.changelog import LogStream
from .plans import catalog, servers, state
from .sources.relations import Fact, ParquetSource

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "text", "o_totalprice": "double precision", "o_orderdate": "timestamp without time zone", "o_orderpriority": "text"}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
EXTRACTED = "2024-02-01T00:00:00+00:00"
#: Where the synthetic log begins: file 16 in hexadecimal.
BASE = 0x16 << 32


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- snapshots -----------------------------------------------------------------------------------

_CLAMPED = "case when {0} < timestamp '0001-01-01 00:00:00' or {0} > timestamp '9999-12-31 23:59:59.999' then timestamp '9999-12-31 23:59:59.999' else {0} end"


@query(f"select o_custkey, {_CLAMPED.format('o_orderdate')} o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice from orders")
def full_table_scan(spark, sf_dir):
    return snapshot.full_table(_table(spark, sf_dir, "orders"), ORDERS)


@query("select c_custkey, c_name, n_name from customer join nation on c_nationkey = n_nationkey")
def view_scan(spark, sf_dir):
    view = _table(spark, sf_dir, "customer").join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return snapshot.full_table(view, {"c_custkey": "bigint", "c_name": "text", "n_name": "text"})


@query("select o_orderkey, row_number() over (order by cast(o_orderkey as varchar)) seq from orders")
def xmin_text_order(spark, sf_dir):
    rows = snapshot.full_table(_table(spark, sf_dir, "orders"), {"o_orderkey": "bigint"}, "o_orderkey")
    text = F.col(snapshot.WATERMARK).cast("string")
    return snapshot.numbered(rows, [text], F.substring(text, 1, 3)).select("o_orderkey", "seq")


_XID = "(o_orderkey + 4294967000) % 4294967296"
_AGE = "((((1000 - {}) % 4294967296) + 4294967296) % 4294967296)"


@query(f"select o_orderkey, {_XID} xid from orders where {_AGE.format(_XID)} <= {_AGE.format("4294967100")}")
def xmin_resume_age(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").withColumn("xid", F.pmod(F.col("o_orderkey") + 4294967000, F.lit(2**32)))
    out = snapshot.full_table(rows, {"o_orderkey": "bigint", "xid": "bigint"}, "xid", 4294967100, 1000)
    return out.drop(snapshot.WATERMARK)


@query("select max_by(x, cast(x as varchar)) xmin from (select o_orderkey x from orders)")
def xmin_last(spark, sf_dir):
    rows = snapshot.full_table(_table(spark, sf_dir, "orders"), {"o_custkey": "bigint"}, "o_orderkey")
    return snapshot.last_watermark(rows)


@query("select l_linenumber, l_orderkey, l_partkey from lineitem where (l_orderkey, l_linenumber) > (500, 3)")
def keyset_resume(spark, sf_dir):
    rows = snapshot.after_key(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [500, 3])
    return snapshot.project(rows, {"l_orderkey": "bigint", "l_linenumber": "integer", "l_partkey": "bigint"})


_SHIFTED = {"+9000": "ts + interval 9000 years", "-2500": "ts - interval 2500 years", "0": "ts"}


@query(" union all ".join(f"select event_id, '{k}' shift, {_CLAMPED.format('(' + v + ')')} ts from events" for k, v in _SHIFTED.items()))
def ts_clamp(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", F.explode(F.array(*[F.lit(k) for k in _SHIFTED])).alias("shift"), "ts")
    moved = events.select("event_id", "shift", F.timestamp_add("YEAR", F.col("shift").cast("int"), F.col("ts")).alias("ts"))
    return snapshot.project(moved, {"event_id": "bigint", "shift": "text", "ts": "timestamp without time zone"})


@query("select cast(cast(o_orderdate as date) as timestamp) d, o_orderkey from orders")
def date_midnight(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return snapshot.project(rows, {"o_orderkey": "bigint", "d": "date"})


# --- incremental reads ---------------------------------------------------------------------------

_KEYED = "case when o_orderkey % 7 = 0 then null else o_orderdate end"


def _keyed(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))


_KEY_TYPES = {"o_orderkey": "bigint", "o_orderdate": "timestamp without time zone", "o_totalprice": "double precision"}


@query(f"select {_KEYED} o_orderdate, o_orderkey, o_totalprice, row_number() over (order by {_KEYED} nulls last, o_orderkey) seq from orders")
def incremental_first(spark, sf_dir):
    rows = incremental.incremental(_keyed(spark, sf_dir), _KEY_TYPES, "o_orderdate", ties=["o_orderkey"])
    return snapshot.numbered(rows, [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey")], F.date_trunc("MONTH", "o_orderdate"))


@query(f"select o_orderdate, o_orderkey, o_totalprice from (select o_orderkey, o_totalprice, {_KEYED} o_orderdate from orders) where o_orderdate >= timestamp '1997-01-01'")
def incremental_resume(spark, sf_dir):
    return incremental.incremental(_keyed(spark, sf_dir), _KEY_TYPES, "o_orderdate", "1997-01-01T00:00:00", "timestamp_ntz")


@query("select o_orderdate, o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '1997-01-01' order by o_orderdate, o_orderkey limit 50")
def incremental_limit(spark, sf_dir):
    return incremental.incremental(_table(spark, sf_dir, "orders"), _KEY_TYPES, "o_orderdate", "1997-01-01T00:00:00", "timestamp_ntz", 50, ["o_orderkey"])


@query(f"select strftime(max({_KEYED}), '%Y-%m-%dT%H:%M:%S+00:00') replication_key_value from orders")
def next_bookmark(spark, sf_dir):
    top = incremental.next_bookmark(_keyed(spark, sf_dir), "o_orderdate")
    return top.select(temporal.iso_timestamp(F.col("replication_key_value")).alias("replication_key_value"))


@query("select x.stream, k.key odd from (values ('a', ['version', 'xmin', 'lsn']), ('b', ['version', 'replication_key'])) x(stream, keys), lateral (select unnest(keys) as key) k where key not in ('replication_key', 'replication_key_value', 'version', 'last_replication_method')")
def bookmark_key_check(spark, sf_dir):
    given = spark.createDataFrame([("a", ["version", "xmin", "lsn"]), ("b", ["version", "replication_key"])], "stream string, keys array<string>")
    return state.odd_keys(given).select("stream", F.explode("odd").alias("odd"))


# --- values --------------------------------------------------------------------------------------

_HALF = "case when event_id % 2 = 0 then date_trunc('second', ts) else ts end"
_ISO = "case when date_trunc('second', {0}) = {0} then strftime({0}, '%Y-%m-%dT%H:%M:%S') else strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') end || '+00:00'"


@query(f"select event_id, {_ISO.format('(' + _HALF + ')')} iso from events")
def iso_timestamp(spark, sf_dir):
    ts = F.when(F.col("event_id") % 2 == 0, F.date_trunc("SECOND", "ts").cast("timestamp_ntz")).otherwise(F.col("ts"))
    return _table(spark, sf_dir, "events").select("event_id", convert.snapshot_value(ts, "timestamp without time zone").alias("iso"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00+00:00' iso from orders")
def iso_date(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", convert.snapshot_value(F.col("o_orderdate").cast("date"), "date").alias("iso"))


@query("select event_id, case when event_id % 5 in (0, 1, 2) then null else value end as value from events")
def float_nonfinite(spark, sf_dir):
    odd = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).when(F.col("event_id") % 5 == 1, F.lit(float("-inf"))).when(F.col("event_id") % 5 == 2, F.lit(float("inf")))
    return _table(spark, sf_dir, "events").select("event_id", convert.snapshot_value(odd.otherwise(F.col("value")), "double precision", "double").alias("value"))


_TEXTS = "case event_id % 4 when 0 then 'NaN' when 1 then cast(event_id as varchar) || '.123456789012345678901234567890' when 2 then '-Infinity' else null end"


@query(f"select event_id, case when lower(t) = 'nan' then null else t end as value from (select event_id, {_TEXTS} t from events)")
def numeric_nan(spark, sf_dir):
    n = F.col("event_id") % 4
    text = F.when(n == 0, "NaN").when(n == 1, F.concat(F.col("event_id").cast("string"), F.lit(".123456789012345678901234567890"))).when(n == 2, "-Infinity")
    return _table(spark, sf_dir, "events").select("event_id", convert.snapshot_value(text, "numeric", "string").alias("value"))


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) k from events")
def json_parse(spark, sf_dir):
    parsed = convert.snapshot_value(F.col("props"), "jsonb", "string")
    return _table(spark, sf_dir, "events").select("event_id", F.try_variant_get(parsed, "$.k", "bigint").alias("k"))


@query("select vec_id, cast(unnest(range(1, len(embedding) + 1)) as int) pos, case when unnest(embedding) < -0.1 then null else unnest(embedding) end x from embeddings")
def array_elements(spark, sf_dir):
    holed = F.transform("embedding", lambda x: F.when(x < -0.1, F.lit(float("nan")).cast("float")).otherwise(x))
    kept = _table(spark, sf_dir, "embeddings").select("vec_id", convert.snapshot_value(holed, "real[]", "array<float>").alias("e"))
    return kept.select("vec_id", F.posexplode("e").alias("pos", "x")).select("vec_id", (F.col("pos") + 1).alias("pos"), "x")


_CLOCK = "case when event_id % 9 = 0 then '24:00:00' else strftime(ts, '%H:%M:%S.%f') end"


def _clock() -> Column:
    return F.when(F.col("event_id") % 9 == 0, "24:00:00").otherwise(F.date_format("ts", "HH:mm:ss.SSSSSS"))


@query(f"select event_id, case when event_id % 9 = 0 then '00:00:00' else strftime(ts, '%H:%M:%S') end as t from events")
def time_hour24(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", convert.snapshot_value(_clock(), "time without time zone").alias("t"))


@query(
    """with s as (select event_id, event_id % 25 - 12 h, case when event_id % 9 = 0 then 0 else hour(ts) * 3600 + minute(ts) * 60 + second(ts) end c from events),
    u as (select event_id, (((c - h * 3600) % 86400) + 86400) % 86400 s from s)
    select event_id, printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) t from u"""
)
def timetz_utc(spark, sf_dir):
    h = F.col("event_id") % 25 - 12
    zone = F.format_string("%s%02d", F.when(h < 0, "-").otherwise("+"), F.abs(h))
    return _table(spark, sf_dir, "events").select("event_id", convert.snapshot_value(F.concat(_clock(), zone), "time with time zone").alias("t"))


@query("select event_id, case event_id % 3 when 0 then true when 1 then false else null end b from events")
def bit_bool(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, "1").when(F.col("event_id") % 3 == 1, "0")
    return _table(spark, sf_dir, "events").select("event_id", convert.snapshot_value(text, "bit", "string").alias("b"))


# --- names and positions -------------------------------------------------------------------------

_BIG = "o_orderkey * 1000000007"
_LSN_TEXT = f"upper(to_hex(({_BIG}) >> 32)) || '/' || upper(to_hex(({_BIG}) & 4294967295))"


@query(f"select o_orderkey, {_LSN_TEXT} lsn from orders")
def int_to_lsn(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", lsn.to_text(F.col("o_orderkey") * 1000000007).alias("lsn"))


@query(f"select o_orderkey, case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then 97500059720 else {_BIG} end lsn from orders")
def lsn_to_int(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.when(k % 11 == 0, "").when(k % 13 == 0, "16/B374D848").otherwise(lsn.to_text(k * 1000000007))
    return _table(spark, sf_dir, "orders").select("o_orderkey", lsn.to_int(text).alias("lsn"))


@query("select c_custkey, regexp_replace(lower('weirflow_' || c_name || case when c_custkey % 2 = 0 then '_' || c_mktsegment else '' end), '[^a-z0-9_]', '_', 'g') slot from customer")
def slot_name(spark, sf_dir):
    pipeline = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    return _table(spark, sf_dir, "customer").select("c_custkey", names.slot_name(F.col("c_name"), pipeline).alias("slot"))


@query(r"""select p_partkey, regexp_replace(p_name || '.' || p_type || ',''*\', '([\\ '',.*])', '\\\1', 'g') as escaped from part""")
def wal_escape(spark, sf_dir):
    raw = F.concat("p_name", F.lit("."), "p_type", F.lit(",'*\\"))
    return _table(spark, sf_dir, "part").select("p_partkey", names.escaped(raw).alias("escaped"))


@query("select string_agg('public.' || replace(n_name, ' ', '\\ '), ',' order by n_name) tables from nation")
def add_tables(spark, sf_dir):
    tables = [("public", r["n_name"]) for r in _table(spark, sf_dir, "nation").select("n_name").orderBy("n_name").collect()]
    return spark.createDataFrame([(names.table_list(tables),)], "tables string")


@query("""select p_partkey, '"' || replace(p_name || '"' || p_brand, '"', '""') || '"' as quoted from part""")
def quote_ident(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", names.quoted(F.concat("p_name", F.lit('"'), "p_brand")).alias("quoted"))


_NAMES = ["integer", "numeric(10,2)", "character varying(33)", "timestamp with time zone", "integer[]", "int; drop table t", "bit(5)", "text'", 'my."Type"', "1x", "numeric(10, 2)[]", ""]
_INLINE = ", ".join("('{}')".format(n.replace("'", "''")) for n in _NAMES)


_SAFE = ["integer", "numeric(10,2)", "character varying(33)", "timestamp with time zone", "integer[]", "bit(5)", 'my."Type"', "numeric(10, 2)[]"]


@query(f"""select name, name in ({", ".join(f"'{n}'" for n in _SAFE)}) safe from (values {_INLINE}) t(name)""")
def datatype_whitelist(spark, sf_dir):
    return spark.createDataFrame([(n, types.is_safe_datatype(n)) for n in _NAMES], "name string, safe boolean")


@query("""select dbname, min_by(name, place) as name from (values ('sales', 'weirflow_sales', 1), ('sales', 'weirflow_sales_eu', 2), ('hr', 'weirflow_hr', 1), ('hr', 'weirflow_hr_eu', 2), ('ops', 'weirflow_ops', 1)) c(dbname, name, place)
    where name in ('weirflow_sales_eu', 'weirflow_hr', 'weirflow_hr_eu', 'other') group by dbname""")
def slot_lookup(spark, sf_dir):
    rows = [(d, n, k) for d, p in (("sales", "eu"), ("hr", "eu"), ("ops", None)) for k, n in enumerate(names.slot_candidates(d, p), 1)]
    slots = spark.createDataFrame([("weirflow_sales_eu",), ("weirflow_hr",), ("weirflow_hr_eu",), ("other",)], "name string")
    return servers.slot_of(spark.createDataFrame(rows, "dbname string, name string, place int"), slots)


_VERSIONS = [90300, 90400, 90420, 90421, 90515, 90516, 90611, 90612, 100006, 100007, 110001, 110002, 120000, 160003]


@query(f"""select cast(version as int) as version, case when version < 90400 then 'unsupported' when (version between 90400 and 90420) or (version between 90500 and 90515) or (version between 90600 and 90611) or (version between 100000 and 100006) or (version between 110000 and 110001) then 'faulty' else 'ok' end verdict
    from (values {', '.join(f'({v})' for v in _VERSIONS)}) t(version)""")
def version_gate(spark, sf_dir):
    return servers.gated(spark, spark.createDataFrame([(v,) for v in _VERSIONS], "version int"))


# --- change log ----------------------------------------------------------------------------------

#: The log is made of ``events``: their type is the table, errors are deletes, three share a position.
_LSN = f"({BASE} + (event_id // 3) * 1000)"
_BROKEN = "event_id % 97 = 0"
LOGGED = {"event_id": "bigint", "ts": "timestamp without time zone", "value": "numeric(18,4)", "props": "jsonb", "user_id": "integer", "seen": "date"}


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lsn, payload) of a synthetic change log; some payloads aren't JSON."""
    e = _table(spark, sf_dir, "events")
    key = F.concat(F.lit('{"name":"event_id","value":'), F.col("event_id"), F.lit("}"))
    rest = F.concat(
        F.lit(',{"name":"ts","value":"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('"},{"name":"value","value":'), F.col("value").cast("decimal(18,4)"),
        F.lit('},{"name":"props","value":'), F.regexp_replace(F.to_json(F.struct(F.col("props").alias("p"))), r'^\{"p":|\}$', ""), F.lit('},{"name":"user_id","value":'), F.col("user_id"),
        F.lit('},{"name":"seen","value":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"}'),
    )
    action = F.when(F.col("event_type") == "error", "D").when(F.col("event_id") % 2 == 0, "U").otherwise("I")
    body = F.when(action == "D", F.concat(F.lit('"identity":['), key, F.lit("]"))).otherwise(F.concat(F.lit('"columns":['), key, rest, F.lit("]")))
    payload = F.concat(F.lit('{"action":"'), action, F.lit('","schema":"public","table":"'), F.col("event_type"), F.lit('",'), body, F.lit("}"))
    position = F.lit(BASE) + F.expr("event_id div 3") * 1000
    return e.select(position.alias("lsn"), F.when(F.col("event_id") % 97 == 0, "not json").otherwise(payload).alias("payload"))


def _streams(spark: SparkSession, tables: list[str]) -> DataFrame:
    return spark.createDataFrame([("public", t, f"public-{t}") for t in tables], "schema string, `table` string, stream string")


_ROUTED = f"from events where not ({_BROKEN}) and event_type in ('error', 'click', 'purchase')"


@query(f"select 'public-' || event_type stream, case when event_type = 'error' then 'D' when event_id % 2 = 0 then 'U' else 'I' end as action, count(*) n {_ROUTED} group by all")
def wal_route(spark, sf_dir):
    routed = changelog.route(changelog.parse(change_log(spark, sf_dir)), _streams(spark, ["error", "click", "purchase"]))
    return routed.groupBy("stream", "action").agg(F.count("*").alias("n"))


@query(f"select {_LSN} lsn, 'not json' payload from events where {_BROKEN}")
def wal_dead_letters(spark, sf_dir):
    return changelog.unreadable(changelog.parse(change_log(spark, sf_dir)))


@query(f"""select event_id, {_ISO.format('ts')} ts, cast(value as decimal(18,4)) as value, try_cast(json_extract_string(props, '$.k') as bigint) k, cast(user_id as int) user_id, strftime(ts, '%Y-%m-%d') || 'T00:00:00+00:00' seen
    from events where not ({_BROKEN}) and event_type = 'click'""")
def wal_decode(spark, sf_dir):
    routed = changelog.route(changelog.parse(change_log(spark, sf_dir)), _streams(spark, ["click"]))
    rows = changelog.assemble(routed, LogStream("public-click", "public", "click", 1, LOGGED), EXTRACTED)
    return rows.select("event_id", "ts", "value", F.try_variant_get("props", "$.k", "bigint").alias("k"), "user_id", "seen")


@query(f"""select event_id, case when event_type = 'error' then null else cast(user_id as int) end user_id, case when event_type = 'error' then '{EXTRACTED}' end _sdc_deleted_at, cast({_LSN} as varchar) _sdc_lsn,
    case when event_type = 'error' then 'event_id' else 'event_id,user_id' end present
    from events where not ({_BROKEN}) and event_type in ('error', 'view')""")
def wal_record_assembly(spark, sf_dir):
    routed = changelog.route(changelog.parse(change_log(spark, sf_dir)), _streams(spark, ["error", "view"]))
    out = None
    for table in ("error", "view"):
        stream = LogStream(f"public-{table}", "public", table, 1, {"event_id": "bigint", "user_id": "integer"})
        rows = changelog.assemble(routed, stream, EXTRACTED, debug_lsn=True)
        chosen = F.array_join(F.array_sort(F.array_intersect("_present", F.array(F.lit("event_id"), F.lit("user_id")))), ",")
        rows = rows.select("event_id", "user_id", "_sdc_deleted_at", "_sdc_lsn", chosen.alias("present"))
        out = rows if out is None else out.union(rows)
    return out


@query(f"select lsn, lag(lsn) over (order by lsn) fully_processed from (select distinct {_LSN} lsn from events)")
def fully_processed_lsn(spark, sf_dir):
    return lsn.fully_processed(change_log(spark, sf_dir))


def _committed(positions: DataFrame) -> DataFrame:
    """stream and committed_lsn of each stream, each a session of its own; there are few."""
    out = None
    for r in positions.select("stream").distinct().collect():
        one = changelog.committed(positions.where(F.col("stream").eqNullSafe(F.lit(r["stream"])))).select(F.lit(r["stream"]).cast("string").alias("stream"), "committed_lsn")
        out = one if out is None else out.union(one)
    return positions.select("stream", F.col("lsn").alias("committed_lsn")).limit(0) if out is None else out


@query(f"select event_type as stream, min({_LSN}) committed_lsn from events where event_type <> 'view' group by event_type")
def committed_min_lsn(spark, sf_dir):
    e = _table(spark, sf_dir, "events").where("event_type <> 'view'")
    positions = e.select(F.col("event_type").alias("stream"), (F.lit(BASE) + F.expr("event_id div 3") * 1000).alias("lsn"))
    return _committed(positions)


@query(f"select count(*) n, max({_LSN}) top from events where {_LSN} <= (select {BASE} + max(event_id) // 6 * 1000 from events)")
def end_lsn(spark, sf_dir):
    last = _table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    log = changelog.until(changelog.parse(change_log(spark, sf_dir)), BASE + last // 6 * 1000)
    return log.agg(F.count("*").alias("n"), F.max("lsn").alias("top"))


_POSITIONS = [(None, 50, None), (40, 50, None), (60, 50, None), (40, None, 30), (40, 50, 40), (45, 50, 40), (50, 50, 49)]


@query("select committed, processed, flushed, case when committed is not null and (processed is null or committed <= processed) and (flushed is null or committed > flushed) then committed end flush from (values (null, 50, null), (40, 50, null), (60, 50, null), (40, null, 30), (40, 50, 40), (45, 50, 40), (50, 50, 49)) t(committed, processed, flushed)")
def flush_position(spark, sf_dir):
    rows = [(*p, changelog.next_flush(*p)) for p in _POSITIONS]
    return spark.createDataFrame(rows, "committed int, processed int, flushed int, flush int")


@query(f"select l.event_type as stream, greatest(c.complete, l.committed) lsn from (select event_type, min({_LSN}) committed from events group by event_type) l, (select max(x) complete from (select distinct {_LSN} x from events) where x < (select max({_LSN}) from events)) c")
def finalize_lsn(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    positions = e.select(F.col("event_type").alias("stream"), (F.lit(BASE) + F.expr("event_id div 3") * 1000).alias("lsn"))
    complete = lsn.last_complete(change_log(spark, sf_dir)).first()["complete"]
    rows = [(r["stream"], changelog.final_position(complete, r["committed_lsn"])) for r in _committed(positions).collect()]
    return spark.createDataFrame(rows, "stream string, lsn long")


@query(f"select distinct event_type as stream, unnest(['props', 'seen', 'ts', 'value']) as name from events where not ({_BROKEN}) and event_type <> 'error'")
def schema_drift(spark, sf_dir):
    known = _streams(spark, ["error", "view", "signup", "click", "purchase"]).select("schema", "table", F.array(F.lit("event_id"), F.lit("user_id")).alias("names"))
    return changelog.drift(changelog.parse(change_log(spark, sf_dir)), known).select(F.col("table").alias("stream"), "name")


_LOG_TIMES = [
    ("2024-01-31 12:30:45.123456", "2024-01-31T12:30:45.123456+00:00"), ("2024-01-31 12:30:45", "2024-01-31T12:30:45+00:00"), ("2024-01-31 12:30:45.5+02", "2024-01-31T12:30:45.500000+02:00"),
    ("9999-12-31 23:59:59.999", "9999-12-31T23:59:59.999000+00:00"), ("9999-12-31 23:59:59.9999", temporal.TOP_TIMESTAMP), ("10000-01-01 00:00:00", temporal.TOP_TIMESTAMP),
    ("0044-03-15 00:00:00 BC", temporal.TOP_TIMESTAMP), ("infinity", temporal.TOP_TIMESTAMP), ("9999-12-31 23:00:00-05", temporal.TOP_TIMESTAMP), ("2024-02-30 00:00:00", temporal.TOP_TIMESTAMP),
    ("0001-01-01 00:00:00", "0001-01-01T00:00:00+00:00"), ("2024-01-31 12:30:45-05:30", "2024-01-31T12:30:45-05:30"),
]


@query(f"select e.event_id, t.iso from events e join (values {', '.join(f'({k}, $${iso}$$)' for k, (_, iso) in enumerate(_LOG_TIMES))}) t(k, iso) on e.event_id % {len(_LOG_TIMES)} = t.k")
def wal_timestamp(spark, sf_dir):
    given = F.element_at(F.array(*[F.lit(t) for t, _ in _LOG_TIMES]), (F.col("event_id") % len(_LOG_TIMES) + 1).cast("int"))
    return _table(spark, sf_dir, "events").select("event_id", temporal.log_timestamp(given).alias("iso"))


@query("select event_id, case when event_id % 4 = 0 then '9999-12-31' else strftime(ts, '%Y-%m-%d') end || 'T00:00:00+00:00' iso from events")
def wal_date(spark, sf_dir):
    text = F.when(F.col("event_id") % 4 == 0, "10000-01-01").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return _table(spark, sf_dir, "events").select("event_id", temporal.log_date(text).alias("iso"))


@query("""select event_id, '[[' || event_id || ', null], [' || user_id || ', -1]]' as nested, len([1, 2]) as n, event_type as first, 'a"b, c' as second from events""")
def wal_array(spark, sf_dir):
    nested = F.concat(F.lit("{{"), F.col("event_id"), F.lit(",NULL},{"), F.col("user_id"), F.lit(",-1}}"))
    flat = literals.flat_array(F.concat(F.lit("{"), F.col("event_type"), F.lit(',"a\\"b, c"}')))
    return _table(spark, sf_dir, "events").select("event_id", literals.array_json(nested, "integer").alias("nested"), F.size(flat).cast("bigint").alias("n"), flat[0].alias("first"), flat[1].alias("second"))


@query("""select event_id, event_type as k, 'x "y", z=>1' as q, cast(null as varchar) as nothing, 3 as n from events""")
def wal_hstore(spark, sf_dir):
    text = F.concat(F.lit('k=>"'), F.col("event_type"), F.lit('", "q"=>"x \\"y\\", z=>1", nothing=>NULL'))
    m = literals.hstore(text)
    return _table(spark, sf_dir, "events").select("event_id", m["k"].alias("k"), m["q"].alias("q"), m["nothing"].alias("nothing"), F.size(m).alias("n"))


# --- what consumers make of it -------------------------------------------------------------------


@query("select event_id, user_id, value from (select *, row_number() over (partition by user_id order by event_id desc) r from events) where r = 1 and event_type <> 'error'")
def cdc_latest_state(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.when(F.col("event_type") == "error", EXTRACTED).alias("_sdc_deleted_at"))
    return apply.latest_state(rows, ["user_id"], "event_id", "_sdc_deleted_at").select("event_id", "user_id", "value")


@query("""with c as (select c_custkey id, c_name as name, 0 p, false d from customer union all select user_id, event_type, event_id + 1, event_type = 'error' from events)
    select id, name from (select *, row_number() over (partition by id order by p desc) r from c) where r = 1 and not d""")
def snapshot_log_merge(spark, sf_dir):
    base = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    log = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("name"), (F.col("event_id") + 1).alias("_lsn"), F.when(F.col("event_type") == "error", EXTRACTED).alias("_sdc_deleted_at"))
    base = base.withColumn("_sdc_deleted_at", F.lit(None).cast("string"))
    return apply.merged(base, log, ["id"], 0).select("id", "name")


@query("select o_orderkey, 2 as version from orders where o_orderkey % 3 <> 0")
def activate_version(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.lit("public-orders").alias("stream"))
    both = orders.withColumn("version", F.lit(1)).union(orders.where("o_orderkey % 3 <> 0").withColumn("version", F.lit(2)))
    return apply.active(both).select("o_orderkey", "version")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(f"select {_LINE}, seq from (select {_LINE}, row_number() over (order by {_LINE}) seq from lineitem) where seq % 1000 = 0")
def state_cadence(spark, sf_dir):
    keys = _LINE.split(", ")
    rows = snapshot.numbered(_table(spark, sf_dir, "lineitem").select(*keys), [F.col(k) for k in keys], F.expr("l_orderkey div 256"))
    return snapshot.cadence(rows, snapshot.FULL_EVERY)


@query("""select b as batch, n, (b // 4) as file, (b + 1) % 4 = 0 fills from (select (l_orderkey // 100) b, 7000 n from lineitem group by 1) where b = b order by b""".replace("(b // 4)", "((row_number() over (order by b) - 1) // 4)").replace("(b + 1) % 4 = 0", "row_number() over (order by b) % 4 = 0"))
def batch_assignment(spark, sf_dir):
    incoming = _table(spark, sf_dir, "lineitem").select(F.expr("l_orderkey div 100").alias("batch")).distinct().withColumn("n", F.lit(7000))
    return batches.assign(incoming, 25_000, "batch", "n")


@query("select event_type as stream, count(*) n from events group by event_type")
def row_metrics(spark, sf_dir):
    changes = _table(spark, sf_dir, "events").select(F.lit("public").alias("schema"), F.col("event_type").alias("table"), F.col("event_id").alias("lsn"))
    return changelog.counts(changes).select(F.col("table").alias("stream"), "n")


@query("""select n_nationkey as _order_0, 'RECORD' as type, 'public-nation' as stream, cast(7 as bigint) as version, '2024-02-01T00:00:00+00:00' time_extracted,
    '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_none":null,"n_regionkey":' || n_regionkey || '}' record from nation""")
def record_messages(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").withColumn("n_none", F.lit(None).cast("string"))
    return messages.record_messages(rows, "public-nation", 7, EXTRACTED, {c: F.col(c) for c in rows.columns}, ["n_nationkey"])


# --- discovery, catalog and state ----------------------------------------------------------------

_KEYS = {"region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",), "supplier": ("s_suppkey",), "part": ("p_partkey",), "orders": ("o_orderkey",), "events": ("event_id",)}


def _source(spark: SparkSession, sf_dir: str) -> ParquetSource:
    return ParquetSource(spark, sf_dir, TABLES, facts={t: Fact(k) for t, k in _KEYS.items()})


_DUCK_TYPES = "case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'integer' when 'DOUBLE' then 'double precision' when 'VARCHAR' then 'text' when 'TIMESTAMP' then 'timestamp without time zone' end"
_DUCK_KEYS = ", ".join(f"('{t}', '{k[0]}')" for t, k in _KEYS.items())


@query(f"""select 'public-' || table_name tap_stream_id, column_name, {_DUCK_TYPES} sql_datatype, case when (table_name, column_name) in ({_DUCK_KEYS}) then 'automatic' else 'available' end inclusion, true selected_by_default,
    case data_type when 'BIGINT' then -9223372036854775808 when 'INTEGER' then -2147483648 end::bigint minimum
    from information_schema.columns where table_schema = 'main' and table_name in ({', '.join(f"'{t}'" for t in TABLES)})""")
def discovery_columns(spark, sf_dir):
    scan = catalog.column_scan(spark, _source(spark, sf_dir).relations())
    rows = []
    for entry in catalog.discover(scan, "local"):
        for m in entry["metadata"][1:]:
            name, facts = m["breadcrumb"][1], m["metadata"]
            rows.append((entry["tap_stream_id"], name, facts["sql-datatype"], facts["inclusion"], facts["selected-by-default"], entry["schema"]["properties"][name].get("minimum")))
    return spark.createDataFrame(rows, "tap_stream_id string, column_name string, sql_datatype string, inclusion string, selected_by_default boolean, minimum long")


@query("select distinct table_name from information_schema.columns where table_schema = 'main' and table_name in ('nation', 'region')")
def filter_schemas(spark, sf_dir):
    relations = [catalog.Relation("geo" if r.name in ("nation", "region") else "trade", r.name, r.frame, r.keys) for r in _source(spark, sf_dir).relations()]
    relations.append(catalog.Relation("pg_catalog", "pg_class", relations[0].frame))
    return catalog.visible(catalog.column_scan(spark, relations), ["geo", "pg_catalog"]).select("table_name").distinct()


@query("""select * from (values ('public', 't', 'a', 'integer', false, false, true), ('public', 't', 'b', 'integer', false, false, false), ('public', 't', 'c', 'text', true, false, false), ('public', 't', 'd', 'mood', true, true, false), ('public', 't', 'e', 'integer', true, false, false), ('public', 't', 'f', 'integer', true, false, false))
    t(schema_name, table_name, column_name, type, is_array, is_enum, is_key)""")
def catalog_joins(spark, sf_dir):
    """Domains, arrays, enum arrays, a domain over an array and an array of domains, from system-catalog tables."""
    frame = spark.createDataFrame
    classes = frame([(100, 1, "t", "r", 5)], "oid long, namespace long, name string, kind string, row_count long")
    namespaces = frame([(1, "public")], "oid long, schema_name string")
    attributes = frame([(100, 1, "a", 23), (100, 2, "b", 50), (100, 3, "c", 60), (100, 4, "d", 61), (100, 5, "e", 51), (100, 6, "f", 62)], "relation long, number int, name string, type long")
    kinds = frame([(23, "integer", 0, 0, "b"), (25, "text", 0, 0, "b"), (50, "quantity", 23, 0, "d"), (60, "_text", 0, 25, "b"), (61, "_mood", 0, 70, "b"), (70, "mood", 0, 0, "e"), (51, "list", 63, 0, "d"), (63, "_int4", 0, 23, "b"), (62, "_quantity", 0, 50, "b")], "oid long, name string, base long, element long, category string")
    keys = frame([(100, [1])], "relation long, numbers array<int>")
    return catalog.resolved_types(classes, namespaces, attributes, kinds, keys).select("schema_name", "table_name", "column_name", "type", "is_array", "is_enum", "is_key")


_NUMERICS = [(None, None), (10, 2), (12, 3), (38, 10), (120, 50), (5, 0)]


@query("""with t as (select case when p is null then 100 else least(p, 100) end p, case when s is null then 38 else least(s, 38) end s from (values (null, null), (10, 2), (12, 3), (38, 10), (120, 50), (5, 0)) t(p, s))
    select p, s, '1' || repeat('0', p - s) maximum, case when s = 0 then '1' else '0.' || repeat('0', s - 1) || '1' end multiple from t""")
def numeric_constraints(spark, sf_dir):
    rows = []
    for p, s in _NUMERICS:
        precision, scale = types.capped(p, s)
        bounds = types.numeric_bounds(precision, scale)
        rows.append((precision, scale, format(bounds["exclusiveMaximum"], "f"), format(bounds["multipleOf"], "f")))
    return spark.createDataFrame(rows, "p int, s int, maximum string, multiple string")


@query("""select * from (values ('', 'selected', 'true'), ('', 'row-count', '20'), ('', 'schema-name', 'public'), ('a', 'sql-datatype', 'bigint'), ('a', 'selected', 'false'), ('c', 'sql-datatype', 'text')) t(place, key, value)""")
def metadata_merge(spark, sf_dir):
    schema = "place string, key string, value string"
    old = spark.createDataFrame([("", "selected", "true"), ("", "row-count", "10"), ("a", "sql-datatype", "integer"), ("a", "selected", "false"), ("b", "selected", "true")], schema)
    fresh = spark.createDataFrame([("", "row-count", "20"), ("", "schema-name", "public"), ("a", "sql-datatype", "bigint"), ("c", "sql-datatype", "text")], schema)
    return catalog.merged_metadata(old, fresh)


@query("select * from (values ('t', 'a'), ('t', 'b'), ('t', 'd')) t(stream, \"column\")")
def column_selection(spark, sf_dir):
    rows = [("t", "a", "automatic", "false"), ("t", "b", "available", None), ("t", "c", "available", "false"), ("t", "d", "available", "TRUE"), ("t", "e", "unsupported", "true"), ("t", "f", "available", "no")]
    return catalog.column_selection(spark.createDataFrame(rows, "stream string, column string, inclusion string, selected string")).select("stream", "column")


@query("select * from (values ('public-a', 'public', 'a'), ('my-schema-b', 'my-schema', 'b')) t(tap_stream_id, schema_name, table_name)")
def catalog_normalize(spark, sf_dir):
    entries = [{"tap_stream_id": "public-a", "stream": "a", "schema": {"properties": {}}}, {"tap_stream_id": "my-schema-b", "stream": "b", "table_name": "b", "schema": {"properties": {}}, "metadata": []}]
    rows = []
    for e in entries:
        s = catalog.Stream(e)
        s.normalize()
        rows.append((s.id, s.schema_name, s.table))
    return spark.createDataFrame(rows, "tap_stream_id string, schema_name string, table_name string")


_STATES = [("a", None, "FULL_TABLE", None, None), ("b", "FULL_TABLE", "LOG_BASED", None, None), ("c", "INCREMENTAL", "INCREMENTAL", "k", "k"), ("d", "INCREMENTAL", "INCREMENTAL", "k", "m"), ("e", "LOG_BASED", "LOG_BASED", None, None)]
_STATE_ROWS = "(values ('a', null, 'FULL_TABLE', null, null), ('b', 'FULL_TABLE', 'LOG_BASED', null, null), ('c', 'INCREMENTAL', 'INCREMENTAL', 'k', 'k'), ('d', 'INCREMENTAL', 'INCREMENTAL', 'k', 'm'), ('e', 'LOG_BASED', 'LOG_BASED', null, null)) t(stream, was, method, was_key, key)"


@query(f"select stream, coalesce(was <> method, false) or (method = 'INCREMENTAL' and was_key is not null and was_key is distinct from key) as is_reset from {_STATE_ROWS}")
def state_reset(spark, sf_dir):
    given = spark.createDataFrame(_STATES, "stream string, was string, method string, was_key string, key string")
    return given.select("stream", state.is_reset(F.col("was"), F.col("method"), F.col("was_key"), F.col("key")).alias("is_reset"))


@query("select * from (values ('a', 'snapshot'), ('b', 'snapshot'), ('c', 'logical'), ('d', 'inconsistent')) t(stream, work)")
def classify_work(spark, sf_dir):
    given = spark.createDataFrame([("a", None, None), ("b", 5, 7), ("c", None, 7), ("d", 5, None)], "stream string, xmin long, lsn long")
    return given.select("stream", state.classified(F.col("xmin"), F.col("lsn")).alias("work"))


@query("select * from (values ('orders', 1), ('events', 2), ('nation', 3), ('part', 4)) t(stream, place)")
def schedule_order(spark, sf_dir):
    streams = spark.createDataFrame([("part",), ("orders",), ("nation",), ("events",)], "stream string")
    ordered = [r["stream"] for r in state.scheduled(streams, "orders").collect()]  # a row for each stream
    return spark.createDataFrame([(s, k) for k, s in enumerate(ordered, 1)], "stream string, place int")


@query("select * from (values ('c')) t(stream)")
def deselected_bookmarks(spark, sf_dir):
    bookmarks = spark.createDataFrame([("a", 5), ("b", None), ("c", 7)], "stream string, lsn long")
    return state.deselected(bookmarks, spark.createDataFrame([("a",)], "stream string")).select("stream")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record messages of the first page of an incremental read of ``orders``."""
    rows = incremental.incremental(_table(spark, sf_dir, "orders"), ORDERS, "o_orderdate", "1997-01-01T00:00:00", "timestamp_ntz", 50, ["o_orderkey"])
    stored = dict(rows.dtypes)
    shown = {c: convert.snapshot_value(names.ref(c), t, stored[c]) for c, t in ORDERS.items()}
    return messages.record_messages(rows, "public-orders", 1, EXTRACTED, shown, ["o_orderdate", "o_orderkey"])
