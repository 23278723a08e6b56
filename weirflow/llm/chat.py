"""Chat formatting after snapshot collapse, in DataFrame operations only (operator 8).

Logs hold snapshots of conversations that go on later.  Every turn is hashed with its place, its role and
its text; the running exclusive or of these hashes (two of 64 bits) identifies each prefix of a conversation.
A conversation whose whole hash occurs as a proper prefix of another is dropped by an anti-join, and of
equal conversations the one with the smallest id stays.  What is left is rendered.

Turns go by turn, then role and text; equal rows stay and count as turns of their own.  A null role or text
is empty when rendered, and differs from the empty one in the hash.  A turn without a conv_id is a conversation
of its own, given with a null conv_id; of equal ones one stays, and that only where no conversation with an id equals
it or begins with it.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

def _turn_hashes(place: Column) -> list[Column]:
    state = [F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return [F.xxhash64(place, *state).alias("h1"), F.xxhash64(F.lit(11), place, F.length("text"), *state).alias("h2")]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), n_turns and the hash of each prefix as ``h1``, ``h2``, of turns that have a conv_id."""
    kept = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = kept.withColumn("place", F.row_number().over(order))
    rows = rows.select("conv_id", "place", *_turn_hashes(F.col("place")))
    run = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id")
    return rows.select("conv_id", "place", F.count("*").over(whole).alias("n_turns"), F.bit_xor("h1").over(run).alias("h1"), F.bit_xor("h2").over(run).alias("h2"))


def maximal(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id of the conversations that no longer one begins with, the smallest of equal ones; role and text of turns without one."""
    spark = turns.sparkSession
    scratch = common.Scratch(spark, "chat")
    hashes = scratch.keep(prefix_hashes(turns), "prefixes")
    # Equal ends and equal prefixes are aggregated before they move: a common first turn is one row.
    ends = scratch.keep(hashes.where("place = n_turns").groupBy("h1", "h2").agg(F.min("conv_id").alias("conv_id")), "ends")
    inner = scratch.keep(hashes.where("place < n_turns").select("h1", "h2").distinct(), "inner")
    out = scratch.keep(ends.join(inner, ["h1", "h2"], "left_anti").select("conv_id"), "maximal")
    loose = turns.where("conv_id is null").select("role", "text").distinct().select("role", "text", *_turn_hashes(F.lit(1)))
    alone = scratch.keep(loose.join(ends.select("h1", "h2").union(inner), ["h1", "h2"], "left_anti").select("role", "text"), "alone")
    scratch.drop(hashes, ends, inner)
    return out, alone


def rendered_turn() -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))


def render(turns: DataFrame, keep: DataFrame, alone: DataFrame) -> DataFrame:
    """conv_id, n_turns and chat of the conversations in ``keep`` and of the turns ``alone``."""
    kept = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").join(keep, "conv_id", "left_semi")
    # Sorted by what the hash is sorted by; nulls first, as there.
    line = F.struct("turn", "role", "text", rendered_turn().alias("line"))
    grouped = kept.groupBy("conv_id").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    whole = grouped.select("conv_id", F.size("lines").cast("long").alias("n_turns"), F.array_join(F.col("lines.line"), "").alias("chat"))
    return whole.union(alone.select(F.lit(None).cast("long"), F.lit(1).cast("long"), rendered_turn()))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = common.table(spark, sf_dir, "conversations")
    return render(turns, *maximal(turns))


ORACLE = """
with u as (select *, case when conv_id is null then row_number() over () end lone from conversations),
t as (select *, row_number() over (partition by conv_id, lone order by turn nulls first, role nulls first, text nulls first) p from u),
c as (select conv_id, lone, count(*) n, list(struct_pack(r := role, t := text) order by p) l from t group by conv_id, lone),
k as (select *, row_number() over (partition by l order by conv_id nulls last, lone) best from c),
m as (select a.conv_id, a.lone, a.n from k a where best = 1 and not exists (
  select 1 from c b where b.n > a.n and b.l[1] = a.l[1] and b.l[1:a.n] = a.l))
select t.conv_id, any_value(m.n) n_turns,
  string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' order by p) chat
from t join m on m.conv_id is not distinct from t.conv_id and m.lone is not distinct from t.lone group by t.conv_id, t.lone
"""
