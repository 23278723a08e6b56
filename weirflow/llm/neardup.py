"""Near-duplicate detection by HyperMinHash (operator 1).

A sketch has one register for each of ``m`` buckets.  A shingle's hash picks its bucket; the smallest
value of a bucket is stored as its leading-zero count (6 bits) and the 10 bits that follow.  A bucket that
no shingle picks takes the smallest value of a hash of its own over all shingles, so that each register of
two sets agrees with the probability of their Jaccard similarity, however short the texts are.  Bands of
``ROWS`` registers give candidates; the share of equal registers, corrected for the chance collisions of
such short registers, rules out those that are far from the threshold; the rest are confirmed on the full
shingle sets.

Texts with one shingle set are one node.  In a bucket of a band, nodes are first compared with one
pivot, and those that stay apart with other pivots.  Nodes of a bucket that are then still in different
components may yet be linked: their candidates come from a prefix filter, which misses no pair that reaches
the threshold and offers few others, as it goes by their rarest shingles.  So no link that a band offers between
two components is lost, and the members of a large group are not paired with each other.

Cases: null, empty and blank texts have no shingle and link with nothing; a text of fewer words than a
shingle is one shingle; equal rows give equal rows; a null doc_id takes part in links, is never a
component_id, and is not kept; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MANTISSA = 10
#: Probability that a pair just at the threshold shares no band.
MISS = 1e-6
#: Registers that are stored for the estimate.
ESTIMATE = 128
#: Rows of a file of labels while components are found.
LABELS_IN_A_FILE = 200_000
#: Counts in the table that orders shingles by rarity.
SLOTS = 1 << 19
#: The estimate rules out pairs this many standard deviations below the threshold.
SIGMAS = 6.0


def band_shape(threshold: float) -> tuple[int, int]:
    """Rows of a band and number of bands: pairs at the threshold meet with probability 1 - MISS."""
    rows = max(2, min(8, int(math.log(0.27) / math.log(threshold)))) if threshold < 1 else 8
    hit = min(threshold, 0.999) ** rows
    return rows, max(math.ceil(math.log(MISS) / math.log1p(-hit)), -(-ESTIMATE // rows))


class Sketcher:
    def __init__(self, rows: int, bands: int):
        self.rows, self.bands, self.m = rows, bands, rows * bands
        own = common.mix(np.arange(1, 2 * self.m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.plus, self.times = own[: self.m], own[self.m :] | np.uint64(1)
        self.salts = common.mix(np.arange(1000, 1000 + bands, dtype=np.uint64))

    def values(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest 64-bit value of each bucket over distinct shingles (at least one)."""
        first = common.mix(shingles ^ np.uint64(0x51ED270B0F4D2C5A))
        bucket = ((first >> np.uint64(20)) % np.uint64(self.m)).astype(np.int64)
        out = np.full(self.m, common.M64)
        np.minimum.at(out, bucket, common.mix(first + np.uint64(0x632BE59BD9B4E019)))
        empty = np.flatnonzero(np.bincount(bucket, minlength=self.m) == 0)
        step = max(1, 500_000 // len(shingles))
        for k in range(0, len(empty), step):
            e = empty[k : k + step]
            x = (shingles[None, :] + self.plus[e, None]) * self.times[e, None]
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            out[e] = x.min(axis=1)
        return out

    def registers(self, shingles: np.ndarray) -> np.ndarray:
        v = self.values(shingles) | np.uint64(1)
        zeros = np.uint64(64) - np.frexp((v >> np.uint64(11)).astype(np.float64) * 2048.0 + 1.0)[1].astype(np.uint64)
        rest = (v << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
        return ((zeros << np.uint64(MANTISSA)) | rest).astype(np.uint16)

    def keys(self, registers: np.ndarray) -> np.ndarray:
        out = self.salts.copy()
        for column in registers.reshape(self.bands, self.rows).T.astype(np.uint64):
            out = common.mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
        return out.view(np.int64)


def chance(a: int, b: int) -> float:
    """Probability that registers of two disjoint sets of these sizes agree by chance."""
    width = 2.0 ** -np.arange(1, 41)  # a level's values are [width, 2 width), in 2**MANTISSA cells
    cells = (width[:, None] * (1 + (np.arange(16) + 0.5) / 16)).ravel()
    cell = np.repeat(width, 16) / 2**MANTISSA
    return float(np.sum(2**MANTISSA / 16 * (a * np.exp(-a * cells) * cell) * (b * np.exp(-b * cells) * cell)))


_chances: dict[tuple[int, int], float] = {}


def estimate(x: np.ndarray, y: np.ndarray, a: int, b: int) -> float:
    """Jaccard similarity from registers, less the expected chance collisions."""
    key = (int(math.log2(a) * 4), int(math.log2(b) * 4))
    if key not in _chances:
        _chances[key] = chance(a, b)
    q = _chances[key]
    return (float(np.mean(x == y)) - q) / (1 - q)


def _hasher(size: int):
    ids = common.WordIds()
    return lambda text: np.unique(common.shingle_hashes(ids(common.words_of(text)), size))


def sketches(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """For each row: its doc_id, a number of its own, its set's size and 128-bit hash, its text's hash, band keys, registers."""

    def run(batches):
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        hashed, sketch, task, seen = _hasher(size), Sketcher(rows, bands), TaskContext.get().partitionId(), 0
        with np.errstate(over="ignore"):
            for b in batches:
                n, high, low, keys, registers = [], [], [], [], []
                for text in b.column(1).to_pylist():
                    s = hashed(text)
                    n.append(len(s))
                    if not len(s):
                        high.append(None), low.append(None), keys.append(None), registers.append(None)
                        continue
                    h = xxhash.xxh3_128_digest(s.tobytes())
                    high.append(int.from_bytes(h[:8], "little", signed=True))
                    low.append(int.from_bytes(h[8:], "little", signed=True))
                    r = sketch.registers(s)
                    keys.append(sketch.keys(r))
                    registers.append(r[:ESTIMATE].tobytes())
                rows_ = (np.arange(seen, seen + len(n), dtype=np.int64)) | (task << 36)
                seen += len(n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), b.column(3), pa.array(rows_), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(registers, pa.binary())],
                    ["doc_id", "text_a", "text_b", "row", "n_shingles", "set_a", "set_b", "keys", "registers"],
                )

    # two hashes find the text of a node again, whatever its doc_id is
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *text_hashes())
    return given.mapInArrow(common.releasing(run), "doc_id long, text_a long, text_b long, row long, n_shingles long, set_a long, set_b long, keys array<long>, registers binary")


def text_hashes(a: str = "text_a", b: str = "text_b") -> list:
    return [F.xxhash64("text").alias(a), F.xxhash64(F.lit(7), "text", F.length("text")).alias(b)]


def has_words() -> Column:
    """Whether a text has a shingle at all."""
    return F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def confirmed(pairs: DataFrame, nodes: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets reach the threshold."""
    low = float(threshold) - SIGMAS * math.sqrt(float(threshold) * max(1 - float(threshold), 0.01) / ESTIMATE)
    over, under = threshold.numerator, threshold.denominator

    def run(batches):
        import pyarrow as pa

        hashed, sets = _hasher(size), OrderedDict()

        def of(node, text):
            s = sets.get(node)
            if s is None:
                s = sets[node] = hashed(text)
                if len(sets) > 64:
                    sets.popitem(last=False)
            return s

        with np.errstate(over="ignore"):
            for batch in batches:
                rows = batch.to_pydict()
                a, b = [], []
                for x, y, tx, ty, rx, ry, nx, ny in zip(*(rows[c] for c in ("a", "b", "text_x", "text_y", "reg_x", "reg_y", "n_x", "n_y"))):
                    if under * min(nx, ny) < over * max(nx, ny):
                        continue  # even a subset would be too small
                    if estimate(np.frombuffer(rx, np.uint16), np.frombuffer(ry, np.uint16), nx, ny) < low:
                        continue
                    both = len(np.intersect1d(of(x, tx), of(y, ty), assume_unique=True))
                    if under * both >= over * (nx + ny - both):
                        a.append(x), b.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def side(node: str, mark: str) -> DataFrame:
        return nodes.select(F.col("node").alias(node), F.col("text").alias(f"text_{mark}"), F.col("registers").alias(f"reg_{mark}"), F.col("n_shingles").alias(f"n_{mark}"))

    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return both.select("a", "b", "text_x", "text_y", "reg_x", "reg_y", "n_x", "n_y").mapInArrow(common.releasing(run), "a long, b long")


def rare_prefixes(nodes: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """(token, node, component, outside, n, place) of each node's rarest shingles.

    Two sets that reach the threshold share one of their ``n - ceil(t n) + 1`` first shingles in any common
    order.  The order is by how often a shingle's slot of a fixed table is met among these nodes, so that what
    a group of copies has in common comes last.  The table has SLOTS counts, however many nodes there are.
    """
    spark = nodes.sparkSession

    def count(batches):
        import pyarrow as pa

        hashed, total = _hasher(size), np.zeros(SLOTS, np.int64)
        with np.errstate(over="ignore"):
            for b in batches:
                for text in b.column(0).to_pylist():
                    np.add.at(total, (hashed(text) % np.uint64(SLOTS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])

    counted = nodes.select("text").mapInArrow(common.releasing(count), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(SLOTS, np.int64)
    table[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    held = spark.sparkContext.broadcast(table.clip(max=2**31 - 1).astype(np.int32))

    def prefix(batches):
        import pyarrow as pa

        hashed, common_ = _hasher(size), held.value
        with np.errstate(over="ignore"):
            for b in batches:
                tokens, node, at = [], [], []
                for k, text in enumerate(b.column(0).to_pylist()):
                    s = hashed(text)
                    most = len(s) - -(-len(s) * threshold.numerator // threshold.denominator) + 1
                    first = s[np.lexsort((s, common_[(s % np.uint64(SLOTS)).astype(np.int64)]))[:most]]
                    tokens.append(first.view(np.int64))
                    node.append(np.full(len(first), k))
                    at.append(np.arange(1, len(first) + 1))
                owner = pa.array(np.concatenate(node))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), *[b.column(c).take(owner) for c in (1, 2, 3, 4)], pa.array(np.concatenate(at))], ["token", "node", "component", "outside", "n", "place"])

    return nodes.select("text", "node", "component", "outside", "n_shingles").mapInArrow(common.releasing(prefix), "token long, node long, component long, outside boolean, n long, place long")


def prefix_pairs(prefixes: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may reach the threshold.

    They share a token at places from which enough shingles follow in both for the overlap that is needed.
    """
    over, under = threshold.numerator, threshold.denominator
    a = prefixes.where("outside").select("token", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("place").alias("pa"))
    b = prefixes.select("token", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("place").alias("pb"), "outside")
    near = (F.col("na") * under >= F.col("nb") * over) & (F.col("nb") * under >= F.col("na") * over)
    enough = (1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))) * (over + under) >= (F.col("na") + F.col("nb")) * over
    once = ~F.col("outside") | (F.col("a") < F.col("b"))
    return a.join(b, "token").where((F.col("ca") != F.col("cb")) & near & enough & once).select("a", "b")


def components(edges: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(node, component) of the nodes that have edges (a, b); the component is its smallest node."""
    parts = 1 + 2 * edges.count() // LABELS_IN_A_FILE  # each round writes its labels: few links make few files
    both = scratch.keep(edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a")).coalesce(parts), "edges")
    labels = scratch.keep(both.groupBy("node").agg(F.least("node", F.min("to")).alias("component")).coalesce(parts), "labels")
    while True:
        around = scratch.keep(both.join(labels.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("component").alias("least")).coalesce(parts), "around")
        lower = scratch.keep(labels.join(around, "node").select("node", "component", F.least("component", "least").alias("next")).coalesce(parts), "lower")
        # a component's own label may have fallen meanwhile: jump to it
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("jumped"))
        new = scratch.keep(lower.join(jump, "next").select("node", F.col("jumped").alias("component"), (F.col("jumped") != F.col("component")).alias("moved")).coalesce(parts), "labels")
        moved = new.where("moved").limit(1).count()
        scratch.drop(around, lower, labels)
        labels = new
        if not moved:
            scratch.drop(both)
            return labels.select("node", "component")


def linked(docs: DataFrame, size: int, threshold: Fraction, scratch: common.Scratch, hashes: bool = False) -> tuple[DataFrame, DataFrame]:
    """Every row with its node (null without a shingle), and (node, component) of the nodes that have links.

    Rows that aren't their node's first have their text's hashes only where ``hashes`` asks for them.
    """
    spark = docs.sparkSession
    common.arrow_rows(spark, 500)
    rows, bands = band_shape(float(threshold))
    made = scratch.keep(sketches(docs, size, rows, bands), "sketches")

    # One node for each shingle set: the smallest row that has it.
    sets = scratch.keep(made.where("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id")), "sets")
    own = F.col("row") == F.col("node")
    full = made.where("n_shingles > 0").join(sets, ["set_a", "set_b"])
    texts = [F.col(c) if hashes else F.when(own, F.col(c)).alias(c) for c in ("text_a", "text_b")]
    full = full.select("doc_id", "n_shingles", "node", "first_id", own.alias("own"), *[F.when(own, F.col(c)).alias(c) for c in ("keys", "registers")], *texts)
    none = made.where("n_shingles = 0").selectExpr("doc_id", "n_shingles", "cast(null as long) node", "doc_id first_id", "false own", "cast(null as array<long>) keys", "cast(null as binary) registers", "0L text_a", "0L text_b")
    placed = scratch.keep(full.union(none), "placed")
    scratch.drop(made, sets)

    # Buckets of at least two nodes, with their members.
    nodes = placed.where("own")
    banded = nodes.select(F.explode("keys").alias("key"), "node")
    shared = scratch.keep(banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    members = scratch.keep(banded.join(shared, "key"), "members")
    scratch.drop(shared)
    involved = scratch.keep(members.groupBy("node").agg(F.sum("n").alias("weight")), "involved")
    sought = scratch.keep(nodes.select("node", "n_shingles", "registers", "text_a", "text_b").join(involved, "node"), "sought")
    # Copies of one text are one key: each task takes one of them before texts move.
    texts = docs.where("text is not null").select("text", *text_hashes()).groupBy("text_a", "text_b").agg(F.first("text").alias("text"))
    found = texts.join(sought, ["text_a", "text_b"]).select("node", "text", "registers", "n_shingles")
    held = scratch.keep(found.groupBy("node").agg(F.first("text").alias("text"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles")), "texts")
    scratch.drop(sought)
    common.arrow_rows(spark, 64)

    def link(pairs: DataFrame, name: str) -> DataFrame:
        one = scratch.keep(pairs.where("a <> b").selectExpr("least(a, b) a", "greatest(a, b) b").distinct(), f"pairs-{name}")
        out = scratch.keep(confirmed(one, held, size, threshold), f"links-{name}")
        scratch.drop(one)
        return out

    # First pivots: the members that meet most others, which copies of one text have in common.
    heavy = members.join(involved, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("a"))
    pivots = scratch.keep(heavy, "pivots")
    links = link(members.join(pivots, "key").select("a", F.col("node").alias("b")), "first")
    scratch.drop(pivots, involved)

    def apart(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of the buckets that more than one component meets in, and such a bucket's largest component."""
        placed_in = members.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        count = placed_in.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key")
        top = scratch.keep(count.agg(F.max(F.struct("n", "component"))["component"].alias("top"), F.count("*").alias("parts")).where("parts > 1").select("key", "top"), "tops")
        return scratch.keep(placed_in.join(top, "key"), "apart"), top

    labels = components(links, scratch)
    mixed, top = apart(labels)
    # Other pivots: each bucket's own.
    others = scratch.keep(mixed.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node", "component")).alias("p")).select("key", F.col("p.node").alias("a"), F.col("p.component").alias("c")), "pivots")
    more = link(mixed.join(others, "key").where("component <> c").select("a", F.col("node").alias("b")), "second")
    scratch.drop(mixed, top, others)
    links = scratch.keep(links.union(more), "links")
    labels = components(links, scratch)
    mixed, top = apart(labels)
    # What is still apart: exact candidates between the components, by the rarest shingles of each.
    loose = mixed.select("node", "component", (F.col("component") != F.col("top")).alias("outside"))
    loose = scratch.keep(loose.groupBy("node", "component").agg(F.max("outside").alias("outside")), "loose")
    prefixes = scratch.keep(rare_prefixes(held.join(loose, "node"), size, threshold), "prefixes")
    rest = prefix_pairs(prefixes, threshold)
    more = link(rest, "rest")
    if more.limit(1).count():
        labels = components(scratch.keep(links.union(more), "links"), scratch)
    scratch.drop(mixed, top, members, held, links, more, loose, prefixes)
    return placed, labels


def near_duplicates(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept of every row."""
    scratch = common.Scratch(docs.sparkSession, "neardup")
    placed, labels = linked(docs, size, threshold, scratch)
    nodes = placed.where("own")
    # The smallest doc_id of every component, given to its nodes and to their rows.
    firsts = nodes.select("node", "first_id").join(labels, "node")
    least = scratch.keep(firsts.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    reached = scratch.keep(labels.join(least, "component").select("node", "component_id"), "reached")
    alone = placed.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = placed.where("node is not null").join(reached, "node", "left").select("doc_id", "n_shingles", F.when(F.col("component_id").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def first_rows(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """doc_id, text_a, text_b and n of one row of each component, and of each row that has words but no link.

    It is the row of the smallest doc_id, a null one only where no row has an id, and among texts of one doc_id
    that of the smallest hashes; ``n`` rows have just this doc_id and text.
    """
    placed, labels = linked(docs, size, threshold, common.Scratch(docs.sparkSession, "neardup"), hashes=True)
    rows = placed.where("node is not null").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counted = rows.groupBy("component", "doc_id", "text_a", "text_b").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_a", "text_b", "n")
    return counted.groupBy("component").agg(F.min(order).alias("first")).select("first.doc_id", "first.text_a", "first.text_b", "first.n")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), size=3, threshold=Fraction(85, 100))


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (
  select distinct doc_id, array_to_string(list_slice(ws, k, k + 2), ' ') g
  from w, lateral (select unnest(range(1, greatest(len(ws) - 2, 1) + 1)) k) where len(ws) > 0),
n as (select doc_id, count(*) n from s group by doc_id),
shared as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select x, y from shared join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 85 * (p.n + q.n - c)),
edges as (select x, y from links union all select y, x from links),
reach as (select doc_id, doc_id other from documents union select r.doc_id, e.y from reach r join edges e on r.other = e.x),
least as (select doc_id, min(other) component_id from reach group by doc_id)
select d.doc_id, coalesce(n.n, 0) n_shingles, l.component_id, d.doc_id = l.component_id kept
from documents d join least l on l.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
"""
