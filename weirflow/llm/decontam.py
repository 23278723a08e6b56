"""Benchmark decontamination by MinHash containment search (operator 4).

Benchmark items are partitioned by size (number of distinct shingles, in powers of two).  An item's sample
is its ``k`` smallest shingle hashes, a bottom-k MinHash; a document that contains a share ``t`` of the
item's shingles misses at most ``(1 - t) * size`` of them, so with one more than that in the sample it
holds at least one sampled shingle.  A document is therefore a candidate of an item if any of the
sample occurs in it, and no partition whose items need more shingles than the document has is searched.
Candidates are confirmed by counting the item's shingles in the document, as words, over the whole text.

Items go to the executors in blocks of bounded bytes, and each block meets all documents; where there are several,
a block's results are written before the next one is read, so that the driver holds one.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all other non-ASCII characters; shingles
take five words.  Cases: an item or document without words contains and is contained in nothing; an item of
fewer words than a shingle is one shingle, which a document holds if it has that run of words anywhere; equal
rows give equal rows; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common

SIZE, THRESHOLD = 5, Fraction(4, 5)
#: Bytes of benchmark text that go to the executors at once.
BLOCK_BYTES = 16_000_000


def _grams(words: list[bytes], size: int) -> set[bytes]:
    if not words:
        return set()
    size = min(size, len(words))
    return {b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)}


class ItemIndex:
    """Samples of a block of items, by size partition and by width of their shingles."""

    def __init__(self, items: list[tuple], size: int, threshold: Fraction):
        self.size, self.threshold = size, threshold
        self.items = []  # (item_id, width, shingles, shingles needed)
        sampled: dict[tuple[int, int], dict[int, list[int]]] = {}
        ids = common.WordIds()
        for item_id, text in items:
            words = common.words_of(text, plain=True)
            if not words:
                continue
            grams = _grams(words, size)
            n, width = len(grams), min(size, len(words))
            need = math.ceil(threshold * n)
            self.items.append((item_id, width, grams, need))
            hashes = np.unique(common.shingle_hashes(ids(words), width))
            part = sampled.setdefault((width, n.bit_length()), {})
            for h in hashes[: n - need + 1].tolist():
                part.setdefault(h, []).append(len(self.items) - 1)
        # for each partition: the least number of shingles its items need, sampled hashes, and whose they are
        self.parts = []
        for (width, level), part in sorted(sampled.items()):
            keys = np.array(sorted(part), np.uint64)
            self.parts.append((width, math.ceil(threshold * (1 << level - 1)), keys, [part[int(k)] for k in keys]))

    def matches(self, words: list[bytes], ids: np.ndarray) -> list[tuple[int, int]]:
        """(item's place, shared shingles) of the items that the document contains."""
        found: set[int] = set()
        hashes: dict[int, np.ndarray] = {}
        for width, least, keys, owners in self.parts:
            if len(words) < width or len(words) - width + 1 < least:
                continue
            if width not in hashes:
                hashes[width] = common.shingle_hashes(ids, width)
            h = hashes[width]
            at = np.searchsorted(keys, h)
            at[at == len(keys)] = 0
            for k in np.unique(at[keys[at] == h]).tolist():
                found.update(owners[k])
        grams: dict[int, set[bytes]] = {}
        out = []
        for k in sorted(found):
            _, width, wanted, need = self.items[k]
            if width not in grams:
                grams[width] = _grams(words, width) if len(words) >= width else set()
            both = len(wanted & grams[width])
            if both >= need:
                out.append((k, both))
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, threshold: Fraction = THRESHOLD, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc_id, item_id, item_shingles, shared and containment of each document and item that it contains.

    ``keys`` are the columns that name a document.
    """
    spark = docs.sparkSession
    common.arrow_rows(spark, 500)
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(F.max(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(total[0] / BLOCK_BYTES))
    item_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"{', '.join(f'{c} {docs.schema[c].dataType.simpleString()}' for c in keys)}, item_id {item_kind}, item_shingles long, shared long, containment double"

    def search(held) -> DataFrame:
        def run(batches):
            import pyarrow as pa

            index, ids = ItemIndex(held.value, size, threshold), common.WordIds()
            with np.errstate(over="ignore"):
                for b in batches:
                    at, rows = [], []
                    for k, text in enumerate(b.column(len(keys)).to_pylist()):
                        words = common.words_of(text, plain=True)
                        for place, both in index.matches(words, ids(words)):
                            item_id, _, grams, _ = index.items[place]
                            at.append(k)
                            rows.append((item_id, len(grams), both, both / len(grams)))
                    item_id, n, both, share = zip(*rows) if rows else ((), (), (), ())
                    named = [b.column(c).take(pa.array(at, pa.int64())) for c in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*named, pa.array(item_id, item_arrow), pa.array(n, pa.int64()), pa.array(both, pa.int64()), pa.array(share, pa.float64())], [*keys, "item_id", "item_shingles", "shared", "containment"])

        return docs.select(*keys, "text").mapInArrow(common.releasing(run), schema)

    def block(k: int) -> DataFrame:
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])  # a block's bytes are bounded
        found = search(held)
        if blocks == 1:
            return found
        written = scratch.keep(found, f"block-{k}")
        held.destroy()
        return written

    scratch = common.Scratch(spark, "decontamination")
    return reduce(DataFrame.union, map(block, range(blocks)))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


ORACLE = r"""
with w as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') ws from documents where text is not null),
b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') ws from benchmark where text is not null),
i as (
  select distinct item_id, least(len(ws), 5) width, array_to_string(list_slice(ws, k, k + least(len(ws), 5) - 1), ' ') g
  from b, lateral (select unnest(range(1, len(ws) - least(len(ws), 5) + 2)) k) where len(ws) > 0),
n as (select item_id, width, count(*) item_shingles from i group by all),
d as (
  select distinct doc_id, width, array_to_string(list_slice(ws, k, k + width - 1), ' ') g
  from w, (select distinct width from i) v, lateral (select unnest(range(1, len(ws) - width + 2)) k) where len(ws) >= width)
select d.doc_id, n.item_id, n.item_shingles, count(*) shared, count(*) / n.item_shingles containment
from d join i on d.g = i.g and d.width = i.width join n on n.item_id = i.item_id
group by d.doc_id, n.item_id, n.item_shingles having 5 * count(*) >= 4 * n.item_shingles
"""
