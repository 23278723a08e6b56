"""Best-fit packing by exact complements (operator 2).

All pieces of one length are alike, so the plan is made on the histogram of lengths, whose size is the
capacity and not the corpus.  From the longest length down, the gap beside a piece is looked up among the
sums of one, two and three lengths that are still available; a combination that fills the gap exactly is
taken as often as its counts allow.  What has no exact complement goes by best fit, decreasing.  The
plan is a table of slots (a range of ranks of one length, the sequences and the offset they go to), and
every piece finds its slot by its length and its rank among pieces of that length.

Cases: null text counts as empty (one token, the end id); equal rows are packed one by one; an empty table
gives an empty result; a null doc_id is kept; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
#: Characters whose pieces are numbered at once.
BLOCK = 4_000_000

Pattern = tuple[tuple[int, int], ...]  # (length, copies) in order of place


class SumIndex:
    """Finds available lengths by the sum of one, two or three of them.

    The sum is the key: a table holds, sum by sum, all pairs of lengths that occur (the longest first part
    first), and one all triples, each as its longest part and the sum of the pair beside it.  ``counts`` says how
    many pieces of a length are left and falls as combinations are consumed; ``pairs_left`` says how many pairs of a
    sum have both lengths left.  Counts never rise, so an entry whose length has run out is never met again.
    """

    def __init__(self, counts: np.ndarray):
        self.counts, size = counts.copy(), len(counts)
        lengths = np.flatnonzero(counts)[::-1]
        first, second = (x.ravel() for x in np.meshgrid(lengths, lengths, indexing="ij"))
        fits = (first >= second) & (first + second < size)
        self.pairs, self.pair_at = self._table(first[fits], second[fits], first[fits] + second[fits], size)
        sums = np.flatnonzero(np.diff(self.pair_at))
        lead, rest = (x.ravel() for x in np.meshgrid(lengths, sums, indexing="ij"))
        fits = (lead + rest < size) & (2 * lead >= rest)
        self.triples, self.triple_at = self._table(lead[fits], rest[fits], lead[fits] + rest[fits], size)
        self.pairs_left = np.diff(self.pair_at)

    @staticmethod
    def _table(a: np.ndarray, b: np.ndarray, total: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries (a, b) by their sum, and where those of each sum begin."""
        order = np.lexsort((-a, total))
        return np.stack([a[order], b[order]]).astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(total, minlength=size))])

    def take(self, parts: tuple[int, ...], n: int) -> None:
        """Consumes a combination ``n`` times; the pairs of a length that runs out go with it."""
        for p in parts:
            self.counts[p] -= n
        for p in {p for p in parts if not self.counts[p]}:
            other = np.flatnonzero(self.counts[: max(len(self.counts) - p, 0)])
            self.pairs_left[other + p] -= 1
            if 2 * p < len(self.counts):
                self.pairs_left[2 * p] -= 1

    def have(self, parts: tuple[int, ...]) -> int:
        """How often the combination is left at once."""
        return min(int(self.counts[p]) // parts.count(p) for p in parts)

    def single(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        return (total,) if self.have((total, *held)) else None

    def pair(self, total: int, held: tuple[int, ...] = (), most: int | None = None) -> tuple[int, ...] | None:
        """The pair of this sum with the longest first part that is left beside what is held."""
        if not self.pairs_left[total]:
            return None
        a, b = self.pairs[:, self.pair_at[total] : self.pair_at[total + 1]]
        left = (self.counts[a] > 0) & (self.counts[b] > 0)
        if most is not None:
            left &= a <= most
        for k in np.flatnonzero(left):
            parts = (int(a[k]), int(b[k]))
            if self.have((*held, *parts)):
                return parts
        return None

    def triple(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        lead, rest = self.triples[:, self.triple_at[total] : self.triple_at[total + 1]]
        for k in np.flatnonzero((self.counts[lead] > 0) & (self.pairs_left[rest] > 0)):
            first = int(lead[k])
            if pair := self.pair(int(rest[k]), (first, *held), first):
                return (first, *pair)
        return None

    def complement(self, length: int, gap: int) -> tuple[tuple[int, ...] | None, int]:
        """The first combination that fills the gap beside a piece of this length, and how often it does."""
        for find in (self.single, self.pair, self.triple):
            if parts := find(gap, (length,)):
                return parts, self.have((length, *parts))
        return None, 0


def _grouped(parts: tuple[int, ...]) -> Pattern:
    out: dict[int, int] = {}
    for p in parts:
        out[p] = out.get(p, 0) + 1
    return tuple(out.items())


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences have each; together they hold every piece once."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] += n
    out = []
    if counts[capacity]:
        out.append((((capacity, 1),), int(counts[capacity])))
        counts[capacity] = 0
    index, residual = SumIndex(counts), {}
    for length in range(capacity - 1, 0, -1):
        while left := int(index.counts[length]):
            parts, n = index.complement(length, capacity - length)
            if not parts:
                residual[length] = left
                index.take((length,), left)
                break
            index.take((length, *parts), n)
            out.append((_grouped((length, *parts)), n))
    return out + best_fit(residual, capacity)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, over equal sequences at once."""
    open_: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)  # by what is free
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for gap in sorted(g for g in open_ if g >= length):
            each = gap // length
            while left and open_[gap]:
                pattern, n = open_[gap].pop()
                full = min(n, left // each)
                used = full + bool(full < n and left - full * each)
                if full:
                    open_[gap - each * length].append((pattern + ((length, each),), full))
                    left -= full * each
                if used > full:
                    open_[gap - left * length].append((pattern + ((length, left),), 1))
                    left = 0
                if used < n:
                    open_[gap].append((pattern, n - used))
        each = capacity // length
        if left // each:
            open_[capacity - each * length].append((((length, each),), left // each))
        if left % each:
            open_[capacity - left % each * length].append((((length, left % each),), 1))
    return [x for gap in sorted(open_) for x in open_[gap]]


def slots(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end of ranks, copies in a sequence, first sequence, offset) of the plan."""
    taken: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length, copies in pattern:
            out.append((length, taken[length], taken[length] + n * copies, copies, sequence, offset))
            taken[length] += n * copies
            offset += length * copies
        sequence += n
    return out


#: Characters below this have no marks to compose and lower-case one by one, but for U+0130.
PLAIN = 0x250


def _class(kind: str) -> str:
    """The characters of a Unicode category, below PLAIN, as they stand within a regex's brackets."""
    return "".join(f"\\u{c:04x}" for c in range(PLAIN) if unicodedata.category(chr(c))[0] == kind)


class WordTokens:
    """Ids of texts of a vocabulary that composes, lower-cases and drops white space.

    The pieces that the vocabulary's pattern cuts a text into encode alone, so they are remembered up to a
    bound; when it is reached the older half goes.  Texts of Latin letters are cut here by the same pattern;
    others are parted at white space, which is always dropped, and their words encoded by the library.
    """

    def __init__(self, path: str, bound: int = 200_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.bound = Tokenizer.from_file(path), bound
        letters, numbers = _class("L"), _class("N")
        # the vocabulary's pattern; alternatives that begin alike keep their order
        self.cut = re.compile(rf"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^\s{letters}{numbers}]+")
        self.hard = re.compile(rf"[^\t-\r -~\u00a1-\u012f\u0131-\u{PLAIN - 1:04x}]|<\|")
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Encodes texts without line ends in one call, and deals the ids to them by place."""
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        got = self.tokenizer.encode("\n".join(texts), add_special_tokens=False)
        ids = np.array(got.ids, "<u4")
        at = np.array([o[0] for o in got.offsets], np.int64)
        cuts = np.searchsorted(at, starts)
        return [ids[cuts[k] : cuts[k + 1]].tobytes() for k in range(len(texts))]

    def _parts(self, text: str | None) -> list[str]:
        """The pieces of a text, or its words where it has to go to the library."""
        if not text:
            return []
        if self.hard.search(text):
            return [w.decode() for w in text.encode().split()]  # at ASCII white space
        return self.cut.findall(text.lower())

    def _ids(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.known) >= self.bound:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        new = []
        for p in parts:
            if p not in known:
                if p in old:
                    known[p] = old[p]
                else:
                    new.append(p)
        known.update(zip(new, self._encode(new)) if new else ())
        out = list(map(known.__getitem__, parts))
        for p in [p for p in new if len(p) > 64]:
            del known[p]
        return out

    def many(self, texts: list[str | None], end: int = 0, block: int = BLOCK) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text and the end id.

        Texts are taken in blocks of about ``block`` characters: their pieces are numbered, each distinct piece is
        looked up once, and the ids are gathered by number.
        """
        tail, at = end.to_bytes(4, "little"), 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and size < block:
                split.append(self._parts(texts[at]))
                size += len(texts[at] or "")
                at += 1
            coded = pa.array(chain.from_iterable(split), pa.string()).dictionary_encode()
            cuts = np.cumsum([0, *map(len, split)])
            split = None  # the pieces' own memory goes before the ids are gathered
            pieces = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            number = coded.indices.to_numpy()
            length = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
            start = np.cumsum(length) - length
            each = length[number]
            ends = np.concatenate([[0], np.cumsum(each)])
            place = np.repeat(start[number] - ends[:-1], each)
            place += np.arange(ends[-1])
            ids = np.frombuffer(b"".join(pieces), "<u4")[place]
            del place, each, coded, number
            for a, b in zip(ends[cuts[:-1]], ends[cuts[1:]]):
                yield ids[a:b].tobytes() + tail

    def __call__(self, text: str | None, end: int = 0) -> bytes:
        return next(self.many([text], end))


_tokens: dict[str, WordTokens] = {}


def word_tokens(name: str) -> WordTokens:
    if name not in _tokens:
        import os

        import public_tokenizers

        _tokens[name] = WordTokens(name if os.path.exists(name) else public_tokenizers.path(name))
    return _tokens[name]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece, with the task that made it and its rank among that task's pieces of its length."""

    def run(batches):
        from pyspark import TaskContext

        tokens, task, seen = word_tokens(vocabulary), TaskContext.get().partitionId(), defaultdict(int)
        for ids, texts in common.gathered(batches, BLOCK):
            rows: list[list] = [[] for _ in range(6)]
            for k, blob in enumerate(tokens.many(texts)):
                for piece, start in enumerate(range(0, len(blob) // 4, capacity)):
                    part = blob[4 * start : 4 * (start + capacity)]
                    n = len(part) // 4
                    for column, value in zip(rows, (k, piece, start, n, zlib.crc32(part), seen[n])):
                        column.append(value)
                    seen[n] += 1
            at, piece, start, n, crc, rank = rows
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(n), pa.int32()), pa.array(rank, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(common.releasing(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, local_rank long")


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and offset; the columns are those of the op2 contract."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "packing")
    # Ranks have to stay as they are if a task runs again, so the pieces are written first.
    made = scratch.keep(pieces(docs, vocabulary, capacity), "pieces")
    counts = scratch.keep(made.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    rows = slots(plan(histogram, capacity))
    table = spark.createDataFrame(rows or [(0, 0, 0, 1, 0, 0)], "length long, low long, high long, copies long, first long, base long")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # Tasks times lengths: that grows with the corpus, so it is met by a shuffle of the pieces' few numbers.
    ranked = made.join(offsets.hint("merge"), ["length", "task"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    # The slots number at most a small multiple of the capacity, whatever the corpus.
    placed = ranked.join(F.broadcast(table), "length").where("rank >= low and rank < high")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("first + (rank - low) div copies").alias("sequence_id"),
        F.expr("base + ((rank - low) % copies) * length").alias("offset"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.arrow_rows(spark, 1000)
    return pack(common.table(spark, sf_dir, "documents"))
