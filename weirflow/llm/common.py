"""What the operators of this subpackage share: scratch tables, word shingles, small helpers."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: White space of the shingle contracts: space and the ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


_written: list[tuple[SparkSession, str]] = []
_own: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where the setting is absent and all tasks run here."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="weirflow-"))
        root = _own[0]
    return root.rstrip("/")


class Scratch:
    """Tables written in the shared folder to cut lineage and to survive the loss of executors.

    ``keep`` writes a DataFrame as Parquet and returns the DataFrame that reads it; ``drop`` removes a
    table once later ones no longer need it; the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.held: list[tuple[DataFrame, str]] = []
        self.made = 0
        _written.append((spark, self.base))

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.base}/{self.made:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            for k, (held, path) in enumerate(self.held):
                if held is df:
                    remove(self.spark, path)
                    del self.held[k]
                    break


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                remove(spark, path)
        except Exception:  # the context may be gone at exit; the folder is the cluster's to clear then
            pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it another than all that are taken."""
    used, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by their whole names, also where these hold dots."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def hashed_sample(df: DataFrame, rows: int, total: int, *key: str) -> DataFrame:
    """At most ``rows`` rows, those of the smallest hash of ``key``; ``total`` is about how many there are.

    Rows far above the cut are left out before the order is taken, so that what the tasks send on is about
    three times the sample in all, and not a sample from each of them.
    """
    h = F.xxhash64(*key)
    if total > 4 * rows:
        df = df.where(F.pmod(h, F.lit(1 << 40)) < int((1 << 40) * 3 * rows / total))
        h = F.pmod(h, F.lit(1 << 40))
    return df.withColumn("_hash", h).orderBy("_hash", *key).limit(rows).drop("_hash")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def crc_bucket(doc_id: Column, buckets: int = 4) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def releasing(kernel: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A kernel that gives free memory back when its task ends: the worker waits on beside later stages."""

    def run(batches: Iterator) -> Iterator:
        yield from kernel(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def gathered(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple]:
    """The columns of as many batches as have about ``block`` characters together, the last one, texts, as a list."""
    held, texts, size = [], [], 0

    def out() -> tuple:
        return (*[pa.concat_arrays(c) for c in zip(*held)], texts)

    for b in batches:
        *rest, new = b.columns
        new = new.to_pylist()
        held.append(rest)
        texts += new
        size += sum(len(t) for t in new if t)
        if size >= block:
            yield out()
            held, texts, size = [], [], 0
    if held:
        yield out()


# --- word shingles -------------------------------------------------------------------------------

_words = re.compile(rb"[^\x20\x09-\x0d]+")
_terms = re.compile(rb"[a-z0-9\x80-\xff]+")
_up = bytes.maketrans(UPPER.encode(), LOWER.encode())


def words_of(text: str | None, plain: bool = False) -> list[bytes]:
    """Lower-cased (A-Z) words of a text as UTF-8; ``plain`` also parts words at ASCII punctuation."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_up)
    return (_terms if plain else _words).findall(raw)


class WordIds:
    """64-bit hashes of words, remembered up to a bound; the memory is emptied when it is full."""

    def __init__(self, bound: int = 200_000):
        self.bound, self.known = bound, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > self.bound:
                known.clear()
                new = list(set(words))
            import xxhash

            h = xxhash.xxh3_64_intdigest
            known.update((w, h(w)) for w in new)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the word shingles in text order; a shorter text is one shingle, an empty one has none."""
    n = len(ids)
    if not n:
        return ids
    width = min(size, n)
    out = np.full(n - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[k : n - width + 1 + k])
    return out


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """Readies a session for Python kernels: rows of an Arrow batch (few, where rows are long), and the package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    ship(spark)
