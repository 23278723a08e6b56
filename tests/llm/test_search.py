import math
import random

import numpy as np
import pytest

from weirflow.llm import common, search


def brute(rows, every=100, top=10, scale=1024):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % every == 0:
            ranked = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:top]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(ranked, 1)]
    return sorted(out)


def found(df):
    got = search.top_k(df)
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint"]
    return sorted(tuple(r) for r in got.collect())


def make(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(3)


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    unit = lambda v: [float(x) for x in np.float32(v / np.linalg.norm(v))]
    rows = [(i, unit(rng.normal(size=16))) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(40)]  # ties with a query
    rows += [(3000, None), (3001, [1.0, None]), (3002, [float("nan")] * 16), (3003, [float("inf")] * 16), (None, rows[1][1]), (3100, []), (3200, [0.5, -0.25]), (3300, [0.0] * 16), (3400, [-1.0] * 16)]
    assert found(make(spark, rows)) == brute(rows)


def test_few_rows_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.1]), (2, [-1.0, 0.1])]
    assert found(make(spark, rows)) == brute(rows)
    assert found(make(spark, [])) == [] and found(make(spark, [(0, [1.0])])) == []


def test_values_beyond_doubles_stay_exact(spark):
    rows = [(0, [3.0e5, 1.0]), (1, [2.9e5, 2.0]), (2, [3.0e5, -1.0]), (3, [2.0e6, 0.5])]  # products of up to 6e17
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert found(make(spark, rows)) == brute(rows)


@pytest.mark.parametrize("seed", range(5))
def test_shards_give_all_above_the_floor(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-200, 200, (3000, 24))
    shard, q = search.Shard(np.arange(3000), x), rng.integers(-200, 200, 24)
    scores = x @ q
    floor = int(np.sort(scores)[-15])
    at, got = shard.search(q, floor)
    assert sorted(zip(at.tolist(), got.tolist())) == [(k, int(s)) for k, s in enumerate(scores) if s >= floor]


@pytest.mark.parametrize("floor", [None, -10**6, -500, 0])
@pytest.mark.parametrize("kind", [np.int64, object])
def test_floors_that_rule_nothing_out(floor, kind):
    x = np.random.default_rng(2).integers(-9, 9, (300, 6)).astype(kind)
    q = np.array([3, 0, -2, 5, -1, 0], kind)
    at, got = search.Shard(np.arange(300), x).search(q, floor)
    assert sorted(zip(at.tolist(), got.tolist())) == [(k, int(s)) for k, s in enumerate(x @ q) if floor is None or s >= floor]


def test_all_rows_pass_through_postings(monkeypatch):
    """Also where there are few, every vector is searched in a shard, and bounds leave terms out once there are k."""
    rows, seen, cuts = 500, [], []
    x = np.abs(np.random.default_rng(3).normal(size=(rows, 8)))
    own = search.Shard.search

    def counted(self, q, floor):
        seen.append(len(self.ids))
        at, scores = own(self, q, floor)
        cuts.append(len(at) < len(self.ids))
        return at, scores

    monkeypatch.setattr(search.Shard, "search", counted)
    monkeypatch.setattr(search, "FIRST_ROWS", 100)
    batch = type("B", (), {"column": lambda self, k: type("C", (), {"to_pylist": lambda _: (list(range(rows)) if k == 0 else x.tolist())[self.part]})()})
    parts = []
    for lo in range(0, rows, 50):
        parts.append(batch())
        parts[-1].part = slice(lo, lo + 50)
    list(search.search_batches(parts, np.array([0]), search.matrix([x[0].tolist()], 1024), 1024, 10))
    assert sum(seen) == rows and any(cuts)


def test_buffers_and_blocks_agree(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(900)]
    queries = search.matrix([v for i, v in rows if i % 100 == 0], 1024)
    ids = np.array([i for i, _ in rows if i % 100 == 0])
    monkeypatch.setattr(search, "SHARD_ROWS", 50)
    monkeypatch.setattr(search, "FIRST_ROWS", 10)

    class Batch:
        def __init__(self, part):
            self.part = part

        def column(self, k):
            return type("C", (), {"to_pylist": lambda _: [r[k] for r in self.part]})()

    got = list(search.search_batches([Batch(rows[k : k + 30]) for k in range(0, 900, 30)], ids, queries, 1024, 10))
    assert sorted((i, v, s) for _, i, v, s in got) == sorted((i, j, s) for i, _, j, s in brute(rows))
    common.arrow_rows(spark, 100)
    monkeypatch.setattr(search, "BLOCK_BYTES", 200)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in search.top_k(df).collect()) == brute(rows)
