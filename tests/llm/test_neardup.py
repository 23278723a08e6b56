import random
from fractions import Fraction

import numpy as np
import pytest

from weirflow.llm import common, neardup


def brute(rows, size, threshold):
    """doc_id, set size and smallest doc_id reachable, by comparing all."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().translate(bytes.maketrans(common.UPPER.encode(), common.LOWER.encode())).replace(b"\x1c", b"\x1c").split(None)
        w = [x for x in common.words_of(text)]
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * threshold.denominator >= threshold.numerator * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), doc if not sets[i] else least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def found(df, size, threshold):
    got = neardup.near_duplicates(df, size, threshold).collect()
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in got)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr)


def test_words():
    assert common.words_of("A\x1cb c\x85\xa0D\n\té") == [b"a\x1cb", "c\x85\xa0d".encode(), "é".encode()]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.85, 0.95, 1.0])
def test_bands_miss_little(threshold):
    rows, bands = neardup.band_shape(threshold)
    assert (1 - min(threshold, 0.999) ** rows) ** bands <= 1.01 * neardup.MISS and rows * bands >= neardup.ESTIMATE


def test_registers_agree_as_sets_do():
    rng = np.random.default_rng(1)
    sketch = neardup.Sketcher(8, 44)
    with np.errstate(over="ignore"):
        for n, shared in ((5000, 4000), (300, 240), (20, 15)):
            equal = estimates = 0.0
            for _ in range(30):
                x = np.unique(rng.integers(0, 2**63, 2 * n - shared, dtype=np.uint64))
                a, b = sketch.registers(x[:n]), sketch.registers(x[n - shared :])
                equal += np.mean(a == b) / 30
                estimates += neardup.estimate(a, b, n, n) / 30
            assert abs(equal - shared / (2 * n - shared)) < 0.04 and abs(estimates - shared / (2 * n - shared)) < 0.04


def test_chance_collisions():
    rng = np.random.default_rng(2)
    sketch = neardup.Sketcher(8, 44)
    with np.errstate(over="ignore"):
        hits = np.mean([np.mean(sketch.registers(rng.integers(0, 2**63, 3000, dtype=np.uint64)) == sketch.registers(rng.integers(0, 2**63, 3000, dtype=np.uint64))) for _ in range(100)])
    assert abs(hits - neardup.chance(3000, 3000)) < 3e-4


@pytest.mark.parametrize("size,threshold", [(3, Fraction(85, 100)), (5, Fraction(4, 5))])
def test_against_all_pairs(spark, sentence, size, threshold):
    rng = random.Random(5)
    rows = [(None, "no id"), (900, None), (901, ""), (902, " \n "), (903, "one"), (904, "One"), (905, "two words"), (905, "two words")]
    for k in range(12):  # groups: copies, near copies at all distances, chains
        base = sentence(rng.choice([8, 30, 120, 400])).split()
        for m in range(6):
            w = list(base)
            for _ in range(int(len(w) * m * 0.012)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            rows.append((10 * k + m, " ".join(w)))
            if m % 2:
                base = w
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int").repartition(3)
    assert found(df, size, threshold) == brute(rows, size, threshold)


def test_a_cloud_of_near_copies(spark, sentence):
    """Independent edits of one text: some are linked to it, others to nothing, and few pairs are tried."""
    rng, base, rows = random.Random(9), sentence(150).split(), []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(14)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 3, Fraction(85, 100)) == brute(rows, 3, Fraction(85, 100))


def test_components(spark):
    scratch = common.Scratch(spark, "test")
    chain = [(k, k + 1) for k in range(40)] + [(100, 200), (300, 200)]
    got = {r["node"]: r["component"] for r in neardup.components(spark.createDataFrame(chain, "a long, b long"), scratch).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 200: 100, 300: 100}


def test_odd_rows(spark, documents, no_documents):
    got = neardup.near_duplicates(documents, 3, Fraction(85, 100)).collect()
    assert len(got) == 10 and {r["doc_id"]: r["component_id"] for r in got if r["doc_id"]}[6] == 5
    assert neardup.near_duplicates(no_documents).collect() == []
