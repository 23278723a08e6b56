import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weirflow.llm import common, packing

PARTS = ["a", "B", "'", "re", "'ll", " ", "\n", "\x1c", "\x85", "　", "É", "ß", "ª", "²", "1", "23", "!", "--", "<|endoftext|>", "<|", "İ", "ΑΣ", "中", "😀", "́", "\xad", "\x00", "ǅ"]
LIBRARY = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=16).map("".join))
def test_ids_are_the_librarys(text):
    assert packing.word_tokens(packing.VOCABULARY)(text) == np.array([*ids(text), 0], "<u4").tobytes()


def test_small_memory_gives_the_same():
    w = packing.WordTokens(public_tokenizers.path(packing.VOCABULARY), bound=3)
    texts = ["Several words here, more than are kept " + "y" * 100, None, "again Several words", "Ω Several", ""] * 30
    assert list(w.many(texts)) == [np.array([*ids(t or ""), 0], "<u4").tobytes() for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_plans_hold_every_piece_once(histogram):
    patterns = packing.plan(histogram, 64)
    used = Counter()
    for pattern, n in patterns:
        assert n > 0 and sum(length * c for length, c in pattern) <= 64
        for length, c in pattern:
            used[length] += c * n
    assert used == Counter(histogram)
    n = sum(m for _, m in patterns)
    total = sum(k * v for k, v in histogram.items())
    assert -(-total // 64) <= n <= max(1, 2 * total // 64 + 1)
    seen = set()
    for length, low, high, copies, first, base in packing.slots(patterns):
        for rank in range(low, high):
            assert (length, rank) not in seen
            seen.add((length, rank))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), min_size=1, max_size=12), st.randoms())
def test_sums_are_found_while_counts_fall(histogram, rng):
    counts = np.zeros(41, np.int64)
    for k, n in histogram.items():
        counts[k] = n
    index, left = packing.SumIndex(counts), Counter(histogram)

    def ways(size, total, held):
        lengths, rest = sorted(left, reverse=True), left - Counter(held)
        return [c for c in combinations_with_replacement(lengths, size) if sum(c) == total and not Counter(c) - rest]

    while left:
        held = (rng.choice(sorted(left)),)
        for total in range(1, 41):
            for size, find in enumerate((index.single, index.pair, index.triple), 1):
                every, got = ways(size, total, held), find(total, held)
                assert (got is None) == (not every) and (got is None or tuple(sorted(got, reverse=True)) in every)
        pairs = Counter(sum(c) for c in combinations_with_replacement(sorted(left), 2))
        assert all(index.pairs_left[t] == pairs.get(t, 0) for t in range(41))
        index.take(held, 1)
        left -= Counter(held)


def test_exact_complements_come_first():
    assert packing.plan({40: 2, 24: 2}, 64) == [(((40, 1), (24, 1)), 2)]
    assert packing.plan({40: 1, 14: 1, 10: 1}, 64) == [(((40, 1), (14, 1), (10, 1)), 1)]
    assert packing.plan({40: 1, 12: 1, 7: 1, 5: 1}, 64) == [(((40, 1), (12, 1), (7, 1), (5, 1)), 1)]
    assert packing.plan({32: 5}, 64) == [(((32, 2),), 2), (((32, 1),), 1)]
    assert packing.plan({}, 64) == []


def test_operator(spark, documents):
    common.arrow_rows(spark, 3)
    got = packing.pack(documents.repartition(3)).collect()
    expected = Counter()
    for r in documents.collect():
        data = np.array([*ids(r["text"] or ""), 0], "<u4")
        for k, at in enumerate(range(0, len(data), 2048)):
            part = data[at : at + 2048]
            expected[r["doc_id"], k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) == -(-sum(r["length"] for r in got) // 2048)


def test_empty(no_documents):
    assert packing.pack(no_documents).collect() == []
