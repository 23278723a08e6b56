import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weirflow.llm import common, tokens

PARTS = ["a", "b", "'", "re", "ll", "ve", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "é", "1", "23", "!", "--", "<|endoftext|>", "<|", "the", "ing", "中", "😀", "́", "​", "\r\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))


def n(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=16).map("".join))
def test_totals_and_prefixes_are_exact(text):
    library, c = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY)) if not hasattr(test_totals_and_prefixes_are_exact, "lib") else test_totals_and_prefixes_are_exact.lib, tokens.counter(tokens.VOCABULARY)
    test_totals_and_prefixes_are_exact.lib = library
    assert c.total(text) == n(library, text)
    assert list(c.prefixes(text)) == [n(library, text[:i]) for i in range(len(text) + 1)]


def test_pairs_are_judged_as_merging_does():
    c, rng = tokens.counter(tokens.VOCABULARY), random.Random(3)
    ids = list(c.bytes)
    for _ in range(5000):
        a, b = rng.choice(ids), rng.choice(ids)
        assert c._fit(a, b) == (c._merged(c.bytes[a] + c.bytes[b]) == [a, b])


def test_small_memory_gives_the_same(library):
    c = tokens.PrefixCounter(public_tokenizers.path(tokens.VOCABULARY), bound=5)
    text = "several words, more than are remembered; " * 20 + "x" * 5000
    assert c.total(text) == n(library, text)


def test_truncation(library):
    c = tokens.counter(tokens.VOCABULARY)
    text = "We can't stop here,   you'll see <|endoftext|> more."
    for budget in range(20):
        cut = c.truncate(text, budget)
        assert n(library, cut) <= budget and all(n(library, text[:i]) > budget for i in range(len(cut) + 1, len(text) + 1))


@pytest.mark.parametrize("before", ["<" * 6000, "x" * 6007, " " * 5001, "\n" * 4097 + "<" * 4099, "y " * 3000 + "!?" * 2500, "", "a b", "c "])
def test_prefixes_within_special_strings(library, before):
    c, text = tokens.counter(tokens.VOCABULARY), before + "<|endoftext|> z<|endoftext|><|endoftext|>"
    at = range(max(0, len(before) - 3), len(text) + 1)
    table = c.prefixes(text)
    assert len(table) == len(text) + 1 and [table[i] for i in at] == [n(library, text[:i]) for i in at]


def test_operator(spark, documents, library):
    common.arrow_rows(spark, 3)
    got = tokens.count_tokens(documents).collect()
    texts = [r["text"] for r in documents.collect()]
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted((r["doc_id"] or 0, len((r["text"] or "").encode()), n(library, r["text"] or ""), n(library, r["text"] or "") > 1024) for r in documents.collect())
    assert len(got) == len(texts)
    tables = {r["doc_id"]: r["counts"] for r in tokens.prefix_table(documents.where("doc_id in (2, 5, 8)")).collect()}
    assert tables[2] == [0] and tables[5][-1] == n(library, "Twice the same row.")
    cut = {r["doc_id"]: r["text"] for r in tokens.fit_budget(documents.where("doc_id in (1, 5)"), 2).collect()}
    assert cut[1] is None and n(library, cut[5]) == 2


def test_empty(no_documents):
    assert tokens.count_tokens(no_documents).collect() == []
