import random
from collections import Counter
from fractions import Fraction

import pytest

import corpus_pipeline
from weirflow.llm import common, packing

from .test_decontam import brute as leaks
from .test_neardup import brute as groups
from .test_packing import ids
from .test_secrets import brute as spans


@pytest.fixture
def tables(spark, tmp_path, sentence):
    rng = random.Random(6)
    docs = [(k, sentence(rng.randint(30, 90)).capitalize() + ".") for k in range(120)]
    docs += [(200 + k, " ".join(w.upper() + "!!" for w in sentence(40).split())) for k in range(30)]
    item = sentence(30)
    docs += [(300, docs[0][1]), (301, docs[1][1] + " extra"), (302, f"{sentence(40)} {item} {sentence(30)}"), (303, f"{sentence(30)} password=abcdefgh12 {sentence(30)}")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i, _ in docs[:150]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, item


def test_stages_by_brute_force(spark, tables):
    root, rows, item = tables
    docs = common.table(spark, root, "documents")
    texts = dict(rows)
    names, functions = zip(*corpus_pipeline.STAGES)
    assert names == ("quality", "near_duplicates", "decontamination", "secrets", "packing")
    for k, stage in enumerate(functions[:-1]):
        out = stage(spark, docs, root)
        assert out.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = {r["doc_id"]: r for r in out.collect()}
        if k == 0:
            assert set(got) == {i for i, _ in rows if not 200 <= i < 300}
        elif k == 1:
            assert set(got) == {i for i, _, first in groups(list(texts.items()), 5, Fraction(4, 5)) if i == first} and not {300, 301} & set(got)
        elif k == 2:
            assert set(texts) - set(got) == {i for i, *_ in leaks(list(texts.items()), [(1, item)])} == {302}
        else:
            assert "password" not in got[303]["text"] and "[REDACTED]" in got[303]["text"] and got[303]["n_chars"] == len(got[303]["text"])
            assert all(not spans(r["text"])[0] for r in got.values()) and all(r["text"] == texts[i] for i, r in got.items() if i != 303)
        texts = {i: r["text"] for i, r in got.items()}
        docs = spark.createDataFrame([tuple(r) for r in got.values()], docs.schema)
    packed = functions[-1](spark, docs, root).collect()
    assert Counter((r["doc_id"], r["length"]) for r in packed) == Counter((i, len(ids(t)) + 1) for i, t in texts.items())
    whole = corpus_pipeline.run(spark, root).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)
    assert packing.CAPACITY == 2048


def test_odd_rows(spark, tables, sentence):
    root, _, _ = tables
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, sentence(20), "en", "s", 5), (None, sentence(20), "en", "s", 5), (3, sentence(25), "en", "s", 5), (3, sentence(25), "en", "s", 5), (4, "a" * 300_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, root)
        assert out.count() >= 6
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), root).count() == 0


def test_rows_that_share_an_id(spark, tables, sentence):
    """A null or repeated doc_id names no row: each text has its own fate."""
    root, _, item = tables
    clean = [sentence(40) for _ in range(5)]
    rows = [(None, clean[0]), (None, clean[0]), (None, f"{sentence(30)} {item}"), (None, clean[1]), (7, clean[2]), (7, clean[3]), (7, f"{item} {sentence(30)}"), (8, clean[2] + " more"), (9, clean[1]), (9, clean[1]), (10, clean[4]), (11, " "), (11, " "), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", 5) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r["source"] for r in corpus_pipeline.unleaked(spark, docs, root).collect())
    assert got == sorted(f"s{k}" for k in range(15) if k not in (2, 6))
    kept = [r["source"] for r in corpus_pipeline.unlike(spark, docs, root).collect()]
    assert kept.count("s0") + kept.count("s1") == 1 and sorted(set(kept) - {"s0", "s1"}) == sorted(f"s{k}" for k in (2, 4, 5, 6, 8, 10, 11, 12, 13, 14)) and len(kept) == 11


def test_the_group_keeps_one_text_of_an_id(spark, tables, sentence):
    root, _, _ = tables
    base = sentence(60)
    docs = spark.createDataFrame([(5, base, "en", "a", 1), (5, base + " more", "en", "b", 1), (None, base, "en", "c", 1), (6, base, "en", "d", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.unlike(spark, docs, root).collect()
    assert [r["doc_id"] for r in kept] == [5]


def test_columns_of_any_name_come_through(spark, tables, sentence):
    """No n_chars, and columns named as the stages' own results: all come back as they were."""
    root, _, item = tables
    names = ["spans", "score", "predicted", "text_a", "item_id", "n", "row", "_rules", "postings_0", "id", "a.b", "node", "key"]
    rows = [(k, t) for k, t in enumerate([sentence(40), sentence(41) + " password=abcdefgh12", f"{sentence(20)} {item}", "", None, sentence(30)])]
    docs = spark.createDataFrame([(i, t, *[f"{n}{i}" for n in names]) for i, t in rows], ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, root)
        assert out.dtypes == docs.dtypes, name
        for r in out.collect():
            assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, root).count() == 6
