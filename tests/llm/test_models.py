import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import common, langid, quality

SYLLABLES = {"aa": "ba ka ta lo mi ren sol", "bb": "zrk vlt schm krst pft gn ngst"}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(words))


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = langid.Network(["x", "y", "z"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y, w = rng.integers(0, 256, (5, 4)), np.array([0, 1, 2, 1]), np.ones(4)
    net.states = lambda x, d, trace=None, f=langid.Network.states: _double(net, x, d, trace)
    loss, g = net.gradients(x, y, w)
    for name, p in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in p.shape) if name[0] != "W" else (int(x[rng.integers(5), rng.integers(4)]), int(rng.integers(p.shape[1])))
            old, e = p[at], 1e-5
            p[at] = old + e
            up = net.gradients(x, y, w)[0]
            p[at] = old - e
            down = net.gradients(x, y, w)[0]
            p[at] = old
            assert abs((up - down) / (2 * e) - g[name][at]) < 1e-4, name


def _double(net, x, d, trace):
    """The forward pass in double precision, step by step."""
    h, n = net.h, x.shape[1]
    W, U = net.p["W" + d], net.p["U" + d]
    s, out = np.zeros((n, h)), []
    for row in x:
        a, r = W[row], s @ U
        gate = 1 / (1 + np.exp(-(a[:, : 2 * h] + r[:, : 2 * h])))
        z, reset = gate[:, :h], gate[:, h:]
        new = np.tanh(a[:, 2 * h :] + reset * r[:, 2 * h :])
        if trace is not None:
            trace.append((s, z, reset, new, r[:, 2 * h :]))
        s = (1 - z) * new + z * s
        out.append(s)
    return np.array(out)


@pytest.mark.parametrize("positions, lookup", [(10**6, 4096), (10**6, 1), (50, 20), (1, 7)])
def test_scoring_reads_whole_texts(positions, lookup, monkeypatch):
    """Side by side or alone, in one span or many, a text's result is that of the trained network over all its bytes."""
    monkeypatch.setattr(langid, "POSITIONS", positions)
    monkeypatch.setattr(langid, "LOOKUP", lookup)
    monkeypatch.setattr(langid, "PANEL", 3 if positions == 50 else 512)
    net, rng = langid.Network(["x", "y", "z"]), random.Random(1)
    texts = [None, "", *["".join(rng.choice("abé 中.z") for _ in range(n)) for n in (1, 40, 7, 7, 300, 1, 96, 97)]]
    got = net.documents(texts)
    assert not got[:2].any()
    for text, p in zip(texts[2:], got[2:]):
        x = np.frombuffer(text.encode(), np.uint8)[:, None]
        logits = net.states(x, "f") @ net.p["Of"] + net.states(x[::-1], "b")[::-1] @ net.p["Ob"] + net.p["c"]
        expected = np.exp(logits) / np.exp(logits).sum(axis=-1, keepdims=True)
        assert np.allclose(p, expected.mean(axis=(0, 1)), atol=1e-5)


def test_stretches_cover_whole_texts():
    net, seen = langid.Network(["x", "y"]), set()
    texts = [b"0123456789abc", b"de"]

    def gradients(x, y, weight):
        for column, k, w in zip(x.T, y, weight.T):
            seen.add((bytes(column[: int((w > 0).sum())]), int(k)))
        return 0.0, {k: np.zeros_like(v) for k, v in net.p.items()}

    net.gradients = gradients
    net.train(texts, np.array([0, 1]), stretch=5, steps=40, batch=4)
    assert seen == {(b"01234", 0), (b"56789", 0), (b"abc", 0), (b"de", 1)}


def test_language_is_learned_and_pooled():
    rng = random.Random(1)
    rows = [(text(rng, lang, 30), lang) for lang in SYLLABLES for _ in range(60)]
    net = langid.fit(rows, steps=80, stretch=48)
    held = [(text(rng, lang, n), lang) for lang in SYLLABLES for n in (2, 10, 400) for _ in range(10)]
    prob = net.documents([t for t, _ in held])
    assert np.mean([net.classes[k] == lang for k, (_, lang) in zip(prob.argmax(axis=1), held)]) > 0.95
    assert np.allclose(prob.sum(axis=1), 1, atol=1e-4) and not net.documents([None, ""]).any()
    alone = net.documents([held[-1][0]])
    assert np.allclose(alone[0], prob[-1], atol=1e-5)  # a text's result doesn't hang on its batch


def test_language_operator(spark, documents, no_documents):
    rng = random.Random(2)
    rows = [(k, text(rng, lang, 20), lang) for k, lang in enumerate(list(SYLLABLES) * 40)] + [(900, text(rng, "aa", 20), None), (901, None, "aa"), (902, "12 34 ½ ² ① !", "bb"), (None, text(rng, "bb", 9), "bb")]
    df = spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, lang string, score double")
    kept = langid.sample(df)
    assert sorted(kept) == sorted({(t, lang) for i, t, lang in rows if lang and t and zlib.crc32(("" if i is None else str(i)).encode()) % 4 != 2})
    few = langid.sample(df.union(df).union(spark.createDataFrame([(i, "rare words", "cc", 0.0) for i in range(8)], df.schema)), rows=5)
    assert {lang: sum(x == lang for _, x in few) for lang in ("aa", "bb", "cc")} == {"aa": 5, "bb": 5, "cc": 1} and len(set(few)) == 11
    common.arrow_rows(spark, 16)
    got = {r["doc_id"]: r for r in langid.predict(df, langid.fit(kept, steps=60)).collect()}
    assert got[901]["lang_pred"] == got[902]["lang_pred"] == "und" and got[900]["lang_pred"] == "aa"
    assert all(r["held_out"] == (zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in got.items())
    assert {r["lang_pred"] for r in langid.predict(documents, langid.fit([])).collect()} == {"und"}
    assert langid.predict(no_documents, None).collect() == []


def test_features():
    a, b = quality.features("Plain words, in a line.\nAnother line."), quality.features("SPAM!! " * 50)
    assert a.shape == b.shape == (quality.WIDTH,) and np.isfinite(a).all() and np.isfinite(b).all()
    assert not quality.features(None).any() and not quality.features("").any() and np.isfinite(quality.features(" \n")).all() and np.isfinite(quality.features("é" * 100_000)).all()


def corpus(rng, n):
    return [(text(rng, "aa", rng.randint(5, 60)).capitalize() + ".", 1) if rng.random() < 0.8 else (" ".join(w.upper() + "!!" for w in text(rng, "aa", 30).split()), 0) for _ in range(n)]


@pytest.mark.parametrize("share", [0.3, 0.8])
def test_positive_unlabelled_learning(share):
    """Without any label 0, the prior is found and the cut has its meaning."""
    rng = random.Random(3)
    rows = corpus(rng, 3000)
    positive, negative = ([r for r in rows if r[1] == k] for k in (1, 0))
    mixed = positive[1000 : 1000 + int(500 * share)] + negative[: int(500 * (1 - share))]
    x = lambda rs: np.array([quality.features(t) for t, _ in rs], np.float32)
    trusted, unlabelled = x(positive[:500]), x(mixed)
    risks = quality.Network().fit(trusted, unlabelled, share, steps=200)
    assert risks[-1] < risks[0] and min(risks) >= 0
    assert abs(quality.class_prior(trusted, unlabelled) - share) < 0.06
    model = quality.fitted(trusted, unlabelled)
    held = positive[500:700] + negative[-100:]
    s = model.score(x(held))
    assert np.mean((s >= 0.7) == [q == 1 for _, q in held]) > 0.98 and abs(model.score(unlabelled).mean() - share) < 0.08


def test_best_bin():
    rng = np.random.default_rng(0)
    p, n = rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000)
    assert abs(quality.least_ratio(p[:2000], np.concatenate([p[2000:3000], n[:3000]])) - 0.25) < 0.04
    assert quality.least_ratio(p, n) < 0.1 and quality.least_ratio(p[:2000], p[2000:]) > 0.9


def test_samples_are_whole_where_there_are_few_and_bounded_else(spark):
    rows = [(k % 7 if k % 3 else None, f"text {k}") for k in range(300)] + [(1, "the same text")] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert len(quality._drawn(df, 1000)) == 500 and len(quality._drawn(df, 40)) == 40 and len(quality._drawn(df.where("false"), 5)) == 0
    assert np.array_equal(quality._drawn(df, 40), quality._drawn(df.repartition(2), 40))


def test_quality_operator(spark, no_documents):
    rng = random.Random(4)
    rows = [(k, t, q) for k, (t, q) in enumerate(corpus(rng, 400))] + [(900, None, None), (901, "", None), (902, "x" * 200_000, None)]
    docs = spark.createDataFrame([(i, t, "old") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows[:300]] + [(1, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    common.arrow_rows(spark, 64)
    model = quality.learn(docs, labels)
    got = {r["doc_id"]: r for r in quality.scored(docs, model).collect()}
    held = [(got[i]["predicted"], q) for i, _, q in rows[:400] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values()) and len(got) == 403
    none = quality.learn(docs, labels.where("false"))
    assert len({r["score"] for r in quality.scored(docs, none).collect()}) == 1
    assert quality.scored(no_documents, quality.learn(no_documents, labels)).collect() == []


@pytest.mark.parametrize("ids", [[0, 1, 17, 123456789, None]])
def test_buckets_are_crc32(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(common.crc_bucket(F.col("doc_id")))
    assert [r[0] for r in df.collect()] == [zlib.crc32(("" if i is None else str(i)).encode()) % 4 for i in ids]


def held_out(spark, query, name, table):
    sf = "/root/testdata/sf0.01"
    got = query(spark, sf).where("held_out")
    return got.join(spark.read.parquet(f"{sf}/{table}.parquet").select("doc_id", name), "doc_id").collect()


def test_held_out_languages(spark):
    rows = held_out(spark, langid.op9_language_id, "lang", "documents")
    right = [r["lang_pred"] == r["lang"] for r in rows if r["lang_pred"] != "und"]
    assert len(right) > 200 and np.mean(right) > 0.96


def test_held_out_quality(spark):
    rows = held_out(spark, quality.op10_quality_classifier, "quality", "labels")
    clean, junk = [r["predicted"] for r in rows if r["quality"] == 1], [r["predicted"] for r in rows if r["quality"] == 0]
    assert len(clean) > 50 and np.mean(clean) > 0.95 and len(junk) > 5 and np.mean(junk) < 0.1
