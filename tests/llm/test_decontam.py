from fractions import Fraction

from weirflow.llm import common, decontam


def brute(docs, items, size=5, t=Fraction(4, 5)):
    out = []
    for doc, text in docs:
        words = common.words_of(text, plain=True)
        for item, wanted in items:
            w = common.words_of(wanted, plain=True)
            if not w:
                continue
            k = min(size, len(w))
            q = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
            both = len(q & {tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
            if both >= t * len(q):
                out.append((doc, item, len(q), both))
    return sorted(out, key=repr)


def test_against_all_pairs(spark, sentence):
    items = [(k, sentence(n)) for k, n in enumerate((3, 5, 9, 17, 30, 59, 200))] + [(90, None), (91, ""), (92, "one two"), (92, "one two"), (None, sentence(12))]
    docs = [(900, None), (901, ""), (None, items[4][1]), (902, "One, TWO!"), (902, "One, TWO!")]
    for k, (_, text) in enumerate(items[:7]):
        w = text.split()
        docs += [(10 * k, f"{sentence(300)} {text.upper()}! {sentence(300)}"), (10 * k + 1, f"{sentence(50)} {' '.join(w[: len(w) // 2])}"), (10 * k + 2, sentence(40) + " " + ", ".join(w[: int(len(w) * 0.9)]) + " end"), (10 * k + 3, " ".join([*w[: len(w) // 3], "other", *w[len(w) // 3 :]]))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contaminated(d, b).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in got), key=repr) == brute(docs, items)
    assert all(r["containment"] == r["shared"] / r["item_shingles"] >= 0.8 for r in got)


def test_blocks_of_items_find_the_same(spark, sentence, monkeypatch):
    items = [(k, sentence(20)) for k in range(30)]
    docs = [(k, sentence(30) + " " + t) for k, t in items]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 500)
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, b).collect()) == [(k, k) for k in range(30)]


def test_odd_rows(spark, documents, no_documents):
    items = spark.createDataFrame([(1, "nothing of this kind is there")], "item_id long, text string")
    assert decontam.contaminated(documents, items).collect() == []
    assert decontam.contaminated(no_documents, items).collect() == []
    assert decontam.contaminated(documents, items.where("false")).collect() == []


def test_ids_of_other_types_and_blocks(spark, monkeypatch):
    from decimal import Decimal

    monkeypatch.setattr(decontam, "BLOCK_BYTES", 60)
    items = [(Decimal(f"{k}.5"), " ".join(f"w{k}x{j}" for j in range(9))) for k in range(6)]
    docs = spark.createDataFrame([(k, f"some words {t} and more") for k, (_, t) in enumerate(items)], "doc_id long, text string")
    got = decontam.contaminated(docs, spark.createDataFrame(items, "item_id decimal(5,1), text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(k, i) for k, (i, _) in enumerate(items)]
