"""Small tables with the cases that every operator has to bear."""

import random

import pytest

SF = "/root/testdata/sf0.001"
WORDS = "the of and river stone cloud paper light green seven often walk under garden winter bright kettle marble signal thunder".split()


@pytest.fixture
def sentence():
    rng = random.Random(7)
    return lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture
def documents(spark, sentence):
    """Null and empty texts, a null id, a repeated row, ties, a very long text, and columns that clash with results."""
    long = sentence(30_000)
    rows = [(1, None), (2, ""), (3, "  \n"), (None, "no id here at all"), (4, "one"), (5, "Twice the same row."), (5, "Twice the same row."), (6, "Twice the same row."), (7, long), (8, "éü ß 中文 😀 <|endoftext|> \x1c\x85")]
    made = [(i, t, "en", "src", None if t is None else len(t), "x", 0.5, "y") for i, t in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long, spans string, score double, component_id string")


@pytest.fixture
def no_documents(documents):
    return documents.where("false")
