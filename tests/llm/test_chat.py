from collections import defaultdict

from weirflow.llm import chat

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "more"), (3, 0, "user", "hi"), (3, 1, "assistant", "other"), (4, 5, "user", "hi"),
    (5, 0, "user", "hi"), (5, 2, "assistant", "hello"), (5, 7, "user", "more"), (6, 0, None, None), (7, 0, "", ""), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (8, 1, "user", "a"), (None, 0, "user", "lost"), (None, 3, "user", "lost"), (None, 0, "user", "hi"), (None, 1, "user", "tie"), (None, 0, None, "x"), (-(2**63), 0, "user", "least"), (9, None, "user", "no turn"), (9, 0, "user", "x" * 100_000),
]


def brute(rows):
    turns = defaultdict(list)
    for k, (conv, *turn) in enumerate(rows):
        turns[("alone", k) if conv is None else conv].append(turn)
    lists = {c: [tuple(t[1:]) for t in sorted(v, key=lambda t: [(x is not None, x) for x in t])] for c, v in turns.items()}
    out = {}
    for c, mine in lists.items():
        longer = any(len(o) > len(mine) and o[: len(mine)] == mine for o in lists.values())
        rank = lambda c: (1, c) if isinstance(c, tuple) else (0, c)
        equal = any(o == mine and rank(d) < rank(c) for d, o in lists.items() if d != c)
        if not longer and not equal:
            out[None if isinstance(c, tuple) else c, tuple(mine)] = (len(mine), "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in mine))
    return out


def test_against_all_pairs(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "conv_id long, turn long, role string, text string, h1 string, place int").repartition(3)
    got = [(r["conv_id"], r["n_turns"], r["chat"]) for r in chat.render(df, *chat.maximal(df)).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[2])
    assert sorted(got, key=key) == sorted([(c, n, t) for (c, _), (n, t) in brute(ROWS).items()], key=key)
    assert {c for c, _, _ in got} == {2, 3, 6, 7, 8, 9, None, -(2**63)} and sum(c is None for c, _, _ in got) == 3


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.render(df, *chat.maximal(df)).collect() == []


def test_plan_is_native(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    plan = chat.render(df, *chat.maximal(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
