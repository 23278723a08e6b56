import random

import pytest

from weirflow.llm import trigrams

LETTERS = "abcAB_"


def made(rng, depth):
    """A random pattern, and a function that gives random matches of it."""
    kind = rng.randrange(3 if depth <= 0 else 10)
    if kind < 2:
        word = "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 5)))
        return word, lambda: word
    if kind == 2:
        pattern, chars = rng.choice([("[abc]", "abc"), ("[A-Z]", "AQZ"), (".", "a-A"), (r"\d", "07"), ("[^a]", "bA-"), ("[a-c_]", "ac_"), (r"\x20*", [" " * k for k in range(4)])])
        return pattern, lambda: rng.choice(chars)
    if kind < 5:
        parts = [made(rng, depth - 1) for _ in range(rng.randint(1, 4))]
        return "".join(p for p, _ in parts), lambda: "".join(f() for _, f in parts)
    if kind < 7:
        parts = [made(rng, depth - 1) for _ in range(rng.randint(2, 3))]
        return f"({'|'.join(p for p, _ in parts)})", lambda: rng.choice(parts)[1]()
    pattern, match = made(rng, depth - 1)
    if kind == 7:
        def cased():
            return "".join(c.swapcase() if c.isascii() and rng.random() < 0.5 else c for c in match())

        return (f"(?i:{pattern})", cased) if "[" not in pattern and "." not in pattern else (f"(?:{pattern})", match)
    least, most, mark = rng.choice([(0, 1, "?"), (0, 3, "*"), (1, 3, "+"), (2, 2, "{2}"), (2, 5, "{2,}"), (0, 2, "{0,2}"), (1, 2, "{1,2}?")])
    return f"(?:{pattern}){mark}", lambda: "".join(match() for _ in range(rng.randint(least, most)))


@pytest.mark.parametrize("seed", range(40))
def test_every_match_satisfies_the_query(seed):
    rng, asked = random.Random(seed), 0
    for _ in range(60):
        pattern, match = made(rng, 4)
        query = trigrams.query(pattern)
        asked += query is not True
        for _ in range(20):
            text = rng.choice(["", "x ", "ab"]) + match() + rng.choice(["", " y", "ba"])
            assert trigrams.holds(query, text), (pattern, text)
    assert asked


def test_queries_ask_for_what_is_mandatory():
    word = lambda s, fold=False: trigrams.both(*[(s[k : k + 3], fold) for k in range(len(s) - 2)])
    assert trigrams.query("token") == word("token")
    assert trigrams.query("(?i)ToKen|pass") == trigrams.either(word("token", True), word("pass", True))
    assert trigrams.query("api_?key=") == trigrams.either(word("api_key="), word("apikey="))
    assert trigrams.query("x(abc)+y") == trigrams.both(word("xabc"), word("abcy"))
    assert trigrams.query("abc.*def") == trigrams.both(word("abc"), word("def"))
    assert trigrams.query("(abc.*d|efg)h") == trigrams.either(("abc", False), ("efg", False))
    for none in ("[0-9a-f]{32,}", "ab", "abc|d", "(abc)?", "", r"\p{L}abc", "[a-z&&[b]]abc", "(?iu:token)", r"abc\v", "(?x) a b c"):
        assert trigrams.query(none) is True, none


def test_grams_are_listed_once():
    assert trigrams.grams(trigrams.query("abcd|xabc")) == [("abc", False), ("bcd", False), ("xab", False)] and trigrams.grams(True) == []
