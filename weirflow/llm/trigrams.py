"""Boolean trigram queries of regular expressions.

A query is true for every text that has a match.  It is ``True``, a gram ``(three characters, fold)``, or
``("and", parts)`` and ``("or", parts)``; with ``fold`` the gram is sought in the lower-cased text (A-Z).

The parsed expression is read from left to right.  While what has been read since the last gap can only be
one of a few strings, these are kept and grow; where more becomes possible (a large class, a repetition
without end), one of the strings must have stood there, so the grams of each, united, are asked for.
Alternatives are united and optional parts may be the empty string; assertions and back-references ask for nothing.
"""

from __future__ import annotations

import re
import warnings

_parse, _ops = re._parser.parse, re._constants

#: Strings that are kept side by side, and characters of a class that are told apart.
STRINGS, CLASS = 64, 8

Query = bool | tuple


def both(*parts: Query) -> Query:
    return _united("and", parts)


def either(*parts: Query) -> Query:
    if True in parts:
        return True
    flat = _united("or", parts)
    if flat[0] != "or":
        return flat
    # what asks for no less than another way does is left out
    sets = {p: frozenset(p[1] if p[0] == "and" else (p,)) for p in flat[1]}
    return _united("or", [p for p in flat[1] if not any(sets[q] < sets[p] for q in flat[1])])


def _united(kind: str, parts) -> Query:
    flat = []
    for p in parts:
        if p is True:
            continue
        for q in p[1] if p[0] == kind else (p,):
            if q not in flat:
                flat.append(q)
    return True if not flat else flat[0] if len(flat) == 1 else (kind, tuple(sorted(flat, key=repr)))


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _asked(strings: dict[str, bool]) -> Query:
    """That one of the strings occurs; each with whether case is free."""
    if not strings:
        return True
    out = []
    for s, fold in strings.items():
        s = lower(s) if fold else s
        out.append(both(*[(s[k : k + 3], fold) for k in range(len(s) - 2)]))
    return either(*out)


class _Reader:
    """What has been asked for so far, and the strings of which one stands right before here.

    ``gap`` tells that more than these strings may have been read.
    """

    def __init__(self, items=(), fold: bool = False):
        self.query: Query = True
        self.run: dict[str, bool] = {"": False}
        self.gap = False
        self.read(items, fold)

    def ask(self, more: Query = True) -> None:
        self.query, self.run, self.gap = both(self.query, _asked(self.run), more), {"": False}, True

    def add(self, strings: dict[str, bool]) -> None:
        if len(self.run) * len(strings) > STRINGS:
            self.ask()
        if len(strings) > STRINGS:
            self.ask(_asked(strings))
            return
        out: dict[str, bool] = {}
        for a, f in self.run.items():
            for b, g in strings.items():
                out[a + b] = f or g or out.get(a + b, False)
        self.run = out

    def read(self, items, fold: bool) -> None:
        for op, value in items:
            self._one(op, value, fold)

    def _one(self, op, value, fold: bool) -> None:
        if op is _ops.LITERAL:
            self.add({chr(value): fold})
        elif op is _ops.IN and (chars := _members(value)) is not None:
            self.add({c: fold for c in chars})
        elif op is _ops.SUBPATTERN:
            _, on, off, inner = value
            self.read(inner, bool((fold or on & re.I.value) and not off & re.I.value))
        elif op is _ops.ATOMIC_GROUP:
            self.read(value, fold)
        elif op is _ops.BRANCH:
            self._branch([_Reader(x, fold) for x in value[1]])
        elif op in (_ops.MAX_REPEAT, _ops.MIN_REPEAT, _ops.POSSESSIVE_REPEAT):
            least, most, inner = value
            got = _Reader(inner, fold)
            if (least, most) == (0, 1):
                self._branch([got, _Reader()])
            elif not got.gap and least and max(map(len, got.run)) * least <= 64:
                for _ in range(least):
                    self.add(got.run)
                if most != least:  # the last ones stand right before what follows
                    self.ask()
                    for _ in range(least):
                        self.add(got.run)
            else:
                self.ask(both(got.query, _asked(got.run)) if least else True)
        elif op in (_ops.AT, _ops.ASSERT, _ops.ASSERT_NOT):
            pass
        else:  # any character, a large or negated class, a back-reference, a condition
            self.ask()

    def _branch(self, ways: list[_Reader]) -> None:
        strings: dict[str, bool] = {}
        for w in ways:
            for s, f in w.run.items():
                strings[s] = f or strings.get(s, False)
        if any(w.gap for w in ways):
            self.ask(either(*[both(w.query, _asked(w.run)) for w in ways]))
        else:
            self.add(strings)


def _members(items) -> list[str] | None:
    """The characters of a class, if they are few."""
    out = []
    for op, value in items:
        if op is _ops.LITERAL:
            out.append(chr(value))
        elif op is _ops.RANGE and value[1] - value[0] < CLASS:
            out += map(chr, range(value[0], value[1] + 1))
        else:
            return None
        if len(out) > CLASS:
            return None
    return out


def query(pattern: str) -> Query:
    """The query of a pattern; ``True`` where no trigram is mandatory.

    Patterns run in the JVM: what is read otherwise there, or not known here, is asked nothing of.
    """
    if re.search(r"\(\?[a-zA-Z-]*[uUxd]|\\v", pattern):
        return True
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            tree = _parse(pattern)
    except (re.error, Warning):
        return True
    reader = _Reader(tree, bool(tree.state.flags & re.I.value))
    reader.ask()
    return reader.query


def grams(asked: Query) -> list[tuple[str, bool]]:
    """The distinct grams of a query, in order."""
    if asked is True:
        return []
    if asked[0] in ("and", "or") and isinstance(asked[1], tuple):
        return sorted({g for p in asked[1] for g in grams(p)})
    return [asked]


def holds(asked: Query, text: str) -> bool:
    """Whether a text satisfies a query."""
    if asked is True:
        return True
    if isinstance(asked[1], tuple):
        return (all if asked[0] == "and" else any)(holds(p, text) for p in asked[1])
    gram, fold = asked
    return gram in (lower(text) if fold else text)
