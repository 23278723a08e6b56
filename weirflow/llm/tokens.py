"""Token counts by prefix dynamic programming (operator 5).

For a byte-level BPE vocabulary, a sequence of tokens is the encoding of its text exactly if each
neighbouring pair of it is the encoding of the pair's text.  So the last token of every prefix follows
from the last tokens of shorter prefixes: it is the token that ends there and is compatible with the
last token before it.  ``count[i] = count[i - len(last[i])] + 1`` then holds the exact count at every
prefix.  Tables are kept for the pieces between white space, which encode independently; a text's table
is their sum, and answers how many tokens a prefix has, or how long a prefix fits a budget, without
encoding again.

Cases: null text counts as empty; an empty text has 0 tokens; equal rows give equal rows; a null doc_id is
kept; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
NEVER = 1 << 40
#: Characters whose segments are numbered at once.
BLOCK = 4_000_000

# White space by Unicode's property, and the public splitting pattern of this vocabulary (fixed values).
_WS = r"\t-\r " + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
_segment = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_run = re.compile(rf"[{_WS}]*")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixCounter:
    """Exact token counts of every prefix of a text, with tables of pieces kept up to a bound (twice ``bound``)."""

    def __init__(self, path: str, bound: int = 300_000):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        vocab = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if all(c in alphabet for c in t)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = spec["model"]["vocab"]
        self.ranks = {(ids[a], ids[b]): (k, ids[a + b]) for k, (a, b) in enumerate(pairs)}
        self.bytes = {i: t for t, i in vocab.items()}
        self.split = {new: (k, a, b) for (a, b), (k, new) in reversed(self.ranks.items())}
        self.spines: tuple[dict, dict] = ({}, {})
        self.single = [vocab[bytes([b])] for b in range(256)]
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        # a token that its own text doesn't encode to never occurs
        self.vocab = {t: i for t, i in vocab.items() if len(t) == 1 or self._merged(t) == [i]}
        self.reach: dict[bytes, int] = {}  # by three last bytes: the longest token that ends in them
        for t in self.vocab:
            if len(t) > 2:
                self.reach[t[-3:]] = max(len(t), self.reach.get(t[-3:], 0))
        self.pieces = regex.compile(_PIECES)
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.bound, self.known, self.whole, self.fits = bound, {}, {}, {}
        self.old_known, self.old_whole = {}, {}  # the older halves of the memory, which go next

    def _merged(self, data: bytes) -> list[int]:
        """Plain BPE; used on single tokens only, to find those that never occur."""
        out, ranks, single = [self.single[b] for b in data], self.ranks, self.single
        while len(out) > 1:
            pair = min(zip(out, out[1:]), key=lambda p: ranks.get(p, (NEVER, 0)))
            if pair not in ranks:
                break
            new, at, merged = ranks[pair][1], 0, []
            while at < len(out):
                if at + 1 < len(out) and (out[at], out[at + 1]) == pair:
                    merged.append(new)
                    at += 2
                else:
                    merged.append(out[at])
                    at += 1
            out = merged
        return out

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token's outermost part on one side, from byte to whole, each with the rank that merges it away."""
        out, rank = [], NEVER
        while True:
            out.append((token, rank))
            if token not in self.split:
                return out[::-1]
            rank, *parts = self.split[token]
            token = parts[side]

    def _fit(self, a: int, b: int) -> bool:
        """Whether a, b is what a + b encodes to: no merge across the border comes before those within."""
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            left, right = self.spines[0].get(a), self.spines[1].get(b)
            if left is None:
                left = self.spines[0][a] = self._spine(a, 1)
            if right is None:
                right = self.spines[1][b] = self._spine(b, 0)
            ranks, i, j = self.ranks, 0, 0
            while True:
                (x, ends), (y, closes) = left[i], right[j]
                r = ranks.get((x, y))
                if r is not None and r[0] < ends and r[0] <= closes:
                    known = False
                    break
                if ends == closes == NEVER:
                    known = True
                    break
                if ends <= closes:
                    i += 1
                if closes <= ends:
                    j += 1
            self.fits[key] = known
        return known

    def piece(self, data: bytes) -> list[int]:
        """Counts at every byte prefix (from 0) of a text that isn't split further."""
        n, vocab, reach, fit = len(data), self.vocab, self.reach.get, self._fit
        last, count = [0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            most = reach(data[i - 3 : i], 2) if i > 2 else i
            for j in range(i - most if i > most else 0, i):
                t = vocab.get(data[j:i])
                if t is not None and (not j or fit(last[j], t)):
                    last[i], count[i] = t, count[j] + 1
                    break
        return count

    def _chars(self, text: str):
        """As piece(), at the ends of characters; kept for short pieces, which recur with other punctuation."""
        out = self.whole.get(text)
        if out is None and (out := self.old_whole.get(text)) is not None:
            self.whole[text] = out
        if out is None:
            data = text.encode()
            out = self.piece(data)
            if len(data) == len(text):
                del out[0]
            else:
                at, ends = 0, []
                for c in text:
                    at += len(c.encode())
                    ends.append(out[at])
                out = ends
            if len(text) <= 64:
                if len(self.whole) >= self.bound:
                    self.old_whole, self.whole = self.whole, {}
                out = self.whole[text] = bytes(out) if out[-1] < 256 else out
        return out

    def segment(self, text: str):
        """Counts at every prefix (from 1 character) of white space followed by other characters."""
        pieces = self.pieces.findall(text)
        if len(pieces) == 1 and (text[0] != "'" or len(text) != 3):
            return self._chars(text)
        gap = _run.match(text).end()
        counts = list(self._chars(text[:gap])) if gap else []
        at = total = 0
        for p in pieces:
            own = self._chars(p)
            if len(p) == 3 and p[0] == "'" and p[1:] in ("re", "ve", "ll"):
                own = (own[0], 2, own[2])  # a cut contraction is a mark and a letter
            if at >= gap:
                counts += [total + c for c in own] if total else own
            else:
                counts += [total + c for c in own[gap - at :]]
            at, total = at + len(p), total + own[-1]
        return bytes(counts) if max(counts) < 256 else array("I", counts)

    def _tables(self, text: str) -> tuple[list[str], dict[str, bytes | array]]:
        """The text's segments, and the tables of all of them."""
        segments = _segment.findall(text)
        if len(self.known) >= self.bound:
            self.old_known, self.known = self.known, {}
        known, old = self.known, self.old_known
        long = []
        for s in set(segments).difference(known):
            t = old.get(s)
            known[s] = self.segment(s) if t is None else t
            if len(s) > 64:
                long.append(s)
        if long:
            tables = {s: known[s] for s in set(segments)}
            for s in long:
                del known[s]
            return segments, tables
        return segments, known

    def total(self, text: str | None) -> int:
        """Tokens of the whole text: the table's last entry."""
        if not text:
            return 0
        if self.parts is not None and any(s in text for s in self.special):
            return sum(1 if k % 2 else self.total(p) for k, p in enumerate(self.parts.split(text)))
        segments, tables = self._tables(text)
        return sum([tables[s][-1] for s in segments])

    def totals(self, texts: list[str | None]) -> np.ndarray:
        """As ``total`` of each text: segments are numbered, and each distinct one's table is looked up once."""
        special = self.special
        odd = [k for k, t in enumerate(texts) if t and any(s in t for s in special)]
        split = [_segment.findall(t) if t else [] for t in texts]
        for k in odd:
            split[k] = []
        coded = pa.array(chain.from_iterable(split), pa.string()).dictionary_encode()
        last = []
        for s in coded.dictionary.to_numpy(zero_copy_only=False).tolist():
            t = self.known.get(s)
            if t is None:
                t = self.old_known.get(s)
                if t is None:
                    t = self.segment(s)
                if len(s) <= 64:
                    if len(self.known) >= self.bound:
                        self.old_known, self.known = self.known, {}
                    self.known[s] = t
            last.append(t[-1])
        ends = np.concatenate([[0], np.cumsum(np.array(last, np.int64)[coded.indices.to_numpy()])])
        out = np.diff(ends[np.cumsum([0, *map(len, split)])])
        for k in odd:
            out[k] = self.total(texts[k])
        return out

    def prefixes(self, text: str | None) -> np.ndarray:
        """``out[i]`` is the exact token count of the first ``i`` characters."""
        out = [np.zeros(1, np.int64)]
        base = 0
        segments, tables = [], {}
        parts = self.parts.split(text or "") if self.parts is not None else [text or ""]
        for k, p in enumerate(parts):
            if k % 2:  # while it is cut, a special string is ordinary text that goes on the last segment before it
                open_, after, start = segments[-1] if segments else "", [], base
                if open_:
                    start -= tables[open_][-1]
                more, those = self._tables(open_ + p[:-1])
                for s in more:
                    after.append(start + np.array(list(those[s]), np.int64))
                    start += those[s][-1]
                out += [*after, np.array([base + 1])] if not open_ else [np.concatenate([*after, [base + 1]])[len(open_) :]]
                base += 1
                continue
            segments, tables = self._tables(p)
            for s in segments:
                out.append(base + np.array(list(tables[s]), np.int64))
                base += tables[s][-1]
        return np.concatenate(out)

    def truncate(self, text: str | None, budget: int) -> str:
        """The longest prefix of at most ``budget`` tokens."""
        fits = np.flatnonzero(self.prefixes(text) <= budget)
        return (text or "")[: fits[-1] if len(fits) else 0]


_counters: dict[str, PrefixCounter] = {}


def counter(name: str) -> PrefixCounter:
    """A worker's counter of a vocabulary, found on the machine it runs on."""
    if name not in _counters:
        import os

        import public_tokenizers

        _counters[name] = PrefixCounter(name if os.path.exists(name) else public_tokenizers.path(name))
    return _counters[name]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text."""

    def run(batches):
        c = counter(vocabulary)
        for ids, texts in common.gathered(batches, BLOCK):
            n = c.totals(texts)
            yield pa.RecordBatch.from_arrays([ids, pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def prefix_table(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and the counts at every prefix, one for each character and one for the empty prefix."""

    def run(batches):
        c = counter(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "counts": pa.array([c.prefixes(t).astype(np.int32) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, counts array<int>")


def fit_budget(docs: DataFrame, budget: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and each text cut to its longest prefix of at most ``budget`` tokens (null stays null)."""

    def run(batches):
        c = counter(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "text": pa.array([None if t is None else c.truncate(t, budget) for t in b.column(1).to_pylist()], pa.string())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.arrow_rows(spark, 1000)
    return count_tokens(common.table(spark, sf_dir, "documents"))
