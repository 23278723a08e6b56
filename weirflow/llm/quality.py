"""Quality by positive-unlabelled learning (operator 10).

Trusted positives are documents of label 1; the unlabelled set is web text as it comes.  Labels 0 are never read.
A small network ``g`` minimises the non-negative unbiased risk: with the class prior ``p``,
``p R+(g, positive) + max(0, R-(g, unlabelled) - p R-(g, positive))``.

Networks are learned from all folds but one, and their mean output counts.  The prior is estimated from the outputs
for positives and for unlabelled texts that a network has not seen: above a cut, the share of unlabelled texts is at least ``p`` times that of positives, and their ratio is least where no
negative scores so high (best bin, with its confidence bounds).  Networks learned with one estimate give the next.

A logistic map of ``g`` turns it into the chance of being positive, so that the contract's cut has its meaning.  For
the logistic loss the unbiased risk is convex in the map, ``mean(log(1 + exp(a g + b)), unlabelled) - p (a mean(g,
positive) + b)``: its slope and shift come from the prior and the same outputs for rows not seen alone.

Both samples are bounded (``POSITIVES`` and ``UNLABELLED`` rows, by a hash of the row); every whole text is scored.

Cases: null text counts as empty, and empty texts are scored; labels whose quality is null, or without a doc_id, are
left out; a doc_id of several labels is positive if one of them is 1, and so are all rows that have it; without
positives, or with hardly any, all scores are 0.5; rows of the held-out quarter are never learned from; rows without a doc_id are
unlabelled; other columns are kept by ``scored``, but those of the
result's names give way to it.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common

POSITIVES, UNLABELLED, CUT = 6000, 6000, 0.7
HIDDEN, STEPS, RATE, FOLDS = 24, 150, 0.02, 3
#: Estimates of the prior, each from networks of so many steps; the confidence of its bounds.
ROUNDS, ROUND_STEPS, DOUBT = 2, 150, 0.1
#: A feature counts as so many standard deviations at most, of at least FLOOR; DECAY of the weights.
CLIP, FLOOR, DECAY = 3, 0.1, 1e-3

# Classes of bytes (fixed values): the features are how often one follows another.
_CLASSES = [range(97, 123), range(65, 91), range(48, 58), [32], [10, 13], [46], [44], [33, 63], range(0xC0, 0x100), range(0x80, 0xC0), [9, 11, 12]]
_kinds = np.full(256, len(_CLASSES), np.uint8)
_kinds[:32] = len(_CLASSES) + 1
for _k, _c in enumerate(_CLASSES):
    _kinds[list(_c)] = _k
KINDS = len(_CLASSES) + 2
WIDTH = KINDS * KINDS + 13


def features(text: str | None) -> np.ndarray:
    """What the text looks like, whatever its language: pairs of byte classes, words, lines, repetition."""
    data = (text or "").encode()
    out = np.zeros(WIDTH, np.float32)
    if not data:
        return out
    kinds = _kinds[np.frombuffer(data, np.uint8)].astype(np.int32)
    if len(kinds) > 1:
        pairs = np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS * KINDS)
        out[: KINDS * KINDS] = np.sqrt(pairs / pairs.sum())
    words = data.split()
    if not words:
        return out
    n = len(words)
    distinct = set(words)
    lines = [s for s in data.split(b"\n") if s.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(w[-1] in b"!?#%&*$|" for w in words)
    more = [
        math.log1p(n) / 10, len(distinct) / n, len(distinct) / n**0.7, same / n, ends / n, lengths.mean() / 10, lengths.std() / 10, lengths.max() / 100,
        len(set(lines)) / len(lines), math.log1p(len(lines)) / 10, len(zlib.compress(data, 1)) / len(data), sum(w.isupper() for w in words) / n, sum(len(w) == 1 for w in words) / n,
    ]
    out[KINDS * KINDS :] = more
    return out


class Network:
    """One hidden layer on standardised features."""

    def __init__(self, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        weights = rng.normal(0, 1 / math.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), hidden), np.zeros(1)
        self.p = [w.astype(np.float32) for w in weights]

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return x, np.tanh(x @ self.p[0] + self.p[1])

    def output(self, x: np.ndarray) -> np.ndarray:
        return self._hidden(x)[1] @ self.p[2] + self.p[3][0]

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE) -> list[float]:
        """Non-negative risk with the sigmoid loss, by Adam; returns the risks on the way."""
        x = np.concatenate([positive, unlabelled]).astype(np.float32)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + FLOOR
        n, u = len(positive), len(unlabelled)
        m, v, risks = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], []
        for step in range(1, steps + 1):
            z, hidden = self._hidden(x)
            g = hidden @ self.p[2] + self.p[3][0]
            wrong = 1 / (1 + np.exp(np.clip(g, -30, 30)))  # loss of g as a positive; 1 - wrong as a negative
            positive_risk = prior * wrong[:n].mean()
            negative_risk = (1 - wrong[n:]).mean() - prior * (1 - wrong[:n]).mean()
            risks.append(positive_risk + max(0.0, negative_risk))
            slope = wrong * (1 - wrong)  # of the loss as a negative, by g
            d = np.zeros(n + u, np.float32)
            if negative_risk >= 0:
                d[:n] = -2 * prior * slope[:n] / n
                d[n:] = slope[n:] / u
            else:  # overfitted: step back out of the negative part
                d[:n] = prior * slope[:n] / n
                d[n:] = -slope[n:] / u
            back = d[:, None] * self.p[2][None, :] * (1 - hidden * hidden)
            grads = [z.T @ back + DECAY * self.p[0], back.sum(axis=0), hidden.T @ d + DECAY * self.p[2], np.array([d.sum()])]
            for k, gk in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.99 * v[k] + 0.01 * gk * gk
                self.p[k] = (self.p[k] - rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return risks

def least_ratio(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = DOUBT) -> float:
    """The class prior by the best bin: the least of share of unlabelled over share of positives above a cut."""
    cuts = np.sort(positive)
    above = 1 - np.arange(len(cuts)) / len(cuts)
    among = 1 - np.searchsorted(np.sort(unlabelled), cuts, "left") / len(unlabelled)
    bound = math.sqrt(math.log(4 / doubt) / 2) * (1 / math.sqrt(len(positive)) + 1 / math.sqrt(len(unlabelled)))
    best = int(np.argmin((among + 1.01 * bound) / above))
    return float(np.clip(among[best] / above[best], 0.01, 0.99))


def crossed(positive: np.ndarray, unlabelled: np.ndarray, prior: float, folds: int, steps: int) -> tuple[list[Network], np.ndarray, np.ndarray]:
    """A network for each fold, learned from the others, and the output for each row of the network that hasn't seen it."""
    networks, g = [], [np.empty(len(positive)), np.empty(len(unlabelled))]
    for k in range(folds):
        mine = [np.arange(len(x)) % folds == k for x in (positive, unlabelled)]
        networks.append(Network(seed=3 + k))
        networks[-1].fit(positive[~mine[0]], unlabelled[~mine[1]], prior, steps)
        for out, x, own in zip(g, (positive, unlabelled), mine):
            out[own] = networks[-1].output(x[own])
    return networks, *g


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = ROUNDS, steps: int = ROUND_STEPS) -> float:
    """The share of positives among the unlabelled."""
    prior = 0.5
    for _ in range(rounds):
        _, *g = crossed(positive, unlabelled, prior, 2, steps)
        prior = least_ratio(*g)
    return prior


class Model:
    """Networks, whose mean output counts, and the logistic map of it."""

    def __init__(self, networks: list[Network] = (), prior: float = 0.5):
        self.networks, self.prior, self.slope, self.shift = networks, prior, 1.0, 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        g = np.mean([n.output(x) for n in self.networks], axis=0) if self.networks else np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self.slope * g + self.shift, -30, 30)))

    def calibrate(self, positive: np.ndarray, unlabelled: np.ndarray) -> None:
        """From outputs for rows not seen: the logistic map of least unbiased risk, by Newton's method; a little weight keeps the slope finite."""
        g = unlabelled
        rows = np.stack([g, np.ones_like(g)], axis=1)
        aim = self.prior * np.array([positive.mean(), 1.0])
        a, ridge = np.array([1.0, 0.0]), np.array([1e-3, 0.0])

        def risk(a: np.ndarray) -> float:
            return float(np.logaddexp(0, rows @ a).mean() - aim @ a + 0.5 * ridge @ (a * a))

        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
            slope = (rows * p[:, None]).mean(axis=0) - aim + ridge * a
            h = (rows * (p * (1 - p))[:, None]).T @ rows / len(g) + 1e-6 * np.eye(2)
            step = np.linalg.solve(h, slope)
            size = 1.0
            while size > 1e-6 and risk(a - size * step) > risk(a):
                size /= 2
            a = a - size * step
            if np.abs(size * step).max() < 1e-7:
                break
        self.slope, self.shift = max(float(a[0]), 1e-3), float(a[1])


def fitted(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model of the features of positives and of unlabelled texts."""
    if min(len(positive), len(unlabelled)) < 2 * FOLDS:
        return Model()
    prior = class_prior(positive, unlabelled)
    networks, *g = crossed(positive, unlabelled, prior, FOLDS, STEPS)
    model = Model(networks, prior)
    model.calibrate(*g)
    return model


def _featured(rows: DataFrame, schema: str) -> DataFrame:
    """Features of ``text`` beside the other columns."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            f = [features(t) for t in b.column("text").to_pylist()]
            rest = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(f, pa.list_(pa.float32()))], [*rest, "features"])

    return rows.mapInArrow(common.releasing(run), schema + ", features array<float>")


def _drawn(texts: DataFrame, rows: int) -> np.ndarray:
    """Features of at most ``rows`` rows (doc_id, text), those of the smallest hashes."""
    hashed = texts.select(F.col("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("_hash"))
    total = hashed.count()
    if total > rows:
        if total > 4 * rows:
            hashed = hashed.where(F.col("_hash") < int((1 << 40) * 3 * rows / total))
        cut = hashed.select("_hash").orderBy("_hash").limit(rows).agg(F.max("_hash")).first()[0]
        hashed = hashed.where(F.col("_hash") <= cut)
    got = _featured(hashed, "_hash long").orderBy("_hash", "features").limit(rows).select("features").collect()
    return np.array([r["features"] for r in got], np.float32).reshape(len(got), WIDTH)


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """The model of a bounded sample of positives and one of unlabelled text."""
    marked = labels.where("doc_id is not null and quality = 1").where(common.crc_bucket(F.col("doc_id")) != 2).select("doc_id").distinct()
    # at most `positives` ids
    ids = common.hashed_sample(marked, positives, marked.count(), "doc_id").collect()
    chosen = docs.sparkSession.createDataFrame(ids, marked.schema)
    plain = docs.where(common.crc_bucket(F.col("doc_id")) != 2).select("doc_id", "text")
    trusted = plain.join(F.broadcast(chosen), "doc_id", "left_semi")
    return fitted(_drawn(trusted, positives), _drawn(plain, unlabelled))


def scored(docs: DataFrame, model: Model, cut: float = CUT, into: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns of ``docs`` with score and predicted, named as ``into`` says, of every whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in into]
    kept, at = docs.select(*common.quoted(rest)), rest.index("text")

    def run(batches):
        import pyarrow as pa

        model = held.value
        for b in batches:
            f = [features(t) for t in b.column(at).to_pylist()]
            s = model.score(np.array(f, np.float32).reshape(len(f), WIDTH)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32))], [*rest, *into])

    schema = StructType([*kept.schema.fields]).add(into[0], "double").add(into[1], "integer")
    return kept.toDF(*[f"c{k}" for k in range(len(rest))]).mapInArrow(common.releasing(run), schema)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.arrow_rows(spark, 256)
    docs = common.table(spark, sf_dir, "documents")
    model = learn(docs, common.table(spark, sf_dir, "labels"))
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (common.crc_bucket(F.col("doc_id")) == 2).alias("held_out"), "score", "predicted")
