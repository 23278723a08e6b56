"""Language identification by a bidirectional gated recurrent network over bytes (operator 9).

The network reads a text's bytes in both directions from end to end, gives each position a distribution over the
languages, and a document's distribution is the mean over all its positions.  It is trained in numpy by
backpropagation through time on a bounded sample of labelled rows (``SAMPLE`` of each language, by a hash of the
text, each text once): batches of stretches of TRAIN_BYTES bytes are drawn from all of their whole texts.

PANEL texts of about one length are read side by side, longest first, in both directions at once, each from its own
start and its own end, so that a step goes on with those that are not through.  A panel has about POSITIONS
positions at most, or one text.

Cases: a text that is null or has no letter (Unicode category L) is ``und`` with score 0; rows without lang, and
rows of the held-out quarter, are never learned from; with nothing to learn from every text is ``und``; equal rows
give equal rows; a null doc_id falls into the bucket of the empty text; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

SAMPLE = 400
HIDDEN, TRAIN_BYTES = 8, 96
STEPS, BATCH, RATE = 200, 160, 0.02
#: Texts and positions that are read side by side, characters that are dealt to panels at once.
PANEL, POSITIONS, BLOCK = 1024, 8_000_000, 32_000_000
#: Positions whose inputs are looked up at once, where few texts are left.
LOOKUP = 8192
_letter = regex.compile(r"\p{L}")


class Network:
    """Weights: for each direction input rows W (256, 3H) and recurrent U (H, 3H), and the output layer."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.classes, self.h = classes, hidden
        self.p = {}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p["U" + d] = rng.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32)
            self.p["O" + d] = rng.normal(0, 0.3, (hidden, len(classes))).astype(np.float32)
        self.p["c"] = np.zeros(len(classes), np.float32)

    def states(self, x: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """Hidden states (T, B, H) of one direction; x is (T, B) in reading order."""
        h, n = self.h, x.shape[1]
        W, U = self.p["W" + d], self.p["U" + d]
        s = np.zeros((n, h), np.float32)
        out = np.empty((len(x), n, h), np.float32)
        for t in range(len(x)):
            a, r = W[x[t]], s @ U
            gates = a[:, : 2 * h]
            gates += r[:, : 2 * h]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, reset = gates[:, :h], gates[:, h:]
            new = a[:, 2 * h :]
            new += reset * r[:, 2 * h :]
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((s, z, reset, new, r[:, 2 * h :]))
            s = new + z * (s - new)
            out[t] = s
        return out

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """Mean distribution over the positions of each text; zeros for an empty one."""
        data = [np.frombuffer((t or "").encode(), np.uint8) for t in texts]
        order = sorted((k for k in range(len(data)) if len(data[k])), key=lambda k: -len(data[k]))
        pooled = np.zeros((len(texts), len(self.classes)))
        while order:
            size = np.cumsum([len(data[k]) for k in order[:PANEL]])
            n = max(1, int(np.searchsorted(size, POSITIONS, "right")))
            pooled[order[:n]] = self._means([data[k] for k in order[:n]])
            order = order[n:]
        return pooled

    def _means(self, texts: list[np.ndarray]) -> np.ndarray:
        """Mean distributions of texts that are read side by side, longest first."""
        lengths = np.array(list(map(len, texts)))
        widths = np.searchsorted(-lengths, -np.arange(lengths[0]))  # texts that are longer than t
        ends = np.cumsum(widths)
        starts = ends - widths
        x = np.empty((2, ends[-1]), np.uint8)  # what each direction reads, step by step
        for r, text in enumerate(texts):
            at = starts[: len(text)] + r
            x[0, at], x[1, at] = text, text[::-1]
        forth, back = self._walk(x, widths, starts, ends)
        out = np.empty((len(texts), len(self.classes)))
        for r, n in enumerate(lengths):
            at = starts[:n] + r
            prob = forth.take(at, axis=0)
            prob += back.take(at[::-1], axis=0)
            prob += self.p["c"]
            prob = np.ascontiguousarray(prob.T)
            prob -= prob.max(axis=0)
            np.exp(prob, out=prob)
            prob /= prob.sum(axis=0)
            out[r] = prob.mean(axis=1, dtype=np.float64)
        return out

    def _walk(self, x: np.ndarray, widths: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """What the states of each direction add to the classes: (2, positions, C).

        As ``states``, for scoring: the batch is innermost, and the directions stand below each other, gate by gate, so
        that a step is a few long loops.
        """
        h, n = self.h, int(widths[0])
        gate = [slice(k * h, (k + 1) * h) for k in range(6)]
        W, U = {}, np.zeros((6 * h, 2 * h), np.float32)
        for k, d in enumerate("fb"):
            for part in range(3):
                half = 0.5 if part < 2 else 1  # the logistic function is a tanh of half its argument
                W[k, part] = np.ascontiguousarray(self.p["W" + d][:, gate[part]].T * np.float32(half))
                U[gate[2 * part + k], gate[k]] = self.p["U" + d][:, gate[part]].T * half
        s, r = np.zeros((2 * h, n), np.float32), np.empty((6 * h, n), np.float32)
        out = np.empty((2, ends[-1], len(self.classes)), np.float32)
        tanh, add, multiply, matmul = np.tanh, np.add, np.multiply, np.matmul
        first = 0
        while first < len(widths):  # the steps from first to last are looked up at once
            low = starts[first]
            last = max(int(np.searchsorted(ends, low + LOOKUP, "right")), first + 1)
            high = ends[last - 1]
            inputs, kept = np.empty((6 * h, high - low), np.float32), np.empty((2 * h, high - low), np.float32)
            for (k, part), w in W.items():
                np.take(w, x[k, low:high], axis=1, mode="clip", out=inputs[gate[2 * part + k]])
            for m, at in zip(widths[first:last].tolist(), (starts[first:last] - low).tolist()):
                if m < n:
                    s, r, n = np.ascontiguousarray(s[:, :m]), np.empty((6 * h, m), np.float32), m
                a = inputs[:, at : at + m]
                gates, reset, new, rest = a[: 4 * h], a[2 * h : 4 * h], a[4 * h :], r[4 * h :]
                matmul(U, s, out=r)
                add(gates, r[: 4 * h], out=gates)
                tanh(gates, out=gates)
                add(gates, 1, out=gates)
                multiply(gates, 0.5, out=gates)
                multiply(rest, reset, out=rest)
                add(new, rest, out=new)
                tanh(new, out=new)
                s -= new
                s *= a[: 2 * h]
                s += new
                kept[:, at : at + m] = s
            for k, d in enumerate("fb"):
                out[k, low:high] = kept[gate[k]].T @ self.p["O" + d]
            first = last
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients, by backpropagation through time; y is by sequence, weight by sequence or position."""
        h, (length, n) = self.h, x.shape
        traces: dict[str, list] = {"f": [], "b": []}
        reading = {"f": x, "b": x[::-1]}
        states = {d: self.states(reading[d], d, traces[d]) for d in "fb"}
        logits = states["f"] @ self.p["Of"] + states["b"][::-1] @ self.p["Ob"] + self.p["c"]
        logits -= logits.max(axis=-1, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=-1, keepdims=True)
        w = np.broadcast_to(weight, x.shape)
        w = (w / w.sum()).astype(np.float32)
        loss = float(-(np.log(prob[:, np.arange(n), y] + 1e-9) * w).sum())
        prob[:, np.arange(n), y] -= 1
        delta = prob * w[:, :, None]
        g = {"c": delta.sum(axis=(0, 1))}
        for d in "fb":
            out = delta if d == "f" else delta[::-1]
            g["O" + d] = np.tensordot(states[d], out, ((0, 1), (0, 1)))
            U, back = self.p["U" + d], out @ self.p["O" + d].T
            gW, gU, ds = np.zeros_like(self.p["W" + d]), np.zeros_like(U), np.zeros((n, h), np.float32)
            for t in range(length - 1, -1, -1):
                s, z, reset, new, rec = traces[d][t]
                ds = ds + back[t]
                dnew = ds * (1 - z) * (1 - new * new)
                da = np.concatenate([ds * (s - new) * z * (1 - z), dnew * rec * reset * (1 - reset), dnew], axis=1)
                dr = da.copy()
                dr[:, 2 * h :] *= reset
                gU += s.T @ dr
                np.add.at(gW, reading[d][t], da)
                ds = ds * z + dr @ U.T
            g["W" + d], g["U" + d] = gW, gU
        return loss, g

    def train(self, texts: list[bytes], y: np.ndarray, stretch: int = TRAIN_BYTES, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> float:
        """Adam over random batches of stretches of all texts; classes count alike. Returns the last loss."""
        rng, loss = np.random.default_rng(seed), 0.0
        lengths = np.array([len(t) for t in texts])
        pieces = -(-lengths // stretch)
        owner = np.repeat(np.arange(len(texts)), pieces)
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * stretch
        size = np.minimum(lengths[owner] - at, stretch)
        at += np.repeat(np.cumsum(lengths) - lengths, pieces)
        data = np.frombuffer(b"".join(texts) + bytes(stretch), np.uint8)
        y, within = y[owner], np.arange(stretch)[:, None]
        share = np.bincount(y, minlength=len(self.classes)).astype(float)
        weight = (1 / np.maximum(share, 1))[y]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(owner), min(batch, len(owner)))
            loss, g = self.gradients(data[at[pick] + within], y[pick], weight[pick] * (within < size[pick]))
            scale = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, p in self.p.items():
                gk = np.clip(g[k], -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * gk
                v2[k] = 0.99 * v2[k] + 0.01 * gk * gk
                p -= (scale * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return loss


def sample(docs: DataFrame, rows: int = SAMPLE) -> list[tuple[str, str]]:
    """(text, lang) of at most ``rows`` texts of each language, outside the held-out quarter, by a hash of the text."""
    learn = docs.where("lang is not null and text is not null").where(common.crc_bucket(F.col("doc_id")) != 2)
    learn = learn.select("text", "lang", F.pmod(F.xxhash64("text"), F.lit(1 << 40)).alias("_hash"))
    # Texts far above the cut are left out before any text moves; languages are classes, which the driver holds anyway.
    count = learn.groupBy("lang").agg(F.approx_count_distinct("_hash").alias("n")).collect()
    cuts = docs.sparkSession.createDataFrame([(r["lang"], 3.0 * rows / max(r["n"], 1) * (1 << 40)) for r in count], "_lang string, _cut double")
    few = learn.join(F.broadcast(cuts), F.col("lang") == F.col("_lang")).where("_hash < _cut").dropDuplicates(["lang", "text"])
    order = Window.partitionBy("lang").orderBy("_hash", "text")
    few = few.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= rows)
    return [(r["text"], r["lang"]) for r in few.orderBy("lang", "_rank").select("text", "lang").collect()]


def fit(rows: list[tuple[str, str]], **settings) -> Network | None:
    rows = [(text, lang) for text, lang in rows if _letter.search(text)]
    if not rows:
        return None
    net = Network(sorted({lang for _, lang in rows}))
    net.train([text.encode() for text, _ in rows], np.array([net.classes.index(lang) for _, lang in rows]), **settings)
    return net


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text."""
    held = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        import pyarrow as pa

        net = held.value
        for ids, held_out, texts in common.gathered(batches, BLOCK):
            texts = [t if t is not None and _letter.search(t) else None for t in texts]
            if net is None:
                langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            else:
                prob = net.documents(texts)
                langs = ["und" if t is None else net.classes[k] for t, k in zip(texts, prob.argmax(axis=1))]
                scores = [0.0 if t is None else min(1.0, float(p)) for t, p in zip(texts, prob.max(axis=1))]
            yield pa.RecordBatch.from_arrays([ids, held_out, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", (common.crc_bucket(F.col("doc_id")) == 2).alias("held_out"), "text")
    return given.mapInArrow(common.releasing(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.arrow_rows(spark, 256)
    docs = common.table(spark, sf_dir, "documents")
    return predict(docs, fit(sample(docs)))
