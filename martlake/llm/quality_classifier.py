"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE_WORDS`` words each, through the
whole text). Each passage is described by shares of character classes, of
single punctuation marks, of repeated and of distinct words, and is encoded by
a small layer, h = tanh(W x + c). A gated attention, softmax over the bag of
w . (tanh(V h) * sigmoid(U h)), weighs the passages; the weighted sum of h
gives the score. Only documents are labelled; which passages matter is learnt
with the rest by gradient descent (Adam, fixed seed, numpy).

Training rows: labelled rows whose crc32(doc_id as text) mod 5 is not 0, at
most ``TRAIN_ROWS`` of each label in the order of a hash of their id, texts of
any length. Tasks read the whole texts and describe their passages; a text of
more than ``TRAIN_PASSAGES`` of them gives that many, in the order of a hash of
their number, so that they lie all over the text. The two bounds hold what
reaches the driver (descriptions, no texts) below 113 MB; the labels are weighed
back to their shares among all such rows. Every row is scored, on all passages
of its whole text, by tasks that hold one batch at a time. Only texts are inputs.

Defined results: null and empty texts, and texts of blanks, are a bag of one
empty passage and get its score; rows that repeat get equal scores; without
labels of both kinds every score is the share of label 1 (1 without any); an
empty table gives no rows; further columns are carried and never read.
"""

from __future__ import annotations

import string
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ship, text_of

PASSAGE_WORDS = 64
TRAIN_ROWS = 2500
TRAIN_PASSAGES = 128
THRESHOLD = 0.3
FOLDS = 5
HIDDEN = 16
GATE = 8
#: Gradient steps; the passes over the sample follow from them.
STEPS = 600
BATCH = 256
RATE = 0.01
DECAY = 1e-4

_MARKS = [c.encode() for c in string.punctuation]
_CLASSES = [string.ascii_uppercase.encode(), string.ascii_lowercase.encode(), string.digits.encode(),
            string.punctuation.encode(), bytes(range(128, 256)), bytes([*range(9), *range(14, 32), 127])]
FEATURES = 6 + len(_CLASSES) + len(_MARKS)


# --- passages ---------------------------------------------------------------

def passage_features(words: list[bytes]) -> list[float]:
    joined = b" ".join(words)
    n, size = len(words), max(1, len(joined))
    if not n:
        return [0.0] * FEATURES
    same = sum(map(bytes.__eq__, words, words[1:]))
    low = joined.lower().split()
    out = [1.0, n / PASSAGE_WORDS, len(set(low)) / n, same / n, min(1.0, size / n / 20),
           sum(map(len, {*words})) / size]
    out += [(size - len(joined.translate(None, c))) / size for c in _CLASSES]
    out += [min(1.0, 4 * joined.count(c) / n) for c in _MARKS]
    return out


def passages(words: int, most: int | None = None):
    """First words of all passages, or of ``most`` in the order of a hash."""
    at = range(0, max(1, words), PASSAGE_WORDS)
    if most is None or len(at) <= most:
        return at
    return sorted(sorted(at, key=lambda k: (zlib.crc32(b"%d" % k), k))[:most])


def bag(text: str, most: int | None = None) -> np.ndarray:
    """The descriptions of the passages, one in a row."""
    words = text.encode("utf-8", "replace").split()
    return np.array([passage_features(words[k:k + PASSAGE_WORDS]) for k in passages(len(words), most)], np.float32)


# --- the model --------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(m: dict, x: np.ndarray, starts: np.ndarray):
    """Scores of the bags that begin at ``starts``, and what the gradient needs."""
    x = (x - m["mean"]) / m["scale"]
    h = np.tanh(x @ m["W"] + m["c"])
    t, s = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = (t * s) @ m["w"]
    sizes = np.diff(np.append(starts, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return _sigmoid(z @ m["v"] + m["b"]), (x, h, t, s, a, z, sizes)


def gradient(m: dict, x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    score, (x, h, t, s, a, z, sizes) = forward(m, x, starts)
    d = (score - y) * weight / weight.sum()
    dz = np.repeat(d[:, None] * m["v"], sizes, axis=0)
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
    dg = de[:, None] * m["w"]
    dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
    dh = a[:, None] * dz + dt @ m["V"].T + ds @ m["U"].T
    dx = dh * (1 - h * h)
    return {"W": x.T @ dx, "c": dx.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds,
            "w": (t * s).T @ de, "v": z.T @ d, "b": d.sum()}


def fit(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> dict:
    """Model parameters; constant when there are not labels of both kinds."""
    rng = np.random.default_rng(7)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 1.0
        return {"constant": np.array(share)}
    every = np.concatenate(bags).astype(np.float64)
    m = {"mean": every.mean(axis=0), "scale": every.std(axis=0) + 0.01,
         "W": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "c": np.zeros(HIDDEN),
         "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)),
         "w": rng.normal(0, 0.3, GATE), "v": rng.normal(0, 0.3, HIDDEN), "b": np.zeros(())}
    names = ["W", "c", "V", "U", "w", "v", "b"]
    first = {n: np.zeros_like(m[n]) for n in names}
    second = {n: np.zeros_like(m[n]) for n in names}
    step, epochs = 0, -(-steps // -(-len(y) // BATCH))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        rate = RATE * (1 - epoch / epochs) + 1e-4
        for k in range(0, len(y), BATCH):
            pick = order[k:k + BATCH]
            sizes = [len(bags[i]) for i in pick]
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
            g = gradient(m, np.concatenate([bags[i] for i in pick]), starts, y[pick], weight[pick])
            step += 1
            for n in names:
                d = g[n] + DECAY * m[n]
                first[n] = 0.9 * first[n] + 0.1 * d
                second[n] = 0.999 * second[n] + 0.001 * d * d
                m[n] = m[n] - rate * (first[n] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)
    return m


def score_texts(m: dict, texts) -> np.ndarray:
    if "constant" in m:
        return np.full(len(texts), float(m["constant"]))
    out = np.empty(len(texts))
    held, at, size = [], 0, 0
    for n, text in enumerate(texts):
        held.append(bag(text or ""))
        size += len(held[-1])
        if size > 20_000 or n == len(texts) - 1:
            starts = np.concatenate(([0], np.cumsum([len(b) for b in held])[:-1])).astype(np.int64)
            out[at:n + 1] = forward(m, np.concatenate(held).astype(np.float64), starts)[0]
            held, at, size = [], n + 1, 0
    return out


# --- on tables --------------------------------------------------------------

def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS, steps: int = STEPS) -> dict:
    known = (labels.filter(F.col(f"`{label_col}`").isin(0, 1) & F.col(f"`{id_col}`").isNotNull()
                           & ~held_out(id_col))
             .select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{label_col}`").cast("int").alias("label")))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(f"`{text_col}`").alias("text"))
    ship(docs.sparkSession)

    @F.pandas_udf("binary")
    def described(text: pd.Series) -> pd.Series:
        return text.map(lambda t: bag(t, TRAIN_PASSAGES).tobytes())
    got = []
    for label in sorted(shares):
        some = known.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(rows)
        got += (texts.join(F.broadcast(some), "id").select("id", "label", described("text").alias("bag"))
                .orderBy(F.xxhash64("id"), "id", "bag").limit(rows).collect())
    y = np.array([r["label"] for r in got], float)
    seen = {k: max(1, int((y == k).sum())) for k in shares}
    weight = np.array([shares[r["label"]] / seen[r["label"]] for r in got])
    return fit([np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in got], y, weight, steps)


def scorer(docs: DataFrame, model: dict):
    """A column function: text -> score."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(score_texts(shared.value, text.tolist()))
    return score


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    score = scorer(docs, train(docs, labels, id_col, text_col, label_col))
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), held_out(id_col).alias("held_out"),
                        score(text_of(f"`{text_col}`")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all columns."""
    score = scorer(docs, train(docs, labels, id_col, text_col, label_col))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.filter(score(text_of(f"row.`{text_col}`")) >= threshold).select("row.*")
