"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Each passage is
encoded as means of word statistics and of hashed word signs; a gated attention
layer, learned from document labels alone, weighs the passages, and the weighted
representation is scored.  So one junk passage can decide about a long document.

Training: at most ``TRAIN_DOCS`` labelled documents (those of smallest id hash),
encoded whole on the executors; of these, in the order of the hash, as many as
hold ``TRAIN_PASSAGES`` passages together (a document that holds more by itself
is no part of the sample).  The network (a few thousand weights) is fitted by
Adam with numpy.  Scoring reads every whole text.

Defined cases: a text that is null or has no word scores 0; a document with
several labels counts as good only if all say so; null labels teach nothing;
rows that repeat are scored alike; without labels of both kinds every text with
a word scores the share of good ones (1 if there are no labels); very long texts are
bags of all their passages; ties do not arise, each text being scored by itself; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from convometrics.llm.common import hash_sample, map_texts, mix64, run_hashes, small_batches, span_hashes, stored, text_slices, words_of

PASSAGE_WORDS = 64
TRAIN_DOCS = 4000
TRAIN_PASSAGES = 200_000  # of all documents together: 20 MB
SIGNS = 12
HIDDEN, GATE = 24, 16
THRESHOLD = 0.3
N_STATS = 12
N_FEATURES = N_STATS + SIGNS


def _byte_kind(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], dtype=np.float64)


_UPPER = _byte_kind(lambda b: 65 <= b <= 90)
_LOWER = _byte_kind(lambda b: 97 <= b <= 122)
_WIDE = _byte_kind(lambda b: b >= 0xC0)
_DIGIT = _byte_kind(lambda b: 48 <= b <= 57)
_STOP = _byte_kind(lambda b: chr(b) in ".,;:")
_SHOUT = _byte_kind(lambda b: chr(b) in "!?")
_SIGN = _byte_kind(lambda b: b < 128 and chr(b) in "#*$%&|<>=@_{}[]\\^~`+")
_FIRST = _byte_kind(lambda b: b & 0xC0 != 0x80)


def encode(texts: pa.Array, passage_words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages in order, n + 1 passage offsets of the texts)."""
    w = words_of(texts)
    counts = -(-w.per_doc // passage_words)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    if not len(w.start):
        return np.zeros((0, N_FEATURES), np.float32), bounds
    # first word of each passage
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = w.doc_words[:-1][owner] + (np.arange(bounds[-1]) - bounds[:-1][owner]) * passage_words
    size = np.diff(np.append(begin, len(w.start))).astype(np.float64)

    word_bytes = np.concatenate((w.start, [len(w.data)]))[begin]  # first byte of each passage
    per_byte = np.stack([np.add.reduceat(kind[w.data], word_bytes) for kind in (_UPPER, _LOWER, _WIDE, _DIGIT, _STOP, _SHOUT, _SIGN, _FIRST)], 1)
    hashes = span_hashes(w.data, w.start, w.end, fold=True)
    passage = np.repeat(np.arange(len(begin), dtype=np.uint64), size.astype(np.int64)) * np.uint64(0x9E3779B97F4A7C15)
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])

    def share_new(keys, groups):
        fresh = np.zeros(len(keys))
        fresh[np.unique(keys, return_index=True)[1]] = 1
        return np.add.reduceat(fresh, groups)

    distinct = share_new(mix64(hashes + passage), begin)
    doc = w.doc_of_word().astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    new_pairs = np.append(run_hashes(hashes, 2), np.uint64(0)) + doc
    fresh_pairs = share_new(mix64(new_pairs), begin)  # word pairs that the document has not shown before
    length = (w.end - w.start).astype(np.float64)
    long_words = np.add.reduceat((length > 15) * 1.0, begin)
    chars = np.maximum(per_byte[:, 7:8], 1)
    stats = np.concatenate(
        (
            per_byte[:, :7] / chars * 5,
            (distinct / size)[:, None],
            (fresh_pairs / size)[:, None],
            (np.add.reduceat(again, begin) / size)[:, None],
            (np.log1p(size) / 4)[:, None],
            (long_words / size)[:, None],
        ),
        axis=1,
    )
    bits = (hashes[:, None] >> np.arange(20, 20 + SIGNS, dtype=np.uint64)) & np.uint64(1)
    signs = np.add.reduceat(bits.astype(np.float64) * 2 - 1, begin, axis=0) / size[:, None]
    return np.concatenate((stats, signs), axis=1).astype(np.float32), bounds


class AttentionMil:
    """tanh encoder, gated attention, logistic output; weights in ``w``."""

    def __init__(self, n_features: int = N_FEATURES, seed: int = 7):
        rnd = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(n_features), np.ones(n_features)
        self.w = {
            "E": rnd.normal(0, n_features**-0.5, (n_features, HIDDEN)),
            "e": np.zeros(HIDDEN),
            "V": rnd.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "U": rnd.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "a": rnd.normal(0, GATE**-0.5, GATE),
            "o": np.zeros(HIDDEN),
            "b": np.zeros(1),
        }

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict:
        w, start = self.w, bounds[:-1]
        h = np.tanh((x - self.mean) / self.scale @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        weight = (t * g) @ w["a"]
        bag = np.repeat(np.arange(len(start)), np.diff(bounds))
        weight = np.exp(weight - np.maximum.reduceat(weight, start)[bag])
        alpha = weight / np.add.reduceat(weight, start)[bag]
        z = np.add.reduceat(alpha[:, None] * h, start, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ w["o"] + w["b"][0], -30, 30)))
        return {"x": (x - self.mean) / self.scale, "h": h, "t": t, "g": g, "alpha": alpha, "z": z, "score": score, "bag": bag}

    def gradients(self, f: dict, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy."""
        w, bag, start = self.w, f["bag"], np.flatnonzero(np.diff(f["bag"], prepend=-1))
        d_out = (f["score"] - y) / len(y)
        d_z = d_out[:, None] * w["o"]
        d_h = f["alpha"][:, None] * d_z[bag]
        d_alpha = (f["h"] * d_z[bag]).sum(1)
        mean = np.add.reduceat(f["alpha"] * d_alpha, start)
        d_weight = f["alpha"] * (d_alpha - mean[bag])
        d_t = d_weight[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
        d_g = d_weight[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
        d_h = (d_h + d_t @ w["V"].T + d_g @ w["U"].T) * (1 - f["h"] ** 2)
        return {
            "E": f["x"].T @ d_h,
            "e": d_h.sum(0),
            "V": f["h"].T @ d_t,
            "U": f["h"].T @ d_g,
            "a": (f["t"] * f["g"]).T @ d_weight,
            "o": f["z"].T @ d_out,
            "b": np.array([d_out.sum()]),
        }

    def fit(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, seed: int = 11):
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        rnd = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for some in np.array_split(rnd.permutation(len(y)), max(1, len(y) // batch)):
                sizes = bounds[some + 1] - bounds[some]
                rows = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in some])
                grads = self.gradients(self.forward(x[rows], np.concatenate(([0], np.cumsum(sizes)))), y[some])
                step += 1
                for k, grad in grads.items():
                    grad = grad + 1e-4 * self.w[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad**2
                    self.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_passages: int = TRAIN_PASSAGES):
    """A fitted network, or the share of good documents where there is nothing to tell apart.

    ``labels``: (doc_id, quality), the ones to learn from.
    """
    small_batches(docs.sparkSession)
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = hash_sample(usable, "doc_id", train_docs)  # bounds what is broadcast and collected
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def encoded(texts):
        x, bounds = encode(texts)
        return {"n": np.diff(bounds), "x": [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]}

    bags = map_texts(sample, encoded, "doc_id long, quality int, n long, x binary", ["doc_id", "quality"])
    bags = stored(bags.withColumn("draw", F.xxhash64(F.lit("bag"), "doc_id")), "mil-bags").filter(F.col("n").between(1, train_passages))
    sizes = bags.select("draw", "n").toPandas().sort_values("draw")  # train_docs rows at most
    drawn = sizes["draw"][sizes["n"].cumsum() <= train_passages]
    last = int(drawn.iloc[-1]) if len(drawn) else None
    # bounded: train_passages in whole bags
    rows = bags.filter(F.col("draw") <= F.lit(last)).select("doc_id", "quality", "x").toPandas().sort_values("doc_id")
    y = rows["quality"].to_numpy(float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 1.0
    parts = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for x in rows["x"]]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return AttentionMil().fit(np.concatenate(parts), bounds, y)


def scores_of(model, texts: pa.Array) -> np.ndarray:
    """Score of each text; ``model`` as returned by ``train``."""
    x, bounds = encode(texts)
    out = np.zeros(len(bounds) - 1)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = model if isinstance(model, float) else model.forward(x, np.append(bounds[:-1][some], bounds[-1]))["score"]
    return out


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id and score of every document."""
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(typed, lambda texts: {"score": scores_of(model, texts)}, "doc_id long, score double", ["doc_id"])


def held_out() -> F.Column:
    """Documents that the classifier must not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned from the labels of those not held out."""
    model = train(docs, labels.filter(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their columns unchanged."""
    model = train(docs, labels.filter(~held_out()))

    def accept(texts: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.binary())})
        found = [scores_of(model, part.column("text")) >= THRESHOLD for part in text_slices(batch)]
        return pd.Series(np.concatenate(found) if found else np.zeros(0, bool))

    return docs.filter(F.pandas_udf(accept, BooleanType())(F.col("text").cast("binary")))
