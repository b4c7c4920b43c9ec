"""Language identification as multilingual mixture inference.

A profile gives each language the probabilities of hashed byte n-grams.  The
words of a document are taken to come from a mixture of languages: expectation
maximisation estimates the proportions from the words' n-gram likelihoods.  This
is done for nested sets of languages, the likeliest first, until the likelihood
of all languages could not pay for another one; the set of the best penalised
likelihood (BIC) is kept, and its largest proportion is the answer.

Learning: at most about ``TRAIN_DOCS`` documents of each language, those of
smallest id hash; the counts are summed on eight tasks.  Prediction reads every
whole text.

Defined cases: a text that is null or has no letter (Unicode property L; numerals
such as one half are none) is ``und`` with score 0; very long texts are read whole;
without a learned language every text is ``und``; of equal proportions the
language first in code-point order wins; rows that repeat are predicted alike;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convometrics.llm.common import IS_SPACE, map_texts, small_batches, stored, text_slices, words_of

TRAIN_DOCS = 3000
BUCKET_BITS = 16
SMOOTHING = 0.5
ROUNDS = 12
TRACE = 0.01  # a second language below this share is none
PENALTY = 3.0  # times the BIC penalty of half a log of the number of words
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[IS_SPACE] = 32


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram bucket at each byte of a word, word offsets into them, document offsets into the words).

    The n-gram at a byte is the byte before, itself and the two after it, as they stand in the padded word.
    """
    w = words_of(texts)
    size = w.end - w.start
    word = np.concatenate(([0], np.cumsum(size)))
    if not len(size):
        return np.zeros(0, np.int64), word, w.doc_words
    # words side by side, one space before and two after each
    at = np.arange(word[-1]) + np.repeat(3 * np.arange(len(size)) + 1, size)
    padded = np.full(word[-1] + 3 * len(size) + 1, 32, np.uint32)
    inside = ~IS_SPACE[w.data]
    padded[at] = _LOWER[w.data[inside]]
    code = padded[at - 1] | padded[at] << 8 | padded[at + 1] << 16 | padded[at + 2] << 24
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), word, w.doc_words


def _counts(docs: DataFrame) -> dict[str, np.ndarray]:
    """n-gram counts by language of (lang, text); a bounded number of documents."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_slices(batch):
                bucket, word, doc = grams(part.column("text"))
                at = word[doc]
                for i, lang in enumerate(part.column("lang").to_pylist()):
                    have = total.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                    have += np.bincount(bucket[at[i] : at[i + 1]], minlength=1 << BUCKET_BITS)
        yield pa.RecordBatch.from_pydict({"lang": list(total), "n": [v.tobytes() for v in total.values()]}, pa.schema([("lang", pa.string()), ("n", pa.binary())]))

    found: dict[str, np.ndarray] = {}
    parts = docs.select("lang", F.col("text").cast("binary").alias("text")).repartition(8)
    for row in parts.mapInArrow(count, "lang string, n binary").toLocalIterator():
        counts = np.frombuffer(row["n"], np.int64)
        found[row["lang"]] = found[row["lang"]] + counts if row["lang"] in found else counts
    return found


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by bucket and language) from (doc_id, text, lang)."""
    small_batches(docs.sparkSession)
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    per_lang = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # every document draws a number by its id; a language's share is such that about train_docs stay
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("lang"), "doc_id"), 11) / F.lit(float(1 << 53))
    few = usable.select("doc_id", "lang").join(stored(per_lang, "lang-sizes"), "lang").filter(draw * F.col("n") < train_docs)
    few = stored(few.select(F.col("doc_id").alias("__doc"), "lang"), "lang-sample")
    sample = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("__doc")).select("lang", "text")
    counts = _counts(sample)
    langs = sorted(counts)
    table = np.stack([counts[x] for x in langs], 1) if langs else np.zeros((1 << BUCKET_BITS, 0))
    table = table + SMOOTHING
    return langs, np.log(table / table.sum(0)).astype(np.float32)


def _em(like: np.ndarray, start: np.ndarray, doc: np.ndarray, allowed: np.ndarray, n: np.ndarray):
    """Proportions by document over the allowed languages and the log likelihood (less the words' best terms)."""
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        part = like * share[doc]
        part /= part.sum(1, keepdims=True)
        share = np.add.reduceat(part, start, axis=0) / n[:, None]
    total = (like * share[doc]).sum(1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-300)), start)


def mixtures(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language proportions of each text, whether it has a word); rows of texts without words are zero."""
    bucket, word, doc_words = grams(texts)
    n = np.diff(doc_words)
    out = np.zeros((len(n), table.shape[1]))
    some = np.flatnonzero(n)
    if not len(some) or not table.shape[1]:
        return out, n > 0
    # the words of the texts that have any
    start, count = doc_words[:-1][some], n[some]
    logs = np.add.reduceat(table[bucket], word[:-1], axis=0).astype(np.float64)
    best = logs.max(1, keepdims=True)
    like = np.exp(np.maximum(logs - best, -60))
    doc = np.repeat(np.arange(len(some)), count)
    langs = table.shape[1]
    # a single language needs no estimation, and is the one whose likelihood is best
    single = np.add.reduceat(logs, start, axis=0)
    chosen = np.zeros((len(some), langs))
    chosen[np.arange(len(some)), single.argmax(1)] = 1
    if langs > 1:
        share, gain = _em(like, start, doc, np.ones((len(some), langs)), count)
        base, value = np.add.reduceat(best[:, 0], start), single.max(1)
        order = np.argsort(-share, axis=1, kind="stable")
        # texts that hold next to nothing of a second language keep the single one
        live = np.flatnonzero(np.take_along_axis(share, order[:, 1:2], axis=1)[:, 0] >= TRACE)
        fee = PENALTY * 0.5 * np.log(count + 1)
        for k in range(2, langs + 1):
            if not len(live):
                break
            if k == langs:
                estimate, more = share[live], gain[live]
            else:
                rows = np.concatenate([np.arange(start[i], start[i] + count[i]) for i in live])
                part = (like[rows], np.concatenate(([0], np.cumsum(count[live])[:-1])), np.repeat(np.arange(len(live)), count[live]))
                allowed = np.zeros((len(live), langs))
                np.put_along_axis(allowed, order[live, :k], 1, axis=1)
                estimate, more = _em(*part, allowed, count[live])
            penalised = base[live] + more - fee[live] * (k - 1)
            better = penalised > value[live]
            value[live] = np.where(better, penalised, value[live])
            chosen[live] = np.where(better[:, None], estimate, chosen[live])
            # a larger set explains a text no better than all languages do
            live = live[better | (base[live] + gain[live] - fee[live] * k > value[live])]
    out[some] = chosen
    return out, n > 0


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score and the proportions (a map of the languages in the chosen set)."""
    langs, table = model
    names = np.array([*langs, UNKNOWN], dtype=object)

    def judge(texts):
        share, _ = mixtures(texts, table)
        letters = np.array([LETTER.search((t or b"").decode("utf-8", "replace")) is not None for t in texts.to_pylist()], bool)
        known = letters & (share.sum(1) > 0)
        best = np.where(known, share.argmax(1) if len(langs) else 0, len(langs))
        score = np.where(known, share.max(1) if len(langs) else 0.0, 0.0)
        sets = [
            ",".join(f"{langs[j]}:{row[j]:.4f}" for j in np.argsort(-row, kind="stable") if row[j] > 0) if ok else ""
            for row, ok in zip(share, known)
        ]
        return {"lang_pred": names[best].astype(str), "score": np.clip(score, 0.0, 1.0), "proportions": sets}

    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(typed, judge, "doc_id long, lang_pred string, score double, proportions string", ["doc_id"])


def held_out() -> F.Column:
    """Documents whose language must not be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, proportions of every document; learned from those not held out."""
    model = train(docs.filter(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "proportions")
