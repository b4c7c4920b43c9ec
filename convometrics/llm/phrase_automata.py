"""Substring deduplication by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document.  A word goes if a
window that covers it also starts, word for word, in a document with a smaller
doc_id; windows are judged on the input.

1. Equal word sequences are one class; its first document stands for it, and
   the others (if they hold a window) go whole.
2. Each window marks its anchor, the phrase of ``PHRASE`` words with the smallest
   hash in it.  Equal windows mark equal anchors, so a window that recurs has an
   anchor that occurs in two documents.  Anchors are grouped by their words: those
   of two documents are the recurring phrases.
3. Documents are dealt to shards of about ``SHARD_BYTES``.  A shard gets the texts
   of the recurring phrases that its documents marked and compiles them, once,
   into an Aho-Corasick automaton; all its documents (one for each class) are
   streamed through it.  Its hits alone say where phrases occur; each window that
   holds a hit is a candidate.
4. Candidates are grouped over all shards by two independent 64-bit hashes of
   their words (128 bits); those found in two documents are confirmed.  Words
   covered by a window confirmed in a smaller document are removed.

An automaton never exceeds the phrases of its shard, whatever the corpus.

Defined cases: a null or empty text has no words; a text shorter than a window
is kept whole; very long texts are read whole (the longest one is a shard of its
own, at least); rows are documents of their own, also those that repeat a doc_id
(only a smaller doc_id removes words, so they do not touch each other); a row
without doc_id is kept whole and removes nothing elsewhere; of windows tied for
a start, the smallest doc_id keeps its words; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from convometrics.llm.common import look_up, map_texts, poly_run_hashes, run_hashes, runs_inside, small_batches, span_hashes, stored, words_of

WINDOW = 50
PHRASE = 8
SHARD_BYTES = 2 << 20
SECOND = 0x5BD1E9955BD1E995  # salt of the second hash
NO_WORDS = hashlib.sha256(b"").hexdigest()


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, by doubling."""
    if len(values) < width:
        return values[:0]
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(words, hashes: np.ndarray, window: int, phrase: int):
    """(hash of the phrase at each position, hash of each window's anchor, mask of windows inside a document)."""
    grams = run_hashes(hashes, phrase)
    return grams, slide(grams, window - phrase + 1, np.minimum), runs_inside(words, window)


def anchor_positions(grams: np.ndarray, least: np.ndarray, inside: np.ndarray, width: int) -> np.ndarray:
    """Positions of phrases that are the anchor of some window covering them."""
    if not len(least):
        return np.zeros(0, np.int64)
    pad = np.zeros(width - 1, np.uint64)
    reach = slide(np.concatenate((pad, np.where(inside, least, np.uint64(0)), pad)), width, np.maximum)
    return np.flatnonzero((reach == grams) & (reach > 0))


def _first_pass(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """doc_id, n_words, n_bytes, sha (of the words joined by one space) and the distinct anchors (hash, words) of every text."""
    anchor = pa.list_(pa.struct([("gram", pa.int64()), ("words", pa.binary())]))

    def look(texts):
        joined = [b" ".join((t or b"").split()) for t in texts.to_pylist()]
        w = words_of(pa.array(joined, pa.binary()))
        hashes = span_hashes(w.data, w.start, w.end)
        grams, least, inside = anchors(w, hashes, window, phrase)
        at = anchor_positions(grams, least, inside, window - phrase + 1)
        first, last = w.start[at], w.end[at + phrase - 1] if len(at) else at
        cut = np.searchsorted(at, w.doc_words)
        found = []
        for text, begin, a, b in zip(joined, w.doc_bytes.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
            gram, one = np.unique(grams[at[a:b]], return_index=True)
            spans = zip((first[a:b][one] - begin).tolist(), (last[a:b][one] - begin).tolist())
            found.append([{"gram": g, "words": text[x:y]} for g, (x, y) in zip(gram.view(np.int64).tolist(), spans)])
        return {
            "n_words": w.per_doc.astype(np.int64),
            "n_bytes": np.array([len(j) for j in joined], np.int64),
            "sha": [hashlib.sha256(j).hexdigest() for j in joined],
            "anchors": pa.array(found, anchor),
        }

    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_words long, n_bytes long, sha string, anchors array<struct<gram: long, words: binary>>"
    return map_texts(typed, look, schema, ["doc_id"])


def automaton_of(phrases: list[bytes]):
    """The phrases, each between two spaces, so that only whole words are found; a byte is a letter."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for words in phrases:
        key = f" {words.decode('latin-1')} "
        automaton.add_word(key, len(key))
    automaton.make_automaton()
    return automaton


def occurrences(automaton, joined: bytes, word_starts: np.ndarray) -> np.ndarray:
    """Numbers of the words at which a phrase of the automaton begins.  ``word_starts``: first byte of each word of ``joined``."""
    starts = [end - length + 1 for end, length in automaton.iter(f" {joined.decode('latin-1')} ")]
    return np.searchsorted(word_starts, np.array(sorted(starts), np.int64))


def candidates(at: np.ndarray, n_words: int, window: int, phrase: int) -> np.ndarray:
    """Starts of the windows of a document that hold a phrase beginning at one of ``at``."""
    if not len(at) or n_words < window:
        return np.zeros(0, np.int64)
    steps = np.zeros(n_words - window + 2, np.int64)
    np.add.at(steps, np.maximum(at + phrase - window, 0), 1)
    np.add.at(steps, np.minimum(at, n_words - window) + 1, -1)
    return np.flatnonzero(np.cumsum(steps)[:-1] > 0)


MARK_DIGITS = 15  # of a text's sha that tell apart the texts of one doc_id


def mark_of(sha="sha"):
    """Column: a long that tells apart the texts of one doc_id."""
    return F.conv(F.substring(sha, 1, MARK_DIGITS), 16, 10).cast("long")


LOCATED = "doc_id long, mark long, text binary, starts array<int>, hashes array<long>, others array<long>"


def _locate(docs: pd.DataFrame, known: pd.DataFrame, window: int, phrase: int) -> pd.DataFrame:
    """Candidate windows of one shard: starts and both hashes, for each document that has some.

    ``docs``: doc_id, text; ``known``: the documents that stand for their class
    (doc_id, sha) and the recurring phrases (words).
    """
    columns = ["doc_id", "mark", "text", "starts", "hashes", "others"]
    phrases = known["words"].dropna().unique().tolist()
    if not phrases:
        return pd.DataFrame({c: [] for c in columns})
    automaton = automaton_of(phrases)
    stand = known.dropna(subset=["doc_id"])
    stand = set(zip(stand["doc_id"].astype("int64"), stand["sha"]))
    out = []
    for doc_id, text in zip(docs["doc_id"].tolist(), docs["text"]):
        joined = b" ".join((text or b"").split())
        key = (doc_id, hashlib.sha256(joined).hexdigest())
        if key not in stand:
            continue
        stand.remove(key)  # a row that repeats id and text is no other document
        w = words_of(pa.array([joined], pa.binary()))
        starts = candidates(occurrences(automaton, joined, w.start), len(w.start), window, phrase)
        if len(starts):
            one = poly_run_hashes(span_hashes(w.data, w.start, w.end), window)[starts]
            two = poly_run_hashes(span_hashes(w.data, w.start, w.end, salt=SECOND), window)[starts]
            out.append((doc_id, int(key[1][:MARK_DIGITS], 16), text, starts.tolist(), one.view(np.int64).tolist(), two.view(np.int64).tolist()))
    return pd.DataFrame(out, columns=columns)


def removed_mask(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Words covered by the windows at ``starts``."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps)[:-1] > 0


def _spans(mask: np.ndarray) -> str:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return ",".join(f"{a}:{b}" for a, b in zip(edges[::2], edges[1::2]))


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, mark, n_removed, kept_sha256, removed of (doc_id, mark, text, starts)."""

    def cut(batches):
        for batch in batches:
            out = {c: batch.column(c) for c in ("doc_id", "mark")} | {"n_removed": [], "kept_sha256": [], "removed": []}
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts")):
                words = text.split()
                mask = removed_mask(np.asarray(starts.values.to_numpy(), np.int64), len(words), window)
                kept = [word for word, gone in zip(words, mask.tolist()) if not gone]
                out["n_removed"].append(int(mask.sum()))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
                out["removed"].append(_spans(mask))
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, mark long, n_removed long, kept_sha256 string, removed string"
    return rows.select("doc_id", "mark", "text", "starts").mapInArrow(cut, schema)


def repeated_passages(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, removed and sha (of all its words, joined by one space) of every document.

    ``removed`` lists the word ranges that go, as start:end,start:end,...
    """
    small_batches(docs.sparkSession)
    made = stored(_first_pass(docs, window, phrase), "first-pass")
    total, size = made.agg(F.count(F.lit(1)), F.sum("n_bytes")).first()
    shards = max(1, -(-(size or 0) // shard_bytes))
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard")

    whole = made.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    classes = stored(
        whole.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size"), F.first("anchors").alias("anchors")),
        "classes",
    )
    stand = classes.select(F.col("first_id").alias("doc_id"), "sha", "anchors")
    marks = stand.select("doc_id", F.explode("anchors").alias("a")).select("doc_id", "a.gram", "a.words")
    twice = marks.groupBy("gram", "words").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    twice = stored(twice.select("gram", "words"), "recurring")
    phrases = marks.select(shard, "gram").distinct().join(twice, "gram").select("shard", "words")
    known = stand.select(shard, "doc_id", "sha", F.lit(None).cast("binary").alias("words")).unionByName(
        phrases.select("shard", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("sha"), "words")
    )

    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.select(shard, "doc_id", "text")
    held = stored(
        texts.groupBy("shard").cogroup(known.groupBy("shard")).applyInPandas(lambda one, two: _locate(one, two, window, phrase), LOCATED),
        "candidates",
    )
    windows = held.select("doc_id", "mark", F.explode(F.arrays_zip("starts", "hashes", "others")).alias("w"))
    windows = windows.select("doc_id", "mark", F.col("w.starts").alias("start"), F.col("w.hashes").alias("hash"), F.col("w.others").alias("other"))
    confirmed = windows.groupBy("hash", "other").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    # written, so that the join shuffles both sides and a passage common to many documents can be split
    confirmed = stored(confirmed.filter("low < high").select("hash", "other", "low"), "confirmed")
    later = windows.join(confirmed, ["hash", "other"]).filter("low < doc_id").groupBy("doc_id", "mark").agg(F.collect_list("start").alias("starts"))
    partly = _cut(held.select("doc_id", "mark", "text").join(later, ["doc_id", "mark"]), window)
    partly = stored(partly.withColumnsRenamed({"doc_id": "cut_id", "mark": "cut_mark"}), "cut")

    plain = made.select("doc_id", "n_words", "sha")
    has_window = (F.col("n_words") >= window) & F.col("doc_id").isNotNull()
    in_class = look_up(plain.filter(has_window), classes.select("sha", "size", "first_id"), ["sha"], "size", total or 0)
    short = plain.filter(~has_window).withColumn("first_id", F.col("doc_id"))
    columns = ["doc_id", "n_words", "sha", "first_id"]
    rows = in_class.select(*columns).unionByName(short.select(*columns))
    copy = F.col("first_id") < F.col("doc_id")
    return rows.join(partly, (F.col("doc_id") == F.col("cut_id")) & (mark_of() == F.col("cut_mark")), "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(NO_WORDS)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.concat(F.lit("0:"), F.col("n_words"))).otherwise(F.coalesce("removed", F.lit(""))).alias("removed"),
        "sha",
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated passages cut out: kept words joined by one space; untouched texts stay as they are."""
    found = repeated_passages(docs, window).filter("n_removed > 0")
    cuts = found.select(F.col("doc_id").alias("cut_id"), F.col("sha").alias("cut_sha"), F.col("removed").alias("cut")).distinct()

    def keep(text: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(text, removed):
            if spans is None or t is None:
                out.append(t)
                continue
            words, kept, at = t.encode().split(), [], 0
            for a, b in (map(int, s.split(":")) for s in spans.split(",")):
                kept += words[at:a]
                at = b
            out.append(b" ".join(kept + words[at:]).decode())
        return pd.Series(out, dtype=object)

    def sha_of(text: pd.Series) -> pd.Series:
        return text.map(lambda t: hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest())

    user = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # whatever its columns are called
    held = docs.select(user.alias("user"), F.col("doc_id").cast("long").alias("id"), F.pandas_udf(sha_of, StringType())("text").alias("sha"))
    joined = held.join(cuts, (F.col("id") == F.col("cut_id")) & (F.col("sha") == F.col("cut_sha")), "left")
    text = F.pandas_udf(keep, StringType())(F.col("user")["text"], F.col("cut"))
    return joined.select(*[(text if c == "text" else F.col("user")[c]).alias(c) for c in docs.columns])


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p WHERE i + 49 <= len(w)),
low AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
hit AS (SELECT DISTINCT doc_id, i, 1 AS gone FROM win JOIN low USING (h) WHERE low < doc_id),
m AS (
  SELECT p.doc_id, p.i, p.w[p.i] AS word,
         coalesce(max(gone) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM p LEFT JOIN hit ON hit.doc_id = p.doc_id AND hit.i = p.i
),
k AS (
  SELECT doc_id, sum(gone) AS n_removed,
         sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
