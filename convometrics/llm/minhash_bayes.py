"""Near-duplicate detection: banded MinHash with sequential Bayesian verification.

1. Every text gives the set of its word shingles (64-bit hashes).  Texts with
   equal sets form a class, found by a group-by on a 128-bit set fingerprint;
   one member stands for the class from there on.
2. Signatures are cut into bands; equal bands meet in a bucket.  The number of
   bands follows from the miss probability, the rows of a band from the number
   of classes, so that chance meetings do not grow with the corpus.
3. Candidates are verified sequentially: signature batches are compared, and a
   pair goes as soon as the posterior probability that its similarity reaches the
   threshold is below ``MISS``.  What survives is confirmed on the full sets.
4. A bucket is not expanded into its pairs.  First every member is compared
   with the bucket's medoid (the member that meets most others); links make
   components.  Then only buckets that still hold several components are looked
   at, and only pairs across components: small ones pair by pair, large ones in
   blocks, each task comparing at most ``BLOCK`` members that are left outside
   of the bucket's main component with at most ``BLOCK`` members.  No candidate
   pair across components is left out.
5. Components of the confirmed links.

Defined cases: a text without words, or null, has an empty set and is linked
with nothing; a text of fewer words than a shingle is one shingle, the whole
sequence; rows that share a doc_id are one document; a row without doc_id is
kept, by itself, with a null component; very long texts are read whole; of texts
tied for a component the smallest doc_id stays; an empty table gives no rows; other
columns are ignored, and ``keep_one`` keeps them whatever they are called.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convometrics.llm.common import look_up, map_texts, mix64, run_hashes, small_batches, span_hashes, stored, words_of
from convometrics.llm.components import components

THRESHOLD = 80  # percent
BAND_MISS = 1e-4  # chance that a pair at the threshold meets in no band
MISS = 1e-5  # posterior below which a pair is given up
BATCH = 20  # signature values compared at a time
SMALL = 32  # members of a bucket whose remaining pairs are written out
BLOCK = 256  # members of larger buckets compared in one task


def band_shape(classes: int, threshold: int = THRESHOLD, miss: float = BAND_MISS) -> tuple[int, int]:
    """(rows, bands): five rows up to a million classes, one more for each factor of twenty."""
    rows = 5 + max(0, math.ceil(math.log(max(classes, 1) / 1e6, 20)))
    return rows, math.ceil(math.log(miss) / math.log(1 - (threshold / 100) ** rows))


def least_matches(n: int, threshold: float, miss: float = MISS) -> int:
    """Smallest number of equal values among ``n`` at which a pair is kept.

    With a uniform prior the similarity's posterior after m of n matches is
    Beta(m + 1, n - m + 1); the chance that it reaches t is P(Bin(n + 1, t) <= m).
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n + 1


def survivors(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Row numbers of the signature pairs (two arrays of equal shape) that no batch rules out."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for start in range(0, a.shape[1], BATCH):
        stop = min(start + BATCH, a.shape[1])
        matches = matches + (a[alive, start:stop] == b[alive, start:stop]).sum(1)
        keep = matches >= least_matches(stop, threshold / 100)
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether two sorted shingle sets are similar enough."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def shingle_sets(texts, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = words_of(texts)
    word = span_hashes(w.data, w.start, w.end, fold=True)
    runs = run_hashes(word, k)
    out = []
    for start, stop in zip(w.doc_words[:-1], w.doc_words[1:]):
        if stop - start >= k:
            out.append(np.unique(runs[start : stop - k + 1]))
        elif stop > start:
            out.append(run_hashes(word[start:stop], int(stop - start)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    x = shingles.astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        least = np.minimum(least, (x[at : at + 2048] * factors[:, None] + shifts[:, None]).min(1))
    return least


def sketches(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set fingerprint, signature (16 bits a value) and band keys of every text."""
    rnd = np.random.default_rng(20)
    factors = rnd.integers(1, 1 << 32, rows * bands, dtype=np.uint32) | np.uint32(1)
    shifts = rnd.integers(0, 1 << 32, rows * bands, dtype=np.uint32)

    def sketch(texts):
        sets = shingle_sets(texts, k)
        values = np.stack([signature(s, factors, shifts) for s in sets])
        keys = np.zeros((len(sets), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
        for r in range(rows):
            keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, r::rows].astype(np.uint64) + np.uint64(1))
        return {
            "n_shingles": np.array([len(s) for s in sets], np.int64),
            "print_a": np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
            "print_b": np.array([mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
            "signature": [(v & np.uint32(0xFFFF)).astype(np.uint16).tobytes() for v in values],
            "bands": list(keys.view(np.int64)),
        }

    schema = "doc_id long, n_shingles long, print_a long, print_b long, signature binary, bands array<long>"
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(typed, sketch, schema, ["doc_id"])


def _with_signatures(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sizes allow a link and whose signatures do not rule it out."""
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    sized = pairs.join(one, "a").join(two, "b")
    sized = sized.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold)

    def compare(parts):
        for part in parts:
            if len(part):
                a = np.stack([np.frombuffer(s, np.uint16) for s in part["s_a"]])
                b = np.stack([np.frombuffer(s, np.uint16) for s in part["s_b"]])
                yield part[["a", "b"]].iloc[survivors(a, b, threshold)]

    return sized.select("a", "b", "s_a", "s_b").mapInPandas(compare, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    # the side that meets one partner goes first; the medoid's set is read once where its pairs meet
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")

    def confirm(parts):
        for part in parts:
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold)
                for x, y in zip(part["x"], part["y"])
            ]
            yield part[["a", "b"]][np.array(keep, bool)]

    return joined.mapInPandas(confirm, "a long, b long")


def _in_blocks(members: DataFrame, classes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links across components in large buckets.

    ``members``: bucket, id, comp, core (the bucket's main component), size,
    outside (members that are not of it).
    """
    held = members.join(classes.select("id", "signature"), "id").join(sets, "id")
    member_blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    outside_blocks = F.ceil(F.col("outside") / BLOCK).cast("long")
    drawn = F.xxhash64("id", "bucket")
    every = held.select(
        "bucket", "id", "comp", "signature", "shingles",
        F.explode(F.sequence(F.lit(0).cast("long"), outside_blocks - 1)).alias("i"), F.pmod(drawn, member_blocks).alias("j"),
    )
    left = held.filter("comp != core").select(
        "bucket", "id", "comp", "signature", "shingles",
        F.pmod(drawn, outside_blocks).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), member_blocks - 1)).alias("j"),
    )

    def compare(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(one) and len(two):
            sigs = np.stack([np.frombuffer(s, np.uint16) for s in two["signature"]])
            full = [np.frombuffer(s, np.uint64) for s in two["shingles"]]
            sizes = np.array([len(s) for s in full])
            comps, ids = two["comp"].to_numpy(), two["id"].to_numpy()
            for a, comp, sig, x in zip(one["id"], one["comp"], one["signature"], one["shingles"]):
                x = np.frombuffer(x, np.uint64)
                other = np.flatnonzero(
                    (comps != comp) & (np.minimum(sizes, len(x)) * 100 >= np.maximum(sizes, len(x)) * threshold)
                )
                alike = np.broadcast_to(np.frombuffer(sig, np.uint16), (len(other), sigs.shape[1]))
                other = other[survivors(alike, sigs[other], threshold)] if len(other) else other
                joined = set()
                for j in other:
                    # one confirmed link joins two components
                    if comps[j] not in joined and linked(x, full[j], threshold):
                        joined.add(comps[j])
                        found.append((a, ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    key = ["bucket", "i", "j"]
    left = left.toDF(*left.columns)  # columns of its own, for the cogroup
    return left.groupBy(*key).cogroup(every.groupBy(*key)).applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = THRESHOLD, shape: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    ``k``: words of a shingle.  ``threshold``: percent of the union that must be
    shared.  ``shape``: rows and bands of the signature, by default from
    ``band_shape``.
    """
    small_batches(docs.sparkSession)
    rows, bands = shape or band_shape(docs.count(), threshold)
    made = stored(sketches(docs, k, rows, bands), "sketches")
    full = made.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(
        full.groupBy("print_a", "print_b", F.col("n_shingles").alias("n")).agg(
            F.min("doc_id").alias("id"),
            F.count(F.lit(1)).alias("size"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )

    # members of the buckets that hold several classes
    banded = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = stored(buckets, "buckets")  # written, so that the join shuffles both sides and a hot bucket can be split
    members = stored(banded.join(buckets, "bucket"), "members")
    meets = stored(members.groupBy("id").agg(F.sum("size").alias("meets")), "meets")
    ranked = members.join(meets, "id")
    best = F.max_by("id", F.struct(F.col("meets"), -F.col("id"))).alias("medoid")
    medoids = stored(ranked.groupBy("bucket").agg(best), "medoids")

    # sets of all candidates, from their whole texts
    wanted = members.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(wanted, "id", "left_semi")
    sets = stored(
        map_texts(texts, lambda t: {"shingles": [s.tobytes() for s in shingle_sets(t, k)]}, "id long, shingles binary", ["id"])
        .dropDuplicates(["id"]),
        "sets",
    )

    pairs = members.join(medoids, "bucket").filter(F.col("id") != F.col("medoid"))
    pairs = pairs.select(F.col("id").alias("a"), F.col("medoid").alias("b")).distinct()
    links = stored(_confirmed(_with_signatures(pairs, classes, threshold), sets, threshold), "links")

    # buckets whose members are not yet one component
    found = components(links)
    placed = members.join(found, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    placed = stored(placed, "placed")
    per = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = F.max_by("comp", F.struct(F.col("c"), -F.col("comp"))).alias("core")
    split = per.groupBy("bucket").agg(main, F.max("c").alias("most"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("comps"))
    split = split.filter("comps > 1").select("bucket", "core", (F.col("all") - F.col("most")).alias("outside"))
    left_open = stored(placed.join(split, "bucket").join(medoids, "bucket"), "open")
    small = left_open.filter(F.col("size") <= SMALL).select("bucket", "id", "comp", "medoid")
    two = small.select("bucket", F.col("id").alias("b"), F.col("comp").alias("comp_b"))
    across = (
        small.filter(F.col("id") != F.col("medoid"))
        .join(two, "bucket")
        .filter((F.col("id") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & (F.col("b") != F.col("medoid")))
        .select(F.col("id").alias("a"), "b")
        .distinct()
    )
    more = _confirmed(_with_signatures(across, classes, threshold), sets, threshold)
    more = more.unionByName(_in_blocks(left_open.filter(F.col("size") > SMALL), classes, sets, threshold))
    joined = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    final = stored(components(joined.unionByName(more)), "components")

    # back to the classes, and from them to every document
    of_class = classes.join(final, "id", "left").select(
        "print_a", "print_b", "size", F.coalesce("component", "id").alias("component_id")
    )
    plain = made.select("doc_id", "n_shingles", "print_a", "print_b")
    grouped = look_up(
        plain.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)), stored(of_class, "classes-done"),
        ["print_a", "print_b"], "size", made.count(),
    )
    alone = plain.filter(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return (
        grouped.select(*columns)
        .unionByName(alone.select(*columns))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one(docs: DataFrame, k: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group stays, with its columns unchanged."""
    keep = near_duplicates(docs, k, threshold).filter("kept").select(F.col("doc_id").alias("keep"))
    user = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # whatever its columns are called
    held = docs.select(user.alias("user"), F.col("doc_id").alias("id"))
    kept = held.join(keep, F.col("id").eqNullSafe(F.col("keep")), "left_semi")
    return kept.select(*[F.col("user")[c].alias(c) for c in docs.columns])


# All pairs, for two-word shingles: a check for small tables.
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle
  FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT x, y FROM met JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION
  SELECT reach.doc_id, edge.y FROM reach JOIN edge ON edge.x = reach.r
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
