"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Each document gives a vector of transformed statistics.  For each (lang, source)
the minimum-covariance-determinant estimate is found by concentration steps: the
rows nearest to a centre by Mahalanobis distance (three quarters of the group)
give the next centre and covariance, until the determinant falls no further.  This
is done from two starts, medians with quartile ranges and the moments of all rows;
the estimate of the smallest determinant wins.  A document whose distance to it
is beyond the chi-square limit is rejected.

All rows take part in every step.  A step is one aggregation by (group, start,
distance bin) for the groups that have not converged: the bins of a group are at
most a few thousand, so the quantile is read from counts and a group with a third
of all rows is summed where its rows lie.  Groups too small to estimate are
judged by the estimate from all rows of their language, and where those are few,
by that from all rows of the table; these two are made only where a group needs
them.

Variances have floors (``VECTOR``): in units of them, a direction in which a group
varies by less than one counts as one; other directions are as estimated.

Defined cases: a null or empty text has no words, fails the base rule and is no
part of an estimate; very long texts are counted whole; null lang and source are
values of their own; groups of equal vectors have the variance floors as their
covariance; rows tied in distance are in or out of a subset together; of starts
tied in determinant the first wins; rows that repeat are rows of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convometrics.llm.common import IS_SPACE, count_in, map_texts, mix64, run_hashes, runs_inside, span_hashes, stored, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SUBSET = 0.75  # share of a group that the estimate is made from
MAX_STEPS = 100  # a guard: a start is left when its determinant falls no further, after some ten steps
CONVERGED = 1e-6  # fall of the log of the determinant
MIN_GROUP = 200  # rows; smaller groups are judged by a pool
REJECT = 1e-6  # chance that a row of a normal group is rejected
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
# name of each transformed statistic, and the least standard deviation it is taken to have
VECTOR = {"size": 1.0, "word_length": 0.1, "symbols": 0.1, "dup_lines": 0.15, "repeats": 0.15}
NAMES = list(VECTOR)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]


def text_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of the base rule for each text."""
    w = words_of(texts)
    docs = len(w.doc_bytes) - 1
    continued = (w.data & 0xC0) == 0x80
    word_chars = count_in(~IS_SPACE[w.data] & ~continued, w.doc_bytes)

    # windows that a document holds twice or more
    hashes = span_hashes(w.data, w.start, w.end)
    covered = np.zeros(len(w.start) + 1, np.int64)
    inside = runs_inside(w, WINDOW)
    if inside.any():
        at = np.flatnonzero(inside)
        owner = w.doc_of_word()[at].astype(np.uint64)
        found = mix64(run_hashes(hashes, WINDOW)[at] + owner * np.uint64(0x9E3779B97F4A7C15))
        _, back, times = np.unique(found, return_inverse=True, return_counts=True)
        again = at[times[back] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    repeated = count_in(np.cumsum(covered)[:-1] > 0, w.doc_words)

    # lines: between line feeds and document ends
    feeds = np.flatnonzero(w.data == 10)
    line_start = np.sort(np.concatenate((w.doc_bytes[:-1], feeds + 1)), kind="stable")
    line_end = np.sort(np.concatenate((feeds, w.doc_bytes[1:])), kind="stable")
    has_word = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    owner = np.searchsorted(w.doc_bytes, line_start, side="right") - 1
    keys = mix64(span_hashes(w.data, line_start, line_end) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    lines = np.bincount(owner, minlength=docs)
    distinct = np.bincount(owner[first], minlength=docs)
    return {
        "n_words": w.per_doc.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": count_in(IS_SYMBOL[w.data], w.doc_bytes),
        "n_dup_lines": (lines - distinct).astype(np.int64),
        "n_repeat_words": repeated,
        "n_lines": lines.astype(np.int64),
    }


def chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution function by the series of the incomplete gamma function."""
    a, half = p / 2, x / 2
    if half <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < q else (low, mid)
    return high


def _groups(rows: DataFrame) -> DataFrame:
    """(lang, source, fit_key, pool_key): the group whose estimate judges a pair, and the pool that the pair's language makes, if any."""
    fit = rows.filter(~F.col("base_failed"))
    pairs = fit.groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("lang_key")  # one row for each source
    needed = (F.min("n").over(w) < MIN_GROUP) & (F.sum("n").over(w) >= MIN_GROUP)
    pairs = pairs.withColumn("pool_key", F.when(needed, F.concat_ws("\x1f", F.lit("lang"), "lang_key")))
    own = F.concat_ws("\x1f", F.lit("pair"), "lang_key", "source_key")
    key = F.when(F.col("n") >= MIN_GROUP, own).otherwise(F.coalesce("pool_key", F.lit("all")))
    return pairs.select("lang_key", "source_key", key.alias("fit_key"), "pool_key")


def _members(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """(fit_key, vector) of the rows that each estimate is made from; a row counts for its pair and for the pools above it."""
    good = keyed.filter(~F.col("base_failed"))
    members = good.filter(F.col("fit_key").startswith("pair\x1f")).select("fit_key", *NAMES)
    pools = groups.agg(F.count("pool_key").alias("lang"), F.count_if(F.col("fit_key") == "all").alias("all")).first()
    if pools["lang"]:
        members = members.unionByName(good.filter(F.col("pool_key").isNotNull()).select(F.col("pool_key").alias("fit_key"), *NAMES))
    if pools["all"]:
        members = members.unionByName(good.select(F.lit("all").alias("fit_key"), *NAMES))
    return members


FLOORS = np.array(list(VECTOR.values()))
KEYS = ["fit_key", "start"]
CENTRE = [f"m{i}" for i in range(len(NAMES))]
INVERSE = [f"v{i}_{j}" for i, j in PAIRS]
PARAMS = ", ".join(["fit_key string", "start int", *(f"{c} double" for c in CENTRE), *(f"{c} double" for c in INVERSE), "logdet double"])
SUMS = ["n", *(f"s{i}" for i in range(len(NAMES))), *(f"q{i}_{j}" for i, j in PAIRS)]


def floored(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """(inverse, log of the determinant) of a covariance, directions that vary by less than the floors being raised to them."""
    values, vectors = np.linalg.eigh(cov / np.outer(FLOORS, FLOORS))
    values = np.maximum(values, 1.0)
    inverse = (vectors / values) @ vectors.T
    return inverse / np.outer(FLOORS, FLOORS), float(np.log(values).sum())


def _inverted(sums: DataFrame) -> DataFrame:
    """Centre, inverse covariance and log of the determinant (both with the floors) of each group and start from its sums."""
    p = len(NAMES)
    share = chi2_cdf(chi2_quantile(SUBSET, p), p + 2) / SUBSET

    def invert(parts):
        for part in parts:
            out = []
            for r in part.to_dict("records"):
                n = r["n"]
                mean = np.array([r[f"s{i}"] for i in range(p)]) / n
                cov = np.zeros((p, p))
                for i, j in PAIRS:
                    cov[i, j] = cov[j, i] = r[f"q{i}_{j}"] / n - mean[i] * mean[j]
                inverse, logdet = floored(cov / (share if r["part"] else 1.0))
                out.append([r["fit_key"], r["start"], *mean.tolist(), *(inverse[i, j] for i, j in PAIRS), logdet])
            yield pd.DataFrame(out, columns=[*KEYS, *CENTRE, *INVERSE, "logdet"])

    return sums.select(*KEYS, *SUMS, "part").mapInPandas(invert, PARAMS)


def _distance() -> F.Column:
    total = F.lit(0.0)
    for i, j in PAIRS:
        term = (F.col(NAMES[i]) - F.col(f"m{i}")) * (F.col(NAMES[j]) - F.col(f"m{j}")) * F.col(f"v{i}_{j}")
        total = total + (term if i == j else term * 2)
    return total


def _moments() -> list:
    """Count, sums and sums of products of the vectors."""
    squares = [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"q{i}_{j}") for i, j in PAIRS]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(NAMES)], *squares]


def _starts(fit: DataFrame) -> DataFrame:
    """First estimates: 0, medians and quartile distances as a diagonal covariance; 1, the moments of all rows.  One aggregation."""
    p = len(NAMES)
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(f"t{i}") for i, c in enumerate(NAMES)]
    seen = stored(fit.groupBy("fit_key").agg(*quartiles, *_moments()), "rule-seen")
    centre = [F.col(f"t{i}")[1].cast("double").alias(f"m{i}") for i in range(p)]
    spread = [(F.col(f"t{i}")[2] - F.col(f"t{i}")[0]) / 1.349 for i in range(p)]
    variance = [F.greatest(spread[i] * spread[i], F.lit(VECTOR[NAMES[i]] ** 2)) for i in range(p)]
    inverse = [((F.lit(1.0) / variance[i]) if i == j else F.lit(0.0)).alias(f"v{i}_{j}") for i, j in PAIRS]
    infinite = F.lit(math.inf).alias("logdet")  # of no subset yet
    robust = seen.select("fit_key", F.lit(0).alias("start"), *centre, *inverse, infinite)
    plain = _inverted(seen.withColumn("start", F.lit(1)).withColumn("part", F.lit(False))).withColumn("logdet", infinite)
    return robust.unionByName(plain)


def _concentrate(fit: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: the estimate from the nearest rows of each group, for each start."""
    near = fit.join(params.drop("logdet"), "fit_key").withColumn("d2", _distance())
    binned = near.withColumn("bin", F.floor(F.log2(F.col("d2") + F.lit(2.0**-20)) * 32).cast("int"))
    by_bin = binned.groupBy(*KEYS, "bin").agg(*_moments())
    whole = Window.partitionBy(*KEYS)  # a few thousand bins at most
    before = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    chosen = (
        by_bin.withColumn("all", F.sum("n").over(whole))
        .withColumn("nearer", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter(F.col("nearer") < F.col("all") * SUBSET)
    )
    sums = chosen.groupBy(*KEYS).agg(F.first("all").alias("all"), *[F.sum(c).alias(c) for c in SUMS])
    return _inverted(sums.withColumn("part", F.col("n") < F.col("all")).drop("all"))


def estimates(fit: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """The estimate of each group of ``fit`` (fit_key and the vector's columns): centre, inverse covariance, logdet, start."""
    params = stored(_starts(fit), "rule-start")
    found = []
    for step in range(max_steps):
        before = params.select(*KEYS, F.col("logdet").alias("before"))
        moved = stored(_concentrate(fit, params).join(before, KEYS), f"rule-step{step}")
        still = F.col("before") - F.col("logdet") > CONVERGED
        found.append(moved.filter(~still).drop("before"))
        params = moved.filter(still).drop("before")
        if params.isEmpty():
            break
    else:
        found.append(params)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.min_by(F.struct("start", *CENTRE, *INVERSE, "logdet"), F.struct("logdet", "start")).alias("best")
    return every.groupBy("fit_key").agg(best).select("fit_key", "best.*")


def quality_rules(docs: DataFrame, reject: float = REJECT) -> DataFrame:
    """Statistics and verdict of every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance (squared Mahalanobis; null if base_failed), kept.
    """
    typed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        "text",
    )
    passed = ["doc_id", "lang", "source"]
    stats = map_texts(typed, text_stats, "doc_id long, lang string, source string, " + STATS, passed)
    words = F.greatest(F.col("n_words"), F.lit(1))
    rows = (
        stats.withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
        )
        .withColumn("size", F.log1p("n_words"))
        .withColumn("word_length", F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words))
        .withColumn("symbols", F.sqrt(F.col("n_symbols") / words))
        .withColumn("dup_lines", F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))))
        .withColumn("repeats", F.sqrt(F.col("n_repeat_words") / words))
        .withColumn("lang_key", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")))
        .withColumn("source_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    )
    rows = stored(rows.drop("lang", "source", "n_lines"), "rule-stats")
    groups = stored(_groups(rows), "rule-groups")
    keyed = rows.join(groups, ["lang_key", "source_key"], "left")
    keyed = stored(keyed.drop("lang_key", "source_key"), "rule-rows")
    fit = _members(keyed, groups)
    params = stored(estimates(fit), "rule-estimates")
    limit = chi2_quantile(1 - reject, len(NAMES))
    judged = keyed.join(params, "fit_key", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))).alias("kept"),
    )
