"""Quality rules against a plain reading of the contract."""

import re

import numpy as np
import pytest

from convometrics.llm import outlier_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed)


EDGE = [
    None,
    "",
    "   \n\n \t",
    "one",
    "a b c d e f g h " * 5,
    "a " * 30,
    "línea uno\nlínea uno\n línea uno\nlínea uno",
    "x y z w # * $ <tag> &amp; | %",
    "\n".join(["same line here"] * 4 + [" ".join(f"w{i}" for i in range(60))]),
    "word " * 3 + "\x0b\x0c mixed\rbreaks\tand more",
    "long" * 50000 + " tail " + " ".join(str(i) for i in range(3000)),
]


def test_base_counts_match_brute_force(spark):
    prose = [" ".join(f"t{(i * j) % 97}" for j in range(1, 60 + i)) for i in range(60)]
    texts = EDGE + prose
    df = spark.createDataFrame([(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", 0) for i, t in enumerate(texts)], SCHEMA)
    df = df.withColumn("kept", df.doc_id)  # a clashing name
    got = {r["doc_id"]: r for r in outlier_rules.quality_rules(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(t), i
        assert not (r["base_failed"] and r["kept"])


def test_outliers_of_a_group_are_rejected(spark):
    import random

    rnd = random.Random(3)
    good = [" ".join("w" * rnd.randint(3, 8) + str(rnd.randint(0, 999)) for _ in range(rnd.randint(40, 200))) for _ in range(400)]
    bad = [" ".join(f"#{rnd.randint(0, 9999)}$%" for _ in range(80)) for _ in range(40)]
    rows = [(i, t, "en", "src0", 0) for i, t in enumerate(good + bad)]
    kept = {r["doc_id"]: r["kept"] for r in outlier_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(kept[i] for i in range(400)) >= 398
    assert not any(kept[i] for i in range(400, 440))


def test_small_groups_are_judged_by_all_rows(spark):
    """Junk of a language or source that hardly occurs is held against the language or the whole table."""
    import random

    rnd = random.Random(4)

    def good():
        return " ".join("w" * rnd.randint(3, 8) + str(rnd.randint(0, 999)) for _ in range(rnd.randint(40, 200)))

    def junk():
        return " ".join(f"#{rnd.randint(0, 9999)}$%" for _ in range(80))

    rows = [(i, good(), "en", "src0", 0) for i in range(400)]
    rows += [(1000, junk(), "fi", "src0", 0), (1001, junk(), None, None, 0), (1002, junk(), "en", "rare", 0), (1003, junk(), "en", None, 0)]
    rows += [(2000, good(), "sv", "src1", 0), (2001, good(), "en", "other", 0)]
    kept = {r["doc_id"]: r["kept"] for r in outlier_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(kept[i] for i in range(1000, 1004))
    assert kept[2000] and kept[2001] and sum(kept[i] for i in range(400)) >= 398


def test_empty_table(spark):
    assert outlier_rules.quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("q", [0.5, 0.75, 0.999])
def test_chi2_quantile(q):
    assert abs(outlier_rules.chi2_cdf(outlier_rules.chi2_quantile(q, 5), 5) - q) < 1e-9


def plain_estimate(x, starts=60, seed=0):
    """Smallest log determinant, and its centre, of concentration steps from many random subsets, each to its end."""
    rnd, h = np.random.default_rng(seed), int(np.ceil(outlier_rules.SUBSET * len(x)))
    p = x.shape[1]
    share = outlier_rules.chi2_cdf(outlier_rules.chi2_quantile(outlier_rules.SUBSET, p), p + 2) / outlier_rules.SUBSET
    best = (np.inf, None)
    for _ in range(starts):
        subset, last = x[rnd.choice(len(x), p + 1, replace=False)], np.inf
        while True:
            centre = subset.mean(0)
            cov = np.cov(subset.T, bias=True) / (share if len(subset) == h else 1.0)
            inverse, logdet = outlier_rules.floored(cov)
            d2 = np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)
            if len(subset) == h:
                if logdet >= last - 1e-9:
                    break
                last = logdet
            subset = x[np.argsort(d2, kind="stable")[:h]]
        best = min(best, (last, centre.tolist()), key=lambda b: b[0])
    return best


def test_estimate_against_many_starts(spark):
    """The determinant found is the least that a search from many random subsets finds, with a fifth of the rows far off."""
    rnd = np.random.default_rng(7)
    floors = outlier_rules.FLOORS
    shape = np.linalg.cholesky(np.array([[4, 1, 0, 0, 0], [1, 3, 1, 0, 0], [0, 1, 2, 0, 0], [0, 0, 0, 1.5, 0.5], [0, 0, 0, 0.5, 2]]))
    groups = {}
    for g, off in (("one", 8.0), ("two", 20.0), ("three", 0.0)):
        x = rnd.normal(0, 1, (900, 5)) @ shape.T
        x[:180] = x[:180] * 0.5 + off  # a tight cloud that moments would take for the centre's
        groups[g] = x * floors
    rows = [(g, *map(float, v)) for g, x in groups.items() for v in x]
    fit = spark.createDataFrame(rows, "fit_key string, " + ", ".join(f"{c} double" for c in outlier_rules.NAMES))
    found = {r["fit_key"]: r for r in outlier_rules.estimates(fit).collect()}
    for g, x in groups.items():
        logdet, centre = plain_estimate(x)
        r = found[g]
        # distances are compared in bins of two per cent, so the subset may hold a few rows more
        assert r["logdet"] <= logdet + 0.15
        assert np.abs((np.array([r[c] for c in outlier_rules.CENTRE]) - centre) / floors).max() < 0.2


def test_floors_only_where_the_variance_is_below_them():
    wide = np.diag((outlier_rules.FLOORS * 3) ** 2)
    inverse, logdet = outlier_rules.floored(wide)
    assert np.allclose(inverse @ wide, np.eye(5)) and np.isclose(logdet, 5 * np.log(9))
    flat = wide.copy()
    flat[0, 0] = 0.0
    inverse, logdet = outlier_rules.floored(flat)
    assert np.allclose(np.diag(inverse), 1 / np.array([1, 9, 9, 9, 9]) / outlier_rules.FLOORS**2) and np.isclose(logdet, 4 * np.log(9))
