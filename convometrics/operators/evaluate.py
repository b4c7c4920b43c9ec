"""Gold vs prediction evaluation.

Comparison semantics follow the reference exactly:

* values compare with Python ``==`` on JSON values (typed; absent == null);
* valid predictions are compared after coercion and defaults, raw ones as-is;
* ``unresolved_next_steps`` compares only N/A vs PENDING;
* accuracy is over scored rows (not errors), latency over all rows.

All aggregates are one ``agg`` pass (partial aggregation before the single
shuffle); the per-field table is an ``unpivot`` of that one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import parse_strict, vstring
from ..functions.stage import stage
from ..schema import ALL_KEY_FIELDS, RESOLVED_FIELD, RULES_BY_NAME, SCORED_FIELDS
from .payload import (
    canon_leaves,
    canon_typed,
    drop_leaves,
    explode_payload,
    normalize_resolved_leaf,
    normalize_resolved_text,
    parse_replies,
    serialize,
    validate,
    with_metrics,
)

NO_PREDICTION = "no prediction for this key"
SEVERAL_PREDICTIONS = "several predictions for this key"
BAD_GOLD = "gold payload is not valid JSON"


def match_col(field: str) -> str:
    return f"match_{field}"


MATCH_COLS = [match_col(f) for f in SCORED_FIELDS]


# ---------------------------------------------------------------------------
# E0 pairing
# ---------------------------------------------------------------------------


def one_per_key(pred: DataFrame, key: str = "k") -> DataFrame:
    """One row for each key of ``pred``, with ``n_predictions``.

    Counted in the shuffle that the join by ``key`` needs anyway; rows of a key
    are combined before it, so a key with a large share of all rows is no hot
    task.  Which of several rows stays is no matter: ``pair`` uses none of them.
    """
    rest = [c for c in pred.columns if c != key]
    grouped = pred.groupBy(key).agg(F.count(F.lit(1)).alias("n_predictions"), F.min(F.struct(*rest)).alias("_one"))
    return grouped.select(key, "n_predictions", *[F.col("_one")[c].alias(c) for c in rest])


def pair(gold: DataFrame, pred: DataFrame, key: str = "k") -> DataFrame:
    """Left join of gold to predictions on ``key``: one row for each row of ``gold``, whatever ``pred`` holds.

    A key without a prediction and a key with several become error rows, with
    the reason in ``model_error``; neither has a latency.  Both sides are large
    and keyed alike, so this is a sort-merge join on ``key`` (pinned: a runtime
    size measured below where replies are built is no bound on the broadcast side).
    """
    p = one_per_key(pred, key).hint("merge")
    out = gold.join(p, key, "left")
    several = F.col("n_predictions") > 1
    err = F.when(F.col("n_predictions").isNull(), F.lit(NO_PREDICTION)).when(several, F.lit(SEVERAL_PREDICTIONS))
    if "model_error" in pred.columns:
        err = F.coalesce(err, F.col("model_error"))
    if "latency_ms" in pred.columns:
        out = out.withColumn("latency_ms", F.when(~several, F.col("latency_ms")))
    return out.withColumn("model_error", err).drop("n_predictions")


def prepare_predictions(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Reply text -> ``body, payload, error, violations, status, metrics`` (+ ``_p_*`` leaves)."""
    return stage(_checked_replies(df, reply))


def _checked_replies(df: DataFrame, reply: str) -> DataFrame:
    model_error = "model_error" if "model_error" in df.columns else None
    parsed = parse_replies(df, reply, model_error)
    return with_metrics(validate(explode_payload(parsed, "payload", "_p")))


def parse_gold(df: DataFrame, gold: str = "gold_json") -> DataFrame:
    """Gold text -> ``gold`` VARIANT (NULL when not strict JSON) + ``_g_*`` leaves."""
    g = F.col(gold)
    df = df.withColumn("gold", parse_strict(g))
    return explode_payload(df, "gold", "_g", typed=False, fields=SCORED_FIELDS)


# ---------------------------------------------------------------------------
# E1-E3 field matches
#
# Each side is reduced to canonical comparison keys, and to the columns named
# here, *before* the join: the shuffle carries short strings, and no document
# unless the caller asks for them.
# ---------------------------------------------------------------------------


def _gkey(field: str) -> str:
    return f"_gc_{field}"


def _pkey(field: str) -> str:
    return f"_pc_{field}"


def _pred_canon(raw: Column) -> Column:
    """ARRAY of the canonical values of the key fields: of the record if valid, of the leaves as they are (``raw``) otherwise."""
    typed = F.array(*[canon_typed(F.col("metrics"), RULES_BY_NAME[f]) for f in ALL_KEY_FIELDS])
    return F.when(F.col("status") == "valid", typed).otherwise(raw)


def resolved_pred() -> Column:
    rule = RULES_BY_NAME[RESOLVED_FIELD]
    return F.when(
        F.col("status") == "valid",
        normalize_resolved_text(F.col("metrics").getField(rule.group).getField(rule.name)),
    ).otherwise(normalize_resolved_leaf("_p"))


def gold_keys(gold: DataFrame, gold_col: str = "gold_json") -> DataFrame:
    """Gold side: ``gold_ok``, ``gold_intent``, ``gold_resolved`` and one canonical key per field."""
    g = parse_gold(gold, gold_col)
    g = g.withColumn("_canon", canon_leaves("_g", ALL_KEY_FIELDS))
    cols = {_gkey(f): F.get("_canon", F.lit(i)) for i, f in enumerate(ALL_KEY_FIELDS)}
    cols["gold_resolved"] = normalize_resolved_leaf("_g")
    cols["gold_intent"] = F.when(F.col("_g_t_customer_intent") == "string", vstring(F.col("_g_x_customer_intent")))
    cols["gold_ok"] = F.col("gold").isNotNull()
    return drop_leaves(g.withColumns(cols), "_g").drop("gold", "_canon")


def prediction_keys(pred: DataFrame, reply: str = "reply", documents: bool = False) -> DataFrame:
    """Prediction side: parse, validate, then one canonical key per field and ``pred_resolved``.

    ``documents`` adds ``pred_json``: the validated record, or the raw object, as text.
    """
    p = _checked_replies(pred, reply).withColumn("_canon", _pred_canon(canon_leaves("_p", ALL_KEY_FIELDS)))
    cols = {_pkey(f): F.get("_canon", F.lit(i)) for i, f in enumerate(ALL_KEY_FIELDS)}
    if documents:
        cols["pred_json"] = F.when(F.col("status") == "valid", serialize(F.col("metrics"))).when(
            F.col("status") == "raw", F.to_json(F.col("payload"))
        )
    cols["pred_resolved"] = F.when(F.col("status") != "error", resolved_pred())
    passed = [c for c in pred.columns if c != reply]
    # the barrier holds short columns only: no reply, no variant and no leaf is copied through it
    return stage(p.select(*passed, "status", "error", *[c.alias(n) for n, c in cols.items()]))


def score(df: DataFrame) -> DataFrame:
    """Add ``scored``, one ``match_<field>`` per scored field and ``strict``.

    Expects ``gold_keys`` paired with ``prediction_keys``.  Rows that are not
    scored get NULL matches.
    """
    status = F.coalesce(F.col("status"), F.lit("error"))
    out = df.withColumn("status", status).withColumn(
        "error",
        F.when(~F.col("gold_ok"), F.lit(BAD_GOLD)).otherwise(F.col("error")),
    ).withColumn("scored", (F.col("status") != "error") & F.col("gold_ok"))
    cols = {match_col(f): F.when(F.col("scored"), F.col(_gkey(f)).eqNullSafe(F.col(_pkey(f)))) for f in ALL_KEY_FIELDS}
    cols[match_col(RESOLVED_FIELD)] = F.when(F.col("scored"), F.col("gold_resolved") == F.col("pred_resolved"))
    out = out.withColumns(cols)
    strict = reduce(lambda a, b: a & b, [F.col(c) for c in MATCH_COLS])
    keys = [_gkey(f) for f in ALL_KEY_FIELDS] + [_pkey(f) for f in ALL_KEY_FIELDS]
    return out.withColumn("strict", F.when(F.col("scored"), strict)).drop(*keys)


_GOLD_SIDE = ["gold_ok", "gold_resolved", "gold_intent", *[_gkey(f) for f in ALL_KEY_FIELDS]]
_PRED_SIDE = ["status", "error", "pred_resolved", *[_pkey(f) for f in ALL_KEY_FIELDS]]


def evaluate(
    gold: DataFrame, pred: DataFrame, key: str = "k", documents: bool = False, duplicates: str = "error"
) -> DataFrame:
    """E0 + P2-P5 + E1-E3: one row per gold key with status, matches and latency.

    A gold key without a prediction, or with several, is an error row; so the
    rows are as many as those of ``gold``.  ``duplicates="failfast"`` stops, before
    anything else is run, on a key with several predictions.  ``documents`` keeps
    ``gold_json`` and ``pred_json``.
    """
    if duplicates == "failfast":
        first = duplicate_keys(pred, key).agg(F.min(F.struct(key, "n")).alias("first")).first()["first"]
        if first is not None:
            raise ValueError(f"{first['n']} predictions for {key} {first[key]}")
    passed = [c for c in ("latency_ms", "model_error") if c in pred.columns]
    left = gold_keys(gold).select(key, *_GOLD_SIDE, *(["gold_json"] if documents else []))
    right = prediction_keys(pred, documents=documents).select(
        key, *_PRED_SIDE, *passed, *(["pred_json"] if documents else [])
    )
    paired = pair(left, right, key)
    unpaired = F.col("model_error").isin(NO_PREDICTION, SEVERAL_PREDICTIONS)
    paired = paired.withColumn("error", F.when(unpaired, F.col("model_error")).otherwise(F.col("error")))
    paired = paired.withColumn("status", F.when(unpaired, F.lit("error")).otherwise(F.col("status")))
    return score(paired)


def evaluate_rows(df: DataFrame, keep: list[str], gold: str = "gold_json") -> DataFrame:
    """P2-P5 + E1-E3 where gold and reply stand in one row: no join.

    ``df``: ``keep`` columns, the gold text, ``reply``, ``latency_ms``,
    ``model_error``.  Returns them with status, matches, ``gold_json`` and ``pred_json``.
    """
    keyed = prediction_keys(gold_keys(df, gold), documents=True)
    both = [*_GOLD_SIDE, *_PRED_SIDE, "latency_ms", "model_error", "pred_json"]
    return score(keyed.select(*keep, F.col(gold).alias("gold_json"), *both))


def duplicate_keys(df: DataFrame, key: str = "k") -> DataFrame:
    """Keys that stand in several rows, with their number: a prediction table should give none."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


# ---------------------------------------------------------------------------
# E4-E8 aggregates and lists
# ---------------------------------------------------------------------------


def _i(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(0))


def summary_counts(scored: DataFrame, latency_ms: str = "latency_ms") -> DataFrame:
    """One row: total/valid/errors, correct per field, strict, latency sums -- one pass."""
    aggs = [
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(_i(F.col("scored"))), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(_i(F.col("strict"))), F.lit(0)).alias("strict_correct"),
        F.sum(F.col(latency_ms)).alias("latency_ms_total"),
        F.min(F.col(latency_ms)).alias("latency_ms_min"),
        F.max(F.col(latency_ms)).alias("latency_ms_max"),
    ]
    aggs += [F.coalesce(F.sum(_i(F.col(match_col(f)))), F.lit(0)).alias(f) for f in SCORED_FIELDS]
    return scored.agg(*aggs)


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def field_accuracy(scored: DataFrame) -> DataFrame:
    """``field, correct, valid, accuracy`` (accuracy 0 when nothing was scored)."""
    s = summary_counts(scored)
    long = s.unpivot(["valid"], SCORED_FIELDS, "field", "correct")
    return long.select(
        "field",
        F.col("correct").cast("long").alias("correct"),
        F.col("valid").cast("long").alias("valid"),
        _ratio(F.col("correct"), F.col("valid")).alias("accuracy"),
    )


def eval_summary(scored: DataFrame) -> DataFrame:
    """E5: ``total, valid, errors, strict_correct, strict_accuracy``."""
    s = summary_counts(scored)
    return s.select(
        F.col("total").cast("long").alias("total"),
        F.col("valid").cast("long").alias("valid"),
        (F.col("total") - F.col("valid")).cast("long").alias("errors"),
        F.col("strict_correct").cast("long").alias("strict_correct"),
        _ratio(F.col("strict_correct"), F.col("valid")).alias("strict_accuracy"),
    )


def latency_summary(scored: DataFrame) -> DataFrame:
    """Mean / min / max / total seconds over all rows (errors included); 0 when empty."""
    s = summary_counts(scored)
    ms = lambda c: F.coalesce(F.col(c).cast("double") / 1000, F.lit(0.0))
    return s.select(
        F.when(F.col("total") > 0, F.col("latency_ms_total").cast("double") / F.col("total") / 1000)
        .otherwise(F.lit(0.0))
        .alias("latency_mean_sec"),
        ms("latency_ms_min").alias("latency_min_sec"),
        ms("latency_ms_max").alias("latency_max_sec"),
        ms("latency_ms_total").alias("latency_total_sec"),
    )


def missed_fields(df: DataFrame) -> Column:
    """ARRAY of field names that did not match, in comparison order."""
    return F.array_compact(F.array(*[F.when(~F.col(match_col(f)), F.lit(f)) for f in SCORED_FIELDS]))


def strict_failures(scored: DataFrame, *key: str) -> DataFrame:
    """Scored rows that are not strict matches, with the missed fields listed."""
    return scored.filter(F.col("scored") & ~F.col("strict")).select(
        *(key or ("k",)),
        F.concat_ws(", ", missed_fields(scored)).alias("missed"),
        F.size(missed_fields(scored)).alias("n_missed"),
    )


def runtime_errors(scored: DataFrame, *key: str) -> DataFrame:
    """Rows with an error, message cut at 200 characters."""
    return scored.filter(F.col("error").isNotNull()).select(
        *(key or ("k",)), F.substring(F.col("error"), 1, 200).alias("error")
    )


def sliced_accuracy(scored: DataFrame, slice_col: str = "segment", key_intent: str = "gold_intent") -> DataFrame:
    """Counts by segment, by gold intent, and overall (GROUPING SETS)."""
    n_correct = reduce(lambda a, b: a + b, [_i(F.col(c)) for c in MATCH_COLS])
    return (
        scored.withColumn("_fields_correct", n_correct)
        .groupingSets(
            [[F.col(slice_col)], [F.col(key_intent)], []],
            F.col(slice_col),
            F.col(key_intent),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(_i(F.col("scored"))).alias("n_scored"),
            F.sum(_i(F.col("strict"))).alias("strict_correct"),
            F.sum("_fields_correct").alias("fields_correct"),
            F.grouping_id().alias("grouping_id"),
        )
    )
