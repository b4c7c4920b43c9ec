"""Registered queries over FX1 (gold vs model replies from ``orders``).

Each query is ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds the DuckDB SQL
for the same result, computed from the raw tables by the fixture rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import parse_strict
from ..functions.stage import materialize, stage
from ..operators import evaluate as ev
from ..operators import payload as pl
from ..operators import report as rep
from ..schema import (
    CUSTOMER_INTENTS,
    DELIVERY_EXCEPTION_TYPES,
    FIELD_RULES,
    REWORK_FREQUENCIES,
    ROOT_CAUSE_CATEGORIES,
    SCORED_FIELDS,
    SENTIMENT_TRAJECTORIES,
    VOCABULARIES,
    VOCABULARY_NAMES,
)
from ..session import scratch_path
from ..sources import fixtures as fx
from . import oracle_fx as O

# ---------------------------------------------------------------------------
# shared plan pieces
# ---------------------------------------------------------------------------


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.evaluate(fx.gold_table(spark, sf_dir), fx.prediction_table(spark, sf_dir), "k")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed, validated predictions with their typed record (``metrics``)."""
    return ev.prepare_predictions(fx.prediction_table(spark, sf_dir))


def valid_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predictions(spark, sf_dir)
    return p.filter(F.col("status") == "valid").select("k", "metrics")


def gold_records(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Typed gold records, limited to the leaves a query uses."""
    g = stage(fx.gold_table(spark, sf_dir).select("k", parse_strict(F.col("gold_json")).alias("payload")))
    return pl.records(g, "payload", fill_defaults=False, name="record", fields=list(fields) or None).select("k", "record")


def _leaf(record: str, name: str):
    rule = next(r for r in FIELD_RULES if r.name == name)
    return F.col(f"{record}.{rule.group}.{rule.name}")


# ---------------------------------------------------------------------------
# Evaluation E0-E9, E11
# ---------------------------------------------------------------------------


def q_pair_gold_pred(spark, sf):
    s = scored(spark, sf)
    return s.select("k", "status", F.col("model_error").isNull().alias("has_prediction"))


def q_pair_with_gaps(spark, sf):
    """E0 with predictions missing (k % 29 = 0) or given two and three times (k % 31 = 0), and gold that is no JSON (k % 41 = 0)."""
    k = F.col("k")
    gold = fx.gold_table(spark, sf).withColumn("gold_json", F.when(k % 41 == 0, F.substring("gold_json", 1, 30)).otherwise(F.col("gold_json")))
    pred = fx.prediction_table(spark, sf).filter(k % 29 != 0)
    # copies of a row, not a union of the table with itself: each reply is built once
    copies = F.when(k % 62 == 0, 3).when(k % 31 == 0, 2).otherwise(1)
    pred = pred.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    s = ev.evaluate(gold, pred)
    return s.select("k", "status", "scored", "strict", "error")


def q_normalize_resolved(spark, sf):
    s = scored(spark, sf)
    return s.select("k", "gold_resolved", F.when(F.col("scored"), F.col("pred_resolved")).alias("pred_resolved"))


def q_field_matches(spark, sf):
    return scored(spark, sf).select("k", *ev.MATCH_COLS)


def q_strict_match(spark, sf):
    return scored(spark, sf).select("k", "status", "strict")


def q_field_accuracy(spark, sf):
    return ev.field_accuracy(scored(spark, sf))


def q_eval_summary(spark, sf):
    return ev.eval_summary(scored(spark, sf))


def q_latency_summary(spark, sf):
    return ev.latency_summary(scored(spark, sf))


def q_strict_failures(spark, sf):
    return ev.strict_failures(scored(spark, sf))


def q_runtime_errors(spark, sf):
    return ev.runtime_errors(scored(spark, sf))


def q_report_lines(spark, sf):
    """The lines of the report, without its headings: tables, failures and errors."""
    s = materialize(scored(spark, sf).withColumn("file_path", F.lit("orders")).withColumnRenamed("k", "line_num"), scratch_path(spark, "scored"))
    summary = rep.summary_of(ev.summary_counts(s).first().asDict())
    key = ("file_path", "line_num")
    lines = rep.report_lines("orders", summary, ev.strict_failures(s, *key), ev.runtime_errors(s, *key))
    return lines.filter(F.col("line").startswith("| ") | F.col("line").startswith("- ")).filter(
        ~F.col("line").startswith("| Metric") & ~F.col("line").startswith("| Field")
    ).select("section", "line_num", "line")


def q_sliced_accuracy(spark, sf):
    s = scored(spark, sf).select("k", "scored", "strict", "gold_intent", *ev.MATCH_COLS)
    crm = fx.crm(spark, sf).select("k", F.col("c_mktsegment").alias("segment"))
    return ev.sliced_accuracy(s.join(crm, "k", "left"), "segment", "gold_intent")


# ---------------------------------------------------------------------------
# Payload P1-P8, V1
# ---------------------------------------------------------------------------


def q_unfence(spark, sf):
    r = fx.prediction_table(spark, sf)
    return r.select("k", pl.unfence(F.col("reply")).alias("body"))


def q_parse_reply(spark, sf):
    p = stage(pl.parse_replies(fx.prediction_table(spark, sf)))
    return p.select("k", F.col("payload").isNotNull().alias("parse_ok"), "error")


def q_validate_payload(spark, sf):
    p = predictions(spark, sf)
    return p.select(
        "k",
        "status",
        F.when(F.col("status") != "error", F.concat_ws("; ", "violations")).alias("violations"),
    )


def q_apply_defaults(spark, sf):
    p = predictions(spark, sf).filter(F.col("status") == "valid")
    names = [
        "delivery_exception_type",
        "root_cause_category",
        "address_change_requested",
        "missed_delivery_explicitly_mentioned",
        "escalation_requested",
    ]
    return p.select("k", *[_leaf("metrics", n).alias(n) for n in names])


def q_flatten_metrics(spark, sf):
    flat = pl.flatten(gold_records(spark, sf), "record", keep=["k"])
    return flat.select(
        "k",
        F.size("effort_and_friction_quotes").cast("long").alias("n_quotes"),
        F.concat_ws("|", "effort_and_friction_quotes").alias("quotes"),
        *[r.name for r in FIELD_RULES if r.name != "effort_and_friction_quotes"],
    )


def q_serialize_metrics(spark, sf):
    return gold_records(spark, sf).select("k", pl.serialize(F.col("record")).alias("json"))


def q_inspect_view(spark, sf):
    return pl.inspect_view(valid_metrics(spark, sf), "metrics", keep=["k"])


def q_vocabulary(spark, sf):
    g = gold_records(spark, sf, *VOCABULARIES)
    counts = (
        g.select(*[_leaf("record", f).alias(f) for f in VOCABULARIES])
        .unpivot([], list(VOCABULARIES), "field", "value")
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n_gold"))
    )
    dim = pl.vocabulary_df(spark)  # 25 rows
    return dim.join(counts, ["field", "value"], "left").select(
        "field", "ordinal", "name", "value", F.coalesce("n_gold", F.lit(0)).cast("long").alias("n_gold")
    )


def q_json_valid(spark, sf):
    from ..functions.jsontext import json_valid

    r = fx.replies(spark, sf)
    return r.select("k", json_valid(F.col("reply")).alias("reply_valid"), json_valid(F.col("gold_json")).alias("gold_valid"))


# ---------------------------------------------------------------------------
# Analytics A1-A6
# ---------------------------------------------------------------------------


def q_vocab_distribution(spark, sf):
    m = valid_metrics(spark, sf)
    counts = (
        m.select(*[_leaf("metrics", f).alias(f) for f in VOCABULARIES])
        .unpivot([], list(VOCABULARIES), "field", "value")
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    dim = pl.vocabulary_df(spark)
    return dim.join(counts, ["field", "value"], "left").select(
        "field", "value", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def q_crm_enriched(spark, sf):
    m = valid_metrics(spark, sf)
    crm = fx.crm(spark, sf)
    return m.join(crm, "k", "left").select(
        "k",
        _leaf("metrics", "customer_intent").alias("customer_intent"),
        _leaf("metrics", "customer_effort_score").alias("customer_effort_score"),
        "c_mktsegment",
        "o_orderpriority",
        F.year("o_orderdate").cast("long").alias("order_year"),
    )


def _rate(c):
    return F.avg(c.cast("int"))


def q_intent_kpis(spark, sf):
    m = valid_metrics(spark, sf)
    return m.groupBy(_leaf("metrics", "customer_intent").alias("customer_intent")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(_leaf("metrics", "customer_effort_score")).alias("mean_effort"),
        _rate(_leaf("metrics", "escalation_requested")).alias("escalation_rate"),
        _rate(_leaf("metrics", "missed_delivery_explicitly_mentioned")).alias("missed_delivery_rate"),
        _rate(_leaf("metrics", "agent_explicitly_confirmed_resolution")).alias("confirmed_resolution_rate"),
    )


def q_intent_cause_cube(spark, sf):
    m = valid_metrics(spark, sf)
    return m.cube(
        _leaf("metrics", "customer_intent").alias("customer_intent"),
        _leaf("metrics", "root_cause_category").alias("root_cause_category"),
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("grouping_id"))


def q_friction_quotes(spark, sf):
    m = valid_metrics(spark, sf)
    return m.select("k", F.posexplode_outer(_leaf("metrics", "effort_and_friction_quotes")).alias("pos", "quote")).filter(
        F.col("quote").isNotNull()
    ).select("k", F.col("pos").cast("long").alias("pos"), "quote")


def q_queue_load(spark, sf):
    m = valid_metrics(spark, sf)
    return m.groupBy(
        _leaf("metrics", "recommended_routing_queue").alias("recommended_routing_queue"),
        _leaf("metrics", "customer_intent").alias("customer_intent"),
    ).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Audits Q1, Q3, Q4 (over gold records)
# ---------------------------------------------------------------------------


def q_resolution_consistency(spark, sf):
    g = gold_records(spark, sf, "agent_explicitly_confirmed_resolution", "unresolved_next_steps")
    confirmed = _leaf("record", "agent_explicitly_confirmed_resolution")
    cls = pl.normalize_resolved_text(_leaf("record", "unresolved_next_steps"))
    return (
        g.select(confirmed.alias("confirmed"), cls.alias("steps_class"))
        .groupBy("confirmed", "steps_class")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("consistent", F.col("confirmed") == (F.col("steps_class") == "N/A"))
    )


def q_quote_count_audit(spark, sf):
    g = gold_records(spark, sf, "effort_and_friction_quotes")
    n = F.size(_leaf("record", "effort_and_friction_quotes")).cast("long")
    return (
        g.select(n.alias("n_quotes"))
        .groupBy("n_quotes")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("in_rule", (F.col("n_quotes") == 0) | F.col("n_quotes").between(1, 3))
    )


COVERAGE_THRESHOLDS = [
    ("distinct_intents", 6),
    ("effort_low_1_2", 2),
    ("effort_moderate_3", 2),
    ("effort_high_4_5", 2),
    ("escalation_requested", 2),
    ("resolved", 2),
    ("unresolved_with_next_steps", 2),
    ("proof_of_delivery", 1),
    ("customs_or_documentation", 1),
]


def coverage_audit(records: DataFrame, record: str = "record", expected_records: int | None = None) -> DataFrame:
    """Q4: eval-set coverage checks, one conditional aggregate pass + unpivot."""
    intent = _leaf(record, "customer_intent")
    effort = _leaf(record, "customer_effort_score")
    confirmed = _leaf(record, "agent_explicitly_confirmed_resolution")
    pending = pl.normalize_resolved_text(_leaf(record, "unresolved_next_steps")) == "PENDING"
    aggs = {
        "distinct_intents": F.count_distinct(intent),
        "effort_low_1_2": F.count_if(effort.between(1, 2)),
        "effort_moderate_3": F.count_if(effort == 3),
        "effort_high_4_5": F.count_if(effort.between(4, 5)),
        "escalation_requested": F.count_if(_leaf(record, "escalation_requested")),
        "resolved": F.count_if(confirmed),
        "unresolved_with_next_steps": F.count_if(~confirmed & pending),
        "proof_of_delivery": F.count_if(intent == "Proof_of_Delivery_Dispute"),
        "customs_or_documentation": F.count_if(intent.isin("Customs_Clearance_Inquiry", "Hazmat_Documentation_Hold")),
        "records": F.count(F.lit(1)),
    }
    one = records.agg(*[v.cast("long").alias(k) for k, v in aggs.items()])
    thresholds = dict(COVERAGE_THRESHOLDS)
    names = [n for n, _ in COVERAGE_THRESHOLDS] + (["records"] if expected_records is not None else [])
    if expected_records is not None:
        thresholds["records"] = expected_records
    long = one.unpivot([], names, "check", "observed")
    th = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(thresholds[n]).cast("long"))])
    out = long.withColumn("threshold", th[F.col("check")])
    exact = F.col("check") == "records"
    return out.withColumn(
        "passed", F.when(exact, F.col("observed") == F.col("threshold")).otherwise(F.col("observed") >= F.col("threshold"))
    )


def q_coverage_audit(spark, sf):
    return coverage_audit(gold_records(spark, sf))


# ---------------------------------------------------------------------------
# registry
# ---------------------------------------------------------------------------

QUERIES = {
    "pair_gold_pred": q_pair_gold_pred,
    "normalize_resolved": q_normalize_resolved,
    "field_matches": q_field_matches,
    "strict_match": q_strict_match,
    "field_accuracy": q_field_accuracy,
    "eval_summary": q_eval_summary,
    "latency_summary": q_latency_summary,
    "pair_with_gaps": q_pair_with_gaps,
    "strict_failures": q_strict_failures,
    "runtime_errors": q_runtime_errors,
    "report_lines": q_report_lines,
    "sliced_accuracy": q_sliced_accuracy,
    "unfence": q_unfence,
    "parse_reply": q_parse_reply,
    "validate_payload": q_validate_payload,
    "apply_defaults": q_apply_defaults,
    "flatten_metrics": q_flatten_metrics,
    "serialize_metrics": q_serialize_metrics,
    "inspect_view": q_inspect_view,
    "vocabulary": q_vocabulary,
    "json_valid": q_json_valid,
    "vocab_distribution": q_vocab_distribution,
    "crm_enriched": q_crm_enriched,
    "intent_kpis": q_intent_kpis,
    "intent_cause_cube": q_intent_cause_cube,
    "friction_quotes": q_friction_quotes,
    "queue_load": q_queue_load,
    "resolution_consistency": q_resolution_consistency,
    "quote_count_audit": q_quote_count_audit,
    "coverage_audit": q_coverage_audit,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_MATCHES = ", ".join(f"match_{f}" for f in SCORED_FIELDS)
_VALID = "count(*) FILTER (WHERE r <> 19)"


def _per_field_counts() -> str:
    parts = [
        f"SELECT '{f}' AS label, count(*) FILTER (WHERE match_{f}) AS correct, {_VALID} AS valid FROM fx1s"
        for f in SCORED_FIELDS
    ]
    parts.append(f"SELECT 'strict' AS label, count(*) FILTER (WHERE strict) AS correct, {_VALID} AS valid FROM fx1s")
    return "\nUNION ALL ".join(parts)


def _vocab_values() -> str:
    rows = [
        f"({O.lit(f)}, {i}, {O.lit(VOCABULARY_NAMES[f][i])}, {O.lit(v)})" for f, vals in VOCABULARIES.items() for i, v in enumerate(vals)
    ]
    return "(VALUES " + ", ".join(rows) + ") AS v(field, ordinal, name, value)"


def _vocab_counts(pre: str, where: str = "true", cause: str | None = None, effort: str | None = None) -> str:
    cause = cause or f"{pre}_cause"
    fields = [
        ("delivery_exception_type", O.pick(DELIVERY_EXCEPTION_TYPES, f"{pre}_exc")),
        ("customer_intent", O.pick(CUSTOMER_INTENTS, f"{pre}_intent")),
        ("root_cause_category", O.pick(ROOT_CAUSE_CATEGORIES, cause)),
        ("sentiment_trajectory", O.pick(SENTIMENT_TRAJECTORIES, f"{pre}_traj")),
        ("rework_frequency", O.pick(REWORK_FREQUENCIES, f"{pre}_rework")),
    ]
    return "\nUNION ALL ".join(
        f"SELECT '{f}' AS field, {e} AS value, count(*) AS n FROM fx1s WHERE {where} GROUP BY 2" for f, e in fields
    )


_STRIP_CHARS = "(chr(10) || chr(13) || chr(9) || ' ')"
_FENCE = r"```(?:json)?\s*([\s\S]*?)```"
_PREFIX = "'Model output could not be parsed as JSON. Raw reply:' || chr(10)"
_QUOTES_LIST = "list_transform(range(k % 4), lambda i: 'quote ' || CAST(k AS VARCHAR) || '-' || CAST(i AS VARCHAR))"
_VALIDW = "r NOT IN (17, 18, 19)"


def _class(e: str) -> str:
    return f"(CASE WHEN upper(trim({e})) IN ('N/A', 'NA') THEN 'N/A' ELSE 'PENDING' END)"


ORACLES = {
    "pair_gold_pred": O.with_fx1("SELECT k, status, true AS has_prediction FROM fx1s"),
    "normalize_resolved": O.with_fx1(
        f"SELECT k, {_class('g_steps')} AS gold_resolved, CASE WHEN r <> 19 THEN {_class('p_steps')} END AS pred_resolved FROM fx1s"
    ),
    "field_matches": O.with_fx1(f"SELECT k, {_MATCHES} FROM fx1s"),
    "strict_match": O.with_fx1("SELECT k, status, strict FROM fx1s"),
    "field_accuracy": O.with_fx1(
        f"""SELECT label AS field, correct, valid,
        CASE WHEN valid > 0 THEN CAST(correct AS DOUBLE) / valid ELSE 0.0 END AS accuracy
        FROM ({_per_field_counts()}) t WHERE label <> 'strict'"""
    ),
    "eval_summary": O.with_fx1(
        f"""SELECT count(*) AS total, {_VALID} AS valid, count(*) FILTER (WHERE r = 19) AS errors,
        count(*) FILTER (WHERE strict) AS strict_correct,
        CASE WHEN {_VALID} > 0 THEN CAST(count(*) FILTER (WHERE strict) AS DOUBLE) / {_VALID} ELSE 0.0 END AS strict_accuracy
        FROM fx1s"""
    ),
    "latency_summary": O.with_fx1(
        """SELECT CASE WHEN count(*) > 0 THEN CAST(sum(latency_ms) AS DOUBLE) / count(*) / 1000 ELSE 0.0 END AS latency_mean_sec,
        coalesce(CAST(min(latency_ms) AS DOUBLE) / 1000, 0.0) AS latency_min_sec,
        coalesce(CAST(max(latency_ms) AS DOUBLE) / 1000, 0.0) AS latency_max_sec,
        coalesce(CAST(sum(latency_ms) AS DOUBLE) / 1000, 0.0) AS latency_total_sec FROM fx1s"""
    ),
    "pair_with_gaps": O.with_fx1(
        f"""SELECT k, CASE WHEN k % 29 = 0 OR k % 31 = 0 THEN 'error' ELSE status END AS status,
        k % 29 <> 0 AND k % 31 <> 0 AND k % 41 <> 0 AND r <> 19 AS scored,
        CASE WHEN k % 29 <> 0 AND k % 31 <> 0 AND k % 41 <> 0 AND r <> 19 THEN strict END AS strict,
        CASE WHEN k % 41 = 0 THEN {O.lit(ev.BAD_GOLD)} WHEN k % 29 = 0 THEN {O.lit(ev.NO_PREDICTION)}
             WHEN k % 31 = 0 THEN {O.lit(ev.SEVERAL_PREDICTIONS)}
             WHEN r = 19 THEN {_PREFIX} || left(reply, 500) || '...' END AS error FROM fx1s"""
    ),
    "strict_failures": O.with_fx1(
        "SELECT k, concat_ws(', ', "
        + ", ".join(f"CASE WHEN NOT match_{f} THEN '{f}' END" for f in SCORED_FIELDS)
        + ") AS missed, CAST("
        + " + ".join(f"(CASE WHEN NOT match_{f} THEN 1 ELSE 0 END)" for f in SCORED_FIELDS)
        + " AS INTEGER) AS n_missed FROM fx1s WHERE r <> 19 AND NOT strict"
    ),
    "runtime_errors": O.with_fx1(
        f"SELECT k, left({_PREFIX} || left(reply, 500) || '...', 200) AS error FROM fx1s WHERE r = 19"
    ),
    "report_lines": O.with_fx1(
        f"""SELECT 0 AS section, CAST(0 AS BIGINT) AS line_num, '| ' || label || ' | ' || correct || '/' || valid || ' | '
              || printf('%.1f', 100.0 * correct / valid) || '% |' AS line FROM ({_per_field_counts()}) t WHERE label <> 'strict'
        UNION ALL SELECT 0, 0, '| Strict accuracy (all key fields match) | ' || printf('%.1f', 100.0 * correct / valid) || '% ('
              || correct || '/' || valid || ') |' FROM ({_per_field_counts()}) t WHERE label = 'strict'
        UNION ALL SELECT 0, 0, unnest(['| Latency (mean) | ' || printf('%.2f', sum(latency_ms) / count(*) / 1000.0) || 's |',
              '| Latency (min / max) | ' || printf('%.2f', min(latency_ms) / 1000.0) || 's / ' || printf('%.2f', max(latency_ms) / 1000.0) || 's |',
              '| Latency (total) | ' || printf('%.2f', sum(latency_ms) / 1000.0) || 's |']) FROM fx1s
        UNION ALL SELECT 1, k, '- **Line ' || k || '**: missed ' || concat_ws(', ', {", ".join(f"CASE WHEN NOT match_{f} THEN '{f}' END" for f in SCORED_FIELDS)})
              FROM fx1s WHERE r <> 19 AND NOT strict
        UNION ALL SELECT 3, k, '- Line ' || k || ': ' || left({_PREFIX} || left(reply, 500) || '...', 200) FROM fx1s WHERE r = 19"""
    ),
    "sliced_accuracy": O.with_fx1(
        f"""SELECT c.c_mktsegment AS segment, {O.pick(CUSTOMER_INTENTS, 'g_intent')} AS gold_intent,
        count(*) AS n, {_VALID} AS n_scored, count(*) FILTER (WHERE strict) AS strict_correct,
        CAST(sum({' + '.join(f'(CASE WHEN match_{f} THEN 1 ELSE 0 END)' for f in SCORED_FIELDS)}) AS BIGINT) AS fields_correct,
        GROUPING(c.c_mktsegment, {O.pick(CUSTOMER_INTENTS, 'g_intent')}) AS grouping_id
        FROM fx1s JOIN orders o ON o.o_orderkey = fx1s.k LEFT JOIN customer c ON c.c_custkey = o.o_custkey
        GROUP BY GROUPING SETS ((c.c_mktsegment), ({O.pick(CUSTOMER_INTENTS, 'g_intent')}), ())"""
    ),
    "unfence": O.with_fx1(
        f"""SELECT k, CASE WHEN regexp_matches(reply, '{_FENCE}')
        THEN trim(regexp_extract(reply, '{_FENCE}', 1), {_STRIP_CHARS}) ELSE trim(reply, {_STRIP_CHARS}) END AS body FROM fx1s"""
    ),
    "parse_reply": O.with_fx1(
        f"""SELECT k, json_valid(b) AS parse_ok,
        CASE WHEN NOT json_valid(b) THEN {_PREFIX} || left(reply, 500) || '...' END AS error
        FROM (SELECT k, reply, CASE WHEN regexp_matches(reply, '{_FENCE}')
              THEN trim(regexp_extract(reply, '{_FENCE}', 1), {_STRIP_CHARS}) ELSE reply END AS b FROM fx1s) t"""
    ),
    "validate_payload": O.with_fx1(
        """SELECT k, status, CASE WHEN r = 17 THEN 'behavioral_analytics.customer_effort_score:range'
        WHEN r = 18 THEN 'diagnostic_reasoning:required' WHEN r = 19 THEN NULL ELSE '' END AS violations FROM fx1s"""
    ),
    "apply_defaults": O.with_fx1(
        f"""SELECT k, {O.pick(DELIVERY_EXCEPTION_TYPES, 'p_exc')} AS delivery_exception_type,
        {O.pick(ROOT_CAUSE_CATEGORIES, 'e_cause')} AS root_cause_category,
        p_addr AS address_change_requested, p_missed AS missed_delivery_explicitly_mentioned,
        e_esc AS escalation_requested FROM fx1s WHERE {_VALIDW}"""
    ),
    "flatten_metrics": O.with_fx1(
        f"""SELECT k, CAST(k % 4 AS BIGINT) AS n_quotes, array_to_string({_QUOTES_LIST}, '|') AS quotes,
        {O.pick(CUSTOMER_INTENTS, 'g_intent')} AS customer_intent, CAST(g_effort AS INTEGER) AS customer_effort_score,
        {O.pick(SENTIMENT_TRAJECTORIES, 'g_traj')} AS sentiment_trajectory,
        {O.pick(REWORK_FREQUENCIES, 'g_rework')} AS rework_frequency,
        'exception_diagnostic_reasoning ' || CAST(k AS VARCHAR) AS exception_diagnostic_reasoning,
        {O.pick(DELIVERY_EXCEPTION_TYPES, 'g_exc')} AS delivery_exception_type,
        {O.pick(ROOT_CAUSE_CATEGORIES, 'g_cause')} AS root_cause_category,
        g_addr AS address_change_requested, g_missed AS missed_delivery_explicitly_mentioned,
        g_esc AS escalation_requested, g_conf AS agent_explicitly_confirmed_resolution,
        g_steps AS unresolved_next_steps,
        CASE WHEN g_effort >= 4 THEN 'Tier 2 Support' ELSE 'Tier 1 Support' END AS recommended_routing_queue,
        'intent_reasoning ' || CAST(k AS VARCHAR) AS intent_reasoning,
        'exception_reasoning ' || CAST(k AS VARCHAR) AS exception_reasoning,
        'effort_reasoning ' || CAST(k AS VARCHAR) AS effort_reasoning FROM fx1s"""
    ),
    "serialize_metrics": O.with_fx1("SELECT k, gold_json AS json FROM fx1s"),
    "inspect_view": O.with_fx1(
        f"""SELECT k, {O.pick(CUSTOMER_INTENTS, 'p_intent')} AS intent, CAST(e_effort AS INTEGER) AS effort_score,
        {O.pick(SENTIMENT_TRAJECTORIES, 'p_traj')} AS sentiment_trajectory,
        CASE WHEN k % 4 = 0 THEN '(none)' ELSE array_to_string(list_transform(range(least(k % 4, 2)),
             lambda i: 'quote ' || CAST(k AS VARCHAR) || '-' || CAST(i AS VARCHAR)), ' | ') END AS quotes,
        p_conf AS resolution_confirmed, p_steps AS unresolved_next_steps,
        CASE WHEN g_effort >= 4 THEN 'Tier 2 Support' ELSE 'Tier 1 Support' END AS routing
        FROM fx1s WHERE {_VALIDW}"""
    ),
    "vocabulary": O.with_fx1(
        f"""SELECT v.field, CAST(v.ordinal AS INTEGER) AS ordinal, v.name, v.value, CAST(coalesce(c.n, 0) AS BIGINT) AS n_gold
        FROM {_vocab_values()} LEFT JOIN ({_vocab_counts('g')}) c ON c.field = v.field AND c.value = v.value"""
    ),
    "json_valid": O.with_fx1("SELECT k, json_valid(reply) AS reply_valid, json_valid(gold_json) AS gold_valid FROM fx1s"),
    "vocab_distribution": O.with_fx1(
        f"""SELECT v.field, v.value, CAST(coalesce(c.n, 0) AS BIGINT) AS n
        FROM {_vocab_values()} LEFT JOIN ({_vocab_counts('p', _VALIDW, cause='e_cause')}) c
        ON c.field = v.field AND c.value = v.value"""
    ),
    "crm_enriched": O.with_fx1(
        f"""SELECT k, {O.pick(CUSTOMER_INTENTS, 'p_intent')} AS customer_intent,
        CAST(e_effort AS INTEGER) AS customer_effort_score, c.c_mktsegment, o.o_orderpriority,
        CAST(year(o.o_orderdate) AS BIGINT) AS order_year
        FROM fx1s JOIN orders o ON o.o_orderkey = fx1s.k LEFT JOIN customer c ON c.c_custkey = o.o_custkey
        WHERE {_VALIDW}"""
    ),
    "intent_kpis": O.with_fx1(
        f"""SELECT {O.pick(CUSTOMER_INTENTS, 'p_intent')} AS customer_intent, count(*) AS n,
        avg(e_effort) AS mean_effort, avg(CAST(e_esc AS INTEGER)) AS escalation_rate,
        avg(CAST(p_missed AS INTEGER)) AS missed_delivery_rate,
        avg(CAST(p_conf AS INTEGER)) AS confirmed_resolution_rate
        FROM fx1s WHERE {_VALIDW} GROUP BY 1"""
    ),
    "intent_cause_cube": O.with_fx1(
        f"""SELECT {O.pick(CUSTOMER_INTENTS, 'p_intent')} AS customer_intent,
        {O.pick(ROOT_CAUSE_CATEGORIES, 'e_cause')} AS root_cause_category, count(*) AS n,
        GROUPING({O.pick(CUSTOMER_INTENTS, 'p_intent')}, {O.pick(ROOT_CAUSE_CATEGORIES, 'e_cause')}) AS grouping_id
        FROM fx1s WHERE {_VALIDW} GROUP BY CUBE (1, 2)"""
    ),
    "friction_quotes": O.with_fx1(
        f"""SELECT k, CAST(i AS BIGINT) AS pos, 'quote ' || CAST(k AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS quote
        FROM (SELECT k, unnest(range(k % 4)) AS i FROM fx1s WHERE {_VALIDW}) t"""
    ),
    "queue_load": O.with_fx1(
        f"""SELECT CASE WHEN g_effort >= 4 THEN 'Tier 2 Support' ELSE 'Tier 1 Support' END AS recommended_routing_queue,
        {O.pick(CUSTOMER_INTENTS, 'p_intent')} AS customer_intent, count(*) AS n FROM fx1s WHERE {_VALIDW} GROUP BY 1, 2"""
    ),
    "resolution_consistency": O.with_fx1(
        f"""SELECT g_conf AS confirmed, {_class('g_steps')} AS steps_class, count(*) AS n,
        (g_conf = ({_class('g_steps')} = 'N/A')) AS consistent FROM fx1s GROUP BY 1, 2"""
    ),
    "quote_count_audit": O.with_fx1(
        """SELECT CAST(k % 4 AS BIGINT) AS n_quotes, count(*) AS n, (k % 4 = 0 OR k % 4 BETWEEN 1 AND 3) AS in_rule
        FROM fx1s GROUP BY 1, 3"""
    ),
    "coverage_audit": O.with_fx1(
        """SELECT c AS "check", observed, threshold,
        observed >= threshold AS passed FROM (
          SELECT 'distinct_intents' AS c, count(DISTINCT g_intent) AS observed, CAST(6 AS BIGINT) AS threshold FROM fx1s
          UNION ALL SELECT 'effort_low_1_2', count(*) FILTER (WHERE g_effort BETWEEN 1 AND 2), 2 FROM fx1s
          UNION ALL SELECT 'effort_moderate_3', count(*) FILTER (WHERE g_effort = 3), 2 FROM fx1s
          UNION ALL SELECT 'effort_high_4_5', count(*) FILTER (WHERE g_effort BETWEEN 4 AND 5), 2 FROM fx1s
          UNION ALL SELECT 'escalation_requested', count(*) FILTER (WHERE g_esc), 2 FROM fx1s
          UNION ALL SELECT 'resolved', count(*) FILTER (WHERE g_conf), 2 FROM fx1s
          UNION ALL SELECT 'unresolved_with_next_steps', count(*) FILTER (WHERE NOT g_conf AND upper(trim(g_steps)) NOT IN ('N/A', 'NA')), 2 FROM fx1s
          UNION ALL SELECT 'proof_of_delivery', count(*) FILTER (WHERE g_intent = 5), 1 FROM fx1s
          UNION ALL SELECT 'customs_or_documentation', count(*) FILTER (WHERE g_intent IN (8, 9)), 1 FROM fx1s
        ) t"""
    ),
}
