"""Registered queries: run logs (L1-L3), publish gate (Q5), release (Q6-Q8),
streaming requests (K1-K2) and evaluation sinks (S5-S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, release, runlog
from ..operators import evaluate as ev
from ..functions.stage import materialize
from ..schema import CUSTOMER_INTENTS, REQUIRED_DATASET_FILES, REQUIRED_MODEL_FILES, REQUIRED_SPLITS, SCORED_FIELDS
from ..session import scratch_path
from ..sources import chatml
from ..sources import fixture_models as fm
from ..sources import fixtures as fx
from ..streaming import requests as rq
from . import dialog_queries as dq
from . import eval_queries as eq
from . import oracle_fx as O

# ---------------------------------------------------------------------------
# L1-L3 (events as a training log: step = event_id + 1, loss = value)
# ---------------------------------------------------------------------------


def run_log(spark, sf) -> DataFrame:
    e = fx.table(spark, sf, "events")
    return e.select((F.col("event_id") + 1).alias("step"), F.col("value").alias("loss"), "event_type", "user_id", "ts")


def q_loss_curve(spark, sf):
    return run_log(spark, sf).select("step", "loss")


def q_loss_summary(spark, sf):
    return runlog.loss_summary(run_log(spark, sf))


def q_run_throughput(spark, sf):
    """Each event type is one run: steps, wall time from first to last event, distinct users as examples."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    runs = run_log(spark, sf).groupBy(F.col("event_type").alias("run")).agg(
        F.count(F.lit(1)).alias("steps"),
        ((F.max(us) - F.min(us)).cast("double") / 1000000).alias("runtime_sec"),
        F.count_distinct("user_id").alias("n_examples"),
    )
    return runlog.run_throughput(runs)


# ---------------------------------------------------------------------------
# Q5-Q8
# ---------------------------------------------------------------------------


def q_publish_gate(spark, sf):
    """Findings by kind, and whether the text may be published (no finding of the kind)."""
    return audit.publish_gate(fx.table(spark, sf, "documents"), "text")


def staged_path(spark: SparkSession, sf: str) -> str:
    t = dq.gold_for_conversations(dq.transcripts(spark, sf))
    rows = t.select(
        "conv_id",
        release.split_of(F.col("conv_id")).alias("split"),
        dq.msg.training_messages(F.col("transcript"), F.col("gold_json")).alias("messages"),
    )
    path = scratch_path(spark, "release")
    release.stage_splits(rows, path)
    return path


def staged(spark, sf) -> DataFrame:
    return spark.read.schema("conv_id bigint, messages array<struct<role:string,content:string>>, split string").json(
        staged_path(spark, sf)
    )


def q_staged_splits(spark, sf):
    return staged(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def q_missing_artifacts(spark, sf):
    """Required files minus those that a listing of the staged directory finds."""
    return release.missing_artifacts(release.required_artifacts(spark), release.present_artifacts(spark, staged_path(spark, sf)))


def q_missing_splits(spark, sf):
    return release.missing_splits(staged(spark, sf))


def q_missing_splits_without(spark, sf):
    """Q8 with each split left out in turn: what is then missing."""
    rows = staged(spark, sf)
    out = None
    for name in ("train", "test", "validation"):
        one = release.missing_splits(rows.filter(F.col("split") != name)).select(F.lit(name).alias("left_out"), "split")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------------------
# K1-K2 streaming
# ---------------------------------------------------------------------------


def _request_source(spark, sf) -> str:
    path = scratch_path(spark, "requests")
    fx.request_bodies(spark, sf).write.json(path)
    return path


def _stream(spark, sf, factory) -> rq.Sinks:
    src = _request_source(spark, sf)
    sink, ckpt = scratch_path(spark, "responses"), scratch_path(spark, "stream-ckpt")
    rq.run_stream(spark, src, sink, ckpt, factory)
    return rq.Sinks(spark, sink)


def q_stream_requests(spark, sf):
    """K1: accepted requests, and the dead letters beside them."""
    sinks = _stream(spark, sf, None)
    out = sinks.answers.read().unionByName(sinks.dead_letters.read().drop("body"), allowMissingColumns=True)
    return out.select("request_id", F.col("http_status").cast("int").alias("http_status"), "error", "system_prompt", "transcript")


def q_stream_extract(spark, sf):
    """K2: answers, and the dead letters beside them."""
    sinks = _stream(spark, sf, fm.extractor_factory)
    out = sinks.answers.read().unionByName(sinks.dead_letters.read().drop("body"), allowMissingColumns=True)
    return out.select("request_id", F.col("http_status").cast("int").alias("http_status"), "customer_intent", "error")


def q_dead_letters(spark, sf):
    """K1: what the dead-letter sink alone holds, with its reason and the length of the body."""
    sinks = _stream(spark, sf, None)
    return sinks.dead_letters.read().select("request_id", "http_status", "error", F.length("body").cast("long").alias("body_chars"))


# ---------------------------------------------------------------------------
# S5-S6 evaluation sinks
# ---------------------------------------------------------------------------

OUTPUT_SCHEMA = "line_num bigint, pred string, gold string, latency_sec double, strict_match boolean, error string"


def _result_columns(keep: list[str]) -> list:
    return [
        *keep,
        F.col("pred_json").alias("pred"),
        F.col("gold_json").alias("gold"),
        (F.col("latency_ms").cast("double") / 1000).alias("latency_sec"),
        F.col("strict").alias("strict_match"),
        "error",
    ]


def write_eval_outputs(scored: DataFrame, path: str, keep: list[str]) -> None:
    """One JSON line per example, nulls kept (pred/gold as JSON text); gzip files, the two documents repeat their keys in each line."""
    chatml.write_jsonl_keep_nulls(scored.select(*_result_columns(keep)), path, "gzip")


def write_eval_results(scored: DataFrame, counts: DataFrame, results: str, summary: str, keep: list[str]) -> None:
    """The per-row results (with every match) and the summary, as two datasets."""
    match = F.struct(*[F.col(ev.match_col(f)).alias(f) for f in SCORED_FIELDS], F.col("strict"))
    scored.select(*_result_columns(keep), "status", F.when(F.col("scored"), match).alias("match")).write.mode("overwrite").parquet(results)
    valid = F.col("valid")
    one = counts.select(
        F.col("total").cast("long").alias("total"),
        valid.cast("long").alias("valid"),
        (F.col("total") - valid).cast("long").alias("errors"),
        F.col("strict_correct").cast("long").alias("strict_correct"),
        F.when(valid > 0, F.col("strict_correct").cast("double") / valid).otherwise(0.0).alias("strict_accuracy"),
        F.struct(*[F.when(valid > 0, F.col(f).cast("double") / valid).otherwise(0.0).alias(f) for f in SCORED_FIELDS]).alias("per_field_accuracy"),
        F.struct(
            F.when(F.col("total") > 0, F.col("latency_ms_total").cast("double") / F.col("total") / 1000).otherwise(0.0).alias("mean"),
            *[F.coalesce(F.col(f"latency_ms_{k}").cast("double") / 1000, F.lit(0.0)).alias(k) for k in ("min", "max", "total")],
        ).alias("latency_sec"),
    )
    one.write.mode("overwrite").json(summary)


SUMMARY_SCHEMA = (
    "total bigint, valid bigint, errors bigint, strict_correct bigint, strict_accuracy double, per_field_accuracy struct<"
    + ", ".join(f"{f}: double" for f in SCORED_FIELDS)
    + ">, latency_sec struct<mean: double, min: double, max: double, total: double>"
)


def q_eval_outputs(spark, sf):
    """Every written line read back: prediction and gold as digests of their text."""
    path = scratch_path(spark, "eval-outputs")
    scored = ev.evaluate(fx.gold_table(spark, sf), fx.prediction_table(spark, sf), "k", documents=True)
    write_eval_outputs(scored.withColumnRenamed("k", "line_num"), path, ["line_num"])
    back = spark.read.schema(OUTPUT_SCHEMA).json(path)
    return back.select(
        "line_num", "latency_sec", "strict_match", "error", F.md5("gold").alias("gold_md5"),
        F.col("pred").isNotNull().alias("has_pred"),
        F.get_json_object("pred", "$.behavioral_analytics.customer_effort_score").cast("int").alias("pred_effort"),
        F.get_json_object("pred", "$.operational_analytics.unresolved_next_steps").alias("pred_steps"),
    )


def q_eval_results(spark, sf):
    """Summary and per-row results as two datasets (never one driver-side document), read back."""
    path = scratch_path(spark, "eval-results")
    scored = ev.evaluate(fx.gold_table(spark, sf), fx.prediction_table(spark, sf), "k", documents=True)
    s = materialize(scored.withColumnRenamed("k", "line_num"), f"{path}/scored")
    write_eval_results(s, ev.summary_counts(s), f"{path}/results", f"{path}/summary", ["line_num"])
    summary = spark.read.schema(SUMMARY_SCHEMA).json(f"{path}/summary")
    flat = summary.select(
        "total", "valid", "errors", "strict_correct", "strict_accuracy",
        *[F.col(f"latency_sec.{c}").alias(f"latency_{c}_sec") for c in ("mean", "min", "max", "total")],
        *[F.col(f"per_field_accuracy.{f}").alias(f"acc_{f}") for f in SCORED_FIELDS],
    )
    checks = spark.read.parquet(f"{path}/results").agg(
        F.count(F.lit(1)).alias("n_results"),
        F.count("pred").alias("n_pred"),
        F.count("error").alias("n_error"),
        F.count_if(F.col("match.customer_intent")).alias("n_intent_matches"),
    )

    def long(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast("double").alias(c) for c in df.columns]).unpivot([], df.columns, "label", "value")

    return long(flat).unionByName(long(checks))


QUERIES = {
    "loss_curve": q_loss_curve,
    "loss_summary": q_loss_summary,
    "run_throughput": q_run_throughput,
    "publish_gate": q_publish_gate,
    "staged_splits": q_staged_splits,
    "missing_artifacts": q_missing_artifacts,
    "missing_splits": q_missing_splits,
    "missing_splits_without": q_missing_splits_without,
    "stream_requests": q_stream_requests,
    "stream_extract": q_stream_extract,
    "dead_letters": q_dead_letters,
    "eval_outputs": q_eval_outputs,
    "eval_results": q_eval_results,
}

# ---------------------------------------------------------------------------
# oracles
# ---------------------------------------------------------------------------

_SPLIT = """CASE WHEN b < 20 THEN 'test' WHEN b < 30 THEN 'validation' ELSE 'train' END"""
_B = "CAST(CAST(('0x' || substr(md5('split:' || CAST(conv_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS INTEGER)"
_CONVS = "SELECT DISTINCT conv_id FROM conversations WHERE role <> 'system'"
_DIGITS = "regexp_replace(t, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum(list_transform(range(length({_DIGITS})), lambda i: (CAST(substr({_DIGITS}, length({_DIGITS}) - CAST(i AS INTEGER), 1) AS INTEGER)"
    f" * (1 + i % 2)) // 10 + (CAST(substr({_DIGITS}, length({_DIGITS}) - CAST(i AS INTEGER), 1) AS INTEGER) * (1 + i % 2)) % 10)) % 10 = 0"
)
_KREQ = "(22 + length(CAST(event_id AS VARCHAR)))"

_RESULT_LABELS = [
    "total", "valid", "errors", "strict_correct", "strict_accuracy", "latency_mean_sec", "latency_min_sec", "latency_max_sec",
    "latency_total_sec", *[f"acc_{f}" for f in SCORED_FIELDS], "n_results", "n_pred", "n_error", "n_intent_matches",
]
_VALID = "count(*) FILTER (WHERE r <> 19)"
_RESULT_VALUES = [
    "count(*)", _VALID, "count(*) FILTER (WHERE r = 19)", "count(*) FILTER (WHERE strict)",
    f"CAST(count(*) FILTER (WHERE strict) AS DOUBLE) / {_VALID}", "CAST(sum(latency_ms) AS DOUBLE) / count(*) / 1000",
    "CAST(min(latency_ms) AS DOUBLE) / 1000", "CAST(max(latency_ms) AS DOUBLE) / 1000", "CAST(sum(latency_ms) AS DOUBLE) / 1000",
    *[f"CAST(count(*) FILTER (WHERE match_{f}) AS DOUBLE) / {_VALID}" for f in SCORED_FIELDS],
    "count(*)", _VALID, "count(*) FILTER (WHERE r = 19)", "count(*) FILTER (WHERE match_customer_intent)",
]

_REQUIRED = ", ".join(f"('{r}', '{a}')" for r, names in (("dataset", REQUIRED_DATASET_FILES), ("model", REQUIRED_MODEL_FILES)) for a in names)
_SPLITS = ", ".join(f"('{s}')" for s in REQUIRED_SPLITS)

ORACLES = {
    "loss_curve": "SELECT event_id + 1 AS step, value AS loss FROM events",
    "loss_summary": """SELECT count(*) AS n_steps, arg_min(value, event_id) AS initial_loss, arg_max(value, event_id) AS final_loss,
        CAST(sum(CAST(value AS DECIMAL(38, 6))) AS DOUBLE) / count(*) AS mean_loss, min(value) AS min_loss, max(value) AS max_loss
        FROM events""",
    "run_throughput": """SELECT run, steps, runtime_sec, n_examples, 8 AS effective_batch,
        CAST(steps * 8 AS DOUBLE) / n_examples AS epochs,
        CASE WHEN steps > 0 THEN runtime_sec / steps ELSE 0.0 END AS sec_per_step,
        CASE WHEN runtime_sec > 0 THEN CAST(steps * 8 AS DOUBLE) / runtime_sec ELSE 0.0 END AS samples_per_sec
        FROM (SELECT event_type AS run, count(*) AS steps,
                     CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000 AS runtime_sec,
                     count(DISTINCT user_id) AS n_examples FROM events GROUP BY 1) t""",
    "publish_gate": f"""WITH d AS (
          SELECT len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')) AS email,
                 len(list_filter(list_transform(string_split_regex(text, '[^0-9.]+'), lambda x: trim(x, '.')),
                     lambda x: regexp_full_match(x, '[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}')
                       AND len(list_filter(string_split(x, '.'), lambda o: TRY_CAST(o AS INTEGER) > 255)) = 0)) AS ipv4,
                 len(list_filter(regexp_extract_all(text, '[0-9](?:[ -]?[0-9])+'),
                     lambda t: length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN})) AS card_number,
                 len(regexp_extract_all(text, 'token\\s*=\\s*"[^"]*"')) AS secret_token
          FROM documents),
        s AS (
        SELECT 'email' AS kind, count(*) FILTER (WHERE email > 0) AS n_docs, CAST(coalesce(sum(email), 0) AS BIGINT) AS n_matches FROM d
        UNION ALL SELECT 'ipv4', count(*) FILTER (WHERE ipv4 > 0), CAST(coalesce(sum(ipv4), 0) AS BIGINT) FROM d
        UNION ALL SELECT 'card_number', count(*) FILTER (WHERE card_number > 0), CAST(coalesce(sum(card_number), 0) AS BIGINT) FROM d
        UNION ALL SELECT 'secret_token', count(*) FILTER (WHERE secret_token > 0), CAST(coalesce(sum(secret_token), 0) AS BIGINT) FROM d)
        SELECT kind, n_docs, n_matches, n_matches = 0 AS passed FROM s""",
    "staged_splits": f"SELECT split, count(*) AS n FROM (SELECT {_SPLIT} AS split FROM (SELECT conv_id, {_B} AS b FROM ({_CONVS}) c) x) y GROUP BY 1",
    "missing_artifacts": f"""SELECT repo, artifact FROM (VALUES {_REQUIRED}) r(repo, artifact)
        WHERE NOT (repo = 'dataset' AND artifact IN (
          SELECT DISTINCT {_SPLIT} || '.jsonl' FROM (SELECT conv_id, {_B} AS b FROM ({_CONVS}) c) x))""",
    "missing_splits_without": f"""SELECT l AS left_out, split FROM (VALUES ('train'), ('test'), ('validation')) o(l), (VALUES {_SPLITS}) r(split)
        WHERE split NOT IN (SELECT DISTINCT {_SPLIT} FROM (SELECT conv_id, {_B} AS b FROM ({_CONVS}) c) x WHERE {_SPLIT} <> l)""",
    "missing_splits": f"""SELECT split FROM (VALUES {_SPLITS}) r(split)
        WHERE split NOT IN (SELECT DISTINCT {_SPLIT} FROM (SELECT conv_id, {_B} AS b FROM ({_CONVS}) c) x)""",
    "stream_requests": """SELECT event_id AS request_id,
        CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 200 ELSE 400 END AS http_status,
        CASE WHEN event_type IN ('signup', 'error') THEN 'Missing or empty ''transcript''' END AS error,
        CASE WHEN event_type = 'click' THEN ' P' || CAST(event_id AS VARCHAR) || ' ' END AS system_prompt,
        CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'Agent: hi ' || CAST(event_id AS VARCHAR) END AS transcript
        FROM events""",
    "dead_letters": """SELECT event_id AS request_id, CAST(400 AS INTEGER) AS http_status, 'Missing or empty ''transcript''' AS error,
        CAST(CASE WHEN event_type = 'signup' THEN 19 ELSE 14 END AS BIGINT) AS body_chars
        FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')""",
    "stream_extract": f"""SELECT event_id AS request_id,
        CASE WHEN event_type NOT IN ('view', 'click', 'purchase') THEN 400 WHEN {_KREQ} % 13 = 0 THEN 500 ELSE 200 END AS http_status,
        CASE WHEN event_type IN ('view', 'click', 'purchase') AND {_KREQ} % 13 <> 0 THEN {O.pick(CUSTOMER_INTENTS, f'{_KREQ} % 10')} END AS customer_intent,
        CASE WHEN event_type NOT IN ('view', 'click', 'purchase') THEN 'Missing or empty ''transcript'''
             WHEN {_KREQ} % 13 = 0 THEN 'boom ' || CAST({_KREQ} AS VARCHAR) END AS error
        FROM events""",
    "eval_outputs": O.with_fx1(
        """SELECT k AS line_num, CAST(latency_ms AS DOUBLE) / 1000 AS latency_sec, strict AS strict_match,
        CASE WHEN r = 19 THEN 'Model output could not be parsed as JSON. Raw reply:' || chr(10) || left(reply, 500) || '...' END AS error,
        md5(gold_json) AS gold_md5, r <> 19 AS has_pred,
        CASE WHEN r <> 19 THEN CAST(e_effort AS INTEGER) END AS pred_effort,
        CASE WHEN r <> 19 THEN p_steps END AS pred_steps FROM fx1s"""
    ),
    "eval_results": O.with_fx1(
        """SELECT unnest(l) AS label, unnest(v) AS value FROM (SELECT """
        + "["
        + ", ".join(O.lit(x) for x in _RESULT_LABELS)
        + "] AS l, ["
        + ", ".join(f"CAST({x} AS DOUBLE)" for x in _RESULT_VALUES)
        + "] AS v FROM fx1s) t"
    ),
}
