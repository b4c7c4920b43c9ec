"""Registered queries over conversations (FX2), synthetic generation and requests (FX4).

Model calls use the deterministic stand-ins of ``sources.fixture_models``; every
decision they take depends on text lengths, which the SQL oracles recompute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import json_valid, ustrip
from ..functions.stage import stage
from ..operators import evaluate as ev
from ..operators import extract as ex
from ..operators import messages as msg
from ..operators import synth as sy
from ..schema import CHANNELS, CUSTOMER_INTENTS, GENERATION_PROMPT_TEMPLATE, PERSONAS, SCENARIOS, SYSTEM_PROMPT
from ..session import scratch_path
from ..sources import chatml
from ..sources.commits import BatchStore
from ..sources import fixture_models as fm
from ..sources import fixtures as fx
from ..streaming import requests as rq
from . import oracle_fx as O

# ---------------------------------------------------------------------------
# plan pieces
# ---------------------------------------------------------------------------


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return msg.assemble_transcripts(fx.turns(spark, sf))


def gold_for_conversations(t: DataFrame) -> DataFrame:
    k = F.col("conv_id")
    return t.withColumn("gold_json", fx.gold_json(k, fx.status_from_key(k)))


def extraction_prompts(spark: SparkSession, sf: str) -> DataFrame:
    t = transcripts(spark, sf)
    m = msg.extraction_messages(F.col("transcript"))
    return t.withColumn("prompt", msg.chat_template(m, add_generation_prompt=True))


def extracted(spark: SparkSession, sf: str) -> DataFrame:
    """X1 on FX2: model once per task, then P2-P5 as native columns."""
    called = ex.run_model(extraction_prompts(spark, sf), fm.extractor_factory, "conv_id", "prompt", carry=["transcript"])
    return ev.prepare_predictions(called)


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """One synthetic sample per conversation id (so the job grows with the table)."""
    c = fx.table(spark, sf, "conversations").select(F.col("conv_id").alias("sample_id")).distinct()
    return sy.with_labels(sy.sample_scenarios(c, "sample_id"))


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf)
    return s.withColumn("prompt", sy.render_prompt(F.col("channel"), F.col("persona"), F.col("scenario")))


# ---------------------------------------------------------------------------
# T1-T8
# ---------------------------------------------------------------------------


def q_assemble_transcripts(spark, sf):
    return transcripts(spark, sf)


def q_split_turns(spark, sf):
    return msg.split_turns(transcripts(spark, sf), keep=["conv_id"])


def q_turn_count_audit(spark, sf):
    return msg.turn_count_audit(q_split_turns(spark, sf)).select("conv_id", F.col("n_turns").cast("long"), "in_range")


def q_build_training_rows(spark, sf):
    t = gold_for_conversations(transcripts(spark, sf))
    lines = stage(t.select("conv_id", msg.training_line(F.col("transcript"), F.col("gold_json")).alias("line")))
    m = F.from_json(F.col("line"), "messages array<struct<role:string,content:string>>").getField("messages")
    return lines.select(
        "conv_id",
        F.size(m).cast("long").alias("n_messages"),
        F.array_join(F.transform(m, lambda x: x.getField("role")), ",").alias("roles"),
        F.md5(m[1].getField("content")).alias("user_md5"),
        F.md5(m[2].getField("content")).alias("assistant_md5"),
        json_valid(F.col("line")).alias("line_valid"),
    )


def q_build_prompt(spark, sf):
    t = transcripts(spark, sf)
    m = msg.extraction_messages(F.col("transcript"))
    return t.select("conv_id", m[0].getField("content").alias("system"), m[1].getField("content").alias("user"))


def _templates(spark, sf):
    t = gold_for_conversations(transcripts(spark, sf))
    train = msg.chat_template(msg.training_messages(F.col("transcript"), F.col("gold_json")))
    infer = msg.chat_template(msg.extraction_messages(F.col("transcript")), add_generation_prompt=True)
    return t.select("conv_id", train.alias("train_text"), infer.alias("infer_text"))


def q_chat_template(spark, sf):
    return _templates(spark, sf)


def q_sequence_budget(spark, sf):
    t = _templates(spark, sf)
    return msg.sequence_budget(t, "train_text").select("conv_id", "n_tokens", "over_budget")


def request_table(spark, sf):
    return rq.classify_requests(fx.request_bodies(spark, sf))


def q_system_prompt_audit(spark, sf):
    acc = request_table(spark, sf).filter(F.col("accepted"))
    eff = ustrip(F.coalesce(F.col("system_prompt"), F.lit(SYSTEM_PROMPT)))
    return msg.system_prompt_audit(acc.withColumn("effective", eff), "effective")


# ---------------------------------------------------------------------------
# X1, X3, X4, Q2
# ---------------------------------------------------------------------------


def q_batch_extract(spark, sf):
    e = extracted(spark, sf)
    return e.select("conv_id", "status", F.col("metrics.behavioral_analytics.customer_intent").alias("customer_intent"), "error")


def q_retry_outcomes(spark, sf):
    p = extraction_prompts(spark, sf)
    stages = [("generation", fm.flaky_factory("generation")), ("extraction", fm.flaky_factory("extraction"))]
    r = ex.run_stages(p, "conv_id", "prompt", stages, sleep=ex.no_sleep)
    return r.select("conv_id", "status", "generation_attempts", "extraction_attempts", "waited_sec")


def q_grounding_audit(spark, sf):
    """Q2: extracted quotes and intent reasoning must occur in the transcript (whitespace folded)."""
    e = extracted(spark, sf).filter(F.col("status") == "valid").select("conv_id", "metrics", "transcript")

    def fold(c):
        return F.regexp_replace(ustrip(c), r"(?U)\s+", " ")

    j = e.withColumn("_t", fold(F.col("transcript")))
    quotes = F.col("metrics.behavioral_analytics.effort_and_friction_quotes")
    grounded = F.filter(quotes, lambda q: F.instr(F.col("_t"), fold(q)) > 0)
    reasoning = F.col("metrics.diagnostic_reasoning.intent_reasoning")
    return j.select(
        "conv_id",
        F.size(quotes).cast("long").alias("n_quotes"),
        F.size(grounded).cast("long").alias("n_grounded"),
        (F.instr(F.col("_t"), fold(reasoning)) > 0).alias("intent_reasoning_grounded"),
    )


def q_scenario_grid(spark, sf):
    counts = samples(spark, sf).groupBy("channel_idx", "persona_idx", "scenario_idx").agg(F.count(F.lit(1)).alias("n"))
    grid = sy.with_labels(sy.scenario_grid(spark))  # 192 rows, fixed size
    return grid.join(counts, ["channel_idx", "persona_idx", "scenario_idx"], "left").select(
        "channel_idx", "persona_idx", "scenario_idx", "channel", "persona", "scenario",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_samples"),
    )


def q_sample_scenarios(spark, sf):
    return samples(spark, sf).select("sample_id", "channel_idx", "persona_idx", "scenario_idx")


def q_render_prompts(spark, sf):
    return prompts(spark, sf).select("sample_id", "prompt")


def generated(spark, sf):
    p = prompts(spark, sf)
    g = ex.run_model(p, fm.generator_factory, "sample_id", "prompt", retries=5, sleep=ex.no_sleep, accept=ex.not_blank)
    return g.withColumn("transcript", ustrip(F.col("reply")))


def q_generate_transcripts(spark, sf):
    g = generated(spark, sf)
    return g.select("sample_id", F.col("model_error").isNull().alias("ok"), "transcript", "attempts", F.col("model_error").alias("error"))


def q_synth_pipeline_status(spark, sf):
    """Draw -> prompt -> generate -> label (validated) -> training row -> append, read back and counted.

    Both model stages run in one pass with one retry delay per sample.
    """
    made = sy.run_pipeline(
        prompts(spark, sf), "sample_id", "prompt", fm.generator_factory, fm.extractor_factory, scratch_path(spark, "synthetic"),
        sleep=ex.no_sleep,
    )
    outcomes = made.outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    rows = chatml.read_appended(spark, made.rows_path)
    appended = rows.agg(
        F.lit("appended").alias("status"),
        F.count_if((F.size("messages") == 3) & json_valid(F.col("messages")[2].getField("content"))).alias("n"),
    )
    return outcomes.unionByName(appended)


def q_roundtrip_append(spark, sf):
    """Training rows appended twice to a new directory, read back with the explicit schema."""
    t = gold_for_conversations(transcripts(spark, sf))
    rows = t.select(msg.training_messages(F.col("transcript"), F.col("gold_json")).alias("messages"))
    path = scratch_path(spark, "train-jsonl")
    chatml.append_jsonl(rows, path)
    chatml.append_jsonl(rows, path)
    back = chatml.read_training_jsonl(spark, path)
    k = F.get_json_object(back.messages[2].getField("content"), "$.operational_analytics.exception_diagnostic_reasoning")
    return (
        back.select(F.regexp_extract(k, r"(\d+)$", 1).cast("long").alias("conv_id"), F.size("messages").cast("long").alias("n_messages"))
        .groupBy("conv_id", "n_messages")
        .agg(F.count(F.lit(1)).alias("n_copies"))
    )


def q_appended_batches(spark, sf):
    """Two batches appended, the first one again, and rows left without a commit; what is read back."""
    t = gold_for_conversations(transcripts(spark, sf))
    path = scratch_path(spark, "batches")
    rows = t.select("conv_id", msg.training_messages(F.col("transcript"), F.col("gold_json")).alias("messages"))
    halves = [rows.filter(F.col("conv_id") % 2 == i).select("messages") for i in (0, 1)]
    written = [chatml.append_jsonl(halves[i], path, f"half{i}") for i in (0, 1, 0)]
    halves[1].write.json(f"{path}/data/left-over")  # as of a job that died before its commit
    back = chatml.read_appended(spark, path)
    k = F.get_json_object(back.messages[2].getField("content"), "$.operational_analytics.exception_diagnostic_reasoning")
    return back.groupBy(F.regexp_extract(k, r"(\d+)$", 1).cast("long").alias("conv_id")).agg(
        F.count(F.lit(1)).alias("n_copies"), F.lit(sum(written)).cast("long").alias("n_written")
    )


def q_resumed_extract(spark, sf):
    """A job that dies after two of four steps, run again: the replies, and how many outputs each conversation has."""
    path = scratch_path(spark, "resumed")
    asked = extraction_prompts(spark, sf).select("conv_id", "prompt")
    steps = []

    def call(todo):
        steps.append(todo)
        if len(steps) == 3:
            raise KeyboardInterrupt
        return ex.run_model(todo, fm.extractor_factory, "conv_id", "prompt", carry=["_asked"])

    try:
        ex.run_once(asked, ["conv_id"], ["prompt"], path, call, chunks=4)
    except KeyboardInterrupt:
        pass
    done = ex.run_once(asked, ["conv_id"], ["prompt"], path, call, chunks=4)
    outputs = BatchStore(spark, path).read().groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_outputs"))
    p = ev.prepare_predictions(done).join(outputs, "conv_id")
    return p.select("conv_id", "status", F.col("metrics.behavioral_analytics.customer_intent").alias("customer_intent"), "n_outputs")


PIECE = 1000  # characters: most conversations of the table have several pieces


def q_assemble_pieces(spark, sf):
    return msg.assemble_pieces(fx.turns(spark, sf), piece_chars=PIECE)


QUERIES = {
    "assemble_transcripts": q_assemble_transcripts,
    "assemble_pieces": q_assemble_pieces,
    "appended_batches": q_appended_batches,
    "resumed_extract": q_resumed_extract,
    "split_turns": q_split_turns,
    "turn_count_audit": q_turn_count_audit,
    "build_training_rows": q_build_training_rows,
    "build_prompt": q_build_prompt,
    "chat_template": q_chat_template,
    "sequence_budget": q_sequence_budget,
    "system_prompt_audit": q_system_prompt_audit,
    "batch_extract": q_batch_extract,
    "retry_outcomes": q_retry_outcomes,
    "grounding_audit": q_grounding_audit,
    "scenario_grid": q_scenario_grid,
    "sample_scenarios": q_sample_scenarios,
    "render_prompts": q_render_prompts,
    "generate_transcripts": q_generate_transcripts,
    "synth_pipeline_status": q_synth_pipeline_status,
    "roundtrip_append": q_roundtrip_append,
}

# ---------------------------------------------------------------------------
# oracles
# ---------------------------------------------------------------------------

NL = "chr(10)"
_TR = f"""tr AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(CASE WHEN role = 'user' THEN 'Customer' ELSE 'Agent' END || ': ' || text, {NL} ORDER BY turn) AS transcript,
    min(turn) FILTER (WHERE role = 'user') AS first_user_turn
  FROM conversations WHERE role <> 'system' GROUP BY conv_id)"""
_SYS = O.lit(SYSTEM_PROMPT)
_INFER = (
    f"'<|im_start|>system' || {NL} || {_SYS} || '<|im_end|>' || {NL} || '<|im_start|>user' || {NL} || 'Transcript:' || {NL}"
    f" || transcript || '<|im_end|>' || {NL} || '<|im_start|>assistant' || {NL}"
)
_TRAIN = (
    f"'<|im_start|>system' || {NL} || {_SYS} || '<|im_end|>' || {NL} || '<|im_start|>user' || {NL} || transcript"
    f" || '<|im_end|>' || {NL} || '<|im_start|>assistant' || {NL} || gold_json || '<|im_end|>' || {NL}"
)
_CONV_FX1 = "SELECT conv_id AS kk, (['F', 'O', 'P'])[conv_id % 3 + 1] AS ss FROM (SELECT DISTINCT conv_id FROM conversations WHERE role <> 'system')"


def _with_tr(select: str) -> str:
    return f"WITH {_TR}\n{select}"


def _with_tr_fx1(select: str) -> str:
    return f"WITH {O.fx1_ctes(_CONV_FX1)},\n{_TR}\n{select}"


def _md5draw(axis: str, n: int) -> str:
    return f"CAST(CAST(('0x' || substr(md5('42:{axis}:' || CAST(sample_id AS VARCHAR)), 1, 8)) AS BIGINT) % {n} AS INTEGER)"


_SAMPLES = f"""smp AS (
  SELECT sample_id, {_md5draw('channel', 3)} AS channel_idx, {_md5draw('persona', 8)} AS persona_idx,
         {_md5draw('scenario', 8)} AS scenario_idx
  FROM (SELECT DISTINCT conv_id AS sample_id FROM conversations) s)"""


def _prompt_sql() -> str:
    t = GENERATION_PROMPT_TEMPLATE
    a, rest = t.split("{channel}", 1)
    b, rest = rest.split("{persona}", 1)
    c, d = rest.split("{scenario}", 1)
    sql_lit = lambda x: "(" + " || chr(10) || ".join(O.lit(p) for p in x.split("\n")) + ")"
    return (
        f"{sql_lit(a)} || {O.pick(CHANNELS, 'channel_idx')} || {sql_lit(b)} || {O.pick(PERSONAS, 'persona_idx')}"
        f" || {sql_lit(c)} || {O.pick(SCENARIOS, 'scenario_idx')} || {sql_lit(d)}"
    )


_PROMPTS = f"prm AS (SELECT sample_id, channel_idx, persona_idx, scenario_idx, {_prompt_sql()} AS prompt FROM smp)"
_GEN_TEXT = f"'Agent: Hello, case ' || CAST(length(prompt) AS VARCHAR) || '.' || {NL} || 'Customer: Thanks.'"
_K = "(12 + length(transcript))"
_P = f"length({_INFER})"

ORACLES = {
    "assemble_transcripts": _with_tr("SELECT conv_id, n_turns, transcript FROM tr"),
    "assemble_pieces": f"""SELECT conv_id, piece, count(*) AS n_turns, string_agg(line, {NL} ORDER BY turn, line) AS transcript
        FROM (SELECT *, ((sum(length(line) + 1) OVER (PARTITION BY conv_id ORDER BY turn, line ROWS UNBOUNDED PRECEDING)
                          - length(line) - 1) // {PIECE})::BIGINT AS piece
              FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'Customer' ELSE 'Agent' END || ': ' || text AS line
                    FROM conversations WHERE role <> 'system') l) p
        GROUP BY conv_id, piece""",
    "appended_batches": _with_tr("SELECT conv_id, CAST(1 AS BIGINT) AS n_copies, CAST(2 AS BIGINT) AS n_written FROM tr"),
    "split_turns": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn_no,
        CASE WHEN role = 'user' THEN 'Customer' ELSE 'Agent' END AS speaker, text
        FROM conversations WHERE role <> 'system'""",
    "turn_count_audit": _with_tr("SELECT conv_id, n_turns, n_turns BETWEEN 6 AND 10 AS in_range FROM tr"),
    "build_training_rows": _with_tr_fx1(
        f"""SELECT tr.conv_id, CAST(3 AS BIGINT) AS n_messages, 'system,user,assistant' AS roles,
        md5(transcript) AS user_md5, md5(gold_json) AS assistant_md5,
        true AS line_valid FROM tr JOIN fx1s ON fx1s.k = tr.conv_id"""
    ),
    "build_prompt": _with_tr(f"SELECT conv_id, {_SYS} AS system, 'Transcript:' || {NL} || transcript AS user FROM tr"),
    "chat_template": _with_tr_fx1(f"SELECT tr.conv_id, {_TRAIN} AS train_text, {_INFER} AS infer_text FROM tr JOIN fx1s ON fx1s.k = tr.conv_id"),
    "sequence_budget": _with_tr_fx1(
        f"""SELECT conv_id, n_tokens, n_tokens > 2048 AS over_budget FROM (
        SELECT tr.conv_id, CAST(len(list_filter(string_split_regex({_TRAIN}, '\\s+'), lambda x: x <> '')) AS BIGINT) AS n_tokens
        FROM tr JOIN fx1s ON fx1s.k = tr.conv_id) t"""
    ),
    "system_prompt_audit": """SELECT event_type = 'click' IS FALSE AS matches_training, count(*) AS n
        FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1""",
    "batch_extract": _with_tr(
        f"""SELECT conv_id, CASE WHEN {_K} % 13 = 0 THEN 'error' ELSE 'valid' END AS status,
        CASE WHEN {_K} % 13 <> 0 THEN {O.pick(CUSTOMER_INTENTS, f'{_K} % 10')} END AS customer_intent,
        CASE WHEN {_K} % 13 = 0 THEN 'boom ' || CAST({_K} AS VARCHAR) END AS error FROM tr"""
    ),
    "resumed_extract": _with_tr(
        f"""SELECT conv_id, CASE WHEN {_K} % 13 = 0 THEN 'error' ELSE 'valid' END AS status,
        CASE WHEN {_K} % 13 <> 0 THEN {O.pick(CUSTOMER_INTENTS, f'{_K} % 10')} END AS customer_intent,
        CAST(1 AS BIGINT) AS n_outputs FROM tr"""
    ),
    "retry_outcomes": _with_tr(
        f"""SELECT conv_id,
          CASE WHEN g >= 5 THEN 'generation_failed' WHEN e >= 5 THEN 'extraction_failed' ELSE 'ok' END AS status,
          CAST(least(g + 1, 5) AS INTEGER) AS generation_attempts,
          CAST(CASE WHEN g >= 5 THEN 0 ELSE least(e + 1, 5) END AS INTEGER) AS extraction_attempts,
          CAST(coalesce(list_sum(list_transform(range(least(g, 4) + CASE WHEN g >= 5 THEN 0 ELSE least(e, 4) END),
               lambda i: least(CAST(pow(2, i + 1) AS BIGINT), 60))), 0) AS DOUBLE) AS waited_sec
        FROM (SELECT conv_id, {_P} % 6 AS g, ({_P} // 6) % 6 AS e FROM tr) t"""
    ),
    "grounding_audit": _with_tr(
        f"""SELECT conv_id, CAST(CASE WHEN first_user_turn IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_quotes,
        CAST(CASE WHEN first_user_turn IS NOT NULL AND {_K} % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_grounded,
        (first_user_turn IS NOT NULL AND {_K} % 3 = 0) AS intent_reasoning_grounded
        FROM tr WHERE {_K} % 13 <> 0"""
    ),
    "scenario_grid": f"""WITH {_SAMPLES},
      grid AS (SELECT CAST(i // 64 AS INTEGER) AS channel_idx, CAST((i // 8) % 8 AS INTEGER) AS persona_idx,
                      CAST(i % 8 AS INTEGER) AS scenario_idx FROM range(192) t(i)),
      cnt AS (SELECT channel_idx, persona_idx, scenario_idx, count(*) AS n FROM smp GROUP BY 1, 2, 3)
      SELECT g.channel_idx, g.persona_idx, g.scenario_idx, {O.pick(CHANNELS, 'g.channel_idx')} AS channel,
        {O.pick(PERSONAS, 'g.persona_idx')} AS persona, {O.pick(SCENARIOS, 'g.scenario_idx')} AS scenario,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_samples
      FROM grid g LEFT JOIN cnt c USING (channel_idx, persona_idx, scenario_idx)""",
    "sample_scenarios": f"WITH {_SAMPLES} SELECT sample_id, channel_idx, persona_idx, scenario_idx FROM smp",
    "render_prompts": f"WITH {_SAMPLES}, {_PROMPTS} SELECT sample_id, prompt FROM prm",
    "generate_transcripts": f"""WITH {_SAMPLES}, {_PROMPTS}
      SELECT sample_id, length(prompt) % 7 <> 0 AS ok,
        CASE WHEN length(prompt) % 7 <> 0 THEN {_GEN_TEXT} END AS transcript,
        CAST(CASE WHEN length(prompt) % 7 = 0 THEN 5 ELSE 1 END AS INTEGER) AS attempts,
        CASE WHEN length(prompt) % 7 = 0 THEN 'Empty transcript returned' END AS error FROM prm""",
    "synth_pipeline_status": f"""WITH {_SAMPLES}, {_PROMPTS},
      st AS (
        SELECT CASE WHEN length(prompt) % 7 = 0 THEN 'generation_failed'
                    WHEN (12 + length({_GEN_TEXT})) % 13 = 0 THEN 'extraction_failed' ELSE 'ok' END AS status FROM prm)
      SELECT status, count(*) AS n FROM st GROUP BY 1
      UNION ALL SELECT 'appended', count(*) FILTER (WHERE status = 'ok') FROM st""",
    "roundtrip_append": _with_tr("SELECT conv_id, CAST(3 AS BIGINT) AS n_messages, CAST(2 AS BIGINT) AS n_copies FROM tr"),
}
