"""Deterministic inputs derived from the driver tables (FIXTURES.md section 3).

The driver text carries no logistics vocabulary, so labels are computed from
keys by integer arithmetic.  Every builder is a plain DataFrame transformation
of a table, so the work grows with the table.

Fixed conventions (shared with the SQL oracles in ``plans/oracle.py``):

* ``k`` is the row key (``o_orderkey``, ``conv_id`` or ``doc_id``).
* rows without an order status take ``F``/``O``/``P`` by ``k % 3``.
* a prediction is the gold record with field ``f`` (0..10, comparison order)
  moved to its next value whenever ``(k + 3*f) % (11 + f) = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import json_escape, json_quote
from ..functions.stage import spread, stage
from ..schema import (
    CUSTOMER_INTENTS,
    DELIVERY_EXCEPTION_TYPES,
    REWORK_FREQUENCIES,
    ROOT_CAUSE_CATEGORIES,
    SCORED_FIELDS,
    SENTIMENT_TRAJECTORIES,
    SYSTEM_PROMPT,
)

TICKET = "Ticket submitted to hub"
# Lines per FX3 file: the writer lays out one file per block of doc ids.
FX3_LINES_PER_FILE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def shifted(k: Column, f: int) -> Column:
    return (k + 3 * f) % (11 + f) == 0


def status_from_key(k: Column) -> Column:
    return _pick(["F", "O", "P"], k % 3)


def _next_steps(k: Column, status: Column) -> Column:
    return (
        F.when(status == "F", F.lit("N/A"))
        .when((status == "O") & (k % 2 == 0), F.lit(" n/a "))
        .otherwise(F.lit(TICKET))
    )


def payload_struct(
    k: Column,
    status: Column,
    predicted: bool = False,
    drop_defaulted: Column | None = None,
    drop_diagnostic: Column | None = None,
) -> Column:
    """Gold record for key ``k`` (or the shifted prediction) as a struct."""

    def sh(f: int) -> Column:
        return shifted(k, f) if predicted else F.lit(False)

    def nxt(idx: Column, n: int, f: int) -> Column:
        return F.when(sh(f), (idx + 1) % n).otherwise(idx)

    effort_gold = (1 + (k / 10).cast("long") % 5).cast("int")
    effort = F.when(sh(1), effort_gold % 5 + 1).otherwise(effort_gold).cast("int")
    ki = k.cast("long")
    quotes = F.transform(
        F.sequence(F.lit(0), F.greatest((ki % 4).cast("int") - 1, F.lit(-1))),
        lambda i: F.concat(F.lit("quote "), ki.cast("string"), F.lit("-"), i.cast("string")),
    )
    quotes = F.when(ki % 4 == 0, F.array().cast("array<string>")).otherwise(quotes)
    gold_steps = _next_steps(ki, status)
    steps = F.when(
        sh(10),
        F.when(F.trim(gold_steps).isin("N/A", "n/a"), F.lit(TICKET)).otherwise(F.lit("N/A")),
    ).otherwise(gold_steps)

    def flag(cond: Column, f: int) -> Column:
        return F.when(sh(f), ~cond).otherwise(cond)

    cause = _pick(ROOT_CAUSE_CATEGORIES, nxt((ki / 4).cast("long") % 6, 6, 5))
    escalation = flag((ki / 10).cast("long") % 5 == 4, 8)
    if drop_defaulted is not None:
        cause = F.when(~drop_defaulted, cause)
        escalation = F.when(~drop_defaulted, escalation)
    behavioral = F.struct(
        quotes.alias("effort_and_friction_quotes"),
        _pick(CUSTOMER_INTENTS, nxt(ki % 10, 10, 0)).alias("customer_intent"),
        effort.alias("customer_effort_score"),
        _pick(SENTIMENT_TRAJECTORIES, nxt((ki / 3).cast("long") % 3, 3, 2)).alias("sentiment_trajectory"),
        _pick(REWORK_FREQUENCIES, nxt((ki / 7).cast("long") % 3, 3, 3)).alias("rework_frequency"),
    )
    operational = F.struct(
        F.concat(F.lit("exception_diagnostic_reasoning "), ki.cast("string")).alias(
            "exception_diagnostic_reasoning"
        ),
        _pick(DELIVERY_EXCEPTION_TYPES, nxt((ki / 2).cast("long") % 3, 3, 4)).alias("delivery_exception_type"),
        cause.alias("root_cause_category"),
        flag(ki % 10 == 3, 6).alias("address_change_requested"),
        flag((ki / 2).cast("long") % 3 == 0, 7).alias("missed_delivery_explicitly_mentioned"),
        escalation.alias("escalation_requested"),
        flag(status == "F", 9).alias("agent_explicitly_confirmed_resolution"),
        steps.alias("unresolved_next_steps"),
    )
    diagnostic = F.struct(
        F.when(effort_gold >= 4, F.lit("Tier 2 Support")).otherwise(F.lit("Tier 1 Support")).alias(
            "recommended_routing_queue"
        ),
        F.concat(F.lit("intent_reasoning "), ki.cast("string")).alias("intent_reasoning"),
        F.concat(F.lit("exception_reasoning "), ki.cast("string")).alias("exception_reasoning"),
        F.concat(F.lit("effort_reasoning "), ki.cast("string")).alias("effort_reasoning"),
    )
    if drop_diagnostic is not None:
        diagnostic = F.when(~drop_diagnostic, diagnostic)
    return F.struct(
        behavioral.alias("behavioral_analytics"),
        operational.alias("operational_analytics"),
        diagnostic.alias("diagnostic_reasoning"),
    )


def gold_json(k: Column, status: Column) -> Column:
    return F.to_json(payload_struct(k, status))


_EFFORT = r'"customer_effort_score":[0-9]+'


def predicted_json(k: Column, status: Column) -> Column:
    r = k % 20
    return F.to_json(
        payload_struct(k, status, predicted=True, drop_defaulted=(r == 15), drop_diagnostic=(r == 18))
    )


def reply_text(k: Column, pred: Column) -> Column:
    """FX1 model reply by ``k % 20`` (bare, fenced, prose-wrapped, defaults, coercion, raw, broken)."""
    r = k % 20
    return (
        F.when(r.isin(12, 13), F.concat(F.lit("```json\n"), pred, F.lit("\n```")))
        .when(r == 14, F.concat(F.lit("Here is the extraction:\n```\n"), pred, F.lit("\n```\nAnything else?")))
        .when(r == 16, F.regexp_replace(pred, _EFFORT, '"customer_effort_score":"4"'))
        .when(r == 17, F.regexp_replace(pred, _EFFORT, '"customer_effort_score":9'))
        .when(
            r == 19,
            F.when((k / 20).cast("long") % 2 == 0, F.concat(pred, F.lit(" trailing text"))).otherwise(
                F.substring(pred, 1, 40)
            ),
        )
        .otherwise(pred)
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"))
    return spread(keys, int(spark.conf.get("spark.sql.shuffle.partitions")))  # two short columns; texts are built after


def latency_ms(k: Column) -> Column:
    return F.lit(15000) + (k * 37) % 30000


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold side of FX1: ``k, gold_json`` -- one row per order."""
    o = _orders(spark, sf_dir)
    return o.select("k", gold_json(F.col("k"), F.col("st")).alias("gold_json"))


def prediction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction side of FX1: ``k, reply, latency_ms`` -- one model reply per order."""
    o = _orders(spark, sf_dir)
    base = stage(o.select("k", predicted_json(F.col("k"), F.col("st")).alias("pred_json")))
    return base.select("k", reply_text(F.col("k"), F.col("pred_json")).alias("reply"), latency_ms(F.col("k")).alias("latency_ms"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1: ``k, gold_json, reply, latency_ms`` -- gold and reply of each order side by side."""
    o = _orders(spark, sf_dir)
    base = stage(
        o.select(
            "k",
            gold_json(F.col("k"), F.col("st")).alias("gold_json"),
            predicted_json(F.col("k"), F.col("st")).alias("pred_json"),
        )
    )
    return base.select(
        "k", "gold_json", reply_text(F.col("k"), F.col("pred_json")).alias("reply"), latency_ms(F.col("k")).alias("latency_ms")
    )


# ---------------------------------------------------------------------------
# FX2 transcripts
# ---------------------------------------------------------------------------

SPEAKER = {"user": "Customer", "assistant": "Agent"}


def speaker_label(role: Column) -> Column:
    return F.when(role == "user", F.lit("Customer")).when(role == "assistant", F.lit("Agent"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-system turns: ``conv_id, turn, speaker, text``."""
    c = table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") != "system").select(
        "conv_id", "turn", speaker_label(F.col("role")).alias("speaker"), "text"
    )


# ---------------------------------------------------------------------------
# FX3 ChatML lines
# ---------------------------------------------------------------------------


def _compact(sys_lit: Column, user_lit: Column, asst_lit: Column | None) -> Column:
    parts = [
        F.lit('{"messages":[{"role":"system","content":'),
        sys_lit,
        F.lit('},{"role":"user","content":'),
        user_lit,
    ]
    if asst_lit is not None:
        parts += [F.lit('},{"role":"assistant","content":'), asst_lit]
    parts.append(F.lit("}]}"))
    return F.concat(*parts)


def chatml_line(k: Column, text: Column) -> Column:
    """FX3 line for document ``k`` (type by ``k % 9``); the whole text is the user turn."""
    user = F.regexp_replace(text, r"[\n\t\r]", " ")
    status = status_from_key(k)
    gold = gold_json(k, status)
    gold_no_diag = F.to_json(payload_struct(k, status, drop_diagnostic=F.lit(True)))
    sys_q = F.lit('"' + SYSTEM_PROMPT + '"')
    user_q = json_quote(user)
    raw = lambda c: F.concat(F.lit('"'), c, F.lit('"'))  # noqa: E731  (unescaped value)
    quoted_word = F.regexp_replace(user, r"^(\S+)", '"$1"')
    t = k % 9
    return (
        F.when(t == 0, _compact(sys_q, user_q, json_quote(gold)))
        .when(t == 1, _compact(sys_q, raw(quoted_word), json_quote(gold)))
        .when(t == 2, _compact(sys_q, user_q, raw(gold)))
        .when(
            t == 3,
            F.concat(
                F.lit('{"messages": [{"role": "system", "content": '),
                sys_q,
                F.lit('}, {"role": "user", "content": '),
                user_q,
                F.lit('}, {"role": "assistant", "content": "'),
                gold,
                F.lit('"}]}'),
            ),
        )
        .when(
            t == 4,
            F.concat(
                F.lit('{"messages":[{"role":"system","content":'),
                sys_q,
                F.lit('},{"role":"user","content":'),
                user_q,
                F.lit('}, {"role": "assistant", "content": "'),
                gold,
                F.lit('"}]}'),
            ),
        )
        .when(t == 5, _compact(sys_q, user_q, json_quote(json_escape(gold))))
        .when(t == 6, _compact(sys_q, user_q, json_quote(gold_no_diag)))
        .when(t == 7, _compact(sys_q, user_q, None))
        .otherwise(F.lit(""))
    )


def chatml_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part, k, line`` -- ``part`` is the file a line goes to (``k / FX3_LINES_PER_FILE``)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    return d.select(
        (k / FX3_LINES_PER_FILE).cast("long").alias("part"),
        k.alias("k"),
        chatml_line(k, F.col("text")).alias("line"),
    )


def write_chatml_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write FX3 as text files: directory ``part=<n>`` holds one file, lines in ``k`` order.

    Each block is written by one task; blocks are independent, so the writer
    scales with the number of blocks.
    """
    lines = chatml_lines(spark, sf_dir)
    (
        lines.repartition("part")
        .sortWithinPartitions("part", "k")
        .select("part", "line")
        .write.mode("overwrite")
        .partitionBy("part")
        .text(path)
    )
    return path


# ---------------------------------------------------------------------------
# FX4 requests
# ---------------------------------------------------------------------------


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``request_id, body``: one raw request body per event (body may be broken JSON)."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    i = F.col("event_id").cast("string")
    base = F.concat(F.lit('{"transcript":"Agent: hi '), i, F.lit('"'))
    et = F.col("event_type")
    body = (
        F.when(et == "view", F.concat(base, F.lit("}")))
        .when(et == "click", F.concat(base, F.lit(',"system_prompt":" P'), i, F.lit(' "}')))
        .when(et == "purchase", F.concat(base, F.lit(',"system_prompt":null}')))
        .when(et == "signup", F.lit('{"transcript":"  "}'))
        .otherwise(F.lit('{"transcript":'))
    )
    return e.select(F.col("event_id").alias("request_id"), body.alias("body"))


# ---------------------------------------------------------------------------
# FX5 CRM
# ---------------------------------------------------------------------------


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined to their customer: ``k, c_mktsegment, o_orderpriority, o_orderdate``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("k"), "c_mktsegment", "o_orderpriority", "o_orderdate"
    )


SCORED = SCORED_FIELDS
