"""DuckDB SQL building blocks for the oracles.

The oracles never restate Spark's output: expected values are derived from
the fixture rules (integer arithmetic on keys), and where a text is needed it
is rebuilt by plain string concatenation in DuckDB.
"""

from __future__ import annotations

from ..schema import (
    CUSTOMER_INTENTS,
    DELIVERY_EXCEPTION_TYPES,
    REWORK_FREQUENCIES,
    ROOT_CAUSE_CATEGORIES,
    SENTIMENT_TRAJECTORIES,
    SYSTEM_PROMPT,
)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def arr(values: list[str]) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(values: list[str], idx: str) -> str:
    """1-based DuckDB list index of a 0-based index expression."""
    return f"({arr(values)})[({idx}) + 1]"


def btxt(e: str) -> str:
    return f"(CASE WHEN {e} THEN 'true' ELSE 'false' END)"


def s(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


TICKET = "Ticket submitted to hub"


def record_columns(k: str, st: str) -> str:
    """Gold and predicted leaf values for key ``k`` with order status ``st``."""
    shifts = ",\n".join(f"(({k} + {3 * f}) % {11 + f} = 0) AS s{f}" for f in range(11))
    return f"""
    {k} AS k, {st} AS st, {k} % 20 AS r,
    {shifts},
    {k} % 10 AS g_intent, 1 + ({k} // 10) % 5 AS g_effort, ({k} // 3) % 3 AS g_traj,
    ({k} // 7) % 3 AS g_rework, ({k} // 2) % 3 AS g_exc, ({k} // 4) % 6 AS g_cause,
    ({k} % 10 = 3) AS g_addr, (({k} // 2) % 3 = 0) AS g_missed, (({k} // 10) % 5 = 4) AS g_esc,
    ({st} = 'F') AS g_conf,
    CASE WHEN {st} = 'F' THEN 'N/A' WHEN {st} = 'O' AND {k} % 2 = 0 THEN ' n/a ' ELSE {lit(TICKET)} END AS g_steps"""


PRED_COLUMNS = f"""
    CASE WHEN s0 THEN (g_intent + 1) % 10 ELSE g_intent END AS p_intent,
    CASE WHEN s1 THEN g_effort % 5 + 1 ELSE g_effort END AS p_effort,
    CASE WHEN s2 THEN (g_traj + 1) % 3 ELSE g_traj END AS p_traj,
    CASE WHEN s3 THEN (g_rework + 1) % 3 ELSE g_rework END AS p_rework,
    CASE WHEN s4 THEN (g_exc + 1) % 3 ELSE g_exc END AS p_exc,
    CASE WHEN s5 THEN (g_cause + 1) % 6 ELSE g_cause END AS p_cause,
    (g_addr <> s6) AS p_addr, (g_missed <> s7) AS p_missed, (g_esc <> s8) AS p_esc, (g_conf <> s9) AS p_conf,
    CASE WHEN s10 THEN (CASE WHEN upper(trim(g_steps)) = 'N/A' THEN {lit(TICKET)} ELSE 'N/A' END)
         ELSE g_steps END AS p_steps"""


def quotes_json(k: str) -> str:
    return (
        f"'[' || array_to_string(list_transform(range({k} % 4), "
        f"lambda i: '\"quote ' || {s(k)} || '-' || CAST(i AS VARCHAR) || '\"'), ',') || ']'"
    )


def payload_json(pre: str, k: str = "k", drop_defaulted: str = "false", drop_diag: str = "false") -> str:
    """JSON text of the record with leaf values ``<pre>_*`` (compact, field order, no nulls)."""
    beh = (
        "'{\"effort_and_friction_quotes\":' || " + quotes_json(k)
        + " || ',\"customer_intent\":\"' || " + pick(CUSTOMER_INTENTS, f"{pre}_intent")
        + " || '\",\"customer_effort_score\":' || " + s(f"{pre}_effort")
        + " || ',\"sentiment_trajectory\":\"' || " + pick(SENTIMENT_TRAJECTORIES, f"{pre}_traj")
        + " || '\",\"rework_frequency\":\"' || " + pick(REWORK_FREQUENCIES, f"{pre}_rework")
        + " || '\"}'"
    )
    cause_part = (
        "',\"root_cause_category\":\"' || " + pick(ROOT_CAUSE_CATEGORIES, f"{pre}_cause") + " || '\"'"
    )
    esc_part = "',\"escalation_requested\":' || " + btxt(f"{pre}_esc")
    op = (
        "'{\"exception_diagnostic_reasoning\":\"exception_diagnostic_reasoning ' || " + s(k)
        + " || '\",\"delivery_exception_type\":\"' || " + pick(DELIVERY_EXCEPTION_TYPES, f"{pre}_exc")
        + " || '\"' || "
        + f"(CASE WHEN {drop_defaulted} THEN '' ELSE {cause_part} END)"
        + " || ',\"address_change_requested\":' || " + btxt(f"{pre}_addr")
        + " || ',\"missed_delivery_explicitly_mentioned\":' || " + btxt(f"{pre}_missed")
        + " || " + f"(CASE WHEN {drop_defaulted} THEN '' ELSE {esc_part} END)"
        + " || ',\"agent_explicitly_confirmed_resolution\":' || " + btxt(f"{pre}_conf")
        + " || ',\"unresolved_next_steps\":\"' || " + f"{pre}_steps" + " || '\"}'"
    )
    diag = (
        "'{\"recommended_routing_queue\":\"' || (CASE WHEN g_effort >= 4 THEN 'Tier 2 Support' ELSE 'Tier 1 Support' END)"
        + " || '\",\"intent_reasoning\":\"intent_reasoning ' || " + s(k)
        + " || '\",\"exception_reasoning\":\"exception_reasoning ' || " + s(k)
        + " || '\",\"effort_reasoning\":\"effort_reasoning ' || " + s(k) + " || '\"}'"
    )
    return (
        "'{\"behavioral_analytics\":' || " + beh
        + " || ',\"operational_analytics\":' || " + op
        + f" || (CASE WHEN {drop_diag} THEN '' ELSE ',\"diagnostic_reasoning\":' || " + diag + " END)"
        + " || '}'"
    )


def reply_sql() -> str:
    return """CASE
      WHEN r IN (12, 13) THEN '```json' || chr(10) || pred_json || chr(10) || '```'
      WHEN r = 14 THEN 'Here is the extraction:' || chr(10) || '```' || chr(10) || pred_json || chr(10) || '```' || chr(10) || 'Anything else?'
      WHEN r = 16 THEN regexp_replace(pred_json, '"customer_effort_score":[0-9]+', '"customer_effort_score":"4"')
      WHEN r = 17 THEN regexp_replace(pred_json, '"customer_effort_score":[0-9]+', '"customer_effort_score":9')
      WHEN r = 19 THEN (CASE WHEN (k // 20) % 2 = 0 THEN pred_json || ' trailing text' ELSE left(pred_json, 40) END)
      ELSE pred_json END"""


def fx1_ctes(source: str = "SELECT o_orderkey AS kk, o_orderstatus AS ss FROM orders") -> str:
    """CTEs ``fx1_base`` -> ``fx1`` with gold/pred values, texts, status and matches."""
    return f"""
fx1_src AS ({source}),
fx1_a AS (SELECT {record_columns('kk', 'ss')} FROM fx1_src),
fx1_b AS (SELECT *, {PRED_COLUMNS} FROM fx1_a),
fx1_c AS (
  SELECT *,
    {payload_json('g')} AS gold_json,
    {payload_json('p', drop_defaulted='r = 15', drop_diag='r = 18')} AS pred_json,
    CASE WHEN r = 19 THEN 'error' WHEN r IN (17, 18) THEN 'raw' ELSE 'valid' END AS status,
    15000 + (k * 37) % 30000 AS latency_ms,
    -- effective predicted values (coercion and defaults on valid rows, raw as-is)
    CASE WHEN r = 16 THEN 4 WHEN r = 17 THEN 9 ELSE p_effort END AS e_effort,
    CASE WHEN r = 15 THEN 5 ELSE p_cause END AS e_cause,
    CASE WHEN r = 15 THEN false ELSE p_esc END AS e_esc
  FROM fx1_b),
fx1 AS (
  SELECT *, {reply_sql()} AS reply,
    CASE WHEN r <> 19 THEN NOT s0 END AS match_customer_intent,
    CASE WHEN r <> 19 THEN e_effort = g_effort END AS match_customer_effort_score,
    CASE WHEN r <> 19 THEN NOT s2 END AS match_sentiment_trajectory,
    CASE WHEN r <> 19 THEN NOT s3 END AS match_rework_frequency,
    CASE WHEN r <> 19 THEN NOT s4 END AS match_delivery_exception_type,
    CASE WHEN r <> 19 THEN e_cause = g_cause END AS match_root_cause_category,
    CASE WHEN r <> 19 THEN NOT s6 END AS match_address_change_requested,
    CASE WHEN r <> 19 THEN NOT s7 END AS match_missed_delivery_explicitly_mentioned,
    CASE WHEN r <> 19 THEN e_esc = g_esc END AS match_escalation_requested,
    CASE WHEN r <> 19 THEN NOT s9 END AS match_agent_explicitly_confirmed_resolution,
    CASE WHEN r <> 19 THEN NOT s10 END AS match_unresolved_next_steps
  FROM fx1_c),
fx1s AS (
  SELECT *, CASE WHEN r <> 19 THEN (match_customer_intent AND match_customer_effort_score
      AND match_sentiment_trajectory AND match_rework_frequency AND match_delivery_exception_type
      AND match_root_cause_category AND match_address_change_requested
      AND match_missed_delivery_explicitly_mentioned AND match_escalation_requested
      AND match_agent_explicitly_confirmed_resolution AND match_unresolved_next_steps) END AS strict
  FROM fx1)"""


def with_fx1(select: str, source: str | None = None) -> str:
    ctes = fx1_ctes(source) if source else fx1_ctes()
    return f"WITH {ctes}\n{select}"


SYSTEM_PROMPT_SQL = lit(SYSTEM_PROMPT)
