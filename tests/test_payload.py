import json

from pydantic import Field, create_model
from pyspark.sql import functions as F

from convometrics.operators import evaluate as ev
from convometrics.operators import payload as pl
from convometrics.schema import FIELD_RULES, GROUPS
from convometrics.sources.fixture_models import record_for_key

from conftest import rows


def _pydantic_model():
    """A pydantic model built from the field-rule table (lax mode), as an independent checker."""
    from enum import Enum
    from typing import List

    groups = {}
    for g in GROUPS:
        fields = {}
        for r in FIELD_RULES:
            if r.group != g:
                continue
            if r.kind == "enum":
                tp = Enum(r.name, {f"v{i}": v for i, v in enumerate(r.vocab)}, type=str)
            else:
                tp = {"str": str, "int": int, "bool": bool, "str_list": List[str]}[r.kind]
            kw = {}
            if r.lo is not None:
                kw = {"ge": r.lo, "le": r.hi}
            default = ... if r.required else (tp(r.default) if r.kind == "enum" else r.default)
            fields[r.name] = (tp, Field(default, **kw))
        groups[g] = (create_model(g, **fields), ...)
    return create_model("Record", **groups)


MODEL = _pydantic_model()


def _variants():
    base = record_for_key(7, ["q"], "r")
    out = []
    for eff in [4, "4", " 4 ", 4.0, True, 4.5, "x", None, "4.0", 9, 0, "+3"]:
        d = json.loads(json.dumps(base))
        d["behavioral_analytics"]["customer_effort_score"] = eff
        out.append(d)
    for b in [True, 0, 1, 2, "yes", "no", "TRUE", " true", None, 1.0]:
        d = json.loads(json.dumps(base))
        d["operational_analytics"]["escalation_requested"] = b
        out.append(d)
    d = json.loads(json.dumps(base)); del d["operational_analytics"]["root_cause_category"]; out.append(d)
    d = json.loads(json.dumps(base)); d["operational_analytics"]["root_cause_category"] = None; out.append(d)
    d = json.loads(json.dumps(base)); del d["diagnostic_reasoning"]; out.append(d)
    d = json.loads(json.dumps(base)); d["behavioral_analytics"]["customer_intent"] = "WISMO"; out.append(d)
    d = json.loads(json.dumps(base)); d["behavioral_analytics"]["effort_and_friction_quotes"] = [1]; out.append(d)
    d = json.loads(json.dumps(base)); d["extra"] = 1; out.append(d)
    return out


def test_validation_matches_pydantic(spark):
    cases = _variants()
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "k long, reply string")
    got = {r["k"]: r for r in rows(ev.prepare_predictions(df).select("k", "status", "metrics"))}
    for i, c in enumerate(cases):
        try:
            m = MODEL.model_validate(c).model_dump(mode="json")
            want = "valid"
        except Exception:
            m, want = None, "raw"
        assert got[i]["status"] == want, (i, c, got[i])
        if m is not None:
            assert got[i]["metrics"]["behavioral_analytics"]["customer_effort_score"] == m["behavioral_analytics"]["customer_effort_score"]
            assert got[i]["metrics"]["operational_analytics"]["escalation_requested"] == m["operational_analytics"]["escalation_requested"]
            assert got[i]["metrics"]["operational_analytics"]["root_cause_category"] == m["operational_analytics"]["root_cause_category"]


def test_unfence_rules(spark):
    cases = [
        ("```json\n{\"a\":1}\n```", '{"a":1}'),
        ("pre ```\n{\"a\":1}\n``` post", '{"a":1}'),
        ("```JSON\n{\"a\":1}\n```", 'JSON\n{"a":1}'),
        ("```json {\"a\":1}", "```json {\"a\":1}"),
        ("  {\"a\":1}  ", '{"a":1}'),
        ("```json\n```", ""),
    ]
    df = spark.createDataFrame(cases, "reply string, want string")
    for r in df.select(pl.unfence(F.col("reply")).alias("got"), "want").collect():
        assert r.got == r.want


def test_parse_states_and_error_text(spark):
    df = spark.createDataFrame([(1, '{"a":1} trailing'), (2, "[1,2]"), (3, "x" * 600)], "k long, reply string")
    got = {r["k"]: r for r in rows(ev.prepare_predictions(df).select("k", "status", "error", "violations"))}
    assert got[1]["status"] == "error" and got[1]["error"].startswith(pl.PARSE_ERROR_PREFIX)
    assert got[2]["status"] == "raw" and got[2]["violations"] == ["root:type"]
    assert got[3]["error"] == pl.PARSE_ERROR_PREFIX + "x" * 500 + "..."


def test_defaults_only_on_valid_predictions(spark):
    """Gold lacking escalation_requested vs a valid prediction lacking it: None != False -> mismatch."""
    gold = record_for_key(10, [], "r")
    del gold["operational_analytics"]["escalation_requested"]
    pred = json.loads(json.dumps(gold))
    g = spark.createDataFrame([(1, json.dumps(gold))], "k long, gold_json string")
    p = spark.createDataFrame([(1, json.dumps(pred), 10)], "k long, reply string, latency_ms long")
    r = rows(ev.evaluate(g, p))[0]
    assert r["status"] == "valid"
    assert r["match_escalation_requested"] is False
    assert r["match_customer_intent"] is True


def test_resolved_class_matches_python(spark):
    import random

    rng = random.Random(3)
    alphabet = list("nNaA/ \t xßŉǆ")
    cases = ["", "N/A", " n/a ", "na", "NA ", "n /a", "N/A.", "  ", "Ticket"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 5))) for _ in range(400)
    ]

    def py(s):
        if not s:
            return "N/A"
        return "N/A" if s.strip().upper() in ("N/A", "NA") else "PENDING"

    df = spark.createDataFrame([(s,) for s in cases], "s string")
    got = df.select("s", pl.normalize_resolved_text(F.col("s")).alias("c")).collect()
    assert [r.c for r in got] == [py(s) for s in cases]


def test_unfence_matches_python_regex(spark):
    import random
    import re

    def py(raw):
        raw = raw.strip()
        m = re.search(r"```(?:json)?\s*([\s\S]*?)```", raw)
        return m.group(1).strip() if m else raw

    rng = random.Random(11)
    pieces = ["`", "```", "json", "JSON", " ", "\n", "x", "{}", "js", " ", "````"]
    cases = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, reply string")
    got = {r.i: r.b for r in df.select("i", pl.unfence(F.col("reply")).alias("b")).collect()}
    bad = [(c, got[i], py(c)) for i, c in enumerate(cases) if got[i] != py(c)]
    assert not bad, bad[:5]
