from pyspark.sql import functions as F

import __spark_entry__ as entry
from convometrics.plans import dialog_queries as dq
from convometrics.plans import ops_queries as oq
from convometrics.streaming import requests as rq

from conftest import SF0001, rows


def test_stream_equals_batch(spark):
    batch = {r["request_id"]: (r["error"], r["system_prompt"]) for r in rows(dq.request_table(spark, SF0001))}
    stream = {r["request_id"]: (r["error"], r["system_prompt"]) for r in rows(oq.q_stream_requests(spark, SF0001))}
    assert stream == batch


def test_request_edge_cases(spark):
    bodies = [(1, "[1]"), (2, '{"transcript": 5}'), (3, "0"), (4, '{"transcript":"x","system_prompt":7}'), (5, "{}")]
    got = {r["request_id"]: r for r in rows(rq.classify_requests(spark.createDataFrame(bodies, rq.REQUEST_SCHEMA)))}
    assert got[1]["error"] == "'list' object has no attribute 'get'"
    assert got[2]["error"] == "'int' object has no attribute 'strip'"
    assert got[3]["error"] == rq.BLANK and got[5]["error"] == rq.BLANK
    assert got[4]["accepted"] and got[4]["prompt_error"] == "'int' object has no attribute 'strip'"


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"kind", "part", "line_num", "label", "value"}
    assert {r["label"] for r in df.filter("kind = 'total'").collect()} >= {"total", "valid", "errors", "strict_correct", "customer_intent"}
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
