import os
import tempfile

from pyspark.sql import functions as F

from convometrics.operators import repair as rp
from convometrics.sources import chatml

from conftest import rows

GOOD = '{"messages":[{"role":"system","content":"s"},{"role":"user","content":"hi"},{"role":"assistant","content":"{\\"behavioral_analytics\\":{},\\"operational_analytics\\":{},\\"diagnostic_reasoning\\":{}}"}]}'


def test_line_numbers_across_many_splits(spark):
    d = tempfile.mkdtemp(prefix="lines-")
    lines = [GOOD if i % 7 else "" for i in range(4000)]
    lines[10] = "{bad"
    with open(os.path.join(d, "a.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = chatml.read_lines(spark, d)
        assert got.rdd.getNumPartitions() > 3
        by_num = {r["line_num"]: r["value"] for r in rows(got)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert by_num == {i + 1: v for i, v in enumerate(lines)}


def _many_files(spark):
    """A corpus in which tasks read several small files, and files are read by several tasks: (folder, {file: lines})."""
    d = tempfile.mkdtemp(prefix="many-")
    want = {}
    for f in range(12):
        lines = [f"{f}-{i}" if (i + f) % 5 else "" for i in range([3, 900, 40, 1][f % 4])]
        with open(os.path.join(d, f"f{f}.jsonl"), "w") as out:
            out.write("\n".join(lines) + "\n")
        want[f"f{f}.jsonl"] = {i + 1: v for i, v in enumerate(lines)}
    return d, want


def _numbered(df):
    found = {}
    for r in rows(df):
        found.setdefault(os.path.basename(r["file_path"]), {})[r["line_num"]] = r["value"]
    return found


def test_line_numbers_of_many_files_by_either_way(spark):
    d, want = _many_files(spark)
    for split, cost in (("2000", "0"), ("2000", "100"), ("1000000", "10")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        try:
            assert _numbered(chatml.read_lines(spark, d)) == want
            assert _numbered(chatml.read_lines(spark, d, max_splits=0)) == want
        finally:
            for c in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
                spark.conf.unset(f"spark.sql.files.{c}")


def test_the_text_is_scanned_once_and_not_shuffled(spark):
    d, _ = _many_files(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a corpus of any size
    try:
        plan = chatml.read_lines(spark, d)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("FileScan text") == 1 and "SortMergeJoin" not in plan
    text_side = plan[: plan.index("FileScan text")]
    assert "Exchange" not in text_side.replace("BroadcastExchange", "")


def test_files_split_anew_stop_the_job(spark):
    d, _ = _many_files(spark)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = chatml.read_lines(spark, d)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        try:
            df.collect()
            raise AssertionError("expected failure")
        except Exception as e:  # noqa: BLE001
            assert chatml.LAYOUT_CHANGED in str(e)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quarantine_and_failfast(spark):
    d = tempfile.mkdtemp(prefix="q-")
    with open(os.path.join(d, "a.jsonl"), "w") as f:
        f.write(GOOD + "\n\n" + '{"messages":[1,2]}' + "\n" + "[1]\n" + "nope\n")
    good, bad = chatml.read_chatml(spark, d)
    assert [r["line_num"] for r in rows(good)] == [1]
    assert {r["line_num"]: r["reason"] for r in rows(bad)} == {3: "too_few_messages", 4: "not_object", 5: "invalid_json"}
    try:
        chatml.read_chatml(spark, d, mode="failfast")
        raise AssertionError("expected failure")
    except ValueError as e:
        assert "line 3" in str(e)


def _repair(spark, lines, legacy=False):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "line_num long, value string")
    return {r["line_num"]: r["repaired"] for r in rows(rp.repair_lines(df, legacy=legacy))}


def test_repair_rules(spark):
    raw_user = '{"messages":[{"role":"system","content":"s"},{"role":"user","content":"say "hi" now"},{"role":"assistant","content":"{"a":1}"}]}'
    mixed = '{"messages":[{"role":"system","content":"s"},{"role":"user","content":"x"}, {"role": "assistant", "content": "{}"}]}'
    first_quote = '{"messages":[{"role":"system","content":"s"},{"role":"user","content":""q" x"},{"role":"assistant","content":"{}"}]}'
    out = _repair(spark, [raw_user, mixed, first_quote])
    import json

    fixed = json.loads(out[0])
    assert fixed["messages"][1]["content"] == 'say "hi" now'
    assert json.loads(fixed["messages"][2]["content"]) == {"a": 1}
    assert out[1] is None  # mixed spacing -> structure not found
    assert json.loads(out[2])["messages"][1]["content"] == '"q" x'
    legacy = _repair(spark, [first_quote], legacy=True)
    try:
        json.loads(legacy[0])
        raise AssertionError("legacy keeps the first character unescaped")
    except json.JSONDecodeError:
        pass


def test_normalize_rules(spark):
    inner = '{"behavioral_analytics":{},"operational_analytics":{},"diagnostic_reasoning":{}}'
    import json

    double = json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"},
                                      {"role": "assistant", "content": inner.replace('"', '\\"')}]})
    obj = json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"},
                                   {"role": "assistant", "content": json.loads(inner)}]})
    missing = GOOD.replace(',\\"diagnostic_reasoning\\":{}', "")
    df = spark.createDataFrame([(1, GOOD), (2, double), (3, obj), (4, missing), (5, "  ")], "line_num long, value string")
    got = {r["line_num"]: (r["outcome"], r["reason"]) for r in rows(rp.normalize_lines(df))}
    assert got == {1: ("kept", None), 2: ("rewritten", None), 3: ("dropped", "content_not_string"),
                   4: ("dropped", "missing_group"), 5: ("dropped", "blank")}
    rewritten = rows(rp.normalize_lines(df).filter("line_num = 2"))[0]["normalized"]
    assert json.loads(json.loads(rewritten)["messages"][2]["content"]) == json.loads(inner)


def test_fixture_hand_rows(spark):
    import json

    inner = '{"behavioral_analytics":{},"operational_analytics":{},"diagnostic_reasoning":{}}'
    empty_user = '{"messages":[{"role":"system","content":"s"},{"role":"user","content":""},{"role":"assistant","content":"{}"}]}'
    plain_string_inner = json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"},
                                                  {"role": "assistant", "content": json.dumps("behavioral_analytics operational_analytics diagnostic_reasoning")}]})
    # a transcript that carries a fragment of its own label and JSONL syntax
    polluted_user = 'Customer: it not come"}, {"role": "assistant", "content": "{\\"behavioral_analytics\\":{'
    polluted = json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": polluted_user},
                                        {"role": "assistant", "content": inner}]})
    # repair: empty user content stays a valid, empty string
    fixed = _repair(spark, [empty_user])[0]
    assert json.loads(fixed)["messages"][1]["content"] == ""
    df = spark.createDataFrame([(1, plain_string_inner), (2, polluted)], "line_num long, value string")
    got = {r["line_num"]: (r["outcome"], r["reason"]) for r in rows(rp.normalize_lines(df))}
    assert got[1] == ("dropped", "inner_not_object")  # the reference would do a substring test here
    assert got[2] == ("kept", None)
    tg = rows(rp.transcript_and_gold(chatml.classify_lines(df).filter("reason is null")))
    by = {r["line_num"]: r for r in tg}
    assert by[2]["transcript"] == polluted_user and by[2]["gold_ok"]
