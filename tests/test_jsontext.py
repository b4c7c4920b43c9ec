import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from convometrics.functions import jsontext as jt


def python_valid(s):
    try:
        json.loads(s)
        return True
    except Exception:
        return False


HAND = [
    '{"a":4}', '{"a":4} xyz', "{'a':4}", '[1,2]', '{"a":4}] [', '1} {"y":2', "", "  ", '"x"', "NaN",
    '{"a":1,"a":2}', '{"a":"\x01"}', "// c\n{}", '{"a":"\\q"}', "01", "1.", "-", '{"a":[1,2,]}', "true", "null",
    ' {"a": 1} ', '{"a":1}\n', '[]', '{}', '{"a":{"b":[1,{"c":null}]}}', '"\\u00e9"', '{"a":1e5}', '{"a":-0.5E-3}',
]


def test_guard_matches_json_loads_on_hand_cases(spark):
    df = spark.createDataFrame([(s,) for s in HAND], "j string")
    got = {r.j: r.v for r in df.select("j", jt.json_valid(F.col("j")).alias("v")).collect()}
    for s in HAND:
        assert got[s] == python_valid(s), s


def _mutate(rng, s):
    chars = list(s)
    for _ in range(rng.randint(1, 3)):
        op = rng.random()
        pos = rng.randint(0, len(chars))
        if op < 0.4 and chars:
            del chars[min(pos, len(chars) - 1)]
        elif op < 0.8:
            chars.insert(pos, rng.choice(list('{}[]",:01 aetn\\.')))
        else:
            chars.append(rng.choice([" x", "]", "}", ",", "1"]))
    return "".join(chars)


def test_guard_matches_json_loads_on_mutations(spark):
    rng = random.Random(7)
    seeds = ['{"a":[1,2,{"b":"c"}],"d":true}', '[1,"x",null]', '{"k":"v w","n":-1.5e3}', '"text"', "123"]
    cases = [_mutate(rng, rng.choice(seeds)) for _ in range(3000)] + seeds
    df = spark.createDataFrame([(s,) for s in cases], "j string")
    got = df.select("j", jt.json_valid(F.col("j")).alias("v")).collect()
    bad = [(r.j, r.v) for r in got if r.v != python_valid(r.j)]
    assert not bad, bad[:10]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \t\n\r  \x1cabé")), max_size=12))
def test_ustrip_matches_python_strip(spark, s):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(jt.ustrip(F.col("s"))).first()[0] == s.strip()


def test_find_rfind_slice(spark):
    s, m = "ab\"}]}cd\"}]}e", '"}]}'
    df = spark.createDataFrame([(s,)], "s string")
    r = df.select(
        jt.find0(F.col("s"), m).alias("f"),
        jt.rfind0(F.col("s"), m).alias("rf"),
        jt.find0(F.col("s"), "zz").alias("nf"),
        jt.slice0(F.col("s"), F.lit(2), F.lit(6)).alias("sl"),
        jt.slice0(F.col("s"), F.lit(5), F.lit(3)).alias("empty"),
    ).first()
    assert (r.f, r.rf, r.nf, r.sl, r.empty) == (s.find(m), s.rfind(m), -1, s[2:6], "")


def test_canonical_typed_equality(spark):
    # Python: "4" != 4, 4 == 4.0, True == 1, None == None (absent or null)
    pairs = [('{"a":"4"}', '{"a":4}', False), ('{"a":4}', '{"a":4.0}', True), ('{"a":true}', '{"a":1}', True),
             ('{}', '{"a":null}', True), ('{"a":[1]}', '{"a":[1]}', True), ('{"a":"x"}', '{"a":"x "}', False)]
    df = spark.createDataFrame(pairs, "l string, r string, want boolean")
    c = lambda col: jt.canon(jt.vget(F.try_parse_json(F.col(col)), "a"))
    for r in df.select(c("l").eqNullSafe(c("r")).alias("eq"), "want").collect():
        assert r.eq == r.want
