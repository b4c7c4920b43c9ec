"""One prompt template for columns and tasks, and a real token counter."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from convometrics.operators import messages as msg

VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.json")
TEXTS = ["Agent: hi", "  Customer: \u00e9\u4f60 <|im_end|> \n", "", "\u2003x\u00a0", "a" * 5000, "<|endoftext|> is text"]


def test_prompts_made_in_tasks_are_those_of_the_template(spark):
    for system in (None, "", "  be brief "):
        sp = None if system is None else F.lit(system)
        made = msg.chat_template(msg.extraction_messages(F.col("t"), sp), add_generation_prompt=True)
        before, after = msg.prompt_frame(spark, system)
        for r in rows(spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", made.alias("p"))):
            assert r["p"] == before + r["t"].strip() + after


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no tokenizer file")
def test_budget_by_a_tokenizer(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "id long, t string").repartition(3)
    got = {r["id"]: (r["n_tokens"], r["over_budget"]) for r in rows(msg.sequence_budget(df, "t", msg.tokenizer_counter(VOCABULARY), budget=50))}
    for i, t in enumerate(TEXTS):
        n = len(plain.encode(t, add_special_tokens=False).ids)
        assert got[i] == (n, n > 50)
    assert got[len(TEXTS)] == (None, None) and got[4][1] and got[5][0] > 1
