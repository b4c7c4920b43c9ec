"""Personal data: base spans against Python's re, and what the contexts add."""

import hashlib
import random
import re

from convometrics.llm import pii_bootstrap

SCHEMA = "doc_id long, text string, n_email long"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def ok(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


def check(spark, texts):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in pii_bootstrap.personal_data(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = brute(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (i, t[:80] if t else t, got[i]["spans"][:200], joined[:200])
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(b[0] == k for b in base) for k in BASE]
        assert set(joined.split(",")) - {""} <= set(got[i]["spans"].split(","))
    return got


def test_base_spans(spark):
    texts = [
        None, "", "no digits", "a@b", "a@b.c%d@e.f x", "á@b.co é.x@ñ.com ok.me@host-1.example.org.",
        "1.2.3.4.5.6.7.8 256.1.1.1 010.000.255.1 1.2.3 99999999999999999999.1.1.1", "4111 1111 1111 1111, 4111-1111-1111-1112",
        "+1 (555) 010-9999 +12 +(1) 22222222 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "😀 a.b@c.d 😀 10.0.0.1", "4" * 40, "x" * 30000 + "@y.z",
        "a.b@c.d\n" * 700, "@" * 500, "1." * 3000, "+1 " + " " * 3000 + "end", "7" * 20000 + " 4111111111111111",
    ]
    rnd = random.Random(5)
    texts += ["".join(rnd.choice("a1 .@+-()4%é\n") for _ in range(rnd.randint(1, 200))) for _ in range(1500)]
    check(spark, texts)


def test_contexts_discover(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    texts = [f"{word()} {word()} please write to me{i}@mail.example.com about {word()}" for i in range(20)]
    texts += [f"{word()} {word()} please write to user{i}2345(at)mail about {word()}" for i in range(3)]
    texts += [f"{word()} {word()} version {rnd.randint(1000, 9999)} of {word()}" for i in range(20)]
    got = check(spark, texts)
    for i in range(20, 23):
        start = texts[i].index("user")
        assert got[i]["spans"] == f"email:{start}:{texts[i].index(' about')}"
    assert all(got[i]["spans"] == "" for i in range(23, 43))


def test_long_neighbours_and_repeated_ids(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    far = "contact" + "x" * 90  # longer than any window of characters
    texts = [f"{word()} {word()} {far} at me{i}@mail.example.com {word()}" for i in range(20)]
    texts += [f"{word()} {'y' * 90}{far} at number{rnd.randint(10000, 99999)} {word()}" for i in range(6)]  # another word that ends alike
    texts += [f"{word()} {far} at user12345(at)mail {word()}"]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(26, "hi", 0), (None, texts[26], 0), (26, None, 0)]
    got = pii_bootstrap.personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    start = texts[26].index("user")
    want = f"email:{start}:{start + len('user12345(at)mail')}"
    assert sorted(r["spans"] for r in got if r["doc_id"] == 26) == ["", "", want]
    assert [r["spans"] for r in got if r["doc_id"] is None] == [want]
    assert all(r["spans"] == "" for r in got if r["doc_id"] in range(20, 26))


def test_empty_table(spark):
    assert pii_bootstrap.personal_data(spark.createDataFrame([], SCHEMA)).count() == 0
