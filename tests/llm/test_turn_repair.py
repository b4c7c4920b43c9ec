"""Conversation repair against a search over whole edit strings."""

import hashlib
import random
import re
import zlib

from convometrics.llm import turn_repair as tr

SCHEMA = "conv_id long, turn long, role string, text string, gaps string, audit int"
WHOLE = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\v\f\r"


def faults(rows):
    """[(role, text, must go, truncated)] of ordered (role, text) and the count of each fault."""
    seen, out, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        said = text.strip(SPACE)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        out.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    return out, count


def plain(rows):
    """(cost, audit, repaired rows): every prefix of initials keeps its least (cost, audit), with whole strings."""
    rows, _ = faults(rows)
    best = {"": (0, "", [])}

    def offer(into, key, value):
        if key not in into or value[:2] < into[key][:2]:
            into[key] = value

    def with_inserts(held):
        held = dict(held)
        for _ in range(3):
            for key, (cost, audit, kept) in list(held.items()):
                for role in ("user", "assistant"):
                    to = (key + role[0])[-1:] if allowed(key, role[0]) else None
                    if to:
                        offer(held, to, (cost + 2, audit + "I", kept + [(role, "")]))
        return held

    def allowed(last, initial):
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[last]

    for role, text, must_go, truncated in rows:
        held, best = with_inserts(best), {}
        for key, (cost, audit, kept) in held.items():
            offer(best, key, (cost + 3, audit + "D", kept))
            if must_go:
                continue
            if role[:1] and allowed(key, role[0]):
                offer(best, role[0], (cost + truncated, audit + "K", kept + [(role, text)]))
            for new in ("user", "assistant"):
                if allowed(key, new[0]):
                    offer(best, new[0], (cost + 2 + truncated, audit + "R", kept + [(new, text)]))
    held = with_inserts(best)
    return min((held[k] for k in ("", "a") if k in held), key=lambda x: x[:2])


def search(rows, limit=4):
    """The same by trying every edit string with at most ``limit`` inserts: no states at all."""
    rows, _ = faults(rows)
    found = []

    def go(i, cost, audit, initials, inserts):
        if i == len(rows) and WHOLE.fullmatch(initials):
            found.append((cost, audit))
        if inserts < limit and not initials.endswith("uu") and WHOLE.fullmatch(initials + "a") or WHOLE.fullmatch(initials + "ua"):
            if inserts < limit:
                for x in "ua":
                    if WHOLE.fullmatch(initials + x) or WHOLE.fullmatch(initials + x + "a"):
                        go(i, cost + 2, audit + "I", initials + x, inserts + 1)
        if i < len(rows):
            role, _, must_go, truncated = rows[i]
            go(i + 1, cost + 3, audit + "D", initials, inserts)
            if not must_go:
                for x, price, edit in [(role[:1], 0, "K"), ("u", 2, "R"), ("a", 2, "R")]:
                    to = initials + x
                    if x and x in "sua" and (WHOLE.fullmatch(to) or WHOLE.fullmatch(to + "a") or WHOLE.fullmatch(to + "ua")):
                        go(i + 1, cost + price + truncated, audit + edit, to, inserts)

    go(0, 0, "", "", 0)
    return min(found)


def decode(rows):
    marked, _ = faults(rows)
    decoder, out = tr.Decoder(), []
    for i, (role, text, must_go, truncated) in enumerate(marked):
        out += decoder.push(role, text, i, must_go, truncated)
    out += decoder.finish()
    return decoder.cost, "".join(e for e, _ in out), [r[:2] for _, r in out if r is not None]


def conversation(rnd, n, roles=("user", "assistant", "system", "tool", "")):
    texts = ["Yes.", "No!", "Cut off", " ", "", "Why? \n", "End. "]
    return [(rnd.choice(roles), rnd.choice(texts) + rnd.choice(["", str(rnd.randrange(50)) + "."])) for _ in range(n)]


def test_decoder_against_whole_strings():
    rnd = random.Random(1)
    for _ in range(1500):
        rows = conversation(rnd, rnd.randrange(0, 40))
        assert decode(rows) == plain(rows)
    for _ in range(300):
        rows = conversation(rnd, rnd.randrange(0, 60), ("system", "user"))
        assert decode(rows) == plain(rows)


def test_whole_strings_against_all_edits():
    rnd = random.Random(2)
    for _ in range(60):
        rows = conversation(rnd, rnd.randrange(0, 5))
        assert plain(rows)[:2] == search(rows)


def test_ties_that_stay_open_to_the_end():
    for n in (2000, 2001):
        rows = [("system", f"{i}.") for i in range(n)]
        assert decode(rows) == plain(rows)


def test_what_is_decided_leaves_the_tree():
    decoder, largest, emitted = tr.Decoder(), 0, 0
    rnd = random.Random(3)
    for i in range(30000):
        role = ("user", "assistant")[i % 2] if rnd.random() < 0.9 else "system"
        emitted += len(list(decoder.push(role, f"{i}.", i, rnd.random() < 0.02, rnd.random() < 0.1)))
        largest = max(largest, decoder.tree.size)
    assert largest < 200 and emitted > 29000
    list(decoder.finish())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def want(rows, damage):
    """{conv_id: audit row} of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            fate = zlib.crc32(key.encode()) % 20 if damage else -1
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            mine += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        said = [r[1:] for r in mine]
        turns = {t for t, _, _ in mine if t is not None}
        initials = [r[:1] for r, _ in said]
        cost, audit, kept = plain(said)
        out[conv] = {
            "conv_id": conv,
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            **faults(said)[1],
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        }
    return out


def table(seed):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, -3, *range(60)]:
        for turn in range(rnd.randrange(1, 12)):
            role, text = conversation(rnd, 1)[0]
            rows.append((conv, rnd.choice([turn, turn, turn + 3, None]), rnd.choice([role, role, None]), rnd.choice([text, text, None])))
    rows += [(99, t, rnd.choice(["user", "assistant"]), f"{t}.") for t in range(800)]  # most rows are one conversation's
    rows += [(98, 0, "user", "long " * 50000 + ".")] + rows[:40]
    return rows


def test_tables_against_brute_force(spark):
    rows = table(4)
    for damage in (True, False):
        df = frame(spark, rows)
        got = {r["conv_id"]: r.asDict() for r in tr.audits(tr.damaged(df) if damage else df).collect()}
        assert got == want(rows, damage)


def test_repaired_turns_are_what_the_digest_says(spark):
    rows = table(5)
    said = {}
    for r in sorted(tr.repaired_turns(frame(spark, rows)).collect(), key=lambda r: r["seq"]):
        said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["seq"] == len(said[r["conv_id"]]) - 1 and (r["edit"] != "I" or r["text"] == "")
    for conv, audit in want(rows, False).items():
        assert hashlib.sha256("\n".join(said.get(conv, [])).encode()).hexdigest() == audit["repaired_sha256"]


def test_empty_table(spark):
    assert tr.audits(tr.damaged(frame(spark, [(1, 1, "user", "a")]).filter("false"))).collect() == []


def test_one_shuffle(spark):
    plan = tr.audits(tr.damaged(frame(spark, table(6))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
