"""Each stage of the pipeline against a plain reading of what it does."""

import itertools
import re

import corpus_pipeline
from convometrics.llm import mix_schedule, quality_mil
from convometrics.llm.common import stored, table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    columns, results, inputs = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        results[name] = docs.collect()
        assert name == "packing" or docs.columns == columns

    raw = inputs["quality_classifier"].collect()
    model = quality_mil.train(inputs["quality_classifier"], labels.filter(~quality_mil.held_out()))
    scores = {r["doc_id"]: r["score"] for r in quality_mil.score(inputs["quality_classifier"], model).collect()}
    assert {r["doc_id"] for r in results["quality_classifier"]} == {r["doc_id"] for r in raw if scores[r["doc_id"]] >= quality_mil.THRESHOLD}

    groups = {}
    for r in results["quality_classifier"]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), []).append(r["doc_id"])
    assert {r["doc_id"] for r in results["exact_dedup"]} == {min(g) for g in groups.values()}

    sets = {}
    for r in results["exact_dedup"]:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {p for ids in by_shingle.values() for p in itertools.combinations(sorted(ids), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert {r["doc_id"] for r in results["near_dedup"]} == {i for i in sets if find(i) == i}

    taken = {r["doc_id"]: r["taken"] for r in mix_schedule.mix(inputs["mixing"]).collect() if r["taken"]}
    words = {}
    for r in results["mixing"]:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"]) or r["n_chars"] is None or len(r["text"]) > 0
    assert words == taken

    packed, bins = {}, {}
    for r in results["packing"]:
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["n_words"]
        if r["bin_id"]:
            bins.setdefault(r["bin_id"], []).append(r)
    assert {k: v for k, v in packed.items() if v} == taken
    for parts in bins.values():
        assert sum(p["n_words"] for p in parts) <= 2048 and len({p["doc_id"] for p in parts}) == len(parts)


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    made = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert made.count() > 0 and "bin_id" in made.columns
