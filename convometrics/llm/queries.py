"""The registered queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

from convometrics.llm import best_fit, dense_search, exact_index, html_blocks, lang_mixture, minhash_bayes, mix_schedule, outlier_rules, phrase_automata, pii_bootstrap, quality_mil, range_shards, turn_repair
from convometrics.llm.common import small_batches, table


def op1_language_mixture(spark, sf_dir):
    return lang_mixture.languages(table(spark, sf_dir, "documents"))


def op2_phrase_automata(spark, sf_dir):
    found = phrase_automata.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_mix_sources(spark, sf_dir):
    return mix_schedule.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_pii_bootstrap(spark, sf_dir):
    return pii_bootstrap.personal_data(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark, sf_dir):
    return best_fit.pack(table(spark, sf_dir, "documents"), source_limit="share")


def op6_html_blocks(spark, sf_dir):
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op7_quality_mil(spark, sf_dir):
    return quality_mil.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark, sf_dir):
    return exact_index.exact_dedup(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark, sf_dir):
    return outlier_rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_minhash_bayes(spark, sf_dir):
    return minhash_bayes.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op11_dense_search(spark, sf_dir):
    found = dense_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op12_range_shards(spark, sf_dir):
    return range_shards.shard_documents(table(spark, sf_dir, "documents"))


def op13_turn_repair(spark, sf_dir):
    return turn_repair.audits(turn_repair.damaged(table(spark, sf_dir, "conversations")))


def _prepared(fn):
    def run(spark, sf_dir):
        small_batches(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    return run


def llm_queries():
    return {name: _prepared(fn) for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def llm_oracles():
    return {
        "op2_phrase_automata": phrase_automata.ORACLE,
        "op8_exact_dedup": exact_index.ORACLE,
        "op10_minhash_bayes": minhash_bayes.ORACLE,
        "op11_dense_search": dense_search.ORACLE,
        "op12_range_shards": range_shards.ORACLE,
        "op13_turn_repair": turn_repair.ORACLE,
    }
