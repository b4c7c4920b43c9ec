"""From raw documents to packed training sequences: the stages, each one operator."""

from __future__ import annotations

from convometrics.llm import best_fit, exact_index, minhash_bayes, mix_schedule, quality_mil
from convometrics.llm.common import small_batches, stored, table
from convometrics.session import configure


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return quality_mil.accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark, docs, sf_dir):
    """One document of each group of equal texts stays."""
    return exact_index.keep_first(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays."""
    return minhash_bayes.keep_one(docs, k=5, threshold=80)


def mixing(spark, docs, sf_dir):
    """The corpus mixed to the sources' target weights: a document stands as often as it is taken."""
    return mix_schedule.mixed_documents(docs, mix_schedule.mix(docs))


def packing(spark, docs, sf_dir):
    """Pieces of documents in bins of equal capacity; copies of a document never share a bin."""
    return best_fit.pack(docs, cluster="doc_id", source_limit="share")


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# The classifier, the schedule and the packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def _prepared(stage):
    def run_stage(spark, docs, sf_dir):
        configure(spark)
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    run_stage.__name__ = stage.__name__
    run_stage.__doc__ = stage.__doc__
    return run_stage


STAGES = [(name, _prepared(stage)) for name, stage in STAGES]


def run(spark, sf_dir):
    """All stages on ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
