"""Exact deduplication over a persistent digest index.

The index is a Parquet table bucketed and sorted by digest.  A batch of new
documents is reduced to its distinct digests, joined to the index by a
sort-merge anti-join (the index side needs no shuffle: its buckets already lie
by digest), and what is new is appended.  DataFrame functions only.

Defined cases: a null text counts as empty, so all null and empty texts are
one group; of equal texts the smallest non-null doc_id stays (a group whose ids
are all null has a null keep_id, and its rows stay); rows that repeat a doc_id
with an equal text share one decision; an empty batch appends nothing; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convometrics.llm.common import look_up, normalised, stored
from convometrics.session import scratch_path

INDEX_SCHEMA = "digest string, keep_id bigint, n bigint"
BUCKETS = 32  # at least
DIGESTS_PER_BUCKET = 1 << 22


def buckets_for(rows: int) -> int:
    """Buckets of an index for about ``rows`` digests: a power of two, so that tasks of any corpus merge buckets of like size."""
    return max(BUCKETS, 1 << (max(rows, 1) // DIGESTS_PER_BUCKET).bit_length())


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of the whole normalised text."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.sha2(normalised().cast("binary"), 256).alias("digest"),
    )


class DigestIndex:
    """A digest index at ``path``; ``create`` starts one, ``attach`` finds one written before."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        # of the whole path: indexes whose paths end alike are different tables
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]

    def attach(self) -> DigestIndex:
        """Register the files at ``path`` as the bucketed table (an empty one if there are none).

        The number of buckets is written beside an index when it is made; one
        that is there keeps its own.
        """
        try:
            self.buckets = self.spark.read.schema("buckets int").parquet(f"{self.path}.buckets").first()["buckets"]
        except AnalysisException:  # no such path: a new index
            one = self.spark.range(1).select(F.lit(self.buckets).alias("buckets"))
            one.write.parquet(f"{self.path}.buckets")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, batch: DataFrame) -> None:
        """Add the digests of ``batch`` (doc_id, digest) that the index lacks; the smallest doc_id of the batch stays.

        ``n`` is the number of rows the digest had in the batch that brought it in.
        """
        distinct = batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        new = distinct.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        # written before it is appended: the table being read may not be the one written to
        (
            stored(new, "new-digests")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .option("path", self.path)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)


def decide(keyed: DataFrame, index: DataFrame) -> DataFrame:
    """Each row of ``keyed`` (doc_id, digest) with keep_id and group_size.

    ``index``: (digest, keep_id), one row per digest; digests it lacks are left
    out.  A hot digest is looked up by broadcast, the rest by a join on the
    digest, in which no digest has more than a thousandth of the rows.
    """
    groups = keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    known = stored(groups.join(index.select("digest", "keep_id").hint("merge"), "digest"), "groups")
    return look_up(keyed, known, ["digest"], "group_size", keyed.count())


def ingest(docs: DataFrame, path: str | None, batches: int, buckets: int | None) -> tuple[DataFrame, DigestIndex]:
    """Append ``docs`` to the index in ``batches`` ranges of ascending doc_id; (doc_id, digest) of all rows, and the index."""
    spark = docs.sparkSession
    keyed = stored(digests(docs), "digests")
    low, high, rows = keyed.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    index = DigestIndex(spark, path or scratch_path(spark, "digest_index"), buckets or buckets_for(rows)).attach()
    if low is None:
        index.append(keyed)
    else:
        step = (high - low) // batches + 1
        arrival = F.coalesce(F.floor((F.col("doc_id") - F.lit(low)) / F.lit(step)), F.lit(batches - 1))
        for i in range(batches):
            index.append(keyed.filter(arrival == i))
    return keyed, index


def exact_dedup(docs: DataFrame, path: str | None = None, batches: int = 2, buckets: int | None = None) -> DataFrame:
    """Every row of ``docs`` with the decision about it.

    The documents arrive in ``batches`` ranges of ascending doc_id, each of
    which is deduplicated against the index of those before.  ``path``: where
    the index lies (one that is there is extended); by default a new one, with
    buckets for the number of rows.
    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    keyed, index = ingest(docs, path, batches, buckets)
    return decide(keyed, index.read()).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, batches: int = 2, buckets: int | None = None) -> DataFrame:
    """The documents that stay, with their columns unchanged (one row for a repeated doc_id and text)."""
    _, index = ingest(docs, None, batches, buckets)
    no_id = F.lit(-(1 << 63))
    keep = index.read().select(F.coalesce("keep_id", no_id).alias("__id"), F.col("digest").alias("__digest"))
    user = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # whatever its columns are called
    held = docs.select(
        user.alias("user"),
        F.coalesce(F.col("doc_id").cast("bigint"), no_id).alias("__id"),
        F.sha2(normalised().cast("binary"), 256).alias("__digest"),
    )
    kept = held.join(keep, ["__id", "__digest"], "left_semi").dropDuplicates(["__id", "__digest"])
    return kept.select(*[F.col("user")[c].alias(c) for c in docs.columns])


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
