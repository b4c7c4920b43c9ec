"""Dataset staging and release checks (Q6-Q8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import REQUIRED_DATASET_FILES, REQUIRED_MODEL_FILES, REQUIRED_SPLITS


def split_of(key: Column, test_pct: int = 20, validation_pct: int = 10, salt: str = "split") -> Column:
    """Deterministic split from md5(salt:key): ``test`` / ``validation`` / ``train``."""
    b = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(salt), key.cast("string"))), 1, 8), 16, 10).cast("long") % 100
    return F.when(b < test_pct, "test").when(b < test_pct + validation_pct, "validation").otherwise("train")


def stage_splits(df: DataFrame, path: str) -> None:
    """Q6: one directory per split (``split=<name>``), JSON lines; partition pruning on read."""
    df.write.mode("overwrite").partitionBy("split").json(path)


def required_artifacts(spark: SparkSession) -> DataFrame:
    rows = [("dataset", f) for f in REQUIRED_DATASET_FILES] + [("model", f) for f in REQUIRED_MODEL_FILES]
    return spark.createDataFrame(rows, "repo string, artifact string")


def present_artifacts(spark: SparkSession, path: str, repo: str = "dataset") -> DataFrame:
    """Artifacts found by listing a staged repository.

    A split written as a directory (``split=<name>/part-*``) counts as
    ``<name>.jsonl``, any other file by its own name.  Only names are read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    split = F.regexp_extract("path", r"/split=([^/]+)/part-[^/]*$", 1)
    own = F.element_at(F.split("path", "/"), -1)
    name = F.when(split != "", F.concat(split, F.lit(".jsonl"))).otherwise(own)
    return files.filter("length > 0").select(F.lit(repo).alias("repo"), name.alias("artifact")).distinct()


def missing_artifacts(required: DataFrame, present: DataFrame) -> DataFrame:
    """Q7: required minus present (anti join; the required side is a fixed 8-row list)."""
    return required.join(present, ["repo", "artifact"], "left_anti")


def missing_splits(staged: DataFrame) -> DataFrame:
    """Q8: required split names not present in the staged data."""
    spark = staged.sparkSession
    req = spark.createDataFrame([(s,) for s in REQUIRED_SPLITS], "split string")
    return req.join(staged.select("split").distinct(), "split", "left_anti")
