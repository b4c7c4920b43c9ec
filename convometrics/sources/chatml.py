"""ChatML JSON-lines sources and sinks.

Physical line numbers in splittable text files
---------------------------------------------
A text file is read in splits; each split is read by one task in order, and a
task may read several.  The high bits of ``monotonically_increasing_id`` are the
number of the task's partition, the low bits count its lines.  One aggregate
over the splits (no text in it) is written first: lines and first id of each,
then the lines of the file before it.  The rows of that table, gathered by
partition, are looked up by partition number inside the scan, so the text is
neither joined by a shuffle nor moved: ``line_num = id - first_id + lines_before + 1``.
Blank lines are numbered before any filtering.

The table has one row for each split.  Up to ``MAX_SPLITS`` (some hundred
terabytes of the usual splits) it is broadcast; beyond, the same numbers come
from a join on file and split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.jsontext import parse_strict, is_object, ustrip, vget, vstring, vtype
from ..functions.stage import materialize, stage
from ..schema import CHATML_SCHEMA
from ..session import scratch_path
from .commits import BatchStore

# Splits whose offsets are broadcast: two longs and a partition number each, some 100 MB at most.
MAX_SPLITS = 1 << 21
PARTITION_BITS = 33  # of monotonically_increasing_id: the partition number stands above these
LAYOUT_CHANGED = "the files were split otherwise than when their lines were counted"


def _split_table(text: DataFrame) -> DataFrame:
    """(file_path, block_start, _first, _before): first row id of each split, and the lines of its file before it."""
    splits = text.groupBy("file_path", "block_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_first"))
    w = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file_path", "block_start", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))


def _number_by_partition(text: DataFrame, splits: DataFrame) -> DataFrame:
    """``text`` with ``line_num``, the splits of a row's partition being looked up by its number."""
    split = F.struct(F.col("_first").alias("first"), F.col("_before").alias("before"), F.col("block_start").alias("start"))
    held = splits.groupBy(F.shiftright("_first", PARTITION_BITS).alias("_part")).agg(F.array_sort(F.collect_list(split)).alias("_splits"))
    found = text.withColumn("_part", F.shiftright("_rid", PARTITION_BITS)).join(F.broadcast(held), "_part", "left")
    # the last split that begins at or before the row; a task of large files has one
    mine = F.when(F.size("_splits") == 1, F.get("_splits", 0)).otherwise(
        F.element_at(F.filter("_splits", lambda s: s.getField("first") <= F.col("_rid")), -1)
    )
    found = found.withColumn("_split", mine)
    number = F.col("_rid") - F.col("_split.first") + F.col("_split.before") + 1
    return found.withColumn(
        "line_num", F.when(F.col("_split.start") == F.col("block_start"), number).otherwise(F.raise_error(F.lit(LAYOUT_CHANGED)).cast("long"))
    )


def _number_by_split(text: DataFrame, splits: DataFrame) -> DataFrame:
    """The same by a join on file and split: for tables of splits too large to broadcast."""
    joined = text.join(splits.hint("merge"), ["file_path", "block_start"])
    return joined.withColumn("line_num", F.col("_before") + (F.col("_rid") - F.col("_first")) + 1)


def read_lines(
    spark: SparkSession, path: str | list[str], where: Column | str | None = None, max_splits: int = MAX_SPLITS
) -> DataFrame:
    """``file_path, line_num, value`` (+ partition columns of the layout) for every physical line.

    ``where`` filters on the layout's columns; it prunes the files that are read.
    The lines of each split are counted when this is called.
    """
    paths = [path] if isinstance(path, str) else path
    raw = spark.read.text(paths)
    if where is not None:
        raw = raw.filter(where)
    part_cols = [c for c in raw.columns if c != "value"]
    text = raw.select(
        "value",
        *part_cols,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("_rid"),
    )
    splits = materialize(_split_table(text), scratch_path(spark, "splits"))
    number = _number_by_partition if splits.count() <= max_splits else _number_by_split
    return number(text, splits).select("file_path", *part_cols, "line_num", "value")


# ---------------------------------------------------------------------------
# S1/S2 ChatML reader with quarantine
# ---------------------------------------------------------------------------


def classify_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``record`` (VARIANT), ``n_messages`` and ``reason`` (NULL when the line is good).

    Reasons: ``blank`` (skipped, still numbered), ``invalid_json``,
    ``not_object``, ``too_few_messages``.
    """
    s = ustrip(F.col(value))
    df = lines.withColumn("_s", s)
    df = stage(df.withColumn("record", parse_strict(F.col("_s"))))
    msgs = F.try_variant_get(F.col("record"), "$.messages", "array<variant>")
    df = df.withColumn("n_messages", F.coalesce(F.size(msgs), F.lit(0)))
    reason = (
        F.when(F.col("_s") == "", F.lit("blank"))
        .when(F.col("record").isNull(), F.lit("invalid_json"))
        .when(~is_object(F.col("record")), F.lit("not_object"))
        .when(F.col("n_messages") < 3, F.lit("too_few_messages"))
    )
    return stage(df.withColumn("reason", reason).drop("_s"))


def messages_column(record: Column) -> Column:
    """``ARRAY<STRUCT<role, content>>``; an object-valued content becomes its JSON text."""
    arr = F.try_variant_get(record, "$.messages", "array<variant>")

    def one(m: Column) -> Column:
        c = vget(m, "content")
        content = F.when(vtype(c) == "string", vstring(c)).when(vtype(c).isin("object", "array", "number", "boolean"), F.to_json(c))
        return F.struct(vstring(vget(m, "role")).alias("role"), content.alias("content"))

    return F.transform(arr, one)


def read_chatml(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "quarantine",
    store: str | None = None,
    where: Column | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Read ChatML JSONL -> (good, quarantine).

    ``good``: ``file_path, line_num, record, messages`` (+ layout columns).
    ``quarantine``: ``file_path, line_num, reason, value`` for every bad line
    except blanks.  ``mode="failfast"`` raises on the first bad line (one
    aggregate), like the reference loader, and on an empty dataset.

    ``store`` names a directory for the classified lines: they are written once
    and ``good``, ``quarantine`` and the fail-fast checks read them there,
    instead of each reading and parsing the text again.
    """
    c = classify_lines(read_lines(spark, path, where))
    if store:
        c = materialize(c, store)
    good = c.filter(F.col("reason").isNull()).withColumn("messages", messages_column(F.col("record")))
    good = good.drop("reason", "value")
    bad = c.filter(F.col("reason").isNotNull() & (F.col("reason") != "blank")).select(
        *[x for x in c.columns if x not in ("record", "n_messages")]
    )
    if mode == "failfast":
        first = bad.agg(F.min_by(F.struct("line_num", "file_path", "reason"), F.col("line_num")).alias("f")).first()
        if first and first["f"] is not None:
            f = first["f"]
            raise ValueError(f"{f['file_path']} line {f['line_num']}: {f['reason']}")
        if good.isEmpty():
            raise ValueError("No valid rows in eval file")
    return good, bad


def read_training_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """S3: training JSONL with an explicit schema (no inference); a missing path raises."""
    return spark.read.schema(CHATML_SCHEMA).json(path)


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------


def append_jsonl(df: DataFrame, path: str, batch: str | None = None) -> bool:
    """Append records as JSON lines (UTF-8, non-ASCII unescaped); creates the directory.

    With ``batch`` the append may be repeated: a batch id counts once, whatever
    runs again or dies half-way, and ``read_appended`` reads the batches that
    count.  Returns whether rows were added.
    """
    if batch is None:
        df.write.mode("append").json(path)
        return True
    return BatchStore(df.sparkSession, path, "json").write(df, batch)


def read_appended(spark: SparkSession, path: str, schema=CHATML_SCHEMA) -> DataFrame:
    """The rows of all batches that ``append_jsonl`` committed to ``path``."""
    return BatchStore(spark, path, "json").read(schema)


def write_jsonl_keep_nulls(df: DataFrame, path: str, compression: str = "none") -> None:
    """JSON lines with null fields written out (the JSON writer drops them by default).

    ``compression``: codec of the files (``gzip``, ...); Spark's readers tell it from their names.
    """
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path, compression=compression)
