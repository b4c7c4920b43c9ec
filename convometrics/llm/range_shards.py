"""Sharding by sampled splitters: shards of near-equal bytes over ranges of a key.

The key of a row is the digest of its text, then its doc_id: the order is as good
as shuffled, and equal texts lie side by side, parted only where a shard ends.

1. Rows are reduced to (key, size, checksum); rows that are equal in all of it
   and were read by the same task are one entry with a number of copies.
2. Splitters: a row is drawn with a probability in proportion to its size (by a
   hash of its key, so reruns agree).  The drawn keys, in order, give quantile
   boundaries, and the entries are partitioned by range.
3. A range that holds over ``OVERFULL`` times its share of bytes or of entries
   is subdivided: keys are drawn again from it, until none is overfull or it has
   one key alone.
4. Each range gives its exact bytes and rows; sums of those before it place every
   row at its byte in the whole order.  A row goes to the shard in which its
   middle lies, so a shard differs from its share by one row's size at most.

Law: ``bytes``.  DataFrame functions only.  What reaches the driver are splitters
(their number is bounded by ``MAX_RANGES``, whatever the table) and sums.
``write_shards`` writes the documents themselves: each finds its shard by a binary
search over the first keys of the shards, so texts are shuffled once, by shard.

Defined cases: a null or empty text has no bytes, size ``OVERHEAD`` and the
checksum of no bytes; very long texts count whole, and one longer than a shard's
share leaves a neighbour short or empty; ties (equal keys) have neighbouring
places, and rows equal in all columns read here are interchangeable; a null
doc_id is placed first among equal texts; repeated rows are rows of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convometrics.llm.common import crc_sql, stored

SHARDS = 24
OVERHEAD = 8
RANGES_PER_SHARD = 8
ENTRIES_PER_RANGE = 1 << 18
MAX_RANGES = 1 << 14
DRAWS_PER_RANGE = 16
OVERFULL = 2

ORDER = ["key", "size", "text_crc32", "part"]


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Digest of the text, then the doc_id, as a string that sorts alike: a null id first, then ascending ids."""
    number = F.col(doc_id).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    place = F.when(F.col(doc_id).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.lpad(F.hex(number), 16, "0")))
    return F.concat(F.md5(F.coalesce(F.col(text).cast("binary"), F.lit(b""))), place)


def record_entries(docs: DataFrame, overhead: int = OVERHEAD) -> DataFrame:
    """(key, doc_id, size, text_crc32, part, copies, bytes): equal rows of one task are one entry."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        row_key().alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
    )
    entries = rows.groupBy("key", "doc_id", "size", "text_crc32", "part").agg(F.count(F.lit(1)).alias("copies"))
    return entries.withColumn("bytes", F.col("size") * F.col("copies"))


def splitters_below(keys: list[str], key: Column) -> Column:
    """How many of the sorted ``keys`` lie at or below ``key``: a binary search, the keys being one literal."""
    n = len(keys)
    if not n:
        return F.lit(0)
    held = F.split(F.lit(",".join(keys)), ",")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])

    def step(at: Column, width: Column) -> Column:
        to = at + width
        return F.when((to <= n) & (F.element_at(held, F.least(to, F.lit(n))) <= key), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _quantiles(drawn: DataFrame) -> list[str]:
    """Keys that part the draws of each range into ``parts`` stretches of equal number.  ``drawn``: range, key, times, parts."""
    order = Window.partitionBy("range").orderBy("key", "times").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = drawn.withColumn("upto", F.sum("times").over(order)).withColumn("all", F.sum("times").over(Window.partitionBy("range")))
    stretch = lambda at: F.floor(at * F.col("parts") / F.col("all"))
    ends = placed.filter(stretch(F.col("upto") - F.col("times")) < stretch(F.col("upto")))
    return [r["key"] for r in ends.select("key").distinct().collect()]


def sampled_splitters(entries: DataFrame, ranges: int, total: int, count: int) -> list[str]:
    """Sorted boundary keys of about ``ranges`` ranges of ``entries``, none of which is overfull."""
    share, fair = total / ranges, count / ranges
    full = [(0, ranges, total, count)]  # (range, parts to cut it into, its bytes and entries)
    splitters: list[str] = []
    level = 0
    while full:
        level += 1
        plan = entries.sparkSession.createDataFrame(full, "range int, parts int, of long, entries long")
        mine = entries.withColumn("range", splitters_below(splitters, F.col("key"))).join(F.broadcast(plan), "range")
        weight = F.col("bytes") / F.col("of")
        if level > 1:  # a range may be overfull by its entries alone
            weight = (weight + F.lit(1.0) / F.col("entries")) / 2
        wanted = weight * F.col("parts") * DRAWS_PER_RANGE
        chance = F.shiftrightunsigned(F.xxhash64(F.lit(level), *ORDER), 11) / F.lit(float(1 << 53))
        times = F.floor(wanted) + F.when(chance < wanted - F.floor(wanted), 1).otherwise(0)
        drawn = mine.select("range", "key", "parts", times.cast("long").alias("times")).filter("times > 0")
        more = sorted(set(splitters) | set(_quantiles(drawn)))
        if len(more) == len(splitters):
            break
        splitters = more
        sums = entries.groupBy(splitters_below(splitters, F.col("key")).alias("range")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        over = sums.filter((F.col("low") < F.col("high")) & ((F.col("bytes") > OVERFULL * share) | (F.col("n") > OVERFULL * fair)))
        full = [(r["range"], int(max(r["bytes"] / share, r["n"] / fair)) + 1, r["bytes"], r["n"]) for r in over.collect()]
    return splitters


def place_rows(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """Every row of ``docs`` as (key, doc_id, size, text_crc32, shard, row): ``row`` numbers the rows in the order of the key."""
    entries = stored(record_entries(docs, overhead), "shard-entries")
    total, rows, count = entries.agg(F.sum("bytes"), F.sum("copies"), F.count(F.lit(1))).first()
    total, rows = total or 0, rows or 0
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, -(-count // ENTRIES_PER_RANGE)))
    splitters = sampled_splitters(entries, ranges, total, count) if total else []

    ranged = entries.withColumn("range", splitters_below(splitters, F.col("key")))
    sums = ranged.groupBy("range").agg(F.sum("bytes").alias("bytes"), F.sum("copies").alias("copies"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are ranges
    base = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("copies").over(before), F.lit(0)).alias("base_rows"),
    )
    inner = Window.partitionBy("range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("bytes_before", F.coalesce(F.sum("bytes").over(inner), F.lit(0))).withColumn(
        "rows_before", F.coalesce(F.sum("copies").over(inner), F.lit(0))
    )
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    placed = within.join(F.broadcast(base), "range").withColumn("copy", copy)
    start = F.col("base_bytes") + F.col("bytes_before") + F.col("copy") * F.col("size")
    placed = placed.withColumn("start", start)
    # the shard in which the row's middle lies
    shard = F.expr(f"least({shards - 1}, ((2 * start + size) * {shards}) div {2 * max(total, 1)})")
    number = F.col("base_rows") + F.col("rows_before") + F.col("copy")
    return placed.select("key", "doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), number.alias("row"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless in a shard, in the order of the key) and grown_shard (null: no law of keys)."""
    placed = stored(place_rows(docs, shards, overhead), "shard-rows")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files: int = 1, overhead: int = OVERHEAD) -> None:
    """Write the documents, columns unchanged, as Parquet under ``path``/shard=i, ``files`` files a shard.

    Rows that are equal in doc_id and text and lie across the end of a shard are dealt to both sides.
    """
    placed = stored(place_rows(docs, shards, overhead), "shard-rows")
    bounds = placed.groupBy("shard").agg(F.min_by("key", "row").alias("low"), F.max_by("key", "row").alias("high")).orderBy("shard").collect()
    # an empty shard starts where the next one does and is never met
    low = {r["shard"]: r["low"] for r in bounds}
    starts = [(r["low"], r["shard"], any(o["high"] == r["low"] for o in bounds if o["shard"] < r["shard"])) for r in bounds[1:]]
    key = row_key()
    at = splitters_below([s for s, _, _ in starts], key)
    both = F.lit(0)
    for s, _, shared in starts:
        both = both + F.when(F.lit(shared) & (key == s), 1).otherwise(0)
    pick = at - F.pmod(F.xxhash64(F.monotonically_increasing_id()), both + 1).cast("int")
    numbers = F.array(*[F.lit(n) for n in sorted(low)]) if low else F.array(F.lit(0))
    user = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    dealt = docs.select(user.alias("user"), F.element_at(numbers, pick + 1).alias("shard"))
    dealt = dealt.withColumn("file", F.pmod(F.xxhash64("user"), F.lit(files))).repartition(shards * files, "shard", "file")
    columns = [F.col("user")[c].alias(c) for c in docs.columns if c != "shard"]
    dealt.select(*columns, "shard").write.partitionBy("shard").parquet(path)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS digest, strlen(coalesce(text, '')) + 8 AS size FROM documents
),
p AS (
  SELECT *, sum(size) OVER (ORDER BY digest, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total FROM d
),
s AS (SELECT *, least(23, (2 * start + size) * 24 // (2 * total))::INTEGER AS shard FROM p)
SELECT doc_id, size::BIGINT AS size,
       {crc_sql("list_transform(regexp_extract_all(hex(t), '..'), lambda x: ('0x' || x)::UBIGINT)")} AS text_crc32,
       'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id NULLS FIRST) - 1)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM s
"""
