"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

1. Targets.  Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, ... and
   share all words of the corpus; a source's target stops at ``max_epochs``
   times its size and the excess goes to the others by weight.
2. Blocks.  The documents of a source are shuffled by hash, laid end to end and
   cut into blocks of equal length (its last one may be shorter).
3. Schedule.  Slot i holds the golden-ratio point frac(i * 0.618...); the points
   are mapped through the sources' cumulative target shares, so any run of
   slots holds each source in about its share.  Ranked within its source, a slot
   takes block (rank mod blocks) of it.  The discrepancy of a few slots is closed
   at the end: ranks beyond the target go, missing ones come after the last slot,
   source by source in turn, and the last slot of a source takes only as much of
   its block as the target still needs.
4. Slots are joined to blocks by (source, block).  The result is the mix in its
   order: ``schedule`` tells for every slot which words of which document it holds
   (``slot, source, block, doc_id, first_word, words``).  What the mix takes of a
   document (``mix``) is the sum over its slots.

Every ranking is done in three levels (groups of chunks, chunks, rows of a chunk),
so that a source with a third of all rows or slots is spread over many tasks.

Defined cases: a null or empty text has size 0 and is in no slot; very long texts
lie across as many blocks as they need; a null source is a source of its own, the
last; ties of the shuffle go by doc_id, then size; an empty table gives no rows;
rows that repeat a doc_id are documents of their own; other columns are ignored,
and ``mixed_documents`` keeps them whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convometrics.llm.common import WORD_CLASS, stored, word_count

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_WORDS = 1024
MIN_SLOTS = 1 << 16  # smaller corpora get shorter blocks
ROWS_PER_CHUNK = 256  # rows of one source ranked together, about
CHUNKS_PER_GROUP = 1024
GOLDEN = (math.sqrt(5) - 1) / 2


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, position, weight, target) from (source, source_size).

    ``weights`` are repeated over the sources in code-point order.  The reshared
    excess converges to min(cap, level * weight); each round raises the level by
    what the sources capped so far leave over.  Only sums reach the driver.
    """
    ordered = stored(_positions(sizes), "sources")
    place = F.pmod(F.col("position"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place + 1).cast("int"))
    ordered = ordered.select("source", "source_size", "position", weight.cast("long").alias("weight"))
    total, weight_sum = ordered.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight_sum = total or 0, weight_sum or 1
    cap = F.col("source_size") * F.lit(max_epochs)
    level, capped = total / weight_sum, -1
    while True:
        n, cap_sum, cap_weight = (
            ordered.filter(cap.cast("double") <= F.col("weight") * F.lit(float(level)))
            .agg(F.count(F.lit(1)), F.sum(cap), F.sum("weight"))
            .first()
        )
        if n == capped or n == 0 or weight_sum == cap_weight:
            break
        capped, level = n, (total - cap_sum) / (weight_sum - cap_weight)
    return ordered.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def _positions(sizes: DataFrame) -> DataFrame:
    """Number the sources from 0 in code-point order, null last: a range sort, then counts of the parts before."""
    parts = stored(
        sizes.withColumn("has", F.col("source").isNull())
        .repartitionByRange(8, "has", "source")
        .withColumn("part", F.spark_partition_id()),
        "source-parts",
    )
    before = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # eight rows
    before = before.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("part").orderBy("has", "source"))
    return parts.withColumn("inner", inner).join(F.broadcast(before), "part").select(
        "source", "source_size", (F.col("before") + F.col("inner") - 1).alias("position")
    )


def _offsets(rows: DataFrame, chunk: str, order: list, amount: str, out: str) -> DataFrame:
    """Running sum of ``amount`` within ``key`` before each row, ordered by (chunk, order).

    One window sums the groups of ``CHUNKS_PER_GROUP`` chunks of a key, one the
    chunks of a group, one the rows of a chunk.
    """
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    group = F.floor(F.col(chunk) / CHUNKS_PER_GROUP).alias("__group")
    sums = rows.groupBy("key", chunk).agg(F.sum(amount).alias("__sum")).select("key", chunk, "__sum", group)
    groups = sums.groupBy("key", "__group").agg(F.sum("__sum").alias("__of_group"))
    over = F.coalesce(F.sum("__of_group").over(upto(Window.partitionBy("key").orderBy("__group"))), F.lit(0))
    groups = groups.select("key", "__group", over.alias("__over"))
    inside = F.coalesce(F.sum("__sum").over(upto(Window.partitionBy("key", "__group").orderBy(chunk))), F.lit(0))
    sums = sums.withColumn("__inside", inside).join(groups, ["key", "__group"])
    sums = sums.select("key", chunk, (F.col("__over") + F.col("__inside")).alias("__before"))
    inner = Window.partitionBy("key", chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("__inner", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
        .join(sums, ["key", chunk])
        .withColumn(out, F.col("__before") + F.col("__inner"))
        .drop("__before", "__inner")
    )


def _slots(plan: DataFrame, n_slots: int) -> DataFrame:
    """(slot, key, block, words): the slots of the mix, each with a block of its source and how many words of it.

    ``plan``: (key, position, block_words, blocks, slots, rest, first, last) by source; points in [first, last) are the source's.
    """
    spark = plan.sparkSession
    sources = plan.count()
    cells = 1 << max(10, math.ceil(math.log2(max(2, sources))) + 2)
    span = plan.filter("first < last").select(
        "key",
        "first",
        "last",
        F.explode(
            F.sequence(
                F.floor(F.col("first") * cells), F.least(F.floor(F.col("last") * cells), F.lit(cells - 1).cast("long"))
            )
        ).alias("cell"),
    )
    point = F.col("id") * F.lit(GOLDEN) - F.floor(F.col("id") * F.lit(GOLDEN))
    drawn = (
        spark.range(n_slots)
        .withColumn("point", point)
        .withColumn("cell", F.floor(F.col("point") * cells))
        .join(span, "cell")
        .filter((F.col("point") >= F.col("first")) & (F.col("point") < F.col("last")))
        .select("key", F.col("id").alias("slot"), F.floor(F.col("id") / 4096).alias("chunk"), F.lit(1).cast("long").alias("one"))
    )
    ranked = stored(_offsets(drawn, "chunk", ["slot"], "one", "rank").select("slot", "key", "rank"), "mix-ranked")
    reached = ranked.groupBy("key").agg(F.count(F.lit(1)).alias("reached"))
    closing = (
        plan.join(reached, "key", "left")
        .withColumn("reached", F.coalesce("reached", F.lit(0)))
        .filter(F.col("reached") < F.col("slots"))
        .select("key", "position", "reached", F.explode(F.sequence(F.col("reached"), F.col("slots") - 1)).alias("rank"))
        .select((F.lit(n_slots) + (F.col("rank") - F.col("reached")) * sources + F.col("position")).alias("slot"), "key", "rank")
    )
    used = ranked.unionByName(closing).join(plan.select("key", "block_words", "blocks", "slots", "rest"), "key").filter("rank < slots")
    last = (F.col("rank") == F.col("slots") - 1) & (F.col("rest") > 0)
    words = F.when(last, F.col("rest")).otherwise(F.col("block_words"))
    return used.select("slot", "key", (F.col("rank") % F.col("blocks")).alias("block"), words.alias("words"))


def _prepare(docs: DataFrame, weights, max_epochs: int, block_words: int):
    """(laid, plan, slots): documents with the word at which each begins in its source, the sources, the slots."""
    rows = stored(docs.select("doc_id", "source", word_count("text").alias("size")), "mix-sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_source = stored(by_source, "mix-sources")
    total, count = by_source.agg(F.sum("source_size"), F.sum("rows")).first()
    total, count = total or 0, count or 0
    block = max(1, min(block_words, total // MIN_SLOTS))
    chunks = 1 << max(8, math.ceil(math.log2(max(1, count / ROWS_PER_CHUNK))))

    # the key of a source: itself, marked so that a null is a value to join by
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    plan = targets(by_source.select("source", "source_size"), weights, max_epochs)
    wanted = F.round(F.col("target")).cast("long")
    plan = plan.withColumn("key", key).withColumn("wanted", F.least(wanted, F.col("source_size") * max_epochs))
    plan = plan.withColumn("block_words", F.lit(block).cast("long"))
    plan = plan.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)))
    size = F.when(F.col("source_size") > 0, F.col("source_size"))
    plan = plan.withColumn("epochs", F.coalesce(F.floor(F.col("wanted") / size), F.lit(0)))
    plan = plan.withColumn("over", F.col("wanted") - F.col("epochs") * F.col("source_size"))
    plan = plan.withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("over") / F.lit(block)))
    plan = plan.withColumn("rest", F.col("over") % block)
    plan = stored(plan, "mix-plan")
    shares = _offsets(
        plan.withColumn("source_key", F.col("key"))
        .withColumn("key", F.lit(0))
        .withColumn("chunk", F.floor(F.col("position") / 4096)),
        "chunk",
        ["position"],
        "target",
        "below",
    )
    scale = F.lit(float(max(total, 1)))
    shares = shares.select(
        F.col("source_key").alias("key"), "position", "block_words", "blocks", "slots", "rest", (F.col("below") / scale).alias("first"),
        ((F.col("below") + F.col("target")) / scale).alias("last"),
    )
    slots = _slots(stored(shares, "mix-shares"), math.ceil(total / block))

    shuffled = F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("size"))
    laid = rows.withColumn("key", key).withColumn("hash", shuffled)
    laid = laid.withColumn("chunk", F.shiftrightunsigned(F.col("hash"), 64 - int(math.log2(chunks))))
    laid = stored(_offsets(laid, "chunk", ["hash", "doc_id", "size"], "size", "begin"), "mix-laid")
    return laid, plan, slots, block


def _held(laid: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """(slot, key, block, doc_id, begin, first_word, words): the stretch of each document that a slot holds."""
    full = laid.filter("size > 0").withColumn("stop", F.col("begin") + F.col("size"))
    pieces = full.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("stop") - 1) / block)))
    )
    low = F.greatest(F.col("begin"), F.col("block") * block)
    here = F.least(F.col("stop"), (F.col("block") + 1) * block) - low
    pieces = pieces.select("key", "block", "doc_id", "begin", low.alias("low"), here.alias("here"))
    # a slot that takes a part of its block takes the block's first words
    taken = F.least(F.col("here"), F.col("words") - (F.col("low") - F.col("block") * block))
    held = slots.join(pieces, ["key", "block"]).withColumn("words", taken).filter("words > 0")
    return held.select("slot", "key", "block", "doc_id", "begin", (F.col("low") - F.col("begin")).alias("first_word"), "words")


def schedule(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix in its order: slot, source, block, doc_id, first_word (from 0) and words of each stretch of a document.

    Slots are in ascending order, without those that a target had no use for;
    within a slot the stretches follow each other by document as they lie in the block.
    """
    laid, plan, slots, block = _prepare(docs, weights, max_epochs, block_words)
    held = _held(laid, slots, block).join(plan.select("key", "source"), "key")
    return held.select("slot", "source", "block", "doc_id", "begin", "first_word", "words")


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What the mix takes of every document: doc_id, source, size, source_size, target, taken (the sum over its slots)."""
    laid, plan, slots, block = _prepare(docs, weights, max_epochs, block_words)
    taken = _held(laid, slots, block).groupBy("key", "begin").agg(F.sum("words").cast("long").alias("taken"))
    found = taken.select(F.col("key").alias("__key"), F.col("begin").alias("__begin"), "taken")
    same = (F.col("key") == F.col("__key")) & (F.when(F.col("size") > 0, F.col("begin")) == F.col("__begin"))
    return (
        laid.join(found, same, "left")
        .join(plan.select("key", "source_size", "target"), "key")
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The mixed corpus, with the columns of ``docs``: a document stands once for each time it is taken.

    Its last copy is cut to the words that are still taken of it (joined by one
    space, with n_chars to match); a document that is not taken goes.  doc_id identifies a document.
    """
    pick = decisions.filter("taken > 0").select(F.col("doc_id").alias("pick_id"), "size", "taken")
    user = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # whatever its columns are called
    held = docs.select(user.alias("user"), F.col("doc_id").alias("id"), F.col("text").alias("whole"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("taken") / F.col("size")) - 1))
    mixed = held.join(pick, F.col("id").eqNullSafe(F.col("pick_id"))).withColumn("copy", copy)
    mixed = mixed.withColumn("here", F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size")))
    words = F.regexp_extract_all("whole", F.lit(WORD_CLASS), F.lit(0))
    part = F.col("here") < F.col("size")
    text = F.when(part, F.array_join(F.slice(words, 1, F.col("here").cast("int")), " ")).otherwise(F.col("whole"))
    mixed = mixed.withColumn("cut", text)

    def column(name: str):
        if name == "text":
            return F.col("cut").alias(name)
        own = F.col("user")[name]
        if name == "n_chars":
            own = F.when(part, F.length("cut")).otherwise(own).cast(docs.schema[name].dataType)
        return own.alias(name)

    return mixed.select(*[column(c) for c in docs.columns])
