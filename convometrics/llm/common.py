"""What the operators share: tables, written intermediates, words as numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from convometrics.session import scratch_path

# The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

# Text handled at once inside a task, so that numpy's working arrays stay small
# whatever the size of an Arrow batch.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a reread of files, not the
    recomputation of what stands above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: whole documents travel in them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes (a longer text is a run of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


@dataclass
class Words:
    """The words of several documents, in order, over one byte array."""

    data: np.ndarray  # all bytes
    doc_bytes: np.ndarray  # n + 1 byte offsets of the documents
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # one past its last byte
    doc_words: np.ndarray  # n + 1 word offsets of the documents

    @property
    def per_doc(self) -> np.ndarray:
        return np.diff(self.doc_words)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_words) - 1), self.per_doc)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a text or binary column; a null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and n else np.zeros(0, np.uint8)
    return data, off - off[0]


def split_spans(data: np.ndarray, off: np.ndarray, belongs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of bytes that ``belongs`` marks; no run crosses an offset of ``off``."""
    inside = belongs[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = off[(off > 0) & (off < len(data))]  # documents lie next to each other: a word ends with its document
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words_of(column: pa.Array) -> Words:
    data, off = byte_view(column)
    start, end = split_spans(data, off, ~IS_SPACE)
    return Words(data, off, start, end, np.searchsorted(start, off))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FOLDED_CODES = _BYTE_CODES.copy()
_FOLDED_CODES[65:91] = _BYTE_CODES[97:123]  # A-Z as a-z
_BASE = np.uint64(0xD6E8FEB86659FD93)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False, salt: int = 0) -> np.ndarray:
    """64-bit hash of each byte span (spans ascending, disjoint); ``fold`` reads A-Z as a-z, ``salt`` gives another hash."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    out = np.zeros(len(start), np.uint64)
    full = size > 0
    s, n = start[full], size[full]
    if len(s):
        before = np.concatenate(([0], np.cumsum(n)[:-1]))
        place = np.arange(int(n.sum())) - np.repeat(before, n)
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(n.max()), _BASE, np.uint64))), dtype=np.uint64)
        table = _FOLDED_CODES if fold else _BYTE_CODES
        codes = (mix64(table + np.uint64(salt)) if salt else table)[data[place + np.repeat(s, n)]]
        out[full] = np.add.reduceat(codes * power[place], before)
    return mix64(out + size.astype(np.uint64))


def run_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (len(word) - k + 1 values; runs cross documents: mask them)."""
    if len(word) < k:
        return np.zeros(0, np.uint64)
    m = len(word) - k + 1
    h = mix64(word[:m] + np.uint64(k))
    for j in range(1, k):
        h = mix64(h * _BASE + word[j : j + m])
    return h


def poly_run_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """As ``run_hashes``, for long runs: by doubling, log2(k) passes."""
    if len(word) < k:
        return np.zeros(0, np.uint64)
    done, length, start = None, 0, 0
    power, span = word, 1
    bits = k
    while bits:
        if bits & 1:
            m = len(word) - length - span + 1
            done = power[:m] if done is None else mix64(done[:m] * _BASE + power[length : length + m])
            length += span
        bits >>= 1
        if bits:
            m = len(power) - span
            power = mix64(power[:m] * _BASE + power[span : span + m] + np.uint64(span))
            span *= 2
    return done[: len(word) - k + 1]


def runs_inside(words: Words, k: int) -> np.ndarray:
    """Mask over ``len(words.start) - k + 1`` positions: the run of k words lies in one document."""
    m = len(words.start) - k + 1
    if m <= 0:
        return np.zeros(0, bool)
    doc = words.doc_of_word()
    return doc[:m] == doc[k - 1 :]


def normalised(text="text"):
    """Column: each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS, " ")


def word_count(text="text"):
    """Column: the number of words; 0 for a null."""

    def count(texts: pd.Series) -> pd.Series:
        # bytes.split() knows just the six separators of the contracts
        return texts.map(lambda b: 0 if b is None else len(b.split())).astype("int64")

    return F.pandas_udf(count, LongType())(F.col(text).cast("binary"))


def count_in(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` over each stretch between neighbouring ``bounds``."""
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def map_texts(df: DataFrame, make, schema: str, passed: list[str], text: str = "text") -> DataFrame:
    """Run ``make(column)`` on the texts, a slice at a time, beside the columns ``passed``.

    ``make`` gets a binary Arrow column and returns a dict of arrays, one value
    for each text; ``schema`` names those after the passed columns.
    """

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                made = make(part.column("text"))
                columns = {c: part.column(c) for c in passed}
                yield pa.RecordBatch.from_pydict(columns | {k: pa.array(v) for k, v in made.items()})

    return df.select(*passed, F.col(text).cast("binary").alias("text")).mapInArrow(run, schema)


# A key with more than one in this many of all rows is looked up by broadcast:
# there are fewer than HOT_SHARE such keys whatever the size of the input.
HOT_SHARE = 1000


def look_up(rows: DataFrame, known: DataFrame, key: list[str], size: str, total: int) -> DataFrame:
    """``rows`` joined with ``known`` (one row for each key; ``size`` is the number of rows of the key).

    Hot keys go by broadcast, the rest by a join in which no key has more than
    a thousandth of the ``total`` rows.
    """
    is_hot = F.col(size) * HOT_SHARE > F.lit(total)
    values = [c for c in known.columns if c not in key]
    held = F.struct(*values).alias("__hot")
    marked = rows.join(F.broadcast(known.filter(is_hot).select(*key, held)), key, "left")
    from_hot = marked.filter(F.col("__hot").isNotNull()).select(*rows.columns, *[F.col("__hot")[c].alias(c) for c in values])
    rest = marked.filter(F.col("__hot").isNull()).drop("__hot").join(known.filter(~is_hot).hint("merge"), key)
    return from_hot.unionByName(rest.select(*rows.columns, *values))


def hash_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of ``df``, those of smallest key hash.

    Rows beyond about four times the limit are dropped where they lie, so what
    the ordering gathers is bounded whatever the number of tasks.
    """
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), F.col(key)), 11) / F.lit(float(1 << 53))
    near = df.withColumn("__draw", draw).filter(F.col("__draw") * df.count() < 4 * limit + 100)
    return near.orderBy("__draw", key).limit(limit).drop("__draw")


def crc_sql(octets: str) -> str:
    """CRC-32 of a list of byte values, bit by bit (polynomial 0xEDB88320)."""
    bit = "lambda c, k: xor(c >> 1, (c & 1) * 3988292384::UBIGINT)"
    byte = f"lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]), {bit})"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {octets}), {byte}), 4294967295::UBIGINT)::BIGINT"
