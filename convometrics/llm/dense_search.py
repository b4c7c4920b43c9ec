"""Ranked lexical search by dense blocked matrix multiplication.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters,
A-Z lower-cased.  A document's impact of a term is a whole number below 10^6, a
term's weight a whole number, and a score the sum of weight x impact over the
terms of an item (repeats included).

1. Items are dealt by hash to groups of about ``GROUP_TERMS`` terms; only one
   group at a time is in the driver and in the tasks, whatever the number of items.
2. One pass over all texts writes, for each document, its number of terms and
   the (column, frequency) pairs of terms that some item of the group has; N, L
   and the document frequencies are sums over what was written.
3. The group's items are cut to tiles of ``ITEM_TILE`` items, each with a compact
   vocabulary (its own terms only) cut to tiles of columns.  Columns go together
   as long as no item's weights times the greatest impact can reach 2^53, so
   every partial product of float64 matrices is exact; the products of the tiles
   are added as 64-bit integers.  A weight too large for one column stands in
   several.
4. Tiles of document impacts are multiplied with each item tile (BLAS).  A tile
   keeps every document whose score reaches the k-th best of the tile, then the
   smallest ids of those tied at the edge.  The best of the tasks meet in two
   steps, so that no task reads more than a thousandth of them.

Defined cases: a null or empty text (of a document or an item) has no term; such
a document has no rank and does not count in N, such an item no row.  Very long
texts are read whole, a slice at a time, and a very long item is spread over as
many column tiles as it needs.  Ties go by ascending doc_id, a null doc_id last;
rows that repeat a doc_id are documents of their own; rows that repeat an
item_id and its text are one item, an item_id with two texts is two items, each
ranked by itself.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convometrics.llm.common import byte_view, map_texts, small_batches, span_hashes, split_spans, stored

K = 20
GROUP_TERMS = 1 << 18
ITEM_TILE = 256
COLUMN_TILE = 1024
DOC_TILE = 512
MAX_IMPACT = 1_000_000  # 10^9 tf / (1000 tf + 12 m) is less
EXACT = 1 << 53

IS_TERM = np.ones(256, dtype=bool)
IS_TERM[:128] = [chr(c).isalnum() for c in range(128)]


class Vocabulary:
    """Terms numbered in order of their hashes; ``columns`` finds the numbers of terms in a text."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        end = np.cumsum([len(t) for t in terms], dtype=np.int64)
        start = end - [len(t) for t in terms]
        hashes = span_hashes(data, start, end)
        order = np.argsort(hashes)
        self.data, self.start, self.end, self.hashes = data, start[order], end[order], hashes[order]
        if len(np.unique(hashes)) < len(terms):
            raise ValueError("two terms of the items share a 64-bit hash")

    def columns(self, folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The column of each span of ``folded``, -1 where it is no term of the vocabulary (compared byte by byte)."""
        found = np.full(len(start), -1, np.int64)
        if not len(start) or not len(self.hashes):
            return found
        h = span_hashes(folded, start, end)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        likely = np.flatnonzero(self.hashes[at] == h)
        at, size = at[likely], (end - start)[likely]
        likely, at = likely[same := size == (self.end - self.start)[at]], at[same]
        size = size[same]
        if len(likely):
            first = np.concatenate(([0], np.cumsum(size)[:-1]))
            inner = np.arange(int(size.sum())) - np.repeat(first, size)
            equal = folded[np.repeat(start[likely], size) + inner] == self.data[np.repeat(self.start[at], size) + inner]
            right = np.logical_and.reduceat(equal, first)
            found[likely[right]] = at[right]
        return found


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


def terms_of(text: bytes | None) -> list[bytes]:
    data = fold(np.frombuffer(text or b"", np.uint8))
    start, end = split_spans(data, np.array([0, len(data)]), IS_TERM)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(start.tolist(), end.tolist())]


def _frequencies(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, n, columns, counts) of every document; the pairs are those of terms in ``words``."""

    def look(texts):
        data, off = byte_view(texts)
        data = fold(data)
        start, end = split_spans(data, off, IS_TERM)
        cut = np.searchsorted(start, off)
        n = np.diff(cut)
        column = words.columns(data, start, end)
        hit = np.flatnonzero(column >= 0)
        doc = np.repeat(np.arange(len(n)), n)[hit]
        pair, count = np.unique(doc * len(words.hashes) + column[hit], return_counts=True)
        of, column = np.divmod(pair, max(1, len(words.hashes)))
        at = np.searchsorted(of, np.arange(len(n) + 1)).astype(np.int32)
        lists = lambda v: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v.astype(np.int32)))
        return {"n": n.astype(np.int64), "columns": lists(column), "counts": lists(count)}

    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(typed, look, "doc_id long, n long, columns array<int>, counts array<int>", ["doc_id"])


def column_tiles(weights: dict[tuple[int, int], int], n_items: int, limit: int = (EXACT - 1) // MAX_IMPACT, width: int = COLUMN_TILE):
    """(columns, (rows, items, weights)) tiles whose entries sum to ``weights``.

    ``weights``: {(column, item): weight}.  In a tile no item's weights sum to
    more than ``limit``, and there are at most ``width`` columns.  Tiles travel
    as entries; ``dense`` makes the float64 matrix (columns x items) of one.
    """
    by_column: dict[int, list] = {}
    for (column, item), weight in sorted(weights.items()):
        if weight > 0:
            by_column.setdefault(column, []).append([item, weight])
    tiles, columns, entries, sums = [], [], [], np.zeros(n_items, np.int64)

    def close():
        nonlocal columns, entries, sums
        if columns:
            row, item, weight = (np.array(v) for v in zip(*entries))
            tiles.append((np.array(columns), (row, item, weight.astype(np.float64))))
        columns, entries, sums = [], [], np.zeros(n_items, np.int64)

    for column, left in by_column.items():
        while left:
            here = [(item, min(weight, limit)) for item, weight in left]
            if len(columns) == width or any(sums[item] + part > limit for item, part in here):
                close()
            columns.append(column)
            for item, part in here:
                entries.append((len(columns) - 1, item, part))
                sums[item] += part
            left = [[item, weight - limit] for item, weight in left if weight > limit]
    close()
    return tiles


def dense(shape: tuple[int, int], row: np.ndarray, column: np.ndarray, value: np.ndarray) -> np.ndarray:
    matrix = np.zeros(shape)
    matrix[row, column] = value
    return matrix


def tile_top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best ``k`` positive scores, ties by ascending id."""
    at = np.flatnonzero(scores > 0)
    if len(at) > k:
        edge = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= edge]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


NO_ID = np.iinfo(np.int64).max  # a null doc_id, ranked last


def _multiply(rows: DataFrame, tiles: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): for each task and item its best ``k`` documents.

    ``tiles``: (item numbers, column tiles) of every item tile.
    """

    def run(batches):
        best: dict[int, tuple] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(at, DOC_TILE)
                ids = part.column("doc_id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
                n = part.column("n").to_pylist()
                m = np.array([75 + 25 * x * n_docs // n_terms for x in n], np.int64)  # whole numbers of any size in Python
                sizes = np.array([len(x) for x in part.column("columns")], np.int64)
                row = np.repeat(np.arange(len(n)), sizes)
                column = part.column("columns").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
                order = np.argsort(column, kind="stable")
                row, column, impact = row[order], column[order], impact[order].astype(np.float64)
                for items, columns in tiles:
                    scores = np.zeros((len(n), len(items)), np.int64)
                    for used, entries in columns:
                        place = np.searchsorted(used, column)
                        place[place == len(used)] = 0
                        here = used[place] == column
                        if not here.any():
                            continue
                        impacts = dense((len(n), len(used)), row[here], place[here], impact[here])
                        scores += (impacts @ dense((len(used), len(items)), *entries)).astype(np.int64)
                    for j in np.flatnonzero(scores.any(axis=0)):
                        top = tile_top(scores[:, j], ids, k)
                        item, found, held = items[j], scores[top, j], ids[top]
                        if item in best:
                            found = np.concatenate((best[item][0], found))
                            held = np.concatenate((best[item][1], held))
                            keep = tile_top(found, held, k)
                            found, held = found[keep], held[keep]
                        best[item] = (found, held)
        if best:
            count = [len(found) for found, _ in best.values()]
            ids = np.concatenate([held for _, held in best.values()])
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array(np.repeat(list(best), count), pa.int64()),
                    "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                    "score": pa.array(np.concatenate([found for found, _ in best.values()]), pa.int64()),
                }
            )

    return rows.filter("n > 0 AND size(columns) > 0").mapInArrow(run, "item long, doc_id long, score long")


def best_of(rows: DataFrame, key: list[str], k: int) -> DataFrame:
    """The ``k`` rows of each key with the highest score, ties by ascending doc_id (null last), with their rank."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def _search_group(docs: DataFrame, items: list, k: int) -> DataFrame:
    """(item_id, text_key, rank, doc_id, score) for a group of items: (item_id, text_key, terms)."""
    spark = docs.sparkSession
    names = sorted({t for _, _, terms in items for t in terms})
    words = Vocabulary(names)
    column = dict(zip(names, words.columns(*_spans_of(names)).tolist()))
    found = stored(_frequencies(docs, words), "search-frequencies")
    n_docs, n_terms = found.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    held = found.select(F.explode("columns").alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("df"))
    df = np.zeros(len(names), np.int64)
    for r in held.collect():  # at most one row for each term of the group
        df[r["column"]] = r["df"]
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df]
    tiles = []
    for at in range(0, len(items), ITEM_TILE):
        entries: dict[tuple[int, int], int] = {}
        part = items[at : at + ITEM_TILE]
        for j, (_, _, terms) in enumerate(part):
            for t in terms:
                entries[column[t], j] = entries.get((column[t], j), 0) + weight[column[t]]
        tiles.append((np.arange(at, at + len(part)), column_tiles(entries, len(part))))
    tops = stored(_multiply(found, tiles, n_docs, max(1, n_terms or 0), k).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(1024))), "search-tops")
    best = best_of(best_of(tops, ["item", "part"], k).drop("rank"), ["item"], k)
    named = spark.createDataFrame([(i, item_id, key) for i, (item_id, key, _) in enumerate(items)], "item long, item_id long, item_key long")
    return best.join(F.broadcast(named), "item").select("item_id", "item_key", "rank", "doc_id", "score")


def _spans_of(names: list[bytes]):
    size = np.array([len(t) for t in names], np.int64)
    end = np.cumsum(size)
    return np.frombuffer(b"".join(names), np.uint8), end - size, end


def search(docs: DataFrame, items: DataFrame, k: int = K, group_terms: int = GROUP_TERMS) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score (above 0) and item_key.

    ``docs``: doc_id, text; ``items``: item_id, text.  item_key tells apart the
    texts of an item_id that has several.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce("text", F.lit(""))
    one = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).distinct()
    one = one.withColumn("item_key", F.xxhash64("item_id", "text"))
    size = one.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // (2 * group_terms)))  # a term and its separator are two bytes at least
    one = stored(one.withColumn("part", F.pmod("item_key", F.lit(groups))), "search-items")
    out = None
    for g in range(groups):
        mine = [(r["item_id"], r["item_key"], terms_of(r["text"].encode())) for r in one.filter(F.col("part") == g).collect()]
        mine = sorted((x for x in mine if x[2]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if mine:
            found = _search_group(docs, mine, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long, item_key long")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "item_key")


ORACLE = """
WITH lower_docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents
),
d AS (SELECT doc_id, t, len(t) AS n FROM lower_docs WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
),
item AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
),
asked AS (SELECT item_id, term, count(*) AS qtf FROM item GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id,
         sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN d USING (doc_id), total
  GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""
