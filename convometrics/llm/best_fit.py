"""Best-fit packing of documents into training sequences, under conflicts.

A bin holds at most ``capacity`` words, at most one piece of each duplicate
cluster and a limited number of pieces of each source: one (``one_per_source``), or
``SOURCE_SLACK`` times as many as a bin would hold if sources were spread evenly,
one at least (``source_limit="share"``), so that a corpus of few sources still fills
its bins.  A source then has as many bits in the bitmaps as a bin may hold
pieces of it, and its pieces take them in turn.  Open
bins lie ordered by what is left of them, and by the bitmaps of their sources
and clusters; for each piece, longest first, the search goes from the tightest
residual that can hold it to the next one up until a bin is compatible.

Documents longer than a bin are cut: full pieces are bins of their own, the
rest is packed.  Documents are dealt to shards of about ``DOCS_PER_SHARD`` by a
hash of the row, so a hot source or cluster is spread evenly; each shard packs
its own bins, and the last few bins of a shard are the cost.

``fill`` reports how full the bins are.

Defined cases: a null or empty text has no words and gets no piece (its one row
has a null bin, piece 0 and 0 words); null sources are one source; null cluster
ids conflict with nothing; very long texts are cut at the capacity; ties of size go in
the order of the rows as they were written; rows that repeat a doc_id are documents of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convometrics.llm.common import normalised, stored, word_count

CAPACITY = 2048
DOCS_PER_SHARD = 2000
SOURCE_SLACK = 2
PACKED = "doc_id long, piece long, n_words long, bin_id string, bin_start long, first_word long"


class Bins:
    """Open bins of one shard by residual, then by bitmap: bins of equal bitmap are equally compatible."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_residual: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
        self.present = 0  # bit r: some open bin has residual r
        self.used: list[int] = []  # words in each bin

    def place(self, size: int, conflicts: int) -> tuple[int, int]:
        """(bin, start): the tightest compatible bin, or a new one."""
        left = self.present >> size
        residual = size
        while left:
            step = (left & -left).bit_length() - 1  # successor: the next residual up that some bin has
            residual += step
            for bitmap, bins in self.by_residual[residual].items():
                if not bitmap & conflicts:
                    number = bins.pop()
                    if not bins:
                        del self.by_residual[residual][bitmap]
                        if not self.by_residual[residual]:
                            self.present &= ~(1 << residual)
                    return number, self._put(number, size, bitmap | conflicts)
            left >>= step + 1
            residual += 1
        self.used.append(0)
        return len(self.used) - 1, self._put(len(self.used) - 1, size, conflicts)

    def _put(self, number: int, size: int, bitmap: int) -> int:
        start = self.used[number]
        self.used[number] = start + size
        residual = self.capacity - start - size
        if residual:
            self.by_residual[residual].setdefault(bitmap, []).append(number)
            self.present |= 1 << residual
        return start


def source_limits(sources: list, sizes: list[int], capacity: int) -> dict:
    """Pieces of each source that a bin may hold: its share of the pieces of a full bin, with slack, one at least."""
    count: dict = {}
    for s in sources:
        count[s] = count.get(s, 0) + 1
    words = sum(sizes)
    per_word = SOURCE_SLACK * capacity / words if words else 0.0
    return {s: max(1, int(-(-n * per_word // 1))) for s, n in count.items()}


def pack_shard(rows: pd.DataFrame, capacity: int, one_per_source: bool, by_share: bool = False) -> pd.DataFrame:
    """Pack one shard: rows of shard, doc_id, source, cluster, size, row (a tie-breaker)."""
    shard = int(rows["shard"].iloc[0])
    rows = rows.sort_values(["size", "row"], ascending=[False, True], kind="stable")
    bits: dict = {}
    source = rows["source"].astype(object).where(rows["source"].notna(), None).tolist()
    limits: dict = {}
    if one_per_source:
        limits = dict.fromkeys(source, 1)
    elif by_share:
        left = [(s, int(n) % capacity) for s, n in zip(source, rows["size"]) if int(n) % capacity]
        limits = source_limits([s for s, _ in left], [n for _, n in left], capacity)
    turn: dict = {}  # pieces of each source so far
    again = rows["cluster"].dropna()
    again = set(again[again.duplicated()])  # a cluster that comes once here conflicts with nothing
    bins, full, out = Bins(capacity), 0, []
    rests = []
    for doc, s, cluster, size, row in zip(rows["doc_id"], source, rows["cluster"], rows["size"], rows["row"]):
        doc = None if pd.isna(doc) else int(doc)
        size = int(size)
        if not size:
            out.append((doc, 0, 0, None, None, 0))
            continue
        whole, rest = divmod(size, capacity)
        for piece in range(whole):
            out.append((doc, piece, capacity, f"{shard}-f{full}", 0, piece * capacity))
            full += 1
        if rest:
            conflicts = 0
            if s in limits:
                turn[s] = turn.get(s, -1) + 1
                conflicts = bits.setdefault(("source", s, turn[s] % limits[s]), 1 << len(bits))
            if cluster in again:
                conflicts |= bits.setdefault(("cluster", cluster), 1 << len(bits))
            rests.append((-rest, int(row), doc, whole, conflicts))
    rests.sort()
    for less, _, doc, whole, conflicts in rests:
        number, start = bins.place(-less, conflicts)
        out.append((doc, whole, -less, f"{shard}-{number}", start, whole * capacity))
    made = pd.DataFrame(out, columns=["doc_id", "piece", "n_words", "bin_id", "bin_start", "first_word"], dtype=object)
    return made.astype({k: "Int64" for k in ("doc_id", "piece", "n_words", "bin_start", "first_word")})


def pack(
    docs: DataFrame, capacity: int = CAPACITY, one_per_source: bool = True, cluster: str | None = None, source_limit: str | None = None
) -> DataFrame:
    """One row per piece: doc_id, piece, n_words, bin_id, bin_start, first_word.

    ``cluster``: the column that holds a document's duplicate cluster; by
    default the digest of its normalised text, so that exact copies conflict.
    ``source_limit="share"`` replaces ``one_per_source``.
    """
    if source_limit not in (None, "share"):
        raise ValueError(f"source_limit: {source_limit}")
    by_share = source_limit == "share"
    mark = F.col(cluster).cast("string") if cluster else F.sha2(normalised().cast("binary"), 256)
    rows = stored(
        docs.select(
            "doc_id", "source", mark.alias("cluster"), word_count("text").alias("size")
        ),
        "pack-sizes",
    )
    shards = max(1, -(-rows.count() // DOCS_PER_SHARD))
    row = F.monotonically_increasing_id()  # of files that stay as they are: the same in every attempt
    dealt = rows.withColumn("row", row).withColumn("shard", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(lambda part: pack_shard(part, capacity, one_per_source and not by_share, by_share), PACKED)


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: bins, words, and the share of the bins' room that words take."""
    one = packed.filter("bin_id IS NOT NULL").agg(F.countDistinct("bin_id").alias("bins"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"))
    room = F.col("bins") * F.lit(capacity)
    return one.withColumn("fill", F.when(room > 0, F.col("words") / room).otherwise(F.lit(0.0)))
