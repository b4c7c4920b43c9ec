"""Plan-shape helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage(df: DataFrame) -> DataFrame:
    """Evaluate every column of ``df`` once, as a unit, before later operators use them.

    Catalyst substitutes projected expressions into filters pushed below them and
    into collapsed projections.  For the layered JSON parsing here that
    multiplies expression trees (each layer references the previous one several
    times).  A one-element ``inline`` (a Generate node) is a boundary neither
    rule crosses: filters on its output stay above it, and projections on each
    side collapse separately.  It runs inside whole-stage codegen, costs one
    struct per row and no I/O or shuffle.  It also stops column pruning: every
    column of ``df`` is computed, so select what is needed before it.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often and under whatever conditions the body uses it.

    A one-element ``transform`` binds it.  The projection that holds it is
    compiled on its own, in small methods, instead of within whole-stage code:
    large trees over long texts are faster that way.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spread(df: DataFrame, num_partitions: int) -> DataFrame:
    """Deal the rows evenly to ``num_partitions``, for CPU-bound work on rows of a few bytes.

    The number is the caller's: nothing of ``df`` is run to decide.
    """
    return df.repartition(num_partitions)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once (parquet, in the shared checkpoint area) and read it back.

    Used after expensive or non-deterministic steps (model calls) so later
    fan-out never recomputes them, and to cut lineage: a lost executor then
    re-reads files instead of re-running the model.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
