"""Training-log tables (L1-L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loss_summary(log: DataFrame, step: str = "step", loss: str = "loss") -> DataFrame:
    """L2: steps, initial/final loss (by step), mean (exact decimal sum), min, max."""
    exact_sum = F.sum(F.col(loss).cast("decimal(38,6)")).cast("double")
    return log.agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.min_by(loss, step).alias("initial_loss"),
        F.max_by(loss, step).alias("final_loss"),
        (exact_sum / F.count(F.lit(1))).alias("mean_loss"),
        F.min(loss).alias("min_loss"),
        F.max(loss).alias("max_loss"),
    )


def run_throughput(runs: DataFrame, per_device_batch: int = 2, grad_accum: int = 4) -> DataFrame:
    """L3: derived throughput from ``run, steps, runtime_sec, n_examples``."""
    eb = per_device_batch * grad_accum
    samples = (F.col("steps") * eb).cast("double")
    return runs.select(
        "run",
        "steps",
        "runtime_sec",
        "n_examples",
        F.lit(eb).alias("effective_batch"),
        (samples / F.col("n_examples")).alias("epochs"),
        F.when(F.col("steps") > 0, F.col("runtime_sec") / F.col("steps")).otherwise(0.0).alias("sec_per_step"),
        F.when(F.col("runtime_sec") > 0, samples / F.col("runtime_sec")).otherwise(0.0).alias("samples_per_sec"),
    )
