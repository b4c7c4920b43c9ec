"""Synthetic scenario grid, seeded draws and generation prompts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import ustrip
from ..functions.stage import materialize, stage
from ..schema import CHANNELS, GENERATION_PROMPT_TEMPLATE, PERSONAS, SCENARIOS
from ..sources.chatml import append_jsonl
from . import extract as ex
from .messages import prompt_frame, training_messages
from .payload import explode_payload, parse_replies, serialize, validate, with_metrics

AXES = {"channel": CHANNELS, "persona": PERSONAS, "scenario": SCENARIOS}


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def scenario_grid(spark: SparkSession) -> DataFrame:
    """G1: all 3 x 8 x 8 = 192 cells, derived from a row index (no join)."""
    n_p, n_s = len(PERSONAS), len(SCENARIOS)
    i = F.col("id")
    return spark.range(len(CHANNELS) * n_p * n_s).select(
        (i / (n_p * n_s)).cast("int").alias("channel_idx"),
        ((i / n_s).cast("long") % n_p).cast("int").alias("persona_idx"),
        (i % n_s).cast("int").alias("scenario_idx"),
    )


def draw(seed: int, axis: str, sample_id: Column, n: int) -> Column:
    """Seeded uniform draw in [0, n): first 32 bits of md5(seed:axis:id).  Reproducible in SQL."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(axis), sample_id.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % n).cast("int")


def sample_scenarios(samples: DataFrame, sample_id: str, seed: int = 42) -> DataFrame:
    """One independent draw per axis for every sample row."""
    sid = F.col(sample_id)
    return samples.select(
        sample_id,
        *[draw(seed, a, sid, len(v)).alias(f"{a}_idx") for a, v in AXES.items()],
    )


def with_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({a: _pick(v, F.col(f"{a}_idx")) for a, v in AXES.items()})


def render_prompt(channel: Column, persona: Column, scenario: Column) -> Column:
    """The generation prompt for one (channel, persona, scenario)."""
    pieces = []
    rest = GENERATION_PROMPT_TEMPLATE
    for name, col in (("{channel}", channel), ("{persona}", persona), ("{scenario}", scenario)):
        before, rest = rest.split(name, 1)
        pieces += [F.lit(before), col]
    pieces.append(F.lit(rest))
    return F.concat(*pieces)


# ---------------------------------------------------------------------------
# G4 the whole pipeline
# ---------------------------------------------------------------------------


@dataclass
class SyntheticRun:
    outcomes: DataFrame  # one row per sample: key, status (ok / generation_failed / extraction_failed), error, attempts
    rows_path: str  # appended training rows


def run_pipeline(
    samples: DataFrame, key: str, prompt: str, generator, labeller, out_dir: str, sleep=None, batch: str = "rows", chunks: int = 1
) -> SyntheticRun:
    """Generate, label, validate and append (S4); failed samples keep their reason.

    One pass per sample over both models, with one retry delay carried from
    generation to labelling.  A label that is not valid after parsing (P3-P5)
    fails the sample.  The run may be repeated with the same ``out_dir``: model
    outputs are kept in ``chunks`` steps and not made twice (``extract.run_once``),
    and the rows of a ``batch`` id are appended once.
    """
    before, after = prompt_frame(samples.sparkSession)
    stages = [("generation", generator, ex.not_blank), ("extraction", labeller, None, lambda t: before + t.strip() + after)]
    made = ex.run_once(
        samples, [key], [prompt], f"{out_dir}/model_outputs",
        lambda todo: ex.run_stages(todo, key, prompt, stages, sleep=sleep, outputs=True, carry=["_asked"]), chunks,
    )
    replies = made.withColumnsRenamed({"status": "stage_status", "error": "stage_error"})
    parsed = explode_payload(stage(parse_replies(replies, "output", "stage_error")))
    checked = stage(with_metrics(validate(parsed)))
    bad_label = (F.col("stage_status") == "ok") & (F.col("status") != "valid")
    joined = checked.select(
        key,
        F.when(bad_label, F.lit("extraction_failed")).otherwise(F.col("stage_status")).alias("status"),
        F.when(bad_label, F.coalesce("error", F.concat_ws("; ", "violations"))).otherwise(F.col("stage_error")).alias("error"),
        "generation_attempts",
        "extraction_attempts",
        "generation_output",
        serialize(F.col("metrics")).alias("label"),
    )
    joined = materialize(joined, f"{out_dir}/labelled")
    rows_path = f"{out_dir}/rows"
    ok = joined.filter(F.col("status") == "ok")
    append_jsonl(ok.select(training_messages(ustrip(F.col("generation_output")), F.col("label")).alias("messages")), rows_path, batch)
    attempts = ["generation_attempts", "extraction_attempts"]
    return SyntheticRun(joined.select(key, "status", "error", *attempts), rows_path)
