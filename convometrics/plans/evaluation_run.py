"""The whole evaluation run, as Spark jobs.

ChatML JSONL (S1) -> transcript and gold (V7) -> extraction prompt (T5/T6) ->
caller's model (X1; outputs written once) -> parse/validate/defaults (P2-P5)
-> field matches (E1-E3) -> results and outputs datasets (S5/S6) -> one-pass
aggregates (E4-E6) -> report (E9).

Lines are classified and written once; gold text, file and line number travel
with the prompt through the model call, so nothing is joined and a line number
that occurs in several files stays apart.  Failures, errors, results and the
report's lines are complete datasets; only one row of counts reaches the driver.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stage import materialize
from ..operators import evaluate as ev
from ..operators import extract as ex
from ..operators import messages as msg
from ..operators import repair as rp
from ..operators import report as rep
from ..session import configure, scratch_path
from ..sources import chatml
from .ops_queries import write_eval_outputs, write_eval_results


@dataclass
class EvalRun:
    summary: dict
    report: str  # the fixed-size part; the complete text is at report_path
    results_path: str
    summary_path: str
    outputs_path: str
    failures_path: str
    errors_path: str
    report_path: str
    quarantine: DataFrame


def run_evaluation(
    spark: SparkSession,
    eval_path: str | list[str],
    factory: ex.ModelFactory,
    out_dir: str | None = None,
    mode: str = "failfast",
    system_prompt: str | None = None,
    num_partitions: int | None = None,
    batch_size: int = 1,
    title: str = "Evaluation Report",
    chunks: int = 1,
) -> EvalRun:
    """Run a model over an evaluation set and write everything under ``out_dir``.

    ``mode="failfast"`` raises, before any model call, on the first bad line and
    on gold that is not JSON; ``"quarantine"`` sets bad lines aside and counts
    bad gold as an error row.  ``num_partitions`` deals the prompts anew for the
    model calls.  A run that died is continued by the same call with the same
    ``out_dir``: rows whose model output was committed are not asked again;
    ``chunks`` is the number of steps in which outputs are committed.
    """
    configure(spark)
    out_dir = (out_dir or scratch_path(spark, "eval-run")).rstrip("/")
    good, bad = chatml.read_chatml(spark, eval_path, mode, store=f"{out_dir}/lines")
    layout = [c for c in good.columns if c not in ("record", "messages", "n_messages", "line_num", "file_path")]
    prepared = rp.transcript_and_gold(good).drop("record", "messages")
    if mode == "failfast":
        wrong = prepared.filter(~F.col("gold_ok")).agg(
            F.min(F.struct("file_path", "line_num")).alias("first")
        ).first()["first"]
        if wrong is not None:
            raise ValueError(f"{wrong['file_path']} line {wrong['line_num']}: {ev.BAD_GOLD}")
    sp = F.lit(system_prompt) if system_prompt is not None else None
    prompts = prepared.select(
        "file_path",
        *layout,
        "line_num",
        F.when(F.col("gold_ok"), F.col("gold_json")).alias("gold_json"),
        msg.chat_template(msg.extraction_messages(F.col("transcript"), sp), add_generation_prompt=True).alias("prompt"),
    )
    if num_partitions:
        prompts = prompts.repartition(num_partitions)
    # model outputs are written once: retries, recomputation and fan-out never call the model again
    keep = ["file_path", *layout, "line_num"]
    carry = ["file_path", *layout, "gold_json", "_asked"]
    called = ex.run_once(
        prompts, ["file_path", "line_num"], ["prompt", "gold_json"], f"{out_dir}/model_outputs",
        lambda todo: ex.run_model(todo, factory, "line_num", "prompt", carry=carry, batch_size=batch_size), chunks,
    )
    scored = materialize(ev.evaluate_rows(called, keep), f"{out_dir}/scored")

    write_eval_outputs(scored, f"{out_dir}/outputs", keep)
    counts = ev.summary_counts(scored)
    write_eval_results(scored, counts, f"{out_dir}/results", f"{out_dir}/summary", keep)
    failures = materialize(ev.strict_failures(scored, *keep), f"{out_dir}/failures")
    errors = materialize(ev.runtime_errors(scored, *keep), f"{out_dir}/errors")
    summary = rep.summary_of(counts.first().asDict())
    name = ", ".join(os.path.basename(p.rstrip("/")) for p in ([eval_path] if isinstance(eval_path, str) else eval_path))
    rep.write_report(rep.report_lines(name, summary, failures, errors, title), f"{out_dir}/report")
    text = "\n".join([
        *rep.head_lines(name, summary, title),
        "",
        f"{summary['valid'] - summary['strict_correct']} lines, in {out_dir}/failures",
        "",
        rep.ERRORS_HEADING,
        "",
        f"{summary['errors']} lines, in {out_dir}/errors",
        "",
    ])
    paths = [f"{out_dir}/{d}" for d in ("results", "summary", "outputs", "failures", "errors", "report")]
    return EvalRun(summary, text, *paths, bad)
