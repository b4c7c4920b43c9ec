"""The evaluation report (E9): its fixed-size tables, and its complete lists as a dataset.

The wording is fixed; the values come from one row of counts.  Failures and
errors are lines of a DataFrame, never a driver-side list.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SCORED_FIELDS

# The wording of the report.
HEADER = """# {title}

**Eval file:** `{name}`  
**Total examples:** {total}  
**Valid (no runtime error):** {valid}  
**Errors:** {errors}  

## Summary
"""
STRICT_LABEL = "Strict accuracy (all key fields match)"
LATENCY_LABELS = ("Latency (mean)", "Latency (min / max)", "Latency (total)")
FIELDS_HEADING = "## Per-field accuracy"
FAILURES_HEADING = "## Failures (strict)"
NO_FAILURES = "None."
ERRORS_HEADING = "## Runtime errors"

HEAD, FAILURE, ERROR_HEAD, ERROR, END = range(5)


def percent(part: int, whole: int) -> str:
    """Share to a tenth of a percent, half to even."""
    return f"{part / whole if whole else 0:.1%}"


def markdown_table(columns: Iterable[str], dashes: Iterable[int], rows: Iterable[Iterable[str]]) -> list[str]:
    body = [list(columns), *map(list, rows)]
    lines = ["| " + " | ".join(r) + " |" for r in body]
    return [lines[0], "|" + "|".join("-" * n for n in dashes) + "|", *lines[1:]]


def summary_of(counts: dict) -> dict:
    """The summary document from the row of ``evaluate.summary_counts``."""
    total, valid = counts["total"], counts["valid"]
    seconds = {k: (counts[f"latency_ms_{k}"] or 0) / 1000 for k in ("total", "min", "max")}
    return {
        "total": total,
        "valid": valid,
        "errors": total - valid,
        "strict_correct": counts["strict_correct"],
        "strict_accuracy": counts["strict_correct"] / valid if valid else 0,
        "correct": {f: counts[f] for f in SCORED_FIELDS},
        "per_field_accuracy": {f: (counts[f] / valid if valid else 0) for f in SCORED_FIELDS},
        "latency": {"mean": seconds["total"] / total if total else 0, **seconds},
    }


def summary_rows(summary: dict) -> list[list[str]]:
    lat, s = summary["latency"], summary
    values = (f"{lat['mean']:.2f}s", f"{lat['min']:.2f}s / {lat['max']:.2f}s", f"{lat['total']:.2f}s")
    strict = f"{percent(s['strict_correct'], s['valid'])} ({s['strict_correct']}/{s['valid']})"
    return [[STRICT_LABEL, strict], *map(list, zip(LATENCY_LABELS, values))]


def field_rows(summary: dict) -> list[list[str]]:
    return [[f, f"{n}/{summary['valid']}", percent(n, summary["valid"])] for f, n in summary["correct"].items()]


def head_lines(name: str, summary: dict, title: str = "Evaluation Report") -> list[str]:
    """The report down to the heading of the failures."""
    counts = {k: summary[k] for k in ("total", "valid", "errors")}
    return [
        *HEADER.format(title=title, name=name, **counts).split("\n"),
        *markdown_table(("Metric", "Value"), (8, 8), summary_rows(summary)),
        "",
        FIELDS_HEADING,
        "",
        *markdown_table(("Field", "Correct", "Accuracy"), (7, 9, 10), field_rows(summary)),
        "",
        FAILURES_HEADING,
    ]


def report_lines(name: str, summary: dict, failures: DataFrame, errors: DataFrame, title: str = "Evaluation Report") -> DataFrame:
    """The complete report: ``section, file_path, line_num, pos, line``, in that order.

    ``failures``: file_path, line_num, missed; ``errors``: file_path, line_num, error.
    """
    spark = failures.sparkSession
    clean = summary["strict_correct"] == summary["valid"]
    rows = [(HEAD, i, t) for i, t in enumerate(head_lines(name, summary, title) + (["", NO_FAILURES] if clean else []))]
    if summary["errors"]:
        rows += [(ERROR_HEAD, 0, ""), (ERROR_HEAD, 1, ERRORS_HEADING)]
    fixed = spark.createDataFrame([*rows, (END, 0, "")], "section int, pos int, line string")
    fixed = fixed.select("section", F.lit("").alias("file_path"), F.lit(0).cast("long").alias("line_num"), "pos", "line")

    def listed(df: DataFrame, section: int, text) -> DataFrame:
        return df.select(F.lit(section).alias("section"), "file_path", "line_num", F.lit(0).alias("pos"), text.alias("line"))

    number = F.col("line_num").cast("string")
    failed = listed(failures, FAILURE, F.concat(F.lit("- **Line "), number, F.lit("**: missed "), F.col("missed")))
    broken = listed(errors, ERROR, F.concat(F.lit("- Line "), number, F.lit(": "), F.col("error")))
    return fixed.unionByName(failed).unionByName(broken)


def write_report(lines: DataFrame, path: str) -> None:
    """Write the report's lines as text, range-sorted: the part files in name order are the report."""
    order = ["section", "file_path", "line_num", "pos"]
    one_line = F.regexp_replace("line", r"[\r\n]+", " ")  # a text sink holds a line a row
    lines.withColumn("line", one_line).orderBy(*order).select("line").write.mode("overwrite").text(path)
