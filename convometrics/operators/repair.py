"""JSONL repair and validation as corpus jobs (V1-V7).

Per-line rules are column expressions (``instr``/``substring``/``replace``);
the corpus jobs are projections plus one ``groupBy`` for the summary.
``write_repaired`` and ``write_normalized`` write to a new versioned directory
(Spark does not overwrite what it reads); ``publish_lines`` makes such a directory
the current version of a corpus, with a way back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import parse_strict, find0, is_object, json_escape, json_quote, json_valid, rfind0, slice0, ustrip, vget, vtype
from ..functions.stage import let, materialize, stage
from ..schema import GROUPS
from ..session import scratch_path
from ..sources.commits import Versions

# Literal markers of the hand-written eval lines (compact and spaced variants).
USER_MARKERS = [
    ('"role":"user","content":"', '"},{"role":"assistant"'),
    ('"role": "user", "content": "', '"}, {"role": "assistant"'),
]
ASSISTANT_MARKERS = ['"role":"assistant","content":"', '"role": "assistant", "content": "']
END_MARKER = '"}]}'


def repair_line(line: Column, legacy: bool = False) -> Column:
    """V3: rebuild one line with user and assistant content escaped; NULL when the structure is not found.

    ``legacy=True`` keeps the reference's off-by-one (the first content character
    is left unescaped); the default escapes the whole content.
    """
    # every search runs once a line, the second form only where the first is not found

    def user_turn(text: Column, start_m: str, end_m: str) -> Column:
        def span(i: Column) -> Column:
            us = i + len(start_m)
            return let(F.when(i >= 0, find0(text, end_m, us)), lambda j: F.when(j >= 0, F.struct(us.alias("start"), j.alias("end"))))

        return let(find0(text, start_m), span)

    def asst_start(text: Column, marker: str) -> Column:
        return let(find0(text, marker), lambda i: F.when(i >= 0, i + len(marker)))

    def positions(text: Column) -> Column:
        user = F.coalesce(*[user_turn(text, *m) for m in USER_MARKERS])
        asst = F.coalesce(*[asst_start(text, m) for m in ASSISTANT_MARKERS])
        return F.struct(user.alias("user"), asst.alias("asst"), rfind0(text, END_MARKER).alias("ast_end"))

    skip = 1 if legacy else 0

    def rebuilt(text: Column, p: Column) -> Column:
        user_start, user_end, ast_start, ast_end = p["user"]["start"], p["user"]["end"], p["asst"], p["ast_end"]
        user_content = slice0(text, user_start + skip, user_end)
        asst = F.replace(slice0(text, ast_start + skip, ast_end), F.lit("\\\\\\\\n"), F.lit("\\\\n"))
        asst = json_escape(asst)
        for line_end in ("\r\n", "\n", "\r"):
            asst = F.replace(asst, F.lit(line_end), F.lit("\\n"))
        whole = F.concat(
            slice0(text, F.lit(0), user_start + skip),
            json_escape(user_content),
            slice0(text, user_end, ast_start + skip),
            asst,
            slice0(text, ast_end),
        )
        has_user_role = text.contains('"role":"user"') | text.contains('"role": "user"')
        ok = user_start.isNotNull() & ast_start.isNotNull() & (ast_end >= 0) & has_user_role
        return F.when(ok, whole)

    return F.when(ustrip(line) != "", let(line, lambda text: let(positions(text), lambda p: rebuilt(text, p))))


def repair_lines(lines: DataFrame, value: str = "value", legacy: bool = False) -> DataFrame:
    """V4: repair every non-blank line; ``status`` is ``fixed`` or ``unrepairable``."""
    df = lines.filter(ustrip(F.col(value)) != "")
    df = stage(df.withColumn("repaired", repair_line(F.col(value), legacy)))
    return df.withColumn("status", F.when(F.col("repaired").isNotNull(), "fixed").otherwise("unrepairable"))


def repair_summary(repaired: DataFrame) -> DataFrame:
    return repaired.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# V5 normalize-and-validate
# ---------------------------------------------------------------------------


def normalize_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """V5 on every line: ``outcome`` (kept / rewritten / dropped), ``reason``, ``normalized`` text.

    Rules: outer JSON parses, ``messages`` has at least 3 entries, the third
    entry's ``content`` is a string that parses as JSON -- directly, or after
    turning ``\\"`` into ``"`` (then the line is rewritten) -- and the inner
    object has the three groups.  Object-valued content is dropped here (the
    evaluation loader accepts it).  Rewritten lines are re-serialized compactly
    with every field of the record and of its messages, in their order; only
    the third content changes, to the text that parsed.
    """
    s = ustrip(F.col(value))
    df = stage(lines.withColumn("_s", s).withColumn("_v", parse_strict(F.col("_s"))))
    content = vget(F.col("_v"), "messages[2].content")
    df = stage(
        df.withColumn("_n", F.coalesce(F.size(F.try_variant_get(F.col("_v"), "$.messages", "array<variant>")), F.lit(0)))
        .withColumn("_ct", vtype(content))
        .withColumn("_c", F.try_variant_get(content, "$", "string"))
    )
    retry = F.replace(F.col("_c"), F.lit('\\"'), F.lit('"'))
    df = stage(
        df.withColumn("_ok1", json_valid(F.col("_c")))
        .withColumn("_c2", F.when(~F.col("_ok1"), retry))
        .withColumn("_ok2", F.coalesce(json_valid(F.col("_c2")), F.lit(False)))
    )
    inner_text = F.when(F.col("_ok1"), F.col("_c")).when(F.col("_ok2"), F.col("_c2"))
    df = stage(df.withColumn("_inner", parse_strict(inner_text)))
    inner_obj = is_object(F.col("_inner"))
    has_groups = inner_obj
    for g in GROUPS:
        has_groups = has_groups & vget(F.col("_inner"), g).isNotNull()
    reason = (
        F.when(F.col("_s") == "", F.lit("blank"))
        .when(F.col("_v").isNull(), F.lit("invalid_json"))
        .when(~is_object(F.col("_v")), F.lit("not_object"))
        .when(F.col("_n") < 3, F.lit("too_few_messages"))
        .when(F.col("_ct") != "string", F.lit("content_not_string"))
        .when(F.col("_inner").isNull(), F.lit("inner_invalid"))
        .when(~inner_obj, F.lit("inner_not_object"))
        .when(~has_groups, F.lit("missing_group"))
    )
    outcome = F.when(reason.isNotNull(), F.lit("dropped")).when(F.col("_ok1"), F.lit("kept")).otherwise(F.lit("rewritten"))
    # the record as text, field by field: maps keep the order of the fields, whatever they are
    fields = F.from_json(F.col("_s"), "map<string,variant>")
    msgs = F.from_json(F.col("_s"), "struct<messages: array<map<string,variant>>>").getField("messages")

    def object_text(entries: Column, value) -> Column:
        pairs = F.transform(F.map_entries(entries), lambda e: F.concat(json_quote(e["key"]), F.lit(":"), value(e)))
        return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))

    def plain(e: Column) -> Column:
        return F.coalesce(F.to_json(e["value"]), F.lit("null"))

    def message(m: Column, i: Column) -> Column:
        changed = object_text(m, lambda e: F.when(e["key"] == "content", json_quote(F.col("_c2"))).otherwise(plain(e)))
        return F.when(i == 2, changed).otherwise(object_text(m, plain))

    all_messages = F.concat(F.lit("["), F.array_join(F.transform(msgs, message), ","), F.lit("]"))
    rewritten = object_text(fields, lambda e: F.when(e["key"] == "messages", all_messages).otherwise(plain(e)))
    df = df.withColumn("reason", reason).withColumn("outcome", outcome)
    df = df.withColumn(
        "normalized",
        F.when(F.col("outcome") == "kept", F.col("_s")).when(F.col("outcome") == "rewritten", rewritten),
    )
    return stage(df.drop("_s", "_v", "_n", "_ct", "_c", "_ok1", "_c2", "_ok2", "_inner"))


def filter_valid(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V6: (kept lines, dropped line numbers with reason)."""
    kept = normalized.filter(F.col("outcome") != "dropped")
    dropped = normalized.filter(F.col("outcome") == "dropped")
    return kept, dropped


# ---------------------------------------------------------------------------
# S7 written corpora
# ---------------------------------------------------------------------------


def _write_lines(df: DataFrame, text: str, layout: list[str], path: str) -> None:
    """One text line a row, in the layout's directories, in line order within a file."""
    writer = df.select(*layout, F.col(text).alias("value")).write.mode("errorifexists")
    (writer.partitionBy(*layout) if layout else writer).text(path)


def _once(lines: DataFrame) -> DataFrame:
    """``lines`` written to scratch: the lines that stay and those that go are two jobs over one evaluation."""
    return materialize(lines, scratch_path(lines.sparkSession, "checked-lines"))


def write_repaired(repaired: DataFrame, path: str | None = None, layout: list[str] | None = None) -> str:
    """S7 of V4: repaired lines and the numbers of the others, in a new directory; returns it.

    ``layout``: partition columns of the corpus, kept as directories.  Lines stay
    in the order in which a task reads them.
    """
    layout = layout or []
    path = path or scratch_path(repaired.sparkSession, "repaired")
    repaired = _once(repaired.select(*layout, "line_num", "status", "repaired"))
    _write_lines(repaired.filter(F.col("status") == "fixed"), "repaired", layout, f"{path}/lines")
    repaired.filter(F.col("status") != "fixed").select(*layout, "line_num", "status").write.json(f"{path}/dropped")
    return path


def write_normalized(normalized: DataFrame, path: str | None = None, layout: list[str] | None = None) -> str:
    """S7 of V6: kept and rewritten lines, and dropped line numbers with their reason, in a new directory."""
    layout = layout or []
    path = path or scratch_path(normalized.sparkSession, "normalized")
    kept, dropped = filter_valid(_once(normalized.select(*layout, "line_num", "outcome", "reason", "normalized")))
    _write_lines(kept, "normalized", layout, f"{path}/lines")
    dropped.select(*layout, "line_num", "reason").write.json(f"{path}/dropped")
    return path


def publish_lines(lines: DataFrame, text: str, versions: Versions, layout: list[str] | None = None, **note) -> str:
    """Make ``lines`` the current version of a corpus, once they are written, read back and counted.

    The version before stays where it is and can be made current again
    (``Versions.rollback``); a job that dies on the way leaves it current.  ``lines``
    are evaluated twice, to count and to write: lines that are costly to make are
    best written to scratch before.
    """
    layout, spark = layout or [], lines.sparkSession
    return versions.publish(
        lambda path: _write_lines(lines, text, layout, f"{path}/lines"),
        lambda path: spark.read.text(f"{path}/lines").count(),
        lines.count(),
        **note,
    )


# ---------------------------------------------------------------------------
# V7 transcript and gold from a record
# ---------------------------------------------------------------------------


def transcript_and_gold(good: DataFrame, record: str = "record") -> DataFrame:
    """Add ``transcript`` (2nd message, stripped) and ``gold_json``/``gold_ok``.

    The 3rd message's content is parsed when it is a string (stripped first) and
    taken as-is when it is already an object.
    """
    r = F.col(record)
    user = vget(r, "messages[1].content")
    asst = vget(r, "messages[2].content")
    df = stage(
        good.withColumn("transcript", ustrip(F.coalesce(F.when(vtype(user) == "string", F.try_variant_get(user, "$", "string")), F.lit(""))))
        .withColumn("_at", vtype(asst))
        .withColumn("_as", ustrip(F.coalesce(F.try_variant_get(asst, "$", "string"), F.lit(""))))
        .withColumn("_aj", F.when(vtype(asst) == "object", F.to_json(asst)))
    )
    gold_text = F.when(F.col("_at") == "object", F.col("_aj")).otherwise(F.col("_as"))
    df = df.withColumn("gold_json", gold_text).withColumn(
        "gold_ok", (F.col("_at") == "object") | json_valid(F.col("_as"))
    )
    return df.drop("_at", "_as", "_aj")
