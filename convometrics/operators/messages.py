"""Transcripts, message triples, prompts and the chat template."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.jsontext import ustrip
from ..schema import MAX_SEQ_LENGTH, SYSTEM_PROMPT

# A turn starts at a line beginning with an Agent/Customer label, bold or not.
_LABEL = r"(?:\*\*)?(Agent|Customer):(?:\*\*)? ?"
_TURN_START = r"\n(?=(?:\*\*)?(?:Agent|Customer):)"


def turn_line(speaker: Column, text: Column) -> Column:
    return F.concat(speaker, F.lit(": "), text)


def assemble_transcripts(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                         speaker: str = "speaker", text: str = "text") -> DataFrame:
    """``key, n_turns, transcript`` -- turns joined by newlines in ``order``.

    One row per conversation is the product; the aggregate is partial (map-side
    collect, then merge).  A conversation must fit in a task: ``assemble_pieces``
    has no such bound, and ``oversized_turns`` sets those beyond a bound of the
    caller's aside, with a reason.
    """
    line = F.struct(F.col(order).alias("o"), turn_line(F.col(speaker), F.col(text)).alias("l"))
    agg = turns.groupBy(key).agg(F.array_sort(F.collect_list(line)).alias("_t"))
    return agg.select(
        key,
        F.size("_t").cast("long").alias("n_turns"),
        F.array_join(F.transform("_t", lambda x: x.getField("l")), "\n").alias("transcript"),
    )


# Characters of a piece of a transcript that is written in several.
PIECE_CHARS = 1 << 20


def assemble_pieces(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                    speaker: str = "speaker", text: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """T1 for conversations of any length: ``key, piece, n_turns, transcript`` in pieces of about ``piece_chars`` characters.

    A turn belongs to the piece in which it begins (characters before it, with
    their newlines, over ``piece_chars``), so the pieces of a conversation, joined
    by newlines in their order, are its transcript; a turn longer than a piece
    leaves numbers out.  One shuffle by conversation: a sorted, running sum over
    its turns, then a group for each piece, so a task holds no more than a
    piece, whatever share of all turns a conversation has.  Ties of ``order`` go
    by the line's text.
    """
    lines = turns.select(key, F.col(order).alias("_o"), turn_line(F.col(speaker), F.col(text)).alias("_l"))
    upto = Window.partitionBy(key).orderBy("_o", "_l").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lines.withColumn("_end", F.sum(F.length("_l") + 1).over(upto))
    start = F.col("_end") - F.length("_l") - 1
    placed = placed.withColumn("piece", F.floor(start / F.lit(piece_chars)).cast("long")).withColumn("_at", start)
    agg = placed.groupBy(key, "piece").agg(F.array_sort(F.collect_list(F.struct("_at", "_l"))).alias("_t"))
    return agg.select(
        key,
        "piece",
        F.size("_t").cast("long").alias("n_turns"),
        F.array_join(F.transform("_t", lambda x: x.getField("_l")), "\n").alias("transcript"),
    )


def oversized_turns(turns: DataFrame, max_turns: int, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """(turns of conversations up to ``max_turns``, quarantine rows ``key, n_turns, reason`` of the others).

    Counts are summed where the turns lie, so a conversation of any size costs no task.
    """
    sizes = turns.groupBy(key).agg(F.count(F.lit(1)).alias("n_turns"))
    over = sizes.filter(F.col("n_turns") > max_turns)
    return turns.join(over.select(key), key, "left_anti"), over.withColumn("reason", F.lit("too_many_turns"))


def split_turns(df: DataFrame, transcript: str = "transcript", keep: list[str] | None = None) -> DataFrame:
    """One row per turn (``turn_no`` from 0, ``speaker``, ``text``); text may span lines."""
    parts = F.split(F.col(transcript), _TURN_START)
    exploded = df.select(*(keep or []), F.posexplode(parts).alias("turn_no", "_p"))
    return exploded.select(
        *(keep or []),
        F.col("turn_no").cast("long").alias("turn_no"),
        F.regexp_extract("_p", "^" + _LABEL, 1).alias("speaker"),
        F.regexp_replace("_p", "^" + _LABEL, "").alias("text"),
    )


def turn_count_audit(turns: DataFrame, key: str = "conv_id", lo: int = 6, hi: int = 10) -> DataFrame:
    """Turns per conversation against the 6-10 rule."""
    return turns.groupBy(key).agg(F.count(F.lit(1)).alias("n_turns")).withColumn(
        "in_range", F.col("n_turns").between(lo, hi)
    )


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def training_messages(transcript: Column, label_json: Column) -> Column:
    """T4: fixed system prompt, bare transcript, label JSON (training format)."""
    return F.array(_msg("system", F.lit(SYSTEM_PROMPT)), _msg("user", transcript), _msg("assistant", label_json))


def training_line(transcript: Column, label_json: Column) -> Column:
    return F.to_json(F.struct(training_messages(transcript, label_json).alias("messages")))


def extraction_messages(transcript: Column, system_prompt: Column | None = None) -> Column:
    """T5: system prompt (override stripped; NULL -> default; '' stays empty) + ``Transcript:`` user turn."""
    sp = F.lit(SYSTEM_PROMPT) if system_prompt is None else F.coalesce(system_prompt, F.lit(SYSTEM_PROMPT))
    return F.array(
        _msg("system", ustrip(sp)),
        _msg("user", F.concat(F.lit("Transcript:\n"), ustrip(transcript))),
    )


def chat_template(messages: Column, add_generation_prompt: bool = False) -> Column:
    """ChatML rendering ``<|im_start|>role\\ncontent<|im_end|>\\n`` per message."""
    body = F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(F.lit("<|im_start|>"), m.getField("role"), F.lit("\n"), m.getField("content"), F.lit("<|im_end|>\n")),
        ),
        "",
    )
    return F.concat(body, F.lit("<|im_start|>assistant\n")) if add_generation_prompt else body


_HERE = "\x00transcript\x00"


def prompt_frame(spark: SparkSession, system_prompt: str | None = None) -> tuple[str, str]:
    """(text before, text after) the stripped transcript in an extraction prompt, as T5 and T6 render it.

    For model jobs that make a prompt inside a task: the template is written once, above.
    """
    sp = None if system_prompt is None else F.lit(system_prompt)
    made = chat_template(extraction_messages(F.lit(_HERE), sp), add_generation_prompt=True)
    before, after = spark.range(1).select(made.alias("prompt")).first()["prompt"].split(_HERE)
    return before, after


def whitespace_tokens(text: Column) -> Column:
    """Stand-in token count: whitespace-separated pieces (``str.split()``)."""
    s = ustrip(text)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, r"(?U)\s+"))).cast("long")


def tokenizer_counter(path: str) -> Callable[[Column], Column]:
    """A token counter for ``sequence_budget`` from a tokenizer file (JSON of the ``tokenizers`` library) at ``path``.

    The file must lie where every task can read it; a worker process loads it
    once.  Special tokens are neither added nor recognised in a text.  A null
    text has no count.
    """

    def count(texts: pd.Series) -> pd.Series:
        held = sys.modules.setdefault("_convometrics_tokenizers", types.ModuleType("_convometrics_tokenizers")).__dict__
        if path not in held:
            from tokenizers import Tokenizer

            held[path] = Tokenizer.from_file(path)
            held[path].encode_special_tokens = True
        some = texts.dropna()
        found = held[path].encode_batch(some.tolist(), add_special_tokens=False)
        return pd.Series([len(e.ids) for e in found], index=some.index, dtype="Int64").reindex(texts.index)

    return F.pandas_udf(count, LongType())


def sequence_budget(df: DataFrame, text: str, counter: Callable[[Column], Column] | None = None,
                    budget: int = MAX_SEQ_LENGTH) -> DataFrame:
    """``n_tokens`` and ``over_budget``.  ``counter`` is a caller's token counter
    (e.g. a ``pandas_udf`` wrapping a tokenizer); default is the whitespace stand-in."""
    n = (counter or whitespace_tokens)(F.col(text))
    return df.withColumn("n_tokens", n.cast("long")).withColumn("over_budget", F.col("n_tokens") > budget)


def system_prompt_audit(df: DataFrame, system: str = "system_prompt") -> DataFrame:
    """How many rows use exactly the training system prompt (a missing one does not)."""
    return df.groupBy(F.col(system).eqNullSafe(F.lit(SYSTEM_PROMPT)).alias("matches_training")).agg(
        F.count(F.lit(1)).alias("n")
    )
