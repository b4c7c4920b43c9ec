"""Extraction requests as a stream (K1-K2).

The reference serves one transcript per HTTP request.  Here requests arrive as
records ``(request_id, body)`` -- ``body`` is the raw request text, possibly
broken JSON -- on a file (or any) streaming source.  ``classify_requests`` is
stateless column code shared by batch and streaming; accepted requests go
through the same ``mapInPandas`` model call as the batch job; rejected ones
go to a dead-letter output of their own, with status 400, the reason and the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.jsontext import parse_strict, ustrip, vbool, vdouble, vget, vstring, vtype
from ..functions.stage import stage
from ..operators import evaluate as ev
from ..operators import extract as ex
from ..operators import messages as msg
from ..operators.payload import serialize
from ..sources.commits import BatchStore

BLANK = "Missing or empty 'transcript'"
REQUEST_SCHEMA = "request_id bigint, body string"


def _pytype(x: Column) -> Column:
    """Python type name of a JSON value (for the attribute-error messages)."""
    s = F.schema_of_variant(x)
    t = vtype(x)
    return (
        F.when(t == "object", F.lit("dict"))
        .when(t == "array", F.lit("list"))
        .when(t == "string", F.lit("str"))
        .when(t == "boolean", F.lit("bool"))
        .when(t == "null", F.lit("NoneType"))
        .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), F.lit("float"))
        .otherwise(F.lit("int"))
    )


def truthy(x: Column) -> Column:
    """Python truthiness of a JSON value; NULL (absent or unparseable) is falsy."""
    t = vtype(x)
    return (
        F.when(x.isNull(), F.lit(False))
        .when(t == "object", F.coalesce(F.size(F.try_variant_get(x, "$", "map<string,variant>")) > 0, F.lit(False)))
        .when(t == "array", F.coalesce(F.size(F.try_variant_get(x, "$", "array<variant>")) > 0, F.lit(False)))
        .when(t == "string", vstring(x) != "")
        .when(t == "number", vdouble(x) != 0)
        .when(t == "boolean", vbool(x))
        .otherwise(F.lit(False))
    )


def classify_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """K1: ``accepted``, ``status`` (NULL when accepted, 400 when rejected), ``error``,
    ``transcript``, ``system_prompt`` (NULL -> default) and ``prompt_error``."""
    b = F.col(body)
    df = stage(df.withColumn("_v", parse_strict(b)))
    v = F.col("_v")
    df = stage(
        df.withColumn("_bt", truthy(v))
        .withColumn("_bobj", vtype(v) == "object")
        .withColumn("_btype", _pytype(v))
        .withColumn("_tr", vget(v, "transcript"))
        .withColumn("_sp", vget(v, "system_prompt"))
    )
    tr = F.col("_tr")
    tr_truthy = F.col("_bt") & F.col("_bobj") & truthy(tr)
    tr_is_str = vtype(tr) == "string"
    error = (
        F.when(F.col("_bt") & ~F.col("_bobj"), F.concat(F.lit("'"), F.col("_btype"), F.lit("' object has no attribute 'get'")))
        .when(~tr_truthy, F.lit(BLANK))
        .when(~tr_is_str, F.concat(F.lit("'"), _pytype(tr), F.lit("' object has no attribute 'strip'")))
        .when(ustrip(vstring(tr)) == "", F.lit(BLANK))
    )
    sp = F.col("_sp")
    sp_type = vtype(sp)
    out = df.withColumn("error", error).withColumn("accepted", F.col("error").isNull())
    out = out.withColumn("status", F.when(~F.col("accepted"), F.lit(400)))
    out = out.withColumn("transcript", F.when(F.col("accepted"), vstring(tr)))
    out = out.withColumn("system_prompt", F.when(F.col("accepted") & (sp_type == "string"), vstring(sp)))
    out = out.withColumn(
        "prompt_error",
        F.when(F.col("accepted") & sp.isNotNull() & ~sp_type.isin("string", "null"),
               F.concat(F.lit("'"), _pytype(sp), F.lit("' object has no attribute 'strip'"))),
    )
    return stage(out.drop("_v", "_bt", "_bobj", "_btype", "_tr", "_sp"))


def extraction_prompt(df: DataFrame) -> DataFrame:
    """Rendered ChatML prompt of accepted requests (system override stripped; NULL -> default)."""
    m = msg.extraction_messages(F.col("transcript"), F.col("system_prompt"))
    return df.withColumn("prompt", msg.chat_template(m, add_generation_prompt=True))


RESPONSE_SCHEMA = "request_id bigint, http_status int, response string, error string, customer_intent string"


def respond(
    df: DataFrame, factory: ex.ModelFactory, key: str = "request_id", batch_size: int = 1, path: str | None = None, chunks: int = 1
) -> DataFrame:
    """K2: accepted requests -> model -> ``status`` 200 with ``response`` JSON, or 500 with ``error``.

    With ``path`` the model's replies are kept there and those that are there
    are not asked for again (``extract.run_once``).
    """
    acc = df.filter(F.col("accepted"))
    asked = extraction_prompt(acc.filter(F.col("prompt_error").isNull())).select(key, "prompt")
    if path is None:
        called = ex.run_model(asked, factory, key, "prompt", batch_size=batch_size)
    else:
        called = ex.run_once(
            asked, [key], ["prompt"], path,
            lambda todo: ex.run_model(todo, factory, key, "prompt", carry=["_asked"], batch_size=batch_size), chunks,
        )
    # a prompt that cannot be made never reaches the model
    refused = acc.filter(F.col("prompt_error").isNotNull()).select(
        key, F.lit(None).cast("string").alias("reply"), F.col("prompt_error").alias("model_error")
    )
    called = called.select(key, "reply", "model_error").unionByName(refused)
    p = ev.prepare_predictions(called)
    body = F.when(F.col("status") == "valid", serialize(F.col("metrics"))).otherwise(F.to_json(F.col("payload")))
    return p.select(
        key,
        F.when(F.col("status") == "error", F.lit(500)).otherwise(F.lit(200)).alias("http_status"),
        F.when(F.col("status") != "error", body).alias("response"),
        F.when(F.col("status") == "error", F.col("error")).alias("error"),
        F.col("metrics.behavioral_analytics.customer_intent").alias("customer_intent"),
    )


class Sinks:
    """Where a stream's output lies under ``path``: accepted requests or answers, and dead letters, each in committed batches."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self.answers = BatchStore(spark, f"{self.path}/answers")
        self.dead_letters = BatchStore(spark, f"{self.path}/dead_letters")

    def replies(self, batch_id: int) -> str:
        return f"{self.path}/replies/batch={batch_id}"


def run_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
               factory: ex.ModelFactory | None = None, fmt: str = "json", batch_size: int = 1,
               max_files_per_trigger: int | None = None, trigger: dict | None = None,
               chunks: int = 1) -> StreamingQuery:
    """Process ``source_dir`` into ``sink_dir``.

    ``trigger`` goes to the stream as it is; by default everything that is there
    now is processed (``availableNow``) and awaited.  ``max_files_per_trigger``
    cuts a backlog into micro-batches of so many files.

    Without a factory only K1 runs (accepted and rejected requests); with one, each
    micro-batch also calls the model (K2).  Rejected requests (400) go to the
    dead letters alone, the others to the answers (``Sinks``).  Both are committed
    by micro-batch, and the replies of the model before them in ``chunks`` steps:
    a replayed micro-batch finds its replies, asks for the missing ones, and adds
    no row twice.
    """
    reader = spark.readStream.schema(REQUEST_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    classified = classify_requests(stream)
    sinks = Sinks(spark, sink_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # several branches read it: the source is read and parsed once
        try:
            rejected = batch.filter(~F.col("accepted"))
            sinks.dead_letters.write(rejected.select("request_id", F.col("status").alias("http_status"), "error", "body"), str(batch_id))
            if factory is None:
                out = batch.filter(F.col("accepted")).select(
                    "request_id", F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("error"), "system_prompt", "transcript"
                )
            else:
                out = respond(batch, factory, batch_size=batch_size, path=sinks.replies(batch_id), chunks=chunks)
            sinks.answers.write(out, str(batch_id))
        finally:
            batch.unpersist()

    q = (
        classified.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if trigger is None:
        q.awaitTermination()
    return q
