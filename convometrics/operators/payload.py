"""Model-reply parsing, schema validation, defaults and flattening.

A reply goes through three states, as in the reference extractor:

* ``valid``  -- strict JSON that passes the schema; values are coerced the way
  pydantic's lax mode does and the five defaulted fields are filled.
* ``raw``    -- strict JSON that fails the schema; the unvalidated object is kept
  and still scored.
* ``error``  -- not parseable as JSON (or the model call failed).

Everything is a native column expression over VARIANT values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import (
    parse_strict,
    canon,
    canon_bool,
    canon_int,
    canon_str,
    ulstrip,
    ustrip,
    vbool,
    vdouble,
    vget,
    vstring,
    type_of_schema,
    vtype,
)
from ..functions.stage import let, stage
from ..schema import FIELD_RULES, GROUPS, VOCABULARIES, VOCABULARY_NAMES, FieldRule

# ---------------------------------------------------------------------------
# P1 vocabulary dimension
# ---------------------------------------------------------------------------


def vocabulary_df(spark: SparkSession) -> DataFrame:
    """(field, ordinal, name, value) for the five controlled vocabularies (25 rows, fixed size)."""
    rows = [(f, i, VOCABULARY_NAMES[f][i], v) for f, vals in VOCABULARIES.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "field string, ordinal int, name string, value string")


# ---------------------------------------------------------------------------
# P2 fence stripping
# ---------------------------------------------------------------------------

FENCE = "```"


def unfence(reply: Column) -> Column:
    r"""Body of the first ```json fenced block, stripped; the whole stripped text if none.

    Same result as searching ``` ```(?:json)?\s*([\s\S]*?)``` ``` (lower-case ``json``
    only; body up to the next fence), done with ``locate``/``substring``.
    """

    def body(raw: Column, open_at: Column) -> Column:
        after = F.substring(raw, open_at + 3, F.length(raw))
        after = F.when(after.startswith("json"), F.substring(after, 5, F.length(after))).otherwise(after)
        inner = let(let(after, ulstrip), lambda t: let(F.instr(t, FENCE), lambda end: F.when(end > 0, ustrip(F.substring(t, F.lit(1), end - 1)))))
        return F.coalesce(inner, raw)

    # most replies hold no fence: they are searched once and stripped
    fenced = let(ustrip(reply), lambda raw: let(F.instr(raw, FENCE), lambda at: body(raw, at)))
    return F.when(reply.contains(FENCE), fenced).otherwise(ustrip(reply))


# ---------------------------------------------------------------------------
# P3 parse
# ---------------------------------------------------------------------------

# Fixed value: the wording of the error text.
PARSE_ERROR_PREFIX = "Model output could not be parsed as JSON. Raw reply:\n"


def parse_replies(df: DataFrame, reply: str = "reply", model_error: str | None = None) -> DataFrame:
    """Add ``body``, ``payload`` (VARIANT or NULL) and ``error``.

    ``model_error`` names a column holding a failure of the model call itself;
    such rows are errors whatever the reply says.
    """
    r = F.col(reply)
    body = unfence(r)
    out = df.withColumn("body", body).withColumn(
        "payload", parse_strict(F.col("body"))
    )
    parse_err = F.when(
        F.col("payload").isNull(),
        F.concat(F.lit(PARSE_ERROR_PREFIX), F.substring(ustrip(r), 1, 500), F.lit("...")),
    )
    if model_error:
        err = F.coalesce(F.col(model_error), parse_err)
        out = out.withColumn("payload", F.when(F.col(model_error).isNull(), F.col("payload")))
    else:
        err = parse_err
    return out.withColumn("error", err)


# ---------------------------------------------------------------------------
# P4 validation (pydantic lax rules as columns)
#
# A payload is taken apart once into per-leaf columns -- ``<p>_x_<leaf>`` (the
# VARIANT at the leaf path), ``<p>_t_<leaf>`` (its JSON type), ``<p>_v_<leaf>``
# (the coerced typed value) -- and every rule reads those columns.  This keeps
# each expression small and makes each variant extraction happen once per row.
# ---------------------------------------------------------------------------

_INT_TEXT = r"^[+-]?[0-9]+(\.0*)?$"
_TRUE_TEXT = ["1", "on", "t", "true", "y", "yes"]
_FALSE_TEXT = ["0", "off", "f", "false", "n", "no"]


def lax_int(x: Column, t: Column) -> Column:
    """Integer value pydantic would accept (as DOUBLE), NULL when the type is wrong."""
    d = vdouble(x)
    s = ustrip(vstring(x))
    return (
        F.when((t == "number") & (d == F.floor(d)), d)
        .when(t == "boolean", F.when(vbool(x), F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(
            (t == "string") & s.rlike(_INT_TEXT),
            F.regexp_extract(s, r"^([+-]?[0-9]+)", 1).try_cast("double"),
        )
    )


def lax_bool(x: Column, t: Column) -> Column:
    """Boolean value pydantic would accept, NULL when it would reject the input."""
    d = vdouble(x)
    s = F.lower(vstring(x))
    return (
        F.when(t == "boolean", vbool(x))
        .when((t == "number") & (d == 1), F.lit(True))
        .when((t == "number") & (d == 0), F.lit(False))
        .when((t == "string") & s.isin(*_TRUE_TEXT), F.lit(True))
        .when((t == "string") & s.isin(*_FALSE_TEXT), F.lit(False))
    )


def _string_list(x: Column, t: Column) -> Column:
    arr = F.try_variant_get(x, "$", "array<variant>")
    ok = (t == "array") & F.forall(arr, lambda e: F.schema_of_variant(e) == "STRING")
    return F.when(ok, F.try_variant_get(x, "$", "array<string>"))


def _variants(payload: Column, rules: list[FieldRule]) -> Column:
    """The leaves as a struct of variants for each group, in one pass; NULL for a root or a group that is no object."""
    groups = {g: ", ".join(f"{r.name}: variant" for r in rules if r.group == g) for g in GROUPS}
    return F.try_variant_get(payload, "$", "struct<" + ", ".join(f"{g}: struct<{f}>" for g, f in groups.items() if f) + ">")


def leaf_col(prefix: str, kind: str, name: str) -> str:
    return f"{prefix}_{kind}_{name}"


def leaf_columns(prefix: str) -> list[str]:
    cols = [leaf_col(prefix, "t", "root")] + [leaf_col(prefix, "t", g) for g in GROUPS]
    for r in FIELD_RULES:
        cols += [leaf_col(prefix, k, r.name) for k in ("x", "t", "v")]
    return cols


def explode_payload(
    df: DataFrame, payload: str = "payload", prefix: str = "_p", typed: bool = True, fields: list[str] | None = None
) -> DataFrame:
    """Add per-leaf VARIANT, type and (when ``typed``) coerced-value columns for ``payload``.

    ``fields`` limits the leaves to those a job uses; without it the shapes of
    the root and of the groups, which validation needs, are added too.
    """
    p = F.col(payload)
    rules = [r for r in FIELD_RULES if fields is None or r.name in fields]
    held = f"{prefix}_held"
    df = stage(df.withColumn(held, _variants(p, rules)))  # taken apart once, whatever reads the leaves
    if fields is None:

        def shape(taken: Column, x: Column) -> Column:
            return F.when(taken.isNotNull(), F.lit("object")).when(x.isNotNull(), F.lit("other"))

        shapes = {leaf_col(prefix, "t", g): shape(F.col(held)[g], vget(p, g)) for g in GROUPS}
        df = df.withColumns({leaf_col(prefix, "t", "root"): shape(F.col(held), p)} | shapes)
    df = df.withColumns({leaf_col(prefix, "x", r.name): F.col(held)[r.group][r.name] for r in rules}).drop(held)
    df = df.withColumns({leaf_col(prefix, "t", r.name): type_of_schema(F.schema_of_variant(leaf_col(prefix, "x", r.name))) for r in rules})
    if not typed:
        return df
    typed_cols = {}
    for r in rules:
        x, t = F.col(leaf_col(prefix, "x", r.name)), F.col(leaf_col(prefix, "t", r.name))
        if r.kind in ("str", "enum"):
            v = F.when(t == "string", vstring(x))
        elif r.kind == "int":
            v = lax_int(x, t)
        elif r.kind == "bool":
            v = lax_bool(x, t)
        else:
            v = _string_list(x, t)
        typed_cols[leaf_col(prefix, "v", r.name)] = v
    return df.withColumns(typed_cols)


def _field_violation(prefix: str, rule: FieldRule) -> Column:
    t = F.col(leaf_col(prefix, "t", rule.name))
    v = F.col(leaf_col(prefix, "v", rule.name))
    tag = rule.path + ":"
    c = F.when(t.isNull(), F.lit(tag + "required") if rule.required else F.lit(None).cast("string"))
    if rule.kind == "enum":
        c = c.when(v.isNull() | ~v.isin(*rule.vocab), tag + "enum")
    elif rule.kind == "int":
        c = c.when(v.isNull(), tag + "type").when((v < rule.lo) | (v > rule.hi), tag + "range")
    else:
        c = c.when(v.isNull(), tag + "type")
    return F.when(F.col(leaf_col(prefix, "t", rule.group)) == "object", c)


def violations(prefix: str = "_p") -> Column:
    """ARRAY<STRING> of ``path:rule`` for every failed rule, in schema order; empty when valid."""
    checks = []
    for g in GROUPS:
        gt = F.col(leaf_col(prefix, "t", g))
        checks.append(F.when(gt.isNull(), F.lit(g + ":required")).when(gt != "object", F.lit(g + ":type")))
    checks += [_field_violation(prefix, r) for r in FIELD_RULES]
    per_field = F.array_compact(F.array(*checks))
    return F.when(F.col(leaf_col(prefix, "t", "root")) != "object", F.array(F.lit("root:type"))).otherwise(
        per_field
    )


def validate(df: DataFrame, payload: str = "payload", prefix: str = "_p") -> DataFrame:
    """Add ``violations`` and ``status`` (valid / raw / error); keeps the leaf columns."""
    if leaf_col(prefix, "t", "root") not in df.columns:
        df = explode_payload(df, payload, prefix)
    p = F.col(payload)
    return df.withColumn("violations", F.when(p.isNotNull(), violations(prefix))).withColumn(
        "status",
        F.when(p.isNull(), "error").when(F.size("violations") == 0, "valid").otherwise("raw"),
    )


def drop_leaves(df: DataFrame, prefix: str = "_p") -> DataFrame:
    return df.drop(*[c for c in leaf_columns(prefix) if c in df.columns])


# ---------------------------------------------------------------------------
# P5/P6 typed record: coercion + defaults
# ---------------------------------------------------------------------------


def typed_value(prefix: str, rule: FieldRule, fill_defaults: bool = True) -> Column:
    """Leaf value in its schema type (lax coercion); default when absent if asked."""
    v = F.col(leaf_col(prefix, "v", rule.name))
    if rule.kind == "int":
        v = v.cast("int")
    if fill_defaults and not rule.required:
        v = F.when(F.col(leaf_col(prefix, "t", rule.name)).isNull(), F.lit(rule.default)).otherwise(v)
    return v


def metrics_struct(prefix: str = "_p", fill_defaults: bool = True, fields: list[str] | None = None) -> Column:
    """The nested metrics record (METRICS_SCHEMA shape, or its ``fields``) built from exploded leaves."""
    groups = []
    for g in GROUPS:
        rules = [r for r in FIELD_RULES if r.group == g and (fields is None or r.name in fields)]
        if rules:
            groups.append(F.struct(*[typed_value(prefix, r, fill_defaults).alias(r.name) for r in rules]).alias(g))
    return F.struct(*groups)


def with_metrics(df: DataFrame, prefix: str = "_p", status: str = "status") -> DataFrame:
    """Add ``metrics``: the validated record with defaults, for ``valid`` rows only."""
    return df.withColumn("metrics", F.when(F.col(status) == "valid", metrics_struct(prefix)))


def records(
    df: DataFrame, payload: str = "payload", fill_defaults: bool = False, name: str = "record", fields: list[str] | None = None
) -> DataFrame:
    """Typed record of any payload (gold included): lax coercion, no validation gate; ``fields``: only these leaves."""
    df = explode_payload(df, payload, "_r", fields=fields)
    return drop_leaves(df.withColumn(name, metrics_struct("_r", fill_defaults, fields)), "_r")


def flatten(df: DataFrame, record: str = "metrics", keep: list[str] | None = None) -> DataFrame:
    """One typed column per leaf (17 columns)."""
    cols = [F.col(f"{record}.{r.group}.{r.name}").alias(r.name) for r in FIELD_RULES]
    return df.select(*(keep or []), *cols)


def serialize(record: Column) -> Column:
    """JSON text of the record in field order, nulls kept."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def inspect_view(df: DataFrame, record: str = "metrics", keep: list[str] | None = None) -> DataFrame:
    """The notebook's quick-check projection."""
    b, o, d = (f"{record}.{g}" for g in GROUPS)
    quotes = F.col(f"{b}.effort_and_friction_quotes")
    return df.select(
        *(keep or []),
        F.col(f"{b}.customer_intent").alias("intent"),
        F.col(f"{b}.customer_effort_score").alias("effort_score"),
        F.col(f"{b}.sentiment_trajectory").alias("sentiment_trajectory"),
        F.when(F.coalesce(F.size(quotes), F.lit(0)) <= 0, F.lit("(none)"))
        .otherwise(F.concat_ws(" | ", F.slice(quotes, 1, 2)))
        .alias("quotes"),
        F.col(f"{o}.agent_explicitly_confirmed_resolution").alias("resolution_confirmed"),
        F.col(f"{o}.unresolved_next_steps").alias("unresolved_next_steps"),
        F.col(f"{d}.recommended_routing_queue").alias("routing"),
    )


# ---------------------------------------------------------------------------
# Canonical field values for comparison
# ---------------------------------------------------------------------------


# Every text whose upper-case form is "N/A" or "NA" (only n/N and a/A map there).
_NA_FORMS = [a + "/" + b for a in "nN" for b in "aA"] + [a + b for a in "nN" for b in "aA"]


def normalize_resolved_text(s: Column) -> Column:
    """``N/A`` for null/empty/(N/A|NA after strip+upper); ``PENDING`` for any other text.

    ``strip().upper() in ("N/A", "NA")`` is tested as membership in the eight
    case forms, which avoids Spark's ICU case mapping on every row.
    """
    return (
        F.when(s.isNull() | (s == ""), F.lit("N/A"))
        .when(ustrip(s).isin(*_NA_FORMS), F.lit("N/A"))
        .otherwise(F.lit("PENDING"))
    )


def normalize_resolved_value(x: Column) -> Column:
    """Same rule on a JSON value: anything that is not a string counts as ``N/A``."""
    return F.when(vtype(x) == "string", normalize_resolved_text(vstring(x))).otherwise(F.lit("N/A"))


def canon_leaves(prefix: str, names: list[str]) -> Column:
    """ARRAY of the canonical values of several leaves, in their order: one tree for all of them."""
    leaves = [F.struct(F.col(leaf_col(prefix, "x", n)).alias("x"), F.col(leaf_col(prefix, "t", n)).alias("t")) for n in names]
    return F.transform(F.array(*leaves), lambda e: canon(e.getField("x"), e.getField("t")))


def canon_typed(record: Column, rule: FieldRule) -> Column:
    v = record.getField(rule.group).getField(rule.name)
    if rule.kind == "int":
        return canon_int(v)
    if rule.kind == "bool":
        return canon_bool(v)
    if rule.kind == "str_list":
        return F.concat(F.lit("j:"), F.to_json(v))
    return canon_str(v)


def normalize_resolved_leaf(prefix: str) -> Column:
    """Resolution class of the exploded ``unresolved_next_steps`` leaf (non-strings are N/A)."""
    t = F.col(leaf_col(prefix, "t", "unresolved_next_steps"))
    x = F.col(leaf_col(prefix, "x", "unresolved_next_steps"))
    return F.when(t == "string", normalize_resolved_text(vstring(x))).otherwise(F.lit("N/A"))


def any_true(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)
