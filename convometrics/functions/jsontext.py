"""Column helpers for strict JSON, typed JSON values and Python-style strings.

All helpers take and return ``Column`` and are built-in expressions.  No Python
runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stage import let

_STRICT = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "false"}

# Characters Python's str.strip() removes: everything str.isspace() accepts
# (Unicode White_Space plus the \x1c-\x1f separators), derived from that rule.
PY_WHITESPACE = [chr(i) for i in range(0x3001) if chr(i).isspace()]


PY_WHITESPACE_CHARS = "".join(PY_WHITESPACE)


def ustrip(c: Column) -> Column:
    """Python ``str.strip()``: trim the exact ``str.isspace()`` character set (no regex)."""
    return F.btrim(c, F.lit(PY_WHITESPACE_CHARS))


def ulstrip(c: Column) -> Column:
    """Python ``str.lstrip()``."""
    return F.ltrim(c, F.lit(PY_WHITESPACE_CHARS))


def _one_value(c: Column) -> tuple[Column, Column]:
    """(``c`` as the first element of an ARRAY<VARIANT>, whether ``c`` is that element and nothing else).

    ``from_json`` ignores what follows the first complete value, so a text may
    close the array early and go on with anything.  The array therefore ends with
    the digest of ``c``: it stands second only if ``c`` was one whole value.  One
    pass over the text.
    """
    mark = F.sha2(c, 256)
    held = F.from_json(F.concat(F.lit("["), c, F.lit(',"'), mark, F.lit('"]')), "array<variant>", _STRICT)
    whole = (F.size(held) == 2) & (F.try_variant_get(F.get(held, 1), "$", "string") == mark)
    return held, F.coalesce(whole, F.lit(False))


def json_valid(c: Column) -> Column:
    """True when ``c`` is one complete, strict JSON text (what ``json.loads`` accepts)."""
    return _one_value(c)[1]


def parse_strict(c: Column) -> Column:
    """VARIANT of ``c`` if it is strict JSON, else NULL."""
    held, whole = _one_value(c)
    return F.when(whole, F.get(held, 0))


def vget(v: Column, path: str) -> Column:
    """Sub-value at a dotted path as VARIANT; NULL when absent (JSON null stays a variant null)."""
    return F.try_variant_get(v, "$." + path if path else "$", "variant")


_TYPES = {"STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "OBJECT": "object", "ARRAY": "array"}


def type_of_schema(s: Column) -> Column:
    """JSON type by the text of ``schema_of_variant``; NULL for a NULL."""
    names = F.create_map(*[F.lit(x) for pair in _TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.substring_index(s, "<", 1)), F.when(s.isNotNull(), F.lit("number")))


def vtype(x: Column) -> Column:
    """JSON type of a VARIANT value: object/array/string/boolean/null/number, NULL if absent."""
    return let(F.schema_of_variant(x), type_of_schema)


def is_object(x: Column) -> Column:
    """True for a JSON object.  Casting to an empty struct reads no fields, so this is
    far cheaper than ``schema_of_variant`` on a large object."""
    return F.try_variant_get(x, "$", "struct<>").isNotNull()


def vshape(x: Column) -> Column:
    """``object`` / ``other`` / NULL (absent) -- the shallow test used for containers."""
    return F.when(x.isNull(), F.lit(None).cast("string")).when(is_object(x), F.lit("object")).otherwise(F.lit("other"))


def vstring(x: Column) -> Column:
    return F.try_variant_get(x, "$", "string")


def vdouble(x: Column) -> Column:
    return F.try_variant_get(x, "$", "double")


def vbool(x: Column) -> Column:
    return F.try_variant_get(x, "$", "boolean")


def canon(x: Column, t: Column | None = None) -> Column:
    """Typed canonical text of a JSON value, so that equality follows Python's ``==``.

    ``"4"`` differs from ``4``; ``4 == 4.0``; ``true == 1``; absent and JSON null
    both compare as ``None`` (SQL NULL here).  Whole numbers are compared exactly
    (up to 38 digits), others as doubles.  Objects and arrays compare by text.
    ``t`` is the precomputed ``vtype(x)`` when available.
    """
    t = vtype(x) if t is None else t
    d = vdouble(x)
    whole = F.when(
        d == F.floor(d),
        F.when(F.abs(d) < 9007199254740992, d.try_cast("bigint").cast("string")).otherwise(
            F.try_variant_get(x, "$", "decimal(38,0)").cast("string")
        ),
    )
    number = F.concat(F.lit("n:"), F.coalesce(whole, d.cast("string")))
    return (
        F.when(t == "string", F.concat(F.lit("s:"), vstring(x)))
        .when(t == "number", number)
        .when(t == "boolean", F.when(vbool(x), "n:1").otherwise("n:0"))
        .when(t.isin("object", "array"), F.concat(F.lit("j:"), F.to_json(x)))
    )


def canon_str(c: Column) -> Column:
    return F.concat(F.lit("s:"), c)


def canon_int(c: Column) -> Column:
    return F.concat(F.lit("n:"), c.cast("bigint").cast("string"))


def canon_bool(c: Column) -> Column:
    return F.when(c, "n:1").when(~c, "n:0")


def json_escape(c: Column) -> Column:
    """Escape backslash, then double quote (the repair script's rule, not full JSON escaping)."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def json_quote(c: Column) -> Column:
    """Full JSON string literal of ``c`` (quotes included), as the JSON writer emits it."""
    arr = F.to_json(F.array(c))
    return F.substring(arr, 2, F.length(arr) - 2)


def find0(s: Column, m: str, start0: Column | int = 0) -> Column:
    """Python ``s.find(m, start0)``: 0-based index or -1."""
    start = start0 if isinstance(start0, Column) else F.lit(start0)
    return F.call_function("locate", F.lit(m), s, start + 1) - 1


def rfind0(s: Column, m: str) -> Column:
    """Python ``s.rfind(m)``: 0-based index of the last occurrence or -1."""
    return let(
        F.instr(F.reverse(s), m[::-1]),
        lambda at: F.when(at == 0, F.lit(-1)).otherwise(F.length(s) - F.lit(len(m)) - at + 1),
    )


def slice0(s: Column, start0: Column, end0: Column | None = None) -> Column:
    """Python ``s[start0:end0]`` for non-negative indices (empty when end <= start)."""
    start = start0 + 1
    if end0 is None:
        return F.substring(s, start, F.greatest(F.length(s) - start0, F.lit(0)))
    return F.substring(s, start, F.greatest(end0 - start0, F.lit(0)))
