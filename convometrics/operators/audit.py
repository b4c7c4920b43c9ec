"""Publish gate: secrets and personal data in text (Q5).

Patterns are matched with built-in regex functions (no look-arounds, so the
rules read the same in every SQL engine).  Address octets are at most 255; card
numbers of 13 to 19 digits, plain or grouped by spaces or dashes, must pass the
Luhn check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
SECRET = r'token\s*=\s*"[^"]*"'
IPV4_TOKEN = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"
CARD = r"[0-9](?:[ -]?[0-9])+"


def luhn_ok(digits: Column) -> Column:
    """Luhn checksum of a string of digits."""
    def term(i):
        d = F.substring(digits, F.length(digits) - i, 1).cast("int")
        doubled = d * 2
        return F.when(i % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + term(i))
    return total % 10 == 0


def _card_ok(match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    return F.when(F.length(digits).between(13, 19), luhn_ok(digits)).otherwise(F.lit(False))


def finding_counts(text: Column) -> dict[str, Column]:
    ip_tokens = F.transform(F.split(text, r"[^0-9.]+"), lambda t: F.regexp_replace(t, r"^\.+|\.+$", ""))
    small = lambda t: F.forall(F.split(t, r"\."), lambda o: o.cast("int") <= 255)
    return {
        "email": F.size(F.regexp_extract_all(text, F.lit(EMAIL), 0)),
        "ipv4": F.size(F.filter(ip_tokens, lambda t: F.when(t.rlike(IPV4_TOKEN), small(t)).otherwise(F.lit(False)))),
        "card_number": F.size(F.filter(F.regexp_extract_all(text, F.lit(CARD), 0), _card_ok)),
        "secret_token": F.size(F.regexp_extract_all(text, F.lit(SECRET), 0)),
    }


def publish_gate(docs: DataFrame, text: str = "text") -> DataFrame:
    """``kind, n_docs, n_matches, passed``: one conditional aggregate (partial, then one tiny shuffle).

    ``passed`` is the verdict of the kind; a corpus may be published if all are true.
    """
    counts = finding_counts(F.col(text))
    per_doc = docs.select(*[c.alias(k) for k, c in counts.items()])
    aggs = []
    for k in counts:
        aggs += [F.count_if(F.col(k) > 0).alias(f"{k}__docs"), F.sum(F.col(k)).cast("long").alias(f"{k}__matches")]
    one = per_doc.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"{k}__docs").alias("n_docs"), F.coalesce(F.col(f"{k}__matches"), F.lit(0)).alias("n_matches"))
        for k in counts
    ]))
    return one.select(rows.alias("r")).select("r.*").withColumn("passed", F.col("n_matches") == 0)
