"""Personal data: fixed patterns, then bootstrapped contextual extraction.  DataFrame functions only.

Base: e-mail addresses, IPv4 addresses, card numbers and phone numbers, found
leftmost and non-overlapping for each kind in the whole text.

Bootstrap: the base entities are seeds.  The words around them induce lexical
patterns (the two words before; the word before and the word after).  The
identifier-like words of the corpus (those with a digit or an @) and the
patterns they stand in form a graph.  Pattern confidence (the weight of its
instances of a kind over all its instances) and instance weight (that of its
best pattern) are computed in turn, ``ROUNDS`` times.  Words in a pattern of high
confidence that are no base entity are new spans of the pattern's kind.

A common pattern is counted where its rows lie, by partial aggregation, before
anything is shuffled; patterns without ``MIN_SEEDS`` different seeds never enter
the graph.

Defined cases: a null text counts as empty; very long texts and very long
neighbour words are read whole; every row is a document of its own, also one that
repeats a doc_id or has none; of kinds equally sure the last in alphabetical order
wins; an empty table gives no rows; other columns are ignored.  The counts n_...
are of base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convometrics.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 5  # different seeds that a pattern needs
MIN_CONFIDENCE = 0.8
PRIOR = 1.0  # instances without a kind that every pattern is taken to have met
ROUNDS = 3
MIN_DIGITS = 4  # of a new span without an @

# The base patterns.  \G or a look-behind lets a match begin only where a scan from the left would find it first,
# possessive repetition keeps long runs linear; neither changes what is found.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be worth trying.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"
# A whole word with a digit or an @.
LIKE_ID = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
STEP = 128
# Neighbour words of a match in the whole gap beside it; a look-behind and possessive repetition keep long gaps linear.
LAST_WORD = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$"
LAST_TWO = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$"
NEXT_WORD = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        odd = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(i % 2 == 1, odd).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(OCTETS)
    if kind == "card":
        n = F.length(_digits(match))
        return F.when((n >= 13) & (n <= 19), _luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _only_valid(kind: str) -> Column:
    return F.filter(kind, lambda s: _valid(kind, s["match"]))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def _found(df: DataFrame, pattern: str, hint: str, out: str) -> DataFrame:
    """Add ``out``: structs (start, end, match, two, last, following) of all matches in ``text``.

    ``two`` and ``last`` are the words before the match, ``following`` the one after it.

    The gaps that a split leaves and the matches themselves give the positions.
    They are summed in steps, so that a text with many matches stays cheap.
    """
    none = F.expr("cast(array() as array<string>)")
    possible = F.col("text").rlike(hint)
    df = df.withColumn("__hits", F.when(possible, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("__gaps", F.when(F.size("__hits") > 0, F.split("text", pattern, -1)).otherwise(none))
    lengths = F.zip_with(
        F.slice("__gaps", 1, F.size("__hits")), "__hits", lambda g, m: (F.length(g) + F.length(m)).cast("long")
    )
    df = df.withColumn("__len", lengths)
    blocks = F.sequence(F.lit(0), (F.size("__hits") / STEP).cast("int"))
    df = df.withColumn("__sums", F.transform(blocks, lambda b: _sum(F.slice("__len", b * STEP + 1, STEP))))
    df = df.withColumn("__before", F.transform(blocks, lambda b: _sum(F.slice("__sums", 1, b))))

    def span(match: Column, i: Column) -> Column:
        block = (i / STEP).cast("int")
        gap = F.get("__gaps", i)
        start = F.get("__before", block) + _sum(F.slice("__len", block * STEP + 1, i % STEP)) + F.length(gap)
        return F.struct(
            start.cast("long").alias("start"),
            (start + F.length(match)).cast("long").alias("end"),
            match.alias("match"),
            F.lower(F.regexp_extract(gap, LAST_TWO, 1)).alias("two"),
            F.lower(F.regexp_extract(gap, LAST_WORD, 1)).alias("last"),
            F.lower(F.regexp_extract(F.get("__gaps", i + 1), NEXT_WORD, 1)).alias("following"),
        )

    return df.withColumn(out, F.transform("__hits", span)).drop("__hits", "__gaps", "__len", "__sums", "__before")


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, an array of spans for each kind, and the identifier-like words (``words``)."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    for kind in KINDS:
        df = _found(df, PATTERNS[kind], HINTS[kind], kind)
        df = df.withColumn(kind, _only_valid(kind))
    df = _found(df, LIKE_ID, "[0-9@]", "words")
    return df.drop("text")


def _patterns(place: str) -> Column:
    """The lexical patterns that a place stands in; none where its neighbours are identifiers."""
    two, last, following = (F.col(f"{place}.{c}") for c in ("two", "last", "following"))
    both = F.when((last != "") & (following != ""), F.concat(F.lit("b "), last, F.lit(" "), following))
    lead = F.when(two != "", F.concat(F.lit("l "), F.regexp_replace(two, r"[\x20\x09-\x0D]+", " ")))
    return F.array_compact(F.array(lead, both))


def _places(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seed places: kind, instance, pattern), (other places: row, start, end, instance, pattern)."""
    seeds = None
    for kind in KINDS:
        one = spans.select(F.explode(kind).alias("s")).select(
            F.lit(kind).alias("kind"),
            F.lower("s.match").alias("instance"),
            F.explode(_patterns("s")).alias("pattern"),
        )
        seeds = one if seeds is None else seeds.unionByName(one)
    # a word without its closing and opening punctuation
    word = spans.select("row", F.explode("words").alias("w")).select(
        "row", "w", "w.start", "w.match",
        F.regexp_extract("w.match", r"^[\"'(\[<{]*", 0).alias("opening"),
    )
    core = F.regexp_replace(F.substr("match", F.length("opening") + 1), r"[\"')\]>}.,;:!?]+$", "")
    word = word.withColumn("core", core).withColumn("from", F.col("start") + F.length("opening"))
    digits = F.length(_digits(F.col("core")))
    known = F.col("core").rlike(PATTERNS["email"]) | F.col("core").rlike(PATTERNS["ip"]) | F.col("core").startswith("+")
    known = known | (digits.between(13, 19) & F.col("core").rlike(r"^[0-9-]+$"))
    others = word.filter(~known & ((digits >= MIN_DIGITS) | F.col("core").contains("@"))).select(
        "row", F.col("from").alias("start"), (F.col("from") + F.length("core")).alias("end"),
        F.lower("core").alias("instance"), F.explode(_patterns("w")).alias("pattern"),
    )
    return seeds, others


def discovered(spans: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row, kind, start, end) of the words found by patterns of high confidence."""
    seeds, others = _places(spans)
    known = seeds.groupBy("pattern", "kind", "instance").agg(F.count(F.lit(1)).alias("n"))
    support = known.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    able = stored(support.filter(F.col("seeds") >= MIN_SEEDS), "pii-patterns")
    edges = others.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n")).join(able.select("pattern").distinct(), "pattern")
    edges = stored(edges.select("pattern", "instance"), "pii-edges")
    # different instances of each pattern, of any kind or none
    met = known.groupBy("pattern").agg(F.count(F.lit(1)).alias("met")).join(able.select("pattern").distinct(), "pattern")
    unknown = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("unknown"))
    size = stored(met.join(unknown, "pattern", "left").select("pattern", (F.col("met") + F.coalesce("unknown", F.lit(0))).alias("met")), "pii-met")
    base = able.join(size, "pattern")
    rated = base.select("pattern", "kind", (F.col("seeds") / (F.col("met") + PRIOR)).alias("confidence"))
    for i in range(rounds):
        rated = stored(rated, f"pii-rated{i}")
        weights = edges.join(rated, "pattern").groupBy("instance", "kind").agg(F.max("confidence").alias("weight"))
        # an instance gives a pattern what its best pattern of the kind says, if that is more likely than not
        gained = (
            edges.join(weights.filter("weight > 0.5"), "instance")
            .groupBy("pattern", "kind")
            .agg(F.sum("weight").alias("gained"))
        )
        rated = base.join(gained, ["pattern", "kind"], "left").select(
            "pattern", "kind", ((F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("met") + PRIOR)).alias("confidence")
        )
    sure = stored(rated.filter(F.col("confidence") >= MIN_CONFIDENCE), "pii-sure")
    best = F.max_by("kind", F.struct(F.col("confidence"), F.col("kind"))).alias("kind")
    return others.join(sure, "pattern").groupBy("row", "start", "end").agg(best)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_discovered of every document."""
    # a row is known by its place in the written spans, so rows that repeat a doc_id stay apart
    spans = stored(base_spans(docs).withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    more = discovered(spans).groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("__more"))
    listed = spans.join(more, F.col("row") == F.col("__row"), "left")
    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")
    listed = listed.withColumn("__more", F.coalesce("__more", none))
    base = F.concat(*[F.col(kind) for kind in KINDS])
    free = F.filter(
        "__more", lambda m: ~F.exists(base, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"]))
    )
    listed = listed.withColumn("__more", F.when(F.size("__more") > 0, free).otherwise(none))

    def text(kind: str, spans_: Column) -> Column:
        return F.transform(spans_, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    def own(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    def added(kind: str) -> Column:
        mine = F.filter("__more", lambda m: m["kind"] == kind)
        return F.transform(mine, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))

    base_text = F.array_join(F.concat(*[text(k, own(k)) for k in KINDS]), ",")
    all_text = F.array_join(F.concat(*[text(k, F.array_sort(F.concat(own(k), added(k)))) for k in KINDS]), ",")
    return listed.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(base_text.cast("binary"), 256).alias("base_sha256"),
        all_text.alias("spans"),
        F.size("__more").cast("long").alias("n_discovered"),
    )
