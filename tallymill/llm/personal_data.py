"""Personal data: fixed patterns, and terms that disclose what the patterns protect.

Base spans are e-mail addresses, IP addresses, payment cards and telephone numbers. The
distinct values that they match are the protected entities. The corpus tells how strongly
a term, a run of letters of any length, reveals an entity: with ``N`` distinct texts,
``n(e)`` that hold the entity, ``n(t)`` that hold the term and ``n(e, t)`` that hold both,
anywhere, the pointwise mutual information ``log2(n(e, t) N / (n(e) n(t)))`` is what the
term tells about the entity, and ``log2(N / n(e))`` is all there is to tell. Where the first
reaches the share ``generalise`` of the second the term is generalised to its first two
letters, and where it reaches ``remove``, or has fewer than four letters, it is removed,
throughout the texts that hold the entity. Counts are over all documents; copies of a text
count once. There is no fixed floor: a pair counts where chance would bring so many texts
together, for any of the corpus's terms, with a probability of ``doubt`` at most.

Entities that the same texts hold are one in all of this, and so are terms, so a long text
with thousands of both is a few pairs. Texts without a base span never meet the terms.

Only DataFrame functions are used. Offsets are code points, ends are exclusive; null texts
count as empty, very long texts are read whole, and rows that repeat are treated alike. An
empty table has no rows. Equal shares of a term with several entities are treated as the
stronger one asks. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.registry import let, query, table
from tallymill.session import stored

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract. A start inside a run that already failed fails as well,
# so starts are tried only where a run or the last match ends; possessive repeats keep
# long runs from being tried again character by character.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be worth trying.
_SIGNS = {"email": "%@%", "phone": "%+%", "ip": "%.%"}
_TERM = r"\p{L}+"
#: The first two letters of a shorter term tell too much of it.
_SHORT = 4
# Hashes of repeated texts that are sent to every task; more of them are joined.
_SENT = 1_000_000


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled, less 9 above 9; the sum ends in 0."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        plain = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(plain, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 4).cast("int") <= 255))
    count = F.length(_digits(match))
    if kind == "phone":
        return count.between(10, 15)
    return count.between(14, 19) & _luhn(_digits(match))


def _lengths(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.length(x))


def found_spans(text: Column, pattern: str, kind: str, number: int, wanted) -> Column:
    """Spans of the matches of ``pattern`` that ``wanted`` accepts.

    The text between matches and the matches before it add up to a match's start; this is
    worked out for accepted matches only.
    """
    cut = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("pieces")
    )

    def spans(c: Column) -> Column:
        accepted = F.filter(
            F.transform(c["matches"], lambda m, i: F.struct(m.alias("m"), i.alias("i"))), lambda x: wanted(x["m"])
        )
        return F.transform(
            accepted,
            lambda x: let(
                _lengths(F.slice(c["pieces"], 1, x["i"] + 1)) + _lengths(F.slice(c["matches"], 1, x["i"])),
                lambda start: F.struct(
                    start.alias("start"),
                    F.lit(number).alias("number"),
                    (start + F.length(x["m"])).alias("end"),
                    F.lit(kind).alias("kind"),
                ),
            ),
        )

    return let(cut, spans)


def base_spans(text: Column) -> Column:
    """All base spans by start, then by kind."""
    each = []
    for number, kind in enumerate(KINDS):
        found = found_spans(text, PATTERNS[kind], kind, number, lambda m, kind=kind: _valid(kind, m))
        worth = text.rlike("[0-9]") if kind in ("card", "ip") else F.lit(True)
        if kind in _SIGNS:
            worth = worth & text.like(_SIGNS[kind])
        each.append(F.when(worth, found).otherwise(_no_spans()))
    return F.array_sort(F.concat(*each))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _evidence(both: Column, one: Column, other: Column, texts: int) -> Column:
    """Minus the log of a bound on the chance that ``one`` texts hold ``both`` of ``other`` or more.

    Chernoff's bound, which holds for draws without replacement as well.
    """
    share, expected = both / one, other / F.lit(float(texts))
    rest = F.when(both < one, (one - both) * F.log((1 - share) / (1 - expected))).otherwise(0.0)
    return both * F.log(share / expected) + rest


def _unique_texts(whole: DataFrame) -> tuple[DataFrame, int]:
    """One row per distinct text of ``whole`` (text, text_hash), and their number.

    Only the rows of texts that repeat are brought together; a text alone stays where it is.
    """
    hashed = whole.select("text", F.xxhash64("text").alias("text_hash"))
    counts = hashed.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = stored(counts, "repeated-texts")
    found = repeated.agg(F.count(F.lit(1)), F.sum(F.col("n") - 1)).first()
    names = repeated.select("text_hash")
    names = F.broadcast(names) if found[0] <= _SENT else names
    alone = hashed.join(names, "text_hash", "left_anti")
    again = hashed.join(names, "text_hash", "left_semi").dropDuplicates(["text_hash"])
    return alone.unionByName(again).select("text", "text_hash"), whole.count() - (found[1] or 0)


def _class_of(key: str, rows: DataFrame) -> DataFrame:
    """(key, class): keys with the same set of ``text_hash`` have the same class."""
    marks = [F.bit_xor(F.xxhash64("text_hash", F.lit(i))) for i in range(2)]
    return rows.groupBy(key).agg(F.xxhash64(F.count(F.lit(1)), *marks).alias("class"))


def disclosing_terms(docs: DataFrame, text: str, generalise: float, remove: float, doubt: float) -> DataFrame:
    """(text_hash, removed, generalised): the disclosing terms of each text, with how to treat them.

    Terms are given by their hashes.
    """
    whole = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))

    def terms_of(content: Column) -> Column:
        words = F.array_distinct(F.regexp_extract_all(F.lower(content), F.lit(_TERM), F.lit(0)))
        return F.transform(words, lambda w: F.xxhash64(w))

    once, texts = _unique_texts(whole)
    some = once.filter(F.col("text").rlike("[0-9@]")).withColumn("spans", base_spans(F.col("text")))
    some = some.filter(F.size("spans") > 0)
    plain = F.col("text")
    for kind in KINDS:
        plain = F.regexp_replace(plain, PATTERNS[kind], " ")

    def entity(t: Column, s: Column) -> Column:
        value = F.lower(F.substring(t, s["start"] + 1, s["end"] - s["start"]))
        digits = s["kind"].isin("card", "phone")
        return F.xxhash64(F.concat_ws(" ", s["kind"], F.when(digits, _digits(value)).otherwise(value)))

    held = stored(
        some.select(
            "text_hash",
            terms_of(plain).alias("terms"),
            let(F.col("text"), lambda t: F.array_distinct(F.transform("spans", lambda s: entity(t, s)))).alias("entities"),
        ),
        "entities",
    )
    # Terms are counted before the join, so their occurrences are never matched one by one.
    counts = stored(
        once.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t")),
        "term-counts",
    )
    need = math.log(max(1, counts.count()) / doubt)
    # A single text is evidence of log N at most, so nothing that would pass is left out here.
    least = 1 if math.log(max(1, texts)) >= need else 2

    named = stored(held.select("text_hash", F.explode("entities").alias("entity")), "entity-texts")
    alike = _class_of("entity", named)
    named = named.join(alike, "entity").select("text_hash", F.col("class").alias("entity")).distinct()
    entities = named.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).filter(F.col("n_e") >= least)
    named = stored(named.join(entities.filter(F.col("n_e") < texts), "entity"), "named-texts")
    largest = named.agg(F.max("n_e")).first()[0] or 0

    def most(n_e):
        """n(e, t) is n(e) at most, so a term in more texts than this tells too little."""
        return (n_e / float(max(1, texts))) ** generalise * texts * (1 + 1e-9)

    rare = counts.filter((F.col("n_t") >= least) & (F.col("n_t") <= most(largest)))
    wanted = stored(
        held.join(named.select("text_hash").distinct(), "text_hash", "left_semi")
        .select("text_hash", F.explode("terms").alias("term"))
        .join(rare, "term"),
        "rare-terms",
    )
    # Terms of one class are in the same of these texts, and in as many texts in all.
    groups = _class_of("term", wanted).join(rare, "term")
    groups = stored(groups.select("term", "n_t", F.xxhash64("class", "n_t").alias("group")), "term-groups")
    grouped = wanted.join(groups.select("term", "group"), "term").select("text_hash", "group", "n_t").distinct()
    pairs = stored(
        named.join(grouped, "text_hash").filter(F.col("n_t") <= most(F.col("n_e"))), "entity-terms"
    )
    both = pairs.groupBy("entity", "group", "n_e", "n_t").agg(F.count(F.lit(1)).alias("n_et"))
    told = F.log2(F.col("n_et") * F.lit(float(texts)) / (F.col("n_e") * F.col("n_t")))
    share = told / F.log2(F.lit(float(texts)) / F.col("n_e"))
    n_e, n_t, n_et = F.col("n_e"), F.col("n_t"), F.col("n_et")
    evidence = F.greatest(_evidence(n_et, n_e, n_t, texts), _evidence(n_et, n_t, n_e, texts))
    strong = (
        both.withColumn("share", share)
        .filter((F.col("share") >= generalise) & (evidence >= need))
        .select("entity", "group", (F.col("share") >= remove).alias("removed"))
    )
    per_text = (
        pairs.join(strong, ["entity", "group"])
        .groupBy("text_hash", "group")
        .agg(F.max("removed").alias("removed"))
        .join(groups.select("group", "term"), "group")
        .groupBy("text_hash")
        .agg(
            F.collect_list(F.when(F.col("removed"), F.col("term"))).alias("removed"),
            F.collect_list(F.when(~F.col("removed"), F.col("term"))).alias("generalised"),
        )
    )
    return stored(per_text, "disclosing-terms")


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")


def _without_overlaps(spans: Column) -> Column:
    """The spans that begin where the last one kept has ended."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), _no_spans().alias("kept")),
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["kept"], F.array(s)).alias("kept"))
        ),
        lambda a: a["kept"],
    )


def _replaced(row: Column) -> Column:
    """The text of ``row`` (t) with its spans (s), which do not overlap, replaced; one piece per span."""
    text, spans = row["t"], row["s"]

    def piece(s: Column, i: Column) -> Column:
        begin = F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
        new = F.when(
            s["kind"] == "general", F.concat(F.substring(text, s["start"] + 1, F.lit(2)), F.lit("*"))
        ).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(F.substring(text, begin + 1, s["start"] - begin), new)

    last = F.coalesce(F.get(spans, F.size(spans) - 1)["end"], F.lit(0))
    return F.concat(F.array_join(F.transform(spans, piece), ""), F.substring(text, last + 1, F.length(text)))


def sanitise(
    docs: DataFrame,
    text: str = "text",
    generalise: float = 0.5,
    remove: float = 0.8,
    doubt: float = 0.05,
    names: tuple[str, str, str] = ("base", "spans", "sanitised"),
) -> DataFrame:
    """``docs`` with base spans, all spans (arrays of start, number, end, kind) and clean text.

    Spans of disclosing terms have the kind ``term`` or ``general`` and never overlap a
    base span. Base spans that overlap are replaced once, by the kind that begins first.
    The three columns are called ``names`` and replace columns of these names.
    """
    terms = disclosing_terms(docs, text, generalise, remove, doubt).withColumnRenamed("text_hash", "_hash")
    kept = [c for c in docs.columns if c not in names]
    # The input travels as one struct, so its column names cannot clash with those below.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # A base span has a digit or an at sign; a text without any goes its own way at once.
    maybe = F.col("_text").rlike("[0-9@]")
    rows = rows.withColumn("base", F.when(maybe, base_spans(F.col("_text"))).otherwise(_no_spans()))
    bare = rows.filter(~maybe | (F.size("base") == 0)).withColumn("spans", F.col("base"))
    rows = rows.filter(maybe & (F.size("base") > 0)).join(terms, F.xxhash64("_text") == F.col("_hash"), "left")

    def of(kind: str, number: int, wanted) -> Column:
        return found_spans(F.col("_text"), _TERM, kind, number, lambda m: let(F.lower(m), wanted))

    def removed(word: Column) -> Column:
        short = F.array_contains("generalised", F.xxhash64(word)) & (F.length(word) < _SHORT)
        return F.array_contains("removed", F.xxhash64(word)) | short

    def generalised(word: Column) -> Column:
        return F.array_contains("generalised", F.xxhash64(word)) & (F.length(word) >= _SHORT)

    added = F.filter(
        F.concat(of("term", 4, removed), of("general", 5, generalised)),
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    rows = rows.withColumn(
        "spans", F.when(F.col("_hash").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", added)))
    )
    overlap = F.exists(
        F.sequence(F.lit(1), F.size("spans") - 1),
        lambda i: F.get("spans", i)["start"] < F.get("spans", i - 1)["end"],
    )
    apart = F.when((F.size("spans") > 1) & overlap, _without_overlaps(F.col("spans"))).otherwise(F.col("spans"))
    whole = F.col("_row")[text]
    rows = rows.withColumn("_clean", let(F.struct(F.col("_text").alias("t"), apart.alias("s")), _replaced))
    sanitised = F.col("_clean")
    rows = rows.select("_row", "base", "spans", "_clean").unionByName(
        bare.select("_row", "base", "spans", whole.alias("_clean"))
    )
    return rows.select(
        *(F.col("_row")[c].alias(c) for c in kept),
        *(c.alias(n) for c, n in zip((F.col("base"), F.col("spans"), sanitised), names, strict=True)),
    )


@query("op5_disclosing_terms")
def op5_disclosing_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digests of every document's spans."""
    found = sanitise(table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
