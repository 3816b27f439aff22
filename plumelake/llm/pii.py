"""Personal data: patterns, and terms that reveal what the patterns found.

Values found by the patterns are protected entities. A word of their documents may give
them away although it is no personal data in itself. How much it gives away is estimated
from the corpus: with N documents, of which n_c hold the entity, n_t the term and
n_ct both, the term discloses

    PMI(c; t) = log2(n_ct N / (n_c n_t))    of    IC(c) = log2(N / n_c)

bits. What is left to know, IC - PMI = -log2(n_ct / n_t), depends on the chance of the entity
beside the term alone, not on N. That chance must be significant: its lower bound, at
``ALPHA`` from the number of distinct texts with both, takes the place of n_ct / n_t. A term
is flagged if at most ``LEFT`` bits are left by that bound, and if it discloses ``GENERALISE``
of what the entity has to disclose, so a common entity is not found beside every word. A
word that stands with an entity in one text proves nothing, in two texts and never without
it just enough. Flagged terms are generalised to a placeholder; those that disclose
``REMOVE`` by the plain counts are removed. Every occurrence in a text with the entity
is marked. All counts are over all documents.

Only column expressions and joins. Word counts are partial sums before the shuffle;
pairs exist only in texts with entities, once per distinct text; the spans of a text
are keyed by its digest, and a hot value or text is a skewed join that adaptive
execution splits.

Defined results: a null text is empty and has no spans; copies have equal spans;
the spans of a kind do not overlap; term spans overlap no span of a pattern.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumelake.llm.common import written

# The patterns of the contract, written without backtracking. A match
# can only begin where a run begins or the last match ended, so the lookbehinds change
# no result; possessive quantifiers keep long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
# A cheap test that a text can hold the kind at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}

GENERALISE, REMOVE = 0.8, 0.95
ALPHA = 0.05            # chance that the bound is too high
LEFT = 2.2              # bits about an entity that a flagged term leaves open
TERM = r"\p{L}{3,}"
SPAN = "array<struct<kind:string,s:int,e:int,value:string>>"
PLACEHOLDER = "[{}]"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + _luhn_digit(digits, i))
    return doubled % 10 == 0


def _luhn_digit(digits: Column, i: Column) -> Column:
    """The i-th digit from the right, every second one doubled."""
    d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
    twice = 2 * d
    return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("long") <= 255, F.lit(False)))
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(13, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _placed(matches: Column, pieces: Column) -> Column:
    """Start and end of each match from the lengths of the matches and of the pieces
    between them."""
    return F.aggregate(
        F.arrays_zip(matches.alias("m"), pieces.alias("p")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("spans")),
        lambda a, x: F.when(x["m"].isNull(), a).otherwise(F.struct(
            (a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
            F.concat(a["spans"], F.array(F.struct(
                (a["at"] + F.length(x["p"])).alias("s"),
                (a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("e")))).cast(
                "array<struct<s:int,e:int>>").alias("spans"))),
        lambda a: a["spans"])


def _described(kind: str, matches: Column, pieces: Column) -> Column:
    """The valid matches with position and value."""
    def span(x: Column, i: Column) -> Column:
        return F.when(_valid(kind, F.get(matches, i)), F.struct(
            F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.get(matches, i).alias("value")))
    return F.filter(F.transform(_placed(matches, pieces), span), lambda x: x.isNotNull())


def find_base(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``_spans``: kind, start, end and value of every valid match,
    by kind and start."""
    whole = F.coalesce(F.col(text), F.lit(""))
    plain = df.select(*keep, whole.alias("_text"))
    for kind in KINDS:
        hint = F.contains("_text", F.lit("@")) if kind == "email" else F.col("_text").rlike(HINTS[kind])
        matches = F.when(hint, F.regexp_extract_all("_text", F.lit(PATTERNS[kind]), F.lit(0)))
        plain = plain.withColumn(f"_m_{kind}", matches)
    for kind in KINDS:
        plain = plain.withColumn(f"_p_{kind}", F.when(
            F.size(f"_m_{kind}") > 0, F.split("_text", PATTERNS[kind], -1)))
    parts = []
    for kind in KINDS:
        m, p = F.col(f"_m_{kind}"), F.col(f"_p_{kind}")
        spans = _described(kind, m, p)
        parts.append(F.when(p.isNotNull(), spans.cast(SPAN)).otherwise(F.array().cast(SPAN)))
    return plain.select(*keep, F.concat(*parts).alias("_spans"))


def _words(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def held_texts(base: DataFrame) -> DataFrame:
    """The distinct texts with entities: _digest, how many ``copies`` it has, its
    ``entities``, and the text with blanks in place of the spans (``free``)."""
    once = base.where(F.size("_spans") > 0).groupBy("_digest").agg(
        F.first("_spans").alias("_spans"), F.first("_held").alias("_held"), F.count(F.lit(1)).alias("copies"))
    free = F.aggregate("_spans", F.col("_held"), lambda t, x: F.overlay(
        t, F.repeat(F.lit(" "), x["e"] - x["s"]), x["s"] + 1, x["e"] - x["s"]))
    return once.select("_digest", "copies", free.alias("free"), F.array_distinct(
        F.transform("_spans", lambda x: F.lower(x["value"]))).alias("entities"))


def mentions(held: DataFrame) -> DataFrame:
    """One row per text, entity and term of it: _digest, copies, entity, term."""
    return held.select("_digest", "copies", _words(F.col("free")).alias("_t"), F.explode("entities").alias(
        "entity")).select("_digest", "copies", "entity", F.explode("_t").alias("term"))


def occurrences(held: DataFrame) -> DataFrame:
    """Every term of the texts with its place: _digest, term, s, e."""
    zipped = F.arrays_zip(F.regexp_extract_all("free", F.lit(TERM), F.lit(0)).alias("m"),
                          F.split("free", TERM, -1).alias("p"))
    rows = held.repartition("_digest").select("_digest", F.posexplode(zipped).alias("n", "x")).where(
        F.col("x.m").isNotNull())
    end = F.sum(F.length("x.p") + F.length("x.m")).over(
        Window.partitionBy("_digest").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    placed = rows.select("_digest", F.col("x.m").alias("_m"), end.alias("e"))
    return placed.select("_digest", F.lower("_m").alias("term"), (F.col("e") - F.length("_m")).alias("s"), "e")


def disclosing(docs: DataFrame, base: DataFrame, text: str = "text", generalise: float = GENERALISE,
               held: DataFrame | None = None) -> DataFrame:
    """Pairs of entity and term with the share of the entity's information that the
    term discloses. ``base`` is the stored result of ``find_all``, ``held`` its
    ``held_texts``."""
    n_docs = base.count()
    pairs = mentions(held if held is not None else held_texts(base)).groupBy("entity", "term").agg(
        F.sum("copies").alias("n_ct"), F.count(F.lit(1)).alias("texts")).where(
        -math.log2(ALPHA) / F.col("texts") <= LEFT)     # fewer texts never prove anything
    entities = base.select(F.explode(F.array_distinct(F.transform(
        "_spans", lambda x: F.lower(x["value"])))).alias("entity")).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_c"))
    terms = docs.select(F.explode(_words(F.coalesce(F.col(text), F.lit("")))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_t"))
    known = pairs.join(entities, "entity").join(terms, "term")
    information = F.log2(n_docs / F.col("n_c"))

    open_bits = -F.log2(F.col("n_ct") / F.col("n_t"))
    # With k texts of k the bound of the chance is ALPHA to the power of 1 / k.
    careful = open_bits - math.log2(ALPHA) / F.col("texts")
    share = F.when(information > 0, 1 - open_bits / information).otherwise(0.0)
    return known.withColumn("share", share).where((careful <= LEFT) & (share >= generalise))


def find_all(docs: DataFrame, keep: list[str], text: str = "text", **how) -> tuple[DataFrame, DataFrame]:
    """The stored base spans of every row (``keep``, _digest, _spans, and the text as
    _held if it has spans), and per digest of a text the revealing terms (_digest,
    _terms: s, e, share)."""
    rows = docs.select(*keep, text, F.col(text).alias("_held")).withColumns({
        "_digest": F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))})
    base = find_base(rows, text, [*keep, "_digest", "_held"])
    base = written(base.withColumn("_held", F.when(F.size("_spans") > 0, F.col("_held"))), "pii-base")
    held = written(held_texts(base), "pii-texts")
    flagged = written(disclosing(docs, base, text, held=held, **how).select("entity", "term", "share"), "pii-terms")
    marked = written(mentions(held).join(flagged, ["entity", "term"]).groupBy("_digest", "term").agg(
        F.max("share").alias("share")), "pii-marked")
    # Only texts with a flagged term are cut into words again.
    concerned = held.join(marked.select("_digest").distinct(), "_digest", "left_semi")
    hits = occurrences(concerned).join(marked, ["_digest", "term"])
    terms = hits.groupBy("_digest").agg(F.sort_array(F.collect_list(     # terms of one text
        F.struct("s", "e", "share"))).alias("_terms"))
    # Stored, so that the join with all rows is one of two plain tables: Spark sends the
    # spans along if they are few, and splits a text with very many copies if not.
    return base, written(terms, "pii-spans")


def spans_text(base: Column, terms: Column | None = None) -> Column:
    """Spans as kind:start:end, comma-joined."""
    listed = F.transform(base, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"]))
    if terms is not None:
        more = F.transform(terms, lambda x: F.concat_ws(":", F.lit("term"), x["s"], x["e"]))
        listed = F.concat(listed, F.coalesce(more, F.array().cast("array<string>")))
    return F.array_join(listed, ",")


def sanitise(docs: DataFrame, text: str = "text", remove: float = REMOVE, **how) -> DataFrame:
    """``docs`` with personal data replaced by the name of its kind and revealing
    terms generalised or removed. Of overlapping spans the first, then the longest
    keeps its label and the others are swallowed."""
    base, terms = find_all(docs, [], text, **how)
    cut = "array<struct<s:int,e:int,label:string>>"
    named = F.transform("_spans", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"),
        F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("label"))).cast(cut)
    extra = F.transform("_terms", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"),
        F.when(x["share"] >= remove, "").otherwise(PLACEHOLDER.format("TERM")).alias("label"))).cast(cut)
    once = base.where(F.size("_spans") > 0).dropDuplicates(["_digest"])
    cuts = once.join(terms, "_digest", "left").select(F.col("_digest").alias("_of"), F.array_sort(
        F.concat(named, F.coalesce(extra, F.array().cast(cut))),
        lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(b["e"] - a["e"])).alias("_cuts"))
    whole = F.col(text)
    digest = F.md5(F.coalesce(whole, F.lit("")).cast("binary"))
    joined = docs.withColumn("_digest", digest).join(cuts, F.col("_digest") == F.col("_of"), "left")
    done = F.aggregate(
        "_cuts", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a["at"], x["e"]).alias("at"),
            F.when(x["s"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.substring(whole, a["at"] + 1, x["s"] - a["at"]), x["label"])).alias("out")),
        lambda a: F.concat(a["out"], F.substring(whole, a["at"] + 1, F.length(whole))))
    columns = [F.coalesce(done, whole).alias(c) if c == text else F.col(c) for c in docs.columns]
    return joined.select(*columns)
