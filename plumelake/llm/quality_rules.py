"""Quality rules with risk-controlled cutoffs.

Each rule compares a rate of the text, in thousandths, with a cutoff. Cutoffs are
not guessed. The rules are tightened step by step along a fixed path, the most lenient
cutoff of every rule first, then the next of every rule, and so on. At each step the
labelled documents of quality 1 tell how many good documents all rules together would
reject, and the exact binomial test must reject "more than ``risk`` of the good documents
are lost". The path ends at the first step where it does not.

Testing in a fixed order needs no correction for the steps: a step is tested only if all
before it passed, so the chance that any false one is used is that of the first. The
strata are independent paths and share ``delta`` (Bonferroni). So with probability
``1 - delta`` no stratum loses more than ``risk``, and with ``risk`` 0.02 and five strata
228 good documents of a stratum are enough for a rule that loses none.

Everything is column expressions and joins; there is no Python in the tasks.

Defined results: a null or blank text has no words and fails the base rules; a null
stratum is a stratum of its own; a stratum without enough labels keeps what the base
rules keep; labels of unknown documents, null labels and labels other than 0 and 1
are ignored; of several labels of a document the lowest counts; repeated documents
are judged one by one and count once per row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumelake.llm.common import NOT_SPACE, SPACE, words, written

WINDOW = 5          # words of a repeated window
MIN_WORDS = 10      # base rule
MAX_REPEATED = 20   # base rule, hundredths of the words

RISK = 0.02         # good documents that the rules of one stratum may lose together
DELTA = 0.05        # chance that any of the bounds fails
# Candidate cutoffs in thousandths. A document with a higher rate is rejected.
CUTOFFS = {
    "symbol_rate": [20, 40, 60, 80, 100, 150, 200, 300],
    "capital_rate": [100, 150, 200, 300, 400, 500, 600, 800],
    "dup_line_rate": [50, 100, 150, 200, 300, 400, 500, 700],
    "repeat_rate": [20, 40, 60, 80, 100, 120, 150, 180],
}
# Numerator and denominator of each rate.
RATES = {
    "symbol_rate": ("n_symbols", "word_chars"),
    "capital_rate": ("_capitals", "word_chars"),
    "dup_line_rate": ("n_dup_lines", "_lines"),
    "repeat_rate": ("n_repeat_words", "n_words"),
}


def _covered(starts: Column) -> Column:
    """Words under windows that begin at the sorted positions ``starts``."""
    steps = F.transform(starts, lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def measure(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus word_chars, n_words, n_symbols, n_dup_lines,
    n_repeat_words (long) and the helpers of the rates.

    Windows are compared by 64-bit hashes inside one text. Most texts repeat none,
    which a hash set finds in one pass; only the others are sorted.
    """
    keep = keep or []
    whole = F.coalesce(F.col(text), F.lit(""))
    step = df.select(*keep, words(whole).alias("_w"), F.filter(
        F.split(whole, "\n"), lambda x: x.rlike(NOT_SPACE)).alias("_l"),
        F.length(F.regexp_replace(whole, f"{SPACE}+", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long").alias("_capitals"))
    n = F.size("_w")
    step = step.select(
        *keep, "word_chars", "n_symbols", "_capitals", n.cast("long").alias("n_words"),
        F.size("_l").cast("long").alias("_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(n > WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
            *[F.get(F.col("_w"), i + k) for k in range(WINDOW)]))).alias("_g"))
    plain = [c for c in step.columns if c != "_g"]
    step = step.select(*plain, "_g", (F.size(F.array_distinct("_g")) < F.size("_g")).alias("_again"))
    step = step.select(*plain, F.when(F.col("_again"), F.sort_array(
        F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))

    def twin(x, j, away):
        return F.coalesce(F.get(F.col("_s"), j + away)["h"] == x["h"], F.lit(False))

    step = step.select(*plain, F.when(F.col("_s").isNotNull(), F.sort_array(F.filter(
        F.transform("_s", lambda x, j: F.when(
            F.when(j > 0, twin(x, j, -1)).otherwise(False) | twin(x, j, 1), x["i"])),
        lambda p: p.isNotNull()))).alias("_starts"))
    return step.select(*plain, F.coalesce(_covered(F.col("_starts")), F.lit(0)).cast("long").alias(
        "n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def rate(rule: str) -> Column:
    """Whole thousandths, rounded down; 0 where there is nothing to divide by."""
    top, bottom = RATES[rule]
    return F.when(F.col(bottom) > 0, F.floor(1000 * F.col(top) / F.col(bottom))).otherwise(0)


def _log_factorial(n: Column) -> Column:
    """ln n!, from the exact table up to 20 and Stirling's series above."""
    x = n.cast("double") + 1
    series = ((x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi)
              + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
                  ).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), where k < n p; 1 where it is not lower than
    the mean, which is never evidence for a lower risk.

    The term at k comes from logarithms, the terms below it from their ratio. What
    lies more than twelve deviations below k adds nothing to a double.
    """
    k, n = k.cast("long"), n.cast("long")
    first = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
                  + k * math.log(p) + (n - k) * math.log1p(-p))
    most = F.least(k, F.ceil(12 * F.sqrt(n * p)) + 64)
    sums = F.aggregate(
        F.when(most > 0, F.sequence(F.lit(1).cast("long"), most)).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (k - j + 1) * (1 - p) / ((n - k + j) * p)).alias("term"),
            (a["sum"] + a["term"] * (k - j + 1) * (1 - p) / ((n - k + j) * p)).alias("sum")),
        lambda a: a["sum"])
    return F.when(k < n * p, first * sums).otherwise(1.0)


def path_of(cutoffs: dict[str, list[int]]) -> list[tuple[str, int]]:
    """Steps of the path: the rule that is tightened, and its new cutoff."""
    lenient_first = {r: sorted(cs, reverse=True) for r, cs in cutoffs.items()}
    longest = max(map(len, lenient_first.values()))
    return [(r, cs[n]) for n in range(longest) for r, cs in lenient_first.items() if n < len(cs)]


def choose_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK,
                   delta: float = DELTA, cutoffs: dict[str, list[int]] | None = None) -> DataFrame:
    """One row per stratum and rule with a usable cutoff: ``cutoff``; and of the step that
    was taken the labelled good documents, the good and bad ones that all rules together
    reject (``lost``, ``gain``), and the tail probability.

    Of the steps that passed, the one that gains most, bad minus good documents, is taken;
    among equals the first. Counts are partial sums over all labelled documents that pass
    the base rules; there is one row per stratum.
    """
    path = path_of(cutoffs or CUTOFFS)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(
        "doc_id").agg(F.min("quality").alias("_quality"))
    holdout = measured.where(~base_failed()).join(known, "doc_id")
    # The step from which on a document is rejected.
    since = F.least(*[F.when(rate(r) > c, F.lit(j)) for j, (r, c) in enumerate(path, 1)])
    counted = holdout.withColumn("_since", since).groupBy(stratum).agg(
        F.sum(F.col("_quality")).alias("n"),
        *[F.count_if((F.col("_since") <= j) & (F.col("_quality") == q)).alias(f"{j}-{q}")
          for j in range(1, len(path) + 1) for q in (0, 1)])
    steps = F.array(*[F.struct(
        F.lit(j).alias("step"), F.lit(r).alias("rule"), F.lit(c).alias("cutoff"),
        F.col(f"`{j}-1`").alias("lost"), F.col(f"`{j}-0`").alias("gain")) for j, (r, c) in enumerate(path, 1)])
    counted = written(counted, "quality-counts")
    level = delta / max(counted.count(), 1)
    rows = counted.select(stratum, "n", F.explode(steps).alias("t")).select(stratum, "n", "t.*").withColumn(
        "tail", binomial_tail(F.col("lost"), F.col("n"), risk))
    failed = F.coalesce(F.min(F.when(F.col("tail") > level, F.col("step"))), F.lit(len(path) + 1)).alias("_failed")
    net = F.when(F.col("gain") > F.col("lost"), F.struct(
        (F.col("gain") - F.col("lost")).alias("net"), (-F.col("step")).alias("minus"), "n", "lost", "gain", "tail"))
    # A stratum has one row per step, and there is a row per stratum.
    ends = rows.groupBy(stratum).agg(failed).withColumnRenamed(stratum, "_of")
    passed = rows.join(ends, F.col(stratum).eqNullSafe(F.col("_of"))).where(F.col("step") < F.col("_failed"))
    best = passed.groupBy(stratum).agg(F.max(net).alias("b")).where(F.col("b").isNotNull())
    taken = best.select(F.col(stratum).alias("_of"), "b")
    return rows.select(stratum, "step", "rule", "cutoff").join(taken, F.col(stratum).eqNullSafe(F.col("_of"))).where(
        F.col("step") <= -F.col("b.minus")).groupBy(stratum, "rule").agg(F.min("cutoff").alias("cutoff"), F.first("b").alias("b")).select(
        stratum, "rule", "cutoff", "b.n", "b.lost", "b.gain", "b.tail")


def judge(measured: DataFrame, chosen: DataFrame, stratum: str) -> DataFrame:
    """``measured`` plus ``base_failed`` and ``kept``. ``chosen`` has one small row per
    stratum after the pivot; Spark sends it to all tasks if its size allows."""
    limits = chosen.groupBy(stratum).agg(*[
        F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_max_{r}") for r in RATES])
    limits = limits.withColumnRenamed(stratum, "_stratum")
    limits = written(limits, "quality-limits")
    joined = measured.join(limits, measured[stratum].eqNullSafe(limits["_stratum"]), "left")
    broken = reduce(lambda a, b: a | b, [
        F.coalesce(rate(r) > F.col(f"_max_{r}"), F.lit(False)) for r in RATES])
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~broken).drop("_stratum", *[f"_max_{r}" for r in RATES])


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **how) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every document. The measures are
    stored once, since both the choice and the verdict read them."""
    measured = written(measure(docs, "text", ["doc_id", stratum]), "quality-measures")
    return judge(measured, choose_cutoffs(measured, labels, stratum, **how), stratum)
