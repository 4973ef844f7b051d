"""Quality rules with risk-controlled thresholds, with DataFrame functions only.

Each rule is a ratio of plain counts and a fixed list of cutoffs. The rules' cutoffs go
together from lax to strict in ``LEVELS`` joint settings, each of which rejects what the
one before it does and more. Documents that labels call good and that the base rules let
through are the holdout. In each stratum (language) the settings are tested one after
the other, lax ones first: the exact binomial chance of so few good documents beyond any
cutoff of a setting, were their true share at the risk, must stay under the error level;
the first setting that fails ends the walk, and the last that passed is used. Tests in a
fixed order that end at the first failure need no correction among themselves; the error
level is divided by the number of strata (Bonferroni). So at most ``risk`` of the good
documents of a stratum go, in all strata at once, with chance 1 - ``error``. Without a
setting that passes (fewer than some 220 good documents prove none) no rule acts.

Defined cases: a null or empty text has no words and fails the base rule; a null
stratum is a stratum of its own; labels that are null or match no document do not
count; ties at a cutoff are kept (a rule rejects beyond it); repeated rows repeat;
an empty table gives an empty table; without labels all rules stay off.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import materialise

SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\x0b\f\r"
#: Largest share of good documents that may go, per stratum; chance of a wrong promise.
RISK, ERROR = 0.02, 0.05


def measures(text: Column) -> dict[str, Column]:
    """Counts on arrays within a row; nothing is shuffled."""
    squeezed = F.trim(F.regexp_replace(F.translate(text, GAPS[1:], " " * (len(GAPS) - 1)), " +", " "))
    return {"words": F.when(squeezed == "", F.array().cast("array<string>")).otherwise(F.split(squeezed, " ")), "letters": F.translate(text, GAPS, "")}


def document_measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, stratum text counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and more."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    got = measures(F.col("text"))
    base = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), text.alias("text"))
    one = base.select("*", got["words"].alias("words"), got["letters"].alias("letters"))
    two = one.select(
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length("letters").cast("long").alias("word_chars"),
        (F.length("letters") - F.length(F.translate("letters", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("letters") - F.length(F.translate("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
        (F.length("letters") - F.length(F.translate("letters", "!?.,;:", ""))).cast("long").alias("n_points"),
        F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, GAPS, "") != "").alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    window = lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2))
    three = two.select("*", F.when(F.col("n_words") >= 3, F.transform(F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(1))), window)).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    four = three.select("*", F.when(repeats, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ordered"))
    twice = F.expr("filter(ordered, (x, k) -> (k > 0 AND get(ordered, k - 1).h = x.h) OR (k < size(ordered) - 1 AND get(ordered, k + 1).h = x.h))")
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return four.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("ordered").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_capitals",
        "n_points",
    )


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


#: rule: (value, cutoffs from strict to lax); a document beyond the cutoff is rejected.
RULES: dict[str, tuple[Column, list[float]]] = {
    "symbols": (lambda: ratio(F.col("n_symbols"), F.col("word_chars")), [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3]),
    "dup_lines": (lambda: ratio(F.col("n_dup_lines"), F.col("n_lines")), [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5]),
    "repeats": (lambda: ratio(F.col("n_repeat_words"), F.col("n_words")), [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5]),
    "capitals": (lambda: ratio(F.col("n_capitals"), F.col("word_chars")), [0.05, 0.08, 0.12, 0.2, 0.3, 0.5]),
    "points": (lambda: ratio(F.col("n_points"), F.col("word_chars")), [0.05, 0.08, 0.12, 0.2, 0.3]),
    "long_words": (lambda: ratio(F.col("word_chars"), F.col("n_words")), [7.0, 8.0, 9.0, 10.0, 12.0, 15.0]),
    "short_words": (lambda: -ratio(F.col("word_chars"), F.col("n_words")), [-4.5, -4.0, -3.5, -3.0, -2.5]),
}


#: Joint settings of all rules, lax ones first.
LEVELS = 8


def setting(level: int) -> dict[str, float]:
    """The rules' cutoffs of a joint setting, 0 the laxest."""
    return {rule: cuts[len(cuts) - 1 - level * (len(cuts) - 1) // (LEVELS - 1)] for rule, (_, cuts) in RULES.items()}


#: ln Gamma's remainder after Stirling's formula, for small whole numbers; its series serves the others.
SMALL = 16
REMAINDERS = [0.0, *(math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi) for n in range(1, SMALL))]


def _remainder(n: Column) -> Column:
    x = n.cast("double")
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n < SMALL, F.get(F.array(*map(F.lit, REMAINDERS)), n.cast("int"))).otherwise(series)


def _deviance(x: Column, mean: Column) -> Column:
    """x ln(x / mean) + mean - x, 0 for x = 0 up to the mean."""
    return F.when(x > 0, x * F.log(x / mean)).otherwise(0.0) + mean - x


def log_binomial_mass(k: Column, n: Column, p: float) -> Column:
    """ln P(X = k) for X ~ Bin(n, p) in saddle-point form, exact to rounding for any n."""
    inner = _remainder(n) - _remainder(k) - _remainder(n - k) - _deviance(k, n * p) - _deviance(n - k, n * (1 - p)) + 0.5 * F.log(n / (2 * math.pi * k * (n - k)))
    return F.when(k == 0, n * math.log1p(-p)).when(k == n, n * math.log(p)).otherwise(inner)


def _log_tail(k: Column, n: Column, p: float, needed: Column) -> Column:
    """ln P(X <= k) for X ~ Bin(n, p) with k below the mean; no steps where it is not needed.

    Terms are summed downwards from k until they no longer count: each is less than
    the one before by at least the first ratio, and far below k they fall as a normal
    curve does, so their number is bounded by some ten standard deviations.
    """
    odds = (1 - p) / p
    ratio = F.greatest(k * odds / (n - k + 1), F.lit(1e-300))
    enough = F.least(k, F.ceil(40 / -F.log(F.least(ratio, F.lit(1 - 1e-12)))), F.ceil(10 * F.sqrt(n * (p * (1 - p))) + 40)).cast("long")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(s: Column, j: Column) -> Column:  # from P(k - j) to P(k - j - 1)
        term = s["term"] * (k - j) * odds / (n - k + j + 1)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    steps = F.when(needed & (enough > 0), F.sequence(F.lit(0).cast("long"), enough - 1)).otherwise(F.array().cast("array<bigint>"))
    return log_binomial_mass(k, n, p) + F.log(F.aggregate(steps, start, add, lambda s: s["total"]))


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) for X ~ Bin(n, p), by the tail on k's side of the mean."""
    k, n = k.cast("long"), n.cast("long")
    below = k < n * p
    above = F.greatest(n - k - 1, F.lit(0))  # P(X > k) is P(Y <= n - k - 1) for Y ~ Bin(n, 1 - p)
    return F.when(k >= n, F.lit(0.0)).when(below, _log_tail(k, n, p, below)).otherwise(F.log1p(-F.exp(_log_tail(above, n, 1 - p, ~below))))


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, level, n_good, n_rejected): the strictest joint setting with a proven risk.

    A stricter setting rejects at least as many, so those that pass are the first ones.
    """
    good = labels.where("quality = 1").select("doc_id").distinct()
    held = measured.where("NOT base_failed").join(good, "doc_id", "left_semi")
    beyond = [F.count_if(rejects(level)).alias(f"beyond_{level}") for level in range(LEVELS)]
    counted = held.groupBy("stratum").agg(F.count("*").alias("n_good"), *beyond)
    long = counted.select("stratum", "n_good", F.inline(F.array(*[F.struct(F.lit(level).alias("level"), F.col(f"beyond_{level}").alias("n_rejected")) for level in range(LEVELS)])))
    strata = counted.agg(F.count("*").alias("strata"))
    proven = long.crossJoin(F.broadcast(strata)).where(log_binomial_cdf(F.col("n_rejected"), F.col("n_good"), risk) <= math.log(error) - F.log("strata"))  # one row
    return proven.groupBy("stratum").agg(F.max(F.struct("level", "n_good", "n_rejected")).alias("x")).select("stratum", "x.*")


def rejects(level: int) -> Column:
    """Whether a document lies beyond any cutoff of a joint setting."""
    out = F.lit(False)
    for rule, cut in setting(level).items():
        out = out | (RULES[rule][0]() > cut)
    return out


def quality_verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Every document's measures, base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = materialise(document_measures(docs).withColumn("base_failed", failed), "measures")
    chosen = thresholds(measured, labels, risk, error).select("stratum", "level")
    rejected = F.lit(False)
    for level in range(LEVELS):
        rejected = F.when(F.col("level") == level, rejects(level)).otherwise(rejected)
    # One row a stratum that has labels; AQE broadcasts it as long as it is small.
    return measured.join(chosen, "stratum", "left").withColumn("kept", ~F.col("base_failed") & ~rejected).drop("level", "stratum")
