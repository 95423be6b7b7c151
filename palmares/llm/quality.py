"""Quality rules whose thresholds bound the risk of rejecting good text.

For each rule and stratum a cutoff is chosen on labelled rows: the tightest whose rate of false rejection is shown,
by an exact binomial test, to lie below the allowed share, at a level divided by the number of all tests made.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, total, words, written

#: Most good texts that may be rejected in a stratum, by all rules together, and the chance that a stratum exceeds it.
RISK = 0.05
CHANCE = 0.05
#: Cutoffs tried for each rule; a text fails if its value is above (sign 1) or below (sign -1) the cutoff.
RULES: dict[str, tuple[int, tuple[float, ...]]] = {
    "symbol_share": (1, (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3)),
    "dup_line_share": (1, (0.05, 0.1, 0.2, 0.3, 0.5)),
    "repeat_share": (1, (0.02, 0.05, 0.1, 0.15)),
    "long_word_mean": (1, (7.0, 8.0, 9.0, 10.0, 12.0, 15.0)),
    "short_word_mean": (-1, (2.0, 2.5, 3.0, 3.5, 4.0)),
    "few_words": (-1, (12.0, 15.0, 20.0, 30.0)),
}
_WIDTH = 5


def _repeat_words(ws: Column) -> Column:
    """Words inside windows of five words that the text holds twice or more.

    Windows are told apart by two 64-bit hashes; a text whose hashes all differ is done after one pass. Otherwise
    (hash, place) pairs are sorted, so equal windows are neighbours, and the places found are joined to stretches.
    """
    def window(hs: Column) -> Column:
        at = lambda i, k: F.get(hs, i + k)
        return F.transform(F.sequence(F.lit(0), F.size(hs) - _WIDTH), lambda i: F.xxhash64(*[at(i, k) for k in range(_WIDTH)]))

    def covered(places: Column) -> Column:
        n = F.size(places)
        gap = lambda p, i: F.when(i + 1 < n, F.least(F.get(places, i + 1) - p, F.lit(_WIDTH))).otherwise(F.lit(_WIDTH))
        return total(F.transform(places, lambda p, i: gap(p, i).cast("long")))

    def places(hs: Column) -> Column:
        pairs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))),
            lambda x: x["i"])))

    def count(hs: Column) -> Column:
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(let(places(hs), covered))

    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) < _WIDTH + 1, F.lit(0).cast("long")).otherwise(let(hashed, lambda hs: let(window(hs), count)))


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (longs) of a text; zeros for null."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    return let(words(text), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        total(F.transform(ws, lambda w: F.length(w).cast("long"))).alias("word_chars"),
        (F.size(F.split(body, r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long")).alias("n_dup_lines"),
        _repeat_words(ws).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines")))


def _values() -> dict[str, Column]:
    """The value each rule compares, from the columns of ``measures``; null where it is undefined (the rule then passes)."""
    n = F.nullif(F.col("n_words"), F.lit(0))
    mean = F.col("word_chars") / n
    return {
        "symbol_share": F.col("n_symbols") / F.nullif(F.col("word_chars"), F.lit(0)),
        "dup_line_share": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)),
        "repeat_share": F.col("n_repeat_words") / n,
        "long_word_mean": mean,
        "short_word_mean": mean,
        "few_words": F.col("n_words").cast("double"),
    }


def _fails(value: Column, sign: int, cutoff: Column) -> Column:
    return F.coalesce((value > cutoff) if sign > 0 else (value < cutoff), F.lit(False))


def tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed exactly in logarithms from the term at 0; the terms follow from each other."""
    step = F.struct(F.lit(0.0).alias("q"), F.lit(0.0).alias("s"))
    first = n * F.log(F.lit(1 - p))
    odds = F.log(F.lit(p / (1 - p)))

    def add(acc: Column, j: Column) -> Column:
        q = acc["q"] + F.log((n - j + 1) / j) + odds
        return F.struct(q.alias("q"), (acc["s"] + F.exp(first + q)).alias("s"))

    begun = F.struct(step["q"].alias("q"), F.exp(first).alias("s"))
    # a sum over an empty range: k = 0 has the first term alone
    js = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(js, begun, add, lambda acc: F.least(acc["s"], F.lit(1.0)))


def cutoffs(good: DataFrame, stratum: str, risk: float = RISK, chance: float = CHANCE) -> DataFrame:
    """Rows (stratum, rule, cutoff, n, failed, p): the tightest proven cutoff by rule and stratum; none proven gives no row.

    ``good`` has one row per text labelled good with its ``measures``. Each rule may reject ``risk`` / rules; the null
    hypothesis that it rejects more is tested at ``chance`` / (rules x cutoffs), which holds for all of them together.
    Counting is one grouped sum: a row a stratum leaves each task, whatever the size of a stratum.
    """
    values = _values()
    tests = sum(len(c) for _, c in RULES.values())
    counts = [F.sum(_fails(values[r], sign, F.lit(c)).cast("long")).alias(f"{r}__{k}") for r, (sign, cs) in RULES.items() for k, c in enumerate(cs)]
    summed = good.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n"), *counts)
    cells = F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.lit(sign * c * -1.0).alias("loose"), F.col(f"{r}__{k}").alias("failed"))
        for r, (sign, cs) in RULES.items() for k, c in enumerate(cs)])
    tried = summed.select("stratum", "n", F.explode(cells).alias("c")).select("stratum", "n", "c.*")
    # far above the allowed number the test cannot succeed: the sum is left out there
    share = risk / len(RULES)
    hopeful = tried.where(F.col("failed") <= F.col("n") * share)
    proven = hopeful.withColumn("p", tail(F.col("n"), F.col("failed"), share)).where(F.col("p") <= chance / tests)
    best = F.max_by(F.struct("cutoff", "n", "failed", "p"), F.col("loose")).alias("b")
    return proven.groupBy("stratum", "rule").agg(best).select("stratum", "rule", "b.*")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, chance: float = CHANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed, kept, failed_rules and the stratum.

    base_failed: under 10 words, or over a fifth of the words repeat in windows. Other texts are kept unless their value is
    beyond a proven cutoff of their stratum. Cutoffs come from rows labelled quality 1 that pass the base; a stratum with
    too few of them to prove anything rejects nothing; a null stratum is one of its own. Null texts have no words.
    Null labels are none; an id labelled twice is good only if all its labels are.
    """
    m = measures(docs["text"]).alias("m")
    base = docs.select(docs["doc_id"], docs[stratum].alias("stratum"), m).select("doc_id", "stratum", "m.*")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    base = written(base.withColumn("base_failed", failed), "measures")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select(F.col("doc_id").alias("good_id"))
    held = base.where(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("good_id"), "left_semi")
    limits = written(cutoffs(held, "stratum", risk, chance), "cutoffs")
    wide = limits.groupBy(F.col("stratum").alias("of")).pivot("rule", list(RULES)).agg(F.first("cutoff"))
    values = _values()
    joined = base.join(wide, base["stratum"].eqNullSafe(wide["of"]), "left")
    bad = F.filter(F.array(*[F.when(_fails(values[r], sign, F.col(r)), F.lit(r)) for r, (sign, _) in RULES.items()]), lambda x: x.isNotNull())
    out = joined.withColumn("failed_rules", bad)
    return out.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), F.array_join("failed_rules", ",").alias("failed_rules"))
