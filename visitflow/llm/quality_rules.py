"""Quality rules whose cutoffs are chosen so that they reject few good documents, with a guarantee.

Statistics of whole texts are column expressions. Base rules are fixed. Each further rule rejects a text
when a statistic (a whole number, see RULES) is above a cutoff. The cutoff is chosen for each stratum, by
default the language, from labelled good documents: going from the most lenient candidate to stricter ones, a
candidate passes while the exact binomial probability of seeing as few rejected good documents, were the
true share `share` / number of rules, is at most `error` / (strata * rules). Testing in that fixed order
needs no further correction, and the division by strata and rules corrects for the many tests. So with
probability 1 - error, in every stratum, all rules together reject at most `share` of good documents.

A stratum with too few labelled documents to certify a cutoff gets none: only the base rules hold there.

Defined cases: a null text has no words. Labels that are null or of unknown documents are not used. A null or
missing stratum is one of its own. Repeated rows are each judged. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared

SPACE = "[\\x20\\x09-\\x0D]"
#: Statistic of each rule, a whole number, and its candidate cutoffs from lenient to strict.
RULES = {
    "symbol_share": [500, 300, 200, 150, 100, 80, 60, 50, 40, 30, 20, 15, 10],
    "line_share": [900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 150, 100],
    "repeat_share": [190, 170, 150, 130, 110, 90, 70, 50],
    "capital_share": [950, 900, 800, 700, 600, 500, 400, 300, 250, 200, 150],
    "mark_share": [600, 500, 400, 300, 250, 200, 150, 120, 100],
    "top_word_share": [950, 900, 800, 700, 600, 500, 400, 300, 250, 200],
}


def _with(value: Column, body) -> Column:
    """body(value), with value computed once for a row however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a run of five words that the text has twice or more."""

    def of_hashes(h: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(1), F.size(h) - 4),
            lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(5)]),
        )
        return _with(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), of_grams(g)).otherwise(F.lit(0)))

    def of_grams(g: Column) -> Column:
        return _with(F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), of_sorted)

    def of_sorted(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda e, k: (F.get(s, k - 1)["x"].eqNullSafe(e["x"])) | (F.get(s, k + 1)["x"].eqNullSafe(e["x"])),
        )
        spots = F.array_sort(F.transform(twice, lambda e: e["i"]))
        return F.aggregate(
            spots,
            F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n")),
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(5), i - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    return F.when(F.size(words) >= 6, _with(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)).otherwise(F.lit(0))


def _top_word(words: Column) -> Column:
    """How often the most common word occurs: the longest run of the sorted words."""
    return F.aggregate(
        F.array_sort(F.transform(words, lambda w: F.xxhash64(w))),
        F.struct(F.lit(0).cast("long").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("top")),
        lambda a, h: _with(
            F.when(a["last"] == h, a["run"] + 1).otherwise(F.lit(1)),
            lambda run: F.struct(h.alias("last"), run.alias("run"), F.greatest(a["top"], run).alias("top")),
        ),
        lambda a: a["top"],
    )


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Rows (doc_id, kept columns, counts) of all docs."""
    text = F.coalesce("text", F.lit(""))
    counts = _with(
        F.filter(F.split(text, SPACE + "+"), lambda w: w != ""),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
            _repeated(words).cast("long").alias("n_repeat_words"),
            _top_word(words).cast("long").alias("n_top_word"),
        ),
    )
    lines = _with(
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    measured = docs.select(
        "doc_id", *keep, counts.alias("_c"), lines.alias("_l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit("[!?]")).cast("long").alias("n_marks"),
    )
    return shared.stored(measured, "statistics").select(
        "doc_id", *keep, "_c.*", "_l.*", "n_symbols", "n_capitals", "n_marks"
    )


def _rules() -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.expr(f"{part} * 1000 div greatest({whole}, 1)")

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "capital_share": share("n_capitals", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
        "top_word_share": share("n_top_word", "n_words"),
    }


def base_failed() -> Column:
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def judged(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", share: float = 0.05, error: float = 0.05
) -> DataFrame:
    """Rows (doc_id, statistics, base_failed, kept)."""
    if stratum not in docs.columns:
        docs = docs.withColumn(stratum, F.lit(None).cast("string"))
    rows = statistics(docs, stratum).withColumn("base_failed", base_failed())
    rows = rows.withColumn("_stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    cutoffs = certified(rows, labels, share, error)
    rejected = F.lit(False)
    for name, value in _rules().items():
        known = {s: c for (s, rule), c in cutoffs.items() if rule == name}
        if known:
            table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
            rejected = rejected | F.coalesce(value > F.try_element_at(table, F.col("_stratum")), F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_stratum", stratum)


def certified(rows: DataFrame, labels: DataFrame, share: float, error: float) -> dict[tuple[str, str], int]:
    """The strictest certified cutoff by stratum and rule, from all good documents that pass the base rules."""
    good = labels.where("quality = 1").select(F.col("doc_id").alias("_good")).distinct()
    steps = F.array(*[
        F.struct(
            F.lit(name).alias("rule"),
            sum((value > cutoff).cast("int") for cutoff in RULES[name]).alias("passed"),
        )
        for name, value in _rules().items()
    ])
    seen = rows.where("NOT base_failed").join(good, F.col("doc_id") == F.col("_good"))
    least = math.ceil(math.log(error / len(RULES)) / math.log(1 - share / len(RULES)))  # none rejected, one stratum
    counts = (
        seen.select("_stratum", F.inline(steps)).groupBy("_stratum", "rule", "passed").agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("_stratum", "rule").agg(F.sum("n").alias("all")).where(F.col("all") >= least)
    found = counts.join(totals, ["_stratum", "rule"]).collect()  # a row for each candidate of each large stratum
    strata = {r["_stratum"] for r in found}
    out = {}
    for s in strata:
        for name, cutoffs in RULES.items():
            own = [r for r in found if r["_stratum"] == s and r["rule"] == name]
            if not own:
                continue
            for k, cutoff in enumerate(cutoffs):
                # a value is above cutoff k, counted from lenient, when it exceeds the len - k smallest cutoffs
                rejected = sum(r["n"] for r in own if r["passed"] >= len(cutoffs) - k)
                if not_more_than(rejected, own[0]["all"], share / len(RULES)) > error / (len(strata) * len(RULES)):
                    break
                out[s, name] = cutoff
    return out


def not_more_than(k: int, n: int, p: float) -> float:
    """The exact probability of at most k of n when each has probability p."""
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))
