"""Quality rules as weak supervision, in DataFrame operations only.

Every rule looks at one statistic of a text and votes good, bad or abstains. A
two-class latent model with class-conditional vote rates (Dawid and Skene) is fitted
by expectation-maximisation on the table of distinct vote patterns, which has at most
``3 ** len(RULES)`` rows whatever the number of documents. The posterior probability
of the good class, not the conjunction of all rules, decides which documents stay. A rule
that abstains carries no evidence. Junk of each kind breaks two rules or more, which is
what lets the model tell a class of junk from a rule that errs.

Defined results: a null text counts as a text without words; empty and wordless texts
have all counts 0 and fail the base rule; repeated rows and repeated ids are each
judged alone; an empty table gives an empty result; extra columns pass through
``quality_scores`` unless their names are those of its own columns, which it replaces.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegraph.llm.common import WORD, materialize

MIN_WORDS = 50
KEEP_AT = 0.5
EM_ROUNDS = 12
#: Added to each count of votes, so that no rate is 0 or 1.
SMOOTHING = 1.0


@dataclass(frozen=True)
class Rule:
    """Votes bad (0) where ``bad`` holds, else good (1) where ``good`` holds, else abstains (-1).

    The conditions are SQL over the columns of ``text_statistics``, in a form that Spark and
    other SQL engines read alike; ratios are compared by whole-number products.
    """

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 50", "n_words >= 100"),
    Rule("word_length", "word_chars > 15 * n_words or word_chars < 2 * n_words", "word_chars between 3 * n_words and 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("repeats", "10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words <= n_words"),
    Rule("lines", "n_lines > 1 and 10 * n_dup_lines > 3 * n_lines", "n_lines > 1 and 10 * n_dup_lines <= n_lines"),
    Rule("capitals", "10 * n_capitals > 3 * n_words", "10 * n_capitals <= n_words"),
    Rule("shouting", "10 * n_marks > n_words", "50 * n_marks <= n_words"),
    Rule("fields", "20 * n_bars > n_words", "n_bars = 0"),
    Rule("punctuation", "10 * (n_symbols + n_marks) > word_chars", "50 * (n_symbols + n_marks) <= word_chars"),
    Rule("variety", "10 * n_distinct_words < 3 * n_words", "2 * n_distinct_words >= n_words"),
)

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_bars",
    "n_distinct_words",
)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns ``STATISTICS`` (long), each computed within its row.

    ``n_repeat_words`` counts the words that lie in a three-word window which the text
    has twice or more. Windows are compared by a 64-bit hash within their text only, and
    sorted only in texts that have a hash twice. ``n_capitals`` counts the words written
    in capitals, ``n_marks`` exclamation and question marks, ``n_bars`` vertical bars.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    spaced = body
    for blank in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    lines = F.filter(F.split(body, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(F.col("_words")[i], F.col("_words")[i + 1], F.col("_words")[i + 2])
    )
    let = lambda value, made: F.transform(F.array(value), made)[0]  # noqa: E731  evaluates value once

    def covered(h: Column) -> Column:
        def alike(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        def words(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda n, x: n + x)

        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return let(F.sort_array(placed), lambda s: let(alike(s), words))

    none = F.array().cast("array<bigint>")
    shouted = F.filter("_words", lambda w: (w == F.upper(w)) & (w != F.lower(w)))
    counted = (
        docs.withColumns({"_spaced": spaced, "_lines": lines})
        .withColumn("_words", F.filter(F.split("_spaced", " "), lambda w: w != ""))
        .withColumn("_hashes", F.when(F.size("_words") >= 3, hashes).otherwise(none))
        .withColumns(
            {
                "n_words": F.size("_words").cast("bigint"),
                "word_chars": F.length(F.replace("_spaced", F.lit(" "))).cast("bigint"),
                "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("bigint"),
                "n_lines": F.size("_lines").cast("bigint"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
                "n_repeat_words": F.when(
                    F.size(F.array_distinct("_hashes")) < F.size("_hashes"), covered(F.col("_hashes"))
                ).otherwise(0),
                "n_capitals": F.size(shouted).cast("bigint"),
                "n_marks": F.regexp_count(body, F.lit("[!?]")).cast("bigint"),
                "n_bars": (F.length("_spaced") - F.length(F.replace("_spaced", F.lit("|")))).cast("bigint"),
                "n_distinct_words": F.size(F.array_distinct("_words")).cast("bigint"),
            }
        )
    )
    # a generator keeps filters on the statistics from being rewritten into their computation
    kept = [c for c in docs.columns if c not in STATISTICS]
    return counted.select(*kept, F.inline(F.array(F.struct(*STATISTICS))))


def votes(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``vote_<rule>`` columns (1 good, 0 bad, -1 abstains)."""
    return stats.withColumns(
        {f"vote_{r.name}": F.expr(f"case when {r.bad} then 0 when {r.good} then 1 else -1 end") for r in rules}
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(voted: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = EM_ROUNDS) -> dict:
    """Prior and vote rates by expectation-maximisation over the written table of vote patterns.

    The start takes a document with a bad vote for bad. Each round sends one row of sums to
    the driver.
    """
    names = [f"vote_{r.name}" for r in rules]
    patterns = materialize(voted.groupBy(*names).agg(F.count("*").alias("n")))
    cast = [(v, k) for v in names for k in (0, 1)]

    def sums(weight: Column) -> list[float]:
        """Of the weights in all, and of those with each vote."""
        weighed = patterns.withColumn("_weight", weight)
        parts = [F.sum("_weight"), *(F.sum(F.when(F.col(v) == k, F.col("_weight"))) for v, k in cast)]
        return [float(x or 0) for x in weighed.agg(*parts).first()]

    every = sums(F.col("n").cast("double"))
    any_bad = F.least(*(F.when(F.col(v) == 0, 0).otherwise(1) for v in names)) == 0
    posterior, model = F.when(any_bad, 0.1).otherwise(0.9), {}
    for _ in range(rounds):
        good = sums(F.col("n") * posterior)
        bad = [a - b for a, b in zip(every, good, strict=True)]
        model = {"prior": math.log((good[0] + SMOOTHING) / (bad[0] + SMOOTHING))}
        for i in range(1, len(cast), 2):
            of_good, of_bad = good[i] + good[i + 1] + 2 * SMOOTHING, bad[i] + bad[i + 1] + 2 * SMOOTHING
            for j in (i, i + 1):
                model[cast[j - 1]] = math.log((good[j] + SMOOTHING) / of_good) - math.log((bad[j] + SMOOTHING) / of_bad)
        posterior = quality_probability(model, rules)
    return model


def quality_probability(model: dict, rules: tuple[Rule, ...] = RULES) -> Column:
    """Posterior of the good class for a row that has the votes."""
    logit = F.lit(model["prior"])
    for r in rules:
        v = f"vote_{r.name}"
        logit = logit + F.when(F.col(v) == 1, model[v, 1]).when(F.col(v) == 0, model[v, 0]).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def quality_scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with statistics, votes, ``quality`` (posterior), ``base_failed`` and ``kept``.

    Texts are cut into words once: the rows are written with their votes, of which the fit
    reads only the votes.
    """
    voted = materialize(votes(text_statistics(docs, text)))
    return judged(voted, fit(voted))


def judged(voted: DataFrame, model: dict) -> DataFrame:
    return voted.withColumns({"quality": quality_probability(model), "base_failed": base_failed()}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT)
    )
