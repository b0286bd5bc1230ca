"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at one figure of a text and says good, bad or nothing. How often a rule
says each of the three about good and about bad documents is not given; it is estimated
with the share of good documents by expectation-maximisation, from the agreement of the
rules over all documents. The posterior probability of good decides, so one failed rule
is evidence and not a verdict. DataFrame functions only; the estimation works on the
counts of vote patterns, at most 3 ^ rules rows whatever the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habitscope.sources.scratch import settled

# What separates words, the symbols that are counted, the base rule.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
MARKS = "0123456789!\"#$%&()*+-/:;<=>?@[\\]^_`{|}~"


def figures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each whole ``text`` (null: no words).

    ``n_repeat_words``: windows of three words are compared by their 64-bit hash; texts in
    which no window occurs twice are told at once, in the others the windows are sorted.
    """
    def without(chars: str) -> Column:
        return F.length("t") - F.length(F.translate("t", chars, ""))

    counted = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
        .withColumn("words", F.array_remove(F.split("t", SPACE), ""))
        .withColumn("lines", F.filter(F.split("t", "\n"), lambda line: F.ltrim(line, F.lit(SPACES)) != ""))
        .select(
            "doc_id", "words", F.size("words").cast("long").alias("n_words"),
            F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
            without(SYMBOLS).cast("long").alias("n_symbols"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            without(CAPITALS).cast("long").alias("n_capitals"), without(MARKS).cast("long").alias("n_marks"),
            F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        )
        .withColumn("windows", F.when(F.col("n_words") >= 3, F.expr(
            "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"))
            .otherwise(F.expr("cast(array() AS array<bigint>)")))
        .drop("words")
        .withColumn("sorted", F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.expr("array_sort(transform(windows, (h, i) -> named_struct('h', h, 'i', i)))")))
    )
    again = F.expr("""
        array_sort(transform(filter(
          transform(sorted, (w, j) -> named_struct('i', w.i, 'twice',
            coalesce(get(sorted, j - 1).h = w.h, false) OR coalesce(get(sorted, j + 1).h = w.h, false))),
          w -> w.twice), w -> w.i))""")
    covered = F.expr("""
        aggregate(again, named_struct('last', -3, 'n', 0L),
          (a, p) -> named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n)""")
    return counted.drop("windows").withColumn("again", F.when(F.col("sorted").isNotNull(), again)).select(
        *[c for c in counted.columns if c not in ("sorted", "windows")],
        F.coalesce(F.when(F.col("again").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"))


@dataclass(frozen=True)
class Rule:
    """Good below ``good``, bad above ``bad`` of a figure, else nothing."""

    name: str
    figure: str
    good: float
    bad: float

    def vote(self) -> Column:
        value = F.expr(self.figure)
        return F.when(value < self.good, 1).when(value > self.bad, -1).otherwise(0).cast("int").alias(self.name)


RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.02, 0.1),
    Rule("marks", "n_marks / greatest(word_chars, 1)", 0.06, 0.2),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", 0.08, 0.25),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", 0.1, 0.35),
    Rule("lines", "n_dup_lines / greatest(n_lines, 1)", 0.05, 0.5),
    Rule("variety", "1 - n_distinct / greatest(least(n_words, 400), 1)", 0.7, 0.85),
    Rule("word_length", "abs(word_chars / greatest(n_words, 1) - 5.5)", 2.5, 5.0),
)
#: Prior of what a rule says, about good and about bad documents (good, nothing, bad), and its
#: weight as a share of the documents. A rule rarely says bad of a good document; a bad one
#: has one kind of fault, so most rules pass it.
PRIOR = {1: (0.85, 0.14, 0.01), 0: (0.65, 0.1, 0.25)}
PRIOR_WEIGHT, PRIOR_GOOD, STEPS = 0.05, 0.85, 12


def log_odds(params: dict, rules: tuple[Rule, ...] = RULES) -> Column:
    """Log odds of good, given the votes."""
    total = F.lit(math.log(params["good"] / (1 - params["good"])))
    for rule in rules:
        says = [math.log(g / b) for g, b in zip(params[rule.name][1], params[rule.name][0])]
        total = total + F.when(F.col(rule.name) == 1, says[0]).when(F.col(rule.name) == 0, says[1]).otherwise(says[2])
    return total


def posterior(params: dict, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.lit(1.0) / (1 + F.exp(-log_odds(params, rules)))


def estimate(votes: DataFrame, rules: tuple[Rule, ...] = RULES, steps: int = STEPS) -> dict:
    """Vote shares of each rule by class and the share of good documents, by
    expectation-maximisation over the vote patterns; values are rounded to 6 digits, so
    the order of summation does not show. Without documents: the prior."""
    params: dict = {"good": PRIOR_GOOD} | {r.name: PRIOR for r in rules}
    patterns = settled(votes.groupBy(*[r.name for r in rules]).count(), "votes")
    for _ in range(steps):
        p = F.col("p")
        sums = [F.sum("count").alias("n"), F.sum(p * F.col("count")).alias("good")]
        for r in rules:
            for v in (1, 0, -1):
                cast = F.when(F.col(r.name) == v, F.col("count")).otherwise(0)
                sums += [F.sum(p * cast).alias(f"{r.name}_1_{v}"), F.sum((1 - p) * cast).alias(f"{r.name}_0_{v}")]
        row = patterns.withColumn("p", posterior(params, rules)).agg(*sums).first()
        if not row["n"]:
            break
        weight = PRIOR_WEIGHT * row["n"]
        size = {1: row["good"], 0: row["n"] - row["good"]}
        good = (row["good"] + weight * PRIOR_GOOD) / (row["n"] + weight)
        params = {"good": round(good, 6)} | {
            r.name: {y: tuple(round((row[f"{r.name}_{y}_{v}"] + weight * PRIOR[y][k]) / (size[y] + weight), 6)
                              for k, v in enumerate((1, 0, -1))) for y in (0, 1)} for r in rules}
    return params


def judged(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Figures, votes, ``base_failed``, ``quality`` (posterior of good) and ``kept`` for each
    row of ``docs`` (``doc_id``, ``text``).

    ``base_failed``: under 50 words, or over half of them in repeated windows; such rows are
    not kept. Null, empty and blank texts have no words and fail. Repeated rows are judged
    alike; an empty table gives no rows.
    """
    seen = settled(figures(docs.select("doc_id", "text")).select("*", *[r.vote() for r in RULES]), "figures")
    params = estimate(seen)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return seen.withColumn("base_failed", failed).withColumn("__p", posterior(params)) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("__p") >= least)) \
        .withColumn("quality", F.round("__p", 3)).drop("__p")


def digest(docs: DataFrame) -> DataFrame:
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "quality")
