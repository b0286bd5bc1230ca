"""The weak-supervision query as DuckDB SQL: figures, votes and every step of the estimate."""

from __future__ import annotations

from habitscope.llm import rules as R

VOTES = (1, 0, -1)


def _vote(rule: R.Rule) -> str:
    return (f"CASE WHEN {rule.figure} < {rule.good}::DOUBLE THEN 1 WHEN {rule.figure} > {rule.bad}::DOUBLE THEN -1 "
            f"ELSE 0 END AS {rule.name}")


def _name(rule: R.Rule, y: int, k: int) -> str:
    return f"{rule.name}_{y}_{k}"


def _posterior() -> str:
    terms = ["ln(good / (1 - good))"] + [
        f"CASE {r.name} " + " ".join(f"WHEN {v} THEN ln({_name(r, 1, k)} / {_name(r, 0, k)})" for k, v in enumerate(VOTES))
        + " END" for r in R.RULES]
    return "1 / (1 + exp(-(" + " + ".join(terms) + ")))"


def _first() -> str:
    shares = [f"{R.PRIOR[y][k]}::DOUBLE AS {_name(r, y, k)}" for r in R.RULES for y in (0, 1) for k in range(3)]
    return f"SELECT {R.PRIOR_GOOD}::DOUBLE AS good, " + ", ".join(shares)


def _step(before: str) -> str:
    weight, side = f"({R.PRIOR_WEIGHT}::DOUBLE * sum(c))", {1: "p", 0: "(1 - p)"}
    shares = [
        f"round((sum({side[y]} * CASE WHEN {r.name} = {v} THEN c ELSE 0 END) + {weight} * {R.PRIOR[y][k]}::DOUBLE) "
        f"/ (sum({side[y]} * c) + {weight}), 6) AS {_name(r, y, k)}"
        for r in R.RULES for y in (0, 1) for k, v in enumerate(VOTES)]
    good = f"round((sum(p * c) + {weight} * {R.PRIOR_GOOD}::DOUBLE) / (sum(c) + {weight}), 6) AS good"
    return f"SELECT {good}, {', '.join(shares)} FROM (SELECT patterns.*, {_posterior()} AS p FROM patterns, {before})"


def oracle(least: float = 0.5) -> str:
    def without(chars: str) -> str:
        return "length(t) - length(translate(t, '" + chars.replace("'", "''") + "', ''))"

    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    votes = ", ".join(r.name for r in R.RULES)
    steps = ", ".join(f"p{i} AS MATERIALIZED ({_step(f'p{i - 1}')})" for i in range(1, R.STEPS + 1))
    return rf"""
WITH a AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents
), b AS MATERIALIZED (
  SELECT doc_id, rid, t, list_filter(regexp_split_to_array(t, '{R.SPACE}'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: ltrim(x, {spaces}) <> '') AS lines FROM a
), g AS (
  SELECT rid, i, words[i] || chr(32) || words[i + 1] || chr(32) || words[i + 2] AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM b)
), h AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM g) WHERE n > 1
), k AS (
  SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM h) GROUP BY rid
), f AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(translate(t, {spaces}, ''))::BIGINT AS word_chars,
    ({without(R.SYMBOLS)})::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, {without(R.CAPITALS)} AS n_capitals,
    {without(R.MARKS)} AS n_marks, len(list_distinct(words)) AS n_distinct, coalesce(k.n, 0)::BIGINT AS n_repeat_words
  FROM b LEFT JOIN k USING (rid)
), v AS MATERIALIZED (SELECT *, {", ".join(_vote(r) for r in R.RULES)} FROM f
), patterns AS MATERIALIZED (SELECT {votes}, count(*)::DOUBLE AS c FROM v GROUP BY {votes}
), p0 AS ({_first()}), {steps}
, q AS (
  SELECT v.*, {_posterior()} AS quality,
    n_words < {R.LEAST_WORDS} OR 100 * n_repeat_words > {R.MOST_REPEATED} * n_words AS base_failed
  FROM v, p{R.STEPS}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND quality >= {least} AS kept, round(quality, 3) AS quality
FROM q
"""
