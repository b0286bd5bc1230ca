"""Sampling, splitting, histograms and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from habitscope.functions.columns import key_fraction


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample decided by the key: the same rows at any partition layout."""
    return df.filter(key_fraction(*keys, seed=seed) < F.lit(fraction))


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own Bernoulli sample; its outcome depends on the partition layout."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def side_of_split(keys: Sequence[str], weights: Sequence[float], seed: int = 42) -> Column:
    """Index of the split a row belongs to, by its key."""
    total = float(sum(weights))
    fraction = key_fraction(*keys, seed=seed)
    reached, side = 0.0, None
    for i, w in enumerate(weights[:-1]):
        reached += w / total
        test = (fraction < F.lit(reached), F.lit(i))
        side = F.when(*test) if side is None else side.when(*test)
    last = F.lit(len(weights) - 1)
    return last if side is None else side.otherwise(last)


def split_by_key(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Disjoint, exhaustive splits that survive recomputation and re-partitioning."""
    side = side_of_split(keys, weights, seed)
    return [df.filter(side == F.lit(i)) for i in range(len(weights))]


def split_rows(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Spark's ``randomSplit``; depends on the partition layout."""
    return df.randomSplit(list(weights), seed=seed)


def histogram(df: DataFrame, col: str, width: float, start: float = 0.0) -> DataFrame:
    """Rows per equal-width bin over the whole column (NULLs left out)."""
    value = F.col(col)
    bin_no = F.floor((value - F.lit(float(start))) / F.lit(float(width))).cast("bigint")
    return (
        df.filter(value.isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("bin_start", F.col("bin") * F.lit(float(width)) + F.lit(float(start)))
    )


def correlations(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Pearson r for every ordered pair, long format (col_a, col_b, r).

    One pass over the rows where both are present. A row is spread over the first
    columns only and correlated there with every second one, then combined on the map
    side: as many rows as columns, and as many aggregates side by side.
    """
    size = len(cols)
    values = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))
    spread = values.select("v", F.posexplode("v").alias("i", "x"))
    matrix = spread.groupBy("i").agg(
        *[F.corr("x", F.element_at("v", j + 1)).alias(f"r_{j}") for j in range(size)]
    )
    names = F.array(*[F.lit(c) for c in cols])
    cells = F.array(*[
        F.struct(F.lit(j).alias("j"), F.lit(c).alias("name"), F.col(f"r_{j}").alias("r"))
        for j, c in enumerate(cols)
    ])
    half = matrix.select(
        "i", names[F.col("i")].alias("name"), F.explode(cells).alias("other")
    ).filter("other.j >= i")
    r = F.col("other.r") if digits is None else F.round("other.r", digits)

    def cell(a: str, b: str) -> Column:
        return F.struct(F.col(a).alias("col_a"), F.col(b).alias("col_b"), r.alias("r"))

    there, back = cell("name", "other.name"), cell("other.name", "name")
    both = F.when(F.col("other.j") == F.col("i"), F.array(there)).otherwise(F.array(there, back))
    return half.select(F.explode(both).alias("cell")).select("cell.*")
