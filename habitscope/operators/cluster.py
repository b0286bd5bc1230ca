"""K-means: scaled vectors, choice of k, assignment, sizes, profiles, 2-d projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from habitscope.functions.columns import key_fraction, range_scaled
from habitscope.operators.encode import standard_scaler
from habitscope.operators.moments import components, moments, scores
from habitscope.sources.scratch import settled


def scaling_stages(features: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="skip"),
        standard_scaler("raw_features", "scaled_features", center=True),
    ]


#: Distances and coordinates are added up in whole numbers of this part of one, so sums are
#: exact and centres do not depend on how rows are dealt out.
ONE = 1 << 20


def nearest(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """(distance, index) of the nearest centre by squared distance; the lowest index on a tie.

    Arrow batches: dozens of centres of a dozen columns are too much for generated code."""
    own = np.array(centres, float).reshape(len(centres), len(columns))

    @F.pandas_udf("distance double, index int")
    def near(*parts: pd.Series) -> pd.DataFrame:
        x = np.stack([p.to_numpy(float) for p in parts], 1)
        best, index = np.full(len(x), np.inf), np.zeros(len(x), np.int32)
        for i, centre in enumerate(own):
            distance = ((x - centre) ** 2).sum(axis=1)
            closer = distance < best
            best[closer], index[closer] = distance[closer], i
        return pd.DataFrame({"distance": best, "index": index})

    return near(*columns)


def _fixed(value: Column | str) -> Column:
    return F.round((F.col(value) if isinstance(value, str) else value) * ONE).cast("long")


def lloyd(
    points: DataFrame, columns: Sequence[str], groups: Mapping[int, Sequence[Sequence[float]]],
    rounds: int,
) -> tuple[dict[int, list[list[float]]], dict[int, float]]:
    """Lloyd steps for several sets of centres at once, and the cost of each set at the end.

    A step is one scan for all sets together: every row is assigned once in each, and sums by
    (set, centre) are combined on the map side. A centre without rows stays where it is.
    """
    centres = {k: [list(map(float, c)) for c in own] for k, own in groups.items()}
    costs: dict[int, float] = {}
    for step in range(rounds + 1):
        near = points.select(*columns, *[nearest(columns, own).alias(f"near_{k}") for k, own in centres.items()])
        cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"near_{k}").alias("near")) for k in centres])
        sums = near.select(*columns, F.explode(cells).alias("cell")).groupBy(
            F.col("cell.k").alias("k"), F.col("cell.near.index").alias("i")
        ).agg(
            F.count(F.lit(1)).alias("n"), F.sum(_fixed(F.col("cell.near.distance"))).alias("cost"),
            *[F.sum(_fixed(c)).alias(f"s{j}") for j, c in enumerate(columns)],
        ).collect()
        costs = {k: sum(r["cost"] for r in sums if r["k"] == k) / ONE for k in centres}
        if step == rounds:
            break
        moved = {k: [list(c) for c in own] for k, own in centres.items()}
        for r in sums:
            moved[r["k"]][r["i"]] = [r[f"s{j}"] / ONE / r["n"] for j in range(len(columns))]
        if moved == centres:
            break
        centres = moved
    return centres, costs


def candidates(
    points: DataFrame, columns: Sequence[str], keys: Sequence[str], k: int, rounds: int = 5, seed: int = 42,
) -> tuple[list[list[float]], list[int]]:
    """Starting points by oversampling (k-means||) and how many rows are nearest to each.

    The first is the row of least key hash. In each round a row joins with a chance of 2k
    times its share of the cost, drawn from its key, so the same rows join in any layout;
    about 2k rows a round reach the driver. ``keys`` have to tell rows apart.
    """
    order = [key_fraction(*keys, seed=seed), *[F.col(c) for c in (*keys, *columns)]]
    chosen = [[float(r[c]) for c in columns] for r in points.orderBy(*order).select(*columns).limit(1).collect()]
    for turn in range(1, rounds + 1) if chosen else ():
        gap = nearest(columns, chosen).getField("distance")
        total = points.agg(F.sum(_fixed(gap))).first()[0] / ONE
        if not total:
            break
        drawn = points.where(key_fraction(*keys, seed=seed + turn) < 2 * k * gap / F.lit(total))
        more = drawn.select(*columns).distinct().collect()
        chosen += sorted([float(v) for v in r] for r in more)
    if not chosen:
        return [], []
    counts = dict(points.groupBy(nearest(columns, chosen).getField("index").alias("i")).count().collect())
    return chosen, [counts.get(i, 0) for i in range(len(chosen))]


def starting_centres(chosen: Sequence[Sequence[float]], weights: Sequence[int], k: int, seed: int = 42) -> list[list[float]]:
    """``k`` of the weighted candidates, each next one drawn by weight times squared distance
    (k-means++). Fewer candidates give all of them."""
    x, w, rng = np.array(chosen, float), np.array(weights, float), np.random.default_rng(seed)
    if len(x) <= k:
        return x.tolist()
    taken = [int(np.argmax(w))]
    while len(taken) < k:
        gap = ((x[:, None] - x[taken]) ** 2).sum(axis=2).min(axis=1) * w
        if not gap.sum():
            break
        taken.append(int(rng.choice(len(x), p=gap / gap.sum())))
    return x[taken].tolist()


def _scaled_columns(df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> tuple[PipelineModel, DataFrame, list[str]]:
    model = Pipeline(stages=scaling_stages(features)).fit(df)
    columns = [f"p{i}" for i in range(len(features))]
    parts = vector_to_array("scaled_features")
    # On a grid: the scaler's last bits change with the layout and would turn ties over.
    points = model.transform(df).select(
        *keys, *[(_fixed(parts[i]) / F.lit(float(ONE))).alias(c) for i, c in enumerate(columns)])
    return model, settled(points, "cluster-points"), columns


def elbow(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], ks: Iterable[int] = range(2, 7),
    max_iter: int = 10, seed: int = 42,
) -> DataFrame:
    """(k, cost) per candidate k, all of them in the same scans.

    All rows are used; to choose k on a sample, pass one (``sample_by_key``).
    """
    _, points, columns = _scaled_columns(df, features, keys)
    ks = list(ks)
    chosen, weights = candidates(points, columns, keys, max(ks), seed=seed)
    groups = {k: starting_centres(chosen, weights, k, seed) for k in ks} if chosen else {}
    costs = lloyd(points, columns, groups, max_iter)[1] if groups else {}
    return df.sparkSession.createDataFrame(sorted(costs.items()), "k bigint, cost double")


class NearestCentre:
    """The last stage of a cluster model: the index of the nearest centre of a vector."""

    def __init__(self, centres: Sequence[Sequence[float]], vector: str, output: str):
        self.centres, self.vector, self.output = [list(c) for c in centres], vector, output

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) for c in self.centres]

    def transform(self, df: DataFrame) -> DataFrame:
        columns = [f"__p{i}" for i in range(len(self.centres[0]) if self.centres else 0)]
        parts = vector_to_array(self.vector)
        spread = df.select("*", *[parts[i].alias(c) for i, c in enumerate(columns)])
        index = nearest(columns, self.centres).getField("index") if self.centres else F.lit(0)
        return spread.withColumn(self.output, index).drop(*columns)


def fit_clusters(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int = 4, max_iter: int = 20, seed: int = 42,
    output: str = "Cluster",
) -> PipelineModel:
    """Assembler + centred scaler + K-means as one reusable model. Seeds come from the rows'
    keys and sums are exact, so centres do not change with the partitions."""
    scaler, points, columns = _scaled_columns(df, features, keys)
    chosen, weights = candidates(points, columns, keys, k, seed=seed)
    centres = lloyd(points, columns, {k: starting_centres(chosen, weights, k, seed)}, max_iter)[0][k] if chosen else []
    return PipelineModel(stages=[*scaler.stages, NearestCentre(centres, "scaled_features", output)])


def assign_nearest(
    df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]],
    output: str = "Cluster",
) -> DataFrame:
    """Index of the nearest given centre, as one expression (lowest index on a tie)."""
    def distance(centre: Sequence[float]) -> Column:
        gaps = [F.col(f) - F.lit(float(v)) for f, v in zip(features, centre, strict=True)]
        return reduce(add, [g * g for g in gaps])

    ranked = [
        F.struct(distance(c).alias("distance"), F.lit(i).alias("index"))
        for i, c in enumerate(centres)
    ]
    nearest_one = ranked[0] if len(ranked) == 1 else F.least(*ranked)
    return df.withColumn(output, nearest_one.getField("index"))


def cluster_sizes(df: DataFrame, cluster: str = "Cluster") -> DataFrame:
    return df.groupBy(cluster).count().orderBy(cluster)


def group_means(df: DataFrame, group: str, features: Sequence[str]) -> DataFrame:
    """Mean of each feature per group, over all rows."""
    return df.groupBy(group).agg(*[F.avg(f).alias(f) for f in features])


def spread_across_groups(
    profile: DataFrame, features: Sequence[str], epsilon: float = 1e-5
) -> DataFrame:
    """Min-max scale each feature across the (few) group rows of a profile."""
    everything = Window.partitionBy()
    return profile.withColumns({
        f: range_scaled(f, F.min(f).over(everything), F.max(f).over(everything), epsilon)
        for f in features
    })


def project_2d(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """First two principal components of the standardised features, with the share of
    variance each explains; see ``moments.components``. Rows with a NULL or NaN feature
    are left out. Two rows at least are needed."""
    whole = df.dropna(subset=list(features))
    found = components(moments(whole, features), 2)
    return scores(whole, features, found).select(
        *keep, "PC1", "PC2",
        F.lit(float(found.shares[0])).alias("PC1_variance"), F.lit(float(found.shares[1])).alias("PC2_variance"),
    )
