"""M*: samples, splits, histogram, correlations, clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from habitscope.operators import cluster, explore
from habitscope.plans import clustering
from habitscope.plans import fixed_values as V
from habitscope.registry.catalog import query
from habitscope.registry.dataset import USERS_SQL, bucket_fraction, clean_users, half_up, table
from habitscope.registry.q_derive import CLUSTER_SQL
from habitscope.sources.tables import kept_in_memory

# -- samples and splits ------------------------------------------------------------------


@query("m1_sample_by_key", f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE {bucket_fraction("o_orderkey")} < 0.05""")
def m1(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return explore.sample_by_key(orders, ["o_orderkey"], 0.05)


@query("m1_sample_rows")
def m1_rows(spark, sf_dir):
    return explore.sample_rows(table(spark, sf_dir, "orders"), 0.05)


@query("m2_split_by_key", f"""
SELECT o_orderkey, CASE WHEN {bucket_fraction("o_orderkey")} < 0.7 THEN 'train' ELSE 'test' END
  AS part FROM orders""")
def m2(spark, sf_dir):
    train, test = explore.split_by_key(
        table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


@query("m2_split_rows")
def m2_rows(spark, sf_dir):
    train, test = explore.split_rows(table(spark, sf_dir, "orders").select("o_orderkey"))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


@query("m3_histogram", USERS_SQL + """
SELECT CAST(FLOOR(perceived_stress_score / 2.0::DOUBLE) AS BIGINT) AS bin, COUNT(*) AS rows,
  CAST(FLOOR(perceived_stress_score / 2.0::DOUBLE) AS BIGINT) * 2.0::DOUBLE AS bin_start
FROM users WHERE perceived_stress_score IS NOT NULL GROUP BY 1, 3""")
def m3(spark, sf_dir):
    return explore.histogram(clean_users(spark, sf_dir), V.REGRESSION_LABEL, width=2.0)


@query("m3_histogram_prices", """
SELECT CAST(FLOOR((l_extendedprice - 900) / 2500.0::DOUBLE) AS BIGINT) AS bin, COUNT(*) AS rows,
  CAST(FLOOR((l_extendedprice - 900) / 2500.0::DOUBLE) AS BIGINT) * 2500.0::DOUBLE + 900 AS bin_start
FROM lineitem GROUP BY 1, 3""")
def m3_prices(spark, sf_dir):
    return explore.histogram(
        table(spark, sf_dir, "lineitem"), "l_extendedprice", width=2500.0, start=900.0)


NUMBERS = [*V.REGRESSION_INPUTS, V.REGRESSION_LABEL]


@query("m4_correlations", USERS_SQL + ", pairs AS (SELECT " + ", ".join(
    f"CORR({a}, {b}) AS r_{i}_{j}" for i, a in enumerate(NUMBERS) for j, b in enumerate(NUMBERS)
) + " FROM users) " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {half_up(f'r_{i}_{j}', 6)} AS r FROM pairs"
    for i, a in enumerate(NUMBERS) for j, b in enumerate(NUMBERS)))
def m4(spark, sf_dir):
    return explore.correlations(clean_users(spark, sf_dir), NUMBERS, digits=6)


# -- clustering -------------------------------------------------------------------------------


@query("m5_elbow")
def m5(spark, sf_dir):
    with kept_in_memory(clustering.prepared(clean_users(spark, sf_dir))) as features:
        return cluster.elbow(features, V.CLUSTER_FEATURES, [V.KEY])


# From given starting points SQL can take the same steps. Points are whole numbers.
STARTS = {2: [(5.0, 7.0), (45.0, 28.0)], 3: [(10.0, 7.0), (25.0, 42.0), (40.0, 14.0)],
          4: [(5.0, 7.0), (15.0, 35.0), (30.0, 21.0), (48.0, 49.0)]}


def steps_sql(steps: int) -> str:
    """Centres c0 (given), c1, ... and for each the nearest one of every point, a0, a1, ..."""
    given = ", ".join(f"({k}, {i}, {a}::DOUBLE, {b}::DOUBLE)" for k, own in STARTS.items() for i, (a, b) in enumerate(own))
    text = f"""WITH p AS (SELECT l_quantity::DOUBLE AS a, l_linenumber * 7::DOUBLE AS b, COUNT(*) AS n
  FROM lineitem GROUP BY 1, 2), c0 AS (SELECT * FROM (VALUES {given}) AS v(k, i, a, b))"""
    for step in range(steps + 1):
        text += f""", a{step} AS (SELECT p.*, c.k, c.i, (p.a - c.a) ** 2 + (p.b - c.b) ** 2 AS d FROM p CROSS JOIN c{step} c
  QUALIFY ROW_NUMBER() OVER (PARTITION BY p.a, p.b, c.k ORDER BY d, c.i) = 1)"""
        if step < steps:
            text += f""", c{step + 1} AS (SELECT c.k, c.i, COALESCE(SUM(x.a * x.n) / SUM(x.n), ANY_VALUE(c.a)) AS a,
  COALESCE(SUM(x.b * x.n) / SUM(x.n), ANY_VALUE(c.b)) AS b
  FROM c{step} c LEFT JOIN a{step} x ON x.k = c.k AND x.i = c.i GROUP BY 1, 2)"""
    return text


def given_points(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("double").alias("a"), (F.col("l_linenumber") * 7).cast("double").alias("b"))


@query("m5_elbow_given_starts", steps_sql(2) + f"""
SELECT k::BIGINT AS k, {half_up("SUM(d * n)", 2)} AS cost FROM a2 GROUP BY 1""")
def m5_given(spark, sf_dir):
    """Cost of two to four centres after two joint steps."""
    costs = cluster.lloyd(given_points(spark, sf_dir), ["a", "b"], STARTS, 2)[1]
    return spark.createDataFrame(list(costs.items()), "k bigint, cost double").withColumn("cost", F.round("cost", 2))


@query("m6_one_step", steps_sql(1) + f"""
SELECT k::BIGINT AS k, i::BIGINT AS i, {half_up("a", 4)} AS a, {half_up("b", 4)} AS b FROM c1""")
def m6_step(spark, sf_dir):
    """The centres after one step."""
    centres = cluster.lloyd(given_points(spark, sf_dir), ["a", "b"], STARTS, 1)[0]
    rows = [(k, i, *c) for k, own in centres.items() for i, c in enumerate(own)]
    return spark.createDataFrame(rows, "k bigint, i bigint, a double, b double").withColumns(
        {c: F.round(c, 4) for c in "ab"})


def clustered(spark, sf_dir):
    with kept_in_memory(clustering.prepared(clean_users(spark, sf_dir))) as features:
        model = clustering.fit(features)
        return clustering.clustered(features, model)


@query("m6_kmeans")
def m6(spark, sf_dir):
    return clustered(spark, sf_dir).select("user_id", "Cluster")


@query("m8_cluster_sizes")
def m8(spark, sf_dir):
    return cluster.cluster_sizes(clustered(spark, sf_dir))


@query("m9_two_components")
def m9(spark, sf_dir):
    with kept_in_memory(clustering.prepared(clean_users(spark, sf_dir))) as features:
        return cluster.project_2d(features, V.CLUSTER_FEATURES, ["user_id"])


@query("m10_radar_profile")
def m10(spark, sf_dir):
    return clustering.radar_profile(clustered(spark, sf_dir))


# With two standardised measures the components are known: variances 1 + |r| and
# 1 - |r|, directions (1, +-1)/sqrt(2). Scores are compared by size.
@query("m9_two_components_of_two", f"""
WITH m AS (SELECT AVG(l_quantity) AS qm, STDDEV_SAMP(l_quantity) AS qs, AVG(l_extendedprice) AS pm,
  STDDEV_SAMP(l_extendedprice) AS ps, CORR(l_quantity, l_extendedprice) AS r FROM lineitem),
z AS (SELECT l_orderkey, l_linenumber, r, (l_quantity - qm) / qs AS a,
  SIGN(r) * (l_extendedprice - pm) / ps AS b FROM lineitem, m)
SELECT l_orderkey, l_linenumber, {half_up("ABS(a + b) / SQRT(2)", 5)} AS size_1,
  {half_up("ABS(a - b) / SQRT(2)", 5)} AS size_2, {half_up("(1 + ABS(r)) / 2", 6)} AS share_1,
  {half_up("(1 - ABS(r)) / 2", 6)} AS share_2 FROM z""")
def m9_two(spark, sf_dir):
    parts = cluster.project_2d(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"],
        ["l_orderkey", "l_linenumber"])
    return parts.select(
        "l_orderkey", "l_linenumber",
        F.round(F.abs("PC1"), 5).alias("size_1"), F.round(F.abs("PC2"), 5).alias("size_2"),
        F.round("PC1_variance", 6).alias("share_1"), F.round("PC2_variance", 6).alias("share_2"))


def components_sql(names, count: int, squarings: int = 30) -> str:
    """Correlations of the features, squared over and over: the columns of the limit lie along
    the first direction. With that taken out of the matrix, the same gives the next."""
    own = ", ".join(f"({f} - AVG({f}) OVER ()) / STDDEV_SAMP({f}) OVER ()" for f in names)
    text = CLUSTER_SQL + f""", z AS MATERIALIZED (SELECT user_id, [{own}] AS v FROM features),
  long AS MATERIALIZED (SELECT user_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM z),
  c1 AS MATERIALIZED (SELECT a.i, b.i AS j, CORR(a.x, b.x) AS v FROM long a JOIN long b USING (user_id) GROUP BY 1, 2)"""
    for k in range(1, count + 1):
        text += f", s{k}_0 AS MATERIALIZED (SELECT * FROM c{k})"
        for step in range(squarings):
            text += f""", s{k}_{step + 1} AS MATERIALIZED (SELECT i, j, v / SUM(v) FILTER (i = j) OVER () AS v FROM (
  SELECT a.i, b.j, SUM(a.v * b.v) AS v FROM s{k}_{step} a JOIN s{k}_{step} b ON a.j = b.i GROUP BY 1, 2))"""
        text += f""", d{k} AS MATERIALIZED (SELECT i, v / SQRT(SUM(v * v) OVER ()) AS v FROM s{k}_{squarings}
    WHERE j = (SELECT i FROM s{k}_{squarings} WHERE i = j ORDER BY v DESC LIMIT 1)),
  e{k} AS MATERIALIZED (SELECT SUM(a.v * c.v * b.v) AS value FROM c{k} c JOIN d{k} a ON a.i = c.i JOIN d{k} b ON b.i = c.j),
  c{k + 1} AS MATERIALIZED (SELECT c.i, c.j, c.v - value * a.v * b.v AS v
    FROM c{k} c JOIN d{k} a ON a.i = c.i JOIN d{k} b ON b.i = c.j, e{k}),
  p{k} AS MATERIALIZED (SELECT user_id, ABS(SUM(x * v)) AS size FROM long JOIN d{k} USING (i) GROUP BY 1)"""
    return text


@query("m9_two_components_sizes", components_sql(V.CLUSTER_FEATURES, 2) + f"""
SELECT user_id, {half_up("p1.size", 5)} AS size_1, {half_up("p2.size", 5)} AS size_2,
  {half_up(f"e1.value / {len(V.CLUSTER_FEATURES)}", 6)} AS share_1,
  {half_up(f"e2.value / {len(V.CLUSTER_FEATURES)}", 6)} AS share_2
FROM p1 JOIN p2 USING (user_id), e1, e2""")
def m9_sizes(spark, sf_dir):
    """Components of all the features, compared by size."""
    parts = m9(spark, sf_dir)
    return parts.select(
        "user_id", F.round(F.abs("PC1"), 5).alias("size_1"), F.round(F.abs("PC2"), 5).alias("size_2"),
        F.round("PC1_variance", 6).alias("share_1"), F.round("PC2_variance", 6).alias("share_2"))


AXES = ["daily_active_minutes_instagram", "reels_watched_per_day", "followers_count"]
CENTRES = [(90.0, 5.0, 500.0), (150.0, 15.0, 1500.0), (250.0, 20.0, 2500.0), (120.0, 10.0, 42000.0)]
NEAREST_SQL = CLUSTER_SQL + ", inputs2 AS (SELECT inputs.*, " + ", ".join(
    "(" + " + ".join(f"({a} - {v}) * ({a} - {v})" for a, v in zip(AXES, centre)) + f") AS d{i}"
    for i, centre in enumerate(CENTRES)
) + """ FROM inputs), assigned AS (SELECT *, CASE
  WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0 WHEN d1 <= d2 AND d1 <= d3 THEN 1
  WHEN d2 <= d3 THEN 2 ELSE 3 END AS Cluster FROM inputs2)"""


def assigned(spark, sf_dir):
    inputs = clustering.numeric_inputs(clean_users(spark, sf_dir))
    return cluster.assign_nearest(inputs, AXES, CENTRES)


@query("m7_nearest_centre", NEAREST_SQL + " SELECT user_id, Cluster FROM assigned")
def m7(spark, sf_dir):
    return assigned(spark, sf_dir).select("user_id", "Cluster")


@query("a10_group_size", NEAREST_SQL + " SELECT Cluster, COUNT(*) AS count FROM assigned GROUP BY 1")
def a10(spark, sf_dir):
    return cluster.cluster_sizes(assigned(spark, sf_dir))


@query("a11_group_means", NEAREST_SQL + " SELECT Cluster, " + ", ".join(
    f"{half_up(f'AVG({a})', 6)} AS {a}" for a in AXES) + " FROM assigned GROUP BY 1")
def a11(spark, sf_dir):
    means = cluster.group_means(assigned(spark, sf_dir), "Cluster", AXES)
    return means.withColumns({a: F.round(a, 6) for a in AXES})


@query("a12_spread_across_groups", NEAREST_SQL + ", p AS (SELECT Cluster, " + ", ".join(
    f"AVG({a}) AS {a}" for a in AXES) + " FROM assigned GROUP BY 1) SELECT Cluster, " + ", ".join(
    half_up(f"({a} - MIN({a}) OVER ()) / (MAX({a}) OVER () - MIN({a}) OVER () + 1e-5)", 6) + f" AS {a}"
    for a in AXES) + " FROM p")
def a12(spark, sf_dir):
    means = cluster.group_means(assigned(spark, sf_dir), "Cluster", AXES)
    return cluster.spread_across_groups(means, AXES).withColumns({a: F.round(a, 6) for a in AXES})
