"""What must hold, over all rows, for results that SQL cannot compute itself: Spark's own
samples and splits, K-means and tree ensembles."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from habitscope.operators import cluster, explain, explore, regress
from habitscope.plans import clustering, regression
from habitscope.plans import fixed_values as V
from habitscope.registry.catalog import query
from habitscope.registry.dataset import USERS_SQL, clean_users, table
from habitscope.registry.q_encode import VECTORS_SQL


@query("m1_sample_rows_inside", "SELECT o_orderkey, TRUE AS at_most_once FROM orders")
def m1(spark, sf_dir):
    """No sampled row is new or repeated."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    times = explore.sample_rows(orders, 0.05).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return orders.join(times, "o_orderkey", "full").select(
        "o_orderkey", (F.coalesce("n", F.lit(0)) <= 1).alias("at_most_once"))


@query("m2_split_rows_whole", "SELECT o_orderkey, 1::BIGINT AS parts FROM orders")
def m2(spark, sf_dir):
    """Every row is in exactly one part."""
    train, test = explore.split_rows(table(spark, sf_dir, "orders").select("o_orderkey"))
    return train.unionByName(test).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("parts"))


@query("m6_kmeans_nearest", USERS_SQL + " SELECT user_id, TRUE AS nearest FROM users")
def m6(spark, sf_dir):
    """Every user is in the cluster of the nearest fitted centre."""
    features = clustering.prepared(clean_users(spark, sf_dir))
    model = clustering.fit(features)
    parts = vector_to_array("scaled_features")

    def distance(centre):
        gaps = [F.element_at("parts", i + 1) - F.lit(float(v)) for i, v in enumerate(centre)]
        return reduce(add, [g * g for g in gaps])

    to_each = F.array(*[distance(c) for c in model.stages[-1].clusterCenters()])
    own = F.element_at("distances", F.col("Cluster") + 1)
    return model.transform(features).withColumn("parts", parts).withColumn("distances", to_each).select(
        "user_id", (own <= F.array_min("distances") + 1e-9).alias("nearest"))


@query("m8_sizes_cover_users", USERS_SQL + " SELECT COUNT(*) AS users FROM users")
def m8(spark, sf_dir):
    features = clustering.prepared(clean_users(spark, sf_dir))
    sizes = cluster.cluster_sizes(clustering.clustered(features, clustering.fit(features)))
    return sizes.agg(F.sum("count").alias("users"))


@query("m10_radar_spans", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high" for f in V.CLUSTER_FEATURES))
def m10(spark, sf_dir):
    """Each feature of the profile runs from 0 to 1 over the clusters."""
    features = clustering.prepared(clean_users(spark, sf_dir))
    radar = clustering.radar_profile(clustering.clustered(features, clustering.fit(features)))
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in V.CLUSTER_FEATURES])
    return radar.select(F.explode(cells).alias("cell")).groupBy("cell.feature").agg(
        F.round(F.min("cell.v"), 2).alias("low"), F.round(F.max("cell.v"), 2).alias("high"))


@query("r4_forest_within_labels", VECTORS_SQL + """
SELECT user_id, 1::BIGINT AS predictions, TRUE AS inside FROM raw_vectors WHERE NOT is_train""")
def r4(spark, sf_dir):
    """One prediction for each held-out user, inside the range of the training labels."""
    v = regression.vectors(clean_users(spark, sf_dir))
    model = regress.random_forest(regression.FEATURES, "label", keys=[V.KEY]).fit(v.train)
    low, high = v.train.agg(F.min("label"), F.max("label")).first()
    return regress.predict_all({"forest": model}, v.test, ["user_id"]).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.bool_and(F.col("prediction").between(low - 1e-9, high + 1e-9)).alias("inside"))


@query("r15_importances_sum", "SELECT 16::BIGINT AS features, 1.0::DOUBLE AS total")
def r15(spark, sf_dir):
    """One importance for each feature; they add up to one."""
    v = regression.vectors(clean_users(spark, sf_dir))
    model = regress.random_forest(regression.FEATURES, "label", keys=[V.KEY]).fit(v.train)
    return explain.tree_importances(v.train, model, v.names()).agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"))
