"""Operators on small frames: semantics, skew, layout independence."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from habitscope.operators import clean, cluster, encode, explain, explore, regress, report
from habitscope.operators.anomaly import with_abs_z
from habitscope.operators.segment import Segmentation, segment
from habitscope.plans import reports
from habitscope.sources import scratch, tables

LAYOUTS = [1, 4, 8]

# -- cleaning ---------------------------------------------------------------------------


@pytest.mark.parametrize("parts", LAYOUTS)
def test_dedupe_prefers_complete_then_latest_rows(spark, rows, parts):
    df = spark.createDataFrame(
        [(1, None, 9), (1, 30, 2), (1, 31, 5), (2, None, 1), (3, 40, 1), (3, 40, 1)],
        "id int, age int, rec int").repartition(parts)
    out = clean.keep_one_per_key(
        df, ["id"], [clean.is_complete(["id", "age"]), F.col("rec")], copies="n")
    assert out.columns == ["id", "age", "rec", "n"]
    assert rows(out, "id") == [(1, 31, 5, 3), (2, None, 1, 1), (3, 40, 1, 2)]


@pytest.mark.parametrize("parts", LAYOUTS)
def test_dedupe_without_preference_is_still_fixed_by_the_data(spark, rows, parts):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (1, "b", 3)], "k int, x string, y int")
    assert rows(clean.keep_one_per_key(df.repartition(parts), ["k"])) == [(1, "b", 3)]


def test_dedupe_of_a_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") < 10000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = clean.keep_one_per_key(df, ["k"], [F.col("v")])
    assert out.filter("k = 0").first()["v"] == 9999 and out.count() == 20001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_dedupe_by_a_unique_mark_carries_only_what_is_read(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v", "id * 2 AS wide", "id * 3 AS wider")
    df.write.mode("overwrite").parquet(path := scratch.new_scratch_path(spark, "dedupe"))
    table = spark.read.parquet(path)
    out = clean.keep_one_per_key(table, ["k"], [F.col("v")], unique=True).select("k", "wide")
    scan = next(x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in x)
    assert "wider" not in scan.split("ReadSchema")[1]
    assert sorted(r["wide"] for r in out.collect()) == [2 * v for v in range(93, 100)]


def test_ranges_and_not_equal_drop_nulls(spark, rows):
    df = spark.createDataFrame([(12, "x"), (13, "x"), (65, "y"), (66, "x"), (None, "x"), (20, None)],
                               "age int, g string")
    assert rows(clean.within_ranges(df, {"age": (13, 65)}), "age") == [(13, "x"), (20, None), (65, "y")]
    assert rows(clean.exclude_value(df, "g", "x")) == [(65, "y")]


def test_imputation_uses_the_fitted_table_and_leaves_empty_columns_null(spark, rows):
    train = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    test = spark.createDataFrame([(None, None), (7.0, 5.0)], "a double, b double")
    means = clean.column_means(train, ["a", "b"])
    assert rows(clean.fill_from(test, means), "a") == [(2.0, None), (7.0, 5.0)]
    assert rows(clean.impute_means(test, ["a"]), "a", "b") == [(7.0, None), (7.0, 5.0)]


def test_statistics_are_computed_once_and_without_a_join(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    out = clean.impute_means(df, ["a", "b"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_reject_report_adds_up(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (3, 50), (4, None)], "a int, b int")
    rules = {"a_present": F.col("a").isNotNull(), "b_small": F.col("b") < 10}
    out = {r["outcome"]: r["rows"] for r in clean.reject_report(df, rules).collect()}
    assert out == {"kept": 1, "a_present": 1, "b_small": 2}
    audit = clean.shape_audit(df, rules).first()
    assert (audit["rows"], audit["columns"], audit["a_present"], audit["b_small"]) == (4, 2, 3, 2)


# -- encoding ----------------------------------------------------------------------------


def test_frequency_index_breaks_ties_by_name_and_keeps_or_skips_the_rest(spark, rows):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "a", "b", "c", None]], "t string")
    kept = encode.frequency_index(df, ["t"], "keep")
    assert rows(kept.distinct(), "t_idx") == [("a", 0.0), ("b", 1.0), ("c", 2.0), (None, 3.0)]
    skipped = encode.frequency_index(df, ["t"], "skip")
    assert skipped.count() == 5
    unseen = spark.createDataFrame([("z",), ("a",)], "t string")
    again = encode.frequency_index(unseen, ["t"], "keep", fitted=encode.label_ranks(df, ["t"]))
    assert rows(again, "t_idx") == [("a", 0.0), ("z", 3.0)]


def test_frequency_index_of_very_many_labels(spark):
    df = spark.range(220_000).select(
        F.when(F.col("id") < 20_000, F.lit("hot")).otherwise(F.concat(F.lit("é"), F.col("id"))).alias("t"))
    out = encode.frequency_index(df, ["t"], "keep")
    assert out.filter("t = 'hot'").select("t_idx").distinct().first()[0] == 0.0
    rest = out.filter("t <> 'hot'")
    assert rest.agg(F.count("*"), F.countDistinct("t_idx"), F.min("t_idx"), F.max("t_idx")).first() == (
        200_000, 200_000, 1.0, 200_000.0)
    order = Window.orderBy("t")
    assert rest.withColumn("n", F.row_number().over(order)).filter("n <> t_idx").count() == 0


def test_one_hot_drops_the_last_category(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "t string")
    skip = encode.one_hot_columns(df, "t", "skip", "h")
    assert skip.columns == ["t", "h_0", "h_1"] and skip.count() == 5
    keep = encode.one_hot_columns(df, "t", "keep", "h").distinct()
    assert {r["t"]: (r["h_0"], r["h_1"], r["h_2"]) for r in keep.collect()} == {
        "a": (1, 0, 0), "b": (0, 1, 0), "c": (0, 0, 1), None: (0, 0, 0)}


def test_vectors_skip_or_fail_on_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert encode.assemble(df, ["a", "b"], "v", "skip").count() == 1
    with pytest.raises(Exception):
        encode.assemble(df, ["a", "b"], "v").collect()


# -- segments -------------------------------------------------------------------------------


@pytest.mark.parametrize("rule,column,kind,cases", [
    (reports.SESSION_HABIT, "average_session_length_minutes", "int",
     {14: "1", 15: "2", 45: "2", 46: "3", None: "3"}),
    (reports.RESPONSE_TIER, "notification_response_rate", "double",
     {0.29: "3", 0.3: "2", 0.7: "2", 0.71: "1", None: "3"}),
    (reports.GENERATION, "age", "int",
     {12: "4", 13: "4", 14: "1", 29: "1", 30: "2", 45: "2", 46: "3", 61: "3", 62: "4", None: "4"}),
    (reports.AGE_DECADE, "age", "int",
     {19: "1", 20: "2", 30: "2", 31: "3", 40: "3", 41: "4", 50: "4", 51: "5", None: "5"}),
    (reports.EXERCISE_LEVEL, "exercise_hours_per_week", "double",
     {0.0: "1", 2.9: "2", 3.0: "3", 5.9: "3", 6.0: "4", 10.0: "5", None: "5"}),
    (reports.USAGE_LEVEL, "daily_active_minutes_instagram", "int",
     {59: "1", 60: "2", 179: "2", 180: "3", 299: "3", 300: "4", None: "4"}),
])
def test_class_edges(spark, rule, column, kind, cases):
    df = spark.createDataFrame([(k,) for k in cases], f"{column} {kind}")
    got = {r[0]: r[1][0] for r in segment(df, rule).collect()}
    assert got == cases


def test_null_rows_can_have_their_own_class(spark):
    rule = Segmentation("c", [("young", "age < 30")], "old", null_label="unknown", null_when="age IS NULL")
    df = spark.createDataFrame([(20,), (40,), (None,)], "age int")
    assert [r["c"] for r in segment(df, rule).collect()] == ["young", "old", "unknown"]


def test_a_null_z_score_falls_through_the_anomaly_rules(spark):
    df = spark.createDataFrame(
        [(3.0, 3.0, 0.0, 0.0), (None, 3.0, 3.5, 0.0), (3.0, None, None, 2.5), (1.5, 1.5, 1.5, None),
         (None, None, None, None)], "z_mins double, z_eng double, z_flw double, z_clicks double")
    labels = [r[-1].split(" ")[:2] for r in segment(df, reports.ANOMALY_CLASS).collect()]
    assert labels == [["Nghi", "Bot"], ["Nghi", "mua"], ["Nghi", "gian"], ["Bat", "thuong"], ["Nguoi", "dung"]]


def test_constant_column_has_no_z_score(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    out = with_abs_z(df, {"a": "a", "b": "b"}).collect()
    assert [(r["z_a"], r["z_b"]) for r in out] == [(1.0, None), (1.0, None)]


# -- reports ----------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", LAYOUTS)
def test_rank_everywhere_equals_brute_force_with_a_hot_value(spark, parts):
    data = [7.0] * 400 + [float(i % 97) for i in range(700)] + [None] * 100
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, v double")
    out = report.rank_everywhere(df.repartition(parts), "v", "r", buckets=16)
    got = {r["id"]: r["r"] for r in out.collect()}
    key = [-math.inf if v is None else v for v in data]
    assert got == {i: 1 + sum(k > key[i] for k in key) for i in range(len(data))}


def test_top_ranked_equals_ranking_everything(spark):
    data = [(f"k{i:03}", round((i * 37 % 50) / 7, 4)) for i in range(200)]
    df = spark.createDataFrame(data, "k string, exact double").withColumn("shown", F.round("exact", 1))
    got = report.top_ranked(df, 10, ["shown"], "exact", "r", ["k"]).collect()
    ranked = sorted(data, key=lambda d: (-d[1], d[0]))[:10]
    assert {r["k"] for r in got} == {k for k, _ in ranked}
    assert all(r["r"] == 1 + sum(v > r["exact"] for _, v in data) for r in got)


def test_share_of_all(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    assert rows(report.share_of_all(df, "n", "pct"), "k") == [("a", 1, 25.0), ("b", 3, 75.0)]


# -- exploration -----------------------------------------------------------------------------


@pytest.mark.parametrize("parts", LAYOUTS)
def test_splits_are_disjoint_exhaustive_and_layout_free(spark, parts):
    df = spark.range(3000)
    train, test = explore.split_by_key(df.repartition(parts), ["id"])
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert not a & b and len(a | b) == 3000 and 0.65 < len(a) / 3000 < 0.75
    same = {r[0] for r in explore.split_by_key(df, ["id"])[0].collect()}
    assert a == same
    three = explore.split_by_key(df, ["id"], (1, 1, 2))
    assert sum(p.count() for p in three) == 3000


def test_histogram_and_correlations(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (2.5, None), (2.6, 6.2)], "a double, b double")
    bins = {r["bin_start"]: r["rows"] for r in explore.histogram(df, "a", 1.0).collect()}
    assert bins == {0.0: 1, 1.0: 1, 2.0: 2}
    r = {(x["col_a"], x["col_b"]): x["r"] for x in explore.correlations(df, ["a", "b"]).collect()}
    assert len(r) == 4 and r["a", "b"] == r["b", "a"] and math.isclose(r["a", "a"], 1.0)
    xs, ys = [0, 1, 2.6], [1, 3, 6.2]
    mx, my = sum(xs) / 3, sum(ys) / 3
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    expected = cov / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
    assert math.isclose(r["a", "b"], expected)


# -- clustering -------------------------------------------------------------------------------


def blobs(spark):
    points = [(i, (i % 3) * 100.0 + i % 7, (i % 3) * -50.0 + i % 5) for i in range(300)]
    return spark.createDataFrame(points, "id int, x double, y double")


def test_kmeans_finds_separate_groups_and_sizes_add_up(spark):
    df = blobs(spark)
    out = cluster.fit_clusters(df, ["x", "y"], ["x", "y"], k=3).transform(df)
    sizes = {r["Cluster"]: r["count"] for r in cluster.cluster_sizes(out).collect()}
    assert sorted(sizes.values()) == [100, 100, 100]
    costs = [r["cost"] for r in cluster.elbow(df, ["x", "y"], ["x", "y"], range(2, 5)).orderBy("k").collect()]
    assert all(c >= 0 for c in costs) and costs[1] < costs[0] / 5


def test_nearest_centre_takes_the_lowest_index_on_a_tie(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (9.0,)], "x double")
    out = cluster.assign_nearest(df, ["x"], [(0.0,), (10.0,)])
    assert [r["Cluster"] for r in out.orderBy("x").collect()] == [0, 0, 1]


def test_components_are_uncorrelated_with_falling_variance(spark):
    df = blobs(spark).withColumn("z", F.col("x") * 0.5 - F.col("y"))
    out = cluster.project_2d(df, ["x", "y", "z"], ["id"]).persist()
    v1, v2, r = out.agg(F.var_samp("PC1"), F.var_samp("PC2"), F.corr("PC1", "PC2")).first()
    shares = out.select("PC1_variance", "PC2_variance").first()
    assert v1 >= v2 and abs(r) < 1e-6 and math.isclose(shares[0], v1 / 3, rel_tol=1e-9)
    assert out.count() == 300 and shares[0] + shares[1] <= 1 + 1e-9


# -- regression ------------------------------------------------------------------------------------


def line(spark):
    rows = [(i, float(i % 17), float(i * 7 % 11), 3.0 * (i % 17) - 2.0 * (i * 7 % 11) + 5.0 + (i % 3) * 0.1)
            for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, label double")
    return encode.assemble(df, ["a", "b"], "features").persist()


def test_line_up_scores_every_row_with_every_model(spark):
    df = line(spark)
    models = regress.fit_all(df, regress.seven_regressors(df, "features", "label", trees=3, rounds=2))
    assert len(models) == 7
    out = regress.predict_all(models, df, ["id", "label"])
    assert out.count() == 7 * 400
    from habitscope.operators.evaluate import leaderboard, metrics_by_model
    board = leaderboard(metrics_by_model(out)).collect()
    assert [r["place"] for r in board] == list(range(1, 8))
    assert [r["rmse"] for r in board] == sorted(r["rmse"] for r in board)
    assert board[0]["r2"] > 0.99


def test_linear_contributions_add_up_to_the_prediction(spark):
    df = line(spark)
    weights = {"a": 3.0, "b": -2.0}
    scored = regress.linear_score(df, weights, 5.0)
    mean = scored.agg(F.avg("prediction")).first()[0]
    total = explain.linear_contributions(df, weights, ["id"]).groupBy("id").agg(F.sum("contribution").alias("c"))
    for r in scored.join(total, "id").collect():
        assert math.isclose(r["c"], r["prediction"] - mean, abs_tol=1e-9)


@pytest.mark.parametrize("buckets", [1, 8])
def test_permutation_importance_finds_the_feature_that_matters(spark, buckets):
    df = line(spark).withColumn("label", F.col("a") * 3)
    model = regress.random_forest("features", "label", trees=5, depth=6).fit(df)
    out = {r["feature"]: r["importance"] for r in explain.permutation_importance(
        df, model, ["a", "b"], "label", ["id"], buckets=buckets).collect()}
    assert out["a"] > 5 and abs(out["b"]) < 0.5
    tree = {r["feature"]: r["importance"] for r in explain.tree_importances(df, model, ["a", "b"]).collect()}
    assert tree["a"] > 0.95


# -- sources -----------------------------------------------------------------------------------


def test_csv_roundtrip_and_header_check(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "x,y", None), (2, 'q"', 2.5)], "a int, b string, c double")
    path = str(tmp_path / "t")
    tables.write_csv(df, path)
    tables.write_csv(df, path)  # replaces
    assert rows(tables.read_csv(spark, path, df.schema), "a") == rows(df, "a")
    assert rows(tables.read_csv(spark, path), "a") == rows(df, "a")
    assert tables.read_csv_text(spark, path).dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    swapped = df.select("b", "a", "c").schema
    with pytest.raises(Exception):
        tables.read_csv(spark, path, swapped).collect()


def test_scratch_is_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark) == named
    a, b = scratch.new_scratch_path(spark, "t"), scratch.new_scratch_path(spark, "t")
    assert a.startswith(named) and a != b
    df = spark.range(5)
    settled = scratch.settled(df, "five")
    assert settled.count() == 5 and settled.inputFiles()[0].find(named.split("://")[-1]) >= 0


def test_cache_is_released(spark):
    df = spark.range(10)
    with tables.kept_in_memory(df) as kept:
        kept.count()
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_centres_do_not_depend_on_the_layout(spark):
    rows = [(i, float(i % 17), float(i * i % 23), float(i % 3)) for i in range(400)]
    rows += [(500 + i, 5.0, 5.0, 1.0) for i in range(200)]  # copies hold a third of the rows
    cols = ["x", "y", "z"]
    found, costs = [], []
    for parts in (1, 4, 8):
        df = spark.createDataFrame(rows, "id int, x double, y double, z double").repartition(parts)
        found.append([c.tolist() for c in cluster.fit_clusters(df, cols, ["id"], k=4).stages[-1].clusterCenters()])
        costs.append([tuple(r) for r in cluster.elbow(df, cols, ["id"], range(2, 5), max_iter=4).orderBy("k").collect()])
    assert np.allclose(found[0], found[1], atol=1e-9) and np.allclose(found[0], found[2], atol=1e-9)
    assert np.allclose(costs[0], costs[1]) and np.allclose(costs[0], costs[2])
    assert costs[0][0][1] > costs[0][1][1] > costs[0][2][1]


def test_joint_steps_are_the_steps_of_each_set(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, (300, 2)).astype(float)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")
    starts = {2: x[:2].tolist(), 3: [*x[5:7].tolist(), [1e6, 1e6]]}  # one centre never gets a row
    centres, costs = cluster.lloyd(df, ["a", "b"], starts, 3)
    for k, own in starts.items():
        own = np.array(own)
        for _ in range(3):
            near = ((x[:, None] - own) ** 2).sum(axis=2).argmin(axis=1)
            own = np.array([x[near == i].mean(axis=0) if (near == i).any() else own[i] for i in range(k)])
        assert np.allclose(centres[k], own, atol=1e-5)
        assert abs(costs[k] - ((x[:, None] - own) ** 2).sum(axis=2).min(axis=1).sum()) < 1e-2


def test_clusters_of_edge_tables(spark):
    schema = "x double, y double"
    empty = spark.createDataFrame([], schema)
    assert cluster.lloyd(empty, ["x", "y"], {1: [[0.0, 0.0]]}, 2) == ({1: [[0.0, 0.0]]}, {1: 0.0})
    assert cluster.candidates(empty, ["x", "y"], ["x"], 2) == ([], [])
    same = spark.createDataFrame([(1.0, 2.0)] * 5, schema)
    assert cluster.candidates(same, ["x", "y"], ["x"], 2) == ([[1.0, 2.0]], [5])
