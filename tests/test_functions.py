"""Scalar expressions on hand-made rows: zero divisors, NULLs, ties, edges."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from habitscope.functions import columns as C
from habitscope.functions import measures as M
from habitscope.functions import windows as W
from habitscope.operators.evaluate import mape, metrics_by_model, r_squared


def values(df, column):
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_guarded_ratio_is_zero_for_zero_negative_or_null_denominator(spark):
    df = spark.createDataFrame(
        [(0, 0), (4, 1), (None, 1), (4, None), (-2, 1)], "views int, clicks int")
    assert values(df, C.guarded_ratio("clicks", "views")) == [0.0, 0.25, 0.0, None, 0.0]


def test_guarded_ratio_can_fall_back_to_the_numerator(spark):
    df = spark.createDataFrame([(0, 7), (2, 7), (None, 7)], "d int, n int")
    assert values(df, C.guarded_ratio("n", "d", F.col("n").cast("double"))) == [7.0, 3.5, 7.0]


def test_safe_ratio_never_fails(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 1.0)], "a double, b double")
    assert values(df, C.safe_ratio("a", "b")) == [None, 0.25, None]


def test_total_is_null_if_any_part_is(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "a int, b int, c int")
    assert values(df, C.total_of("a", "b", "c")) == [6, None]


def test_lenient_casts(spark):
    df = spark.createDataFrame([("3.0",), ("-3.9",), ("n/a",), (None,), ("12",)], "t string")
    t = df.schema["t"].dataType
    assert values(df, C.lenient_cast("t", "int", t)) == [3, -3, None, None, 12]
    assert values(df, C.lenient_cast("t", "double", t)) == [3.0, -3.9, None, None, 12.0]
    numbers = spark.createDataFrame([(3.99,), (-3.99,)], "d double")
    assert values(numbers, C.lenient_cast("d", "int")) == [3, -3]


def test_dates_that_do_not_exist_become_null(spark):
    df = spark.createDataFrame([("1/5/2024",), ("12/31/2023",), ("13/40/2024",), (None,)], "d string")
    assert values(df, C.parsed_date("d")) == [date(2024, 1, 5), date(2023, 12, 31), None, None]


def test_both_apostrophe_faults_are_repaired_everywhere(spark):
    df = spark.createDataFrame([("Bachelor’s’",), ("Masterâ€™s",), ("plain's",), (None,)], "t string")
    fixed = C.repaired_apostrophes(C.straight_apostrophes("t"))
    assert values(df, fixed) == ["Bachelor's'", "Master's", "plain's", None]


def test_codes_leave_unmapped_null(spark):
    df = spark.createDataFrame([("No",), ("Yes",), ("Maybe",), (None,)], "t string")
    assert values(df, C.code_of("t", {"No": 0.0, "Yes": 1.0})) == [0.0, 1.0, None, None]
    assert values(df, C.code_of("t", {})) == [None] * 4


def test_first_match_gives_nulls_to_the_default_unless_named(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    rules = [("small", F.col("x") < 3), ("any", F.col("x") < 100)]
    assert values(df, C.first_match(rules, "rest")) == ["small", "any", "rest"]
    named = C.first_match(rules, "rest", "missing", F.col("x").isNull())
    assert values(df, named) == ["small", "any", "missing"]


def test_z_score_of_a_constant_column_is_null(spark):
    df = spark.createDataFrame([(5.0,)], "x double")
    assert values(df, C.abs_z("x", F.lit(5.0), F.lit(0.0))) == [None]
    assert values(df, C.abs_z("x", F.lit(9.0), F.lit(2.0))) == [2.0]


def test_smoothing_weights_and_gaps(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "a double, b double")
    assert values(df, C.add_one_ratio("a", "b")) == [0.5]
    assert values(df, C.weighted_sum({"a": 2, "b": 0.5})) == [3.5]
    assert values(df, C.weekly_total("a", "b")) == [22.0]
    assert values(df, C.gap_from("a", 4, 2)) == [6.0]
    assert values(df, C.scaled_down("b", 6)) == [0.5]
    assert values(df, C.years_since(F.lit(2019), 2025)) == [6]


def test_key_fraction_is_fixed_by_key_and_seed(spark):
    df = spark.range(2000)
    one = values(df.repartition(1), C.key_fraction("id"))
    many = {r[0]: r[1] for r in df.repartition(7).select("id", C.key_fraction("id")).collect()}
    assert {i: f for i, f in zip([r[0] for r in df.repartition(1).collect()], one)} == many
    assert all(0 <= f < 1 for f in one)
    assert 0.45 < sum(one) / len(one) < 0.55
    assert many != {r[0]: r[1] for r in df.select("id", C.key_fraction("id", seed=7)).collect()}


def test_means_shares_and_ratios(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", None, 4)], "k string, x int, y int")
    out = {r["k"]: r for r in df.groupBy("k").agg(
        M.mean_of("x", 1).alias("m"), M.mean_of("x", times=100).alias("p"),
        M.ratio_of_means("x", "y", 2).alias("r"), M.row_count().alias("n")).collect()}
    assert (out["a"]["m"], out["a"]["p"], out["a"]["r"], out["a"]["n"]) == (1.5, 150.0, None, 2)
    assert (out["b"]["m"], out["b"]["r"]) == (None, None)
    share = M.share_pct(F.lit(1), F.lit(3))
    assert values(spark.range(1), share) == [33.33]


def test_rank_has_gaps_and_nulls_come_last(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", None)], "k string, v int")
    out = df.select("k", W.rank_desc("v"), W.number_desc("v", ["k"]), W.number_asc("v", ["k"]))
    assert rows(out, "k") == [("a", 1, 1, 2), ("b", 1, 2, 3), ("c", 3, 3, 1), ("d", 4, 4, 4)]


def test_percentage_error_skips_zero_labels(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 9.0), (20.0, 22.0)], "y double, p double")
    assert math.isclose(df.agg(mape("y", "p")).first()[0], 10.0)
    zeros = spark.createDataFrame([(0.0, 5.0)], "y double, p double")
    assert zeros.agg(mape("y", "p")).first()[0] is None


def test_metrics_match_their_definitions(spark):
    y, p = [1.0, 2.0, 4.0, 7.0], [1.5, 1.0, 4.5, 6.0]
    df = spark.createDataFrame([("m", a, b) for a, b in zip(y, p)], "model string, label double, prediction double")
    r = metrics_by_model(df).first()
    n, mean = len(y), sum(y) / len(y)
    sse = sum((a - b) ** 2 for a, b in zip(y, p))
    assert math.isclose(r["rmse"], math.sqrt(sse / n))
    assert math.isclose(r["mae"], sum(abs(a - b) for a, b in zip(y, p)) / n)
    assert math.isclose(r["mape_pct"], 100 * sum(abs((a - b) / a) for a, b in zip(y, p)) / n)
    assert math.isclose(r["r2"], 1 - sse / sum((a - mean) ** 2 for a in y))


def test_r_squared_of_a_constant_label_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert df.agg(r_squared("y", "p")).first()[0] is None


@pytest.mark.parametrize("value,low,high,expected", [(5.0, 0.0, 10.0, 50.0), (3.0, 3.0, 3.0, 0.0)])
def test_range_scaling_survives_a_constant_column(spark, value, low, high, expected):
    df = spark.createDataFrame([(value,)], "x double")
    out = values(df, C.range_scaled("x", F.lit(low), F.lit(high), 1e-5, 100.0))[0]
    assert math.isclose(out, expected, abs_tol=1e-3)
