"""The jobs end to end, from the derived raw user table."""

import pytest
from pyspark.sql import functions as F

from habitscope.plans import clustering, regression, reports
from habitscope.plans import fixed_values as V
from habitscope.plans import users as plan
from habitscope.registry import dataset
from habitscope.sources import tables

SF = "/root/testdata/sf0.001"


def test_fixed_columns_cover_the_57_of_the_user_table():
    named = [V.KEY, *V.INT_COLUMNS, *V.DOUBLE_COLUMNS, V.DATE_COLUMN, *V.FLAG_CODES,
             *V.ORDINAL_CODES, *V.NOMINAL_COLUMNS]
    assert len(named) == len(set(named)) == 57
    assert set(dataset.FIELDS) == set(named) | {"record_id"}


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    raw = dataset.raw_users(spark, SF)
    path = str(tmp_path_factory.mktemp("clean") / "users")
    counts = plan.run_cleaning(raw, path, prefer=[F.col("record_id")])
    return counts, tables.read_parquet(spark, path).drop("record_id")


def test_cleaning_job_writes_80_columns_and_counts_every_stage(cleaned, spark):
    counts, users = cleaned
    assert len(users.columns) == 80
    raw = dataset.raw_users(spark, SF)
    assert counts["raw_rows"] == raw.count()
    assert counts["distinct_users"] == raw.select("user_id").distinct().count()
    assert counts["clean_rows"] == users.count() == users.select("user_id").distinct().count()
    assert counts["removed_rows"] == counts["raw_rows"] - counts["clean_rows"]
    assert counts["raw_rows"] > counts["after_nulls"] >= counts["clean_rows"] > 0


def test_cleaning_job_accepts_an_all_text_csv(cleaned, spark, tmp_path):
    raw = dataset.raw_users(spark, SF)
    tables.write_csv(raw, str(tmp_path / "raw"))
    text = tables.read_csv_text(spark, str(tmp_path / "raw"))
    counts = plan.run_cleaning(
        text, str(tmp_path / "clean"), fmt="csv", prefer=[F.col("record_id").cast("bigint")])
    assert {k: counts[k] for k in cleaned[0] if k != "columns"} == {
        k: v for k, v in cleaned[0].items() if k != "columns"}
    back = tables.read_csv_text(spark, str(tmp_path / "clean"))
    assert back.count() == counts["clean_rows"] and len(back.columns) == counts["columns"]


def test_every_report_runs_on_the_written_table(cleaned):
    _, users = cleaned
    n = users.count()
    for name, run in reports.ALL_REPORTS.items():
        small = {"ad_targeting": {"more_than": 0}, "exercise_and_usage": {"at_least": 1}}.get(name, {})
        out = run(users, **small)
        rows = out.collect()
        assert rows, name
        if name == "ad_targeting":
            assert len(rows) == V.TOP_TARGETS
            continue
        count = next(c for c in out.columns if c in ("total_users", "user_count", "so_nguoi_dung"))
        assert sum(r[count] for r in rows) == n, name


def test_reports_do_not_join_and_shuffle_only_groups(cleaned):
    _, users = cleaned
    plan_text = reports.loyalty_segments(users)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan_text and "partial_avg" in plan_text
    scan = next(line for line in plan_text.splitlines() if "FileScan" in line)
    assert "sessions_per_day" in scan and "blood_pressure_systolic" not in scan


def test_clustering_covers_every_user(cleaned):
    _, users = cleaned
    features = clustering.cluster_features(users)
    assert features.columns == [V.KEY, *V.CLUSTER_FEATURES]
    model = clustering.fit(features)
    out = clustering.clustered(features, model).persist()
    assert out.count() == users.count()
    radar = clustering.radar_profile(out).collect()
    assert len(radar) == out.select("Cluster").distinct().count()
    assert all(-1e-9 <= r[f] <= 1 for r in radar for f in V.CLUSTER_FEATURES)


def test_regression_vectors_and_bake_off(cleaned):
    _, users = cleaned
    v = regression.vectors(users)
    both = v.train.unionByName(v.test)
    complete = users.dropna(subset=[V.REGRESSION_LABEL, *V.REGRESSION_CATEGORIES])
    assert both.count() == both.select(V.KEY).distinct().count() == complete.count()
    assert len(v.names()) == v.train.first()["features"].size
    board = regression.bake_off(v, regression.fit_models(v, trees=5, rounds=2)).collect()
    assert [r["place"] for r in board] == list(range(1, 8))


def test_text_that_is_no_number_makes_a_record_incomplete(spark):
    row = {c: "1" for c in (*V.DOUBLE_COLUMNS, *V.INT_COLUMNS, *V.NOMINAL_COLUMNS, *V.FLAG_CODES, *V.ORDINAL_CODES)}
    row |= {V.KEY: "7", V.DATE_COLUMN: "1/2/2024", "gender": "Male"}
    raw = spark.createDataFrame([row | {"age": "n/a", "sessions_per_day": "9"}, row | {"age": "23.0"}])
    kept = plan.one_record_per_user(plan.typed(raw)).collect()
    assert [(r["age"], r["sessions_per_day"]) for r in kept] == [(23, 1)]
    counts = plan.stage_counts(raw).first()
    assert (counts["raw_rows"], counts["distinct_users"], counts["after_nulls"]) == (2, 1, 1)


def test_accepted_ranges_and_codes_are_these():
    assert V.ACCEPTED_RANGES == {
        "age": (13, 65), "sleep_hours_per_night": (3, 10), "exercise_hours_per_week": (0, 24),
        "weekly_work_hours": (0, 80), "body_mass_index": (15, 45), "average_session_length_minutes": (5, 52),
        "blood_pressure_systolic": (70, 200), "account_creation_year": (2010, 2025),
    }
    assert V.EXCLUDED_GENDER == "Prefer not to say" and V.REQUIRED == ["user_id", "age", "gender"]
    assert set(V.FLAG_CODES) == {"gender", "has_children", "smoking", "uses_premium_features",
                                 "two_factor_auth_enabled", "biometric_login_used"}
    assert set(V.ORDINAL_CODES) == {"income_level", "diet_quality", "alcohol_frequency", "privacy_setting_level",
                                    "education_level"}


def test_cleaning_job_of_an_empty_table(spark, tmp_path):
    raw = dataset.raw_users(spark, SF).where("user_id < 0")
    counts = plan.run_cleaning(raw, str(tmp_path / "none"), prefer=[F.col("record_id")])
    assert counts == {c: 0 for c in ("raw_rows", "distinct_users", "after_nulls", "clean_rows", "removed_rows")} | {
        "columns": counts["columns"]}
