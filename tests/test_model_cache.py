"""Shared fits follow the tables' files, not only their path."""

from threading import Barrier

import pytest
from pyspark.ml.linalg import Vectors

from habitscope.operators import moments, regress
from habitscope.registry import q_models
from habitscope.registry.dataset import RAW_TABLES, SCHEMAS


def test_a_replaced_table_has_another_mark(spark, tmp_path):
    for name in RAW_TABLES:
        spark.createDataFrame([], SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    nation = "n_nationkey int, n_name string, n_regionkey int"
    path = f"{tmp_path}/nation.parquet"
    marks = []
    for rows in ([(1, "a", 0)], [(2, "b", 1), (3, "c", 1)]):
        spark.createDataFrame(rows, nation).write.mode("overwrite").parquet(path)
        marks.append(q_models.files_mark(spark, str(tmp_path)))
        assert q_models.files_mark(spark, str(tmp_path)) == marks[-1]
    assert marks[0] != marks[1]


def test_models_not_yet_made_are_fitted_at_the_same_time(spark, monkeypatch):
    met = Barrier(3, timeout=20)  # breaks unless all three fits have begun
    monkeypatch.setattr(q_models, "files_mark", lambda *at: 0)
    for name in ("_vectors", "_line_up"):
        monkeypatch.setattr(q_models, name, lambda *at: None)
    monkeypatch.setattr(q_models, "_model", lambda spark, at, mark, name: (met.wait(), name)[1])
    assert q_models.fitted(spark, "", "a", "b", "c")[1] == {"a": "a", "b": "b", "c": "c"}


def test_fit_all_keeps_the_order_and_shares_one_scan(spark, monkeypatch):
    scans = []
    whole = moments.moments
    monkeypatch.setattr(moments, "moments", lambda *of: (scans.append(1), whole(*of))[1])
    rows = [(Vectors.dense(float(i), float(i * i % 7)), float(3 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, ["features", "label"])
    models = regress.fit_all(df, regress.linear_fits(df, "features", "label"))
    assert list(models) == ["Linear Regression", "Ridge Regression", "Lasso Regression"] and len(scans) == 1
    assert abs(models["Linear Regression"].coefficients[0] - 3) < 1e-9


def test_a_fit_that_fails_is_told(spark):
    def broken():
        raise ValueError("no rows")

    with pytest.raises(ValueError, match="no rows"):
        regress.at_once(spark, {"a": lambda: 1, "b": broken})
    assert regress.at_once(spark, {}) == {}
