"""Linear fits and components from covariances, held against dense algebra."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from habitscope.operators import cluster, encode, moments, regress

COLS = ["a", "b", "c", "flat"]


def data(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(1e6, 2, n), rng.normal(0, 0.01, n), rng.integers(0, 2, n), np.full(n, 7.0)], 1)
    x[:, 1] += (x[:, 0] - 1e6) * 0.002
    return x, 3 * (x[:, 0] - 1e6) - 40 * x[:, 1] + x[:, 2] + rng.normal(0, 0.5, n)


@pytest.fixture
def frame(spark):
    def build(x, y, parts=3):
        rows = [(i, *map(float, r), None if t is None else float(t)) for i, (r, t) in enumerate(zip(x, y))]
        return spark.createDataFrame(rows, "id int, a double, b double, c double, flat double, label double").repartition(parts)
    return build


@pytest.mark.parametrize("parts", [1, 4, 8])
def test_moments_of_large_means_and_missing_rows(frame, parts):
    x, y = data()
    missing = frame(x[:5], [None] * 5).withColumn("b", F.when(F.col("id") > 2, F.col("b")))
    df = frame(x, y, parts).unionByName(missing)
    m = moments.moments(df, COLS, "label")
    z = np.column_stack([x, y])
    assert m.n == len(x)
    np.testing.assert_allclose(m.means, z.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose(m.covariance, np.cov(z.T, bias=True), rtol=1e-7, atol=1e-9)
    vector = VectorAssembler(inputCols=COLS, outputCol="v", handleInvalid="keep").transform(df)
    np.testing.assert_allclose(moments.moments(vector, "v", "label").covariance, m.covariance, rtol=1e-7, atol=1e-9)


def test_fits_equal_dense_algebra(frame):
    x, y = data()
    m = moments.moments(frame(x, y), COLS, "label")
    xc, yc = x - x.mean(axis=0), y - y.mean()
    np.testing.assert_allclose(moments.least_squares(m), np.linalg.lstsq(xc, yc, rcond=1e-9)[0], rtol=1e-5, atol=1e-9)
    for alpha in (0.5, 100.0):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
        np.testing.assert_allclose(moments.ridge(m, alpha), want, rtol=1e-6, atol=1e-9)
    for alpha in (0.0, 0.01, 0.2, 1e6):
        w = moments.lasso(m, alpha)
        pull = xc.T @ (yc - xc @ w) / len(y)          # the optimum's own conditions
        np.testing.assert_allclose(pull[w != 0], alpha * np.sign(w[w != 0]), atol=1e-6)
        assert (np.abs(pull[w == 0]) <= alpha + 1e-6).all()
    assert not moments.lasso(m, 1e6).any()


def test_three_fits_read_the_table_once(frame, monkeypatch):
    x, y = data()
    train = encode.assemble(frame(x, y), COLS, "features")
    reads = []
    own = moments.covariances
    monkeypatch.setattr(moments, "covariances", lambda *a: reads.append(1) or own(*a))
    models = regress.fit_all(train, regress.linear_fits(train, "features", "label"))
    assert len(reads) == 1
    out = regress.predict_all(models, train, ["id", "label"])
    errors = {r["model"]: r["e"] for r in out.groupBy("model").agg(
        F.avg(F.pow(F.col("label") - F.col("prediction"), 2)).alias("e")).collect()}
    assert out.count() == 3 * len(x) and errors["Linear Regression"] == min(errors.values()) < 0.3


def test_tables_without_rows_and_constant_columns(frame):
    x, y = data(4)
    df = frame(x, y)
    with pytest.raises(ValueError):
        moments.moments(df.where("id < 0"), COLS, "label")
    one = moments.moments(df.where("id = 1"), COLS, "label")
    assert not moments.least_squares(one).any() and not moments.lasso(one, 0.1).any()
    parts = moments.components(moments.moments(df, COLS), 3)
    assert np.allclose(parts.directions[:, 3], 0) and np.isclose(parts.shares.sum(), 1)


def test_components_keep_their_sign_in_every_layout(frame):
    x, y = data()
    z = (x[:, :3] - x[:, :3].mean(axis=0)) / x[:, :3].std(axis=0, ddof=1)
    values, vectors = np.linalg.eigh(np.corrcoef(x[:, :3].T))
    for parts in (1, 4, 8):
        df = frame(x, y, parts).unionByName(frame(x[:1], y[:1]).withColumn("b", F.lit(float("nan"))).withColumn("id", F.lit(-1)))
        out = cluster.project_2d(df, ["a", "b", "c"], ["id"]).orderBy("id").toPandas()
        assert len(out) == len(x)
        for k in (1, 2):
            direction = vectors[:, -k] * np.sign(vectors[np.abs(vectors[:, -k]).argmax(), -k])
            np.testing.assert_allclose(out[f"PC{k}"], z @ direction, atol=1e-6)
            assert np.isclose(out[f"PC{k}_variance"][0], values[-k] / 3)


def test_index_by_maps_has_no_join_and_equals_the_join(spark, monkeypatch):
    rows = [(i, "abcd"[i % 4] if i % 7 else None, str(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, t string, u string")
    for how in ("keep", "skip"):
        maps = encode.frequency_index(df, ["t", "u"], how)
        assert "Join" not in maps._jdf.queryExecution().optimizedPlan().toString()
        with monkeypatch.context() as m:
            m.setattr(encode, "MAP_LABELS", 4)
            joined = encode.frequency_index(df, ["t", "u"], how)
        assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, maps.collect())) == sorted(map(str, joined.collect()))
    unseen = spark.createDataFrame([(1, "z", None)], "id int, t string, u string")
    fitted = encode.label_ranks(df, ["t", "u"])
    assert encode.frequency_index(unseen, ["t", "u"], "keep", fitted=fitted).first()[3:] == (4.0, 5.0)
    assert encode.frequency_index(unseen, ["t", "u"], "skip", fitted=fitted).count() == 0
    nothing = df.where("id < 0")
    assert encode.frequency_index(nothing, ["t"], "keep").count() == 0
    assert encode.frequency_index(unseen, ["t"], "keep", fitted=encode.label_ranks(nothing, ["t"])).first()["t_idx"] == 0.0
