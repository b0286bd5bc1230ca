"""R*: regressors, scoring, metrics, leaderboard, explanation."""

from __future__ import annotations

from functools import lru_cache, partial, reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from habitscope.operators import boost, encode, evaluate, explain, forest, moments, regress
from habitscope.plans import fixed_values as V
from habitscope.plans import regression
from habitscope.registry.catalog import query
from habitscope.registry.dataset import RAW_TABLES, clean_users, half_up, table
from habitscope.registry.q_encode import REGRESSION_SQL, VECTORS_SQL
from habitscope.sources.scratch import use_checkpoints

# -- linear fits with a closed form ------------------------------------------------------


def line_vectors(spark, sf_dir, *features: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_extendedprice", *features)
    return encode.assemble(lines, features, "features")


def coefficients(spark, model: moments.LinearFitModel, names, **extra) -> DataFrame:
    """The fitted parameters as rows: a handful of numbers from the model."""
    rows = [(n, float(v)) for n, v in zip(names, model.coefficients)]
    rows.append(("intercept", float(model.intercept)))
    out = spark.createDataFrame(rows, "term string, value double")
    return out.withColumns({k: F.lit(v) for k, v in extra.items()})


MOMENTS = """WITH m AS (SELECT COUNT(*)::DOUBLE AS n, AVG(l_extendedprice) AS my,
  AVG(l_quantity) AS m1, AVG(l_linenumber) AS m2, VAR_POP(l_quantity) AS v1,
  VAR_POP(l_linenumber) AS v2, COVAR_POP(l_quantity, l_linenumber) AS c12,
  COVAR_POP(l_quantity, l_extendedprice) AS c1, COVAR_POP(l_linenumber, l_extendedprice) AS c2
  FROM lineitem)"""


@query("r1_least_squares", MOMENTS + """, w AS (
  SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS w1,
    (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS w2 FROM m)
SELECT 'l_quantity' AS term, """ + half_up("w1", 4) + """ AS value FROM w
UNION ALL SELECT 'l_linenumber', """ + half_up("w2", 4) + """ FROM w
UNION ALL SELECT 'intercept', """ + half_up("my - w1 * m1 - w2 * m2", 3) + " FROM w")
def r1(spark, sf_dir):
    names = ["l_quantity", "l_linenumber"]
    lines = line_vectors(spark, sf_dir, *names)
    out = coefficients(spark, regress.linear_fits(lines, "features", "l_extendedprice")["Linear Regression"].fit(lines), names)
    digits = F.when(F.col("term") == "intercept", F.round("value", 3)).otherwise(F.round("value", 4))
    return out.withColumn("value", digits)


RIDGE_ALPHAS = [1.0, 1000.0, 50000.0]


@query("r2_ridge", MOMENTS + " SELECT a AS alpha, " + half_up("n * c1 / (n * v1 + a)", 4) + """ AS slope
FROM m, (SELECT UNNEST([1.0::DOUBLE, 1000.0::DOUBLE, 50000.0::DOUBLE]) AS a)""")
def r2(spark, sf_dir):
    """All penalties from one scan."""
    m = moments.moments(table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice")
    slopes = [(a, float(moments.ridge(m, a)[0])) for a in RIDGE_ALPHAS]
    return spark.createDataFrame(slopes, "alpha double, slope double").withColumn(
        "slope", F.round("slope", 4))


LASSO_ALPHAS = [0.1, 100.0, 500.0]


@query("r3_lasso", MOMENTS + " SELECT a AS alpha, "
       + half_up("SIGN(c1) * GREATEST(ABS(c1) - a, 0) / v1", 4) + """ AS slope
FROM m, (SELECT UNNEST([0.1::DOUBLE, 100.0::DOUBLE, 500.0::DOUBLE]) AS a)""")
def r3(spark, sf_dir):
    """All penalties from one scan."""
    m = moments.moments(table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice")
    slopes = [(a, float(moments.lasso(m, a)[0])) for a in LASSO_ALPHAS]
    return spark.createDataFrame(slopes, "alpha double, slope double").withColumn(
        "slope", F.round("slope", 4))


# The covariances that all three fits of the line-up start from, on its 16 scaled features.
@query("r1_covariances", VECTORS_SQL + ", z AS (SELECT user_id, [" + ", ".join(
    f"x_{i} / sd_{i}" for i in range(16)) + f""", label::DOUBLE] AS v FROM raw_vectors, sd WHERE is_train),
long AS (SELECT user_id, generate_subscripts(v, 1) - 1 AS i, unnest(v) AS x FROM z)
SELECT a.i::INT AS i, b.i::INT AS j, COUNT(*) AS n, {half_up("COVAR_POP(a.x, b.x)", 6)} AS covariance
FROM long a JOIN long b USING (user_id) GROUP BY 1, 2, a.i, b.i""")
def r1_covariances(spark, sf_dir):
    rows = moments.covariances(shared_vectors(spark, sf_dir).train, regression.FEATURES, "label")
    return rows.select("i", "n", F.posexplode("with").alias("j", "c")).select(
        "i", "j", "n", F.round("c", 6).alias("covariance"))


# -- the line-up on the stress score --------------------------------------------------------

def files_mark(spark, sf_dir) -> int:
    """Changes when a file of the tables that users are made of is replaced. No column is read."""
    marks = [table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size",
                                               "_metadata.file_modification_time") for name in RAW_TABLES]
    return reduce(DataFrame.union, marks).distinct().agg(
        F.coalesce(F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time")), F.lit(0))).first()[0]


@lru_cache(maxsize=2)
def _vectors(spark, sf_dir, mark: int):
    return regression.vectors(clean_users(spark, sf_dir))


@lru_cache(maxsize=2)
def _line_up(spark, sf_dir, mark: int):
    train = _vectors(spark, sf_dir, mark).train
    return regress.seven_regressors(train, regression.FEATURES, "label", keys=[V.KEY])


@lru_cache(maxsize=14)
def _model(spark, sf_dir, mark: int, name: str):
    return _line_up(spark, sf_dir, mark)[name].fit(_vectors(spark, sf_dir, mark).train)


def shared_vectors(spark, sf_dir):
    return _vectors(spark, sf_dir, files_mark(spark, sf_dir))


def shared_line_up(spark, sf_dir):
    return _line_up(spark, sf_dir, files_mark(spark, sf_dir))


def fitted(spark, sf_dir, *names: str):
    """(vectors, models) for the named members of the line-up. The queries of a session
    share vectors and fits as long as the tables' files stay the same. Fits not yet made run
    at the same time."""
    mark = files_mark(spark, sf_dir)
    use_checkpoints(spark)
    _line_up(spark, sf_dir, mark)
    return _vectors(spark, sf_dir, mark), regress.at_once(
        spark, {n: partial(_model, spark, sf_dir, mark, n) for n in names})


def prediction_query(key: str, name: str):
    """Held-out predictions of one model."""
    @query(key)
    def run(spark, sf_dir):
        v, models = fitted(spark, sf_dir, name)
        return regress.predict_all(models, v.test, ["user_id", "label"])
    return run


prediction_query("r4_random_forest", "Random Forest")
prediction_query("r5_gradient_boosting", "Gradient Boosting")
prediction_query("r6_histogram_boosting", "Histogram Boosting")
prediction_query("r7_leafwise_boosting", "Leafwise Boosting")


# One tree on given bins, which SQL can grow too: the root's best split, then its children's.
TREE_EDGES = {
    "l_linenumber": [float(i) for i in range(1, 7)], "l_quantity": [float(i) for i in range(1, 50)],
    "l_discount": [i / 100 for i in range(10)], "l_tax": [i / 100 for i in range(8)],
}


def tree_sql(penalty: float, min_rows: int, leaves: int, weight: str = "1") -> str:
    """``weight``: how often a row counts."""
    def term(g: str, n: str) -> str:
        return f"({g}) * ({g}) / ({n} + {penalty})"

    def best(rows: str, name: str) -> str:
        return f"""{name}_sums AS (
  SELECT node, f, b, SUM(y * w) AS g, SUM(w)::DOUBLE AS n
  FROM (SELECT node, y, w, UNNEST([0, 1, 2, 3]) AS f, UNNEST([f0, f1, f2, f3]) AS b FROM {rows}) GROUP BY ALL),
{name}_cuts AS (
  SELECT node, f, b, SUM(g) OVER up AS gl, SUM(n) OVER up AS nl, SUM(g) OVER every AS g, SUM(n) OVER every AS n
  FROM {name}_sums WINDOW up AS (PARTITION BY node, f ORDER BY b), every AS (PARTITION BY node, f)),
{name} AS (
  SELECT node, f, b, {term("gl", "nl")} + {term("g - gl", "(n - nl)")} - {term("g", "n")} AS gain
  FROM {name}_cuts WHERE nl >= {min_rows} AND n - nl >= {min_rows}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1)"""

    def side(rows: str, split: str, node: str) -> str:
        return f"""SELECT {node} AS node, y, w, f0, f1, f2, f3 FROM (
    SELECT x.*, CASE s.f WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END <= s.b AS low
    FROM {rows} x JOIN {split} s ON s.node = x.node)"""

    names = "[" + ", ".join(f"'{n}'" for n in TREE_EDGES) + "]"
    return f"""WITH x AS (
  SELECT '' AS node, l_extendedprice AS y, {weight} AS w, l_linenumber::INT AS f0, l_quantity::INT AS f1,
    ROUND(l_discount * 100)::INT AS f2, ROUND(l_tax * 100)::INT AS f3 FROM lineitem),
{best("x", "first")},
children AS ({side("x", "first", "CASE WHEN low THEN 'l' ELSE 'r' END")}),
{best("children", "every_second")},
second AS (SELECT * FROM every_second QUALIFY ROW_NUMBER() OVER (ORDER BY gain DESC, node) < {leaves}),
grandchildren AS ({side("children", "second", "node || CASE WHEN low THEN 'l' ELSE 'r' END")}),
nodes AS (
  SELECT node, SUM(w)::BIGINT AS rows, SUM(y * w) / (SUM(w) + {penalty}) AS value
  FROM (SELECT * FROM x UNION ALL SELECT * FROM children UNION ALL SELECT * FROM grandchildren) GROUP BY node),
splits AS (SELECT * FROM first UNION ALL SELECT * FROM second)
SELECT n.node, {names}[s.f + 1] AS feature,
  CASE WHEN s.f < 2 THEN s.b::DOUBLE ELSE s.b / 100.0::DOUBLE END AS edge, n.rows, {half_up("n.value", 2)} AS value
FROM nodes n LEFT JOIN splits s ON s.node = n.node"""


def tree_rows(spark, model: boost.BoostedModel, names: list[str], which: int = 0, times: int = 1) -> DataFrame:
    """The nodes of one tree: path from the root, split, rows, and the score with this tree
    alone, its steps taken ``times``."""
    tree, rows, paths = model.trees[which], [], [(0, "")]
    while paths:
        node, path = paths.pop()
        feature = int(tree.feature[node])
        split = (None, None) if feature < 0 else (names[feature], float(model.edges[feature][tree.bin[node]]))
        rows.append((path, *split, int(tree.rows[node]), model.base + times * float(tree.value[node])))
        if feature >= 0:
            paths += [(int(tree.left[node]), path + "l"), (int(tree.right[node]), path + "r")]
    out = spark.createDataFrame(rows, "node string, feature string, edge double, rows long, value double")
    return out.withColumn("value", F.round("value", 2))


def first_tree(key: str, settings: boost.Settings, leaves: int):
    @query(key, tree_sql(settings.penalty, settings.min_rows, leaves))
    def run(spark, sf_dir):
        model = boost.HistogramBoosting(
            "features", "l_extendedprice", settings, [np.array(e) for e in TREE_EDGES.values()], 0.0,
        ).fit(line_vectors(spark, sf_dir, *TREE_EDGES))
        return tree_rows(spark, model, list(TREE_EDGES))
    return run


first_tree("r6_first_tree", boost.Settings(rounds=1, depth=2, rate=1.0), leaves=4)
first_tree("r7_first_tree", boost.Settings(rounds=1, depth=2, rate=1.0, penalty=0.0, min_rows=20, leaves=3), leaves=2)


# The last of ten bagged trees, whose weights are the second draw of the second MD5.
BAGGED_TREES = 10
BAGGED_DRAW = ("CAST('0x' || SUBSTR(MD5('42:1:' || l_orderkey::VARCHAR || ':' || l_linenumber::VARCHAR), 5, 4) AS INT)")
BAGGED_WEIGHT = "(" + " + ".join(f"({BAGGED_DRAW} >= {cut})::INT" for cut in forest.CUTS) + ")"


@query("r4_bagged_tree", tree_sql(0.0, 1, 4, BAGGED_WEIGHT))
def r4_bagged(spark, sf_dir):
    """The nodes of one tree of a forest over all lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", *TREE_EDGES)
    model = forest.BaggedForest(
        "features", "l_extendedprice", ("l_orderkey", "l_linenumber"), BAGGED_TREES, depth=2,
        edges=[np.array(e) for e in TREE_EDGES.values()],
    ).fit(encode.assemble(lines, list(TREE_EDGES), "features"))
    return tree_rows(spark, model, list(TREE_EDGES), BAGGED_TREES - 1, BAGGED_TREES)


@query("r5_first_round", "SELECT value AS prediction, rows FROM (" + tree_sql(0.0, 1, 4) + ") WHERE feature IS NULL")
def r5_first(spark, sf_dir):
    """Where the first round of boosting puts all lines."""
    lines = line_vectors(spark, sf_dir, *TREE_EDGES)
    model = regress.boosted_trees("features", "l_extendedprice", rounds=1, depth=2, bins=64).fit(lines)
    return model.transform(lines).groupBy(F.round("prediction", 2).alias("prediction")).agg(
        F.count(F.lit(1)).alias("rows"))


@query("r8_held_out_scores")
def r8(spark, sf_dir):
    v, models = fitted(
        spark, sf_dir, "Linear Regression", "Ridge Regression", "Lasso Regression")
    return regress.predict_all(models, v.test, ["user_id", "label"])


WEIGHTS = {"daily_active_minutes_instagram": 0.03, "sessions_per_day": 1.25, "age": -0.05}
INTERCEPT = 2.5
SCORE_SQL = f"{INTERCEPT}::DOUBLE" + "".join(
    f" + {name} * ({w})::DOUBLE" for name, w in WEIGHTS.items())
SCORED_SQL = REGRESSION_SQL + f", scored AS (SELECT *, {SCORE_SQL} AS prediction FROM features)"


def scored(spark, sf_dir) -> DataFrame:
    train, test = regression.prepared(*regression.split(clean_users(spark, sf_dir)))
    both = train.unionByName(test).withColumnRenamed(V.REGRESSION_LABEL, "label")
    return regress.linear_score(both, WEIGHTS, INTERCEPT)


@query("r8_score_given_weights", SCORED_SQL + f"""
SELECT user_id, label, {half_up("prediction", 6)} AS prediction FROM scored""")
def r8_given(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "user_id", "label", F.round("prediction", 6).alias("prediction"))


# -- metrics on given predictions -------------------------------------------------------------

RMSE = "SQRT(AVG((label - prediction) * (label - prediction)))"
MAE = "AVG(ABS(label - prediction))"
MAPE = "AVG(ABS((label - prediction) / NULLIF(label, 0))) * 100"
R2 = "1 - SUM((label - prediction) * (label - prediction)) / NULLIF(COUNT(*) * VAR_POP(label), 0)"


def metric_query(key: str, name: str, text: str, metric):
    """One metric of the given linear score; labels of zero occur."""
    @query(key, SCORED_SQL + f" SELECT {half_up(text, 6)} AS {name} FROM scored")
    def run(spark, sf_dir):
        return scored(spark, sf_dir).agg(F.round(metric("label", "prediction"), 6).alias(name))
    return run


metric_query("r9_rmse", "rmse", RMSE, evaluate.rmse)
metric_query("r10_mae", "mae", MAE, evaluate.mae)
metric_query("r11_mape", "mape_pct", MAPE, evaluate.mape)
metric_query("r12_r_squared", "r2", R2, evaluate.r_squared)

GIVEN = {"half": "l_discount / 2", "tax": "l_tax", "flat": "0.05"}
GIVEN_SQL = "WITH p AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, l_discount AS label, ({text})::DOUBLE AS prediction FROM lineitem"
    for name, text in GIVEN.items()) + ")"
METRICS_SQL = GIVEN_SQL + f""", b AS (SELECT model, {half_up(RMSE, 6)} AS rmse,
  {half_up(MAE, 6)} AS mae, {half_up(MAPE, 6)} AS mape_pct, {half_up(R2, 6)} AS r2
  FROM p GROUP BY model)"""


def given_metrics(spark, sf_dir) -> DataFrame:
    cells = F.array(*[
        F.struct(F.lit(n).alias("model"), F.expr(t).cast("double").alias("prediction"))
        for n, t in GIVEN.items()])
    long = table(spark, sf_dir, "lineitem").select(
        F.col("l_discount").alias("label"), F.explode(cells).alias("cell")
    ).select("label", "cell.*")
    metrics = evaluate.metrics_by_model(long)
    return metrics.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "mape_pct", "r2")})


@query("r13_metrics_by_model", METRICS_SQL + " SELECT * FROM b")
def r13(spark, sf_dir):
    return given_metrics(spark, sf_dir)


@query("r14_leaderboard", METRICS_SQL + " SELECT *, ROW_NUMBER() OVER (ORDER BY rmse, model) AS place FROM b")
def r14(spark, sf_dir):
    return evaluate.leaderboard(given_metrics(spark, sf_dir))


@query("r14_seven_models")
def r14_seven(spark, sf_dir):
    """The whole bake-off: seven models scored on the held-out users."""
    return regression.bake_off(*fitted(spark, sf_dir, *shared_line_up(spark, sf_dir)))


# The booster that splits at leaves is the one explained.
EXPLAINED = regression.EXPLAINED

# -- explanation ----------------------------------------------------------------------------------

CONTRIBUTIONS_SQL = REGRESSION_SQL + ", c AS (" + " UNION ALL ".join(
    f"SELECT user_id, '{name}' AS feature, {name} AS value,"
    f" ({w})::DOUBLE * ({name} - AVG({name}) OVER ()) AS contribution FROM features"
    for name, w in WEIGHTS.items()) + ")"


def contributions(spark, sf_dir) -> DataFrame:
    train, test = regression.prepared(*regression.split(clean_users(spark, sf_dir)))
    return explain.linear_contributions(train.unionByName(test), WEIGHTS, ["user_id"])


@query("r15_mean_abs_contribution", CONTRIBUTIONS_SQL + f"""
SELECT feature, {half_up("AVG(ABS(contribution))", 6)} AS importance FROM c GROUP BY 1""")
def r15(spark, sf_dir):
    importance = explain.mean_abs_contribution(contributions(spark, sf_dir))
    return importance.withColumn("importance", F.round("importance", 6))


@query("r15_tree_importances")
def r15_tree(spark, sf_dir):
    v, models = fitted(spark, sf_dir, EXPLAINED)
    return explain.tree_importances(v.train, models[EXPLAINED], v.names())


@query("r15_permutation_importance")
def r15_permutation(spark, sf_dir):
    v, models = fitted(spark, sf_dir, EXPLAINED)
    return explain.permutation_importance(
        v.test, models[EXPLAINED], v.names(), "label", ["user_id"])


@query("r16_contributions", CONTRIBUTIONS_SQL + f"""
SELECT user_id, feature, {half_up("value", 6)} AS value, {half_up("contribution", 6)} AS contribution
FROM c""")
def r16(spark, sf_dir):
    return contributions(spark, sf_dir).withColumns(
        {c: F.round(c, 6) for c in ("value", "contribution")})


@query("r16_tree_contributions")
def r16_tree(spark, sf_dir):
    """What each feature adds to each held-out prediction of the explained booster."""
    v, models = fitted(spark, sf_dir, EXPLAINED)
    return boost.tree_contributions(v.test, models[EXPLAINED], v.names(), ["user_id"])


@query("r16_tree_adds_up", VECTORS_SQL + """
SELECT user_id, TRUE AS adds_up FROM raw_vectors WHERE NOT is_train""")
def r16_adds_up(spark, sf_dir):
    """Contributions and the mean add up to the prediction, user by user."""
    v, models = fitted(spark, sf_dir, EXPLAINED)
    model = models[EXPLAINED]
    total = boost.tree_contributions(v.test, model, v.names(), ["user_id"]).groupBy("user_id").agg(
        F.sum("contribution").alias("total"))
    return model.transform(v.test).join(total, "user_id").select(
        "user_id", (F.abs(F.col("prediction") - F.col("total")) < 1e-9).alias("adds_up"))


@query("r15_tree_mean_abs_contribution")
def r15_tree_contribution(spark, sf_dir):
    """Mean absolute contribution of each feature over the held-out users."""
    v, models = fitted(spark, sf_dir, EXPLAINED)
    parts = boost.tree_contributions(v.test, models[EXPLAINED], v.names(), ["user_id"])
    return explain.mean_abs_contribution(parts.where("feature <> '(mean)'"))
