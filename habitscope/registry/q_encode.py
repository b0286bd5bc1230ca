"""E*: category codes, frequency indices, one-hot, vectors, scalers."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from habitscope.operators import encode
from habitscope.operators.explore import split_by_key
from habitscope.plans import fixed_values as V
from habitscope.plans import regression
from habitscope.registry.catalog import query
from habitscope.registry.dataset import (
    RAW_SQL, USERS_SQL, bucket_fraction, clean_users, half_up, newest_first, raw_users, sql_codes,
    table,
)
from habitscope.plans import users as plan


def codes_sql(maps: dict) -> str:
    return RAW_SQL + " SELECT record_id, " + ", ".join(
        f"{c}, {sql_codes(c, m)} AS {c}_encoded" for c, m in maps.items()) + " FROM raw"


@query("e1_flag_codes", codes_sql(V.FLAG_CODES))
def e1(spark, sf_dir):
    raw = raw_users(spark, sf_dir).select("record_id", *V.FLAG_CODES)
    return encode.encode_codes(raw, V.FLAG_CODES)


@query("e2_ordinal_codes", codes_sql(V.ORDINAL_CODES))
def e2(spark, sf_dir):
    raw = raw_users(spark, sf_dir).select("record_id", *V.ORDINAL_CODES)
    return encode.encode_codes(raw, V.ORDINAL_CODES)


def rank_ctes(columns, source: str) -> str:
    return "".join(
        f", rank_{c} AS (SELECT {c} AS category, (ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) - 1)"
        f"::DOUBLE AS idx FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})" for c in columns
    )


@query("e3_frequency_index_keep", USERS_SQL + rank_ctes(V.NOMINAL_COLUMNS, "users")
       + " SELECT users.*, " + ", ".join(
    f"COALESCE((SELECT idx FROM rank_{c} WHERE category = {c}), (SELECT COUNT(*) FROM rank_{c})::DOUBLE)"
    f" AS {c}_idx" for c in V.NOMINAL_COLUMNS) + " FROM users")
def e3(spark, sf_dir):
    """The complete 80-column clean table."""
    return plan.clean_and_indexed_users(raw_users(spark, sf_dir), newest_first()).drop("record_id")


@query("e4_frequency_index_skip", USERS_SQL + ", r AS (SELECT *, " + bucket_fraction("user_id")
       + " < 0.7 AS is_train FROM users), train AS (SELECT * FROM r WHERE is_train)"
       + rank_ctes(V.REGRESSION_CATEGORIES, "train") + """
SELECT user_id, employment_status, urban_rural, a.idx AS employment_status_index,
  b.idx AS urban_rural_index
FROM r JOIN rank_employment_status a ON employment_status = a.category
JOIN rank_urban_rural b ON urban_rural = b.category WHERE NOT is_train""")
def e4(spark, sf_dir):
    """Indexed by the training part's frequencies; rows without a known label go."""
    users = clean_users(spark, sf_dir).select("user_id", *V.REGRESSION_CATEGORIES)
    train, test = split_by_key(users, ["user_id"])
    fitted = encode.label_ranks(train, V.REGRESSION_CATEGORIES)
    return encode.frequency_index(
        test, V.REGRESSION_CATEGORIES, invalid="skip", suffix="_index", fitted=fitted
    )


@query("e5_one_hot", """
WITH r AS (SELECT c_mktsegment AS label, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, c_mktsegment) - 1
  AS idx FROM customer GROUP BY 1)
SELECT c_custkey, c_mktsegment, """ + ", ".join(
    f"CASE WHEN idx = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS segment_{i}" for i in range(4)
) + " FROM customer JOIN r ON c_mktsegment = label")
def e5(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return encode.one_hot_columns(customers, "c_mktsegment", prefix="segment")


PARTS = ["daily_active_minutes_instagram", "dms_received_per_week", "notification_response_rate"]


@query("e6_vector_skip_nulls", USERS_SQL + " SELECT user_id, " + ", ".join(
    f"{c}::DOUBLE AS v_{i}" for i, c in enumerate(PARTS)) + " FROM users WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in PARTS))
def e6(spark, sf_dir):
    users = clean_users(spark, sf_dir).select("user_id", *PARTS)
    vectors = encode.assemble(users, PARTS, "v", invalid="skip")
    arrays = vectors.select("user_id", vector_to_array("v").alias("v"))
    return encode.unpacked(arrays, "v", ["v_0", "v_1", "v_2"])


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def scaled(spark, sf_dir, center: bool):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    vectors = encode.assemble(lines, MEASURES, "v")
    out = encode.standard_scaler("v", "s", center).fit(vectors).transform(vectors)
    arrays = out.select("l_orderkey", "l_linenumber", vector_to_array("s").alias("s"))
    unpacked = encode.unpacked(arrays, "s", [f"s_{i}" for i in range(4)])
    return unpacked.withColumns({f"s_{i}": F.round(f"s_{i}", 6) for i in range(4)})


def scaled_sql(center: bool) -> str:
    return ("WITH m AS (SELECT " + ", ".join(
        f"AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in MEASURES)
        + " FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
        half_up(f"({c}{f' - m_{c}' if center else ''}) / s_{c}", 6) + f" AS s_{i}"
        for i, c in enumerate(MEASURES)) + " FROM lineitem, m")


@query("e7_vector_all_rows", """
SELECT l_orderkey, l_linenumber, l_quantity AS v_0, l_extendedprice AS v_1, l_discount AS v_2,
  l_tax AS v_3 FROM lineitem""")
def e7(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    vectors = encode.assemble(lines, MEASURES, "v")
    arrays = vectors.select("l_orderkey", "l_linenumber", vector_to_array("v").alias("v"))
    return encode.unpacked(arrays, "v", [f"v_{i}" for i in range(4)])


@query("e8_standardise_centred", scaled_sql(True))
def e8(spark, sf_dir):
    return scaled(spark, sf_dir, True)


@query("e9_standardise_uncentred", scaled_sql(False))
def e9(spark, sf_dir):
    return scaled(spark, sf_dir, False)


# -- the regression inputs, from users to scaled vectors ------------------------------

REGRESSION_SQL = USERS_SQL + ", r AS (SELECT user_id, " + ", ".join(
    f"{c}::DOUBLE AS {c}" for c in regression.NUMBERS
) + ", employment_status, urban_rural, " + bucket_fraction("user_id") + """ < 0.7 AS is_train
  FROM users), means AS (SELECT """ + ", ".join(
    f"AVG({c}) AS m_{c}" for c in V.REGRESSION_INPUTS
) + " FROM r WHERE is_train), filled AS (SELECT user_id, is_train, employment_status, urban_rural, " + (
    f"{V.REGRESSION_LABEL} AS label, "
) + ", ".join(
    f"COALESCE({c}, m_{c}) AS {c}" for c in V.REGRESSION_INPUTS
) + f""" FROM r, means WHERE {V.REGRESSION_LABEL} IS NOT NULL
), ranges AS (SELECT MIN(body_mass_index) AS b0, MAX(body_mass_index) AS b1,
  MIN(blood_pressure_systolic) AS p0, MAX(blood_pressure_systolic) AS p1 FROM filled WHERE is_train
), features AS (SELECT *,
  daily_active_minutes_instagram / NULLIF(sleep_hours_per_night, 0) AS screen_to_sleep_ratio,
  time_on_feed_per_day + time_on_reels_per_day AS passive_consumption,
  (body_mass_index - b0) / (b1 - b0 + 1e-5) * 100::DOUBLE AS bmi_scaled,
  (blood_pressure_systolic - p0) / (p1 - p0 + 1e-5) * 100::DOUBLE AS bp_scaled,
  (bmi_scaled + bp_scaled) / 2::DOUBLE AS health_composite FROM filled, ranges
)"""

HOT = {"employment_status": 3, "urban_rural": 2}

VECTORS_SQL = (
    REGRESSION_SQL + ", train AS (SELECT * FROM features WHERE is_train)"
    + rank_ctes(HOT, "train")
    + ", raw_vectors AS (SELECT user_id, is_train, label, "
    + ", ".join(f"{c} AS x_{i}" for i, c in enumerate(V.REGRESSION_FEATURES)) + ", "
    + ", ".join(f"CASE WHEN a.idx = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS x_{11 + i}" for i in range(3))
    + ", "
    + ", ".join(f"CASE WHEN b.idx = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS x_{14 + i}" for i in range(2))
    + " FROM features JOIN rank_employment_status a ON employment_status = a.category"
    + " JOIN rank_urban_rural b ON urban_rural = b.category), sd AS (SELECT "
    + ", ".join(f"STDDEV_SAMP(x_{i}) AS sd_{i}" for i in range(16))
    + " FROM raw_vectors WHERE is_train)"
)


@query("e10_fit_then_apply", VECTORS_SQL + " SELECT user_id, label, CASE WHEN is_train THEN 'train'"
       " ELSE 'test' END AS part, " + ", ".join(
    f"{half_up(f'x_{i} / sd_{i}', 6)} AS f_{i}" for i in range(16)) + " FROM raw_vectors, sd")
def e10(spark, sf_dir):
    """Index, one-hot, assemble and scale, fitted on the training part, both parts out."""
    train, test = regression.prepared(*regression.split(clean_users(spark, sf_dir)))
    stages = Pipeline(stages=encode.feature_stages(
        V.REGRESSION_FEATURES, V.REGRESSION_CATEGORIES)).fit(train)
    parts = [
        stages.transform(df).select(
            "user_id", F.col(V.REGRESSION_LABEL).alias("label"), F.lit(name).alias("part"),
            vector_to_array("features").alias("f"),
        )
        for name, df in (("train", train), ("test", test))
    ]
    names = [f"f_{i}" for i in range(16)]
    out = encode.unpacked(parts[0].unionByName(parts[1]), "f", names)
    return out.withColumns({n: F.round(n, 6) for n in names})


@query("e11_range_scaled", REGRESSION_SQL + f"""
SELECT user_id, is_train, {half_up("bmi_scaled", 6)} AS bmi_scaled,
  {half_up("bp_scaled", 6)} AS bp_scaled FROM features""")
def e11(spark, sf_dir):
    train, test = regression.filled(*regression.split(clean_users(spark, sf_dir)))
    ranges = encode.column_ranges(train, ["body_mass_index", "blood_pressure_systolic"])
    both = train.withColumn("is_train", F.lit(True)).unionByName(
        test.withColumn("is_train", F.lit(False)))
    scaled_both = encode.scale_ranges(both, ranges, {
        "body_mass_index": "bmi_scaled", "blood_pressure_systolic": "bp_scaled"})
    return scaled_both.select(
        "user_id", "is_train", F.round("bmi_scaled", 6).alias("bmi_scaled"),
        F.round("bp_scaled", 6).alias("bp_scaled"),
    )
