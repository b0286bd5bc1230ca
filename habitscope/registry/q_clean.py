"""C*: dedupe, required columns, casts, text repair, filters, imputation, accounting."""

from __future__ import annotations

from pyspark.sql import functions as F

from habitscope.functions import columns as C
from habitscope.operators import clean
from habitscope.operators.explore import split_by_key
from habitscope.plans import fixed_values as V
from habitscope.plans import regression
from habitscope.plans import users as plan
from habitscope.registry.catalog import query
from habitscope.registry.dataset import (
    ACCEPTED, RAW_SQL, TYPED_SQL, USERS_SQL, bucket_fraction, clean_users, half_up, newest_first,
    raw_users, typed_users,
)


@query("c1_one_row_per_key", TYPED_SQL + """
SELECT user_id, record_id, copies, age, gender, education_level, last_login_date FROM one""")
def c1(spark, sf_dir):
    kept = plan.one_record_per_user(raw_users(spark, sf_dir), newest_first(), copies="copies")
    return kept.select(
        "user_id", "record_id", "copies", "age", "gender", "education_level", "last_login_date"
    )


@query("c2_required_columns", RAW_SQL + """
SELECT record_id, user_id, age, gender FROM raw
WHERE user_id IS NOT NULL AND age IS NOT NULL AND gender IS NOT NULL""")
def c2(spark, sf_dir):
    kept = clean.require_columns(raw_users(spark, sf_dir), V.REQUIRED)
    return kept.select("record_id", "user_id", "age", "gender")


@query("c3_cast_double", RAW_SQL + " SELECT record_id, " + ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in V.DOUBLE_COLUMNS) + " FROM raw")
def c3(spark, sf_dir):
    raw = raw_users(spark, sf_dir).select("record_id", *V.DOUBLE_COLUMNS)
    return clean.cast_columns(raw, {c: "double" for c in V.DOUBLE_COLUMNS})


@query("c4_cast_int", RAW_SQL + " SELECT record_id, " + ", ".join(
    f"CAST(TRUNC({c}) AS INTEGER) AS {c}" for c in V.INT_COLUMNS) + " FROM raw")
def c4(spark, sf_dir):
    raw = raw_users(spark, sf_dir).select("record_id", *V.INT_COLUMNS)
    return clean.cast_columns(raw, {c: "int" for c in V.INT_COLUMNS})


@query("c5_cast_and_move_last", USERS_SQL + " SELECT user_id, gender, country, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in V.CLUSTER_INPUTS) + " FROM users")
def c5(spark, sf_dir):
    users = clean_users(spark, sf_dir).select(*V.CLUSTER_INPUTS, "user_id", "gender", "country")
    return clean.cast_and_move_last(users, {c: "double" for c in V.CLUSTER_INPUTS})


@query("c6_cast_by_name", USERS_SQL + " SELECT user_id, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in [*V.REGRESSION_INPUTS, V.REGRESSION_LABEL]
) + ", employment_status, urban_rural FROM users")
def c6(spark, sf_dir):
    return regression.numeric_inputs(clean_users(spark, sf_dir))


@query("c7_parse_date", RAW_SQL + """
SELECT record_id, CAST(TRY_STRPTIME(last_login_date, '%m/%d/%Y') AS DATE) AS last_login_date
FROM raw""")
def c7(spark, sf_dir):
    raw = raw_users(spark, sf_dir).select("record_id", V.DATE_COLUMN)
    return clean.parse_dates(raw, {V.DATE_COLUMN: V.DATE_PATTERN})


@query("c8_typographic_apostrophe", RAW_SQL + """
SELECT record_id, REGEXP_REPLACE(education_level, '’', '''', 'g') AS education_level FROM raw""")
def c8(spark, sf_dir):
    return raw_users(spark, sf_dir).select(
        "record_id", C.straight_apostrophes("education_level").alias("education_level")
    )


@query("c9_misread_apostrophe", RAW_SQL + """
SELECT record_id, REPLACE(education_level, 'â€™', '''') AS education_level FROM raw""")
def c9(spark, sf_dir):
    return raw_users(spark, sf_dir).select(
        "record_id", C.repaired_apostrophes("education_level").alias("education_level")
    )


@query("c10_floor_to_int", RAW_SQL + """
SELECT record_id, CAST(FLOOR(account_creation_year) AS INTEGER) AS account_creation_year,
  CAST(FLOOR(hobbies_count) AS INTEGER) AS hobbies_count FROM raw""")
def c10(spark, sf_dir):
    raw = raw_users(spark, sf_dir).select("record_id", V.YEAR_COLUMN, "hobbies_count")
    return clean.floor_to_int(raw, V.YEAR_COLUMN, "hobbies_count")


RANGES = ACCEPTED.rsplit(" AND ", 1)[0]


@query("c11_closed_ranges", TYPED_SQL + f"""
SELECT user_id, {", ".join(V.ACCEPTED_RANGES)} FROM typed WHERE {RANGES}""")
def c11(spark, sf_dir):
    kept = clean.within_ranges(typed_users(spark, sf_dir), V.ACCEPTED_RANGES)
    return kept.select("user_id", *V.ACCEPTED_RANGES)


@query("c12_exclude_value", RAW_SQL + f"""
SELECT record_id, gender FROM raw WHERE gender <> '{V.EXCLUDED_GENDER}'""")
def c12(spark, sf_dir):
    raw = raw_users(spark, sf_dir).select("record_id", "gender")
    return clean.exclude_value(raw, "gender", V.EXCLUDED_GENDER)


@query("c13_impute_means", USERS_SQL + ", m AS (SELECT " + ", ".join(
    f"AVG({c}) AS m_{c}" for c in V.CLUSTER_INPUTS) + " FROM users) SELECT user_id, " + ", ".join(
    f"{half_up(f'COALESCE({c}::DOUBLE, m_{c})', 6)} AS {c}" for c in V.CLUSTER_INPUTS
) + " FROM users, m")
def c13(spark, sf_dir):
    cols = V.CLUSTER_INPUTS
    users = clean_users(spark, sf_dir).select("user_id", *cols)
    filled = clean.impute_means(clean.cast_columns(users, {c: "double" for c in cols}), cols)
    return filled.withColumns({c: F.round(c, 6) for c in cols})


@query("c14_impute_from_train", USERS_SQL + ", r AS (SELECT *, " + bucket_fraction("user_id")
       + " < 0.7 AS is_train FROM users), m AS (SELECT " + ", ".join(
    f"AVG({c}) AS m_{c}" for c in regression.NUMBERS) + " FROM r WHERE is_train)"
       + " SELECT user_id, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part, " + ", ".join(
    f"COALESCE({c}::DOUBLE, m_{c}) AS {c}" for c in regression.NUMBERS) + " FROM r, m")
def c14(spark, sf_dir):
    train, test = split_by_key(regression.numeric_inputs(clean_users(spark, sf_dir)), ["user_id"])
    train, test = regression.filled(train, test, impute_label=True)
    both = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return both.select("user_id", "part", *regression.NUMBERS)


REJECT_SQL = " ".join(
    [f"WHEN {c} IS NULL THEN '{c}_present'" for c in V.REQUIRED]
    + [f"WHEN COALESCE({c} NOT BETWEEN {lo} AND {hi}, TRUE) THEN '{c}_in_range'"
       for c, (lo, hi) in V.ACCEPTED_RANGES.items()]
    + [f"WHEN gender = '{V.EXCLUDED_GENDER}' THEN 'gender_stated'"]
)


@query("c15_reject_report", TYPED_SQL + f"""
SELECT CASE {REJECT_SQL} ELSE 'kept' END AS outcome, COUNT(*) AS rows FROM typed GROUP BY 1""")
def c15(spark, sf_dir):
    return clean.reject_report(typed_users(spark, sf_dir), plan.cleaning_rules())
