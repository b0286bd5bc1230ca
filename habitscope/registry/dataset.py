"""The wide user table, derived from the whole orders and lineitem tables.

Every order is one raw record of the user who placed it, so users have about ten
records each: the duplicates the cleaning job has to resolve. The 57 columns are
arithmetic on the order and on the sums of its lines, chosen to fall into the
ranges and categories of the user table, with missing values, numbers that do not
parse, impossible dates and both apostrophe faults among them. Measures are whole
numbers or binary fractions, so sums and means are exact in any order.

``COLUMNS`` is SQL that Spark and DuckDB read alike; everything around it is
written once per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from habitscope.plans import fixed_values as V
from habitscope.plans import users as plan

COLUMNS = {
    "record_id": "o_orderkey",
    "user_id": "o_custkey",
    # whole numbers, held as double as a type-inferring reader would leave them
    "age": "CASE WHEN priority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(11 + cents % 57 AS DOUBLE) END",
    "perceived_stress_score":
        "CASE WHEN dom > 27 THEN NULL WHEN ret * 3 + lines + cents % 13 > 41 THEN CAST(40 AS DOUBLE)"
        " ELSE CAST(ret * 3 + lines + cents % 13 - 1 AS DOUBLE) END",
    "self_reported_happiness": "CAST(1 + CAST(FLOOR(cents / 100) AS BIGINT) % 10 AS DOUBLE)",
    "blood_pressure_systolic": "CAST(65 + cents % 140 AS DOUBLE)",
    "blood_pressure_diastolic":
        "CASE WHEN status = 'P' AND dom > 20 THEN NULL ELSE CAST(50 + cents % 61 AS DOUBLE) END",
    "daily_steps_count": "CAST(500 + parts % 15000 AS DOUBLE)",
    "hobbies_count": "CAST(lines AS DOUBLE) + CAST(0.75 AS DOUBLE)",
    "social_events_per_month": "CAST(ret + disc % 5 AS DOUBLE)",
    "books_read_per_year": "CAST(tax % 25 AS DOUBLE)",
    "travel_frequency_per_year": "CAST(day % 12 AS DOUBLE)",
    "daily_active_minutes_instagram":
        "CASE WHEN dom = 13 THEN NULL ELSE CAST(10 + qty + cents % 60 AS DOUBLE) END",
    "sessions_per_day": "CAST(lines + cents % 4 AS DOUBLE)",
    "posts_created_per_week": "CAST(cents % 6 AS DOUBLE)",
    "reels_watched_per_day": "CAST(day % 25 AS DOUBLE)",
    "stories_viewed_per_day": "CAST(disc AS DOUBLE)",
    "likes_given_per_day": "CAST(qty % 60 AS DOUBLE)",
    "comments_written_per_day": "CAST(cents % 4 AS DOUBLE)",
    "dms_sent_per_week": "CAST(tax AS DOUBLE)",
    "dms_received_per_week": "CASE WHEN dom < 7 THEN NULL ELSE CAST(day % 31 AS DOUBLE) END",
    "ads_viewed_per_day": "CASE WHEN dom = 28 THEN NULL ELSE CAST(disc % 30 AS DOUBLE) END",
    "ads_clicked_per_day": "CASE WHEN priority = '5-LOW' THEN NULL ELSE CAST(ret AS DOUBLE) END",
    "time_on_feed_per_day": "CAST(disc + cents % 40 AS DOUBLE)",
    "time_on_explore_per_day": "CAST(tax + 3 AS DOUBLE)",
    "time_on_messages_per_day":
        "CASE WHEN priority = '5-LOW' THEN NULL ELSE CAST(cents % 30 AS DOUBLE) END",
    "time_on_reels_per_day": "CASE WHEN dom = 9 THEN NULL ELSE CAST(day % 50 AS DOUBLE) END",
    "followers_count":
        "CAST(CASE WHEN cents % 50 = 0 THEN 40000 + cents % 10000 ELSE cents % 3000 END AS DOUBLE)",
    "following_count": "CAST(parts % 16 * 25 AS DOUBLE)",
    "account_creation_year": "CAST(2009 + cents % 18 AS DOUBLE) + CAST(0.75 AS DOUBLE)",
    "linked_accounts_count": "CAST(ret + cents % 5 AS DOUBLE)",
    "average_session_length_minutes": "CAST(3 + cents % 52 AS DOUBLE)",
    # measures that arrive as text, some of it not a number
    "exercise_hours_per_week":
        "CAST(CASE WHEN tax % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tax % 52 AS DOUBLE) / 4 END AS STRING)",
    "sleep_hours_per_night": "CAST(CAST(10 + cents % 32 AS DOUBLE) / 4 AS STRING)",
    "weekly_work_hours": "CAST(CAST(cents % 168 AS DOUBLE) / 2 AS STRING)",
    "volunteer_hours_per_month":
        "CASE WHEN status = 'F' AND dom = 2 THEN 'n/a' ELSE CAST(CAST(ret AS DOUBLE) / 2 AS STRING) END",
    "user_engagement_score": "CAST(CAST(qty + ret * 4 + lines * 8 AS DOUBLE) / 64 AS STRING)",
    "body_mass_index": "CAST(CAST(56 + cents % 128 AS DOUBLE) / 4 AS STRING)",
    "notification_response_rate":
        "CASE WHEN priority = '5-LOW' AND status = 'P' THEN 'n/a' WHEN priority = '5-LOW' THEN NULL"
        " ELSE CAST(CAST(cents % 129 AS DOUBLE) / 128 AS STRING) END",
    # categories
    "gender":
        "CASE WHEN priority = '5-LOW' AND dom > 25 THEN NULL WHEN cents % 9 < 4 THEN 'Male'"
        " WHEN cents % 9 < 7 THEN 'Female' WHEN cents % 9 = 7 THEN 'Non-binary'"
        " ELSE 'Prefer not to say' END",
    "has_children": "CASE WHEN day % 2 = 0 THEN 'No' ELSE 'Yes' END",
    "uses_premium_features": "CASE WHEN disc % 3 = 0 THEN 'Yes' ELSE 'No' END",
    "two_factor_auth_enabled": "CASE WHEN lines % 2 = 0 THEN 'Yes' ELSE 'No' END",
    "biometric_login_used": "CASE WHEN dom % 2 = 0 THEN 'Yes' WHEN dom = 15 THEN NULL ELSE 'No' END",
    "smoking":
        "CASE WHEN tax % 7 = 0 THEN 'Yes' WHEN tax % 7 = 1 THEN 'Former' WHEN tax % 7 = 2"
        " THEN 'Unknown' ELSE 'No' END",
    "income_level":
        "CASE WHEN cents < 10000000 THEN 'Low' WHEN cents < 20000000 THEN 'Lower-middle'"
        " WHEN cents < 30000000 THEN 'Middle' WHEN cents < 40000000 THEN 'Upper-middle' ELSE 'High' END",
    "diet_quality":
        "CASE disc % 5 WHEN 0 THEN 'Very poor' WHEN 1 THEN 'Poor' WHEN 2 THEN 'Average'"
        " WHEN 3 THEN 'Good' ELSE 'Excellent' END",
    "alcohol_frequency":
        "CASE qty % 5 WHEN 0 THEN 'Never' WHEN 1 THEN 'Rarely' WHEN 2 THEN 'Weekly'"
        " WHEN 3 THEN 'Several times a week' ELSE 'Daily' END",
    "privacy_setting_level":
        "CASE parts % 3 WHEN 0 THEN 'Public' WHEN 1 THEN 'Friends only' ELSE 'Private' END",
    "education_level":
        "CASE day % 6 WHEN 0 THEN 'High school' WHEN 1 THEN 'Some college' WHEN 2 THEN"
        " CASE status WHEN 'F' THEN 'Bachelor’s' WHEN 'O' THEN 'Bachelorâ€™s' ELSE 'Bachelor''s' END"
        " WHEN 3 THEN CASE status WHEN 'F' THEN 'Master’s' WHEN 'O' THEN 'Masterâ€™s' ELSE 'Master''s' END"
        " WHEN 4 THEN 'PhD' ELSE 'Other' END",
    "urban_rural":
        "CASE WHEN status = 'P' AND dom = 7 THEN NULL WHEN n_regionkey < 2 THEN 'Urban'"
        " WHEN n_regionkey < 4 THEN 'Suburban' ELSE 'Rural' END",
    "employment_status":
        "CASE mon % 4 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Part-time' WHEN 2 THEN 'Student'"
        " ELSE CASE WHEN dom = 30 THEN NULL ELSE 'Unemployed' END END",
    "relationship_status":
        "CASE dom % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' ELSE 'In a relationship' END",
    "content_type_preference": "CASE status WHEN 'F' THEN 'Reels' WHEN 'O' THEN 'Photos' ELSE 'Stories' END",
    "preferred_content_theme":
        "CASE cents % 5 WHEN 0 THEN 'Travel' WHEN 1 THEN 'Food' WHEN 2 THEN 'Fitness'"
        " WHEN 3 THEN 'Fashion' ELSE 'Tech' END",
    "subscription_status":
        "CASE cents % 3 WHEN 0 THEN 'Free' WHEN 1 THEN 'Premium' ELSE 'Trial' END",
    "country": "n_name",
    "last_login_date":
        "CASE WHEN priority = '1-URGENT' AND status = 'P' THEN '13/40/2024'"
        " ELSE CONCAT(CAST(mon AS STRING), '/', CAST(dom AS STRING), '/', CAST(yr AS STRING)) END",
}

FIELDS = list(COLUMNS)


# -- Spark -----------------------------------------------------------------------


# Declared, so that reading these starts no job to look at the files.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
                " c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


#: The tables that users are made of.
RAW_TABLES = ("orders", "lineitem", "nation")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are summed per order before they meet the orders, and both sides of
    that join are then unique in its key, so no order can be hot. The orders are
    partitioned on the join key up front: a shuffled join reuses that, and a few
    small files still feed every core. Nation is left for Spark to broadcast if its
    file is small enough."""
    def hundredths(c: str):
        return F.round(F.col(c) * 100).cast("bigint")

    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.sum(hundredths("l_discount")).alias("disc"),
        F.sum(hundredths("l_tax")).alias("tax"),
        F.count_if(F.col("l_returnflag") == "R").alias("ret"),
        F.sum("l_partkey").alias("parts"),
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        hundredths("o_totalprice").alias("cents"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.date_diff(F.to_date("o_orderdate"), F.to_date(F.lit("1995-01-01"))).alias("day"),
        F.year("o_orderdate").alias("yr"),
        F.month("o_orderdate").alias("mon"),
        F.dayofmonth("o_orderdate").alias("dom"),
    ).repartition("o_orderkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    base = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        nation, (F.col("cents") % 25).cast("int") == F.col("n_nationkey")
    )
    return base.selectExpr(*[f"{text} AS {name}" for name, text in COLUMNS.items()])


def newest_first() -> list:
    """Among a user's records the latest one is kept."""
    return [F.col("record_id")]


def clean_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.clean_users(raw_users(spark, sf_dir), newest_first(), unique=True).drop("record_id")


def typed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed row per user, before the acceptance filters."""
    return plan.one_record_per_user(plan.typed(raw_users(spark, sf_dir)), newest_first(), unique=True)


# -- DuckDB ------------------------------------------------------------------------


def half_up(expression: str, digits: int) -> str:
    """Round half up on the decimal text of a double, which is what Spark does."""
    return (
        f"CAST(ROUND(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38, 17)), {digits}) AS DOUBLE)"
    )


def bucket_fraction(key: str, seed: int = 42) -> str:
    return f"(CAST('0x' || SUBSTR(MD5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def sql_codes(column: str, codes: dict[str, float]) -> str:
    arms = " ".join(
        "WHEN '{}' THEN {}::DOUBLE".format(label.replace("'", "''"), code)
        for label, code in codes.items()
    )
    return f"CASE {column} {arms} END"


def sql_rules(rule: tuple) -> str:
    _, rules, default = rule
    arms = " ".join(f"WHEN {predicate} THEN '{label}'" for label, predicate in rules)
    return f"CASE {arms} ELSE '{default}' END"


COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in V.REQUIRED)
ACCEPTED = " AND ".join(
    f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in V.ACCEPTED_RANGES.items()
) + f" AND gender <> '{V.EXCLUDED_GENDER}'"


def _typed_column(c: str) -> str:
    if c in V.DOUBLE_COLUMNS:
        return f"TRY_CAST({c} AS DOUBLE) AS {c}"
    if c in V.INT_COLUMNS:
        return f"CAST(TRUNC({c}) AS INTEGER) AS {c}"
    if c == V.DATE_COLUMN:
        return f"CAST(TRY_STRPTIME({c}, '%m/%d/%Y') AS DATE) AS {c}"
    if c == V.TEXT_TO_REPAIR:
        return f"REGEXP_REPLACE(REGEXP_REPLACE({c}, '’', '''', 'g'), 'â€™', '''', 'g') AS {c}"
    return c


RAW_SQL = f"""WITH base AS (
  SELECT o_orderkey, o_custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,
    o_orderpriority AS priority, o_orderstatus AS status,
    DATE_DIFF('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS day,
    YEAR(o_orderdate) AS yr, MONTH(o_orderdate) AS mon, DAY(o_orderdate) AS dom,
    l.*, n_name, n_regionkey
  FROM orders LEFT JOIN (
    SELECT l_orderkey, COUNT(*) AS lines, SUM(CAST(l_quantity AS BIGINT))::BIGINT AS qty,
      SUM(CAST(ROUND(l_discount * 100) AS BIGINT))::BIGINT AS disc,
      SUM(CAST(ROUND(l_tax * 100) AS BIGINT))::BIGINT AS tax,
      COUNT(*) FILTER (WHERE l_returnflag = 'R') AS ret, SUM(l_partkey)::BIGINT AS parts
    FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
  JOIN nation ON CAST(ROUND(o_totalprice * 100) AS BIGINT) % 25 = n_nationkey
), raw AS (
  SELECT {", ".join(f"{text} AS {name}" for name, text in COLUMNS.items())}
  FROM base
)"""

TYPED_SQL = RAW_SQL + f""", one AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, COUNT(*) OVER (PARTITION BY user_id) AS copies,
      ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ({COMPLETE}) DESC, record_id DESC) AS rn
    FROM raw) WHERE rn = 1
), typed AS (
  SELECT {", ".join(_typed_column(c) for c in FIELDS)}, copies FROM one
)"""

DERIVED_SQL = f"""
    time_on_feed_per_day + time_on_explore_per_day + time_on_messages_per_day
      + time_on_reels_per_day AS total_time_on_instagram_per_day,
    CASE WHEN ads_viewed_per_day > 0 THEN ads_clicked_per_day / ads_viewed_per_day
      ELSE 0.0::DOUBLE END AS ads_ctr,
    CASE WHEN following_count > 0 THEN followers_count / following_count
      ELSE followers_count::DOUBLE END AS follower_following_ratio,
    {V.AS_OF_YEAR} - account_creation_year AS account_age_years,
    perceived_stress_score / 40.0::DOUBLE AS stress_score_normalized"""

USERS_SQL = TYPED_SQL + f""", users AS (
  SELECT * EXCLUDE (copies, record_id),
    {", ".join(f"{sql_codes(c, m)} AS {c}_encoded" for c, m in (V.FLAG_CODES | V.ORDINAL_CODES).items())},
    {DERIVED_SQL}
  FROM typed WHERE {COMPLETE} AND {ACCEPTED}
)"""
