"""S*: files, views, audits and one-row statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from habitscope.operators import clean
from habitscope.plans import fixed_values as V
from habitscope.plans import users as plan
from habitscope.registry.catalog import query
from habitscope.registry.dataset import (
    COMPLETE, RAW_SQL, TYPED_SQL, USERS_SQL, clean_users, raw_users, table, typed_users,
)
from habitscope.registry.q_reports import BY_GENDER
from habitscope.sources import tables
from habitscope.sources.scratch import new_scratch_path

RAW_FIELDS = [f.name for f in plan.raw_schema().fields]


@query("s1_csv_declared_types", RAW_SQL + f" SELECT {', '.join(RAW_FIELDS)} FROM raw")
def s1(spark, sf_dir):
    """The raw user file written as CSV and read with its declared schema."""
    path = new_scratch_path(spark, "raw-csv")
    tables.write_csv(raw_users(spark, sf_dir).select(*RAW_FIELDS), path)
    return tables.read_csv(spark, path, plan.raw_schema())


@query("s1_csv_inferred_types", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM part""")
def s1_inferred(spark, sf_dir):
    path = new_scratch_path(spark, "part-csv")
    tables.write_csv(table(spark, sf_dir, "part"), path)
    return tables.read_csv(spark, path)


@query("s2_csv_all_text", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def s2(spark, sf_dir):
    path = new_scratch_path(spark, "customer-csv")
    tables.write_csv(table(spark, sf_dir, "customer"), path)
    return tables.read_csv_text(spark, path)


@query("s3_csv_sink", "SELECT * FROM orders")
def s3(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = new_scratch_path(spark, "orders-csv")
    tables.write_csv(orders, path)
    return tables.read_csv(spark, path, orders.schema)


@query("s3_parquet_sink", USERS_SQL + " SELECT * FROM users")
def s3_parquet(spark, sf_dir):
    path = new_scratch_path(spark, "users-clean")
    tables.write_parquet(clean_users(spark, sf_dir), path)
    return tables.read_parquet(spark, path)


@query("s4_temp_view", BY_GENDER)
def s4(spark, sf_dir):
    tables.register_view(clean_users(spark, sf_dir), "users_clean")
    return spark.sql("""
        SELECT gender, COUNT(*) AS total_users,
               ROUND(AVG(user_engagement_score), 4) AS avg_engagement
        FROM users_clean GROUP BY gender ORDER BY total_users DESC""")


def audit_rules() -> dict:
    return {
        "has_age": F.col("age").isNotNull(),
        "has_gender": F.col("gender").isNotNull(),
        "in_ranges": clean.in_ranges(V.ACCEPTED_RANGES),
    }


RANGES_SQL = " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in V.ACCEPTED_RANGES.items())


@query("s7_shape_audit", TYPED_SQL + f"""
SELECT COUNT(*) AS rows, {len(RAW_FIELDS) + 1}::BIGINT AS columns,
  COUNT(*) FILTER (WHERE age IS NOT NULL) AS has_age,
  COUNT(*) FILTER (WHERE gender IS NOT NULL) AS has_gender,
  COUNT(*) FILTER (WHERE {RANGES_SQL}) AS in_ranges FROM typed""")
def s7(spark, sf_dir):
    return clean.shape_audit(typed_users(spark, sf_dir), audit_rules())


@query("s7_stage_counts", TYPED_SQL + f"""
SELECT *, raw_rows - clean_rows AS removed_rows FROM (
  SELECT SUM(copies)::BIGINT AS raw_rows, COUNT(*) AS distinct_users,
    COUNT(*) FILTER (WHERE {COMPLETE}) AS after_nulls,
    COUNT(*) FILTER (WHERE {COMPLETE} AND {RANGES_SQL} AND gender <> '{V.EXCLUDED_GENDER}')
      AS clean_rows FROM typed)""")
def s7_stages(spark, sf_dir):
    return plan.stage_counts(raw_users(spark, sf_dir), [F.col("record_id")])


@query("s10_one_row_statistics", USERS_SQL + " SELECT " + ", ".join(
    f"AVG({c}) AS {c}" for c in V.REGRESSION_INPUTS) + " FROM users")
def s10(spark, sf_dir):
    return clean.column_means(clean_users(spark, sf_dir), V.REGRESSION_INPUTS)
