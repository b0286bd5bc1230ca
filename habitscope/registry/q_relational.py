"""X*, A*, J*, W*, O*: scalar functions, aggregates, the one-row join, windows, order.

These run on the plain tables, whole.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from habitscope.functions import columns as C
from habitscope.functions.measures import mean_of, ratio_of_means, row_count, share_pct
from habitscope.functions.windows import number_desc, rank_desc, total_over
from habitscope.operators.anomaly import mean_and_deviation, with_abs_z
from habitscope.operators.encode import column_ranges
from habitscope.operators.evaluate import leaderboard
from habitscope.operators.report import grouped, rank_everywhere, share_of_all, top_ranked
from habitscope.operators.segment import Segmentation, segment
from habitscope.registry.catalog import query
from habitscope.registry.dataset import half_up, table

LINE = ["l_orderkey", "l_linenumber"]

# -- scalar functions ------------------------------------------------------------------


@query("x1_round_half_up", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{half_up('l_extendedprice * (1 - l_discount) / 7', n)} AS r{n}" for n in range(5)
) + " FROM lineitem")
def x1(spark, sf_dir):
    net = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) / 7
    return table(spark, sf_dir, "lineitem").select(
        *LINE, *[F.round(net, n).alias(f"r{n}") for n in range(5)])


@query("x2_null_on_zero", """
SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0) AS discount_or_null,
  l_tax / NULLIF(l_discount, 0) AS tax_per_discount FROM lineitem""")
def x2(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *LINE, F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount_or_null"),
        C.safe_ratio("l_tax", "l_discount").alias("tax_per_discount"))


@query("x3_absolute_value", """
SELECT c_custkey, ABS(c_acctbal) AS size, ABS(c_acctbal - 4500) * 3 AS gap FROM customer""")
def x3(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.abs("c_acctbal").alias("size"), C.gap_from("c_acctbal", 4500, 3).alias("gap"))


@query("x4_arithmetic", """
SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber AS plus, l_quantity - l_linenumber AS minus,
  l_quantity * l_linenumber AS times, l_quantity / l_linenumber AS over,
  l_orderkey / (l_linenumber + 1) AS whole_over FROM lineitem""")
def x4(spark, sf_dir):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        *LINE, (q + n).alias("plus"), (q - n).alias("minus"), (q * n).alias("times"),
        (q / n).alias("over"), (F.col("l_orderkey") / (n + 1)).alias("whole_over"))


@query("x5_percent_of_mean", f"""
SELECT l_returnflag, {half_up("AVG(l_discount) * 100", 1)} AS discount_pct FROM lineitem GROUP BY 1""")
def x5(spark, sf_dir):
    return grouped(table(spark, sf_dir, "lineitem"), ["l_returnflag"], {
        "discount_pct": mean_of("l_discount", 1, times=100.0)})


@query("x6_searched_case", """
SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_orderstatus = 'F' AND
  o_totalprice < 300000 THEN 'middle, finished' ELSE 'other' END AS size FROM orders""")
def x6(spark, sf_dir):
    size = C.first_match([
        ("small", F.col("o_totalprice") < 100000),
        ("middle, finished", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 300000)),
    ], "other")
    return table(spark, sf_dir, "orders").select("o_orderkey", size.alias("size"))


@query("x7_closed_interval", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def x7(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.col("p_size").between(10, 20)).select(
        "p_partkey", "p_size")


@query("x8_comparisons", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 40
  AND l_returnflag <> 'A' AND l_linenumber <= 5 AND l_tax > 0.01 AND l_linestatus = 'F'""")
def x8(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter(
        (F.col("l_quantity") >= 10) & (F.col("l_quantity") < 40) & (F.col("l_returnflag") != "A")
        & (F.col("l_linenumber") <= 5) & (F.col("l_tax") > 0.01) & (F.col("l_linestatus") == "F")
    ).select(*LINE)


@query("x9_star_with_added", """
SELECT *, s_acctbal / 1000.0::DOUBLE AS thousands,
  CASE WHEN s_acctbal < 0 THEN 'debit' ELSE 'credit' END AS side FROM supplier""")
def x9(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").withColumn(
        "thousands", C.scaled_down("s_acctbal", 1000))
    return segment(suppliers, Segmentation("side", [("debit", "s_acctbal < 0")], "credit"))


@query("x10_output_names", """
SELECT n_name AS ten_quoc_gia, n_regionkey AS ma_vung FROM nation""")
def x10(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("ten_quoc_gia"), F.col("n_regionkey").alias("ma_vung"))


@query("x11_text_functions", """
SELECT p_partkey, REGEXP_REPLACE(p_name, '[aeiou]', '*', 'g') AS starred,
  CAST(FLOOR(p_retailprice) AS INTEGER) AS whole_price,
  TRY_CAST(REGEXP_REPLACE(p_brand, '[^0-9]', '', 'g') AS DOUBLE) AS brand_number FROM part""")
def x11(spark, sf_dir):
    digits = F.regexp_replace("p_brand", "[^0-9]", "")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.regexp_replace("p_name", "[aeiou]", "*").alias("starred"),
        C.floored_int("p_retailprice").alias("whole_price"),
        C.lenient_cast(digits, "double").alias("brand_number"))


# -- aggregates ----------------------------------------------------------------------------


@query("a1_rows_per_group", "SELECT l_returnflag, COUNT(*) AS rows FROM lineitem GROUP BY 1")
def a1(spark, sf_dir):
    return grouped(table(spark, sf_dir, "lineitem"), ["l_returnflag"], {"rows": row_count()})


@query("a2_rounded_means", f"""
SELECT l_linestatus, {half_up("AVG(l_quantity)", 2)} AS avg_quantity,
  {half_up("AVG(l_extendedprice)", 1)} AS avg_price, {half_up("AVG(l_linenumber)", 4)} AS avg_line
FROM lineitem GROUP BY 1""")
def a2(spark, sf_dir):
    return grouped(table(spark, sf_dir, "lineitem"), ["l_linestatus"], {
        "avg_quantity": mean_of("l_quantity", 2), "avg_price": mean_of("l_extendedprice", 1),
        "avg_line": mean_of("l_linenumber", 4)})


@query("a3_ratio_of_means", f"""
SELECT l_returnflag, {half_up("AVG(l_quantity) / NULLIF(AVG(l_linenumber), 0)", 4)} AS per_line,
  AVG(l_quantity) / NULLIF(AVG(l_quantity - l_quantity), 0) AS by_zero FROM lineitem GROUP BY 1""")
def a3(spark, sf_dir):
    return grouped(table(spark, sf_dir, "lineitem"), ["l_returnflag"], {
        "per_line": ratio_of_means("l_quantity", "l_linenumber", 4),
        "by_zero": ratio_of_means("l_quantity", F.col("l_quantity") - F.col("l_quantity"))})


@query("a4_population_deviation", f"""
SELECT l_returnflag, {half_up("STDDEV_POP(l_extendedprice)", 4)} AS sd_price,
  {half_up("STDDEV_POP(l_quantity)", 6)} AS sd_quantity FROM lineitem GROUP BY 1""")
def a4(spark, sf_dir):
    return grouped(table(spark, sf_dir, "lineitem"), ["l_returnflag"], {
        "sd_price": F.round(F.stddev_pop("l_extendedprice"), 4),
        "sd_quantity": F.round(F.stddev_pop("l_quantity"), 6)})


@query("a5_whole_table_statistics", f"""
SELECT {half_up("AVG(l_quantity)", 6)} AS mean_q, {half_up("AVG(l_extendedprice)", 4)} AS mean_p,
  {half_up("STDDEV_POP(l_quantity)", 6)} AS sd_q, {half_up("STDDEV_POP(l_extendedprice)", 4)} AS sd_p
FROM lineitem""")
def a5(spark, sf_dir):
    one = mean_and_deviation(
        table(spark, sf_dir, "lineitem"), {"q": "l_quantity", "p": "l_extendedprice"})
    return one.select(
        F.round("mean_q", 6).alias("mean_q"), F.round("mean_p", 4).alias("mean_p"),
        F.round("sd_q", 6).alias("sd_q"), F.round("sd_p", 4).alias("sd_p"))


PRICE_BAND = Segmentation(
    "band", [("low", "o_totalprice < 100000"), ("mid", "o_totalprice BETWEEN 100000 AND 300000")],
    "high")
BAND_SQL = """CASE WHEN o_totalprice < 100000 THEN 'low'
  WHEN o_totalprice BETWEEN 100000 AND 300000 THEN 'mid' ELSE 'high' END"""


@query("a6_group_by_expression", f"""
SELECT {BAND_SQL} AS band, COUNT(*) AS rows, {half_up("AVG(o_totalprice)", 2)} AS avg_price
FROM orders GROUP BY 1""")
def a6(spark, sf_dir):
    return grouped(table(spark, sf_dir, "orders"), [PRICE_BAND.column()], {
        "rows": row_count(), "avg_price": mean_of("o_totalprice", 2)})


@query("a7_group_by_three_keys", """
SELECT l_returnflag, l_linestatus, l_linenumber, COUNT(*) AS rows, AVG(l_quantity) AS avg_quantity
FROM lineitem GROUP BY 1, 2, 3""")
def a7(spark, sf_dir):
    return grouped(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"],
        {"rows": row_count(), "avg_quantity": mean_of("l_quantity")})


@query("a8_having", """
SELECT o_custkey, COUNT(*) AS rows FROM orders GROUP BY 1 HAVING COUNT(*) > 12""")
def a8(spark, sf_dir):
    return grouped(table(spark, sf_dir, "orders"), ["o_custkey"], {"rows": row_count()},
                   having=F.col("rows") > 12)


@query("a9_min_max", """
SELECT MIN(o_totalprice) AS o_totalprice_min, MAX(o_totalprice) AS o_totalprice_max,
  MIN(o_custkey) AS o_custkey_min, MAX(o_custkey) AS o_custkey_max FROM orders""")
def a9(spark, sf_dir):
    return column_ranges(table(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey"])


# -- one-row join, CTE chain, derived table ---------------------------------------------------


@query("j1_one_row_join", f"""
SELECT o_orderkey, {half_up("ABS((o_totalprice - m) / NULLIF(s, 0))", 6)} AS z_price
FROM orders, (SELECT AVG(o_totalprice) AS m, STDDEV_POP(o_totalprice) AS s FROM orders)""")
def j1(spark, sf_dir):
    scored = with_abs_z(table(spark, sf_dir, "orders"), {"price": "o_totalprice"})
    return scored.select("o_orderkey", F.round("z_price", 6).alias("z_price"))


@query("j2_staged_query", f"""
WITH a AS (SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY 1),
b AS (SELECT CASE WHEN orders < 8 THEN 'few' WHEN orders <= 12 THEN 'some' ELSE 'many' END AS habit,
  orders FROM a),
c AS (SELECT habit, COUNT(*) AS customers, {half_up("AVG(orders)", 3)} AS avg_orders FROM b GROUP BY 1)
SELECT *, RANK() OVER (ORDER BY avg_orders DESC) AS place FROM c""")
def j2(spark, sf_dir):
    per_customer = grouped(table(spark, sf_dir, "orders"), ["o_custkey"], {"orders": row_count()})
    habit = Segmentation("habit", [("few", "orders < 8"), ("some", "orders <= 12")], "many")
    classes = grouped(per_customer, [habit.column()], {
        "customers": row_count(), "avg_orders": mean_of("orders", 3)})
    return classes.withColumn("place", rank_desc("avg_orders"))


@query("j3_derived_table", """
SELECT rows, COUNT(*) AS orders FROM (SELECT l_orderkey, COUNT(*) AS rows FROM lineitem GROUP BY 1)
GROUP BY rows""")
def j3(spark, sf_dir):
    sizes = grouped(table(spark, sf_dir, "lineitem"), ["l_orderkey"], {"rows": row_count()})
    return grouped(sizes, ["rows"], {"orders": row_count()})


# -- windows ------------------------------------------------------------------------------------

GROUPS_SQL = f"""WITH g AS (SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
  {half_up("AVG(l_quantity)", 2)} AS q, AVG(l_linenumber) AS l FROM lineitem GROUP BY 1, 2)"""


def line_groups(spark, sf_dir):
    return grouped(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "n": row_count(), "q": mean_of("l_quantity", 2), "l": mean_of("l_linenumber")})


@query("w1_rank", GROUPS_SQL + " SELECT *, RANK() OVER (ORDER BY q DESC NULLS LAST) AS place FROM g")
def w1(spark, sf_dir):
    return line_groups(spark, sf_dir).withColumn("place", rank_desc("q"))


@query("w1_rank_whole_table", """
SELECT l_orderkey, l_linenumber, l_quantity, RANK() OVER (ORDER BY l_quantity DESC) AS place
FROM lineitem""")
def w1_whole(spark, sf_dir):
    """RANK over every row of a table, with no single-task sort."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE, "l_quantity")
    return rank_everywhere(lines, "l_quantity", "place")


@query("w2_rank_by_expression", GROUPS_SQL + """
SELECT *, RANK() OVER (ORDER BY q / NULLIF(l / 60.0::DOUBLE, 0) DESC NULLS LAST) AS place FROM g""")
def w2(spark, sf_dir):
    return line_groups(spark, sf_dir).withColumn(
        "place", rank_desc(C.safe_ratio("q", F.col("l") / F.lit(60.0))))


@query("w3_rank_in_partition", GROUPS_SQL + """
SELECT *, RANK() OVER (PARTITION BY l_returnflag ORDER BY q DESC NULLS LAST) AS place FROM g""")
def w3(spark, sf_dir):
    return line_groups(spark, sf_dir).withColumn("place", rank_desc("q", ["l_returnflag"]))


@query("w4_rank_by_aggregate", """
SELECT l_linenumber, l_returnflag, COUNT(*) AS n,
  RANK() OVER (PARTITION BY l_linenumber ORDER BY AVG(l_quantity) DESC) AS place
FROM lineitem GROUP BY 1, 2""")
def w4(spark, sf_dir):
    return grouped(table(spark, sf_dir, "lineitem"), ["l_linenumber", "l_returnflag"], {
        "n": row_count(), "exact": mean_of("l_quantity"),
    }).withColumn("place", rank_desc("exact", ["l_linenumber"])).drop("exact")


@query("w5_row_number_in_partition", """
SELECT c_nationkey, c_mktsegment, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY c_nationkey
  ORDER BY COUNT(*) DESC, c_mktsegment) AS position FROM customer GROUP BY 1, 2""")
def w5(spark, sf_dir):
    groups = grouped(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"],
                     {"n": row_count()})
    return groups.withColumn("position", number_desc("n", ["c_mktsegment"], ["c_nationkey"]))


@query("w6_share_of_total", f"""
SELECT c_mktsegment, COUNT(*) AS n,
  {half_up("COUNT(*)::DOUBLE * 100.0::DOUBLE / (SUM(COUNT(*)) OVER ())::DOUBLE", 2)} AS pct
FROM customer GROUP BY 1""")
def w6(spark, sf_dir):
    groups = grouped(table(spark, sf_dir, "customer"), ["c_mktsegment"], {"n": row_count()})
    return groups.withColumn("pct", share_pct(F.col("n"), total_over("n")))


@query("w6_share_without_window", f"""
SELECT o_custkey, COUNT(*) AS n,
  {half_up("COUNT(*)::DOUBLE * 100.0::DOUBLE / (SELECT COUNT(*) FROM orders)::DOUBLE", 4)} AS pct
FROM orders GROUP BY 1""")
def w6_many(spark, sf_dir):
    """The same share for an unbounded number of groups."""
    groups = grouped(table(spark, sf_dir, "orders"), ["o_custkey"], {"n": row_count()})
    return share_of_all(groups, "n", "pct", digits=4)


@query("w7_share_in_partition", f"""
SELECT c_nationkey, c_mktsegment, COUNT(*) AS n,
  {half_up("COUNT(*)::DOUBLE * 100.0::DOUBLE / (SUM(COUNT(*)) OVER (PARTITION BY c_nationkey))::DOUBLE", 2)}
    AS pct FROM customer GROUP BY 1, 2""")
def w7(spark, sf_dir):
    groups = grouped(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"],
                     {"n": row_count()})
    return groups.withColumn("pct", share_pct(F.col("n"), total_over("n", ["c_nationkey"])))


@query("w8_share_over_aggregate", f"""
SELECT event_type, COUNT(*) AS n, {half_up("AVG(value)", 2)} AS avg_value,
  {half_up("COUNT(*)::DOUBLE * 100.0::DOUBLE / (SUM(COUNT(*)) OVER ())::DOUBLE", 2)} AS pct
FROM events GROUP BY 1""")
def w8(spark, sf_dir):
    groups = grouped(table(spark, sf_dir, "events"), ["event_type"], {
        "n": row_count(), "avg_value": mean_of("value", 2)})
    return groups.withColumn("pct", share_pct(F.col("n"), total_over("n")))


# -- order -----------------------------------------------------------------------------------------


@query("o1_sort_two_keys", """
SELECT p_brand, p_size, p_partkey FROM part ORDER BY p_brand, p_size DESC, p_partkey""")
def o1(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_brand", "p_size", "p_partkey").orderBy(
        "p_brand", F.col("p_size").desc(), "p_partkey")


@query("o2_top_k", """
SELECT *, RANK() OVER (ORDER BY spend DESC) AS place FROM (
  SELECT o_custkey, SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT))::BIGINT AS spend
  FROM orders GROUP BY 1) ORDER BY spend DESC, o_custkey LIMIT 10""")
def o2(spark, sf_dir):
    spend = grouped(table(spark, sf_dir, "orders"), ["o_custkey"], {
        "spend": F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))})
    return top_ranked(spend, 10, ["spend"], "spend", "place", ["o_custkey"])


@query("o3_sort_and_number", f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY rmse NULLS LAST, model) AS place FROM (
  SELECT l_returnflag AS model, {half_up("SQRT(AVG((l_discount - l_tax) * (l_discount - l_tax)))", 6)}
    AS rmse FROM lineitem GROUP BY 1)""")
def o3(spark, sf_dir):
    gap = F.col("l_discount") - F.col("l_tax")
    scores = grouped(
        table(spark, sf_dir, "lineitem"), [F.col("l_returnflag").alias("model")],
        {"rmse": F.round(F.sqrt(F.avg(gap * gap)), 6)})
    return leaderboard(scores)
