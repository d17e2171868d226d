"""Analyses that need more than one grouping or reading of their tables: distinct counts rolled up from one table of
bitmaps, states on every day of the calendar, distinct unions, comparison without case, bucketed catalog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators.aggs import ordered_list_in_slices
from tallyframe.operators.distinct import bitmap_counts, distinct_bitmaps, merged_bitmaps
from tallyframe.operators.joins import salted_full_outer_merge
from tallyframe.operators.states import state_calendar
from tallyframe.plans.delivery_queries import order_detail
from tallyframe.plans.dims import nation_dim
from tallyframe.plans.registry import query
from tallyframe.session import shared_folder
from tallyframe.sources.buckets import bucketed_database
from tallyframe.sources.tables import TableSet


@query("distinct_orders_rollup", oracle="""
WITH x AS (SELECT l_orderkey, s_nationkey, n_regionkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
           JOIN nation ON s_nationkey = n_nationkey)
SELECT CASE WHEN GROUPING(s_nationkey) = 0 THEN 'nation' WHEN GROUPING(n_regionkey) = 0 THEN 'region' ELSE 'all' END AS level,
       CASE WHEN GROUPING(s_nationkey) = 0 THEN s_nationkey WHEN GROUPING(n_regionkey) = 0 THEN n_regionkey END AS key,
       COUNT(DISTINCT l_orderkey) AS n_orders
FROM x GROUP BY GROUPING SETS ((s_nationkey), (n_regionkey), ())
""")
def distinct_orders_rollup(t):
    """Distinct orders by nation of the supplier, by region and in all: the lines are read once, into a stored table of
    bitmaps by nation, and each level is merged from it."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey").join(
        t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    folder = shared_folder(t.spark, "order-bitmaps")
    distinct_bitmaps(lines, "s_nationkey", "l_orderkey").write.mode("overwrite").parquet(folder)
    stored = t.spark.read.parquet(folder)
    regions = stored.join(nation_dim(t), F.col("s_nationkey") == F.col("n_nationkey"))
    levels = [("nation", stored, "s_nationkey"), ("region", merged_bitmaps(regions, "n_regionkey"), "n_regionkey"),
              ("all", merged_bitmaps(stored.withColumn("key", F.lit(None).cast("int")), "key"), "key")]
    out = None
    for level, bitmaps, key in levels:
        counts = bitmap_counts(bitmaps, key, "n_orders").select(F.lit(level).alias("level"), F.col(key).alias("key"), "n_orders")
        out = counts if out is None else out.unionByName(counts)
    return out


@query("state_by_day", oracle="""
WITH span AS (SELECT CAST(MIN(ts) AS DATE) AS a, CAST(MAX(ts) AS DATE) AS b FROM events),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
held AS (
  SELECT day, event_type, row_number() OVER (PARTITION BY day, user_id ORDER BY ts DESC, event_id DESC) AS back
  FROM days JOIN events ON ts < day + 1)
SELECT day, event_type, COUNT(*) AS n_users FROM held WHERE back = 1 GROUP BY day, event_type
""")
def state_by_day(t):
    """Users in each state at the end of every day of the log."""
    return state_calendar(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_type",
                          tie_cols=["event_id"], out_col="n_users")


@query("buyers_or_ordering_customers", oracle="""
SELECT user_id AS customer_id FROM events WHERE event_type = 'purchase'
UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def buyers_or_ordering_customers(t):
    """Everyone with a purchase event or a pending order, once: a distinct union.  Each side is reduced before it is dealt."""
    buyers = t.events.where(F.col("event_type") == "purchase").select(F.col("user_id").alias("customer_id"))
    pending = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("customer_id"))
    return buyers.unionByName(pending).distinct()


@query("part_names_any_case", oracle="""
WITH x AS (SELECT lower(p_name) AS name, p_retailprice FROM part WHERE p_name ILIKE '%ring%'),
y AS (SELECT lower(p_name) AS name, COUNT(*) AS n_economy FROM part WHERE p_type = 'ECONOMY' GROUP BY 1)
SELECT name, COUNT(*) AS n_parts, MAX(p_retailprice) AS top_price, ANY_VALUE(n_economy) AS n_economy
FROM x JOIN y USING (name) GROUP BY name
""")
def part_names_any_case(t):
    """Part names that hold a word in any case, grouped and joined without regard to case: the names come in three
    spellings, and the collated column compares, groups and joins them as one."""
    key = F.col("p_partkey")
    spelt = F.when(key % 3 == 0, F.upper("p_name")).when(key % 3 == 1, F.initcap("p_name")).otherwise(F.col("p_name"))
    parts = t.part.select(F.collate(spelt, "UTF8_LCASE").alias("name"), "p_retailprice", "p_type")
    grouped = parts.where(F.col("name").like("%RING%")).groupBy("name").agg(
        F.count("*").alias("n_parts"), F.max("p_retailprice").alias("top_price"))
    economy = parts.where(F.col("p_type") == "ECONOMY").groupBy("name").agg(F.count("*").alias("n_economy"))
    return grouped.join(economy, "name").withColumn("name", F.collate(F.lower("name"), "UTF8_BINARY"))


@query("customer_names_by_segment", oracle="""
SELECT c_mktsegment, string_agg(c_name, ', ' ORDER BY c_name) AS names FROM customer GROUP BY c_mktsegment
""")
def customer_names_by_segment(t):
    """All customers of a segment in one ordered list: few, very large groups, put together from slices."""
    return ordered_list_in_slices(t.customer.select("c_mktsegment", "c_name"), "c_mktsegment", "c_name", sep=", ", out_col="names", slices=32)


@query("views_beside_purchases", oracle="""
SELECT COALESCE(v.user_id, p.user_id) AS user_id, COUNT(*) AS n_rows, COUNT(DISTINCT v.event_id) AS n_views,
       COUNT(DISTINCT p.event_id) AS n_purchases, COUNT(*) FILTER (v.ts < p.ts) AS n_before
FROM (SELECT * FROM events WHERE event_type = 'view') v
FULL OUTER JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON v.user_id = p.user_id
GROUP BY 1
""")
def views_beside_purchases(t):
    """Every view beside every purchase of its user, users with only one kind included; busy users are split."""
    def kind(name: str, short: str):
        return t.events.where(F.col("event_type") == name).select("user_id", F.col("event_id").alias(f"{short}_id"), F.col("ts").alias(f"{short}_ts"))

    merged = salted_full_outer_merge(kind("view", "v"), kind("purchase", "p"), "user_id", hot_share=0.005)
    return merged.groupBy("user_id").agg(
        F.count("*").alias("n_rows"), F.count_distinct("v_id").alias("n_views"), F.count_distinct("p_id").alias("n_purchases"),
        F.count_if(F.col("v_ts") < F.col("p_ts")).alias("n_before"))


BUCKETS = 16


@query("order_detail_bucketed", oracle="""
SELECT l_orderkey, c_custkey, l_suppkey, o_orderdate, l_shipdate, l_quantity, l_extendedprice,
       CAST(floor(o_totalprice / 80000) AS INTEGER) AS rating
FROM lineitem, orders, customer
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_linestatus = 'F' AND o_orderstatus = 'F'
  AND floor(o_totalprice / 80000) IN (1, 2, 3, 4, 5)
""")
def order_detail_bucketed(t):
    """``order_detail`` on bucketed catalog tables, read by qualified name: lines, orders and ratings meet by order
    where they lie."""
    database = bucketed_database(t.spark, {
        "lineitem": (t.lineitem, "l_orderkey"), "orders": (t.orders, "o_orderkey"), "customer": (t.customer, None)}, BUCKETS)
    return order_detail(TableSet(t.spark, database=database))
