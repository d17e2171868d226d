"""Analyses on dirty columns and unmatched keys: id lists, two kinds of missing
values, text that holds times, merges with rows on either side only, and
candidates that a validated append turns away."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.text import id_list, is_present
from tallyframe.operators.append import rejected, validate_candidates
from tallyframe.operators.joins import full_outer_merge, member_join
from tallyframe.plans.registry import query

ROUND = 6


@query("orders_per_type_from_id_lists", oracle="""
SELECT p.p_type, COUNT(*) AS n_members, COUNT(DISTINCT d.l_orderkey) AS n_orders
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) d JOIN part p ON p.p_partkey = d.l_partkey
GROUP BY p.p_type
""")
def orders_per_type_from_id_lists(t):
    """Orders per part type when an order holds its parts as one text of ids
    (with spaces and repeats), joined back to the parts by list membership."""
    lists = t.lineitem.groupBy("l_orderkey").agg(F.concat_ws(", ", F.collect_list("l_partkey")).alias("parts"))
    m = member_join(lists, "parts", t.part.select("p_partkey", "p_type"), "p_partkey")
    return m.groupBy("p_type").agg(F.count("*").alias("n_members"), F.countDistinct("l_orderkey").alias("n_orders"))


@query("ids_per_order_list", oracle="""
SELECT l_orderkey, COUNT(DISTINCT l_partkey) AS n_ids
FROM lineitem GROUP BY l_orderkey
""")
def ids_per_order_list(t):
    """Distinct ids in each order's id text, blanks removed."""
    lists = t.lineitem.groupBy("l_orderkey").agg(F.concat_ws(" ,", F.collect_list("l_partkey")).alias("parts"))
    return lists.select("l_orderkey", F.size(id_list("parts")).cast("long").alias("n_ids"))


@query("views_and_purchases_by_user_hour", oracle="""
SELECT COALESCE(v.user_id, p.user_id) AS user_id, COALESCE(v.hour, p.hour) AS hour, v.n_views, p.n_purchases
FROM (SELECT user_id, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS n_views
      FROM events WHERE event_type = 'view' GROUP BY ALL) v
FULL OUTER JOIN (SELECT user_id, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS n_purchases
                 FROM events WHERE event_type = 'purchase' GROUP BY ALL) p
  ON v.user_id = p.user_id AND v.hour = p.hour
""")
def views_and_purchases_by_user_hour(t):
    """Views beside purchases per user and hour; either side may be missing."""
    e = t.events.withColumn("hour", F.hour("ts"))

    def count_of(kind: str, name: str):
        return e.where(F.col("event_type") == kind).groupBy("user_id", "hour").agg(F.count("*").alias(name))

    return full_outer_merge(count_of("view", "n_views"), count_of("purchase", "n_purchases"), ["user_id", "hour"])


@query("present_flags", oracle="""
WITH f AS (SELECT l_linestatus, CASE l_returnflag WHEN 'N' THEN '' WHEN 'R' THEN 'R' END AS flag FROM lineitem)
SELECT l_linestatus, COUNT(*) FILTER (flag IS NOT NULL AND flag <> '') AS n_present,
       COUNT(*) FILTER (flag = '') AS n_blank, COUNT(*) FILTER (flag IS NULL) AS n_null
FROM f GROUP BY l_linestatus
""")
def present_flags(t):
    """Rows whose text is present, when NULL and '' both mean missing."""
    flag = F.when(F.col("l_returnflag") == "N", "").when(F.col("l_returnflag") == "R", "R")
    f = t.lineitem.select("l_linestatus", flag.alias("flag"))
    return f.groupBy("l_linestatus").agg(
        F.count_if(is_present("flag")).alias("n_present"), F.count_if(F.col("flag") == "").alias("n_blank"),
        F.count_if(F.col("flag").isNull()).alias("n_null"))


@query("times_from_text", oracle="""
WITH x AS (SELECT o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'soon' ELSE
                  strftime(o_orderdate, '%Y-%m-%d') || ' 18:15:34' END AS said FROM orders)
SELECT o_orderpriority, COUNT(TRY_CAST(said AS TIMESTAMP)) AS n_times, COUNT(*) AS n_rows,
       MIN(TRY_CAST(said AS TIMESTAMP)) AS first_time
FROM x GROUP BY o_orderpriority
""")
def times_from_text(t):
    """Text cast to timestamps; text that holds no time gives NULL."""
    said = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 18:15:34")))
    x = t.orders.select("o_orderpriority", said.try_cast("timestamp_ntz").alias("at"))
    return x.groupBy("o_orderpriority").agg(F.count("at").alias("n_times"), F.count("*").alias("n_rows"),
                                            F.min("at").alias("first_time"))


@query("text_extremes_per_brand", oracle="""
SELECT p_brand, MAX(CAST(p_size AS VARCHAR)) AS max_size_text, MIN(CAST(p_size AS VARCHAR)) AS min_size_text,
       MAX(p_name) AS last_name, MIN(p_name) AS first_name
FROM part GROUP BY p_brand
""")
def text_extremes_per_brand(t):
    """Largest and smallest values compared as text ('9' after '10')."""
    size = F.col("p_size").cast("string")
    return t.part.groupBy("p_brand").agg(F.max(size).alias("max_size_text"), F.min(size).alias("min_size_text"),
                                         F.max("p_name").alias("last_name"), F.min("p_name").alias("first_name"))


@query("rejected_ratings", oracle="""
SELECT c.order_id, c.rating,
       CASE WHEN o.o_orderkey IS NULL THEN 'unknown parent' WHEN o.o_orderstatus <> 'F' THEN 'parent not eligible'
            ELSE 'rating out of range' END AS reject_reason
FROM (SELECT o_orderkey + (o_orderkey % 3) * 1000000000 AS order_id, CAST(o_orderkey % 7 AS INTEGER) AS rating FROM orders) c
LEFT JOIN orders o ON o.o_orderkey = c.order_id
WHERE o.o_orderkey IS NULL OR o.o_orderstatus <> 'F' OR c.rating NOT BETWEEN 1 AND 5
""")
def rejected_ratings(t):
    """Candidate ratings that are turned away, with the reason: no such order,
    an order not delivered, a rating outside 1-5."""
    key = F.col("o_orderkey")
    candidates = t.orders.select((key + key % 3 * 1_000_000_000).alias("order_id"), (key % 7).cast("int").alias("rating"))
    parents = t.orders.select(key.alias("order_id"), "o_orderstatus")
    v = validate_candidates(candidates, parents, "order_id", F.col("o_orderstatus") == "F",
                            checks={"rating out of range": F.col("rating").between(1, 5)})
    return rejected(v).select("order_id", "rating", "reject_reason")
