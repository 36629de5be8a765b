"""Set operations, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import relational as R
from tidemark.plans.registry import query
from tidemark.sources.tables import table

LINE = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


@query(f"""
WITH a AS (SELECT md5({LINE}) AS h FROM lineitem WHERE l_orderkey % 10 < 6), b AS (SELECT md5({LINE}) AS h FROM lineitem WHERE l_orderkey % 10 >= 4)
SELECT (SELECT count(*) FROM (SELECT h FROM a EXCEPT ALL SELECT h FROM b)) AS only_left, (SELECT count(*) FROM (SELECT h FROM b EXCEPT ALL SELECT h FROM a)) AS only_right""")
def multiset_diff(spark, d):
    """SET-03, SET-05, DQ-05: rows that two tables don't share, with repetition, from one aggregate."""
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey"), F.md5(F.expr(LINE)).alias("h"))
    a = rows.where("l_orderkey % 10 < 6").select("h", F.lit(1).alias("n"))
    b = rows.where("l_orderkey % 10 >= 4").select("h", F.lit(-1).alias("n"))
    balance = a.union(b).groupBy("h").agg(F.sum("n").alias("n"))
    side = lambda sign: F.coalesce(F.sum(F.when(F.col("n") * sign > 0, F.col("n") * sign)), F.lit(0))
    return balance.agg(side(1).alias("only_left"), side(-1).alias("only_right"))


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def set_except(spark, d):
    """SET-04."""
    o = table(spark, d, "orders")
    return o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).subtract(o.where("o_orderstatus = 'O'").select("o_custkey"))


@query("SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer WHERE c_acctbal < 0")
def union_distinct(spark, d):
    """SET-02."""
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).union(table(spark, d, "customer").where("c_acctbal < 0").select("c_nationkey")).distinct()


@query("""
WITH covered AS (SELECT epoch_us(ts) // 3600000000 AS h FROM events WHERE event_type = 'click'), excluded AS (SELECT epoch_us(ts) // 3600000000 AS h FROM events WHERE event_type = 'error')
SELECT h FROM covered INTERSECT SELECT h FROM excluded""")
def intersect_hours(spark, d):
    """SET-06: hours that are both covered and excluded."""
    hour = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 3600000000").alias("h")
    e = table(spark, d, "events")
    return e.where("event_type = 'click'").select(hour).intersect(e.where("event_type = 'error'").select(hour))


@query("SELECT n_nationkey AS key, n_name AS name, NULL::VARCHAR AS extra FROM nation UNION ALL BY NAME SELECT r_name AS name, r_regionkey AS key, 'region' AS extra FROM region")
def union_by_name(spark, d):
    """SET-01: tables of other shapes and column orders."""
    a = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    b = table(spark, d, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("key"), F.lit("region").alias("extra"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def topk_limit(spark, d):
    """SORT-01, SORT-04: a total order and its first rows."""
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("""
WITH m AS (SELECT p_brand, median(p_retailprice) AS mid FROM part GROUP BY p_brand)
SELECT p_brand, p_partkey, round(abs(p_retailprice - mid), 4) AS gap FROM part JOIN m USING (p_brand)
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY abs(p_retailprice - mid), p_partkey) <= 5""")
def nearest_k(spark, d):
    """SORT-05: the five rows nearest to their group's median; Spark keeps five per task before the shuffle."""
    part = table(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice")
    ranks = {"low": F.floor((F.col("n") + 1) / 2), "high": F.floor(F.col("n") / 2) + 1}
    middle = R.order_statistics(part, ["p_brand"], "p_retailprice", 0.5, ranks).select("p_brand", ((F.col("low") + F.col("high")) / 2).alias("mid"))
    gap = part.join(middle, "p_brand").withColumn("d", F.abs(F.col("p_retailprice") - F.col("mid")))
    return R.nearest(gap, ["p_brand"], F.col("d"), ["p_partkey"], 5).select("p_brand", "p_partkey", F.round("d", 4).alias("gap"))


@query("""
SELECT c_nationkey, arg_max(c_custkey, (n, -c_custkey)) AS pick, max(n) AS n FROM (SELECT c_nationkey, c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) GROUP BY c_nationkey""")
def representative_pick(spark, d):
    """SORT-08: the customer with most orders of each nation, ties to the smallest key."""
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey").join(n, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return rows.groupBy("c_nationkey").agg(F.max_by("c_custkey", F.struct("n", -F.col("c_custkey"))).alias("pick"), F.max("n").alias("n"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 250")
def offset_page(spark, d):
    """SORT-07, WIN-02: a page of a total order, without numbering all rows."""
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").offset(250).limit(100)


@query("""
SELECT event_id, k, row_number() OVER (ORDER BY k NULLS LAST, event_id) AS place FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS k FROM events)""")
def order_nulls_last(spark, d):
    """SORT-02: the place of every row in the order with nulls last."""
    k = F.when(F.col("event_type") != "error", F.col("user_id"))
    return R.numbered(table(spark, d, "events").select("event_id", k.alias("k")), [], [F.asc_nulls_last("k"), "event_id"], "place")


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(concat('42|', c_custkey)), c_custkey LIMIT 100")
def sample_deterministic(spark, d):
    """SCAN-15: a repeatable sample of a fixed number of rows, by hash order."""
    return table(spark, d, "customer").select("c_custkey", "c_name").orderBy(F.md5(F.concat(F.lit("42|"), F.col("c_custkey").cast("string"))), "c_custkey").limit(100)
