"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import epoch_day, epoch_micros
from tidemark.operators import relational as R
from tidemark.plans.registry import query
from tidemark.sources.tables import table

DAY_US = 86_400_000_000


@query("""
SELECT n_name, r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name""")
def dimension_joins(spark, d):
    """JOIN-01, JOIN-03, JOIN-04: inner and left equi-joins; the sums come before the joins."""
    sums = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    out = sums.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select("n_name", "r_name", "customers", "balance")


@query("""
WITH b AS (SELECT i, DATE '1992-01-01' + (i * 7)::INT AS lo, DATE '1992-01-01' + (i * 7 + 6)::INT AS hi FROM range(0, 600) t(i))
SELECT b.i AS batch, count(o_orderkey) AS stored, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM b LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN b.lo AND b.hi GROUP BY b.i""")
def range_join_counts(spark, d):
    """JOIN-05, DQ-06: orders counted in weekly batches, as a bucketed equi-join."""
    base = "datediff(to_date(o_orderdate), date'1992-01-01')"
    days = table(spark, d, "orders").select(F.expr(base).cast("long").alias("day"), "o_orderkey", "o_totalprice")
    batches = spark.range(600).select(F.col("id").alias("batch"), (F.col("id") * 7).alias("lo"), (F.col("id") * 7 + 6).alias("hi"))
    pairs = R.range_join(days, batches, "day", "lo", "hi", 7, how="left")
    return pairs.groupBy("batch").agg(F.count("o_orderkey").alias("stored"), F.round(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)), 2).alias("total"))


@query("""
WITH w AS (SELECT p_partkey * 10 AS lo, p_partkey * 10 + 5 AS hi FROM part WHERE p_size > 40)
SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM w WHERE o.o_orderkey BETWEEN w.lo AND w.hi)""")
def semi_range(spark, d):
    """JOIN-06, FILT-04: orders inside any published range."""
    ranges = table(spark, d, "part").where("p_size > 40").select((F.col("p_partkey") * 10).alias("lo"), (F.col("p_partkey") * 10 + 5).alias("hi"))
    ranges = ranges.withColumn("one", F.lit(0))
    merged = ranges.groupBy("lo", "hi").agg(F.first("one").alias("one"))
    return R.range_join(table(spark, d, "orders").select("o_orderkey"), merged, "o_orderkey", "lo", "hi", 10).select("o_orderkey").distinct()


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti_join(spark, d):
    """JOIN-07: customers without large orders."""
    large = table(spark, d, "orders").where("o_totalprice > 300000").select("o_custkey")
    return table(spark, d, "customer").join(large, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_orderstatus IN ('F', 'P')")
def not_in(spark, d):
    """FILT-03: IN of literals, NOT IN of a subquery over keys without nulls."""
    building = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    orders = table(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "P"))
    return orders.join(building, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("""
SELECT a.o_custkey, count(*) AS moved FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority AND a.o_orderstatus <> b.o_orderstatus
GROUP BY a.o_custkey""")
def join_inequality(spark, d):
    """JOIN-08: equal keys with an unequal residual; counted per status first, so pairs are never listed."""
    per = table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    total = per.groupBy("o_custkey", "o_orderpriority").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"))
    out = total.groupBy("o_custkey").agg(F.sum(F.col("all") * F.col("all") - F.col("same")).alias("moved"))
    return out.where("moved > 0")


@query("""
WITH days AS (SELECT DISTINCT epoch_us(ts) // 86400000000 AS day FROM events), users AS (SELECT DISTINCT user_id FROM events),
last AS (SELECT user_id, epoch_us(ts) // 86400000000 AS day, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY ALL)
SELECT user_id, day, value, event_type FROM users CROSS JOIN days LEFT JOIN last USING (user_id, day)""")
def snapshot_asof(spark, d):
    """JOIN-09, WIN-07: the last event of each user in each day, on a grid of users and the few days."""
    events = table(spark, d, "events")
    days = events.select(epoch_day("ts").alias("day")).distinct().agg(F.collect_set("day").alias("days"))
    grid = events.select("user_id").distinct().join(F.broadcast(days)).select("user_id", F.explode("days").alias("day"))
    last = R.last_in_window(events, ["user_id"], epoch_day("ts"), ["ts", "event_id"], {"value": "value", "event_type": "event_type"})
    return grid.join(last.withColumnRenamed("bucket", "day"), ["user_id", "day"], "left")


@query("""
WITH s AS (SELECT user_id, epoch_us(ts) // 86400000000 AS day, count(*) AS n FROM events GROUP BY ALL)
SELECT a.user_id, a.day, a.n, a.n - b.n AS change FROM s a LEFT JOIN s b ON a.user_id = b.user_id AND b.day = a.day - 1""")
def prev_bucket_delta(spark, d):
    """JOIN-10: change against the day before; a gap gives null."""
    days = table(spark, d, "events").groupBy("user_id", epoch_day("ts").alias("day")).agg(F.count("*").alias("n"))
    return R.previous_bucket(days, ["user_id"], "day", 1, "n", "change")


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) AS t, event_id, value, event_type FROM events),
r AS (SELECT user_id, t, max(value) AS v FROM e WHERE event_type = 'purchase' GROUP BY ALL),
a AS (SELECT l.event_id, l.t, r.t AS rt, r.v FROM (SELECT * FROM e WHERE event_type = 'click') l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.t > r.t),
m AS (SELECT list_sort(list(value))[count(*) // 2 + 1] AS mid FROM e WHERE event_type = 'purchase')
SELECT event_id, coalesce(CASE WHEN rt >= t - 7 * 86400000000 THEN v END, mid) AS centre FROM a, m""")
def causal_lookup(spark, d):
    """JOIN-12: the user's latest purchase before each click, at most seven days old, else the upper median."""
    events = table(spark, d, "events").select("user_id", epoch_micros("ts").alias("t"), "event_id", "value", "event_type")
    bought = events.where("event_type = 'purchase'")
    last = bought.groupBy("user_id", "t").agg(F.max("value").alias("v"))
    # Strictly before: at the same instant the click sorts first.
    found = R.latest_before(events.where("event_type = 'click'").select("user_id", "t", "event_id"), last, ["user_id"], "t", "t", "v", 7 * DAY_US, "held")
    above = R.order_statistics(bought, [], "value", 0.5, {"mid": F.floor(F.col("n") / 2) + 1}).select("mid")  # one row
    return found.join(F.broadcast(above)).select("event_id", F.coalesce("held", "mid").alias("centre"))


@query("""
WITH s(lo, version) AS (VALUES (0, 'v1'), (1000, 'v2'), (30000, 'v3')), x AS (SELECT o_orderkey FROM orders)
SELECT version, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM x ASOF JOIN s ON x.o_orderkey >= s.lo GROUP BY version""")
def version_asof(spark, d):
    """JOIN-13: the newest schedule entry at or below each key; a short schedule becomes one expression."""
    schedule = [(0, "v1"), (1000, "v2"), (30000, "v3")]
    version = F.lit(None).cast("string")
    for low, name in schedule:
        version = F.when(F.col("o_orderkey") >= low, name).otherwise(version)
    out = table(spark, d, "orders").select("o_orderkey", version.alias("version")).where("version is not null")
    return out.groupBy("version").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("""
WITH dim AS (SELECT p_brand, min(p_partkey) AS asset_id FROM part GROUP BY p_brand), f AS (SELECT p_brand, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT p_brand, asset_id, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM f LEFT JOIN dim USING (p_brand) GROUP BY ALL""")
def fan_out_guard(spark, d):
    """JOIN-11: a join to an aggregated dimension, which cannot multiply rows."""
    part = table(spark, d, "part")
    dim = part.groupBy("p_brand").agg(F.min("p_partkey").alias("asset_id"))
    lines = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    sums = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.sum("n").alias("n"), F.round(F.sum("qty"), 2).alias("qty"))
    return sums.join(dim, "p_brand", "left").select("p_brand", "asset_id", "n", "qty")


@query("""
WITH seed(c_name, target) AS (VALUES ('Customer#000000001', 'ALPHA'), ('Customer#000000005', 'BETA')),
base AS (SELECT s_name, upper(s_name) AS target FROM supplier)
SELECT c.c_name, coalesce(seed.target, base.target) AS target, CASE WHEN seed.target IS NOT NULL THEN 'seeded' WHEN base.target IS NOT NULL THEN 'name' ELSE 'none' END AS how
FROM customer c LEFT JOIN seed USING (c_name) LEFT JOIN base ON replace(c.c_name, 'Customer', 'Supplier') = base.s_name""")
def name_candidate_join(spark, d):
    """JOIN-16: a seeded mapping first, then equal base names."""
    seed = F.broadcast(spark.createDataFrame([("Customer#000000001", "ALPHA"), ("Customer#000000005", "BETA")], "c_name string, seeded string"))
    base = table(spark, d, "supplier").select("s_name", F.upper("s_name").alias("named"))
    rows = table(spark, d, "customer").select("c_name").join(seed, "c_name", "left").withColumn("s_name", F.expr("replace(c_name, 'Customer', 'Supplier')"))
    how = F.when(F.col("seeded").isNotNull(), "seeded").when(F.col("named").isNotNull(), "name").otherwise("none")
    return rows.join(base, "s_name", "left").select("c_name", F.coalesce("seeded", "named").alias("target"), how.alias("how"))


@query("""
SELECT o_orderkey, o_totalprice, (SELECT round(sum(l_extendedprice), 2) FROM lineitem WHERE l_orderkey = o_orderkey) AS stored,
  (SELECT count(*) FROM customer) AS customers FROM orders WHERE o_orderstatus = 'P'""")
def lateral_scalar(spark, d):
    """JOIN-15: correlated and uncorrelated scalar subqueries."""
    sums = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("stored"))
    n = table(spark, d, "customer").agg(F.count("*").alias("customers"))
    orders = table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice")
    return orders.join(sums, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(F.broadcast(n)).select("o_orderkey", "o_totalprice", "stored", "customers")


@query("""
WITH t AS (SELECT DISTINCT l_orderkey AS tx, l_linenumber AS pos, l_suppkey AS mint, l_returnflag AS side FROM lineitem),
p AS (SELECT a.tx, a.mint AS sold, b.mint AS bought FROM t a JOIN t b ON a.tx = b.tx AND a.pos < b.pos AND a.side = 'A' AND b.side = 'R' AND a.mint <> b.mint)
SELECT tx, CASE WHEN count(*) = 1 THEN 'swap' ELSE 'unresolved' END AS verdict, CASE WHEN count(*) = 1 THEN min(sold) END AS sold, CASE WHEN count(*) = 1 THEN min(bought) END AS bought
FROM p GROUP BY tx""")
def swap_inference(spark, d):
    """DEC-08: ordered pairs of transfers within a transaction that read as a trade; exactly one, or unresolved.  A transaction has few transfers."""
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("pos"), F.col("l_suppkey").alias("mint"), F.col("l_returnflag").alias("side"))
    gave = t.where("side = 'A'").select("tx", F.col("pos").alias("p"), F.col("mint").alias("sold")).distinct()
    got = t.where("side = 'R'").select("tx", F.col("pos").alias("q"), F.col("mint").alias("bought")).distinct()
    pairs = gave.join(got, "tx").where("p < q and sold <> bought")
    one = F.count("*") == 1
    return pairs.groupBy("tx").agg(F.when(one, "swap").otherwise("unresolved").alias("verdict"), F.when(one, F.min("sold")).alias("sold"), F.when(one, F.min("bought")).alias("bought"))


@query("""
SELECT coalesce(c_nationkey, s_nationkey) AS nation, c.n AS customers, s.n AS suppliers FROM (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY ALL) c
FULL JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL) s ON c_nationkey = s_nationkey""")
def open_sql_full_join(spark, d):
    """Open SQL surface: a full outer join."""
    c = table(spark, d, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    s = table(spark, d, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    return c.join(s, "nation", "full")
