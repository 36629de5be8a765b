"""Aggregates and the hourly market features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import epoch_day, epoch_hour, epoch_micros
from tidemark.operators import market
from tidemark.operators import quality as Q
from tidemark.operators import relational as R
from tidemark.plans.registry import query
from tidemark.sources.tables import table


@query("""
SELECT event_type, epoch_us(ts) // 3600000000 AS hour, arg_max(value, (ts, event_id)) AS last_value,
       max({'t': ts, 'p': value})['p'] AS last_or_larger
FROM events GROUP BY ALL""")
def hourly_last_price(spark, d):
    """AGG-04, AGG-05, AGG-08: last value of each type and hour, by composite key and by struct maximum."""
    return table(spark, d, "events").groupBy("event_type", epoch_hour("ts").alias("hour")).agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("last_value"), F.max(F.struct("ts", "value"))["value"].alias("last_or_larger")
    )


@query("""
WITH e AS (SELECT event_type AS coin, epoch_us(ts) // 3600000000 AS hour, epoch_us(ts) // 60000000 AS minute, ts, event_id, value, user_id,
  event_type = 'purchase' AS buy FROM events WHERE value > 0),
h AS (SELECT coin, hour, count(*) AS n_trades, round(sum(value), 4) AS vol, round(coalesce(sum(value) FILTER (WHERE user_id % 2 = 0), 0), 4) AS buy,
  round(coalesce(sum(value) FILTER (WHERE user_id % 7 = 0), 0), 4) AS liq, arg_min(value, (ts, event_id)) AS first_px, arg_max(value, (ts, event_id)) AS last_px FROM e GROUP BY ALL),
m AS (SELECT coin, hour, minute, arg_max(value, (ts, event_id)) AS px FROM e GROUP BY ALL),
r AS (SELECT coin, hour, ln(px) - lag(ln(px)) OVER (PARTITION BY coin, hour ORDER BY minute) AS dr FROM m),
v AS (SELECT coin, hour, count(*) AS n_minutes, round(coalesce(sum(dr * dr), 0), 6) AS rv2 FROM r GROUP BY ALL)
SELECT * FROM h LEFT JOIN v USING (coin, hour)""")
def stage1_hourly(spark, d):
    """AGG-03, AGG-04, AGG-11, JOIN-04, WIN-04: hourly features; one pass by minute, one by hour."""
    e = table(spark, d, "events").where("value > 0")
    fills = e.select(
        F.col("event_type").alias("coin"), epoch_micros("ts").alias("t"), F.col("event_id").alias("tid"), F.col("value").alias("px"), F.lit(1.0).alias("sz"),
        (F.col("user_id") % 2 == 0).alias("buy"), (F.col("user_id") % 7 == 0).alias("liquidation"),
    )
    out = market.hourly_features(fills)
    return out.select("coin", "hour", "n_trades", *(F.round(c, 4).alias(c) for c in ("vol", "buy", "liq")), "first_px", "last_px", "n_minutes", F.round("rv2", 6).alias("rv2"))


@query("""
SELECT event_type, epoch_us(ts) // 3600000000 AS hour, count(*) AS n, min(value) AS low, max(value) AS high, round(sum(value), 4) AS total,
  arg_max(value, (ts, event_id)) AS last FROM events GROUP BY ALL""")
def partial_final_merge(spark, d):
    """AGG-10: partial aggregates per source (user bucket) merged into final ones."""
    source = F.col("user_id") % 16
    parts = table(spark, d, "events").groupBy(source.alias("source"), "event_type", epoch_hour("ts").alias("hour")).agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.sum("value").alias("total"), F.max(F.struct("ts", "event_id", "value")).alias("last")
    )
    return parts.groupBy("event_type", "hour").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.round(F.sum("total"), 4).alias("total"), F.max("last")["value"].alias("last")
    )


@query("""
SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END * l_extendedprice) / 2, 4) AS d_oi
FROM lineitem GROUP BY l_suppkey""")
def oi_delta(spark, d):
    """AGG-12: signed notional change, halved."""
    sign = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0)
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum(sign * F.col("l_extendedprice")) / 2, 4).alias("d_oi"))


@query("""
SELECT count(*) AS n, count(DISTINCT user_id) AS users, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean,
  count(*) FILTER (WHERE event_type = 'error') AS errors, round(sum(value) FILTER (WHERE event_type = 'purchase'), 2) AS purchases,
  count(DISTINCT user_id) FILTER (WHERE event_type = 'signup') AS signups FROM events""")
def global_aggregates(spark, d):
    """AGG-01, AGG-02, AGG-03: counts, extremes, distinct counts and filtered aggregates."""
    kind = F.col("event_type")
    return table(spark, d, "events").agg(
        F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.avg("value"), 6).alias("mean"),
        F.count(F.when(kind == "error", 1)).alias("errors"), F.round(F.sum(F.when(kind == "purchase", F.col("value"))), 2).alias("purchases"),
        F.countDistinct(F.when(kind == "signup", F.col("user_id"))).alias("signups"),
    )


@query("""
WITH h AS (SELECT event_type, epoch_us(ts) // 3600000000 AS hour, avg(value) AS p FROM events WHERE value > 0 GROUP BY ALL),
pairs AS (SELECT a.event_type AS x, b.event_type AS y, abs(ln(a.p / b.p)) AS gap FROM h a JOIN h b ON a.hour = b.hour AND a.event_type < b.event_type)
SELECT x, y, count(*) AS n_hours, round(median(gap), 6) AS mid,
  CASE WHEN count(*) < 24 THEN 'thin' WHEN median(gap) < 0.01 THEN 'map' ELSE 'divergence' END AS verdict FROM pairs GROUP BY x, y""")
def median_ratio_verdict(spark, d):
    """AGG-13, DQ-13, JOIN-14: do two price series track each other over their common hours?"""
    e = table(spark, d, "events").where("value > 0")
    prices = e.groupBy(F.col("event_type").alias("symbol"), epoch_hour("ts").alias("hour")).agg(F.avg("value").alias("price"))
    # The candidates: all pairs of the few symbols.
    names = F.transform(F.array_sort(F.collect_set("symbol")), lambda x: x)
    pairs = prices.agg(names.alias("s")).select(F.explode("s").alias("x"), "s").select("x", F.explode("s").alias("y")).where("x < y")
    out = market.tracking_verdict(prices, prices, pairs)
    return out.select("x", "y", "n_hours", F.round("mid", 6).alias("mid"), "verdict")


@query("""
SELECT p_brand, list_sort(list(p_retailprice))[count(*) // 2 + 1] AS upper_median FROM part GROUP BY p_brand""")
def upper_median(spark, d):
    """AGG-14: the element at n / 2, not the mean of two."""
    return R.order_statistics(table(spark, d, "part"), ["p_brand"], "p_retailprice", 0.5, {"upper_median": F.floor(F.col("n") / 2) + 1}).drop("n")


@query("""
SELECT user_id, min(epoch_us(ts)) FILTER (WHERE free) AS first_free, max(epoch_us(ts)) FILTER (WHERE free) AS last_free, count(*) FILTER (WHERE NOT free) AS held
FROM (SELECT *, NOT ((epoch_us(ts) // 3600000000) % 24 BETWEEN 2 AND 4 OR (epoch_us(ts) // 86400000000) % 7 = 3) AS free FROM events) GROUP BY user_id""")
def conditional_span(spark, d):
    """AGG-15, FILT-07: first and last time outside excluded hours and days."""
    hour, t = epoch_hour("ts") % 24, epoch_micros("ts")
    free = R.outside(hour, [(2, 5)]) & (epoch_day("ts") % 7 != 3)
    return table(spark, d, "events").groupBy("user_id").agg(
        F.min(F.when(free, t)).alias("first_free"), F.max(F.when(free, t)).alias("last_free"), F.count(F.when(~free, 1)).alias("held")
    )


@query("""
SELECT user_id, array_to_string(list(event_type ORDER BY ts, event_id)[1:5], '>') AS first_types,
  array_to_string(list(event_id ORDER BY event_id) FILTER (WHERE event_type = 'error'), ',') AS errors FROM events GROUP BY user_id""")
def ordered_list_slice(spark, d):
    """AGG-07, PROJ-08: ordered lists of a group, sliced and filtered; a user's list is bounded by the user's events."""
    errors = F.array_sort(F.collect_list(F.when(F.col("event_type") == "error", F.col("event_id"))))
    return table(spark, d, "events").groupBy("user_id").agg(
        F.array_join(F.slice(R.ordered_values("event_type", ["ts", "event_id"]), 1, 5), ">").alias("first_types"),
        F.when(F.count(F.when(F.col("event_type") == "error", 1)) > 0, F.array_join(errors, ",")).alias("errors"),
    )


@query("""
SELECT count(DISTINCT k) AS n FROM (SELECT o_custkey AS k FROM orders WHERE o_totalprice > 100000 UNION SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def distinct_union_count(spark, d):
    """AGG-19, SET-02: size of a union."""
    a = table(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("k"))
    b = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    return a.union(b).agg(F.countDistinct("k").alias("n"))


@query("""
SELECT p_type, count(*) AS decoded, count(*) FILTER (WHERE p_size > 25) AS undecoded,
  round(sum(p_retailprice) FILTER (WHERE p_size <= 25) / sum(p_retailprice), 6) AS coverage FROM part GROUP BY p_type""")
def coverage_by_program(spark, d):
    """AGG-20: counters and a weighted coverage per group."""
    p = table(spark, d, "part")
    small = F.sum(F.when(F.col("p_size") <= 25, F.col("p_retailprice")))
    return p.groupBy("p_type").agg(F.count("*").alias("decoded"), F.count(F.when(F.col("p_size") > 25, 1)).alias("undecoded"), F.round(small / F.sum("p_retailprice"), 6).alias("coverage"))


DIGEST_KINDS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_orderdate": "string", "cents": "bigint"}
_TAGGED = " || ".join(f"coalesce('{'I' if k == 'bigint' else 'T'}' || length({c}::VARCHAR) || ':' || {c}::VARCHAR, 'N')" for c, k in DIGEST_KINDS.items())
_SCHEMA = "6:orders" + f"{len(DIGEST_KINDS)}:" + "".join(f"{len(c)}:{c}{len(k)}:{k}" for c, k in DIGEST_KINDS.items())


@query(f"""
WITH src AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE)::VARCHAR AS o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
r AS (SELECT sha256('I' || length(o_orderkey::VARCHAR) || ':' || o_orderkey) AS k, sha256({_TAGGED}) AS h FROM src),
size AS (SELECT count(*) AS n, greatest(0, CAST(ceil(log2(count(*))) AS INT) - 10) AS bits FROM r),
leaves AS (SELECT ('0x' || substr(k, 1, 12))::BIGINT >> (48 - bits) AS leaf, sha256(string_agg(h, '' ORDER BY k)) AS h FROM r, size GROUP BY leaf),
root AS (SELECT CASE WHEN bits = 0 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY leaf)) END AS h FROM leaves, size GROUP BY bits)
SELECT n, sha256('{_SCHEMA}' || n || ':' || h) AS digest FROM size, root""")
def content_digest(spark, d):
    """AGG-17, FN-11: digest of schema and rows in the order of a tree over their keys, with one level above the leaves as in the SQL."""
    day, cents = F.to_date("o_orderdate").cast("string").alias("o_orderdate"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderstatus", day, cents)
    return Q.content_digest(rows, "orders", ["o_orderkey"])


@query("""
SELECT n_regionkey, any_value(r_name) AS region, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY n_regionkey""")
def any_of_group(spark, d):
    """AGG-06: any value of a group, here the one that its key determines."""
    joined = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("n_regionkey").agg(F.any_value("r_name").alias("region"), F.count("*").alias("nations"))


@query("""
SELECT DISTINCT event_type, CAST(ts AS DATE)::VARCHAR AS day FROM events""")
def distinct_rows(spark, d):
    """AGG-16: distinct rows and expressions."""
    return table(spark, d, "events").select("event_type", F.to_date("ts").cast("string").alias("day")).distinct()


@query("""
SELECT n_regionkey, n_nationkey, grouping(n_nationkey) AS g, count(*) AS n FROM nation GROUP BY ROLLUP (n_regionkey, n_nationkey)""")
def open_sql_rollup(spark, d):
    """Open SQL surface: grouping sets."""
    return table(spark, d, "nation").rollup("n_regionkey", "n_nationkey").agg(F.grouping("n_nationkey").cast("long").alias("g"), F.count("*").alias("n"))


@query("""
SELECT epoch_us(ts) // 3600000000 * 3600 AS hour_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_window(spark, d):
    """STR-06: tumbling hours."""
    w = F.window(F.col("ts"), "1 hour")
    out = table(spark, d, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', w.start)")
    return out.select(start.alias("hour_start"), "event_type", "n", "total")


@query("""
SELECT event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS day_no, ntile(4) OVER (PARTITION BY event_type ORDER BY value, event_id) AS quartile FROM events""")
def open_sql_ranks(spark, d):
    """Open SQL surface: rank functions.  A quartile over one of few types is made of its row number i among n, so that no task holds a type: of the
    four parts the first r = n % 4 hold q + 1 rows, the others q = n div 4."""
    rows = R.numbered(table(spark, d, "events"), ["event_type"], ["value", "event_id"], "i", "n")
    return rows.withColumn("q", F.expr("n div 4")).withColumn("r", F.col("n") % 4).select(
        "event_id",
        F.dense_rank().over(Window.partitionBy("user_id").orderBy(F.to_date("ts"))).cast("long").alias("day_no"),
        F.expr("case when i <= r * (q + 1) then (i - 1) div (q + 1) else r + (i - 1 - r * (q + 1)) div q end + 1").alias("quartile"),
    )
