"""Revision semantics: newest rows, children of winners, compaction, upserts, change detection."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import epoch_hour
from tidemark.operators import relational as R
from tidemark.plans.registry import query
from tidemark.sources.tables import table


@query("""
WITH newest AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM newest GROUP BY event_type ORDER BY n DESC, event_type""")
def latest_revision(spark, d):
    """WIN-01, FILT-05: newest event of each user and type, counted by type."""
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    newest = R.latest_revision(events, ["user_id", "event_type"], ["ts", "event_id"])
    return newest.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).orderBy(F.desc("n"), "event_type")


@query("""
WITH win AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT o.o_custkey, o.o_orderkey, count(*) AS lines, round(sum(l_extendedprice), 2) AS amount
FROM lineitem l JOIN win o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey, o.o_orderkey""")
def latest_revision_parent_child(spark, d):
    """JOIN-02: lines are visible only under the winning order of their customer."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    winners = R.latest_revision(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    sums = lines.groupBy("o_orderkey").agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("amount"))
    return sums.join(winners.select("o_custkey", "o_orderkey"), "o_orderkey").select("o_custkey", "o_orderkey", "lines", "amount")


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""")
def revision_compaction(spark, d):
    """SINK-13: what a compaction keeps of overlapping files, the greatest revision per key."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    kept = R.latest_revision(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return kept.drop("l_extendedprice")


@query("""
WITH new AS (SELECT o_orderkey, o_custkey, round(o_totalprice * 2, 2) AS price, 'new' AS origin FROM orders WHERE o_orderkey % 3 = 0),
old AS (SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0),
both_ AS (SELECT *, 1 AS rank FROM new UNION ALL BY NAME SELECT *, 2 AS rank FROM old)
SELECT o_orderkey, o_custkey, price, origin, o_orderstatus FROM both_ QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY rank) = 1""")
def merge_upsert(spark, d):
    """SINK-05, SET-01: a new slice merged by key into an old one of another shape."""
    orders = table(spark, d, "orders")
    new = orders.where("o_orderkey % 3 = 0").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 2, 2).alias("price"), F.lit("new").alias("origin"))
    old = orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    return R.merge_upsert(new, old, ["o_orderkey"])


@query("""
SELECT user_id, epoch_us(ts) // 600000000 AS bucket, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 600000000 ORDER BY ts DESC, event_id DESC) = 1""")
def bucket_downsample(spark, d):
    """WIN-06: the newest event of each user in each ten minutes."""
    bucket = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 600000000")
    return R.last_in_window(table(spark, d, "events"), ["user_id"], bucket, ["ts", "event_id"], {"event_id": "event_id", "value": "value"})


@query("""
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events""")
def ffill_header(spark, d):
    """WIN-08: each event with the user's last purchase value so far."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    return R.forward_fill(events, ["user_id"], ["ts", "event_id"], value, "last_purchase").select("event_id", "user_id", "last_purchase")


@query("""
SELECT event_id, user_id, event_type FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before IS DISTINCT FROM event_type""")
def change_only(spark, d):
    """STR-12, FILT-02: events whose type differs from the user's previous one."""
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type").withColumn("before", before)
    return events.where(~F.col("before").eqNullSafe(F.col("event_type"))).select("event_id", "user_id", "event_type")


@query("""
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM events""")
def seq_within_key(spark, d):
    """WIN-09: events numbered from 0 within their user."""
    seq = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long") - 1
    return table(spark, d, "events").select("user_id", "event_id", seq.alias("seq"))


@query("""
WITH f AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT * FROM f ORDER BY l_orderkey, l_linenumber LIMIT 100""")
def dup_key_refusal(spark, d):
    """DQ-04, AGG-09, SORT-04: the first hundred keys that are not unique."""
    keys = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return keys.where("n > 1").orderBy("l_orderkey", "l_linenumber").limit(100)


@query("""
SELECT DISTINCT l_orderkey, l_linenumber, n FROM (
  SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def duplicate_count_window(spark, d):
    """WIN-05: keys with more than one row; the window count is an aggregate here, which combines before the shuffle."""
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("""
WITH known AS (SELECT user_id, event_type, arg_max(md5(props), (ts, event_id)) AS h, max(ts) AS at FROM events WHERE event_id % 2 = 0 GROUP BY ALL),
new AS (SELECT *, md5(props) AS h FROM events WHERE event_id % 2 = 1)
SELECT n.event_id, CASE WHEN k.h IS NULL THEN 'new' WHEN n.ts < k.at THEN 'older' WHEN n.h = k.h THEN 'unchanged' ELSE 'changed' END AS verdict
FROM new n LEFT JOIN known k ON n.user_id = k.user_id AND n.event_type = k.event_type""")
def change_detection(spark, d):
    """STR-03: incoming rows against the known revision of their key: new, older, unchanged or changed."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", F.md5("props").alias("h"))
    known = R.latest_revision(events.where("event_id % 2 = 0"), ["user_id", "event_type"], ["ts", "event_id"])
    known = known.select("user_id", "event_type", F.col("h").alias("known"), F.col("ts").alias("at"))
    rows = events.where("event_id % 2 = 1").join(known, ["user_id", "event_type"], "left")
    verdict = F.expr("case when known is null then 'new' when ts < at then 'older' when h = known then 'unchanged' else 'changed' end")
    return rows.select("event_id", verdict.alias("verdict"))


@query("""
SELECT coalesce(strftime(ts, '%Y-%m-%dT%H'), 'undated') AS hour_file, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS ts FROM events) GROUP BY ALL""")
def late_rows_route(spark, d):
    """STR-07: every row goes to the file of its own hour, rows without a time to 'undated'."""
    ts = F.when(F.col("event_id") % 97 != 0, F.col("ts"))
    label = F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH"), F.lit("undated"))
    return table(spark, d, "events").groupBy(label.alias("hour_file")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("""
WITH h AS (SELECT event_type, epoch_us(ts) // 3600000000 AS hour, count(*) AS n FROM events GROUP BY ALL),
mark AS (SELECT max(hour) AS w FROM h)
SELECT a.event_type, a.hour, a.n FROM h a, mark
WHERE a.hour + 3 <= w AND EXISTS (SELECT 1 FROM h b WHERE b.event_type = a.event_type AND b.hour = a.hour - 1)
  AND EXISTS (SELECT 1 FROM h c WHERE c.event_type = a.event_type AND c.hour = a.hour + 1)""")
def seal_gate(spark, d):
    """STR-08: an hour seals once both neighbours exist and the watermark is three hours on."""
    hours = table(spark, d, "events").groupBy("event_type", epoch_hour("ts").alias("hour")).agg(F.count("*").alias("n"))
    mark = hours.agg(F.max("hour").alias("w"))  # one row
    w = Window.partitionBy("event_type").orderBy("hour")
    near = hours.withColumns({"before": F.lag("hour").over(w), "after": F.lead("hour").over(w)})
    return near.join(F.broadcast(mark)).where("hour + 3 <= w and before = hour - 1 and after = hour + 1").select("event_type", "hour", "n")
