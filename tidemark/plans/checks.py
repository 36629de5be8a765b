"""Data-quality composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import epoch_day, epoch_hour
from tidemark.operators import quality as Q
from tidemark.operators import relational as R
from tidemark.plans.registry import query
from tidemark.sources.tables import table


@query("""
WITH m AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 50 <> 7), h AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_orderkey % 50 <> 9 GROUP BY ALL)
SELECT (SELECT count(*) FROM m) AS expected, (SELECT count(*) FROM h) AS held, (SELECT count(*) FROM m WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.k = m.k)) AS missing,
 (SELECT count(*) FROM h WHERE NOT EXISTS (SELECT 1 FROM m WHERE h.k = m.k)) AS unlisted, (SELECT count(*) FROM h WHERE n > 1) AS repeated, false AS ok""")
def completeness_v1(spark, d):
    """DQ-01, JOIN-03, JOIN-07, DEC-17: manifest against held rows in one report row."""
    m = table(spark, d, "orders").where("o_orderkey % 50 <> 7").select(F.col("o_orderkey").alias("k"))
    h = table(spark, d, "lineitem").where("l_orderkey % 50 <> 9").select(F.col("l_orderkey").alias("k"))
    return Q.reconcile(m, h, ["k"])


@query("""
SELECT l_orderkey, count(*) AS n, count(l_linenumber) AS indexed, count(DISTINCT l_linenumber) AS distinct, count(*) FILTER (WHERE l_linenumber = 1) AS singles FROM lineitem
GROUP BY l_orderkey HAVING (count(*) > 1 AND (count(l_linenumber) <> count(*) OR count(DISTINCT l_linenumber) <> count(*) OR count(*) FILTER (WHERE l_linenumber = 1) > 0))
  OR (count(*) = 1 AND count(*) FILTER (WHERE l_linenumber = 1) <> 1)""")
def ordering_v6(spark, d):
    """DQ-02: orders whose line numbers are no proper order."""
    return Q.misordered(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", F.col("l_linenumber") == 1)


@query("""
WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 < 2), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 40 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 3 > 0)
SELECT (SELECT count(*) FROM a) AS listed, (SELECT count(*) FROM b) AS archived, (SELECT count(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = a.k)) AS only_listed,
  (SELECT count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.k = a.k)) AS only_archived, (SELECT count(*) FROM a JOIN b USING (k) WHERE a.s IS DISTINCT FROM b.s) AS moved,
  (SELECT min(a.k) FROM a JOIN b USING (k) WHERE a.s IS DISTINCT FROM b.s) AS first_moved""")
def manifest_compare(spark, d):
    """DQ-03, FILT-04, JOIN-15: what two listings don't share, and a sample, from one full join."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    a = o.where("k % 3 < 2").select("k", F.col("s").alias("a"), F.lit(True).alias("in_a"))
    b = o.where("k % 3 > 0").select("k", F.when(F.col("k") % 40 == 0, "X").otherwise(F.col("s")).alias("b"), F.lit(True).alias("in_b"))
    moved = F.col("in_a").isNotNull() & F.col("in_b").isNotNull() & ~F.col("a").eqNullSafe(F.col("b"))
    return a.join(b, "k", "full").agg(
        F.count("in_a").alias("listed"), F.count("in_b").alias("archived"), F.count(F.when(F.col("in_b").isNull(), 1)).alias("only_listed"),
        F.count(F.when(F.col("in_a").isNull(), 1)).alias("only_archived"), F.count(F.when(moved, 1)).alias("moved"), F.min(F.when(moved, F.col("k"))).alias("first_moved"),
    )


@query("""
WITH days AS (SELECT DISTINCT user_id, epoch_us(ts) // 86400000000 AS lo FROM events), r AS (SELECT user_id, lo, lo + user_id % 3 AS hi FROM days),
b AS (SELECT *, max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r)
SELECT user_id, count(*) AS ranges, count(*) FILTER (WHERE lo <= before) AS overlaps, count(*) FILTER (WHERE lo > before + 1) AS gaps FROM b GROUP BY user_id""")
def gaps_overlaps(spark, d):
    """DQ-06, WIN-03: overlaps and gaps between consecutive ranges of a user."""
    days = table(spark, d, "events").select("user_id", epoch_day("ts").alias("lo")).distinct()
    return Q.gaps_and_overlaps(days.withColumn("hi", F.col("lo") + F.col("user_id") % 3), ["user_id"], "lo", "hi")


@query("""
WITH days AS (SELECT DISTINCT user_id, epoch_us(ts) // 86400000000 AS lo FROM events), r AS (SELECT user_id, lo, lo + user_id % 3 AS hi FROM days),
f AS (SELECT *, CASE WHEN lo > max(hi) OVER w + 1 OR max(hi) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM r WINDOW w AS (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT user_id, min(lo) AS lo, max(hi) AS hi FROM i GROUP BY user_id, island""")
def interval_union(spark, d):
    """AGG-18: overlapping or adjacent ranges become one."""
    days = table(spark, d, "events").select("user_id", epoch_day("ts").alias("lo")).distinct()
    return R.merge_intervals(days.withColumn("hi", F.col("lo") + F.col("user_id") % 3), ["user_id"], "lo", "hi")


@query("""
SELECT epoch_us(ts) // 86400000000 AS day, count(*) AS n, CASE WHEN count(*) FILTER (WHERE event_type = 'error') >= 40 THEN 'critical' WHEN count(*) FILTER (WHERE event_type = 'error') >= 10 THEN 'warn' ELSE 'ok' END AS grade
FROM events GROUP BY ALL""")
def health_grade(spark, d):
    """DQ-11: thresholds over daily counts."""
    days = table(spark, d, "events").groupBy(epoch_day("ts").alias("day")).agg(F.count("*").alias("n"), F.count(F.when(F.col("event_type") == "error", 1)).alias("errors"))
    return days.select("day", "n", Q.grade(F.col("errors"), 10, 40).alias("grade"))


@query("""
WITH held AS (SELECT DISTINCT user_id, month(ts)::BIGINT AS m FROM events), b AS (SELECT user_id, min(m) AS lo, max(m) AS hi FROM held GROUP BY user_id)
SELECT user_id, p AS m, CASE WHEN p < lo THEN 'leading' WHEN p > hi THEN 'trailing' ELSE 'interior' END AS position FROM b, (SELECT unnest(range(1, 13)) AS p)
WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.user_id = b.user_id AND held.m = p)""")
def hole_classify(spark, d):
    """DQ-10: absent months of a user, before, between or after the held ones."""
    held = table(spark, d, "events").select("user_id", F.month("ts").cast("long").alias("m")).distinct()
    return Q.classify_holes(held, ["user_id"], "m", 1, 12).withColumn("m", F.col("m").cast("long"))


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'F') AS misplaced, count(DISTINCT l_suppkey) AS files,
  count(*) FILTER (WHERE year(l_shipdate) < 1995 AND l_linestatus = 'O') AS wrong_date FROM lineitem GROUP BY ALL""")
def count_tallies(spark, d):
    """DQ-08: tallies and misplacement counts."""
    late = (F.year("l_shipdate") < 1995) & (F.col("l_linestatus") == "O")
    wrong = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.count(F.when(wrong, 1)).alias("misplaced"), F.countDistinct("l_suppkey").alias("files"), F.count(F.when(late, 1)).alias("wrong_date")
    )


@query("""
WITH mark AS (SELECT max(epoch_us(ts) // 3600000000) AS w FROM events)
SELECT event_type, count(DISTINCT epoch_us(ts) // 3600000000) FILTER (WHERE epoch_us(ts) // 3600000000 > w - 48 AND user_id % 5 <> 0) AS batches,
  max(epoch_us(ts) // 3600000000) < w - 1 AS behind FROM events, mark GROUP BY event_type, w""")
def batches_behind(spark, d):
    """DQ-15: distinct batches in a trailing window, and who is behind the newest."""
    e = table(spark, d, "events").select("event_type", "user_id", epoch_hour("ts").alias("hour"))
    mark = e.agg(F.max("hour").alias("w"))
    recent = (F.col("hour") > F.col("w") - 48) & (F.col("user_id") % 5 != 0)
    return e.join(F.broadcast(mark)).groupBy("event_type", "w").agg(F.countDistinct(F.when(recent, F.col("hour"))).alias("batches"), (F.max("hour") < F.col("w") - 1).alias("behind")).drop("w")


@query("""
SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day, count(*) AS n FROM orders GROUP BY ALL HAVING bool_and(o_orderstatus <> 'P' AND o_totalprice > 1000 AND o_totalprice < 450000)""")
def sealable_days(spark, d):
    """DQ-17: days all of whose rows are final and inside the bounds."""
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate").cast("string"))
    return Q.sealable_days(o, "day", F.col("o_orderstatus") != "P", (F.col("o_totalprice") > 1000) & (F.col("o_totalprice") < 450000))


@query("""
WITH old AS (SELECT user_id, event_type AS reason, min(epoch_us(ts)) AS detected_at FROM events WHERE event_type = 'error' GROUP BY ALL),
new AS (SELECT user_id, event_type AS reason, min(epoch_us(ts)) + 5 AS detected_at FROM events WHERE user_id % 2 = 0 AND event_type IN ('error', 'view') GROUP BY ALL)
SELECT user_id, reason, min(detected_at) AS detected_at FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY ALL""")
def quarantine_merge(spark, d):
    """DQ-16: ledger entries merged, the first detection kept."""
    t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    e = table(spark, d, "events").select("user_id", F.col("event_type").alias("reason"), t.alias("t"))
    old = e.where("reason = 'error'").groupBy("user_id", "reason").agg(F.min("t").alias("detected_at"))
    new = e.where("user_id % 2 = 0 and reason in ('error', 'view')").groupBy("user_id", "reason").agg((F.min("t") + 5).alias("detected_at"))
    return Q.merge_quarantine(old, new, ["user_id", "reason"], "detected_at")


@query("""
SELECT count(*) AS unproven FROM (SELECT o_orderkey, md5(concat_ws('|', o_custkey, o_orderstatus)) FROM orders
  EXCEPT SELECT o_orderkey, md5(concat_ws('|', o_custkey, o_orderstatus)) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A'))""")
def archive_proof(spark, d):
    """DQ-07, SET-04: rows without an equal archived copy; the archive holds the orders with a line of flag A.  Hashes, not payloads, are shuffled."""
    rows = table(spark, d, "orders").select("o_orderkey", F.md5(F.concat_ws("|", "o_custkey", "o_orderstatus")).alias("h"))
    flagged = table(spark, d, "lineitem").where("l_returnflag = 'A'").select("l_orderkey")
    archive = rows.join(flagged, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return rows.join(archive, ["o_orderkey", "h"], "left_anti").distinct().agg(F.count("*").alias("unproven"))


@query("""
WITH u AS (SELECT o_orderkey, max(l_shipdate) AS shipped FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT o.o_orderkey, CASE WHEN u.shipped IS NOT NULL AND o.o_orderstatus IS DISTINCT FROM 'R' THEN 'R' ELSE o.o_orderstatus END AS status FROM orders o LEFT JOIN u USING (o_orderkey)
WHERE NOT (o.o_orderkey BETWEEN 100 AND 200)""")
def update_and_trim(spark, d):
    """SINK-08, SINK-09, SINK-10: an update from a join where values differ, and a range deleted."""
    back = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("back", F.lit(True))
    orders = table(spark, d, "orders").where("not (o_orderkey between 100 and 200)").select("o_orderkey", "o_orderstatus")
    new = F.when(F.col("back") & ~F.col("o_orderstatus").eqNullSafe(F.lit("R")), "R").otherwise(F.col("o_orderstatus"))
    return orders.join(back, "o_orderkey", "left").select("o_orderkey", new.alias("status"))


@query("""
WITH held AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 0), incoming AS (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem)
SELECT o_orderkey, 'held' AS origin FROM held UNION ALL SELECT o_orderkey, 'new' FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.o_orderkey = i.o_orderkey AND h.o_orderkey BETWEEN (SELECT min(o_orderkey) FROM incoming) AND (SELECT max(o_orderkey) FROM incoming))""")
def insert_unseen(spark, d):
    """SINK-11: an insert of unseen keys, with the known side cut to the window of the incoming one."""
    held = table(spark, d, "orders").where("o_orderkey % 4 = 0").select("o_orderkey")
    incoming = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    low, high = table(spark, d, "lineitem").agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    window = held.where(F.col("o_orderkey").between(low, high)) if low is not None else held
    new = incoming.join(window, "o_orderkey", "left_anti")
    return held.withColumn("origin", F.lit("held")).unionByName(new.withColumn("origin", F.lit("new")))


@query("""
SELECT user_id, array_to_string(list_sort(CASE WHEN list_contains(t, 'view') THEN t ELSE list_append(t, 'view') END), ',') AS types
FROM (SELECT user_id, list(DISTINCT event_type) AS t FROM events GROUP BY user_id)""")
def append_if_absent(spark, d):
    """SINK-12, FN-15: an element added to an array that lacks it."""
    types = F.array_union(F.collect_set("event_type"), F.array(F.lit("view")))
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(types), ",").alias("types"))
