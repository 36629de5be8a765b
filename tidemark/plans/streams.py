"""Streaming forms of batch queries; the oracle is the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.sources.tables import table
from tidemark.streaming import incremental as I  # noqa: E741


@query("""
SELECT epoch_us(ts) // 3600000000 * 3600 AS hour_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def stream_equals_batch(spark, d, files_per_batch=1000):
    """STR-01, STR-06: tumbling hours by Structured Streaming over the files, in any order of time, collected batch by batch."""
    schema = table(spark, d, "events").schema
    root = I.state_dir(spark)
    out = f"{root}/out"

    def each(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    totals = I.hourly_totals(I.file_stream(spark, f"{d}/events.parquet*", schema, files_per_batch), lateness=None)
    start = F.unix_seconds(F.col("w.start"))
    stream = totals.select(start.alias("hour_start"), "event_type", "n", F.round("total", 4).alias("total"))
    writer = stream.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    rows = spark.read.schema("hour_start long, event_type string, n long, total double, batch int").parquet(out)
    newest = rows.groupBy("hour_start", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("r"))
    return newest.select("hour_start", "event_type", "r.n", "r.total")


@query("""
SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_newest_wins(spark, d):
    """STR-03, STR-11: the newest row per key, kept up by a log of deltas that foreachBatch appends to."""
    from tidemark.operators.relational import latest_revision

    events = table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    root = I.state_dir(spark)
    log = I.DeltaLog(spark, f"{root}/log", events.schema, lambda rows: latest_revision(rows, ["user_id"], ["ts", "event_id"]))

    def each(batch, number):
        log.commit(log.folded(batch.select(*events.columns)), number)

    I.run_available(I.file_stream(spark, f"{d}/events.parquet*", table(spark, d, "events").schema), each, f"{root}/checkpoint")
    return log.folded(log.rows()).select("user_id", "event_id", "value")


@query("""
SELECT count(*) AS n, sum(o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total, max(o_orderkey) AS mark FROM orders""")
def two_lanes(spark, d):
    """STR-04, STR-05, STR-09, STR-10: orders published by a tail that follows the newest keys with an overlap, and by a history that walks down
    in segments; ranges are buffered and restored in order if a publication fails, as the second one does here."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    low, head = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    root = I.state_dir(spark)
    store, failed = I.PeriodStore(spark, f"{root}/store"), []
    step = max(1, (head - low) // 6)

    def publish(a, b):
        if not failed and a > low:
            failed.append((a, b))  # this range stays where it is, and the next call takes it again
            return False
        store.merge("all", orders.where(F.col("o_orderkey").between(a, b)), ["o_orderkey"])
        return True

    first = I.Lanes(spark, f"{root}/lanes", step, overlap=step // 10, floor=low)
    first.begin(low + (head - low) // 2)
    first.history(publish)
    lanes = I.Lanes(spark, f"{root}/lanes", step, overlap=step // 10, floor=low)  # a new driver goes on
    while lanes.state()[1] < head or lanes.state()[2]:
        lanes.tail(head, publish)
        lanes.history(publish)
    held = store.read("all")
    return held.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.lit(lanes.state()[1]).alias("mark"))


@query("""
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, max(event_id) AS newest FROM events GROUP BY event_type""")
def bounded_batches(spark, d, files=4):
    """STR-01, STR-02, STR-05: two sources, newest files first, in micro-batches of one file each, written exactly once: a repeated batch finds itself done."""
    from tidemark.operators.relational import latest_revision

    events = table(spark, d, "events").select("event_id", "event_type", "user_id")
    root = I.state_dir(spark)
    for k in (0, 1):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == k).repartition(files, "event_id").write.parquet(f"{root}/source-{k}")
    sources = [I.file_stream(spark, f"{root}/source-{k}", events.schema, files_per_batch=1, newest_first=True) for k in (0, 1)]
    log = I.DeltaLog(spark, f"{root}/log", events.schema, lambda rows: latest_revision(rows, ["event_id"], ["event_type", "user_id"]))

    def each(batch, number):
        log.commit(batch, number)
        log.commit(batch, number)  # as after a restart

    I.run_available(sources[0].unionByName(sources[1]), each, f"{root}/checkpoint")
    return log.rows().groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"), F.max("event_id").alias("newest"))
