"""Readers and writers: each query writes files of a form into the shared folder and reads them back."""

from __future__ import annotations

import io
import json
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.catalog import CompactionPolicy, Store, TableSpec
from tidemark.plans.registry import query
from tidemark.sources import tables as T
from tidemark.sources.tables import table
from tidemark.storage import Folder
from tidemark.streaming.incremental import state_dir

PART = "p_partkey long, p_name string, p_brand string, p_size long, p_retailprice double"
PARTS = "SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"


def _part(spark, d):
    kinds = StructType.fromDDL(PART)
    return table(spark, d, "part").select(*(F.col(f.name).cast(f.dataType) for f in kinds)), kinds


@query("""
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS part FROM customer""")
def scan_file_list(spark, d):
    """SCAN-01: an explicit list of files whose schemas differ, merged by name, with the file of each row."""
    root, c = state_dir(spark), table(spark, d, "customer")
    c.where("c_custkey % 2 = 1").select("c_custkey", "c_name").write.parquet(f"{root}/odd")
    c.where("c_custkey % 2 = 0").select("c_acctbal", "c_name", "c_custkey").write.parquet(f"{root}/even")
    kinds = c.select("c_custkey", "c_name", "c_acctbal").schema
    rows = T.parquet_files(spark, [f"{root}/odd", f"{root}/even"], kinds)
    return rows.select("c_custkey", "c_name", "c_acctbal", F.regexp_extract("file_path", "/(odd|even)/", 1).alias("part"))


@query("SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_nationkey DESC) - 1 AS file_row_number FROM nation")
def scan_row_numbers(spark, d):
    """SCAN-02: the physical row number in one file."""
    path = f"{state_dir(spark)}/nation"
    table(spark, d, "nation").orderBy(F.desc("n_nationkey")).coalesce(1).write.parquet(path)
    return T.numbered_rows(spark, path).select("n_nationkey", "n_name", "file_row_number")


@query(PARTS)
def scan_csv(spark, d):
    """SCAN-03, SINK-07: typed CSV with a header and quotes, verified when it was written."""
    rows, kinds = _part(spark, d)
    path = f"{state_dir(spark)}/part"
    T.verified_csv(rows, path)
    return T.csv(spark, path, kinds)


@query(PARTS)
def scan_csv_gzip(spark, d):
    """SCAN-04: gzip CSV without a header."""
    rows, kinds = _part(spark, d)
    path = f"{state_dir(spark)}/part"
    rows.write.option("compression", "gzip").csv(path)
    return T.csv(spark, path, kinds, header=False)


@query(PARTS)
def scan_csv_inferred(spark, d):
    """SCAN-05: CSV with inferred types."""
    rows, _ = _part(spark, d)
    path = f"{state_dir(spark)}/part"
    rows.write.option("header", True).csv(path)
    return T.csv(spark, path, None).withColumn("p_partkey", F.col("p_partkey").cast("long")).withColumn("p_size", F.col("p_size").cast("long"))


@query("SELECT n_nationkey, n_name FROM nation")
def scan_zipped_csv(spark, d):
    """SCAN-06: a zip that holds one CSV."""
    rows = table(spark, d, "nation").select(F.col("n_nationkey").cast("long"), "n_name")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("nation.csv", rows.toPandas().to_csv(index=False))
    return T.zipped_csv(spark, Folder(spark, state_dir(spark)).put("nation.zip", buffer.getvalue()), rows.schema)


def _lz4(text: str) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as out:
        out.write(text.encode())
    return sink.getvalue().to_pybytes()


@query("SELECT n_nationkey, n_name, 'csv' AS form FROM nation UNION ALL SELECT n_nationkey, n_name, 'json' FROM nation")
def scan_lz4(spark, d):
    """SCAN-07: CSV and JSON lines in lz4 frames."""
    rows = table(spark, d, "nation").select(F.col("n_nationkey").cast("long"), "n_name")
    folder, small = Folder(spark, state_dir(spark)), rows.collect()
    a = folder.put("nation.csv.lz4", _lz4("".join(f'{r[0]},"{r[1]}"\n' for r in small)))
    b = folder.put("nation.json.lz4", _lz4("\n".join(json.dumps({"n_name": r[1], "n_nationkey": r[0]}) for r in small)))
    both = T.lz4_csv(spark, a, rows.schema).withColumn("form", F.lit("csv"))
    return both.unionByName(T.lz4_json(spark, b, rows.schema).withColumn("form", F.lit("json")))


@query("SELECT n_nationkey, n_name FROM nation")
def scan_json_array(spark, d):
    """SCAN-08: a file that holds one JSON array."""
    rows = table(spark, d, "nation").select(F.col("n_nationkey").cast("long"), "n_name")
    path = Folder(spark, state_dir(spark)).put("nation.json", json.dumps([r.asDict() for r in rows.collect()]).encode())
    return T.json_array(spark, path, rows.schema)


@query("SELECT user_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM events GROUP BY user_id")
def scan_json_lines(spark, d):
    """SCAN-09: JSON lines with an array column."""
    rows = table(spark, d, "events").groupBy(F.col("user_id").cast("long").alias("user_id")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("event_type")).alias("types"))
    path = f"{state_dir(spark)}/users"
    rows.write.json(path)
    return T.ndjson(spark, path, StructType.fromDDL("user_id long, n long, types array<string>")).withColumn("types", F.array_join("types", ","))


@query("SELECT r_regionkey, r_name FROM region")
def scan_json_parameter(spark, d):
    """SCAN-10, SCAN-11: a JSON text as a relation, its rows typed by a definition."""
    rows = table(spark, d, "region").select(F.col("r_regionkey").cast("long"), "r_name")
    return T.json_rows(spark, json.dumps([r.asDict() for r in rows.collect()]), rows.schema)


@query("SELECT r_regionkey, r_name, CAST(NULL AS DOUBLE) AS score FROM region")
def scan_typed_empty(spark, d):
    """SCAN-12: a typed empty relation gives a union its columns."""
    rows = table(spark, d, "region").select("r_regionkey", "r_name")
    wide = StructType([*rows.schema.fields]).add("score", "double")
    return rows.unionByName(T.empty(spark, wide), allowMissingColumns=True)


@query("""
SELECT row_number() OVER () AS place, column_name AS name, CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS type
FROM (DESCRIBE SELECT o_orderstatus AS status, count(*) AS n, max(o_totalprice) AS top, bool_or(o_orderkey > 5) AS some FROM orders GROUP BY o_orderstatus)""")
def schema_probe(spark, d):
    """SCAN-18, SCAN-20: names and types of a query's columns, without running it."""
    table(spark, d, "orders").createOrReplaceTempView("orders")
    return T.probe(spark, "SELECT o_orderstatus AS status, count(*) AS n, max(o_totalprice) AS top, bool_or(o_orderkey > 5) AS some FROM orders GROUP BY o_orderstatus")


@query("SELECT 'customer' AS relation, column_name AS name FROM (DESCRIBE customer) UNION ALL SELECT 'supplier', column_name FROM (DESCRIBE supplier)")
def introspection(spark, d):
    """SCAN-16: relations of the session and their columns."""
    names = ("customer", "supplier")
    for name in names:
        table(spark, d, name).createOrReplaceTempView(name)
    rows = [(t, c.name) for t in names if spark.catalog.tableExists(t) for c in spark.catalog.listColumns(t)]
    return spark.createDataFrame(rows, "relation string, name string")


@query("SELECT version() IS NOT NULL AS has_version, current_setting('TimeZone') IS NOT NULL AS has_zone")
def engine_settings(spark, d):
    """FN-23: the engine's version and a setting."""
    return spark.range(1).select(F.lit(bool(spark.version)).alias("has_version"), F.lit(bool(spark.conf.get("spark.sql.session.timeZone"))).alias("has_zone"))


def _store(spark, d, name, frame, key, ranged, root=None):
    return Store(spark, root or f"{state_dir(spark)}/store", [TableSpec(name, frame.schema, key, ranged, blooms=key[:1])])


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def store_round_trip(spark, d):
    """SINK-01, SINK-02, SINK-06, SINK-13, SINK-14, STR-14, SCAN-19: published in batches by epoch, with pinned writers and checks, compacted
    while a reader holds a snapshot, cleared of garbage when it has ended, and read back by its newest revisions."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("long"), "o_custkey", "o_orderstatus", (F.col("o_orderkey") * 30).cast("long").alias("slot"))
    store = _store(spark, d, "orders", o, ("o_orderkey",), "slot")
    store.publish(1, {"orders": o.withColumn("o_orderstatus", F.lit("old"))})
    store.publish(2, {"orders": o.where("o_custkey % 2 = 0")})
    store.publish(3, {"orders": o.where("o_custkey % 2 = 1")})
    with store.lease() as seen:
        before = store.latest("orders", catalog=seen)
        store.compact("orders", CompactionPolicy(head_files=2))
        if store.collect_garbage() or before.count() != o.count():
            raise ValueError("files went while they were read")
    store.collect_garbage()
    if store.faults():
        raise ValueError(str(store.faults()))
    return store.latest("orders").drop("slot")


@query("SELECT count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders WHERE o_orderkey * 30 BETWEEN 432000 AND 1295999")
def store_pruned(spark, d):
    """SCAN-19, FILT-11: a query that the gate accepts reads only the files of two epochs."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("long"), (F.col("o_orderkey") * 30).cast("long").alias("slot"))
    store = _store(spark, d, "orders", o, ("o_orderkey",), "slot")
    store.publish(1, {"orders": o})
    low, high = 432_000, 1_295_999
    if {f.low // low for f in store.files("orders", low, high)} - {1, 2}:
        raise ValueError("files of other epochs are read")
    return store.query("select count(*) n, min(o_orderkey) low, max(o_orderkey) high from orders", low, high)


@query("SELECT c_nationkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey")
def two_stores(spark, d):
    """SCAN-14: tables of two stores, attached side by side."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_totalprice")
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("long"), "c_nationkey")
    a, b = _store(spark, d, "orders", o, ("o_orderkey",), "o_orderkey"), _store(spark, d, "customer", c, ("c_custkey",), "c_custkey")
    a.publish(1, {"orders": o})
    b.publish(1, {"customer": c})
    a.attach()
    b.attach()
    return spark.sql("select c_nationkey, count(*) orders, round(sum(o_totalprice), 2) total from orders join customer on o_custkey = c_custkey group by c_nationkey")


@query("""
SELECT epoch, count(*) AS n, bool_and(whole) AS sealed FROM (SELECT o_orderkey * 30 // 432000 AS epoch, (SELECT max(o_orderkey) * 30 // 432000 FROM orders) > o_orderkey * 30 // 432000 AS whole FROM orders)
GROUP BY epoch""")
def sealed_epochs(spark, d):
    """SINK-15, SINK-16, DQ-09, DQ-12: epochs sealed once by their facts; the first is offloaded and restored, and all files are as registered."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("long"), (F.col("o_orderkey") * 30).cast("long").alias("slot"))
    root = state_dir(spark)
    store = _store(spark, d, "orders", o, ("o_orderkey",), "slot", f"{root}/store")
    store.publish(1, {"orders": o})
    top = max(f.high for f in store.files("orders"))
    last = top // 432_000
    said = {e: store.seal(e, (last + 1) * 432_000, 1, [(0, last * 432_000 - 1)]) for e in range(last + 1)}
    first = min(f.low // 432_000 for f in store.files("orders"))
    again = store.seal(first, (last + 1) * 432_000, 1, [(0, last * 432_000 - 1)])
    if first < last:
        store.offload(first, f"{root}/far")
        store.restore(first)
        if again != "unchanged":
            raise ValueError(again)
    if store.faults():
        raise ValueError(str(store.faults()))
    seals = spark.createDataFrame([(e, s == "sealed") for e, s in said.items()], "epoch long, sealed boolean")
    counts = store.latest("orders").groupBy(F.expr("slot div 432000").alias("epoch")).agg(F.count("*").alias("n"))
    return counts.join(seals, "epoch").select("epoch", "n", "sealed")


@query("SELECT l_suppkey, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def sorted_files(spark, d):
    """SINK-03, SINK-04, SORT-03: files in a total order that ends in a sequence number which is not written, in bounded row groups at a high level of compression."""
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber").withColumn("_seq", F.monotonically_increasing_id())
    order = ["l_suppkey", "l_orderkey", "l_linenumber", "_seq"]
    path = f"{state_dir(spark)}/lines"
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": "16", "parquet.writer.version": "v1", "parquet.block.row.count.limit": "1000000"}
    rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_seq").write.options(**options).parquet(path)
    return spark.read.parquet(path).groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderpriority, o_orderkey) AS place FROM orders""")
def priority_order(spark, d):
    """SORT-06: an order by several criteria, newest first, then by name and key, numbered without one task."""
    from tidemark.operators.relational import numbered

    rows = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    return numbered(rows, [], [F.desc("day"), "o_orderpriority", "o_orderkey"], "place").select("o_orderkey", "place")


@query("""
SELECT event_type AS symbol, epoch_us(ts) // 3600000000 * 3600000 AS open_time_ms, count(*) AS trades, min(value) AS low, max(value) AS high, strftime(date_trunc('hour', ts), '%Y-%m-%d') AS day
FROM events GROUP BY ALL""")
def market_feed(spark, d):
    """DEC-15, SCAN-03: a feed of hourly bars, from files of its form to its typed table with the label of each row's period file."""
    from functools import reduce

    from tidemark.functions.scalar import epoch_hour
    from tidemark.sources import market_data as M

    bars = table(spark, d, "events").groupBy("event_type", (epoch_hour("ts") * 3_600_000).alias("open_time")).agg(F.count("*").alias("count"), F.min("value").alias("low"), F.max("value").alias("high"))
    root, kinds = state_dir(spark), StructType.fromDDL(M.KLINE.columns)
    bars.select("event_type", *(F.col(f.name).cast(f.dataType) if f.name in bars.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kinds)).write.partitionBy("event_type").option("header", True).csv(root)
    names = [r[0] for r in bars.select("event_type").distinct().collect()]  # a feed's symbols, a folder of files for each
    read = (M.read(spark, "binance_klines", f"{root}/event_type={n}", n) for n in names)
    return reduce(lambda a, b: a.unionByName(b), read).select("symbol", "open_time_ms", "trades", "low", "high", M.period_of("ts", "day").alias("day"))


@query("""
SELECT p_partkey, 'poly' || p_partkey AS token_id, p_retailprice AS price, CAST(1760000000 + p_partkey AS BIGINT) AS time_s, CAST(p_size AS BIGINT) AS outcome_index FROM part""")
def nested_feed(spark, d):
    """DEC-15, SCAN-08: nested answers as flat rows; entries without an id are left out."""
    from tidemark.sources import market_data as M

    entry = F.struct((F.lit(1760000000) + F.col("p_partkey")).cast("long").alias("t"), F.col("p_retailprice").alias("p"), F.concat(F.lit("poly"), "p_partkey").alias("token_id"), F.col("p_size").cast("long").alias("outcome_index"))
    lines = table(spark, d, "part").select("p_partkey", F.to_json(F.struct(F.struct(F.array(entry, entry.withField("token_id", F.lit(None).cast("string"))).alias("history")).alias("data"))).alias("answer"))
    kinds = StructType.fromDDL(M.FEEDS["polymarket_prices"].columns)
    answers = lines.select("p_partkey", F.from_json("answer", f"struct<data:struct<history:array<{kinds.simpleString()}>>>").alias("a"))
    flat = answers.select("p_partkey", F.explode(F.filter("a.data.history", lambda x: x["token_id"].isNotNull())).alias("x"))
    keyed = M.project(flat.select(F.to_json(F.struct("p_partkey")).alias("outcome"), *(F.col(f"x.{f.name}").alias(f.name) for f in kinds if f.name != "outcome")), M.FEEDS["polymarket_prices"])
    return keyed.select(F.get_json_object("outcome", "$.p_partkey").cast("long").alias("p_partkey"), "token_id", "price", "time_s", "outcome_index")


@query("""
SELECT label, count(*) AS n FROM (VALUES ('1-URGENT', 'first'), ('2-HIGH', 'first'), ('5-LOW', 'last')) v(priority, label) JOIN orders ON o_orderpriority = priority GROUP BY label""")
def inline_values(spark, d):
    """SCAN-13: values in a query as a relation."""
    table(spark, d, "orders").createOrReplaceTempView("valued_orders")
    return spark.sql("select label, count(*) n from values ('1-URGENT', 'first'), ('2-HIGH', 'first'), ('5-LOW', 'last') v(priority, label) join valued_orders on o_orderpriority = priority group by label")
