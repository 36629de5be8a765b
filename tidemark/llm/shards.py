"""Sharding by global byte-size prefix sums, with SQL functions only.

Rows are range-partitioned by id.  Each partition's total and each row's running sum inside its
partition give the global prefix sum of every row without one task seeing all rows; the sums are cut
at equal byte targets, so shards are contiguous in id order and of near equal size.

Cases: a null text has no bytes (size 1, crc32 of no bytes: 0); empty texts likewise; rows with equal
or null ids are ordered by crc32 and size, nulls first, and equal rows in any order; a row larger than a shard's
target stays whole, and a shard may then be empty; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table

SHARDS = 8
LEAST_ROWS, MOST_ROWS = 20_000, 2_000_000  # of about 32 bytes, in a range partition


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sized = cut(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            # Only to deal equal ids over several partitions.
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    rows = sized.count()
    order = ["doc_id", "text_crc32", "size", "row"]
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-rows // LEAST_ROWS), max(usual, -(-rows // MOST_ROWS))))
    dealt = cut(sized.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    # One row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut(
        totals.select(
            "part",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("part_bytes").over(Window.partitionBy()).alias("total"),
        ),
        "partition-totals",
    )
    inside = Window.partitionBy("part").orderBy(*order)
    running = dealt.select(
        "doc_id", "size", "text_crc32", "part",
        F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bytes_in"),
        (F.row_number().over(inside) - 1).cast("long").alias("rows_in"),
    )
    totals = F.broadcast(totals) if parts <= 1_000_000 else totals
    # The shard in which the row's middle byte falls.
    shard = F.expr(f"cast(least((2 * (bytes_before + bytes_in) + size) * {shards} div (2 * total), {shards - 1}) as int)")
    placed = cut(
        running.join(totals, "part").select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("rows_in")).alias("place")),
        "places",
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by the law of near equal bytes."""
    out = assign(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_sql() -> str:
    """The same in DuckDB SQL, which has no crc32: it is built from its definition, bit by bit, over a table of 256 values."""
    return f"""
WITH RECURSIVE step(i, n, c) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, n + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END FROM step WHERE n < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE n = 8),
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents
),
summed AS (
  SELECT doc_id, size,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, [('0x' || h[2 * i + 1 : 2 * i + 2])::UBIGINT FOR i IN range(size - 1)]),
             lambda a, b: xor(a // 256, t[(xor(a % 256, b) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM sized, crc
),
placed AS (
  SELECT *, sum(size) OVER w - size AS bytes_before, row_number() OVER w - 1 AS place, sum(size) OVER () AS total
  FROM summed WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
),
cut AS (SELECT *, least((2 * bytes_before + size) * {SHARDS} // (2 * total), {SHARDS - 1})::INT AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard
FROM cut"""
