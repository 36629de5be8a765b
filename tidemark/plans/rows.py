"""Projections, predicates and scalar functions, and row decoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.plans.registry import query
from tidemark.sources.tables import table


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity > 0 AND l_tax > 0 THEN l_extendedprice / l_quantity / l_tax END AS ratio,
  coalesce(nullif(l_returnflag, 'N'), 'none') AS flag FROM lineitem""")
def case_ratio_guard(spark, d):
    """PROJ-04, FN-03, FN-04: guarded ratios and defaults."""
    ratio = F.when((F.col("l_quantity") > 0) & (F.col("l_tax") > 0), F.try_divide(F.try_divide("l_extendedprice", "l_quantity"), F.col("l_tax")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ratio.alias("ratio"), F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("N")), F.lit("none")).alias("flag"))


@query("""
SELECT event_id, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE)::VARCHAR AS day, strftime(ts, '%Y-%m-%dT%H') AS hour_label,
  epoch_us(make_timestamp(epoch_us(ts) // 1000000 * 1000000)) AS second_us, TRY_CAST(event_type AS BIGINT) AS not_a_number, CAST(value AS VARCHAR) IS NOT NULL AS has_value FROM events""")
def casts_dates(spark, d):
    """PROJ-05, FN-05, FN-06, FN-07, FN-22: casts that may fail, epochs, dates and labels."""
    us = S.epoch_micros("ts")
    return table(spark, d, "events").select(
        "event_id", us.alias("us"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 1000").alias("ms"), F.to_date("ts").cast("string").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH").alias("hour_label"),
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', date_trunc('second', ts))").alias("second_us"),
        F.col("event_type").try_cast("long").alias("not_a_number"), F.col("value").cast("string").isNotNull().alias("has_value"),
    )


@query("""
SELECT o_orderkey // 432 AS epoch, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi, -7 // 2 AS truncated FROM orders GROUP BY ALL""")
def int_div_epoch(spark, d):
    """FN-01, FN-02: partition numbers by integer division, which truncates."""
    return table(spark, d, "orders").groupBy(F.expr("o_orderkey div 432").alias("epoch")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), F.expr("cast(-7 div 2 as int)").alias("truncated")
    )


@query("""
WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '@' WHEN 1 THEN '#' WHEN 2 THEN 'xyz:' ELSE '' END || p_name AS coin FROM part)
SELECT p_partkey, coin, CASE WHEN starts_with(coin, '@') THEN 'spot' WHEN starts_with(coin, '#') THEN 'outcome' WHEN contains(coin, ':') THEN 'hip3' ELSE 'perp' END AS class,
  CASE WHEN contains(coin, ':') THEN split_part(coin, ':', 1) END AS builder, length(coin) AS n FROM n""")
def string_class(spark, d):
    """FN-10, FN-17, FILT-08: classes by prefix and content."""
    prefix = F.element_at(F.array(F.lit("@"), F.lit("#"), F.lit("xyz:"), F.lit("")), (F.col("p_partkey") % 4).cast("int") + 1)
    named = table(spark, d, "part").select("p_partkey", F.concat(prefix, "p_name").alias("coin"))
    return named.select("p_partkey", "coin", S.coin_class(F.col("coin")).alias("class"), S.builder(F.col("coin")).alias("builder"), F.length("coin").cast("long").alias("n"))


@query("""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, regexp_matches(url, '[0-9]') AS has_digit, regexp_extract(url, '([0-9]+)', 1) AS digits FROM pages""")
def regex_extract(spark, d):
    """FN-09."""
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.col("url").rlike("[0-9]").alias("has_digit"), F.regexp_extract("url", "([0-9]+)", 1).alias("digits"))


@query("""
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, props->>'$.missing' AS missing FROM events""")
def json_extract(spark, d):
    """FN-14: fields of a JSON text, by schema."""
    p = F.from_json("props", "k long, missing string")
    return table(spark, d, "events").select("event_id", p["k"].alias("k"), p["missing"].alias("missing"))


@query("""
SELECT vec_id, embedding[1]::DOUBLE AS first, round(list_sum(list_transform(embedding[1:20], lambda x: x::DOUBLE)), 4) AS top20,
  round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS norm2, len(embedding) AS n, list_contains(embedding, 0.0) AS has_zero FROM embeddings""")
def array_ops(spark, d):
    """FN-15, PROJ-06, PROJ-08: elements, slices, generated sums."""
    v = F.col("embedding").cast("array<double>")
    add = lambda a, x: a + x
    return table(spark, d, "embeddings").select(
        "vec_id", v[0].alias("first"), F.round(F.aggregate(F.slice(v, 1, 20), F.lit(0.0), add), 4).alias("top20"),
        F.round(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), add), 4).alias("norm2"), F.size(v).cast("long").alias("n"), F.array_contains(v, 0.0).alias("has_zero"),
    )


@query("""
SELECT l_orderkey, l_linenumber, sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag)) AS digest, md5(l_returnflag || l_linestatus) AS short FROM lineitem""")
def row_digest(spark, d):
    """FN-11: digests of explicit text, which every engine renders alike."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.sha2(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"), 256).alias("digest"), F.md5(F.concat("l_returnflag", "l_linestatus")).alias("short")
    )


@query("""
SELECT s_suppkey, base64(encode(s_name)) AS b64, lower(hex(encode(s_name))) AS hx, decode(from_base64(base64(encode(s_name)))) AS back FROM supplier""")
def binary_text(spark, d):
    """FN-13: base64 and hex."""
    raw = F.col("s_name").cast("binary")
    return table(spark, d, "supplier").select("s_suppkey", F.base64(raw).alias("b64"), F.lower(F.hex(raw)).alias("hx"), F.unbase64(F.base64(raw)).cast("string").alias("back"))


@query("""
SELECT event_id FROM events WHERE value IS NOT NULL AND NOT (event_id % 11 = 0 OR event_id % 13 = 0) AND NOT (epoch_us(ts) // 3600000000 % 24 >= 3 AND epoch_us(ts) // 3600000000 % 24 < 6) AND user_id BETWEEN 10 AND 500""")
def predicate_mix(spark, d):
    """FILT-01, FILT-06, FILT-07, FILT-09, FILT-10: comparisons, half-open windows, exclusion ranges, absent non-finite values."""
    from tidemark.operators.relational import finite_or_null, outside

    # 11ths play NaN and 13ths infinity: both make a row absent.
    bad = F.when(F.col("event_id") % 11 == 0, float("nan")).when(F.col("event_id") % 13 == 0, float("inf")).otherwise(F.col("value"))
    e = table(spark, d, "events").where(F.col("user_id").between(10, 500)).withColumn("x", bad)
    return e.where(finite_or_null("x") & F.col("value").isNotNull() & outside(S.epoch_hour("ts") % 24, [(3, 6)])).select("event_id")


@query("""
SELECT o_orderkey, o_custkey, round(o_totalprice * 100)::BIGINT AS cents, 'orders' AS lane, round(power(10, -2) * round(o_totalprice * 100), 2) AS price FROM orders""")
def rename_and_constants(spark, d):
    """PROJ-01, PROJ-02, PROJ-03, FN-18: columns renamed, dropped, added; a price from ticks."""
    o = table(spark, d, "orders").drop("o_orderdate", "o_orderstatus", "o_orderpriority").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    return o.select("o_orderkey", "o_custkey", "cents", F.lit("orders").alias("lane"), F.round(F.pow(F.lit(10.0), F.lit(-2)) * F.col("cents"), 2).alias("price"))


@query("""
WITH a AS (SELECT user_id, list(event_id ORDER BY event_id) AS ids, list(event_type ORDER BY event_id) AS types FROM events GROUP BY user_id)
SELECT user_id, unnest(ids) AS event_id, unnest(types) AS event_type, unnest(range(len(ids))) AS place FROM a""")
def zip_columns(spark, d):
    """DEC-14, JOIN-14, PROJ-07: column-oriented arrays back to rows, with their places."""
    e = F.array_sort(F.collect_list(F.struct("event_id", "event_type")))
    return table(spark, d, "events").groupBy("user_id").agg(e.alias("e")).select("user_id", F.posexplode("e").alias("place", "e")).select("user_id", "e.event_id", "e.event_type", F.col("place").cast("long").alias("place"))


@query("""
SELECT event_id, CASE WHEN contains(lower(event_type), 'err') THEN 'failure' WHEN contains(lower(event_type), 'purch') THEN 'money' WHEN contains(lower(event_type), 'i') THEN 'traffic' ELSE 'other' END AS class FROM events""")
def message_class(spark, d):
    """DQ-14: ordered rules, the first that matches."""
    return table(spark, d, "events").select("event_id", S.message_class(F.col("event_type"), [("err", "failure"), ("purch", "money"), ("i", "traffic")]).alias("class"))


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 AND event_id % 3 = 0 THEN (value + value * 2) / 2 WHEN event_id % 2 = 0 THEN value WHEN event_id % 3 = 0 THEN value * 2 END AS strike,
  CASE WHEN event_id % 5 = 0 THEN 1700000000 + event_id ELSE (1700000000000 + event_id) / 1000 END AS seconds FROM events""")
def market_fields(spark, d):
    """FN-08, FN-21: a strike from floor and cap, and times in seconds or milliseconds."""
    i = F.col("event_id")
    raw = F.when(i % 5 == 0, 1700000000 + i).otherwise(1700000000000 + i)
    return table(spark, d, "events").select(
        "event_id", S.strike(F.when(i % 2 == 0, F.col("value")), F.when(i % 3 == 0, F.col("value") * 2)).alias("strike"), S.seconds_of(raw).alias("seconds")
    )
