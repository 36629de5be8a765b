"""Decoders over payloads that are built from table rows, so that the SQL can say what must come out; and functions."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import decode, scalar, swaps, venues
from tidemark.functions.idl import EVENT_TAG, discriminator
from tidemark.operators import decoded
from tidemark.plans.registry import query
from tidemark.sources.tables import table


def _key(n: int) -> bytes:
    return struct.pack(">Q", n).rjust(32, b"\x01")


def _built(df, columns, kind, of):
    """df with the column made, of(...) of the columns."""
    names = df.columns
    spark_kind = {pa.binary(): "binary", pa.string(): "string"}.get(kind) or kind

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [of(*v) for v in zip(*(batch.column(names.index(c)).to_pylist() for c in columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*names, "made"])

    return df.mapInArrow(each, StructType([*df.schema.fields, *StructType.fromDDL(f"made {spark_kind}").fields]))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE 'legacy' END AS version, CAST(1 + o_custkey % 2 AS INTEGER) AS signers, CAST(o_custkey % 5 + 2 AS BIGINT) AS n_keys, CAST(o_custkey % 4 AS BIGINT) AS steps,
  o_custkey % 7 = 0 AS broken FROM orders WHERE o_custkey % 7 <> 0
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, true FROM orders WHERE o_custkey % 7 = 0""")
def parsed_wires(spark, d):
    """DEC-01, DEC-02: transaction envelopes, some cut short, and their resolved accounts."""
    import base64

    def wire(order: int, customer: int) -> str:
        signers, keys, steps = 1 + customer % 2, customer % 5 + 2, customer % 4
        raw = bytes([signers]) + b"\x09" * 64 * signers + (b"\x80" if order % 3 == 0 else b"") + bytes([signers, 0, 1, keys]) + b"".join(_key(i) for i in range(keys)) + b"\7" * 32
        raw += bytes([steps]) + b"".join(bytes([1, 2, 0, 1, 3]) + b"abc" for _ in range(steps)) + (b"\0" if order % 3 == 0 else b"")
        return base64.b64encode(raw[:-1] if customer % 7 == 0 else raw).decode()

    rows = _built(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], pa.string(), wire)
    got = decode.parse_transactions(rows, "made", keep=("o_orderkey",))
    all_keys = decode.resolve_accounts(F.col("keys"), F.array().cast("array<string>"), F.lit(None).cast("array<string>"))
    size = lambda c: F.when(F.col("error").isNull(), F.size(c).cast("long"))
    return got.select("o_orderkey", "version", "signers", size(all_keys).alias("n_keys"), size(F.col("instructions")).alias("steps"), F.col("error").isNotNull().alias("broken"))


@query("""
SELECT o_orderkey, CAST(o_custkey % 5 AS VARCHAR) || '.0,' || o_custkey % 5 || '.0.0,' || o_custkey % 5 || '.0.1,' || o_custkey % 5 || '.1' AS paths FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 2 = 1""")
def call_paths(spark, d):
    """DEC-03: paths from stack heights, by an expression; heights that skip a level give null."""
    rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 5).alias("top"), F.when(F.col("o_orderkey") % 2 == 0, F.array(*map(F.lit, (2, 3, 3, 2)))).otherwise(F.array(F.lit(2), F.lit(4))).alias("heights"))
    return rows.select("o_orderkey", F.array_join(venues.call_paths("top", "heights"), ",").alias("paths"))


@query("""
SELECT l_orderkey || '-' || l_suppkey AS signature, CASE WHEN l_returnflag = 'R' THEN 'orphan.7.0' ELSE '1.0' END AS path, CASE WHEN l_returnflag = 'R' OR l_linestatus = 'F' THEN 'unknown' ELSE 'stack_height' END AS attribution,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END AS logs, count(*) AS n FROM lineitem GROUP BY ALL""")
def grouped_logs(spark, d):
    """DEC-04: log instructions grouped below the instruction that they belong to, or alone."""
    rows = table(spark, d, "lineitem").withColumn("id", F.monotonically_increasing_id()).select("id", F.concat_ws("-", "l_orderkey", "l_suppkey").alias("signature"), "l_returnflag", "l_linestatus")
    tag = F.unhex(F.lit(decoded.LOG_TAGS[0]))
    step = lambda i, path, data, sure: F.struct(F.lit(i).alias("ord"), F.lit(path).alias("path"), data.alias("data"), sure.alias("attribution"))
    sure, unsure = F.lit("stack_height"), F.when(F.col("l_linestatus") == "F", "unknown").otherwise("stack_height")
    calls = F.array(step(0, "1.0", F.unhex(F.lit("00")), sure), step(1, "1.0.0", tag, unsure), step(2, "1.0.1", F.concat(tag, F.unhex(F.lit("FF"))), sure))
    alone = F.array(step(0, "7.0", tag, sure))
    steps = rows.select("id", "signature", F.explode(F.when(F.col("l_returnflag") == "R", alone).otherwise(calls)).alias("s")).select("id", "signature", F.lit(decoded.PROGRAM).alias("program"), "s.*")
    got = decoded.grouped_logs(steps, key="id").join(rows.select("id", "signature"), "id")
    return got.groupBy("signature", "path", "attribution", F.size("logs").alias("logs")).agg(F.count("*").alias("n"))


def _groups(spark, d):
    """Orders as transactions of one group each: a header, a fill, an order, and what was not read for some."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("signature"), F.md5(F.col("o_orderkey").cast("string")).alias("source_hash"), F.col("o_orderkey").cast("long").alias("slot"), F.lit(1).alias("tx_index"), F.lit(False).alias("single_in_slot"),
        F.lit(None).cast("long").alias("block_time"), F.when(F.col("o_custkey") % 3 == 0, F.lit(json.dumps({"err": {"Custom": 1}}))).otherwise(F.lit(json.dumps({"err": None}))).alias("meta_json"), F.lit(None).cast("string").alias("terminal_error"),
        F.lit(None).cast("string").alias("err"), "o_custkey", "o_orderkey",
    )
    header = F.concat(F.lit('{"Header":{"asset_id":'), (F.col("o_custkey") % 11).cast("string"), F.lit(',"tick_size":100,"trader_account":null}}'))
    fill = F.concat(F.lit('{"OrderFilled":{"side":"Bid","price":7'), F.col("o_orderkey").cast("string"), F.lit("000000000000000000"), F.lit(',"base_lots_filled":7}}'))
    placed = F.concat(F.lit('{"OrderPlaced":{"asset_id":99,"quantity":-'), F.col("o_custkey").cast("string"), F.lit(',"client_order_id":[1,255],"reason":{"Code":[1]}}}'))
    none = F.lit(None).cast("string")
    result = lambda event, error: F.struct(event.alias("event"), error.alias("error"), F.unhex(F.lit("AB")).alias("bytes"))
    bad = F.when(F.col("o_custkey") % 7 == 0, F.lit("short"))
    results = F.array(result(header, none), result(fill, bad), result(placed, none))
    unsure = F.when(F.col("o_custkey") % 5 == 0, "unknown").otherwise("stack_height")
    groups = o.select("signature", F.lit("1.0").alias("path"), unsure.alias("attribution"), results.alias("results"))
    return o, decoded.decoded_groups(groups)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS signature, CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE 3 END AS events, CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 0 END AS errors,
  CASE WHEN o_custkey % 7 <> 0 THEN '{"OrderFilled":{"side":"Bid","price":"7' || o_orderkey || '000000000000000000","base_lots_filled":"7"}}' END AS fill FROM orders""")
def decoded_groups(spark, d):
    """DEC-05: a group gives events with exact numbers, or errors, never both."""
    _, groups = _groups(spark, d)
    return groups.select("signature", F.size("events").alias("events"), F.size("errors").alias("errors"), F.get("events", F.lit(1)).alias("fill"))


@query("""
WITH t AS (SELECT *, o_custkey % 3 <> 0 AS committed, o_custkey % 7 = 0 AS bad, o_custkey % 5 <> 0 AS sure FROM orders)
SELECT 'events' AS part, o_orderkey || '/1.0/' || i AS id, CAST(CASE WHEN i = 2 THEN 99 ELSE o_custkey % 11 END AS VARCHAR) AS asset, '100' AS tick, CASE i WHEN 0 THEN 'Header' WHEN 1 THEN 'OrderFilled' ELSE 'OrderPlaced' END AS what FROM t, range(3) r(i) WHERE NOT bad
UNION ALL SELECT 'fills', o_orderkey || '/1.0/1', CAST(o_custkey % 11 AS VARCHAR), '100', 'Ask7' || o_orderkey || '000000000000000000' FROM t WHERE NOT bad AND committed AND sure
UNION ALL SELECT 'order_events', o_orderkey || '/1.0/2', '99', '100', '01ff-' || o_custkey FROM t WHERE NOT bad AND committed AND sure
UNION ALL SELECT 'decode_errors', o_orderkey || '/1.0/0', NULL, NULL, 'short' FROM t WHERE bad
UNION ALL SELECT 'decoded_transactions', CAST(o_orderkey AS VARCHAR), CASE WHEN bad THEN '0' ELSE '3' END, CASE WHEN committed THEN 'true' ELSE 'false' END, CASE WHEN bad THEN 'quarantined' WHEN NOT sure THEN 'unattributed' ELSE 'decoded' END FROM t""")
def normalised_tables(spark, d):
    """DEC-06: the typed tables of decoded groups, side by side."""
    tx, groups = _groups(spark, d)
    t = decoded.normalised(tx, groups, "v1", "2025-01-01", "orders")
    pick = lambda name, *columns: t[name].select(F.lit(name).alias("part"), *(c.alias(n) for c, n in zip(columns, ("id", "asset", "tick", "what"), strict=True)))
    c, none = F.col, F.lit(None).cast("string")
    out = pick("events", c("event_id"), c("asset_id"), c("tick_size"), c("event_type"))
    out = out.unionByName(pick("fills", c("event_id"), c("asset_id"), c("tick_size"), F.concat("taker_side", "price_ticks")))
    out = out.unionByName(pick("order_events", c("event_id"), c("asset_id"), c("tick_size"), F.concat("client_order_id", "quantity_signed")))
    out = out.unionByName(pick("decode_errors", c("error_id"), none, none, c("error")))
    return out.unionByName(pick("decoded_transactions", c("signature"), c("event_count").cast("string"), c("committed").cast("string"), c("status")))


def _signed(n: int) -> str:
    return scalar.base58_encode(_key(n))


@query("""
SELECT o_orderkey, 'orca_whirlpool' AS program, 'swap' AS kind, o_custkey % 2 = 0 AS a_to_b, CAST(o_custkey AS BIGINT) AS amount_in, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_out, CAST(30 AS BIGINT) AS fee FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'humidifi', 'swap', o_custkey % 2 = 0, CAST(o_custkey AS BIGINT), CAST(round(o_totalprice * 100) AS BIGINT), NULL FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, 'raydium_amm', 'swap', o_custkey % 2 = 0, CAST(o_custkey AS BIGINT), CAST(round(o_totalprice * 100) AS BIGINT), NULL FROM orders WHERE o_orderkey % 3 = 2""")
def decoded_swaps(spark, d):
    """DEC-07, DEC-08: trades of an event that an instruction carries, of token transfers, and of a log line in a form of its own."""
    import base64

    ids = {p.name: p.id for p in swaps.PROGRAMS}
    pool, mints, vaults, mine, me = _signed(9), [_signed(1), _signed(2)], [_signed(3), _signed(4)], [_signed(5), _signed(6)], _signed(7)
    names = [me, pool, *mints, *vaults, *mine, ids["orca_whirlpool"], ids["humidifi"], ids["raydium_amm"], swaps.TOKENS[0]]
    at = {k: i for i, k in enumerate(names)}

    def transaction(order: int, customer: int, cents: int) -> dict:
        down = customer % 2 == 0
        step = lambda program, accounts, data, depth: {"program": at[program], "accounts": [at[a] for a in accounts], "data": data, "depth": depth, "top": 0}
        logs: list[str] = []
        if order % 3 == 0:
            event = discriminator("event", "Traded") + _key(9) + bytes([down]) + bytes(16) + (1 << 64).to_bytes(16, "little") + struct.pack("<6Q", customer, cents, 0, 0, 10, 20)
            steps = [step(ids["orca_whirlpool"], [me, pool], discriminator("global", "swap"), 1), step(ids["orca_whirlpool"], [], EVENT_TAG + event, 2)]
        elif order % 3 == 1:
            paid, got = (0, 1) if down else (1, 0)
            move = lambda a, b, who, n: step(swaps.TOKENS[0], [a, b, who], b"\x03" + struct.pack("<Q", n), 2)
            steps = [step(ids["humidifi"], [me, pool], b"\x01", 1), move(vaults[got], mine[got], pool, cents), move(mine[paid], vaults[paid], me, customer)]
        else:
            log = b"\x03" + struct.pack("<7Q", customer, 0, 2 if down else 1, 0, 5, 6, cents)
            steps = [step(ids["raydium_amm"], [me, pool, me, *vaults], b"\x10", 1)]
            logs = [f"Program {ids['raydium_amm']} invoke [1]", "Program log: ray_log: " + base64.b64encode(log).decode(), f"Program {ids['raydium_amm']} success"]
        held = [(v, m, pool) for v, m in zip(vaults, mints, strict=True)] + [(v, m, me) for v, m in zip(mine, mints, strict=True)]
        return {"keys": names, "signers": 1, "instructions": steps, "logs": logs, "balances": [{"account": at[a], "mint": m, "owner": o, "before": None} for a, m, o in held]}

    step = pa.struct([("program", pa.int32()), ("accounts", pa.list_(pa.int32())), ("data", pa.binary()), ("depth", pa.int32()), ("top", pa.int32())])
    balance = pa.struct([("account", pa.int32()), ("mint", pa.string()), ("owner", pa.string()), ("before", pa.int64())])
    kind = pa.struct([("keys", pa.list_(pa.string())), ("signers", pa.int32()), ("instructions", pa.list_(step)), ("logs", pa.list_(pa.string())), ("balances", pa.list_(balance))])
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [transaction(*v) for v in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, kind)], names=["o_orderkey", "t"])

    made = "struct<keys:array<string>,signers:int,instructions:array<struct<program:int,accounts:array<int>,data:binary,depth:int,top:int>>,logs:array<string>,balances:array<struct<account:int,mint:string,owner:string,before:bigint>>>"
    schema = StructType([orders.schema["o_orderkey"], *StructType.fromDDL(f"t {made}").fields])
    rows = orders.mapInArrow(each, schema).select("o_orderkey", "t.*")
    got = swaps.decode_swaps(rows, keep=("o_orderkey",)).where("kind <> 'frame'")
    return got.select("o_orderkey", "program", "kind", "a_to_b", *(F.col(c).cast("long").alias(c) for c in ("amount_in", "amount_out", "fee")))


IDL_TEXT = json.dumps({
    "instructions": [{"name": "placeOrder"}],
    "events": [{"name": "Filled", "fields": [{"name": "order", "type": "u64"}, {"name": "price", "type": {"option": "i128"}}, {"name": "side", "type": {"defined": "Side"}}, {"name": "owner", "type": "publicKey"}]}],
    "types": [{"name": "Side", "type": {"kind": "enum", "variants": [{"name": "Bid"}, {"name": "Ask", "fields": [{"name": "lots", "type": "u32"}]}]}}],
})


@query("""
SELECT o_orderkey, 'instruction' AS kind, 'placeOrder' AS name, NULL AS fields, NULL AS decode_error FROM orders
UNION ALL SELECT o_orderkey, 'event', 'Filled', CASE WHEN o_custkey % 4 <> 3 THEN '{"order":"' || o_orderkey || '","price":' || CASE WHEN o_custkey % 2 = 0 THEN 'null' ELSE '"-' || o_custkey || '"' END || ',"side":'
  || CASE WHEN o_custkey % 2 = 0 THEN '"Bid"' ELSE '{"Ask":{"lots":7}}' END || ',"owner":"11111111111111111111111111111111"}' END, CASE WHEN o_custkey % 4 = 3 THEN '1 trailing bytes' END FROM orders""")
def venue_rows(spark, d):
    """DEC-09, DEC-10, DEC-16: instructions and events of a venue, from log lines, read by its description; one in four has a byte too much."""
    import base64

    program = "Venue111111111111111111111111111111111111111"

    def log(order: int, customer: int) -> str:
        price = b"\0" if customer % 2 == 0 else b"\1" + (-customer).to_bytes(16, "little", signed=True)
        side = b"\0" if customer % 2 == 0 else b"\1" + struct.pack("<I", 7)
        return base64.b64encode(discriminator("event", "Filled") + struct.pack("<Q", order) + price + side + bytes(32) + b"x" * (customer % 4 == 3)).decode()

    rows = _built(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], pa.string(), log)
    start = F.unhex(F.lit(discriminator("global", "place_order").hex()))
    steps = F.array(F.struct(F.lit(program).alias("program"), F.lit("0").alias("path"), F.array(F.lit("a")).alias("accounts"), start.alias("data")), F.struct(F.lit("Other").alias("program"), F.lit("1").alias("path"), F.array(F.lit("a")).alias("accounts"), start.alias("data")))
    logs = F.array(F.lit("Program Other invoke [1]"), F.concat(F.lit("Program data: "), "made"), F.lit(f"Program {program} invoke [2]"), F.concat(F.lit("Program data: "), "made"), F.lit(f"Program {program} success"), F.lit("Program Other success"))
    got = venues.venue_rows(rows.select("o_orderkey", steps.alias("steps"), logs.alias("logs")), program, [IDL_TEXT], keep=("o_orderkey",))
    return got.select("o_orderkey", "kind", "name", "fields", "decode_error")


@query("""
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS price, CAST(-2 AS INTEGER) AS exponent, round(o_custkey * 0.01, 6) AS price_f, CASE WHEN o_orderkey % 2 = 0 THEN 'Full' ELSE 'Partial(5)' END AS verification, NULL AS error FROM orders WHERE o_custkey % 9 <> 0
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, 'not a price account' FROM orders WHERE o_custkey % 9 = 0""")
def price_accounts(spark, d):
    """DEC-11: price accounts of a fixed layout."""

    def account(order: int, customer: int) -> bytes:
        level = b"\1" if order % 2 == 0 else b"\0\5"
        return (bytes(8) if customer % 9 == 0 else decode.PRICE_ACCOUNT) + bytes(32) + level + bytes(32) + struct.pack("<qQiqqqQQ", customer, 6, -2, 100, 99, 12000, 7, 555)

    rows = _built(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], pa.binary(), account)
    got = venues.price_updates(rows, "made", keep=("o_orderkey",))
    return got.select("o_orderkey", "price", "exponent", F.round("price_f", 6).alias("price_f"), "verification", "error")


@query("SELECT CAST(l_orderkey AS BIGINT) AS oid, CAST(l_linenumber AS BIGINT) AS tid, l_quantity AS px, l_extendedprice AS sz, 'perp' AS coin_class, count(*) AS n FROM lineitem GROUP BY ALL")
def fills_of_blocks(spark, d):
    """DEC-12: block lines of fills, two to a line, and as many rows as the lines say."""
    fill = F.to_json(F.struct(F.lit("SOL").alias("coin"), F.lit(1760000000000).alias("time"), F.col("l_quantity").cast("string").alias("px"), F.col("l_extendedprice").cast("string").alias("sz"), F.col("l_orderkey").alias("oid"), F.col("l_linenumber").alias("tid")))
    line = F.concat(F.lit('{"block_number":5,"block_time":"","events":[["u",'), fill, F.lit("]]}"))
    got = decode.block_fills(table(spark, d, "lineitem").select(line.alias("value")))
    return got.groupBy("oid", "tid", "px", "sz", "coin_class").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_retailprice AS best, CAST(p_size AS BIGINT) AS n, CAST(20 AS INTEGER) AS levels, CAST(least(p_size, 20) AS INTEGER) AS held FROM part")
def book_lines(spark, d):
    """DEC-13: order book lines as arrays of twenty, padded or cut."""
    level = F.struct(F.col("p_retailprice").cast("string").alias("px"), F.lit("1").alias("sz"), F.col("p_size").cast("long").alias("n"))
    levels = F.array(F.array_repeat(level, F.col("p_size").cast("int")), F.array_repeat(level, 1))
    data = F.struct(F.col("p_partkey").cast("string").alias("coin"), F.lit(1760000000000).alias("time"), levels.alias("levels"))
    lines = table(spark, d, "part").select(F.to_json(F.struct(F.lit("r").alias("time"), F.struct(data.alias("data")).alias("raw"))).alias("value"))
    got = decode.book_snapshots(lines)
    held = F.size(F.filter("bid_px", lambda x: x.isNotNull()))
    return got.select(F.col("coin").cast("long").alias("p_partkey"), F.col("ask_px")[0].alias("best"), F.col("ask_n")[0].alias("n"), F.size("bid_px").alias("levels"), held.alias("held"))


@query("SELECT o_orderkey, sha256('[\"v1\",\"' || o_orderstatus || '\",\"' || o_orderpriority || '\"]') AS digest FROM orders")
def content_hashes(spark, d):
    """FN-12: the digest of values as a JSON array."""
    scalar.register(spark)
    table(spark, d, "orders").createOrReplaceTempView("hashed_orders")
    return spark.sql("select o_orderkey, content_hash(array('v1', o_orderstatus, o_orderpriority)) digest from hashed_orders")


@query("SELECT o_orderkey, regexp_replace(regexp_replace(printf('%.4f', o_totalprice), '0+$', ''), '[.]$', '') AS price FROM orders")
def canonical_decimals(spark, d):
    """FN-16: the shortest plain text of a decimal number."""
    scalar.register(spark)
    table(spark, d, "orders").createOrReplaceTempView("priced_orders")
    return spark.sql("select o_orderkey, canonical_decimal(format_string('00%.4f', o_totalprice)) price from priced_orders")


@query("SELECT p_partkey, round(pow(p_retailprice, 2) * pow(10.0, 6 - 9), 9) AS price FROM part")
def sqrt_prices(spark, d):
    """FN-19: prices from square roots in fixed point."""
    q64 = (F.col("p_retailprice") * float(1 << 64)).cast("decimal(38,0)")
    return table(spark, d, "part").select("p_partkey", F.round(scalar.sqrt_price(q64, F.lit(6), F.lit(9)), 9).alias("price"))


@query("SELECT count(DISTINCT (l_quantity, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END)) AS books FROM lineitem")
def book_digests(spark, d):
    """FN-20: digests tell books apart by the bits of their numbers, and null from every number."""
    scalar.register(spark)
    table(spark, d, "lineitem").createOrReplaceTempView("book_lines")
    return spark.sql("select count(distinct book_digest(array(l_quantity, if(l_returnflag = 'N', null, l_discount)))) books from book_lines")
