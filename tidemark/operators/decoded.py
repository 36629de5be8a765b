"""From a program's log instructions to typed tables: grouping, quarantine, normalisation."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.scalar import base58_encode

#: The program whose events are normalised, and what its log instructions begin with.
PROGRAM = "EtrnLzgbS7nMMy5fbD42kXiUzGg8XQzJ972Xtk1cjWih"
LOG_TAGS = ("8DE6D6F209D1CFAA", "F70786CBB5479947")


def grouped_logs(instructions: DataFrame, program: str = PROGRAM, tags: Sequence[str] = LOG_TAGS, key: str = "signature") -> DataFrame:
    """(key, place, path, attribution, logs) of each instruction of the program that has log instructions below it.

    instructions: key, ord (order of execution), program, path, data, attribution.  A log belongs to the last instruction before
    it whose path is its own without the last part; one without such a parent is a group of its own, orphan.<path>, unknown.
    The attribution is unknown if that of any log is not stack_height."""
    own = instructions.where(F.col("program") == program).withColumn("is_log", F.hex(F.substring("data", 1, 8)).isin(*tags))
    parent = F.regexp_replace("path", r"\.?[0-9]+$", "")
    own = own.withColumn("owner", F.when(F.col("is_log"), parent).otherwise(F.col("path")))
    call = F.when(~F.col("is_log"), F.struct("ord", "attribution"))
    own = own.withColumn("call", F.last(call, ignorenulls=True).over(Window.partitionBy(key, "owner").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)))
    lost = F.col("call").isNull()
    logs = own.where("is_log").select(
        key, F.coalesce("call.ord", "ord").alias("place"), F.when(lost, F.concat(F.lit("orphan."), "path")).otherwise(F.col("owner")).alias("path"),
        F.when(lost, "unknown").otherwise(F.col("call.attribution")).alias("base"), "ord", "data", (F.col("attribution") == "stack_height").alias("sure"),
    )
    # A transaction's logs are few: what is collected is bounded by its size.
    out = logs.groupBy(key, "place", "path", "base").agg(F.array_sort(F.collect_list(F.struct("ord", "data"))).alias("held"), F.bool_and("sure").alias("sure"))
    return out.select(key, "place", "path", F.when(F.col("sure"), F.col("base")).otherwise("unknown").alias("attribution"), F.col("held.data").alias("logs"))


def envelope_fault(parts: Sequence[tuple[bool, bytes]]) -> str | None:
    """What is wrong with a group's payloads (whether each lists lengths, and its bytes after the tag), or None.

    A payload begins with a batch number and a count.  Lengths are listed in payloads of their own, two bytes each, before
    the batch that they belong to, whose events must have just those lengths."""
    if not any(lengths for lengths, _ in parts):
        return None
    waiting: dict[int, list[list[int]]] = {}
    for lengths, data in parts:
        if len(data) < 8:
            return "short log envelope"
        batch, count = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
        if lengths:
            if len(data) != 8 + 2 * count:
                return "length vector size mismatch"
            waiting.setdefault(batch, []).append([int.from_bytes(data[i : i + 2], "little") for i in range(8, len(data), 2)])
        elif not waiting.get(batch):
            return "missing length envelope"
        elif len(sizes := waiting[batch].pop(0)) != count or len(data) != 8 + sum(sizes):
            return "event count or total byte size mismatch"
    return "unconsumed event lengths" if any(waiting.values()) else None


def exact(text: str | None) -> str | None:
    """A JSON text whose numbers are texts, digit by digit as they were."""
    return None if text is None else json.dumps(json.loads(text, parse_int=str, parse_float=str), separators=(",", ":"), ensure_ascii=False)


def decoded_groups(groups: DataFrame, results: str = "results", fault: str | None = None) -> DataFrame:
    """groups with events (JSON texts with exact numbers) and errors (error, bytes), never both: a payload that was not read takes its
    whole instruction with it, since the ordinals of the others would not be stable.

    results: array of struct (event, error, bytes), one for each payload in order; fault: a column that names what is wrong with
    all payloads of the group."""

    @F.pandas_udf("array<string>")
    def exact_all(texts: pd.Series) -> pd.Series:
        return texts.map(lambda xs: None if xs is None else [exact(x) for x in xs])

    own = F.filter(results, lambda r: r["error"].isNotNull() | r["event"].isNull())
    errors = F.transform(own, lambda r: F.struct(F.coalesce(r["error"], F.lit("unrecognized log instruction")).alias("error"), r["bytes"].alias("bytes")))
    if fault is not None:
        every = F.transform(results, lambda r: F.struct(F.col(fault).alias("error"), r["bytes"].alias("bytes")))
        errors = F.when(F.col(fault).isNotNull(), F.concat(errors, every)).otherwise(errors)
    out = groups.withColumn("errors", errors)
    events = F.when(F.size("errors") == 0, F.transform(results, lambda r: r["event"])).otherwise(F.array().cast("array<string>"))
    return out.withColumn("events", exact_all(events))


@F.pandas_udf(StringType())
def key_text(values: pd.Series) -> pd.Series:
    """Base58 of a JSON array of 32 bytes, else null."""

    def one(text):
        try:
            data = bytes(int(float(x)) for x in json.loads(text)) if text else b""
        except (ValueError, TypeError):
            return None
        return base58_encode(data) if len(data) == 32 else None

    return values.map(one)


@F.pandas_udf(StringType())
def bytes_text(values: pd.Series) -> pd.Series:
    """The text of a JSON array of bytes, without the zeros at its end."""
    return values.map(lambda t: bytes(int(float(x)) for x in json.loads(t)).decode("utf-8", "replace").rstrip("\0") if t else None)


@F.pandas_udf(StringType())
def bytes_hex(values: pd.Series) -> pd.Series:
    return values.map(lambda t: bytes(int(float(x)) for x in json.loads(t)).hex() if t else None)


#: The kinds of events that the tables hold.
FILLS = ("OrderFilled", "SplineFilled")
ORDERS = ("OrderPlaced", "OrderModified", "OrderRejected", "OrderResidualDiscarded")


def normalised(transactions: DataFrame, groups: DataFrame, version: str, decoded_at: str, source_file: str) -> dict[str, DataFrame]:
    """The tables events, fills, order_events, funding_events, decode_errors and decoded_transactions, and faults: the signatures
    with an event whose slot is not the transaction's, which are in none of the others.

    transactions: signature, source_hash, slot, tx_index, single_in_slot, block_time, meta_json, terminal_error, err.
    groups: signature, path, attribution, events, errors.  An event is an object of one member, its kind and body.  What the body
    lacks comes from the last Header before it in the group.  The analytic tables hold events of committed transactions
    whose instruction was established by stack heights."""
    meta = F.from_json("meta_json", "map<string,string>")
    committed = F.coalesce(F.map_contains_key(meta, "err") & F.element_at(meta, "err").isNull(), F.lit(False))
    committed = committed & (F.col("err").isNull() | (F.col("err") == "null")) & F.col("terminal_error").isNull()
    own = ["signature", "source_hash", "slot", "tx_index", "single_in_slot", "block_time"]
    tx = transactions.select(*own, committed.alias("committed"))
    # A group's events are bounded by its instruction.
    each = groups.select("signature", "path", "attribution", F.posexplode("events").alias("event_ordinal", "event_json"))
    each = each.withColumn("parsed", F.from_json("event_json", "map<string,string>"))
    each = each.withColumn("event_type", F.map_keys("parsed")[0]).withColumn("body", F.map_values("parsed")[0]).where("event_type is not null")
    header = F.when(F.col("event_type") == "Header", F.col("body"))
    window = Window.partitionBy("signature", "path").orderBy("event_ordinal").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("header", F.last(header, ignorenulls=True).over(window)).join(tx, "signature")
    own_slot = F.get_json_object("body", "$.slot")
    faults = each.where((F.col("event_type") == "SlotContext") & ~own_slot.eqNullSafe(F.col("slot").cast("string"))).select("signature").distinct()
    each = each.join(faults, "signature", "left_anti")

    def either(body: str, head: str | None = None) -> Column:
        return F.coalesce(F.get_json_object("body", f"$.{body}"), F.get_json_object("header", f"$.{head or body}"))

    head = lambda name: F.get_json_object("header", f"$.{name}")
    symbol = F.coalesce(F.get_json_object("body", "$.asset_symbol"), head("asset_symbol"))
    events = each.select(
        F.concat_ws("/", "signature", "path", "event_ordinal").alias("event_id"), *own, F.col("path").alias("instruction_path"), "event_ordinal", "event_type", "committed", "attribution",
        bytes_text(F.get_json_object(symbol, "$.symbol_bytes")).alias("asset_symbol"), either("asset_id").alias("asset_id"), key_text(either("trader", "trader_account")).alias("trader"), key_text(head("signer")).alias("signer"),
        *(head(c).alias(c) for c in ("sequence_number", "tick_size", "base_lot_decimals", "quote_lot_decimals")), F.lit(version).alias("decoder_version"), "event_json", "body",
    )
    counted = events.where("committed and attribution = 'stack_height'")
    field = lambda name: F.get_json_object("body", f"$.{name}")
    fills = counted.where(F.col("event_type").isin(*FILLS)).select(
        "*", key_text(field("maker")).alias("maker"), field("side").alias("maker_side"), F.when(field("side") == "Bid", "Ask").otherwise("Bid").alias("taker_side"), field("price").alias("price_ticks"),
        field("base_lots_filled").alias("base_lots"), field("quote_lots_filled").alias("quote_lots"), field("maker_fee_rate").alias("maker_fee_rate_micro"),
        *(field(c).alias(c) for c in ("order_sequence_number", "spline_sequence_number", "quantity_remaining")),
    )
    client = field("client_order_id")
    orders = counted.where(F.col("event_type").isin(*ORDERS)).select(
        "*", field("order_sequence_number").alias("order_sequence_number"), field("price").alias("price_ticks"), F.coalesce(field("quantity"), field("base_lots_released")).alias("quantity_signed"),
        F.when(client.startswith("["), bytes_hex(client)).when(client.isNotNull() & (client != "false"), "").alias("client_order_id"), field("reason").alias("modification_reason"),
    )
    funding = counted.where("event_type = 'TraderFundingSettled'").select(
        "*", field("funding_payment").alias("funding_payment_quote_lots"), field("new_collateral_balance").alias("new_collateral_quote_lots"), field("cumulative_funding_snapshot").alias("cumulative_funding_snapshot")
    )
    kept = groups.join(faults, "signature", "left_anti")
    errors = kept.select("signature", "path", F.posexplode("errors").alias("place", "e")).join(tx, "signature")
    errors = errors.select(
        F.concat_ws("/", "signature", "path", "place").alias("error_id"), "signature", "source_hash", "slot", F.col("path").alias("instruction_path"), "e.error", F.base64(F.col("e.bytes")).alias("bytes_base64"), F.lit(version).alias("decoder_version")
    )
    sums = kept.groupBy("signature").agg(F.sum(F.size("events")).alias("n"), F.sum(F.size("errors")).alias("bad"), F.bool_and(F.col("attribution") == "stack_height").alias("sure"))
    status = F.when(F.coalesce("bad", F.lit(0)) > 0, "quarantined").when(~F.coalesce("sure", F.lit(True)), "unattributed").otherwise("decoded")
    done = tx.join(faults, "signature", "left_anti").join(sums, "signature", "left").select(
        *own, "committed", status.alias("status"), F.coalesce("n", F.lit(0)).alias("event_count"), F.coalesce("bad", F.lit(0)).alias("error_count"), F.lit(source_file).alias("source_file"), F.lit(decoded_at).alias("decoded_at"), F.lit(version).alias("decoder_version")
    )
    bare = lambda df: df.drop("body")
    return {"events": bare(events), "fills": bare(fills), "order_events": bare(orders), "funding_events": bare(funding), "decode_errors": errors, "decoded_transactions": done, "faults": faults}
