"""Row decoders: one input row becomes any number of output rows."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import base58_encode, book_array, coin_class


class WireError(ValueError):
    """A transaction envelope that cannot be read."""


@dataclass(frozen=True)
class Instruction:
    program: int
    accounts: tuple[int, ...]
    data: bytes


@dataclass(frozen=True)
class Wire:
    version: str
    signatures: tuple[bytes, ...]
    keys: tuple[bytes, ...]
    instructions: tuple[Instruction, ...]


class Cursor:
    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def take(self, n: int) -> bytes:
        out = self.raw[self.at : self.at + n]
        if len(out) < n:
            raise WireError("truncated")
        self.at += n
        return out

    def unpack(self, form: str):
        return struct.unpack("<" + form, self.take(struct.calcsize("<" + form)))[0]

    def short(self) -> int:
        """A compact length: seven bits a byte, low ones first, three bytes at most."""
        out = 0
        for i in range(3):
            b = self.take(1)[0]
            out |= (b & 0x7F) << 7 * i
            if not b & 0x80:
                return out
        raise WireError("length is too long")


def parse_wire(raw: bytes) -> Wire:
    """A legacy or version 0 envelope: signatures, then a message of header, keys, block hash, instructions
    (and, in version 0, table lookups)."""
    if raw[:1] == b"\x81":
        raise WireError("version 1 envelopes are not supported")
    c = Cursor(raw)
    signatures = tuple(c.take(64) for _ in range(c.short()))
    if not signatures:
        raise WireError("no signature")
    version = "legacy"
    if c.raw[c.at : c.at + 1] >= b"\x80":
        if (marked := c.take(1)[0] & 0x7F) != 0:
            raise WireError(f"message version {marked} is not supported")
        version = "0"
    c.take(3)
    keys = tuple(c.take(32) for _ in range(c.short()))
    c.take(32)
    instructions = []
    for _ in range(c.short()):
        program = c.take(1)[0]
        accounts = tuple(c.take(c.short()))
        instructions.append(Instruction(program, accounts, c.take(c.short())))
    if version == "0":
        for _ in range(c.short()):
            c.take(32)
            c.take(c.short())
            c.take(c.short())
    if c.at != len(raw):
        raise WireError("bytes are left over")
    return Wire(version, signatures, keys, tuple(instructions))


def resolve_accounts(static: Column, writable: Column, readonly: Column) -> Column:
    """The list that instruction indices refer to."""
    nothing = F.array().cast("array<string>")
    return F.concat(static, F.coalesce(writable, nothing), F.coalesce(readonly, nothing))


def parse_transactions(df: DataFrame, wire: str = "tx_b64", keep: Sequence[str] = ("slot",)) -> DataFrame:
    """keep, with signature, version, signers, keys and instructions (program, accounts, data); error says why a
    row could not be read, and its other fields are null then."""
    shape = pa.list_(pa.struct([("program", pa.int32()), ("accounts", pa.list_(pa.int32())), ("data", pa.binary())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(0).to_pylist():
                try:
                    w = parse_wire(base64.b64decode(text or "", validate=True))
                except ValueError as e:
                    out.append((None, None, None, None, None, str(e) or "invalid"))
                    continue
                steps = [{"program": i.program, "accounts": list(i.accounts), "data": i.data} for i in w.instructions]
                out.append((base58_encode(w.signatures[0]), w.version, len(w.signatures), [base58_encode(k) for k in w.keys], steps, None))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()), shape, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                names=[*batch.schema.names[1:], "signature", "version", "signers", "keys", "instructions", "error"],
            )

    rows = df.select(F.col(wire).cast("string").alias("__wire"), *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__wire").schema.fields)
    made = "signature string, version string, signers int, keys array<string>, instructions array<struct<program:int,accounts:array<int>,data:binary>>, error string"
    return rows.mapInArrow(each, f"{kept}, {made}" if kept else made)


def cpi_paths(top: int, heights: Sequence[int]) -> list[str]:
    """Paths of the inner instructions below top-level instruction `top`, by their stack heights (2 is a
    direct call): a sibling counts on, a child begins at 0, and a height may not skip a level."""
    path, out = [top], []
    for h in heights:
        depth = h - 1
        if depth < 1 or depth > len(path):
            raise ValueError(f"stack height {h} does not follow {'.'.join(map(str, path))}")
        path = [*path, 0] if depth == len(path) else [*path[:depth], path[depth] + 1]
        out.append(".".join(map(str, path)))
    return out


@dataclass(frozen=True)
class LogEvent:
    program: str
    invocation: int  # the how-manieth invocation of that program in the transaction
    kind: str  # data or ray_log
    payload: bytes


def log_events(lines: Sequence[str]) -> tuple[list[LogEvent], bool]:
    """Events of a transaction's log lines, each with the invocation on top of the invoke stack, and whether the
    log was cut off: nothing after that can be attributed."""
    stack: list[tuple[str, int]] = []
    seen: dict[str, int] = {}
    out: list[LogEvent] = []

    def decoded(text: str) -> bytes | None:
        try:
            return base64.b64decode(text.strip(), validate=True)
        except ValueError:
            return None

    for line in lines:
        if line == "Log truncated":
            return out, True
        if line.startswith("Program data: "):
            if stack:
                parts = (decoded(p) for p in line[14:].split(" "))
                out.append(LogEvent(*stack[-1], "data", b"".join(p for p in parts if p is not None)))
        elif line.startswith("Program log: ray_log: "):
            if stack and (payload := decoded(line[22:])) is not None:
                out.append(LogEvent(*stack[-1], "ray_log", payload))
        elif line.startswith("Program "):
            words = line.split(" ")
            if len(words) > 2 and words[2] == "invoke":
                stack.append((words[1], seen.get(words[1], 0)))
                seen[words[1]] = stack[-1][1] + 1
            elif len(words) > 2 and (words[2] == "success" or words[2].startswith("failed")) and stack and stack[-1][0] == words[1]:
                stack.pop()
    return out, False


#: Fixed value: the first eight bytes of a price account, sha256("account:PriceUpdateV2").
PRICE_ACCOUNT = bytes([34, 241, 35, 99, 157, 126, 244, 205])


def price_update(data: bytes) -> dict:
    """A price account of fixed layout; price_f = price * 10**exponent."""
    c = Cursor(data)
    if c.take(8) != PRICE_ACCOUNT:
        raise WireError("not a price account")
    c.take(32)
    tag = c.take(1)[0]
    if tag > 1:
        raise WireError(f"verification level {tag}")
    out = {"verification": "Full" if tag else f"Partial({c.take(1)[0]})", "feed_id": c.take(32).hex()}
    for name, form in [("price", "q"), ("conf", "Q"), ("exponent", "i"), ("publish_time", "q"), ("prev_publish_time", "q"), ("ema_price", "q"), ("ema_conf", "Q"), ("posted_slot", "Q")]:
        out[name] = c.unpack(form)
    return out | {"price_f": out["price"] * 10.0 ** out["exponent"]}


# The fields of a fill and their column names.
FILL_TEXT = {"side": "side", "dir": "dir", "feeToken": "fee_token", "hash": "hash", "cloid": "cloid", "builder": "builder"}
FILL_NUMBERS = {"px": "px", "sz": "sz", "startPosition": "start_position", "closedPnl": "closed_pnl", "fee": "fee", "builderFee": "builder_fee", "deployerFee": "deployer_fee", "priorityGas": "priority_gas"}
FILL_INTEGERS = {"oid": "oid", "tid": "tid", "twapId": "twap_id"}
BLOCK = "block_number long, block_time string, events array<array<string>>"


def block_fills(lines: DataFrame, line: str = "value") -> DataFrame:
    """Fills of block lines: one row per [user, fill] event.  Absent, null and "" are null."""
    fields = ", ".join(f"{k} string" for k in ("coin", "time", "crossed", "liquidation", *FILL_TEXT, *FILL_NUMBERS, *FILL_INTEGERS))
    block = lines.select(F.from_json(line, BLOCK, {"mode": "FAILFAST"}).alias("b"))
    events = block.select("b.block_number", F.nullif(F.col("b.block_time"), F.lit("")).alias("block_time"), F.explode("b.events").alias("e"))
    fill = events.select("block_number", "block_time", F.col("e")[0].alias("user"), F.from_json(F.col("e")[1], fields, {"mode": "FAILFAST"}).alias("f"))
    text = lambda k: F.nullif(F.col(f"f.{k}"), F.lit(""))
    return fill.select(
        text("time").cast("long").alias("time_ms"), text("coin").alias("coin"), coin_class(F.col("f.coin")).alias("coin_class"), "user",
        *(text(k).alias(v) for k, v in FILL_TEXT.items()), *(text(k).cast("double").alias(v) for k, v in FILL_NUMBERS.items()), *(text(k).cast("long").alias(v) for k, v in FILL_INTEGERS.items()),
        text("crossed").cast("boolean").alias("crossed"), text("liquidation").alias("liquidation"), "block_number", "block_time",
    )


def count_events(line: Column) -> Column:
    """Events of a block line, counted without reading them: the rows of block_fills must agree."""
    return F.size(F.from_json(line, BLOCK)["events"])


SNAPSHOT = "time string, raw struct<data:struct<coin:string,time:long,levels:array<array<struct<px:string,sz:string,n:long>>>>>"
EARLIEST_MS, LATEST_MS = 1_577_836_800_000, 4_102_444_800_000  # 2020 to 2100: seconds would land in 1970


def book_snapshots(lines: DataFrame, line: str = "value") -> DataFrame:
    """Order books of snapshot lines: six arrays of twenty, null past the last level."""
    row = lines.select(F.from_json(line, SNAPSHOT, {"mode": "FAILFAST"}).alias("s")).select(F.col("s.time").alias("received"), "s.raw.data.*")
    ok = F.col("coin").isNotNull() & F.col("time").between(EARLIEST_MS, LATEST_MS - 1) & (F.size("levels") == 2)
    row = row.where(F.when(ok, True).otherwise(F.raise_error(F.lit("not a snapshot line")).cast("boolean")))
    sides = {"bid": F.col("levels")[0], "ask": F.col("levels")[1]}

    def part(side: Column, field: str, kind: str) -> Column:
        return book_array(F.transform(side, lambda x: x[field].cast(kind)))

    columns = [part(side, k, kind).alias(f"{name}_{k}") for name, side in sides.items() for k, kind in (("px", "double"), ("sz", "double"), ("n", "long"))]
    return row.select("coin", F.col("time").alias("time_ms"), "received", *columns)


def distinct_books(books: DataFrame, order: str) -> DataFrame:
    """Per coin and time identical books are one row (the first by order), and distinct ones stay.  Books are
    compared by the hex of their doubles' bits, in which 0.0 and -0.0 differ as they do in a bit pattern."""
    bits = [F.to_json(F.col(f"{s}_{k}")) for s in ("bid", "ask") for k in ("px", "sz", "n")]
    rest = [c for c in books.columns if c not in ("coin", "time_ms")]
    keyed = books.withColumn("__digest", F.sha2(F.concat_ws("|", *(F.coalesce(b, F.lit("null")) for b in bits)), 256))
    first = keyed.groupBy("coin", "time_ms", "__digest").agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return first.select("coin", "time_ms", "__row.*")


def universe_contexts(answers: DataFrame, names: str = "universe", contexts: str = "contexts") -> DataFrame:
    """Names zipped with the contexts at their places."""
    pairs = F.explode(F.arrays_zip(F.col(names).alias("name"), F.col(contexts).alias("context")))
    return answers.select(pairs.alias("z")).select("z.name", "z.context.*")


def columns_to_rows(filings: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filings given column by column, as rows."""
    zipped = F.inline(F.arrays_zip(*columns))
    return filings.select(zipped)


def ladder(events: DataFrame, markets: DataFrame, window_pct: float, max_strikes: int, max_life_hours: int, lookback_ms: int) -> DataFrame:
    """Markets kept around each event's centre.

    events: series, event, open_ms, close_ms, settle_ms, settle_value; markets: event, ticker, strike.
    The centre is the latest settlement of the same series by the event's opening, at most lookback_ms
    old, else the event's upper-median strike.  Kept are strikes within window_pct percent times the
    root of the event's hours, at most max_strikes nearest.
    """
    from tidemark.operators.relational import latest_before, nearest, upper_median

    settled = events.where("settle_ms is not null and settle_value > 0 and settle_value < double('Infinity')")
    # by_ms is one after, as a settlement at the opening itself counts.
    by = settled.groupBy("series", (F.col("settle_ms") + 1).alias("by_ms")).agg(F.max("settle_value").alias("settle_value"))
    opened = events.select("series", "event", "open_ms", "close_ms", (F.col("open_ms") + 2).alias("at"))
    found = latest_before(opened, by, ["series"], "at", "by_ms", "settle_value", lookback_ms + 1, "previous")
    middle = markets.where("strike is not null").groupBy("event").agg(upper_median("strike").alias("median"))
    centred = found.join(middle, "event", "left").select(
        "event", F.coalesce("previous", "median").alias("centre"), F.when(F.col("previous").isNotNull(), "previous_settle").otherwise("median").alias("centre_source"),
        (F.least(F.greatest(F.col("close_ms") - F.col("open_ms"), F.lit(3_600_000)), F.lit(max_life_hours * 3_600_000)) / 3_600_000.0).alias("hours"),
    )
    rows = markets.join(centred, "event")
    gap = F.abs(F.col("strike") - F.col("centre"))
    if window_pct > 0:
        rows = rows.where(F.col("centre").isNull() | (F.col("centre") <= 0) | (gap / F.col("centre") <= window_pct / 100 * F.sqrt("hours")))
    if max_strikes > 0:
        near = nearest(rows.where("centre > 0"), ["event"], F.coalesce(gap, F.lit(float("inf"))), ["ticker"], max_strikes)
        rows = near.unionByName(rows.where("centre is null or centre <= 0"))
    return rows.drop("hours")
