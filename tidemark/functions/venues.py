"""Events of programs: call paths, log attribution, price accounts, and the rows that a venue's transactions give."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.decode import WireError, log_events, price_update
from tidemark.functions.idl import EVENT_TAG, Idl


def call_paths(top: str, heights: str) -> Column:
    """cpi_paths() as an expression over the columns of the top-level place and the stack heights; null if a height skips a level."""
    step = "if(h - 1 = size(a.path), concat(a.path, array(0)), concat(slice(a.path, 1, greatest(h - 1, 0)), array(coalesce(get(a.path, h - 1), 0) + 1)))"
    return F.expr(f"""aggregate(transform(`{heights}`, h -> cast(h as int)),
      named_struct('path', array(cast(`{top}` as int)), 'out', cast(array() as array<string>), 'ok', true),
      (a, h) -> named_struct('path', {step}, 'out', concat(a.out, array(array_join({step}, '.'))), 'ok', coalesce(a.ok and h - 1 between 1 and size(a.path), false)),
      a -> if(a.ok, a.out, null))""")


def _exploded(df: DataFrame, columns: Sequence[str], keep: Sequence[str], made: dict[str, tuple[pa.DataType, str]], of: Callable[..., list[dict]]) -> DataFrame:
    """The columns keep, with made (Arrow type and Spark name of each), for each row that `of` makes of the columns."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(keep)
        for batch in batches:
            out, source = [], []
            for i, values in enumerate(zip(*(c.to_pylist() for c in batch.columns[n:]), strict=True)):
                rows = of(*values)
                out += rows
                source += [i] * len(rows)
            picked = [c.take(pa.array(source, pa.int32())) for c in batch.columns[:n]]
            yield pa.RecordBatch.from_arrays([*picked, *(pa.array([r.get(k) for r in out], kind) for k, (kind, _) in made.items())], names=[*keep, *made])

    rows = df.select(*keep, *(F.col(c).alias(f"__in{i}") for i, c in enumerate(columns)))
    new = StructType.fromDDL(", ".join(f"`{k}` {name}" for k, (_, name) in made.items()))
    return rows.mapInArrow(each, StructType([*rows.select(*keep).schema.fields, *new.fields]))


def attributed_events(transactions: DataFrame, logs: str = "logs", keep: Sequence[str] = ("signature",)) -> DataFrame:
    """The columns keep, with ordinal, program, invocation, kind and payload of each event in the log lines, and whether the log was cut off."""
    made = {"ordinal": (pa.int32(), "int"), "program": (pa.string(), "string"), "invocation": (pa.int32(), "int"), "kind": (pa.string(), "string"), "payload": (pa.binary(), "binary"), "truncated": (pa.bool_(), "boolean")}

    def of(lines: list[str] | None) -> list[dict]:
        events, cut = log_events([x for x in lines or [] if x is not None])
        return [{"ordinal": i, "truncated": cut, **vars(e)} for i, e in enumerate(events)]

    return _exploded(transactions, [logs], keep, made, of)


PRICE_FIELDS = {
    "verification": (pa.string(), "string"), "feed_id": (pa.string(), "string"), "price": (pa.int64(), "long"), "conf": (pa.uint64(), "decimal(20,0)"), "exponent": (pa.int32(), "int"), "publish_time": (pa.int64(), "long"),
    "prev_publish_time": (pa.int64(), "long"), "ema_price": (pa.int64(), "long"), "ema_conf": (pa.uint64(), "decimal(20,0)"), "posted_slot": (pa.uint64(), "decimal(20,0)"), "price_f": (pa.float64(), "double"), "error": (pa.string(), "string"),
}


def price_updates(accounts: DataFrame, data: str = "data", keep: Sequence[str] = ("account",)) -> DataFrame:
    """The columns keep, with the fields of each price account; error says why one could not be read."""
    import decimal

    wide = [k for k, (kind, _) in PRICE_FIELDS.items() if kind == pa.uint64()]
    made = {k: (pa.decimal128(20, 0) if k in wide else kind, name) for k, (kind, name) in PRICE_FIELDS.items()}

    def of(raw: bytes | None) -> list[dict]:
        try:
            found = price_update(raw or b"")
        except WireError as e:
            return [{"error": str(e)}]
        return [found | {k: decimal.Decimal(found[k]) for k in wide}]

    return _exploded(accounts, [data], keep, made, of)


def venue_rows(transactions: DataFrame, program: str, idls: Sequence[str], keep: Sequence[str] = ("signature",), steps: str = "steps", logs: str = "logs") -> DataFrame:
    """The columns keep, and a row for each instruction of the program and each event that it emitted, as an instruction that only
    carries it (via cpi) or in its log lines (via log).

    steps: array of struct (program, path, accounts, data).  The newest description reads a payload, else an older one;
    a payload stays as bytes whatever comes of it.  Of events, name is null for an unknown discriminator, and decode_error
    says why a known one was not read: counting both gives the counters."""
    texts = list(idls)
    made = {
        "kind": (pa.string(), "string"), "ordinal": (pa.int32(), "int"), "via": (pa.string(), "string"), "path": (pa.string(), "string"), "discriminator": (pa.string(), "string"), "name": (pa.string(), "string"),
        "payload": (pa.binary(), "binary"), "accounts": (pa.list_(pa.string()), "array<string>"), "fields": (pa.string(), "string"), "decode_error": (pa.string(), "string"),
    }
    held: list[Idl] = []

    def of(instructions: list[dict] | None, lines: list[str] | None) -> list[dict]:
        if not held:  # compiled once in each task
            held.append(Idl(texts[0], [Idl(t) for t in texts[1:]]))
        idl, out, ordinal = held[0], [], 0

        def event(payload: bytes, via: str, path: str | None) -> None:
            nonlocal ordinal
            name, fields, error = idl.event(payload)
            text = None if fields is None else json.dumps(fields, separators=(",", ":"), ensure_ascii=False)
            out.append({"kind": "event", "ordinal": ordinal, "via": via, "path": path, "discriminator": payload[:8].hex(), "name": name, "payload": payload, "fields": text, "decode_error": error})
            ordinal += 1

        for s in instructions or []:
            if s["program"] != program:
                continue
            data = s["data"] or b""
            if len(data) >= 16 and data[:8] == EVENT_TAG:
                event(data[8:], "cpi", s["path"])
            else:
                out.append({"kind": "instruction", "path": s["path"], "discriminator": data[:8].hex(), "name": idl.instruction(data), "payload": data, "accounts": s["accounts"]})
        for e in log_events([x for x in lines or [] if x is not None])[0]:
            if e.program == program and e.kind == "data" and len(e.payload) >= 8:
                event(e.payload, "log", None)
        return out

    return _exploded(transactions, [steps, logs], keep, made, of)
