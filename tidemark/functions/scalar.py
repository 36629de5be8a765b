"""Scalar functions: as column expressions where SQL can say them, else Arrow UDFs."""

from __future__ import annotations

import decimal
import hashlib
import json
import re
import struct
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the base58 alphabet.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
NUMBER = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?")


@lru_cache(maxsize=1 << 16)  # keys come again and again
def base58_encode(data: bytes) -> str:
    n, out = int.from_bytes(data, "big"), []
    while n:
        n, r = divmod(n, 58)
        out.append(BASE58[r])
    zeros = len(data) - len(data.lstrip(b"\0"))
    return BASE58[0] * zeros + "".join(reversed(out))


@lru_cache(maxsize=1 << 16)
def base58_decode(text: str) -> bytes:
    n = 0
    for c in text:
        n = n * 58 + BASE58.index(c)
    zeros = len(text) - len(text.lstrip(BASE58[0]))
    return b"\0" * zeros + n.to_bytes((n.bit_length() + 7) // 8, "big")


def canonical_decimal(text: str) -> str:
    """The shortest plain text of a decimal number: no exponent, no needless zeros, no negative zero."""
    if not NUMBER.fullmatch(text):
        raise ValueError(f"not a finite decimal: {text!r}")
    with decimal.localcontext(prec=max(28, 2 * len(text) + 400)):
        out = format(decimal.Decimal(text), "f")
    sign, digits = ("-", out[1:]) if out[0] == "-" else ("", out)
    whole, _, part = digits.partition(".")
    whole, part = whole.lstrip("0") or "0", part.rstrip("0")
    plain = f"{whole}.{part}" if part else whole
    return plain if plain == "0" else sign + plain


def content_hash(values: Sequence) -> str:
    """SHA-256 of the values as a compact JSON array."""
    return hashlib.sha256(json.dumps(list(values), separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def book_digest(levels: Sequence[float | None]) -> str:
    """SHA-256 over presence tags and bit patterns: 0.0 and -0.0 differ, null is no number."""
    h = hashlib.sha256()
    for x in levels:
        h.update(b"\0" if x is None else b"\1" + struct.pack("<d", x))
    return h.hexdigest()


def coin_class(name: Column) -> Column:
    """@ names are spot, # names outcomes, names with a colon of a builder (hip3), others perpetuals."""
    return (
        F.when(name.startswith("@"), "spot").when(name.startswith("#"), "outcome").when(name.contains(":"), "hip3").when(name.isNotNull(), "perp")
    )


def builder(name: Column) -> Column:
    return F.when(name.contains(":"), F.substring_index(name, ":", 1))


def book_array(levels: Column, depth: int = 20) -> Column:
    """An array padded with nulls, or cut, to the given depth."""
    return F.transform(F.sequence(F.lit(1), F.lit(depth)), lambda i: F.try_element_at(levels, i))


def floor_div(x: Column, y: int) -> Column:
    """Division that rounds towards minus infinity."""
    return ((x - F.pmod(x, F.lit(y))) / y).cast("long")


def seconds_of(x: Column) -> Column:
    """Unix seconds of a number that is in seconds or, beyond 1e11, in milliseconds."""
    return F.when(x > 100_000_000_000, x / 1000.0).otherwise(x.cast("double"))


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)")


def epoch_hour(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`) div 3600000000")


def epoch_day(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`) div 86400000000")


def sqrt_price(q64: Column, decimals_a: Column, decimals_b: Column) -> Column:
    """Price from a Q64.64 square root: (q / 2**64)**2 * 10**(a - b)."""
    root = q64.cast("double") / float(1 << 64)
    return root * root * F.pow(F.lit(10.0), decimals_a - decimals_b)


def strike(floor: Column, cap: Column) -> Column:
    return F.when(floor.isNotNull() & cap.isNotNull(), (floor + cap) / 2).otherwise(F.coalesce(floor, cap))


def message_class(message: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The class of the first rule whose word the message contains, whatever its case."""
    low, out = F.lower(message), None
    for word, name in rules:
        out = F.when(low.contains(word), name) if out is None else out.when(low.contains(word), name)
    return out.otherwise("other") if out is not None else F.lit("other")


def register(spark: SparkSession) -> None:
    """Register the functions that SQL cannot say, for use in queries."""

    def lifted(f):
        return lambda s: s.map(lambda x: None if x is None else f(x)).astype(object)

    def udf(f, kind: str):
        def run(s: pd.Series) -> pd.Series:
            return lifted(f)(s)

        return F.pandas_udf(run, kind)

    spark.udf.register("base58_encode", udf(lambda b: base58_encode(bytes(b)), "string"))
    spark.udf.register("base58_decode", udf(base58_decode, "binary"))
    spark.udf.register("canonical_decimal", udf(canonical_decimal, "string"))
    spark.udf.register("content_hash", udf(lambda v: content_hash(list(v)), "string"))
    spark.udf.register("book_digest", udf(lambda v: book_digest([None if x is None or x != x else float(x) for x in v]), "string"))
