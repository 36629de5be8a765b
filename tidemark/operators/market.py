"""Hourly market features from fills, and whether two price series track each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.relational import order_statistics, previous_bucket

HOUR_US, MINUTE_US = 3_600_000_000, 60_000_000
THIN_HOURS, CLOSE_GAP = 24, 0.01


def hourly_features(fills: DataFrame) -> DataFrame:
    """Per coin and hour of fills (coin, t in microseconds, tid, px, sz, buy, liquidation, optional d_oi):
    n_trades, vol, buy, liq (notional), first_px, last_px, n_minutes and rv2, the sum of squared
    differences of ln(last price) between consecutive minutes that traded.

    Two aggregates: by minute, which combines before the shuffle, then a window over an hour's at
    most sixty minute rows, then by hour.
    """
    notional = F.col("px") * F.col("sz")
    key = F.struct("t", "tid")
    extra = [F.sum("d_oi").alias("d_oi")] if "d_oi" in fills.columns else []
    by_minute = fills.groupBy("coin", F.expr(f"t div {HOUR_US}").alias("hour"), F.expr(f"t div {MINUTE_US}").alias("minute")).agg(
        F.count("*").alias("n"), F.sum(notional).alias("vol"),
        F.sum(F.when(F.col("buy"), notional).otherwise(0.0)).alias("buy"), F.sum(F.when(F.col("liquidation"), notional).otherwise(0.0)).alias("liq"),
        F.min_by("px", key).alias("first_px"), F.max_by("px", key).alias("last_px"), *extra,
    )
    in_hour = Window.partitionBy("coin", "hour").orderBy("minute")
    step = F.log("last_px") - F.lag(F.log("last_px")).over(in_hour)
    moved = by_minute.withColumn("dr", step)
    extra = [F.sum("d_oi").alias("d_oi")] if extra else []
    return moved.groupBy("coin", "hour").agg(
        F.sum("n").alias("n_trades"), F.sum("vol").alias("vol"), F.sum("buy").alias("buy"), F.sum("liq").alias("liq"),
        F.min_by("first_px", "minute").alias("first_px"), F.max_by("last_px", "minute").alias("last_px"),
        F.count("*").alias("n_minutes"), F.coalesce(F.sum(F.col("dr") * F.col("dr")), F.lit(0.0)).alias("rv2"), *extra,
    )


def open_interest_change(side: Column, start_position: Column, px: Column, sz: Column) -> Column:
    """Half the notional by which a fill raises its holder's absolute position; null without a start position."""
    after = F.when(side == "B", start_position + sz).otherwise(start_position - sz)
    return (F.abs(after) - F.abs(start_position)) * px / 2


def snapshot_features(snapshots: DataFrame, key: str, hour: str, order: list[str], value: str, sources: list[str]) -> DataFrame:
    """Last snapshot of each hour, from the first source that has one, with its change from the same
    source's previous hour (null after a gap)."""
    last = snapshots.groupBy(key, hour, "source").agg(F.max_by(value, F.struct(*order)).alias(value))
    moved = previous_bucket(last, [key, "source"], hour, 1, value, "change")
    rank = F.array_position(F.array(*(F.lit(s) for s in sources)), F.col("source"))
    best = moved.groupBy(key, hour).agg(F.min_by(F.struct("source", value, "change"), rank).alias("__row"))
    return best.select(key, hour, "__row.*")


def tracking_verdict(left: DataFrame, right: DataFrame, pairs: Column | DataFrame, thin: int = THIN_HOURS, close: float = CLOSE_GAP) -> DataFrame:
    """x, y, n_hours, mid, verdict for pairs of symbols over their common hours; mid is the median of
    |ln(price ratio)|.  Fewer than `thin` hours: thin; a median under `close`: map; else divergence.

    pairs: the candidates, a table (x, y) that prices are joined to before they meet, so that an hour's prices never meet
    all others; or a condition, for few symbols."""
    a = left.select(F.col("symbol").alias("x"), "hour", F.col("price").alias("p"))
    b = right.select(F.col("symbol").alias("y"), "hour", F.col("price").alias("q"))
    met = a.join(b, "hour").where(pairs) if isinstance(pairs, Column) else a.join(pairs.select("x", "y").distinct(), "x").join(b, ["y", "hour"])
    gaps = met.select("x", "y", F.abs(F.log(F.col("p") / F.col("q"))).alias("gap"))
    middle = {"low": F.floor((F.col("n") + 1) / 2), "high": F.floor(F.col("n") / 2) + 1}
    counts = gaps.groupBy("x", "y").agg(F.count("*").alias("n_hours"))
    found = order_statistics(gaps, ["x", "y"], "gap", 0.5, middle).select("x", "y", ((F.col("low") + F.col("high")) / 2).alias("mid"))
    out = counts.join(found, ["x", "y"], "left")
    verdict = F.when(F.col("n_hours") < thin, "thin").when(F.col("mid") < close, "map").otherwise("divergence")
    return out.withColumn("verdict", verdict)
