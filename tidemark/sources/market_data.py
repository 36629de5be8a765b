"""Typed projections of market-data sources into time-keyed tables.

A feed names its file format, the columns its files hold, and the table that they become: ts is a
timestamp without zone of the feed's own time column, and every row carries symbol and market
symbol.  `read` loads files; `merge_period` keeps period files up to date.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.relational import latest_revision, merge_upsert
from tidemark.sources import tables


@dataclass(frozen=True)
class Feed:
    form: str  # csv, json (an array) or ndjson
    columns: str  # DDL of the file
    select: tuple[str, ...]  # SQL of the table's columns
    key: tuple[str, ...]
    period: str = "day"


def ms(column: str, name: str | None = None) -> tuple[str, str]:
    return f"{column} AS {name or column + '_ms'}", f"cast(timestamp_millis({column}) AS timestamp_ntz) AS ts"


def seconds(column: str, name: str) -> tuple[str, str]:
    return f"{column} AS {name}", f"cast(timestamp_seconds({column}) AS timestamp_ntz) AS ts"


def doubles(**names: str) -> tuple[str, ...]:
    """Columns that come as text."""
    return tuple(f"cast({old} AS double) AS {new}" for new, old in names.items())


# The files' columns and the tables' names for them.
KLINE = Feed(
    "csv",
    "open_time long, open double, high double, low double, close double, volume double, close_time long, quote_volume double, count long, "
    "taker_buy_volume double, taker_buy_quote_volume double, ignore string",
    (*ms("open_time"), "open", "high", "low", "close", "volume", "close_time AS close_time_ms", "quote_volume", "count AS trades", "taker_buy_volume", "taker_buy_quote_volume"),
    ("open_time_ms",),
)
BOOK_LEVELS, BOOK_KEPT = 25, 5
TARDIS_HEAD = ("`timestamp` AS time_us", "local_timestamp AS local_time_us", "cast(timestamp_micros(`timestamp`) AS timestamp_ntz) AS ts")
TARDIS_COLUMNS = "exchange string, symbol string, `timestamp` long, local_timestamp long, "


def _book_columns() -> str:
    return ", ".join(f"`{side}[{i}].{what}` double" for i in range(BOOK_LEVELS) for side in ("asks", "bids") for what in ("price", "amount"))


def _book_select() -> tuple[str, ...]:
    kept = tuple(f"`{side}[{i}].{what}` AS {side[:3]}_{what}_{i}" for i in range(BOOK_KEPT) for side in ("bids", "asks") for what in ("price", "amount"))
    amount = lambda side, i: f"coalesce(`{side}[{i}].amount`, 0)"
    sums = tuple(f"{' + '.join(amount(side, i) for i in range(BOOK_LEVELS))} AS {side[:3]}_amount_25" for side in ("bids", "asks"))
    notional = tuple(
        f"{' + '.join(f'coalesce(`{side}[{i}].price` * `{side}[{i}].amount`, 0)' for i in range(BOOK_LEVELS))} AS {side[:3]}_notional_25" for side in ("bids", "asks")
    )
    return (*kept, *sums, *notional)


FEEDS: dict[str, Feed] = {
    "binance_klines": KLINE,
    "binance_premiumIndexKlines": KLINE,
    "binance_markPriceKlines": KLINE,
    "binance_indexPriceKlines": KLINE,
    "binance_metrics": Feed(
        "csv",
        "create_time timestamp_ntz, symbol string, sum_open_interest double, sum_open_interest_value double, count_toptrader_long_short_ratio double, "
        "sum_toptrader_long_short_ratio double, count_long_short_ratio double, sum_taker_long_short_vol_ratio double",
        ("create_time AS ts", "sum_open_interest", "sum_open_interest_value", "count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio", "count_long_short_ratio",
         "sum_taker_long_short_vol_ratio"),
        ("ts",),
    ),
    "binance_fundingRate": Feed(
        "csv", "calc_time long, funding_interval_hours long, last_funding_rate double", (*ms("calc_time"), "funding_interval_hours", "last_funding_rate"), ("calc_time_ms",), "month"
    ),
    "binance_aggTrades": Feed(
        "csv", "agg_trade_id long, price double, quantity double, first_trade_id long, last_trade_id long, transact_time long, is_buyer_maker boolean",
        ("agg_trade_id", *ms("transact_time"), "price", "quantity", "first_trade_id", "last_trade_id", "is_buyer_maker"), ("agg_trade_id",),
    ),
    "binance_bookDepth": Feed("csv", "timestamp timestamp_ntz, percentage double, depth double, notional double", ("timestamp AS ts", "percentage", "depth", "notional"), ("ts", "percentage")),
    "bybit_funding": Feed(
        "json", "symbol string, fundingRate string, fundingRateTimestamp string",
        (*ms("cast(fundingRateTimestamp AS bigint)", "time_ms"), *doubles(funding_rate="fundingRate")), ("time_ms",), "month",
    ),
    "okx_trades": Feed("csv", "instrument_name string, trade_id string, side string, price double, size double, created_time long",
                       (*ms("created_time", "time_ms"), "trade_id", "side", "price", "size"), ("time_ms", "trade_id")),
    "okx_funding": Feed("csv", "instrument_name string, funding_rate double, funding_time long", (*ms("funding_time", "time_ms"), "funding_rate"), ("time_ms",), "month"),
    "deribit_dvol": Feed("json", "t long, o double, h double, l double, c double", (*ms("t", "time_ms"), "o AS open", "h AS high", "l AS low", "c AS close"), ("time_ms",)),
    "hyperliquid_funding": Feed("json", "coin string, fundingRate string, premium string, time long", (*ms("time"), *doubles(funding_rate="fundingRate", premium="premium")), ("time_ms",), "month"),
    "hyperliquid_candles_1m": Feed(
        "json", "open_time long, close_time long, o string, h string, l string, c string, v string, n long",
        (*ms("open_time"), "close_time AS close_time_ms", *doubles(open="o", high="h", low="l", close="c", volume="v"), "n AS trades"), ("open_time_ms",),
    ),
    "hyperliquid_asset_contexts": Feed(
        "json",
        "captured_at long, coin string, funding string, openInterest string, markPx string, oraclePx string, midPx string, premium string, prevDayPx string, dayNtlVlm string, "
        "dayBaseVlm string, impactPxs array<string>",
        (*ms("captured_at", "at_ms"), "coin", *doubles(funding="funding", open_interest="openInterest", mark_px="markPx", oracle_px="oraclePx", mid_px="midPx", premium="premium",
         prev_day_px="prevDayPx", day_notional_volume="dayNtlVlm", day_base_volume="dayBaseVlm"), "impactPxs AS impact_pxs"),
        ("at_ms", "coin"),
    ),
    "defillama_stablecoins": Feed(
        "json",
        "date long, stablecoin_id string, total_circulating double, total_circulating_usd double, total_unreleased double, total_minted_usd double, total_bridged_to_usd double, raw_json string",
        (*seconds("date", "date_s"), "stablecoin_id", "total_circulating", "total_circulating_usd", "total_unreleased", "total_minted_usd", "total_bridged_to_usd", "raw_json"),
        ("date_s", "stablecoin_id"), "month",
    ),
    "alternative_fng": Feed(
        "json", "date long, value long, classification string",
        (*seconds("date", "date_s"), "cast(cast(timestamp_seconds(date) AS timestamp_ntz) AS date) AS day", "value", "classification"), ("date_s",), "year",
    ),
    "sec_filings": Feed(
        "json",
        "accession string, filed_at long, acceptance string, filing_date string, report_date string, form string, items string, cik string, primary_document string, "
        "primary_doc_description string, size long, is_xbrl long, url string",
        (*ms("filed_at"), "cik", "form", "items", "cast(filing_date AS date) AS filing_date", "acceptance", "report_date", "accession", "primary_document", "primary_doc_description",
         "size", "is_xbrl", "url"),
        ("accession",), "month",
    ),
    "polymarket_prices": Feed(
        "json", "t long, p double, token_id string, outcome string, outcome_index long", (*seconds("t", "time_s"), "p AS price", "token_id", "outcome", "outcome_index"), ("time_s", "token_id"), "month"
    ),
    "kalshi_trades": Feed(
        "json",
        "trade_id string, ticker string, series_ticker string, close_day string, created_ms long, yes_price double, no_price double, count double, taker_side string, "
        "taker_outcome_side string, taker_book_side string, is_block_trade boolean, fetched_at long",
        ("trade_id", "ticker", "series_ticker", "close_day", *ms("created_ms", "created_ms"), "yes_price", "no_price", "count", "taker_side", "taker_outcome_side", "taker_book_side",
         "is_block_trade", "fetched_at AS fetched_at_ms"),
        ("trade_id",),
    ),
    "tardis_derivative_ticker": Feed(
        "csv",
        TARDIS_COLUMNS + "funding_timestamp long, funding_rate double, predicted_funding_rate double, open_interest double, last_price double, index_price double, mark_price double",
        (*TARDIS_HEAD, "funding_timestamp AS funding_time_us", "funding_rate", "predicted_funding_rate", "open_interest", "last_price", "index_price", "mark_price", "exchange"),
        ("local_time_us",),
    ),
    "tardis_book_snapshot_25": Feed("csv", TARDIS_COLUMNS + _book_columns(), (*TARDIS_HEAD, *_book_select(), "exchange"), ("local_time_us",)),
    "tardis_trades": Feed("csv", TARDIS_COLUMNS + "id string, side string, price double, amount double", (*TARDIS_HEAD, "id", "side", "price", "amount", "exchange"), ("local_time_us", "id")),
}


def project(staged: DataFrame, feed: Feed, symbol: str | None = None, market_symbol: str | None = None) -> DataFrame:
    # timestamp_millis and its like give instants; their wall clock is taken in UTC whatever the session's zone.
    in_utc = [s.replace("cast(timestamp_", "cast(to_utc_timestamp(timestamp_").replace(") AS timestamp_ntz)", "), current_timezone()) AS timestamp_ntz)") if "cast(timestamp_" in s else s for s in feed.select]
    return staged.selectExpr(*in_utc).withColumns({"symbol": F.lit(symbol).cast("string"), "market_symbol": F.lit(market_symbol).cast("string")})


def read(spark: SparkSession, name: str, paths: str | list[str], symbol: str | None = None, market_symbol: str | None = None, header: bool = True) -> DataFrame:
    """Files of a feed as its typed table, in no particular order."""
    feed = FEEDS[name]
    schema = StructType.fromDDL(feed.columns)
    if feed.form == "csv":
        staged = tables.csv(spark, paths, schema, header)
    elif feed.form == "json":
        staged = tables.json_array(spark, paths, schema)
    else:
        staged = tables.ndjson(spark, paths, schema)
    out = project(staged, feed, symbol, market_symbol)
    if name == "tardis_book_snapshot_25":  # the newest snapshot of each second
        out = latest_revision(out.withColumn("__s", F.expr("local_time_us div 1000000")), ["__s"], ["local_time_us"]).drop("__s")
    return out


def period_of(ts: str, period: str):
    """The label of the file that a row belongs to; rows without a time are 'undated'."""
    form = {"hour": "yyyy-MM-dd'T'HH", "day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[period]
    return F.coalesce(F.date_format(ts, form), F.lit("undated"))


def merge_period(held: DataFrame | None, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """A period's rows after a capture: the newest copy of each key, in key order inside partitions."""
    out = merge_upsert(new, held, list(key)) if held is not None else latest_revision(new, list(key), [c for c in new.columns if c not in key])
    return out.sortWithinPartitions(*key)
