"""Readers, feeds and decoders on small files."""

import base64
import gzip
import json
import struct
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.functions import decode
from tidemark.functions.scalar import base58_encode
from tidemark.sources import market_data, tables
from tidemark.streaming import incremental

AB = StructType([StructField("a", LongType()), StructField("b", StringType())])


def test_csv_forms(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"x, y"\n2,\n')
    with gzip.open(tmp_path / "y.csv.gz", "wt") as f:
        f.write("1,z\n")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("z.csv", 'a,b\n7,"q"\n8,\n')
    assert [tuple(r) for r in tables.csv(spark, str(tmp_path / "x.csv"), AB).collect()] == [(1, "x, y"), (2, None)]
    assert [tuple(r) for r in tables.csv(spark, str(tmp_path / "y.csv.gz"), AB, header=False).collect()] == [(1, "z")]
    assert tables.csv(spark, str(tmp_path / "x.csv"), None).schema["a"].dataType.typeName() == "integer"
    assert [tuple(r) for r in tables.zipped_csv(spark, str(tmp_path / "z.zip"), AB).collect()] == [(7, "q"), (8, None)]
    (tmp_path / "bad.csv").write_text("a,b\nnope,1\n")
    with pytest.raises(Exception, match="(?i)malformed|nope"):
        tables.csv(spark, str(tmp_path / "bad.csv"), AB).collect()


def test_json_forms(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"a": 1, "b": "x"}, {"a": 2}]')
    (tmp_path / "good.ndjson").write_text('{"a": 1}\n{"a": 2, "b": "y"}\n')
    (tmp_path / "bad.ndjson").write_text('{"a": 3}\nnot json\n')
    assert [tuple(r) for r in tables.json_array(spark, str(tmp_path / "x.json"), AB).collect()] == [(1, "x"), (2, None)]
    assert tables.ndjson(spark, str(tmp_path / "good.ndjson"), AB).count() == 2
    good, bad = tables.ndjson_with_quarantine(spark, [str(tmp_path / "good.ndjson"), str(tmp_path / "bad.ndjson")], AB)
    assert sorted(r["a"] for r in good.collect()) == [1, 2] and [r["_corrupt_record"] for r in bad.collect()] == ["not json"]
    assert [tuple(r) for r in tables.json_rows(spark, '[{"a":5,"b":"v"}]', AB).collect()] == [(5, "v")]


def test_parquet_lists(spark, tmp_path):
    spark.createDataFrame([(1,)], "a long").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([(2, "x")], AB).write.parquet(str(tmp_path / "p2"))
    got = tables.parquet_files(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")], AB)
    assert sorted((r["a"], r["b"]) for r in got.collect()) == [(1, None), (2, "x")] and got.where("file_path like '%/p1/%'").count() == 1
    assert tables.parquet_files(spark, [], AB).count() == 0
    assert [r["file_row_number"] for r in tables.numbered_rows(spark, str(tmp_path / "p2")).collect()] == [0]


def test_feeds(spark, tmp_path):
    (tmp_path / "k.csv").write_text(
        "open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore\n1760000000000,1,2,0.5,1.5,10,1760000059999,15,7,4,6,0\n"
    )
    row = market_data.read(spark, "binance_klines", str(tmp_path / "k.csv"), "SOLUSDT", "SOL").first()
    assert (row["open_time_ms"], row["ts"], row["trades"], row["symbol"], row["market_symbol"]) == (1760000000000, datetime(2025, 10, 9, 8, 53, 20), 7, "SOLUSDT", "SOL")
    (tmp_path / "f.json").write_text('[{"symbol":"X","fundingRate":"-0.0001","fundingRateTimestamp":"1760000000000"}]')
    row = market_data.read(spark, "bybit_funding", str(tmp_path / "f.json")).first()
    assert (row["time_ms"], row["funding_rate"]) == (1760000000000, -0.0001)
    (tmp_path / "g.json").write_text('[{"date": 1760000000, "value": 40, "classification": "Fear"}]')
    assert str(market_data.read(spark, "alternative_fng", str(tmp_path / "g.json")).first()["day"]) == "2025-10-09"
    for name, feed in market_data.FEEDS.items():  # every projection binds to its columns
        empty = tables.empty(spark, StructType.fromDDL(feed.columns))
        assert set(feed.key) <= set(market_data.project(empty, feed).columns), name
    label = spark.sql("select timestamp_ntz'2025-10-09 08:53:20' ts union all select null").select(market_data.period_of("ts", "hour").alias("p"))
    assert sorted(r["p"] for r in label.collect()) == ["2025-10-09T08", "undated"]


def test_period_merges_are_repeatable(spark, tmp_path):
    store = incremental.PeriodStore(spark, str(tmp_path))
    old = spark.createDataFrame([(1, "a"), (2, "b")], AB)
    new = spark.createDataFrame([(2, "c", 1.0), (3, "d", 2.0)], StructType([*AB.fields, StructField("x", DoubleType())]))
    store.merge("2025", old, ["a"])
    for _ in range(2):
        store.merge("2025", new, ["a"])
        assert sorted(map(tuple, store.read("2025").select("a", "b", "x").collect())) == [(1, "a", None), (2, "c", 1.0), (3, "d", 2.0)]


def test_revision_state(spark, tmp_path):
    schema = StructType([StructField("k", LongType()), StructField("hash", StringType()), StructField("at", LongType())])
    state = incremental.RevisionState(spark, str(tmp_path), ["k"], schema)
    first = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], schema)
    assert {r["verdict"] for r in state.verdicts(first).collect()} == {"new"}
    state.commit(first, 0)
    state.commit(first, 0)
    second = spark.createDataFrame([(1, "a", 11), (2, "c", 11), (3, "d", 1), (2, "z", 9)], schema)
    assert {r["k"]: r["verdict"] for r in state.verdicts(second).collect()} == {1: "unchanged", 2: "changed", 3: "new"}
    state.commit(second, 1)
    assert {r["k"]: r["hash"] for r in state.known().collect()} == {1: "a", 2: "c", 3: "d"}
    assert {r["verdict"] for r in state.verdicts(spark.createDataFrame([(2, "q", 3)], schema)).collect()} == {"older"}


def wire(version=None, keys=3):
    short = lambda n: bytes([n]) if n < 128 else bytes([n & 127 | 128, n >> 7])
    message = (b"" if version is None else bytes([128 | version])) + b"\1\0\1" + short(keys) + b"".join(bytes([i]) * 32 for i in range(keys)) + b"\7" * 32
    message += short(2) + b"\2" + short(2) + b"\0\1" + short(200) + b"d" * 200 + b"\1" + short(0) + short(0)
    if version == 0:
        message += short(1) + b"\5" * 32 + short(1) + b"\0" + short(0)
    return short(1) + b"\x09" * 64 + message


def test_wires(spark):
    for version, name in ((None, "legacy"), (0, "0")):
        w = decode.parse_wire(wire(version))
        assert w.version == name and len(w.keys) == 3 and w.instructions[0] == decode.Instruction(2, (0, 1), b"d" * 200) and w.instructions[1].data == b""
    for bad in (wire()[:-1], wire() + b"x", b"\0", b"", wire(1), b"\x81"):
        with pytest.raises(decode.WireError):
            decode.parse_wire(bad)
    rows = [(1, base64.b64encode(wire()).decode()), (2, "!!"), (3, None)]
    got = {r["slot"]: r for r in decode.parse_transactions(spark.createDataFrame(rows, "slot long, tx_b64 string")).collect()}
    assert got[1]["signature"] == base58_encode(b"\x09" * 64) and got[1]["keys"][0] == "1" * 32 and got[1]["error"] is None
    assert got[2]["signature"] is None and got[2]["error"] and got[3]["error"]


def test_cpi_paths():
    assert decode.cpi_paths(3, [2, 3, 3, 2, 3, 4]) == ["3.0", "3.0.0", "3.0.1", "3.1", "3.1.0", "3.1.0.0"]
    for heights in ([1], [3], [2, 4]):
        with pytest.raises(ValueError):
            decode.cpi_paths(0, heights)


def test_log_events():
    b = lambda s: base64.b64encode(s).decode()
    lines = [
        "Program A invoke [1]", "Program log: hi", "Program B invoke [2]", f"Program data: {b(b'x')} {b(b'y')}", "Program B success", f"Program data: {b(b'z')}",
        "Program A success", "Program A invoke [1]", f"Program log: ray_log: {b(b'r')}", "Program A failed: custom", f"Program data: {b(b'lost')}",
    ]
    got, cut = decode.log_events(lines)
    assert not cut and [(e.program, e.invocation, e.kind, e.payload) for e in got] == [("B", 0, "data", b"xy"), ("A", 0, "data", b"z"), ("A", 1, "ray_log", b"r")]
    assert decode.log_events([*lines[:4], "Log truncated", *lines[4:]]) == (got[:1], True)


def test_price_update():
    import hashlib

    assert hashlib.sha256(b"account:PriceUpdateV2").digest()[:8] == decode.PRICE_ACCOUNT
    body = decode.PRICE_ACCOUNT + b"\1" * 32 + b"\1" + b"\2" * 32 + struct.pack("<qQiqqqQQ", 12345, 6, -2, 100, 99, 12000, 7, 555)
    got = decode.price_update(body)
    assert got["price_f"] == pytest.approx(123.45) and got["verification"] == "Full" and got["feed_id"] == "02" * 32 and got["posted_slot"] == 555
    with pytest.raises(decode.WireError):
        decode.price_update(body[:-1])


def test_fills_and_books(spark):
    fill = {"coin": "xyz:A", "time": 1760000000000, "px": "1.5", "sz": "2", "side": "B", "startPosition": "", "crossed": True, "tid": 7, "liquidation": {"m": 1}}
    line = json.dumps({"block_number": 5, "block_time": "t", "events": [["u1", fill], ["u2", {"coin": "@1", "time": 1}]]})
    lines = spark.createDataFrame([(line,)], "value string")
    got = decode.block_fills(lines).orderBy("user").collect()
    assert lines.select(decode.count_events(F.col("value")).alias("n")).first()["n"] == len(got) == 2
    assert (got[0]["px"], got[0]["start_position"], got[0]["crossed"], got[0]["coin_class"], got[0]["tid"], got[0]["block_number"]) == (1.5, None, True, "hip3", 7, 5)
    assert got[0]["liquidation"] and (got[1]["coin_class"], got[1]["px"]) == ("spot", None)
    book = {"time": "r", "raw": {"data": {"coin": "A", "time": 1760000000000, "levels": [[{"px": "2", "sz": "1", "n": 3}] * 25, [{"px": "3", "sz": "0.0", "n": 1}]]}}}
    other = json.loads(json.dumps(book))
    other["raw"]["data"]["levels"][1][0]["sz"] = "-0.0"
    books = decode.book_snapshots(spark.createDataFrame([(json.dumps(x),) for x in (book, book, other)], "value string")).withColumn("seq", F.monotonically_increasing_id())
    row = books.first()
    assert len(row["bid_px"]) == 20 and row["ask_px"] == [3.0] + [None] * 19 and row["bid_n"][0] == 3
    assert decode.distinct_books(books, "seq").count() == 2
    with pytest.raises(Exception, match="snapshot"):
        decode.book_snapshots(spark.createDataFrame([('{"time":"r","raw":{"data":{"coin":"A","time":5,"levels":[[],[]]}}}',)], "value string")).collect()


def test_zips(spark):
    df = spark.sql("select array('a','b') universe, array(named_struct('px', 1), named_struct('px', 2)) contexts")
    assert [tuple(r) for r in decode.universe_contexts(df).collect()] == [("a", 1), ("b", 2)]
    df = spark.sql("select array('x','y') form, array(1,2) size")
    assert [tuple(r) for r in decode.columns_to_rows(df, ["form", "size"]).collect()] == [("x", 1), ("y", 2)]


def test_ladder(spark):
    h = 3_600_000
    events = spark.createDataFrame(
        [("S", "old", 0, h, h, 100.0), ("S", "new", h, 5 * h, None, None), ("S", "far", 100 * h, 101 * h, None, None)],
        "series string, event string, open_ms long, close_ms long, settle_ms long, settle_value double",
    )
    markets = spark.createDataFrame([(e, f"{e}{k}", float(k)) for e in ("new", "far") for k in (90, 96, 99, 101, 103, 120)], "event string, ticker string, strike double")
    got = decode.ladder(events, markets, 2.0, 3, 24, 10 * h).collect()
    by = lambda e: sorted(r["strike"] for r in got if r["event"] == e)
    assert by("new") == [99.0, 101.0, 103.0] and {r["centre_source"] for r in got if r["event"] == "new"} == {"previous_settle"}
    assert {(r["centre"], r["centre_source"]) for r in got if r["event"] == "far"} == {(101.0, "median")} and by("far") == [99.0, 101.0, 103.0]


def test_revisions_survive_the_driver(spark, tmp_path):
    schema = StructType([StructField("k", LongType()), StructField("hash", StringType()), StructField("at", LongType())])
    new = lambda: incremental.RevisionState(spark, f"file://{tmp_path}/s", ["k"], schema, fold=3)
    rows = lambda n: spark.createDataFrame([(k, f"h{n}", n) for k in range(n, n + 3)], schema)
    assert [new().commit(rows(n), n) for n in (0, 1, 1, 2, 3)] == [True, True, False, True, True] and new().done == 3
    assert {r["k"]: r["hash"] for r in new().known().collect()} == {0: "h0", 1: "h1", 2: "h2", 3: "h3", 4: "h3", 5: "h3"}
    assert len(new()._state()[1]) == 2  # the third commit folded what was there
    assert {r["k"]: r["verdict"] for r in new().verdicts(spark.createDataFrame([(5, "h3", 9), (9, "x", 9), (0, "q", -1)], schema)).collect()} == {5: "unchanged", 9: "new", 0: "older"}


def test_periods_survive_the_driver_and_writers_take_turns(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"file://{tmp_path}/p"
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda i: incremental.PeriodStore(spark, root).merge("2025", spark.createDataFrame([(i, "x"), (9, f"{i}")], AB), ["a"]), range(3)))
    store = incremental.PeriodStore(spark, root)
    assert sorted(r["a"] for r in store.read("2025").collect()) == [0, 1, 2, 9] == sorted(r["a"] for r in store.all(AB).collect())
    assert store.read("2024") is None


def test_lanes_resume_and_overlap(spark, tmp_path):
    new = lambda: incremental.Lanes(spark, f"file://{tmp_path}/l", step=10, overlap=3, floor=0)
    seen = []
    publish = lambda low, high: seen.append((low, high)) or True
    with pytest.raises(ValueError):
        new().tail(5, publish)
    new().begin(25)
    assert new().tail(25, publish) is False and new().tail(31, lambda a, b: False) is False and new().state()[1] == 25
    assert new().tail(31, publish) and seen == [(23, 31)] and new().state()[1] == 31
    assert new().history(publish) and new().history(lambda a, b: False) is False and new().history(publish)
    assert seen[1:] == [(16, 25), (6, 15)] and new().state()[2] == [(0, 5)]
    new().begin(100)  # above a gap: it is a segment of its own, walked first, and the old one goes on after it
    assert new().state()[1:] == (100, [(29, 100), (0, 5)])
    while new().history(publish):
        pass
    covered = {x for low, high in seen for x in range(low, high + 1)}
    assert covered == set(range(101)) and new().state()[2] == []
    new().begin(105)  # no gap
    assert new().state()[1] == 100


def test_lz4_and_verified_csv(spark, tmp_path):
    import pyarrow as pa

    with pa.CompressedOutputStream(str(tmp_path / "x.lz4"), "lz4") as f:
        f.write(b'1,"a, b"\r\n2,\n3,c')
    assert [tuple(r) for r in tables.lz4_csv(spark, str(tmp_path / "x.lz4"), AB).collect()] == [(1, "a, b"), (2, None), (3, "c")]
    df = spark.createDataFrame([(1, 'x "y", z'), (2, "two"), (None, None)], AB)
    assert tables.verified_csv(df, str(tmp_path / "c")) == 3
    with pytest.raises(Exception, match="(?i)exist"):
        tables.verified_csv(df, str(tmp_path / "c"))


def test_shared_folder_is_needed_on_a_cluster():
    from tidemark.storage import shared_dir

    class Context:
        master = "spark://far:7077"

        @staticmethod
        def getConf():
            return {}

    class Session:
        conf, sparkContext = {}, Context

    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(Session)
