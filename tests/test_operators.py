"""Operators on small hand-made tables, and their rules by property."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark import catalog as C
from tidemark.functions import scalar as S
from tidemark.operators import market, quality, relational
from tidemark.sql import accept, render

HOUR = 3_600_000_000


def test_hourly_features_by_hand(spark):
    rows = [
        ("BTC", 60, 1, 100.0, 2.0, "B", False, 1.0), ("BTC", 120, 2, 110.0, 1.0, "S", False, 2.0), ("BTC", 660, 3, 90.0, 3.0, "B", True, 0.0),
        ("@1", 30, 4, 5.0, 1.0, "B", False, None), ("xyz:HIP", 90, 5, 10.0, 1.0, "B", False, 0.0),
    ]
    df = spark.createDataFrame(rows, "coin string, s long, tid long, px double, sz double, side string, liquidation boolean, start double")
    change = F.coalesce(market.open_interest_change(F.col("side"), F.col("start"), F.col("px"), F.col("sz")), F.lit(0.0))
    fills = df.select("coin", (F.col("s") * 1_000_000).alias("t"), "tid", "px", "sz", (F.col("side") == "B").alias("buy"), "liquidation", change.alias("d_oi"))
    got = {r["coin"]: r for r in market.hourly_features(fills).collect()}
    b = got["BTC"]
    assert (b["n_trades"], b["vol"], b["buy"], b["liq"], b["first_px"], b["last_px"], b["n_minutes"]) == (3, 580, 470, 270, 100, 90, 3)
    assert math.isclose(b["rv2"], (math.log(110) - math.log(100)) ** 2 + (math.log(90) - math.log(110)) ** 2)
    assert b["d_oi"] == 180 and got["@1"]["d_oi"] == 0 and got["xyz:HIP"]["d_oi"] == 5
    assert got["xyz:HIP"]["rv2"] == 0 and got["xyz:HIP"]["n_minutes"] == 1


@pytest.mark.parametrize(("gap", "hours", "verdict"), [(0.0099, 24, "map"), (0.0101, 24, "divergence"), (0.2, 30, "divergence"), (0.001, 23, "thin")])
def test_tracking_verdict(spark, gap, hours, verdict):
    a = spark.range(hours).select(F.lit("x").alias("symbol"), F.col("id").alias("hour"), F.lit(100.0).alias("price"))
    b = a.withColumn("symbol", F.lit("y")).withColumn("price", F.lit(100.0 * math.exp(gap)))
    assert market.tracking_verdict(a, b, F.lit(True)).first()["verdict"] == verdict


def test_snapshots_prefer_the_first_source(spark):
    rows = [("a", 1, "s3", 10, 1.0), ("a", 2, "s3", 20, 3.0), ("a", 2, "capture", 25, 9.0), ("a", 3, "capture", 30, 10.0), ("a", 5, "s3", 50, 7.0)]
    df = spark.createDataFrame(rows, "coin string, hour long, source string, t long, oi double")
    got = {r["hour"]: (r["source"], r["oi"], r["change"]) for r in market.snapshot_features(df, "coin", "hour", ["t"], "oi", ["s3", "capture"]).collect()}
    assert got == {1: ("s3", 1.0, None), 2: ("s3", 3.0, 2.0), 3: ("capture", 10.0, 1.0), 5: ("s3", 7.0, None)}


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 8)), max_size=30))
def test_merge_coverage(raw):
    ranges = [(a, a + n) for a, n in raw]
    merged = C.merge_coverage(ranges)
    assert {x for a, b in merged for x in range(a, b + 1)} == {x for a, b in ranges for x in range(a, b + 1)}
    assert all(b + 1 < c for (_, b), (c, _) in zip(merged, merged[1:], strict=False))


def test_merge_coverage_case():
    assert C.merge_coverage([(3, 4), (1, 3), (10, 12)]) == [(1, 4), (10, 12)]


def test_select_run_cases():
    policy = C.CompactionPolicy()
    assert C.select_run([(30_000, 1000)] * 200, policy) == (0, 133)
    assert C.select_run([(30_000, 1000)] * 31, policy) is None
    assert C.select_run([(30_000, 1000)] * 31, policy, settled=True) == (0, 31)
    assert C.select_run([(5_000_000, 1), (10, 1), (10, 1)], policy) == (1, 3)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(1, 5_000_000), st.integers(1, 600 << 20)), max_size=60))
def test_select_run_fits(files):
    run = C.select_run(files)
    if run:
        i, j = run
        assert sum(r for r, _ in files[i:j]) <= 4_000_000 and sum(b for _, b in files[i:j]) <= 512 << 20 and j - i >= (32 if i == 0 else 2)


@pytest.mark.parametrize(("text", "want"), [("1.00", "1"), ("01.10", "1.1"), ("-0.0", "0"), ("1.5e2", "150"), ("1e-3", "0.001"), ("-2.50", "-2.5")])
def test_canonical_decimal(text, want):
    assert S.canonical_decimal(text) == want


@pytest.mark.parametrize("text", ["NaN", "1e", "", "inf", "1.2.3"])
def test_canonical_decimal_refuses(text):
    with pytest.raises(ValueError):
        S.canonical_decimal(text)


@given(st.binary(max_size=40))
def test_base58_round_trip(data):
    assert S.base58_decode(S.base58_encode(data)) == data


def test_content_hash_text():
    import hashlib

    values = ["v/schema-1", "AA==", "{}", 0, False, None, "null"]
    assert S.content_hash(values) == hashlib.sha256(b'["v/schema-1","AA==","{}",0,false,null,"null"]').hexdigest()
    assert S.book_digest([0.0]) != S.book_digest([-0.0]) != S.book_digest([None])


def test_functions_in_sql(spark):
    S.register(spark)
    row = spark.sql("select canonical_decimal('01.50') a, base58_encode(X'0001') b, hex(base58_decode('12')) c, base58_encode(cast(null as binary)) d").first()
    assert tuple(row) == ("1.5", "12", "0001", None)


@settings(deadline=None, max_examples=8)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=12), st.lists(st.tuples(st.integers(0, 35), st.integers(0, 12)), max_size=6))
def test_range_join_is_the_plain_join(spark, points, spans):
    p = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(points)], "i long, x long")
    r = spark.createDataFrame(sorted({(a, a + n) for a, n in spans}), "lo long, hi long")
    got = sorted(map(tuple, relational.range_join(p, r, "x", "lo", "hi", 5).select("i", "lo", "hi").collect()))
    want = sorted((i, a, b) for i, (_, x) in enumerate(points) for a, b in {(a, a + n) for a, n in spans} if a <= x <= b)
    assert got == want


def test_latest_before_is_strict_and_bounded(spark):
    left = spark.createDataFrame([("k", 10), ("k", 11), ("k", 30), ("z", 5)], "k string, t long")
    right = spark.createDataFrame([("k", 10, 1.0), ("k", 4, 2.0)], "k string, t long, v double")
    got = {(r["k"], r["t"]): r["held"] for r in relational.latest_before(left, right, ["k"], "t", "t", "v", 8, "held").collect()}
    assert got == {("k", 10): 2.0, ("k", 11): 1.0, ("k", 30): None, ("z", 5): None}


def test_holes_and_grades(spark):
    held = spark.createDataFrame([("a", 3), ("a", 5)], "k string, p int")
    got = {r["p"]: r["position"] for r in quality.classify_holes(held, ["k"], "p", 1, 7).collect()}
    assert got == {1: "leading", 2: "leading", 4: "interior", 6: "trailing", 7: "trailing"}


def test_reconcile_counts_each_fault(spark):
    m = spark.createDataFrame([(i,) for i in range(10)], "k long")
    ok = quality.reconcile(m, m, ["k"]).first()
    assert ok["ok"] and ok["expected"] == 10
    lost = quality.reconcile(m, m.where("k <> 4"), ["k"]).first()
    assert (lost["missing"], lost["unlisted"], lost["ok"]) == (1, 0, False)


def test_rows_differ(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    assert relational.rows_differ(a, a) == 0
    assert relational.rows_differ(a, a.dropDuplicates()) == 1


@pytest.mark.parametrize("sql", ["select 1", " WITH a AS (SELECT ';' x) SELECT * FROM a", "select 1;", "(select 1) union (select 2)"])
def test_gate_accepts(sql):
    accept(sql)


@pytest.mark.parametrize("sql", ["", "drop table t", "select 1; drop table t", "insert into t values (1)", "show tables", "with a as (select 1) insert into t select * from a"])
def test_gate_refuses(sql):
    with pytest.raises(ValueError):
        accept(sql)


def test_render(spark):
    df = spark.sql("select 1L a, cast('nan' as double) b, timestamp_ntz'2025-01-02 03:04:05.600000' c, X'00' d, array(1.50BD) e, 7 f, null g")
    assert list(render(df)) == ['{"a": "1", "b": null, "c": "2025-01-02 03:04:05.6", "d": "AA==", "e": ["1.50"], "f": 7, "g": null}']


SPECS = [
    C.TableSpec("txs", StructType([StructField("sig", StringType()), StructField("slot", LongType()), StructField("hash", StringType())]), ("sig",), "slot"),
    C.TableSpec("events", StructType([StructField("id", StringType()), StructField("sig", StringType()), StructField("slot", LongType()), StructField("hash", StringType())]), ("id",), "slot", "txs", ("sig", "hash")),
]


def batch(spark, txs, events):
    return {"txs": spark.createDataFrame(txs, SPECS[0].schema), "events": spark.createDataFrame(events, SPECS[1].schema)}


def test_store_revisions_and_compaction(spark, tmp_path):
    store = C.Store(spark, f"file://{tmp_path}/store", SPECS)
    assert store.latest("txs").count() == 0
    store.publish(1, batch(spark, [("a", 5, "h1"), ("b", 500_000, "h1")], [("a/0", "a", 5, "h1"), ("a/1", "a", 5, "h1"), ("b/0", "b", 500_000, "h1")]))
    store.publish(2, batch(spark, [("a", 5, "h2")], [("a/0", "a", 5, "h2")]))
    store.publish(2, batch(spark, [("a", 5, "h9")], []))  # a repeated batch changes nothing
    # a/1 belongs to the revision of a that lost.
    assert sorted(r["id"] for r in store.latest("events").collect()) == ["a/0", "b/0"]
    assert {r["sig"]: r["hash"] for r in store.latest("txs").collect()} == {"a": "h2", "b": "h1"}
    assert store.raw("txs").count() == 3 and store.raw("txs", 0, 100).count() == 2
    assert [f.batch for f in store.files("txs", 400_000, 600_000)] == [1]
    assert store.query("select count(*) n from txs_raw").first()["n"] == 3
    before = sorted(map(tuple, store.latest("events").collect()))
    assert store.compact("events", C.CompactionPolicy(head_files=2)) == 2
    assert sorted(map(tuple, store.latest("events").collect())) == before
    assert store.collect_garbage() == 2
    assert sorted(map(tuple, store.latest("events").collect())) == before
    with pytest.raises(ValueError):
        store.publish(3, batch(spark, [("a", 5, "h"), ("a", 5, "i")], []))


def test_sealable_epochs():
    whole = [(0, 3 * C.EPOCH_SLOTS - 1)]
    assert C.sealable_epochs(4 * C.EPOCH_SLOTS, 1, whole, [0]) == [1, 2]
    assert C.sealable_epochs(4 * C.EPOCH_SLOTS, 1, [(0, C.EPOCH_SLOTS), (C.EPOCH_SLOTS + 2, 3 * C.EPOCH_SLOTS - 1)], []) == [0, 2]


def test_a_batch_that_was_compacted_is_not_published_again(spark, tmp_path):
    store = C.Store(spark, f"file://{tmp_path}/store", SPECS)
    for b in (1, 2):
        store.publish(b, batch(spark, [(f"t{b}", 5, "h")], []))
    assert store.compact("txs", C.CompactionPolicy(head_files=2)) == 2
    store.publish(1, batch(spark, [("t1", 5, "other"), ("new", 6, "h")], []))
    store.publish(3, batch(spark, [], []))  # a batch without rows is registered too
    assert sorted(map(tuple, store.raw("txs").select("sig", "hash").collect())) == [("t1", "h"), ("t2", "h")]
    assert store.snapshot().batches == [(1, 3)]


def test_two_writers_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"file://{tmp_path}/store"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: C.Store(spark, root, SPECS).publish(b, batch(spark, [(f"t{b}", b, "h")], [])), range(1, 7)))
    store = C.Store(spark, root, SPECS)
    assert sorted(r["sig"] for r in store.latest("txs").collect()) == [f"t{b}" for b in range(1, 7)] and store.snapshot().version == 6


def test_leases_and_age_hold_garbage(spark, tmp_path):
    store = C.Store(spark, f"file://{tmp_path}/store", SPECS)
    for b in (1, 2):
        store.publish(b, batch(spark, [(f"t{b}", 5, "h")], []))
    with store.lease() as seen:
        rows = store.latest("txs", catalog=seen)
        assert store.compact("txs", C.CompactionPolicy(head_files=2)) == 2
        assert store.collect_garbage() == 0 and rows.count() == 2
    assert store.collect_garbage(min_age_s=C.GARBAGE_AGE_S) == 0
    assert store.collect_garbage() == 2 and store.latest("txs").count() == 2 and store.collect_garbage() == 0
    store._make(f"{store.root}/leases/lost.json", {"until": 0})  # of a driver that is gone
    assert store._leased_since() is None and store._names("leases") == []


def test_faults_seals_and_offload(spark, tmp_path):
    import shutil

    store = C.Store(spark, f"file://{tmp_path}/store", SPECS)
    store.publish(1, batch(spark, [("a", 5, "h"), ("b", C.EPOCH_SLOTS + 1, "h")], [("a/0", "a", 5, "h")]))
    whole = [(0, 2 * C.EPOCH_SLOTS - 1)]
    now = 3 * C.EPOCH_SLOTS
    assert store.faults() == [] and [f.low for f in store.files("txs")] == [5, C.EPOCH_SLOTS + 1]
    assert store.seal(0, C.EPOCH_SLOTS, 1, whole) == "waiting"
    assert [store.seal(0, now, 1, whole) for _ in range(2)] == ["sealed", "unchanged"]
    with pytest.raises(ValueError, match="not sealed"):
        store.offload(1, f"file://{tmp_path}/far")
    before = sorted(map(tuple, store.latest("txs").collect()))
    assert store.offload(0, f"file://{tmp_path}/far") == 2 and store.collect_garbage() == 2
    with pytest.raises(ValueError, match="restore"):
        store.latest("txs")
    assert store.latest("txs", C.EPOCH_SLOTS, None).count() == 1
    assert store.restore(0) == 2 and sorted(map(tuple, store.latest("txs").collect())) == before
    assert store.seal(0, now, 1, whole) == "unchanged" and store.compact("txs", C.CompactionPolicy(head_files=1)) <= 1
    store.publish(2, batch(spark, [("c", 7, "h")], []))
    assert store.seal(0, now, 1, whole) == "sealed"
    file = next(f for f in store.files("txs") if f.batch == 2)
    shutil.rmtree(file.path.removeprefix("file://"))
    assert store.faults() == [(file.path, "missing")] and store.faults(watermark=6) == []
    with pytest.raises(ValueError, match="is null"):
        store.publish(9, {"txs": spark.createDataFrame([("z", None, "h")], SPECS[0].schema)})


@pytest.mark.parametrize(
    "sql",
    [
        "select * from csv.`/etc/passwd`", "select reflect('java.lang.System', 'setProperty', 'a', 'b')", "select java_method('java.util.UUID', 'randomUUID')", "select * from other",
        "with x as (select * from other) select * from x", "select (select max(sig) from other) m from txs", "select * from txs where exists (select 1 from text.`/etc/passwd`)",
        "select * from parquet.`/tmp/x`", "select try_reflect('java.lang.System', 'exit', 0)", "select transform(sig) using 'cat' as (x) from txs", "select * from txs, lateral (select * from other)",
        "select sig in (select reflect('java.lang.System', 'gc')) from txs", "select * from read_files('/etc/passwd')",
    ],
)
def test_store_queries_read_the_store_only(spark, tmp_path, sql):
    store = C.Store(spark, f"file://{tmp_path}/store", SPECS)
    spark.range(1).createOrReplaceTempView("other")
    with pytest.raises(ValueError):
        store.query(sql)


def test_store_queries_that_read(spark, tmp_path):
    store = C.Store(spark, f"file://{tmp_path}/store", SPECS)
    store.publish(1, batch(spark, [("a", 5, "h1"), ("b", 6, "h1")], [("a/0", "a", 5, "h1")]))
    for sql, n in [
        ("select * from txs", 2), ("with x as (select sig from txs), y as (select * from x) select x.sig from x join events_raw e on e.sig = x.sig, y", 2), ("select * from txs where sig in (select sig from events)", 1),
        ("select * from range(3)", 3), ("select sig, (select count(*) from events) c from txs union all select 'z', 0", 3), ("select explode(array(1, 2)) from txs", 4), ("describe select sig, slot from txs", 2),
    ]:
        assert store.query(sql).count() == n, sql


def test_left_range_join_with_nulls_and_repeats(spark):
    points = spark.createDataFrame([(5,), (None,)], "x long")
    spans = spark.createDataFrame([(0, 10, None), (0, 10, None), (20, 30, "a"), (None, 3, "b")], "lo long, hi long, name string")
    got = relational.range_join(points, spans, "x", "lo", "hi", 4, how="left").select("lo", "hi", "name", "x").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(0, 10, None, 5), (0, 10, None, 5), (20, 30, "a", None), (None, 3, "b", None)]))


def test_order_statistics_are_exact(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rows = [(k, None if rng.random() < 0.1 else round(rng.gauss(0, 1), rng.choice([1, 6]))) for k in "ab" for _ in range(3000)] + [("c", 1.0), ("d", None), (None, 2.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for accuracy in (10_000, 100):  # the second brackets
        monkeypatch.setattr(relational, "ACCURACY", accuracy)
        for share in (0.5, 0.01, 1.0):
            at = F.greatest(F.lit(1), F.floor(F.col("n") * share))
            got = {r["k"]: (r["n"], r["q"]) for r in relational.order_statistics(df, ["k"], "v", share, {"q": at}).collect()}
            for k in ("a", "b", "c"):
                values = sorted(v for x, v in rows if x == k and v is not None)
                assert got[k] == (len(values), values[max(1, math.floor(len(values) * share)) - 1])


def test_numbered_rows_of_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", i * 7 % 1000, i) for i in range(1000)] + [(None, 1, -1), (None, 0, -2)]
    got = relational.numbered(spark.createDataFrame(rows, "k string, v int, i int").repartition(4), ["k"], ["v", "i"], "at", "of").collect()
    for k in ("hot", "k0", None):
        mine = sorted((v, i) for x, v, i in rows if x == k)
        assert sorted((r["at"], r["v"], r["i"], r["of"]) for r in got if r["k"] == k) == [(n + 1, *x, len(mine)) for n, x in enumerate(mine)]


def test_content_digest_depends_on_content_alone(spark):
    rows = [(i, None if i % 5 else f"t{i}", i / 4) for i in range(5000)]
    digest = lambda xs, schema="a long, b string, c double", name="t", parts=3: quality.content_digest(spark.createDataFrame(xs, schema).repartition(parts), name, ["a"]).first()["digest"]
    first = digest(rows)
    assert first == digest(rows[::-1], parts=7)
    others = [digest(rows[1:]), digest([(0, "t0", 0.5), *rows[1:]]), digest(rows, name="u"), digest(rows, "a long, b string, d double"), digest([]), digest([(0, "", 0.0)]), digest([(0, None, 0.0)])]
    assert len({first, *others}) == 8
    with pytest.raises(Exception, match="repeated"):
        digest([*rows, rows[7]])


def test_content_digest_has_one_level_above_many_leaves(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(quality, "LEAF_ROWS", 1)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    leaves = {}
    for i in range(3000):  # 12 bits of leaves
        text = f"I{len(str(i))}:{i}"
        leaves.setdefault(int(sha(text)[:3], 16), []).append((sha(text), sha(text + f"T2:t{i % 10}")))
    root = sha("".join(sha("".join(h for _, h in sorted(leaves[at]))) for at in sorted(leaves)))
    got = quality.content_digest(spark.range(3000).selectExpr("id a", "concat('t', id % 10) b").repartition(5), "t", ["a"]).first()
    assert (got["n"], got["digest"]) == (3000, sha("1:t2:1:a6:bigint1:b6:string3000:" + root))


def test_a_stores_digest_is_of_its_content(spark, tmp_path):
    stores = [C.Store(spark, f"file://{tmp_path}/{k}", SPECS) for k in "ab"]
    a, b = stores
    a.publish(1, batch(spark, [("a", 5, "old"), ("b", C.EPOCH_SLOTS, "h")], []))
    a.publish(2, batch(spark, [("a", 5, "h")], [("a/0", "a", 5, "h")]))
    b.publish(9, batch(spark, [("b", C.EPOCH_SLOTS, "h"), ("a", 5, "h")], [("a/0", "a", 5, "h")]))
    first = a.digest()
    assert first == b.digest() and a.compact("txs", C.CompactionPolicy(head_files=2)) == 2 and a.digest() == first
    b.publish(10, batch(spark, [("c", 6, "h")], []))
    assert b.digest() != first


def test_faults_tell_rows_and_content_apart(spark, tmp_path):
    store = C.Store(spark, f"file://{tmp_path}/store", SPECS)
    store.publish(1, batch(spark, [("a", 5, "h"), ("b", 6, "h")], [("a/0", "a", 5, "h")]))
    path = store.files("txs")[0].path
    for rows, what in (([("a", 5, "h")], "1 rows instead of 2"), ([("a", 5, "h"), ("b", 6, "other")], "other content")):
        spark.createDataFrame(rows, SPECS[0].schema).write.mode("overwrite").parquet(path)
        assert store.faults() == [(path, what)]
