"""The training-data operators against brute force, round trips, held-out accuracy and awkward tables."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, common, decontam, langid, licenses, lm_score, pivots, pseudonyms, quality, queries, shards, simhash
from tidemark.llm.common import connected_components

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, score double, __text string, fp long, label string"
ENGLISH, GERMAN = "the cat sat on the mat and looked at the other cats", "der hund und die katze sind nicht im haus mit den leuten"
#: Nulls in every column, empty and long texts, repeated rows, texts without letters, names that clash with inner ones.
AWKWARD = [
    (1, ENGLISH, "en", "a", 1, 9, 0.5, "x", 7, "l"),
    (1, ENGLISH, "en", "a", 1, 9, 0.5, "x", 7, "l"),
    (2, GERMAN, "de", None, None, None, None, None, None, None),
    (3, None, "en", "a", 0, 9, 0.5, "x", 7, "l"),
    (4, "", None, "a", 0, 9, 0.5, "x", 7, "l"),
    (5, "  \n\t ", "en", "a", 0, 9, 0.5, "x", 7, "l"),
    (6, "12 34 !!", "en", "a", 0, 9, 0.5, "x", 7, "l"),
    (None, GERMAN, "de", "a", 0, 9, 0.5, "x", 7, "l"),
    (7, (ENGLISH + " ") * 8000, "en", "a", 0, 9, 0.5, "x", 7, "l"),
    (8, "x" * 300_000, "en", "a", 0, 9, 0.5, "x", 7, "l"),
    (9, ENGLISH, None, "b", 1, 9, 0.5, "x", 7, "l"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def real(spark):
    return {t: spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark", "labels", "embeddings")}


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES) == list(range(1, 11))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {name_} AS SELECT * FROM '{FOLDER}/{name_}.parquet'")
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    text = lambda df: sorted(str(tuple(None if pd.isna(x) else x for x in r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))
    assert text(got) == text(want)


def test_components_of_chains(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


# 1. Language identification


def slow_bundle(text, dim, seed):
    x = [c if c.isalpha() else "\0" for c in "\n" + text.lower() + "\n"]
    v = lambda c: langid.letter_vector(0 if c == "\0" else ord(c), dim, seed).astype(int)
    out = np.zeros(dim, int)
    for a, b, c in zip(x, x[1:], x[2:], strict=False):
        if b != "\0":
            out += np.roll(v(a), 2) * np.roll(v(b), 1) * v(c)
    return out


def test_bundles_are_the_definition():
    texts = ["Das Haus, größer als 12 Häuser!", "", "élève où", "a"]
    got = langid.bundles([t.encode() for t in texts], np.arange(4), 4, 256, 5)
    assert (got == np.stack([slow_bundle(t, 256, 5) for t in texts])).all()


def test_bundles_of_long_and_rich_texts_are_the_definition(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcé Σσς'’,İ\n中文字", k=n)) for n in (900, 3, 700)] + ["".join(map(chr, range(0x4E00, 0x4E00 + 300)))]
    monkeypatch.setattr(langid, "CHUNK_BYTES", 64)
    monkeypatch.setattr(langid, "STEP", 16)
    monkeypatch.setattr(langid, "MOST_VECTORS", 20)
    got = langid.bundles([t.encode() for t in texts], np.arange(4), 4, 64, 5)
    assert (got == np.stack([slow_bundle(t, 64, 5) for t in texts])).all()


def test_bundles_hold_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA0, 1_300_000))).encode() + " ".join(map(chr, rng.integers(0x4E00, 0x9FA0, 30_000))).encode()
    cut_up = " ".join(text.decode()[i : i + 900] for i in range(0, 1_300_000, 900)).encode()
    tracemalloc.start()
    langid.bundles([cut_up], np.zeros(1, int), 1, langid.DIM, langid.SEED)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(cut_up) > 3_800_000 and peak < 500 << 20


def test_bundles_hold_few_trigram_vectors():
    import tracemalloc

    text = "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz ", k=200_000)).encode()
    tracemalloc.start()
    langid.bundles([text], np.zeros(1, int), 1, langid.DIM, langid.SEED)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(langid.grams([text])[1]) > 15_000 and peak < 64 << 20


def test_stages_bound_batches_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, f"{ENGLISH} {i} " * 2000, "en", "a") for i in range(100)], "doc_id long, text string, lang string, source string").repartition(1)
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]}) for b in batches)
    try:
        for stage in (langid.stage, simhash.stage, decontam.stage, bpe.stage):
            spark.conf.unset(key)
            stage(spark, docs, FOLDER)
            got = docs.mapInArrow(sizes, "rows long, bytes long").collect()
            assert sum(r["rows"] for r in got) == 100 and max(r["bytes"] for r in got) < common.BATCH_BYTES + (1 << 20)
        spark.conf.set(key, "1m")
        bpe.stage(spark, docs, FOLDER)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_langid_predicts_by_brute_force_cosine(spark, real):
    rows = real["documents"].where("n_chars < 1500").limit(40)
    profiles = langid.learn(real["documents"].where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2), dim=256)
    learned = real["documents"].toPandas()
    learned = learned[[zlib.crc32(str(i).encode()) % 4 != 2 for i in learned.doc_id]].dropna(subset=["lang", "text"])
    sums = {k: sum(langid.bundles([t.encode()], np.zeros(1, int), 1, 256, langid.SEED)[0] for t in g.text) for k, g in learned.groupby("lang")}
    langs = sorted(sums)
    matrix = np.stack([sums[k] / np.linalg.norm(sums[k]) for k in langs])
    assert profiles.langs == tuple(langs) and np.allclose(profiles.matrix, matrix)
    for r in langid.predict(rows, profiles, keep=("text",)).collect():
        v = slow_bundle(r["text"], 256, langid.SEED)
        cos = matrix @ v / np.linalg.norm(v)
        assert r["lang_pred"] == langs[int(cos.argmax())] and math.isclose(r["score"], max(0.0, cos.max()), abs_tol=1e-9)


def test_langid_held_out(spark, real):
    got = langid.op1_language_id(spark, FOLDER).toPandas().merge(real["documents"].select("doc_id", "lang", "n_chars").toPandas(), on="doc_id")
    held = got[got.held_out & (got.n_chars >= 40)]
    assert len(held) > 20 and (held.lang_pred == held.lang).mean() >= 0.95
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()


def test_langid_awkward(spark, docs, none):
    profiles = langid.learn(docs.where("doc_id is not null"))
    assert profiles.langs == ("de", "en")
    got = langid.predict(docs, profiles).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, 7, 9, None)] == ["en", "de", "und", "und", "und", "und", "en", "en", "de"]
    assert langid.predict(none, profiles).count() == 0
    nothing = langid.learn(none)
    assert nothing.langs == () and {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_langid_stage_rejects_noise(spark, real):
    rng = random.Random(3)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x4E00, 0x4F00)))]
    noise = [" ".join("".join(rng.choices(a, k=rng.randint(2, 9))) for _ in range(120)) for a in alphabets for _ in range(10)]
    extra = [(1_000_000 + i, t, None, "noise", len(t)) for i, t in enumerate(noise)]
    docs = real["documents"]
    got = langid.stage(spark, docs.unionByName(spark.createDataFrame(extra, docs.schema)), FOLDER)
    kept = {r["doc_id"] for r in got.select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_langid_beginnings_are_scored_as_texts(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcé Šs'’,İ\n中文字", k=n)) for n in (900, 3, 700)] + ["", "1 2", "a", "".join(map(chr, range(0x4E00, 0x4E00 + 300)))]
    texts = [t.encode() for t in texts] + [None]
    matrix = langid.bundles(texts[:3], np.arange(3), 3, 256, 5)
    profiles = langid.Profiles(("x", "y", "z"), matrix / np.linalg.norm(matrix, axis=1)[:, None], 256, 5)
    whole = langid.beginnings(texts, profiles)
    for name, value in (("CHUNK_BYTES", 64), ("STEP", 16)):
        monkeypatch.setattr(langid, name, value)
    for t, got, pieces in zip(texts, whole, langid.beginnings(texts, profiles), strict=True):
        at, decoded = langid.letters(t), (t or b"").decode()
        want = langid.guesses([decoded[: at[(1 << k) - 1] + 1].encode() for k in range(len(at).bit_length())], profiles)[1]
        assert np.allclose(got, want, atol=1e-12) and np.allclose(pieces, want, atol=1e-12)


def test_langid_bars_are_of_all_learning_texts(spark, monkeypatch):
    rng = random.Random(6)
    words = (ENGLISH + " " + GERMAN).split()
    rows = [(" ".join(rng.choices(words, k=rng.randint(1, 4))) + f" {i}", "en" if i % 2 else "de") for i in range(5000)]
    docs = spark.createDataFrame([*rows, *rows[:900], ("zqx vwk", None), (None, "en")], "text string, lang string").repartition(3)
    profiles = langid.learn(docs, dim=256)
    scores = langid.beginnings([t.encode() for t, _ in rows], profiles)
    want = []
    for k in range(max(map(len, scores))):
        mine = [s[k] for s in scores if len(s) > k]
        want.append(np.percentile(mine, 100 * langid.BAR_QUANTILE) * langid.BAR_SHARE if len(mine) >= langid.LEAST_SAMPLES else None)
    while want[-1] is None:
        want.pop()
    assert np.allclose(langid.bars(docs, profiles), want, rtol=0, atol=1e-12)
    monkeypatch.setattr(langid, "ACCURACY", 2000)  # brackets that leave most scores out
    assert np.allclose(langid.bars(docs, profiles), want, rtol=0, atol=1e-12)


def test_langid_stage_learns_from_all_labelled_rows(spark):
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    rest = [i for i in range(40) if i not in held]
    rows = [(i, GERMAN, "de") for i in held] + [(i, ENGLISH, "en") for i in rest] + [(100, GERMAN + " und", None)]
    got = langid.stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), FOLDER)
    assert {r["doc_id"]: r["lang"] for r in got.collect()} == {i: "de" if i in held or i == 100 else "en" for i in (*held, *rest, 100)}


# 2. Decontamination


def test_decontam_finds_templates(spark):
    items = spark.createDataFrame(
        [
            (1, "Tom has 12 apples and Ann Lee gives Tom 5 more apples so how many km does Tom walk when 12 trees are 3 km apart"),
            (2, "a b"),
            (3, None),
            (4, "only five plain words here"),
        ],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [
            (10, "Intro words. Tom has 40 apples and Ann Lee gives Tom 7 more apples so how many km does Tom walk when 40 trees are 9 km apart. The end."),
            (11, "Tom has 40 apples and Ann Lee gives Tom 7 more apples so how many km does Tom walk when 41 trees are 9 km apart"),
            (12, "Nothing to see here at all, really nothing, and more of it, again and again, all day long."),
            (13, None),
            (14, ""),
            (15, "Before only (five) plain words, here after"),
            (16, "Tom has 12 apples and Ann Lee gives Tom 5 more apples so how many km does Tom walk when 12 trees are 3 km apart"),
            (16, "Tom has 12 apples and Ann Lee gives Tom 5 more apples so how many km does Tom walk when 12 trees are 3 km apart"),
        ],
        "doc_id long, text string",
    )
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.matches(docs, items).collect()}
    # 11 lets 12 stand for both 40 and 41 along one alignment, so its slots are inconsistent.
    assert set(got) == {(10, 1), (15, 4), (16, 1)}
    assert got[10, 1]["changed_slots"] == 3 and got[16, 1]["changed_slots"] == 0 and got[16, 1]["coverage"] == 1.0


def test_decontam_equals_containment(spark, real):
    got = {(r["doc_id"], r["item_id"]) for r in decontam.op2_decontamination(spark, FOLDER).collect()}
    d, b = real["documents"].toPandas(), real["benchmark"].toPandas()
    want = {(i, k) for i, t in zip(d.doc_id, d.text, strict=True) for k, s in zip(b.item_id, b.text, strict=True) if s in t}
    assert want and got == want


def test_decontam_finds_capitals_and_titles(spark):
    item = "La casa de los niños está lejos, y el río Émeraude no tiene agua en verano. Nadie lo sabe."
    items = spark.createDataFrame([(1, item), (2, "Ada Byron met Émile Zola near 12 old bridges in the quiet town of Arles")], "item_id long, text string")
    rows = [
        (1, f"before it {item.upper()}!! after it"),
        (2, f"plain words, {item.title()}"),
        (3, "!! ".join(item.upper().split())),
        (4, "who said Mary Shelley met Jean Giono near 30 old bridges in the quiet town of Nîmes"),
        (5, "LA CASA DE LOS OTROS NO ESTÁ LEJOS, Y TODO LO DEMÁS SON OTRAS PALABRAS EN OTRO ORDEN."),
    ]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 2)}


def test_decontam_equals_containment_without_case(spark):
    folder = "/root/testdata/sf0.1"
    got = {(r["doc_id"], r["item_id"]) for r in decontam.op2_decontamination(spark, folder).collect()}
    d, b = (spark.read.parquet(f"{folder}/{t}.parquet").toPandas() for t in ("documents", "benchmark"))
    texts = d.text.fillna("").str.lower()
    want = {(i, k) for k, s in zip(b.item_id, b.text.str.lower(), strict=True) for i in d.doc_id[texts.str.contains(s, regex=False)]}
    assert want and got >= want and len(got - want) <= len(want) // 10


def test_decontam_without_the_bitmap(spark, real, monkeypatch):
    with_map = sorted(map(tuple, decontam.matches(real["documents"], real["benchmark"]).collect()))
    monkeypatch.setattr(decontam, "FILTER_WINDOWS", 1)
    assert sorted(map(tuple, decontam.matches(real["documents"], real["benchmark"]).collect())) == with_map


def test_decontam_finds_long_runs_and_copies_with_a_slip(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    plain = [[word() for _ in range(n)] for n in (59, 400)]
    slip = [word() for _ in range(70)]
    for i in (10, 35, 60):
        slip[i] = "Tom"
    items = [*plain, slip]
    other = [word() for _ in range(30)]
    rows = [
        (1, other + plain[0][:29] + other[::-1]),
        (2, other + plain[1][150:250] + other[::-1]),
        (3, slip[:35] + ["Tim"] + slip[36:]),
        (4, other + plain[1][150:172] + other[::-1]),  # 22 words are too few
    ]
    items = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    rows = spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_matched"] for r in decontam.matches(rows, items).collect()}
    assert got == {(1, 0): 22, (2, 1): 93, (3, 2): 63 - 8}


PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def slow_template(text, names=True):
    """(token, kind, slot) of each word by plain rules: token is the word, or its kind where it is a slot."""
    out, number, opens = [], False, True
    words = [w for line in (text or "").split("\n") for w in [*line.split(), "\n"]]
    plain = [w for w in words if w != "\n"]
    runs, at = [0] * len(plain), 0
    while at < len(plain):  # runs of capitalised words
        end = at
        while end < len(plain) and plain[end].strip(PUNCTUATION)[:1].isupper():
            end += 1
        runs[at : max(end, at + 1)] = [end - at] * (max(end, at + 1) - at)
        at = max(end, at + 1)
    i = 0
    for w in words:
        if w == "\n":
            opens = True
            continue
        core = w.strip(PUNCTUATION) or w
        low = core.lower()
        m = decontam.QUANTITY.fullmatch(low.encode())
        kind = None
        if low.encode() in decontam.NUMBER_WORDS or decontam.NUMBER.fullmatch(low.encode()) or m and m[1] in decontam.UNITS:
            kind = "number"
        elif number and low.encode() in decontam.UNITS:
            kind = "unit"
        elif names and core[0].isupper() and not opens and runs[i] <= decontam.NAME_WORDS:
            kind = "name"
        out.append((kind and f"<{kind}>" or low, kind, low))
        number = kind == "number"
        opens = any(c in ".!?:|" for c in w[len(w.rstrip(PUNCTUATION)) :])
        i += 1
    return out


def slow_matches(rows, items):
    """{(doc_id, item_id): (n_windows, n_matched)} by comparing every window of an item with every one of a row."""
    out = {}
    for item_id, text in set(items):
        own, plain = slow_template(text), slow_template(text, names=False)
        size = min(decontam.WINDOW, len(own))
        starts = [s for s in range(len(own) - size + 1) if size and sum(not k for _, k, _ in own[s : s + size]) >= decontam.MIN_LITERALS]
        verbatim = not starts
        starts = starts or (list(range(len(own) - size + 1)) if size else [])
        for doc_id, doc in set(rows):
            words = slow_template(doc)
            if len(own) < decontam.SHORT and len(words) != len(own):
                continue
            held = {}
            for place, s in enumerate(starts):
                for p in range(len(words) - size + 1):
                    for x in [own, plain]:
                        a, b = x[s : s + size], words[p : p + size]
                        if verbatim and [w[2] for w in a] != [w[2] for w in b] or not verbatim and [w[0] for w in a] != [w[0] for w in b]:
                            continue
                        pairs = tuple((v[2], w[2]) for v, w in zip(a, b, strict=True) if v[1])
                        same = all(v == w for v, w in pairs)
                        for band in [(p - s) // 8 * 2, (p - s + 4) // 8 * 2 + 1, *(["same"] if same else [])]:
                            held.setdefault(band, set()).add((place, pairs))
            for windows in held.values():
                values = {x for _, pairs in windows for x in pairs}
                if len(values) != len({v for v, _ in values}):
                    windows = {w for w in windows if all(v == x for v, x in w[1])}
                places = sorted({p for p, _ in windows})
                run = best = 0
                for i, p in enumerate(places):
                    run = run + 1 if i and places[i - 1] == p - 1 else 1
                    best = max(best, run)
                if places and (len(places) / len(starts) >= decontam.MIN_COVERAGE or best >= decontam.MIN_RUN):
                    old = out.get((doc_id, item_id), (1, 0))
                    out[doc_id, item_id] = max(old, (len(starts), len(places)), key=lambda x: x[1] / x[0])
    return out


def test_decontam_equals_brute_force(spark):
    rng = random.Random(4)
    names, units = ["Tom", "Ann", "Bo", "Ada Byron", "Zed"], ["km", "kg", "days"]
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "sto", "ven")]

    def sentence(n):
        kinds = rng.choices(["plain", "name", "number", "quantity"], [8, 1, 1, 1], k=n)
        return [{"plain": rng.choice(plain), "name": rng.choice(names), "number": str(rng.randrange(90)), "quantity": f"{rng.randrange(9)} {rng.choice(units)}"}[k] for k in kinds]

    items = [(i, " ".join([rng.choice(plain), *sentence(rng.choice([1, 3, 6, 14, 14, 30, 60]))])) for i in range(40)]
    items += [(100, "what is 7 times 8"), (101, "12 7 9 30 5 6 7 8 9 10 11"), (102, "yes"), (103, None), (104, ""), (0, items[1][1])]
    rows = []
    for _, text in items[:40] * 6:
        words = text.split()
        change = {w: rng.choice([str(rng.randrange(90)), w]) if w.isdigit() else rng.choice([*names, w]) if w[0].isupper() else w for w in words}
        new = [change[w] for w in words]
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            new[rng.randrange(len(new))] = rng.choice([*plain, "Tom", "5"])
        cut = rng.randrange(len(new) + 1) if rng.random() < 0.3 else 0
        parts = [new[:cut], new[cut:]]
        body = parts[0] + sentence(rng.choice([1, 3, 12])) + parts[1] if cut else new
        rows.append((rng.choice([None, *range(150)]), " ".join([rng.choice(plain), *sentence(5), *body, *sentence(6)])))
    rows += [(500, "so what is 7 times 8 then"), (501, "so what is 7 times 9 then"), (502, "Yes!"), (503, "yes and no"), (504, "a 12 7 9 30 5 6 7 8 9 10 11 z"), (505, None), (506, ""), rows[0]]
    got = decontam.matches(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")).collect()
    ours = {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_matched"]) for r in got}
    want = slow_matches(rows, [i for i in items if i[1]])
    assert ours == want and len(want) > 60
    assert {(500, 100), (502, 102), (504, 101)} <= set(want) and not {(501, 100), (503, 102)} & set(want)


TEMPLATE = "Tom has 12 apples and Ann Lee gives Tom 5 more apples so how many km does Tom walk when 12 trees are 3 km apart"


def test_decontam_judges_one_alignment_of_one_row(spark):
    items = spark.createDataFrame([(1, TEMPLATE)], "item_id long, text string")
    first, second = TEMPLATE.replace("12", "40").split()[:12], TEMPLATE.replace("12", "77").split()[12:]
    copies = [TEMPLATE.replace("12", "40"), TEMPLATE.replace("12", "77").replace("Tom", "Bob")]
    rows = [(1, " ".join([*first, *["other"] * 20, *second])), (2, copies[0]), (2, copies[1]), (None, copies[0]), (None, copies[1]), (3, TEMPLATE.replace("Ann Lee", "Zoe"))]
    got = {(r["doc_id"], r["coverage"]) for r in decontam.matches(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert {i for i, _ in got} >= {2, None} and (2, 1.0) in got and (None, 1.0) in got and 1 not in {i for i, _ in got}


def test_decontam_stage_with_clashing_names(spark, real):
    text = real["benchmark"].first()["text"]
    names = "doc_id long, text string, digest int, item_id int, row int, id int, own_digest int, __key int, __bad int"
    rows = [(1, "clean words of no account at all, not one of them", 1, 2, 3, 4, 5, 6, 7), (1, f"before {text} after", 1, 2, 3, 4, 5, 6, 7)]
    got = decontam.stage(spark, spark.createDataFrame(rows, names), FOLDER).collect()
    assert [tuple(r) for r in got] == [rows[0]]


def test_decontam_awkward(spark, docs, none):
    items = spark.createDataFrame([(1, ENGLISH), (2, GERMAN)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, items).collect()}
    assert got == {(1, 1), (7, 1), (9, 1), (2, 2), (None, 2)}
    assert decontam.matches(none, items).count() == 0
    assert decontam.matches(docs, none.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def test_decontam_stage_tells_unnamed_rows_apart(spark, real):
    text = real["benchmark"].first()["text"]
    rows = [(1, "clean words of no account at all, not one of them"), (2, f"before {text} after"), (None, f"a {text}"), (None, "clean and unnamed, as it is"), (None, None)]
    got = decontam.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in got if r["text"] in (rows[0][1], rows[3][1], None)) and len(got) == 3


# 3. Licence scans


def test_license_forms(spark, none, docs):
    texts = [
        (1, "Copyright (c) 2020 Someone\nAll rights reserved.\n\nReleased under the MIT Licence"),
        (2, "A story.\nReleased   under the M.I.T licence!\n* LICENSED UNDER CC BY-NC 4.0\nLicensed under CC BY-NC 4.0."),
        (3, "Permission is not granted"),
        (4, None),
        (5, ""),
        (6, licenses.REGISTRY[0][1].replace("(the", "(the\n").upper()),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    known = licenses.registry(spark)
    got = {(r["doc_id"], r["license_id"], r["scope"]): r["n"] for r in licenses.scan(df, known).collect()}
    assert got == {(1, "MIT", "document"): 1, (1, "MIT", "line"): 1, (2, "CC-BY-NC-4.0", "line"): 2, (6, "MIT", "document"): 1}
    assert licenses.scan(none, known).count() == 0 and licenses.scan(docs, known, small=False).count() == 0
    assert licenses.scan(df, licenses.registry(spark, [("X", "!!")])).count() == 0


def laid_out(text, prefix=""):
    """A licence text in paragraphs of short lines, as files have it."""
    import textwrap

    parts = re.split(r"(?=The above copyright notice|THE SOFTWARE IS|THIS SOFTWARE IS|\b[123]\. )", text)
    lines = [line for p in parts if p.strip() for line in ["", *textwrap.wrap(p, 60)]][1:]
    return "\n".join(f"{prefix}{line}".rstrip() for line in lines)


def license_files():
    known = dict(reversed(licenses.REGISTRY))
    mit, bsd = laid_out(known["MIT"]), laid_out(known["BSD-3-Clause"])
    notice = next(t for k, t in licenses.REGISTRY if k == "Apache-2.0" and "you may not use" in t)
    return [
        ("MIT", "document", f"MIT License\n\nCopyright (c) 2021 Some One\n\n{mit}\n"),
        ("MIT", "document", f"The MIT License (MIT)\n=====================\n\nCopyright © 2021 Some One <a@b.c>\nCopyright (c) 2022 More\n\n{mit}"),
        ("MIT", "document", mit),
        ("BSD-3-Clause", "document", f"BSD 3-Clause License\n\nCopyright (c) 2021, Some One\nAll rights reserved.\n\n{bsd}"),
        ("BSD-3-Clause", "document", f"Copyright (c) 2021, Some One\nAll rights reserved.\n\n{re.sub('(?m)^[123][.] ', '* ', bsd)}"),
        ("MIT", "block", "/*\n * Copyright (c) 2021 Some One\n *\n" + laid_out(known["MIT"], " * ") + "\n */\n\n#include <x.h>\n\nint main() { return 0; }\n"),
        ("Apache-2.0", "block", "#!/bin/sh\n#\n# Copyright 2021 Some One\n#\n" + laid_out(notice, "# ") + "\n#\n\necho done\n\necho more\n"),
        ("BSD-3-Clause", "block", "Some prose goes here.\n\nBSD 3-Clause License\n\n" + bsd + "\n\nAnd some more prose goes there."),
    ]


def test_license_files_are_found(spark):
    import os

    files = license_files()
    for name, found in (("Apache-2.0", "Apache-2.0"), ("GPL-3", "GPL-3.0-only"), ("GPL-2", "GPL-2.0-only"), ("MPL-2.0", "MPL-2.0"), ("LGPL-2.1", "LGPL-2.1-only")):
        if os.path.exists(path := f"/usr/share/common-licenses/{name}"):
            with open(path, encoding="utf-8") as f:
                files.append((found, "document", f.read()))
    files.append((None, None, "MIT License\n\nThis is no licence but a text that speaks of one.\n\nIt has paragraphs\nof several lines."))
    df = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(files)], "doc_id long, text string")
    got = {(r["doc_id"], r["license_id"], r["scope"]) for r in licenses.scan(df, licenses.registry(spark)).collect()}
    assert got >= {(i, k, scope) for i, (k, scope, _) in enumerate(files) if k} and {i for i, _, _ in got} == set(range(len(files) - 1))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(i, t) for i, (_, _, t) in enumerate(files)], columns=["doc_id", "text"]))
    assert {(r[0], r[1], r[2]) for r in con.sql(licenses.op3_sql()).fetchall()} == got


def test_license_folder(spark, tmp_path):
    (tmp_path / "House-1.0.txt").write_text("HOUSE LICENSE\n\nCopyright 2020 X\n\nDo as you like,\nbut wipe your feet.")
    known = licenses.folder(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "do as you like but wipe your feet")], "doc_id long, text string")
    assert [tuple(r) for r in licenses.scan(df, known).where("scope = 'document'").collect()] == [(1, "House-1.0", "document", 1)]


# 4. SimHash


def slow_fingerprint(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    s = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    ones = [sum(xxhash.xxh64_intdigest(x.encode(), 42) >> b & 1 for x in s) for b in range(64)]
    return sum((n * 2 > len(s)) << b for b, n in enumerate(ones))


def test_fingerprint_is_the_definition(spark):
    for t in [None, "", "a", "A b", "a B c", "ÄÖ x y\x1cz w \x0b q", ENGLISH, "a a a a a a"]:
        assert simhash.fingerprint(t and t.encode()) == slow_fingerprint(t)
    signed = spark.range(1).select(F.xxhash64(F.lit("the cat sat"))).first()[0]
    assert xxhash.xxh64_intdigest(b"the cat sat", 42) == signed % (1 << 64)


def brute_components(ids, fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_shards_lose_no_link(spark, radius):
    rng = random.Random(radius)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(300):  # chains and dense groups
        fps.append(rng.choice(fps[-60:]) ^ (1 << rng.randrange(64)))
    fps = list(dict.fromkeys(fps))
    points = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.shard_links(points, radius, shard_points=40)
    found = connected_components(links)
    got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in found.collect()}
    ours = Counter(got.get(f, f) for f in fps)
    want = brute_components(range(len(fps)), fps, radius)
    assert sorted(ours.values()) == sorted(Counter(want).values())
    pairs = {(a, b) for a, b in zip((got.get(f, f) for f in fps), want, strict=True)}
    assert len(pairs) == len(set(want))


def test_simhash_query(spark, real):
    got = simhash.op4_simhash_near_dedup(spark, FOLDER).toPandas().sort_values("doc_id")
    d = real["documents"].toPandas().sort_values("doc_id")
    fps = [slow_fingerprint(t) for t in d.text]
    assert got.fingerprint.tolist() == [f"{f:016x}" for f in fps]
    assert got.component_id.tolist() == brute_components(d.doc_id.tolist(), fps, 2)


def test_simhash_awkward(spark, docs, none):
    got = simhash.components(docs).collect()
    assert len(got) == len(AWKWARD)
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by == {1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: 6, None: 2, 7: by[7], 8: 8, 9: 1}
    assert simhash.components(none).count() == 0
    kept = simhash.stage(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "6", "8", "None"] + (["7"] if by[7] == 7 else []))
    assert simhash.stage(spark, none, FOLDER).count() == 0


def test_stage_finds_similar_texts(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, sets = [], []
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.choice([12, 60, 200, 600]))
        for _ in range(3):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 40))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, "a b", "A  b"])]
    for _, t in rows:
        words = (t or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    close = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (close[a] ^ close[b]).bit_count() <= 2 or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    got = simhash.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(root))
    assert len(set(root)) < len(set(brute_components(range(len(rows)), close, 2)))


# 5. Sharding


def test_shards(spark, docs, none):
    got = shards.assign(docs, 4).toPandas()
    assert len(got) == len(AWKWARD) and shards.assign(none).count() == 0
    assert sorted(got["size"]) == sorted(len((r[1] or "").encode()) + 1 for r in AWKWARD)
    assert sorted(got.text_crc32) == sorted(zlib.crc32((r[1] or "").encode()) for r in AWKWARD)
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_shards_are_balanced_and_contiguous(spark):
    got = shards.op5_sharding(spark, FOLDER).toPandas().sort_values("doc_id")
    assert got.shard.is_monotonic_increasing and set(got.shard) == set(range(8))
    sizes = got.groupby("shard")["size"].sum()
    assert (sizes - sizes.sum() / 8).abs().max() <= got["size"].max()


# 6. Vectors


def brute_vectors(rows, cosine=0.98):
    unit = []
    for _, v, label in rows:
        x = np.array([np.nan if a is None else a for a in v], float) if v else np.array([])
        ok = label is not None and len(x) and np.isfinite(x).all() and (x != 0).any()
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    n = len(rows)
    link = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[i][0], len(link[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def some_vectors(n=400, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 8, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


def test_vectors_against_brute_force(spark, monkeypatch):
    rows = some_vectors()
    rows += [(1000, rows[0][1], rows[0][2]), (1001, rows[0][1], rows[0][2]), (1001, rows[0][1], rows[0][2])]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [float("inf")] + [1.0] * 15, 1), (2005, [None] + [1.0] * 15, 1)]
    rows += [(2006, rows[5][1], None), (2007, rows[6][1][:4], rows[6][2]), (2008, [1e-200] * 16, 1), (2009, [1e200] * 16, 1), (None, rows[7][1], rows[7][2])]
    monkeypatch.setattr(pivots, "BLOCK", 16)
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>, label int, gid long, n long")
    got = pivots.near_duplicates(df).collect()
    ours = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)
    want = brute_vectors(rows)
    assert sum(r[1] for r in ours) >= 0.9 * sum(r[1] for r in want) > 0
    assert all(a[1] <= b[1] for a, b in zip(ours, want, strict=True))
    assert sum(a[2] == b[2] for a, b in zip(ours, want, strict=True)) >= 0.95 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert pivots.near_duplicates(df.limit(0)).count() == 0


def test_vectors_in_single_precision_give_the_same(spark):
    rows = [(i, v, label) for i, v, label in some_vectors()]
    frame = lambda kind: spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    a, b = (sorted(map(tuple, pivots.near_duplicates(frame(k)).collect())) for k in ("float", "double"))
    assert a == b and sum(r[1] for r in a) > 0


# 7. Quality


def test_quality_held_out(spark, real):
    got = quality.op7_quality(spark, FOLDER).toPandas().merge(real["labels"].toPandas(), on="doc_id")
    assert len(got) and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert (got.predicted == got.quality).mean() >= 0.9


def test_quality_rules_compile_as_they_fit():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] <= 0.6)).astype(float)
    model = quality.fit(["a", "b", "c"], x, y)
    assert 0 < len(model.rules) < 120
    total = np.full(600, model.intercept)
    for r in model.rules:
        total += r.weight * np.all([(x[:, "abc".index(k)] > v) == above for k, above, v in r.conditions], axis=0)
    assert ((total > 0) == (y == 1)).mean() > 0.95


def slow_statistics(text):
    t = text or ""
    least, words = max(1, len(t)), t.split(" ")
    out = {k: sum(c in chars for c in t) / least for k, chars in quality.SHARES.items()}
    return out | {"log_chars": math.log1p(len(t)), "word_chars": len(t) / len(words), "distinct_words": len(set(words)) / len(words)}


def test_quality_equals_brute_force(spark, real):
    labels = {r["doc_id"]: r["quality"] for r in real["labels"].collect() if r["doc_id"] is not None and r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    rows = {r["doc_id"]: r["text"] for r in real["documents"].collect()}
    stats = {i: slow_statistics(t) for i, t in rows.items()}
    names = list(slow_statistics(""))
    used = sorted(i for i in labels if i in rows)
    model = quality.fit(names, np.array([[stats[i][k] for k in names] for i in used]), np.array([float(labels[i]) for i in used]))
    assert model.rules
    for r in quality.op7_quality(spark, FOLDER).collect():
        total = model.intercept
        for rule in model.rules:
            total += rule.weight * all((stats[r["doc_id"]][k] > v) == above for k, above, v in rule.conditions)
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-6)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3)


def test_quality_counts_repeats_once_and_keeps_columns(spark):
    good, bad = [f"A fine text, number {'i' * i} of them." for i in range(40)], [f"xx!! {i}{i}{i} ##" for i in range(40)]
    docs = [(i % 40, t) for i, t in enumerate(good)] + [(100 + i, t) for i, t in enumerate(bad)]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)]
    df = lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)
    once = quality.learn(df(docs, "doc_id long, text string"), df(labels, "doc_id long, quality int"))
    assert once.rules and once == quality.learn(df(docs * 3, "doc_id long, text string"), df(labels * 2, "doc_id long, quality int"))
    got = quality.score(spark.createDataFrame([("t", 1, 2, 3)], "text string, __upper int, statistics int, score int"), once).first()
    assert got["__upper"] == 1 and got["statistics"] == 2 and 0 <= got["score"] <= 1


def test_quality_awkward(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (1, 1), (99, 0)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = quality.score(docs.drop("score"), model)
    assert got.count() == len(AWKWARD) and got.where("score is null or score < 0 or score > 1").isEmpty()
    assert quality.learn(docs, labels.limit(0)).rules == () and quality.score(none.drop("score"), model).count() == 0


# 8. Pseudonyms


def slow_feistel(values, moduli, tweak, key):
    half, v = len(moduli) // 2, list(values)
    for r in range(pseudonyms.ROUNDS):
        other = v[half:] if r % 2 == 0 else v[:half]
        s = hashlib.sha512(f"{key}|{tweak}|{r}|{','.join(map(str, other))}".encode()).hexdigest()
        v = [(x + int(s[i % 16 * 8 : i % 16 * 8 + 8], 16)) % moduli[i] if (i < half) == (r % 2 == 0) else x for i, x in enumerate(v)]
    return v


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_card_and_ip_by_hand(spark):
    df = spark.createDataFrame([(1, "4207051279108084"), (2, "28.125.121.88")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(df, key="k").collect()}
    d = [int(c) for c in "4207051279108084"]
    body = [4, *slow_feistel(d[1:-1], [10] * 14, "card4", "k")]
    check = next(c for c in range(10) if luhn([*body, c]))
    assert got[1] == "".join(map(str, [*body, check]))
    assert got[2] == ".".join(map(str, slow_feistel([28, 125, 121, 88], [256] * 4, "ip", "k")))


def test_dates_and_ssns_are_permuted(spark):
    days = [f"{y}-{m:02d}-{d:02d}" for y in (1900, 1999, 2000, 2099) for m in range(1, 13) for d in range(1, 29)]
    df = spark.createDataFrame([(d,) for d in days], "text string")
    got = [r["new"] for r in pseudonyms.pseudonymise(df, out="new").collect()]
    assert len(set(got)) == len(days) and all("1900-01-01" <= g <= "2099-12-31" for g in got)
    ssns = [f"{a:03d}-{b:02d}-{c:04d}" for a in (1, 665, 667, 899) for b in (1, 99) for c in (1, 9999)]
    got = [r["new"] for r in pseudonyms.pseudonymise(spark.createDataFrame([(x,) for x in ssns], "text string"), out="new").collect()]
    assert len(set(got)) == len(ssns) and all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", g) for g in got)


def test_formats_links_and_clean_texts(spark):
    texts = [
        "mail fakol.33@mail7.example.com now, +1 (927) 555-7911 and 28.125.121.88.",
        "again fakol.33@mail7.example.com; 4207-0512-7910-8084, bad 4207051279108085",
        "iban GB82 WEST 1234 5698 7654 32, born 28/02/1987, bad 1987-02-30, ip 999.1.1.1, version 2.0.",
        "plain 12 dogs, 3.14, 2024, ü 1,000,000",
        None,
        "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"] for r in pseudonyms.pseudonymise(df).orderBy("doc_id").collect()]
    mail = re.search(r"[a-z]{5}\.\d\d@mail7\.example\.com", got[0])[0]
    assert mail in got[1] and mail != "fakol.33@mail7.example.com"
    assert re.fullmatch(r"mail \S+ now, \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} and \d+\.\d+\.\d+\.\d+\.", got[0]) and "555-7911" not in got[0]
    card = re.search(r"4\d{3}-\d{4}-\d{4}-\d{4}", got[1])[0]
    assert luhn([int(c) for c in card if c.isdigit()]) and "4207-0512" not in got[1] and got[1].endswith("bad 4207051279108085")
    iban = re.search(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", got[2])[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and "WEST" not in iban
    assert got[2].endswith("bad 1987-02-30, ip 999.1.1.1, version 2.0.") and "28/02/1987" not in got[2]
    assert got[3:] == texts[3:]


def test_values_beside_each_other(spark):
    one = ["123-45-6789", "345-67-8901", "555-123-4568", "555-765-4321", "2024-01-15", "555-123-4567", "4207-0512-7910-8084", "4207 0512 7910 8084", "4207 05 1279 10 8084"]
    rows = [*((x,) for x in one), *((f"{a} {b}",) for a in one for b in one if "5 1279" not in a + b), ("8 12 4207 0512 7910 8084 12",), ("GB82 4207 0512 7910 8084",)]
    got = {r["text"]: r["new"] for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "text string"), out="new").collect()}
    assert all(got[x] != x for x in one)
    assert all(got[f"{a} {b}"] == f"{got[a]} {got[b]}" for a in one for b in one if f"{a} {b}" in got)
    assert got["GB82 4207 0512 7910 8084"] == f"GB82 {got['4207 0512 7910 8084']}"
    assert got["8 12 4207 0512 7910 8084 12"] == f"8 12 {got['4207 0512 7910 8084']} 12"


def slow_pseudonym(values, moduli, tweak, key):
    """The permutation by its definition, for any length."""
    half, v = len(moduli) // 2, list(values)
    for r in range(pseudonyms.ROUNDS):
        other = ",".join(map(str, v[half:] if r % 2 == 0 else v[:half]))
        blocks = [hashlib.sha512((f"{key}|{tweak}|{r}|{other}" + (f"|{b}" if b else "")).encode()).hexdigest() for b in range((len(v) - 1) // 16 + 1)]
        v = [(x + int(blocks[i // 16][i % 16 * 8 : i % 16 * 8 + 8], 16)) % moduli[i] if (i < half) == (r % 2 == 0) else x for i, x in enumerate(v)]
    return v


def slow_email(value, key):
    local, domain = value.rsplit("@", 1)
    spans = [next(((lo, n) for lo, n in pseudonyms.RANGES if lo <= ord(c) < lo + n), (ord(c), 1)) for c in local]
    new = slow_pseudonym([ord(c) - lo for c, (lo, _) in zip(local, spans, strict=True)], [n for _, n in spans], f"email{domain.lower()}", key)
    return "".join(chr(lo + x) for x, (lo, _) in zip(new, spans, strict=True)) + "@" + domain


def slow_phone(value, key):
    d = [int(c) for c in value if c.isdigit()]
    abroad = value.startswith("+") and not re.match(r"\+1[ .(-]|\+1\d{10}$", value)
    stay = 2 if abroad else 1 if value.startswith("0") else len(d) - 10
    low = [0 if abroad else (i == 0) * 1 if value.startswith("0") else (i in (0, 3)) * 2 for i in range(len(d) - stay)]
    moduli = [10 - m if x >= m else m for x, m in zip(d[stay:], low, strict=True)]
    new = slow_pseudonym([x - m if x >= m else x for x, m in zip(d[stay:], low, strict=True)], moduli, "phone", key)
    new = iter(d[:stay] + [x + m if m and n == 10 - m else x for x, m, n in zip(new, low, moduli, strict=True)])
    return "".join(str(next(new)) if c.isdigit() else c for c in value)


def slow_iban(value, key):
    bare = value.replace(" ", "")
    spans = [(48, 10) if c.isdigit() else (65, 26) for c in bare[4:]]
    new = slow_pseudonym([ord(c) - lo for c, (lo, _) in zip(bare[4:], spans, strict=True)], [n for _, n in spans], f"iban{bare[:2]}", key)
    body = "".join(chr(lo + x) for x, (lo, _) in zip(new, spans, strict=True))
    check = 98 - int("".join(str(int(c, 36)) for c in body + bare[:2] + "00")) % 97
    out = iter(f"{bare[:2]}{check:02d}{body}")
    return "".join(" " if c == " " else next(out) for c in value)


def slow_ssn(value, key):
    a, b, c = map(int, value.split("-"))
    a, b, c = slow_pseudonym([a - (2 if a > 666 else 1), b - 1, c - 1], [898, 99, 9999], "ssn", key)
    return f"{a + (2 if a >= 665 else 1):03d}-{b + 1:02d}-{c + 1:04d}"


def slow_date(value, key):
    import datetime

    form = "%Y-%m-%d" if value[4] == "-" else "%d/%m/%Y" if "/" in value else "%d.%m.%Y"
    days = (datetime.datetime.strptime(value, form).date() - datetime.date(1900, 1, 1)).days
    a, b = slow_pseudonym(divmod(days, 229), [319, 229], "date", key)
    return (datetime.date(1900, 1, 1) + datetime.timedelta(a * 229 + b)).strftime(form)


def test_pseudonyms_equal_brute_force(spark):
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    local = lambda: "".join(rng.choices("abzAZ09._+-äÖßéñжЖλ中ø", k=rng.choice([1, 3, 8, 40])))
    values = [(slow_email, f"{rng.choice('aß中9')}{local()}@{rng.choice(['x.org', 'Firma.de', 'müller.de'])}") for _ in range(40)]
    values += [(slow_email, x) for x in ("anna@müller.de", "müller@firma.de")]
    values += [(slow_phone, x) for x in ("030 1234567", "0171/1234567", "+49 30 1234567", "+1 (927) 555-7911", "927-555-7911", "+44 20 7946 0958")]
    values += [(slow_iban, x) for x in ("GB82 WEST 1234 5698 7654 32", "DE89370400440532013000")]
    values += [(slow_ssn, f"{rng.choice([1, 665, 667, 899]):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}") for _ in range(10)]
    values += [(slow_date, x) for x in ("1987-02-28", "28/02/1987", "31.12.2099", "1900-01-01")]
    for key in ("k", "ab'c", "a\\b\"|é"):
        df = spark.createDataFrame([(i, f"so {v} it is") for i, (_, v) in enumerate(values)], "doc_id long, text string")
        got = pseudonyms.pseudonymise(df, key=key).orderBy("doc_id").collect()
        assert [r["text"] for r in got] == [f"so {f(v, key)} it is" for f, v in values]


def test_pii_keeps_columns_of_its_own_names(spark):
    df = spark.createDataFrame([("mail a.b@c.org", 1, 2, 3)], "text string, __pii int, pieces int, pieces_ int")
    got = pseudonyms.pseudonymise(df, out="new").first()
    assert got.asDict().keys() == {"text", "__pii", "pieces", "pieces_", "new"} and got[:4] == ("mail a.b@c.org", 1, 2, 3)


def test_pii_awkward(spark, docs, none):
    got = pseudonyms.stage(spark, docs, FOLDER)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert Counter(r["text"] for r in got.collect()) == Counter(r[1] for r in AWKWARD)
    assert pseudonyms.stage(spark, none, FOLDER).count() == 0


# 9. Byte pairs

POOL = [
    "<|endoftext|>", "<|startoftext|>", " ", "\n", "\x1c", "\x85", "\xa0", "​", "'s", "'LL", "don't", "Σ", "ΑΣ", "İ", "é", "é", "中文字", "😀", "½", "٣", "the", "ing",
    "A" * 50, "ǅ", "ß", "̀", "\x00", "<|", "|>", "_", "--", "x" * 300, "aaaa" * 20, "'", "’s",
]


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path()
    library, own, rng = Tokenizer.from_file(path), bpe.Codec(path), random.Random(9)
    texts = ["".join(rng.choices(POOL, k=rng.randrange(12))) for _ in range(1500)] + ["".join(rng.choices("abcdeinthr", k=20_000))]
    for i in range(0, len(texts), 100):
        for t, (raw, back) in zip(texts[i : i + 100], own.encode_batch(texts[i : i + 100]), strict=True):
            ids = library.encode(t, add_special_tokens=False).ids
            assert raw == struct.pack(f"<{len(ids)}I", *ids)
            assert back.decode() == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


def test_bpe_query_and_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path()
    library = Tokenizer.from_file(path)
    rows = bpe.digests(docs, path, keep=("doc_id", "text")).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    encoded = bpe.encode(docs, path)
    back = {r["doc_id"]: r["text_decoded"] for r in bpe.decode(encoded, path).collect()}
    assert back[1].replace("</w>", "").split() == ENGLISH.split() or back[1].replace("</w> ", "|").replace(" ", "").replace("|", " ").replace("</w>", "") == ENGLISH
    assert back[3] == back[4] == "" and bpe.encode(none, path).count() == 0 and bpe.digests(none, path).count() == 0


# 10. Language models


def slow_words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+|[^a-z0-9\x80-\U0010ffff\x20\x09-\x0D]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_lm_scores(texts, target, background):
    """(n_tokens, score) of each text by the definition."""
    lines = [[["", *slow_words(t), ""] for t in side if slow_words(t)] for side in (target, background)]
    kinds = len({w for side in lines for x in side for w in x[1:]})
    models = []
    for side in lines:
        one, two = Counter(w for x in side for w in x[1:]), Counter(p for x in side for p in zip(x, x[1:], strict=False))
        n = sum(one.values())
        models.append(lambda u, w, one=one, two=two, n=n: (two[u, w] + lm_score.PRIOR * (one[w] + 1) / (n + kinds)) / (one[u] + lm_score.PRIOR))
    out = []
    for t in texts:
        w = slow_words(t)
        line = ["", *w, ""] if w and lines[0] else []
        loss = [math.log(models[1](u, v)) - math.log(models[0](u, v)) for u, v in zip(line, line[1:], strict=False)]
        out.append((len(w), sum(loss) / max(1, len(loss))))
    return out


def test_lm_scores_are_the_definition(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "GROUP_ROWS", 2)
    monkeypatch.setattr(lm_score, "SHARD_BYTES", 16)
    good, rest = ["The cat sat.", "a dog", "", "ab"], ["The cat sat.", "a dog", "", "ab", "zzz 12!", "é ü--É", None, " \n"]
    probe = ["the dog", "zz", "x", "", None, "12 é", "the cat sat"]
    df = lambda xs: spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "doc_id long, text string").repartition(3)
    for texts, background in ((probe, rest), (rest, None)):
        got = lm_score.scores(df(texts), df(good), background and df(background)).orderBy("doc_id").collect()
        for r, (n, want) in zip(got, slow_lm_scores(texts, good, rest), strict=True):
            assert r["n_tokens"] == n and math.isclose(r["ce_difference"], want, abs_tol=1e-12)


def test_lm_words_of_long_texts_are_whole(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choices("aB9é .,\n ", k=rng.choice([0, 5, 900]))).encode() for _ in range(60)] + [b"x" * 500, None, b"a " * 300]
    whole, n = lm_score.words(texts)
    monkeypatch.setattr(lm_score, "SEGMENT", 64)
    pieces, m = lm_score.words(texts)
    assert (whole == pieces).all() and (n == m).all() and n.tolist() == [len(slow_words(t and t.decode())) for t in texts]


def test_lm_filter_loses_no_target(spark, monkeypatch):
    docs = spark.createDataFrame([(i if i % 7 else None, str(i)) for i in range(500)], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in [*range(1, 500, 3), None, None, 4]], "doc_id int")
    want = sorted(str(i) for i in range(500) if i % 7 and (i % 3 == 1))
    for log in (24, 7):
        monkeypatch.setattr(lm_score, "FILTER_LOG", log)
        assert sorted(r["text"] for r in lm_score.chosen(docs, ids).collect()) == want


def test_lm_model_grows_with_the_corpus(spark):
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    for n in (50, 500):
        docs = spark.createDataFrame([(i, f"{word(i)} {word(i + 1)}") for i in range(n)], "doc_id long, text string")
        parts = lm_score.contributions(lm_score.numbered(docs, ("doc_id",), "text"), 0, 0, 1, True).toPandas()
        found = {k for blob in parts["keys"] for k in np.cumsum(lm_score.unpacked(blob, np.uint64), dtype=np.uint64).tolist()}
        # words and the end; pairs of a start, of neighbours and of an end
        assert len(found) == (n + 1 + 1) + 3 * n


def test_lm_prefers_the_target(spark, real):
    got = lm_score.op10_lm_scoring(spark, FOLDER).toPandas().merge(real["labels"].toPandas(), on="doc_id")
    good, bad = got.ce_difference[got.quality == 1], got.ce_difference[got.quality == 0]
    assert np.less.outer(good.to_numpy(), bad.to_numpy()).mean() > 0.9


def test_lm_awkward(spark, docs, none):
    assert {r["ce_difference"] for r in lm_score.scores(docs, none).collect()} == {0.0}
    got = lm_score.scores(docs, docs.where("lang = 'en'"), keep=("doc_id", "score", "fp")).collect()
    assert len(got) == len(AWKWARD) and all(math.isfinite(r["ce_difference"]) for r in got)
    assert [r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)] == [0, 0, 0]
    assert lm_score.scores(none, docs).count() == 0


# The pipeline


def test_pipeline_against_brute_force(spark, real):
    out = corpus_pipeline.run(spark, FOLDER).toPandas().set_index("doc_id")
    d = real["documents"].toPandas().set_index("doc_id")
    bench = real["benchmark"].toPandas().text.tolist()
    known = langid.op1_language_id(spark, FOLDER).toPandas().set_index("doc_id")
    d = d[(known.lang_pred.reindex(d.index) != "und") & (known.score.reindex(d.index) > 0)]
    fps = [slow_fingerprint(t) for t in d.text]
    d = d[[c == i for c, i in zip(brute_components(d.index.tolist(), fps, 2), d.index, strict=True)]]
    d = d[[not any(b in t for b in bench) for t in d.text]]
    assert sorted(out.index) == sorted(d.index)
    codec = bpe.Codec(bpe.vocabulary_path())
    clean = [i for i in d.index if not re.search(r"@|\d\d", d.text[i])]
    assert clean and all(list(out.ids[i]) == codec.encode(d.text[i]) for i in clean)
    assert not any("@" in d.text[i] and list(out.ids[i]) == codec.encode(d.text[i]) for i in d.index)


def test_pipeline_decodes_what_it_encodes(spark, docs):
    out = bpe.stage(spark, docs, FOLDER)
    back = bpe.decode(out, bpe.vocabulary_path(), keep=("decoded_sha256",)).collect()
    assert len(back) == len(AWKWARD) and all(hashlib.sha256(r["text_decoded"].encode()).hexdigest() == r["decoded_sha256"] for r in back)


def test_pipeline_stages_awkward(spark, docs, none):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == docs.columns
        assert got.count() > 0 and stage(spark, none, FOLDER).count() == 0


def test_stage_tells_rows_of_one_id_apart(spark):
    rows = [(1, "the first text of this id has words of its own", 5), (1, "another text altogether stands under the same id", 6), (2, "The first text of this id has  words of its own", 7), (1, "the first text of this id has words of its own", 4)]
    got = simhash.stage(spark, spark.createDataFrame(rows, "doc_id long, text string, row int"), FOLDER)
    assert sorted(r["row"] for r in got.collect()) == [4, 6]


def test_blocks_of_a_band_lose_no_link(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(70):  # chains of edits: some pairs are similar, most are not
        words = (rng.choice(texts[-12:]) if texts else base).copy()
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(words)
    sets = [{tuple(w[i : i + 5]) for i in range(146)} for w in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    arrays = [simhash.shingle_set(" ".join(w).encode()) for w in texts]
    members = spark.createDataFrame([(i, [int(x) for x in a.view(np.int64)]) for i, a in enumerate(arrays)], "node long, members array<long>")
    mixed = spark.createDataFrame([(5, i, i, 7) for i in range(len(texts))], "key long, node long, root long, blocks int")
    links = simhash.links_in_bands(mixed, members)
    assert links.count() < 7 * 7 * len(texts)
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert [found.get(i, i) for i in range(len(texts))] == root and 1 < len(set(root)) < len(texts)


def test_cut_needs_a_shared_folder_and_is_released(spark):
    import os

    table = common.cut(spark.range(3), "probe")
    path = table.__dict__["_cut_path"].removeprefix("file://")
    assert table.count() == 3 and os.path.exists(path)
    common.release(table)
    assert not os.path.exists(path)


def test_pipeline_against_brute_force_of_five_words(spark, real):
    """As test_pipeline_against_brute_force, with the links that the stage has to make: two bits of three-word fingerprints, or
    sets of five-word shingles that are alike by 0.8 or more, every pair compared."""
    out = corpus_pipeline.run(spark, FOLDER).toPandas().set_index("doc_id")
    d = real["documents"].toPandas().set_index("doc_id")
    bench = real["benchmark"].toPandas().text.tolist()
    sets = []
    for t in d.text:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    fps = [slow_fingerprint(t) for t in d.text]
    root = list(range(len(d)))
    for a in range(len(d)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2 or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    least = {r: min(i for i, x in zip(d.index, root, strict=True) if x == r) for r in set(root)}
    d = d[[least[r] == i for r, i in zip(root, d.index, strict=True)]]
    d = d[[not any(b in t for b in bench) for t in d.text]]
    assert sorted(out.index) == sorted(d.index)
