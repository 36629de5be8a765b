"""SimHash near-duplicates over distributed vantage-point trees.

Each distinct text fingerprint is one point of Hamming space.  The driver grows the top of a
vantage-point tree from a bounded sample of points; its leaves are shards.  A point lives in the
shard its distances lead to and is also sent, as a query, to every shard whose region its ball of
`radius` bits can reach by the triangle inequality.  Each shard grows its own tree below that and
compares exactly at the leaves.  So every pair within the radius meets in the home shard of either.
Shards report spanning links only; the components of those are found in Spark.

The pipeline's stage also takes texts as copies whose sets of five-word shingles are at least
SIMILARITY alike.  Those lie up to 20 bits apart, where no tree prunes, so the stage finds candidates by
bands of minimum hashes and compares the shingle sets themselves.

Cases: a null text counts as empty; texts without a word have fingerprint 0 and link like others;
equal fingerprints always link (distance 0); repeated rows stay, each with the same component;
null ids never become a component id unless all ids of the component are null; other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, cut, small_batches, table, text_chunks, tidy

WORDS = 3
RADIUS = 2
SEED = 42
SAMPLE = 8192  # points from which the driver grows the top of the tree
SHARD_POINTS = 8192
LEAF = 64
STAGE_WORDS = 5
SIMILARITY = 0.8  # Jaccard similarity of the sets of STAGE_WORDS shingles from which the stage takes texts as copies
BLOCK = 512  # nodes of a band that are compared in one run with those of another block
SKETCH, MARGIN = 320, 0.15  # minimum hashes that estimate a similarity, and almost seven standard deviations of the estimate
BANDS, ROWS = 40, 8  # a pair at SIMILARITY shares a band with probability 1 - (1 - 0.8**8)**40 = 0.9994

_rng = np.random.default_rng(SEED)
_SLOPE, _SHIFT = _rng.integers(0, 1 << 32, (2, BANDS * ROWS), np.uint32) | np.array([[1], [0]], np.uint32)
_BAND_ODD = _rng.integers(0, 1 << 64, ROWS + 1, np.uint64) | np.uint64(1)


def shingles(text: bytes | None, words: int) -> Iterator[np.ndarray]:
    """Digests of the text's word shingles, as rows of 8 bytes, in bounded blocks; a shorter text is one shingle."""
    parts = (text or b"").lower().split()  # bytes: A-Z only, and \x20 \x09-\x0D only
    if not parts:
        return
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    n = max(1, len(parts) - words + 1)
    first = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    last = ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    for lo in range(0, n, 1 << 15):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(first[lo : lo + (1 << 15)], last[lo : lo + (1 << 15)], strict=True)])
        yield np.frombuffer(raw, np.uint8).reshape(-1, 8)


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """SimHash of the text's word shingles, as an unsigned integer."""
    counts, n = np.zeros(64, np.int64), 0
    for raw in shingles(text, words):
        counts += np.unpackbits(raw, axis=1).sum(0, dtype=np.int64)
        n += len(raw)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            fps = np.fromiter((fingerprint(x.as_py(), words) for x in raw), np.uint64, len(raw)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(tidy(each), "doc_id long, fp long")


def distance(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    # Unsigned: of a negative number bitwise_count counts the absolute value's bits.
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64)).astype(np.int16)


def split(points: np.ndarray, rng: np.random.Generator) -> tuple[int, int] | None:
    """A vantage point and the distance that halves the points best; None if no distance does."""
    best = None
    for v in rng.choice(points, min(8, len(points)), replace=False):
        d = distance(points, v)
        mu = int(np.median(d))
        if mu == d.max():
            mu -= 1
        inside = int((d <= mu).sum())
        if 0 < inside < len(points):
            # Even halves, and few points within reach of the boundary.
            cost = abs(2 * inside - len(points)) + int((np.abs(d - mu) <= RADIUS).sum())
            if best is None or cost < best[0]:
                best = (cost, int(v), mu)
    return best and best[1:]


def grow(sample: np.ndarray, depth: int) -> list:
    """Top of the tree as nested [vantage, mu, inside, outside]; a leaf is its shard number."""
    rng, shards = np.random.default_rng(SEED), iter(range(1 << 30))

    def node(points: np.ndarray, left: int):
        cutter = split(points, rng) if left and len(points) > 2 else None
        if cutter is None:
            return next(shards)
        d = distance(points, np.int64(cutter[0]))
        return [cutter[0], cutter[1], node(points[d <= cutter[1]], left - 1), node(points[d > cutter[1]], left - 1)]

    return node(sample, depth)


def route(tree, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, points, which of them live there) for each shard that points reach."""

    def walk(node, at: np.ndarray, home: np.ndarray):
        if not len(at):
            return
        if isinstance(node, int):
            yield node, at, home
            return
        v, mu, inside, outside = node
        d = distance(points[at], np.int64(v))
        go = d - radius <= mu
        yield from walk(inside, at[go], (home & (d <= mu))[go])
        go = d + radius > mu
        yield from walk(outside, at[go], (home & (d > mu))[go])

    for shard, at, home in walk(tree, np.arange(len(points)), np.ones(len(points), bool)):
        yield shard, points[at], home


def spanning_links(home: np.ndarray, visiting: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions in home ++ visiting) that connect all points of home with every point within the radius of them."""
    points = np.concatenate([home, visiting])
    rng, found = np.random.default_rng(SEED), [np.empty((0, 2), np.int64)]

    def leaf(h: np.ndarray, q: np.ndarray) -> None:
        near = distance(points[h][:, None], points[q][None, :]) <= radius
        first = near.argmax(0)  # all homes near one query are connected through it
        rows, cols = np.nonzero(near)
        pairs = np.unique(rows * np.int64(len(h)) + first[cols])
        found.append(np.stack([h[pairs // len(h)], h[pairs % len(h)]], 1))
        hit = np.flatnonzero(near.any(0))
        found.append(np.stack([q[hit], h[first[hit]]], 1))

    stack = [(np.arange(len(home)), np.arange(len(points)))]
    while stack:
        h, q = stack.pop()
        cutter = split(points[h], rng) if len(h) > LEAF else None
        if cutter is None:
            for lo in range(0, len(h), LEAF):
                for at in range(0, len(q), 1 << 16):
                    leaf(h[lo : lo + LEAF], q[at : at + (1 << 16)])
            continue
        v, mu = np.int64(cutter[0]), cutter[1]
        dh, dq = distance(points[h], v), distance(points[q], v)
        stack.append((h[dh <= mu], q[dq - radius <= mu]))
        stack.append((h[dh > mu], q[dq + radius > mu]))
    links = np.concatenate(found)
    return links[links[:, 0] != links[:, 1]].T


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position that each of n positions is connected with."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def shard_links(points: DataFrame, radius: int = RADIUS, shard_points: int = SHARD_POINTS, sample: int = SAMPLE) -> DataFrame:
    """Spanning links (a, b) of the distinct points fp at most radius bits apart."""
    n = points.count()
    size = max(shard_points, int(16 * n**0.5))  # shards grow with the root of the points, and so does their number
    depth = max(0, int(np.ceil(np.log2(max(1, n / size)))))
    picked = np.array([r[0] for r in points.orderBy(F.xxhash64("fp", F.lit(SEED)), "fp").limit(sample).collect()], np.int64)
    tree = grow(picked, depth) if len(picked) else 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, fps, home in route(tree, batch.column(0).to_numpy(zero_copy_only=False), radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fps), shard, np.int32)), pa.array(fps), pa.array(home)], names=["shard", "fp", "home"]
                )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        home = group["home"].to_numpy()
        fps = group["fp"].to_numpy()
        here, visiting = np.sort(fps[home]), np.sort(fps[~home])
        root = roots(len(fps), *spanning_links(here, visiting, radius))
        points = np.concatenate([here, visiting])
        moved = root != np.arange(len(root))
        return pd.DataFrame({"a": points[moved], "b": points[root[moved]]})

    return points.select("fp").mapInArrow(tidy(deal), "shard int, fp long, home boolean").groupBy("shard").applyInPandas(search, "a long, b long")


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs."""
    rows = cut(fingerprints(docs, id_col, text, words), "fingerprints")
    points = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    found = connected_components(shard_links(points, radius))
    joined = points.join(found, points["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    joined = cut(joined, "rooted")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(joined.join(ids, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: bytes | None, words: int = STAGE_WORDS) -> np.ndarray:
    found = [np.unique(raw.copy().view(np.uint64).ravel()) for raw in shingles(text, words)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def node(text: bytes | None) -> int:
    """Digest of the text's words, as a signed integer."""
    return int.from_bytes(xxhash.xxh64_digest(b" ".join((text or b"").lower().split()), SEED), "big", signed=True)


def least_hashes(members: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minimum hashes of a shingle set; two sets agree in each with the probability of their similarity."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    short = (members >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(short), 512):
        np.minimum(least, (_SLOPE * short[lo : lo + 512, None] + _SHIFT).min(0), out=least)
    return least


def band_keys(members: np.ndarray) -> np.ndarray:
    """BANDS keys of a shingle set; two sets share each with the probability similarity**ROWS."""
    least = least_hashes(members)
    keys = (least.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_ODD[1 : ROWS + 1]).sum(1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _BAND_ODD[0]
    keys ^= keys >> np.uint64(31)
    return (keys * _BAND_ODD[1]).view(np.int64)


def similar_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, points, links): rows has each row's doc_id, text_digest and node, the digest of its words; points has each
    node's least (doc_id, text_digest); links (a, b) connect the nodes within RADIUS bits and those whose shingle sets are
    similar.  Nodes that share a band are connected already or compared exactly: first with the least node of the band, then,
    where that leaves a band with several components, with the nodes of the other components."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch.column(2), 1 << 22, 1024):
                sets = [shingle_set(t) for t in texts]
                keys = np.concatenate([band_keys(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        batch.column(1).slice(start, len(texts)),
                        pa.array([node(t) for t in texts], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(keys)),
                    ],
                    names=["doc_id", "text_digest", "node", "n", "fp", "bands"],
                )

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_chunks(batch.column(0), 1 << 22, 1024):
                sets = [shingle_set(t).view(np.int64) for t in texts]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                columns = [pa.array([node(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "members"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_digest"), F.col("text").cast("string").alias("text"))
    rows = cut(texts.mapInArrow(tidy(each), "doc_id long, text_digest long, node long, n int, fp long, bands array<long>"), "bands")
    own = F.struct("doc_id", "text_digest")
    points = cut(rows.groupBy("node").agg(F.min(own).alias("least"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "points")
    close = connected_components(shard_links(points.select("fp").distinct(), RADIUS)).withColumnRenamed("node", "fp")
    groups = cut(points.join(close, "fp", "left").select("node", F.coalesce("root", "fp").alias("group")), "close-groups")
    heads = groups.groupBy("group").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b <> last")
    within = cut(groups.join(heads, "group").select(F.col("node").alias("a"), "b").where("a <> b"), "close-links")
    keys = points.select("node", "n", F.explode("bands").alias("key"))
    bands = keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lead"), F.max("node").alias("last")).where("lead.node <> last")
    shared = cut(keys.join(bands.select("key", "lead"), "key"), "shared-bands")

    wanted = shared.select("node").distinct().join(points, "node").select("node", "least.*")
    held = texts.join(wanted.select("doc_id", "text_digest").distinct(), ["doc_id", "text_digest"], "left_semi").select("text")
    sets = held.mapInArrow(tidy(sets_of), "node long, members array<long>").dropDuplicates(["node"])
    sets = cut(sets.join(wanted.select("node"), "node", "left_semi"), "shingle-sets")

    head = within.withColumnRenamed("a", "node").withColumnRenamed("b", "head")
    led = shared.join(head, "node", "left").select(F.col("node").alias("a"), "head", F.col("n").alias("na"), F.col("lead.node").alias("b"), F.col("lead.n").alias("nb"))
    led = led.where("(head is null or head <> b) and a <> b").where(F.least("na", "nb") >= F.greatest("na", "nb") * SIMILARITY).select("a", "b").distinct()
    both = led.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
    met = F.size(F.array_intersect("x", "y"))
    alike = cut(both.where(met >= SIMILARITY * (F.size("x") + F.size("y") - met)).select("a", "b"), "led-links")
    links = cut(within.unionByName(alike), "links")
    found = connected_components(links).withColumnRenamed("root", "found")
    marked = cut(shared.join(found, "node", "left").select("key", "node", F.coalesce("found", "node").alias("root")), "marked-bands")
    sizes = marked.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).where("low <> high")
    sizes = sizes.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    return rows.select("doc_id", "text_digest", "node"), points.select("node", "least"), links.unionByName(links_in_bands(marked.join(sizes, "key"), sets))


def links_in_bands(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is similar among the nodes (key, node, root, blocks) of each band; nodes of one root
    are connected.  A band is cut into blocks of about BLOCK nodes, and each pair of blocks is a run of its own: a task
    holds the shingle sets of one run, compares them inside numpy and gives spanning links only."""
    dealt = mixed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "root").join(sets, "node")
    run = ["key", "lo", "hi"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by run; the last run of a batch waits for the next.
        held: pa.Table | None = None

        def flush(rows: pa.Table) -> pa.RecordBatch:
            node, root, members = rows["node"].to_numpy(), rows["root"].to_numpy(), rows["members"].combine_chunks()
            values, ends = members.flatten().to_numpy(), members.offsets.to_numpy() - members.offsets[0].as_py()
            edges = np.concatenate([[0], np.flatnonzero(run_changes(rows)) + 1, [len(node)]])
            found = [np.empty((0, 2), np.int64)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                pairs = similar_pairs([values[ends[i] : ends[i + 1]] for i in range(lo, hi)], root[lo:hi])
                found.append(node[lo:hi][np.array(pairs, np.int64).reshape(-1, 2)])
            a, b = np.concatenate(found).T
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def run_changes(rows: pa.Table) -> np.ndarray:
            columns = [rows[k].to_numpy() for k in run]
            return np.any([c[1:] != c[:-1] for c in columns], axis=0)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            edge = np.flatnonzero(run_changes(rows))
            if not len(edge):
                held = rows
                continue
            yield flush(rows.slice(0, edge[-1] + 1))
            held = rows.slice(edge[-1] + 1)
        if held is not None and held.num_rows:
            yield flush(held)

    dealt = dealt.select(*run, "node", "root", "members").repartition(*run).sortWithinPartitions(*run, "node")
    return cut(dealt.mapInArrow(tidy(compare), "a long, b long"), "mixed-links")


def similar_pairs(sets: list[np.ndarray], root: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (i, j) of sets of at least SIMILARITY that connect all those of different roots which are similar.  Equal
    sets of SKETCH minimum hashes estimate the similarity; those that lie MARGIN below it at most are compared exactly."""
    size = np.array([len(s) for s in sets])
    sketch = np.stack([least_hashes(s.view(np.uint64))[:SKETCH] for s in sets])
    _, top = np.unique(root, return_inverse=True)
    top = top.copy()
    out = []
    for i in range(1, len(sets)):
        near = (sketch[:i] == sketch[i]).mean(1)
        near[(top[:i] == top[i]) | (np.minimum(size[:i], size[i]) < SIMILARITY * np.maximum(size[:i], size[i]))] = 0
        for j in np.argsort(-near, kind="stable").tolist():
            if near[j] < SIMILARITY - MARGIN:
                break
            if top[i] == top[j]:
                continue
            met = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if met >= SIMILARITY * (size[i] + size[j] - met):
                out.append((j, i))
                top[top == top[j]] = top[i]
    return out


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, text_digest, kept) of every distinct pair of doc_id and text_digest in docs, over links of close fingerprints and
    of similar shingle sets; kept is true for one pair of each component, that of the smallest doc_id."""
    rows, points, links = similar_links(docs)
    found = connected_components(links)
    joined = points.join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    joined = cut(joined, "rooted")
    ids = joined.groupBy("root").agg(F.min("least").alias("chosen"))
    named = cut(joined.join(ids, "root").select("node", "chosen"), "named")
    joined = rows.distinct().join(named, "node")
    return joined.select("doc_id", "text_digest", (F.struct("doc_id", "text_digest") == F.col("chosen")).alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close or similar texts: the one with the smallest doc_id, of rows that repeat its id and text
    the least in column order.  Rows are told apart by id and text, so a doc_id may stand for several texts.  Rows without an id
    can't be named by a component and stay."""
    del sf_dir
    small_batches(spark)
    # One column holds the row, so that no name of the input can clash with the names here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("digest"))
    kept = similar_components(docs.where("doc_id is not null")).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_digest").alias("kept_digest"))
    out = rows.join(kept, (F.col("id") == F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")), "left_semi")
    out = out.groupBy("id", "digest").agg(F.min("row").alias("row")).select("row.*")
    return out.unionByName(docs.where("doc_id is null"))
