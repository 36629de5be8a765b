"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors.  Each vector is described by its
PREFIX nearest pivots in order of nearness.  The inverted lists are kept by pairs of pivots: two
vectors that share at least two of their pivots meet in the list of the two smallest shared ones,
which alone counts the pair, after a check of the shared-pivot count and the exact cosine in double
precision.  Lists beyond BLOCK vectors are cut into blocks, and each pair of blocks is a task of its
own: no list is capped.  Equal vectors are one point with a multiplicity.

Sizes: pivots are 2 * sqrt(points), between 64 and 4096, taken in order of a hash of the point.

Cases: null, empty and zero vectors, vectors with null or non-finite components, and vectors with a
null label link with nothing (n_links 0, their own component, kept); vectors of different length are
never compared; repeated rows link with each other like any equal vectors; a null id takes part in
n_links of others, and is a component id only if all ids of the component are null; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import connected_components, cut, table, tidy
from tidemark.llm.simhash import roots

COSINE = 0.98
PREFIX = 5
SHARED = 2
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
BLOCK = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision at length 1; scaled first, so that no square overflows or vanishes."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def permutation_prefix(vectors: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The nearest pivots of each unit vector, nearest first."""
    near = vectors @ pivots.T
    k = min(prefix, len(pivots))
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
    return np.take_along_axis(top, order, 1).astype(np.int32)


def owned(si: np.ndarray, sj: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which pairs of vectors with the sorted prefixes si, sj share at least SHARED pivots, the two smallest being p, q:
    those pairs are counted in the list of p, q and in no other."""
    common = (si[:, :, None] == sj[:, None, :]).any(2)
    rows = np.arange(len(si))
    first = common.argmax(1)
    rest = common.copy()
    rest[rows, first] = False
    second = rest.argmax(1)
    return (common.sum(1) >= SHARED) & (si[rows, first] == p) & (si[rows, second] == q)


def links_in_runs(x: np.ndarray, sorted_prefix: np.ndarray, p: np.ndarray, q: np.ndarray, block: np.ndarray, lo: np.ndarray, hi: np.ndarray, starts: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked positions (i, j) among consecutive runs of vectors, each run a list or a pair of its blocks."""
    n = len(x)
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    size = end - np.repeat(starts, np.diff(np.append(starts, n)))
    across = lo != hi  # in a pair of different blocks only pairs across count
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        own = (~across[i] | (block[i] != block[j]))
        i, j = i[own], j[own]
        own = owned(sorted_prefix[i], sorted_prefix[j], p[i], q[i])
        found.append((i[own], j[own]))

    small = np.flatnonzero(size <= 64)
    for step in range(1, 64):
        i = small = small[small + step < end[small]]
        if not len(i):
            break
        near = np.einsum("ij,ij->i", x[i], x[i + step]) >= cosine
        keep(i[near], i[near] + step)
    for s, e in zip(starts, np.append(starts[1:], n), strict=True):
        if e - s > 64:
            for at in range(s, e, 256):
                i, j = np.nonzero(x[at : min(at + 256, e)] @ x[s:e].T >= cosine)
                i, j = i + at, j + s
                keep(i[i < j], j[i < j])
    return np.concatenate([f[0] for f in found] or [np.empty(0, int)]), np.concatenate([f[1] for f in found] or [np.empty(0, int)])


def linked(points: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(gid, root, links) partial results: links counts partners with their multiplicity, and each row's
    gid and root are connected.  points: gid, label, v (array of double), n (multiplicity)."""
    total = points.count()
    m = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, 2 * total**0.5)))
    pivots: dict[int, np.ndarray] = {}
    for (width,) in points.select(F.size("v")).distinct().collect():
        picked = points.where(F.size("v") == width).orderBy(F.xxhash64("v"), "gid").limit(m).select("v").collect()
        pivots[width] = unit(np.array([r[0] for r in picked]))
    shared = points.sparkSession.sparkContext.broadcast(pivots)  # MOST_PIVOTS vectors at most

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = batch.column(0).flatten().to_numpy(), np.diff(batch.column(0).offsets.to_numpy())
            starts = np.concatenate([[0], np.cumsum(sizes)])
            out: list = [None] * len(sizes)
            for width in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == width)
                x = unit(flat[starts[rows][:, None] + np.arange(width)])
                for lo in range(0, len(rows), 4096):
                    for r, p in zip(rows[lo : lo + 4096], permutation_prefix(x[lo : lo + 4096], shared.value[width]), strict=True):
                        out[r] = p
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "prefix"])

    described = points.select("v", "gid", "label", "n")
    described = described.mapInArrow(tidy(describe), f"v {points.schema['v'].dataType.simpleString()}, gid long, label string, n long, prefix array<int>")
    pairs = F.array(*(F.struct(F.get("sorted", a).alias("p"), F.get("sorted", b).alias("q")) for a, b in combinations(range(PREFIX), 2)))
    described = described.withColumn("sorted", F.array_sort("prefix"))
    described = cut(described.select("gid", "label", "n", "v", "sorted", F.size("v").alias("width")), "prefixes")
    # A length that fewer vectors than PREFIX have has shorter prefixes.
    listed = described.withColumn("pair", F.explode(pairs)).where("pair.p is not null and pair.q is not null")
    # The lists hold ids; a vector moves once to meet those, and then only to the lists where it has a partner.
    listed = listed.select("gid", "label", "width", "pair.p", "pair.q")

    key = ["label", "width", "p", "q"]
    long = listed.select(*key).groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > 1)
    long = cut(long.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size"), "lists")
    # A vector alone in a list has no partner there.
    dealt = listed.join(long, key).withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select(*key, "gid", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    dealt = dealt.join(described.select("gid", "n", "v", "sorted"), "gid")

    order = [*key, "lo", "hi"]
    names = [*order, "gid", "n", "block", "v", "sorted"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by run; the last run of a batch waits for the next, and has two blocks at most.
        held: pa.Table | None = None

        def flush(rows: pa.Table) -> pa.RecordBatch:
            col = {k: rows[k].to_numpy() for k in ("width", "p", "q", "lo", "hi", "gid", "n", "block")}
            n = rows.num_rows
            change = np.ones(n, bool)
            change[1:] = _changes(rows, order)
            starts = np.flatnonzero(change)
            found_i, found_j = [], []
            sorted_prefix = np.full((n, PREFIX), -1, np.int32)
            flat = rows["sorted"].combine_chunks()
            length = np.diff(flat.offsets.to_numpy())
            for k in range(PREFIX):  # a shorter prefix is filled up with numbers that no other row has
                has = length > k
                sorted_prefix[has, k] = flat.flatten().to_numpy()[(flat.offsets.to_numpy()[:-1] - flat.offsets[0].as_py())[has] + k]
                sorted_prefix[~has, k] = -1 - np.flatnonzero(~has)
            vectors = rows["v"].combine_chunks()
            values, offsets = vectors.flatten().to_numpy(), vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            for width in np.unique(col["width"]).tolist():
                at = np.flatnonzero(col["width"] == width)
                x = unit(values[offsets[:-1][at][:, None] + np.arange(width)])
                own = np.flatnonzero(change[at])
                i, j = links_in_runs(x, sorted_prefix[at], *(col[k][at] for k in ("p", "q", "block", "lo", "hi")), own, cosine)
                found_i.append(at[i])
                found_j.append(at[j])
            i, j = np.concatenate(found_i or [[]]).astype(int), np.concatenate(found_j or [[]]).astype(int)
            links = np.zeros(n, np.int64)
            np.add.at(links, i, col["n"][j])
            np.add.at(links, j, col["n"][i])
            root = roots(n, i, j)
            hit = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays([pa.array(col["gid"][hit]), pa.array(col["gid"][root[hit]]), pa.array(links[hit])], names=["gid", "root", "links"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            edge = np.flatnonzero(_changes(rows, order))
            if not len(edge):
                held = rows
                continue
            yield flush(rows.slice(0, edge[-1] + 1))
            held = rows.slice(edge[-1] + 1)
        if held is not None and held.num_rows:
            yield flush(held)

    dealt = dealt.select(*names)
    dealt = dealt.repartition(*order).sortWithinPartitions(*order, "gid")
    return dealt.mapInArrow(tidy(verify), "gid long, root long, links long")


def _changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a row differs in the keys from the one before, from the second row on."""
    out = np.zeros(max(0, rows.num_rows - 1), bool)
    for k in keys:
        c = rows[k].combine_chunks()
        values = c.dictionary_encode().indices.to_numpy() if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c.to_numpy()
        out |= values[1:] != values[:-1]
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    # Single-precision components stay so while they move; they are compared in double precision.
    single = vectors.schema[vector].dataType == T.ArrayType(T.FloatType(), vectors.schema[vector].dataType.containsNull)
    v = F.col(vector) if single else F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0)
    usable = F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.col(label).isNotNull(), F.lit(False))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(usable, v).alias("v"),
        F.when(usable, F.col(label).cast("string")).alias("label"),
    )
    rows = cut(rows.withColumn("digest", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws("|", "label", text_of("v")), 256))), "vectors")
    points = rows.where("digest is not null").groupBy("digest").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count("*").alias("n"))
    points = cut(points.withColumn("gid", F.monotonically_increasing_id()), "points")
    found = cut(linked(points.select("gid", "label", "v", "n"), cosine), "links")
    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    rooted = connected_components(found.select(F.col("gid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "gid")
    merged = points.select("gid", "digest", "least", "n").join(links, "gid", "left").join(rooted, "gid", "left")
    merged = cut(merged.select("digest", "least", F.coalesce("root", "gid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "merged")
    ids = merged.groupBy("root").agg(F.min("least").alias("component"))
    named = cut(merged.join(ids, "root").select("digest", "n_links", "component"), "components")
    usable_rows = rows.where("digest is not null").select("vec_id", "digest").join(named, "digest").select("vec_id", "n_links", F.col("component").alias("component_id"))
    others = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable_rows.unionByName(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def text_of(v: str):
    """A text that is equal for equal vectors; + 0.0 turns -0.0 into 0.0."""
    return F.array_join(F.transform(F.col(v), lambda x: (x + F.lit(0.0)).cast("string")), ",")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_sql() -> str:
    """Links and components in DuckDB SQL, by comparing all pairs of a label."""
    return f"""
WITH RECURSIVE rows AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
scaled AS (
  SELECT r, label, list_transform(e, lambda x: x / m) AS e FROM (
    SELECT *, list_max(list_transform(e, lambda x: abs(x))) AS m FROM rows
    WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  ) WHERE m > 0
),
unit AS MATERIALIZED (SELECT r, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM scaled),
links AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM unit a JOIN unit b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r AND list_dot_product(a.e, b.e) >= {COSINE}),
reach(r, s) AS (SELECT r, r FROM rows UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.s = links.a),
roots AS (SELECT reach.r, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.s GROUP BY reach.r),
counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM rows JOIN roots USING (r) LEFT JOIN counts USING (r)"""
