"""What the operators of this subpackage share: table paths, shared storage, text batches, components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = 1 << 23  # of an Arrow batch on its way to a worker


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where it is unset, a session whose executors run
    in the driver gets a local folder; any other is refused, as its executors could not see each other's files."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is unset: {master} needs a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


#: Folders of the tables that cut() wrote and release() did not delete yet, with their sessions.
_held: dict[str, SparkSession] = {}


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, so a lost
    executor costs no earlier stage, and the scan prunes columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _held[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_cut_path"] = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that cut() wrote and nothing lazy reads any more."""
    for t in tables:
        _delete(t.__dict__["_cut_path"])


def clear() -> None:
    """Delete every table that cut() wrote; call it when the results are consumed.  The driver's exit does it too."""
    for path in list(_held):
        _delete(path)


def _delete(path: str) -> None:
    spark = _held.pop(path, None)
    if spark is not None and spark.sparkContext._jsc is not None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


atexit.register(clear)


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches end at BATCH_BYTES, or where it has a lower limit already; a longer row stands
    alone.  At Spark's 64 MB a task's whole input can be one batch, which the executor holds outside its heap, in buffers of up to
    twice the size, while the worker holds it again and the executor reads what comes back."""
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def free_name(docs: DataFrame, base: str) -> str:
    """base, made longer until no column of docs has that name."""
    taken = {c.lower() for c in docs.columns}
    while base.lower() in taken:
        base += "_"
    return base


def key_bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo modulus; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def text_chunks(texts: pa.Array, max_bytes: int, max_rows: int) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, UTF-8 texts) for slices of at most max_rows rows and about max_bytes bytes;
    a longer text stands alone, whole."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()

    def values(lo: int, hi: int) -> list[bytes | None]:
        return texts.slice(lo, hi - lo).cast(pa.large_binary()).to_pylist()

    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and (held + n > max_bytes or i - start >= max_rows):
            yield start, values(start, i)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, values(start, len(lengths))


def tidy(each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """each, but the worker gives the memory it freed back to the system at the end of the task: workers are
    used again and again, and else keep the most that any task took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from each(batches)
        _power_table.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
            trim(0)

    return run


_BASE = 0x9E3779B97F4A7C15  # odd, so powers of it have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _power_table(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _powers(base: int, n: int) -> np.ndarray:
    return _power_table(base, 1 << n.bit_length())[:n]


def word_hashes(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the slices [lo, hi) of raw bytes, mixed."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)))])
    h = (sums[hi] - sums[lo]) * _powers(_INVERSE, len(raw) + 1)[lo]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass(frozen=True)
class HashFilter:
    """A set of 64-bit hashes by their top log bits (7 at least), of which the 64-bit words that are not zero are kept: a test
    without misses, of at most 2**(log - 3) bytes whatever the set."""

    log: int
    places: np.ndarray
    words: np.ndarray

    @staticmethod
    def of(hashes: DataFrame, log: int) -> HashFilter:
        """The filter of the column hash."""
        word = f"cast(shiftrightunsigned(hash, {64 - log + 6}) as int) as word"
        bit = f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - log}) & 63 as int)) as bit"
        got = hashes.where("hash is not null").selectExpr(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
        return HashFilter(log, got["word"].to_numpy(np.int64), got["bits"].to_numpy(np.int64).view(np.uint64))

    def bitmap(self) -> Callable[[np.ndarray], np.ndarray]:
        """The test of an array of unsigned hashes."""
        bits = np.zeros(1 << (self.log - 6), np.uint64)
        bits[self.places] = self.words
        return lambda h: bits[h >> np.uint64(64 - self.log + 6)] >> (h >> np.uint64(64 - self.log) & np.uint64(63)) & np.uint64(1) > 0


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the smallest node of its
    component.  Alternates large-star and small-star passes; each round is written to the shared
    folder, hubs meet only in min() aggregates and joins that Spark can split.
    """
    e = cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        "edges",
    )

    def mark(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        before, large = e, cut(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(),
            "large-star",
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        e = cut(small, "small-star")
        release(before, large)
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled: every component is a star around its smallest node.
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
