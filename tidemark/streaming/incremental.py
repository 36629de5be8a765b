"""Incremental runs on Structured Streaming, with results equal to the batch form."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.relational import latest_revision, merge_upsert
from tidemark.storage import Conflict, Folder, shared_dir


def state_dir(spark: SparkSession) -> str:
    """A new folder for checkpoints and state in the shared one."""
    return f"{shared_dir(spark)}/tidemark-stream/{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000, newest_first: bool = False) -> DataFrame:
    """Parquet files as they appear, in bounded micro-batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("latestFirst", newest_first).parquet(path)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand all available micro-batches to each(batch, number); a rerun repeats a batch under its old number."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def hourly_totals(events: DataFrame, lateness: str | None = "2 hours") -> DataFrame:
    """Tumbling hours of an event stream (ts, event_type, value); an hour closes `lateness` after its end, or never
    if that is None: then rows in any order count, and the state holds all hours."""
    # The watermark needs an instant; a time without zone counts as UTC.
    at = F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    rows = events.withColumn("at", at)
    if lateness is not None:
        rows = rows.withWatermark("at", lateness)
    return rows.groupBy(F.window("at", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


class PeriodStore(Folder):
    """One Parquet folder per period; a period is rewritten while open, and each write is a new version
    that a file of its own names, so readers never see half a write, writers that meet take turns, and a new driver
    finds what the last one left."""

    def _newest(self, period: str) -> tuple[int, str | None]:
        names = self._names(f"versions/{period}")
        return (int(names[-1].removesuffix(".json")), self._read(f"{self.root}/versions/{period}/{names[-1]}")["path"]) if names else (0, None)

    def read(self, period: str) -> DataFrame | None:
        path = self._newest(period)[1]
        return self.spark.read.parquet(path) if path else None

    def merge(self, period: str, new: DataFrame, key: Sequence[str]) -> None:
        """Newest copy wins: rows of new replace the held rows of their keys."""
        while True:
            version, held = self._newest(period)
            path = f"{self.root}/period={period}/{uuid.uuid4().hex}"
            (merge_upsert(new, self.spark.read.parquet(held), key) if held else new).write.parquet(path)
            try:
                self._make(f"{self.root}/versions/{period}/{version + 1:012d}.json", {"path": path})
                return
            except Conflict:  # another writer was first: merge into what it wrote
                self._delete([path])

    def all(self, schema: StructType) -> DataFrame:
        paths = [path for period in self._names("versions") if (path := self._newest(period)[1])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


class DeltaLog(Folder):
    """Rows that micro-batches add, each written once under the batch's number, in a log that survives the driver.

    A batch costs what it holds: it is a new folder beside the others, and after `fold` of them they are made one by
    the function that says what stays.  The newest commit file names the folders and the last batch; a batch that
    is repeated after a restart finds itself done."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, folded: Callable[[DataFrame], DataFrame], fold: int = 16):
        super().__init__(spark, root)
        self.schema, self.folded, self.fold = schema, folded, fold

    def _state(self) -> tuple[int, list[str]]:
        names = self._names("commits")
        if not names:
            return -1, []
        return int(names[-1].removesuffix(".json")), self._read(f"{self.root}/commits/{names[-1]}")["paths"]

    @property
    def done(self) -> int:
        return self._state()[0]

    def rows(self) -> DataFrame:
        paths = self._state()[1]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def commit(self, rows: DataFrame, number: int) -> bool:
        """Add the rows of batch number; False if it is done already."""
        done, paths = self._state()
        if number <= done:
            return False
        path = f"{self.root}/rows/{number}-{uuid.uuid4().hex}"
        rows = rows.select(*self.schema.fieldNames())
        if len(paths) + 1 >= self.fold:
            rows, paths = self.folded(self.rows().unionByName(rows)).select(*self.schema.fieldNames()), []
        rows.write.parquet(path)
        try:
            self._make(f"{self.root}/commits/{number:012d}.json", {"paths": [*paths, path]})
            return True
        except Conflict:
            self._delete([path])
            return False


class RevisionState(DeltaLog):
    """The known revision of each key: (key, hash, at) as a log of deltas.

    verdicts() tells new, changed, unchanged and older rows apart; commit() moves the state on."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], schema: StructType, fold: int = 16):
        self.key = list(key)
        super().__init__(spark, root, schema, lambda rows: latest_revision(rows, self.key, ["at", "hash"]), fold)

    def known(self) -> DataFrame:
        return self.folded(self.rows())

    def verdicts(self, batch: DataFrame) -> DataFrame:
        newest = latest_revision(batch, self.key, ["at", "hash"])
        # Only the batch's keys are looked up in the log.
        held = self.folded(self.rows().join(newest.select(*self.key), self.key, "left_semi"))
        known = held.select(*self.key, F.col("hash").alias("__hash"), F.col("at").alias("__at"))
        rows = newest.join(known, self.key, "left")
        verdict = F.expr("case when __hash is null then 'new' when at < __at then 'older' when hash = __hash then 'unchanged' else 'changed' end")
        return rows.withColumn("verdict", verdict).drop("__hash", "__at")


class Lanes(Folder):
    """Two lanes over a range of positions that publish into one place: the tail, which follows the head upwards, and
    the history, which walks downwards in resumable segments.

    A lane's mark moves only after a range is published and found valid, in one file that a new driver reads.  The tail
    reads `overlap` positions again below its mark, so rows that came late there are published too: what
    publishes must be repeatable, newest copy wins.  The history keeps the segments [low, high] that it has still to walk, newest
    first; when the tail begins anew above a gap, the gap is a new segment that reaches `overlap` into the one below."""

    def __init__(self, spark: SparkSession, root: str, step: int, overlap: int = 0, floor: int = 0):
        super().__init__(spark, root)
        self.step, self.overlap, self.floor = step, overlap, floor

    def state(self) -> tuple[int, int | None, list[tuple[int, int]]]:
        """(version, tail mark, segments to walk)"""
        names = self._names("lanes")
        if not names:
            return 0, None, []
        got = self._read(f"{self.root}/lanes/{names[-1]}")
        return int(names[-1].removesuffix(".json")), got["mark"], [tuple(s) for s in got["segments"]]

    def _move(self, version: int, mark: int | None, segments: Sequence[tuple[int, int]]) -> None:
        self._make(f"{self.root}/lanes/{version + 1:012d}.json", {"mark": mark, "segments": [list(s) for s in segments]})

    def begin(self, head: int) -> None:
        """Follow from head on.  What lies below, down to the last mark or the floor, is the history's newest segment."""
        version, mark, segments = self.state()
        low = self.floor if mark is None else max(self.floor, mark + 1 - self.overlap)
        if mark is None or head > mark + self.step:
            self._move(version, head, [*([(low, head)] if low <= head else []), *segments])

    def tail(self, head: int, publish: Callable[[int, int], bool]) -> bool:
        """One step of the tail towards head: publish(low, high) reads, publishes and validates; True if the mark moved."""
        version, mark, segments = self.state()
        if mark is None:
            raise ValueError("begin() sets where the tail follows from")
        high = min(head, mark + self.step)
        if high <= mark or not publish(max(self.floor, mark + 1 - self.overlap), high):
            return False
        self._move(version, high, segments)
        return True

    def history(self, publish: Callable[[int, int], bool]) -> bool:
        """One step down the newest segment; True if it moved."""
        version, mark, segments = self.state()
        if not segments:
            return False
        (low, high), *rest = segments
        start = max(low, high - self.step + 1)
        if not publish(start, high):
            return False
        self._move(version, mark, [*([(low, start - 1)] if start > low else []), *rest])
        return True
