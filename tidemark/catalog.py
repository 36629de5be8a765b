"""Catalogued, immutable Parquet files: registration, pruning, revisions, compaction, seals, offload, queries.

A catalog lists every active file of every table with its batch number, its epoch and range, row count and content
digest.  Each version is a file of its own that is made by a rename which never overwrites: of two writers that start
from one version one gets the next, and the other begins again from what the first wrote.  Readers take one version
as their snapshot.  All files are reached through Hadoop's file systems, so the folder may be in any store that Spark
reaches whose rename is atomic.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.quality import content_digest
from tidemark.operators.relational import children_of_winners, latest_revision
from tidemark.storage import Conflict, Folder

#: Slots in an epoch, the unit of partitioning.
EPOCH_SLOTS = 432_000


def epoch_of(slot: int) -> int:
    return slot // EPOCH_SLOTS


#: Seconds for which a retired file stays, at least, so that readers of older snapshots end.
GARBAGE_AGE_S = 600
#: Versions of the catalog that stay beside the newest.
KEPT_VERSIONS = 16


@dataclass(frozen=True)
class File:
    """One folder of Parquet parts: the rows of one table and epoch.  batches are those that it holds, of which batch is
    the newest; remote is where its copy lies once it is offloaded, and path is empty while only that copy exists."""

    path: str
    table: str
    batch: int
    low: int
    high: int
    rows: int
    bytes: int = 0
    digest: str = ""
    batches: tuple[int, ...] = ()
    remote: str = ""


@dataclass(frozen=True)
class Retired:
    path: str
    at: float
    replaced_by: str


@dataclass
class Catalog:
    files: list[File] = field(default_factory=list)
    version: int = 0
    retired: list[Retired] = field(default_factory=list)
    #: Registered batches, as closed ranges: they stay registered when their files are compacted or hold no rows.
    batches: list[tuple[int, int]] = field(default_factory=list)
    #: Facts of each sealed epoch, as a digest.
    seals: dict[int, str] = field(default_factory=dict)

    def has(self, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self.batches)


@dataclass(frozen=True)
class TableSpec:
    """A table's columns, its key, and the column by which files are pruned; a child names its parent and the join columns."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    range_column: str
    parent: str | None = None
    parent_on: tuple[str, ...] = ()
    blooms: tuple[str, ...] = ()  # columns with Bloom filters


class Store(Folder):
    """A folder of catalogued tables."""

    def __init__(self, spark: SparkSession, root: str, tables: Sequence[TableSpec]):
        super().__init__(spark, root)
        self.tables = {t.name: t for t in tables}

    # The catalog's files

    def snapshot(self) -> Catalog:
        names = [n for n in self._names("catalog") if n.endswith(".json")]
        if not names:
            return Catalog()
        got = self._read(f"{self.root}/catalog/{names[-1]}")
        files = [File(**f | {"batches": tuple(f["batches"])}) for f in got["files"]]
        return Catalog(files, got["version"], [Retired(**r) for r in got["retired"]], [tuple(r) for r in got["batches"]], {int(k): v for k, v in got["seals"].items()})

    def change(self, step: Callable[[Catalog], bool | None], tries: int = 50) -> Catalog:
        """Apply step to the newest catalog and make the next version of it; begin again if another writer was first.
        A step that returns False changes nothing."""
        for _ in range(tries):
            catalog = self.snapshot()
            if step(catalog) is False:
                return catalog
            catalog.version += 1
            try:
                self._make(f"{self.root}/catalog/{catalog.version:020d}.json", asdict(catalog))
                return catalog
            except Conflict:
                continue
        raise Conflict(f"{tries} tries")

    # Leases

    @contextmanager
    def lease(self, seconds: float = 3600) -> Iterator[Catalog]:
        """A snapshot whose files stay until the block ends, or the time is over if its driver is lost."""
        path = f"{self.root}/leases/{uuid.uuid4().hex}.json"
        # Registered before the snapshot is taken: what a collector retires later it finds held, whatever the order.
        self._make(path, {"until": time.time() + seconds})
        try:
            yield self.snapshot()
        finally:
            fs, p = self._fs(path)
            fs.delete(p, False)

    def _leased_since(self) -> float | None:
        """When the oldest live lease was taken; leases that are over go."""
        oldest = None
        for name in self._names("leases"):
            path = f"{self.root}/leases/{name}"
            fs, p = self._fs(path)
            try:
                until, taken = self._read(path)["until"], fs.getFileStatus(p).getModificationTime() / 1000
            except Py4JJavaError:  # it ended meanwhile
                continue
            if until < time.time():
                fs.delete(p, False)
            else:
                oldest = taken if oldest is None else min(oldest, taken)
        return oldest

    # Writing

    def publish(self, batch: int, rows: dict[str, DataFrame]) -> None:
        """Register one batch: files per table and epoch, verified by reading back, all in one catalog step.

        Keys must be unique within a batch; a batch that was registered before is left as it is, even if its files were compacted since."""
        if self.snapshot().has(batch):
            return
        added = [f for name, df in rows.items() for f in self._write(name, [batch], df)]

        def step(catalog: Catalog) -> bool | None:
            if catalog.has(batch):
                return False
            catalog.files += added
            catalog.batches = merge_coverage([*catalog.batches, (batch, batch)])
            return None

        registered = self.change(step).files
        # Another writer may have registered the batch first, or registered it before and compacted it since.
        self._delete(f.path for f in added if f not in registered)

    def _facts(self, rows: DataFrame, spec: TableSpec) -> tuple[Column, ...]:
        """Aggregates: rows, and two sums over 64-bit digests of the columns, in which every row and repetition counts, but no order."""
        names = spec.schema.fieldNames()
        sums = (F.sum(F.xxhash64(F.lit(k), *names).cast("decimal(38,0)")) for k in (1, 2))
        return F.count("*").alias("n"), *(x.alias(k) for x, k in zip(sums, ("x", "y"), strict=True))

    def _write(self, name: str, batches: Sequence[int], df: DataFrame, checked: bool = False) -> list[File]:
        spec, batch = self.tables[name], max(batches)
        root = f"{self.root}/{name}/batch={batch}-{uuid.uuid4().hex}"
        seen = Observation()
        rows = df.select(*spec.schema.fieldNames())
        # Sorted inside range partitions: row groups have narrow key ranges, and no global single task is needed.
        epoch = F.floor(F.col(spec.range_column) / EPOCH_SLOTS).cast("long")
        ordered = rows.withColumn("epoch", epoch).repartitionByRange("epoch", spec.range_column, *spec.key).sortWithinPartitions("epoch", spec.range_column, *spec.key)
        # Observed above the exchange: what is below runs a second time to sample the ranges.
        writer = ordered.observe(seen, *self._facts(df, spec)).write.partitionBy("epoch")
        for key, value in PINNED.items():
            writer = writer.option(key, value)
        for column in spec.blooms:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(root)
        said = seen.get
        if not said["n"]:
            return []
        back = self.spark.read.schema(spec.schema).option("basePath", root).parquet(root)
        c = F.col(spec.range_column)
        found = self.spark.read.schema(StructType([*spec.schema.fields]).add("epoch", "long")).parquet(root)
        per = found.groupBy("epoch").agg(F.min(c).alias("low"), F.max(c).alias("high"), *self._facts(found, spec)).orderBy("epoch").collect()
        if any(r["epoch"] is None or r["low"] is None for r in per):
            raise ValueError(f"{name}: {spec.range_column} is null in batch {batch}")
        read = tuple(sum(r[k] for r in per) for k in ("n", "x", "y"))
        # A stage that ran again for a lost executor is observed twice; then the source itself is asked.
        if read != (said["n"], said["x"], said["y"]) and read != tuple(rows.agg(*self._facts(rows, spec)).first()):
            raise ValueError(f"{name}: batch {batch} reads back other than it was written")
        if not checked and (twice := back.groupBy(*spec.key).count().where("count > 1").orderBy(*spec.key).first()):
            raise ValueError(f"{name}: key {tuple(twice)[:-1]} is not unique in batch {batch}")
        made = []
        for r in per:
            path = f"{root}/epoch={r['epoch']}"
            fs, p = self._fs(path)
            made.append(File(path, name, batch, int(r["low"]), int(r["high"]), int(r["n"]), int(fs.getContentSummary(p).getLength()), digest_of(r), tuple(sorted(batches))))
        return made

    # Reading

    def files(self, name: str, low: int | None = None, high: int | None = None, catalog: Catalog | None = None) -> list[File]:
        """Files that may hold rows of [low, high]."""
        files = (catalog or self.snapshot()).files
        return [f for f in files if f.table == name and (low is None or f.high >= low) and (high is None or f.low <= high)]

    def raw(self, name: str, low: int | None = None, high: int | None = None, catalog: Catalog | None = None) -> DataFrame:
        """All revisions, with their batch.  The range filter stands in the scan, below any window."""
        spec, files = self.tables[name], self.files(name, low, high, catalog)
        if not files:
            return self.spark.createDataFrame([], StructType([*spec.schema.fields]).add("batch_id", "long"))
        if away := [f.remote for f in files if not f.path]:
            raise ValueError(f"{name}: {len(away)} files are only offloaded; restore them first: {away[0]}")
        df = self._rows(spec, files)
        if low is not None:
            df = df.where(F.col(spec.range_column) >= low)
        if high is not None:
            df = df.where(F.col(spec.range_column) <= high)
        return df

    def _rows(self, spec: TableSpec, files: Sequence[File]) -> DataFrame:
        batch = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)-", 1).cast("long")
        return self.spark.read.schema(spec.schema).parquet(*(f.path for f in files)).select("*", batch.alias("batch_id"))

    def latest(self, name: str, low: int | None = None, high: int | None = None, catalog: Catalog | None = None) -> DataFrame:
        """The newest revision of each key; of a child table only rows under the winning parent revision."""
        catalog = catalog or self.snapshot()
        spec = self.tables[name]
        rows = latest_revision(self.raw(name, low, high, catalog), spec.key, ["batch_id"])
        if spec.parent:
            rows = children_of_winners(rows, self.latest(spec.parent, low, high, catalog), spec.parent_on)
        return rows.select(*spec.schema.fieldNames())

    def digest(self, catalog: Catalog | None = None) -> str:
        """SHA-256 of the newest revisions of all tables, names and types included: equal for equal content, however it is cut into files."""
        catalog = catalog or self.snapshot()
        each = (content_digest(self.latest(name, catalog=catalog), name, spec.key).first()["digest"] for name, spec in self.tables.items())
        return hashlib.sha256("".join(each).encode()).hexdigest()

    def attach(self, low: int | None = None, high: int | None = None) -> Catalog:
        """Temporary views of all tables, <name> and <name>_raw, over one snapshot."""
        catalog = self.snapshot()
        for name in self.tables:
            self.latest(name, low, high, catalog).createOrReplaceTempView(name)
            self.raw(name, low, high, catalog).createOrReplaceTempView(f"{name}_raw")
        return catalog

    def query(self, sql: str, low: int | None = None, high: int | None = None) -> DataFrame:
        """One read-only statement over the newest revisions, of rows in [low, high] if given."""
        from tidemark.sql import accept

        if low is not None and high is not None and low > high:
            raise ValueError(f"empty range {low}-{high}")
        accept(sql, self.spark, [v for name in self.tables for v in (name, f"{name}_raw")], describing=True)
        self.attach(low, high)
        return self.spark.sql(sql)

    # Maintenance

    def compact(self, name: str, policy: CompactionPolicy | None = None, settled_before: int | None = None) -> int:
        """Rewrite one run of one epoch's files as one; returns how many were replaced (0: nothing to do).  Epochs below
        settled_before get no more files, so their newest ones need not wait."""
        spec, catalog = self.tables[name], self.snapshot()
        by_epoch: dict[int, list[File]] = {}
        for f in self.files(name, catalog=catalog):
            if f.path and not f.remote:
                by_epoch.setdefault(epoch_of(f.low), []).append(f)
        for epoch, files in sorted(by_epoch.items(), reverse=True):
            newest_first = sorted(files, key=lambda f: -f.batch)
            settled = settled_before is not None and epoch < settled_before
            run = select_run([(f.rows, f.bytes) for f in newest_first], policy or CompactionPolicy(), settled)
            if run is None:
                continue
            chosen = newest_first[run[0] : run[1]]
            rows = latest_revision(self._rows(spec, chosen), spec.key, ["batch_id"])
            made = self._write(name, sorted({b for f in chosen for b in f.batches}), rows, checked=True)
            gone = {f.path for f in chosen}

            def step(catalog: Catalog, chosen=chosen, made=made, gone=gone) -> bool | None:
                if not gone <= {f.path for f in catalog.files}:  # another writer replaced some of them
                    return False
                catalog.files = [f for f in catalog.files if f.path not in gone] + made
                catalog.retired += [Retired(f.path, time.time(), made[0].path) for f in chosen]
                return None

            if made[0] not in self.change(step).files:
                self._delete(f.path for f in made)
                return 0
            return len(chosen)
        return 0

    def collect_garbage(self, in_use: Sequence[str] = (), min_age_s: float = 0) -> int:
        """Delete retired files that are old enough, that no reader may hold, and whose replacement is there."""
        catalog, now, since = self.snapshot(), time.time(), self._leased_since()
        active = {f.path for f in catalog.files}

        def free(r: Retired) -> bool:
            # A lease that was taken before the file was retired may read it.
            held = r.path in in_use or (since is not None and since <= r.at + 1)
            return not held and now - r.at >= min_age_s and (r.replaced_by not in active or self._exists(r.replaced_by))

        gone = {r.path for r in catalog.retired if free(r)}
        if not gone:
            return 0

        def step(c: Catalog) -> None:
            c.retired = [r for r in c.retired if r.path not in gone]

        # Out of the catalog first: a lost driver leaves a file too much, never an entry without its file.
        self.change(step)
        self._delete(gone)
        for name in self._names("catalog")[:-KEPT_VERSIONS]:
            self._delete([f"{self.root}/catalog/{name}"])
        return len(gone)

    def maintain(self, policy: CompactionPolicy | None = None, settled_before: int | None = None) -> int:
        """Compact every table as far as the policy goes, then collect garbage of GARBAGE_AGE_S seconds."""
        n = sum(self.compact(name, policy, settled_before) for name in self.tables)
        self.collect_garbage(min_age_s=GARBAGE_AGE_S)
        return n

    def faults(self, watermark: int | None = None, catalog: Catalog | None = None) -> list[tuple[str, str]]:
        """(path, fault) of the active files that hold rows up to the watermark: missing, or other rows than registered.  A
        service starts only on an empty list."""
        out, files = [], [f for f in (catalog or self.snapshot()).files if f.path and (watermark is None or f.low <= watermark)]
        for name, spec in self.tables.items():
            own = [f for f in files if f.table == name]
            there = [f for f in own if self._exists(f.path)]
            out += [(f.path, "missing") for f in own if f not in there]
            if not there:
                continue
            # One job for all files of a table; a folder's last two names tell it from all others.
            rows = self.spark.read.schema(spec.schema).parquet(*(f.path for f in there)).select("*", F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)/[^/]+$", 1).alias("folder"))
            found = {r["folder"]: (int(r["n"]), digest_of(r)) for r in rows.groupBy("folder").agg(*self._facts(rows, spec)).collect()}
            for f in there:
                n, digest = found.get("/".join(f.path.split("/")[-2:]), (0, ""))
                if n != f.rows:
                    out.append((f.path, f"{n} rows instead of {f.rows}"))
                elif digest != f.digest:
                    out.append((f.path, "other content"))
        return out

    def _found(self, path: str, name: str) -> tuple[int, str]:
        spec = self.tables[name]
        rows = self.spark.read.schema(spec.schema).parquet(path)
        r = rows.agg(*self._facts(rows, spec)).first()
        return int(r["n"]), digest_of(r)

    def facts(self, epoch: int, catalog: Catalog | None = None) -> str:
        """Digest of what an epoch holds: tables, batches, rows and content, but not where the files lie or how they are cut."""
        rows: dict[str, list[tuple]] = {}
        for f in (catalog or self.snapshot()).files:
            if epoch_of(f.low) == epoch:
                rows.setdefault(f.table, []).append((f.batches, f.rows, f.digest))
        return hashlib.sha256(json.dumps({k: sorted(v) for k, v in sorted(rows.items())}, separators=(",", ":")).encode()).hexdigest()

    def seal(self, epoch: int, current_slot: int, lag: int, covered: Sequence[tuple[int, int]]) -> str:
        """Seal an epoch that is settled, covered and whole: 'sealed', or 'unchanged' if its facts are those of its seal,
        'waiting' if it is not settled or covered.  Files that do not read back as registered are an error."""
        if epoch not in sealable_epochs(current_slot, lag, covered, []):
            return "waiting"
        catalog = self.snapshot()
        now = self.facts(epoch, catalog)
        if catalog.seals.get(epoch) == now:
            return "unchanged"
        own = replace(catalog, files=[f for f in catalog.files if epoch_of(f.low) == epoch])
        if faults := self.faults(catalog=own):
            raise ValueError(f"epoch {epoch}: {faults[0][0]}: {faults[0][1]}")

        def step(c: Catalog) -> bool | None:
            if self.facts(epoch, c) != now:  # a file came meanwhile
                return False
            c.seals[epoch] = now
            return None

        return "sealed" if self.change(step).seals.get(epoch) == now else "waiting"

    def offload(self, epoch: int, target: str) -> int:
        """Copy a sealed epoch's files below target, prove the copies by their content, and let the local ones go as garbage.
        Returns how many; reads of the epoch are refused until restore()."""
        catalog = self.snapshot()
        if catalog.seals.get(epoch) != self.facts(epoch, catalog):
            raise ValueError(f"epoch {epoch} is not sealed as it is")
        chosen = [f for f in catalog.files if epoch_of(f.low) == epoch and f.path]
        moved = {f.path: replace(f, path="", remote=f.remote or self._copy(f.path, f"{target.rstrip('/')}{f.path.removeprefix(self.root)}", f)) for f in chosen}

        def step(c: Catalog) -> None:
            c.retired += [Retired(f.path, time.time(), moved[f.path].remote) for f in c.files if f.path in moved]
            c.files = [moved.get(f.path, f) if f.path else f for f in c.files]

        self.change(step)
        return len(chosen)

    def restore(self, epoch: int) -> int:
        """Copy an offloaded epoch's files back and prove them; their remote copies stay known."""
        chosen = [f for f in self.snapshot().files if epoch_of(f.low) == epoch and not f.path]
        # The batch number stands in the folder's name.
        back = {f.remote: replace(f, path=self._copy(f.remote, f"{self.root}/{f.table}/batch={f.batch}-{uuid.uuid4().hex}/epoch={epoch}", f)) for f in chosen}

        def step(c: Catalog) -> None:
            c.files = [back.get(f.remote, f) if not f.path else f for f in c.files]

        self.change(step)
        return len(chosen)

    def _copy(self, source: str, target: str, file: File) -> str:
        (a, p), (b, q) = self._fs(source), self._fs(target)
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        b.delete(q, True)  # of a copy that was broken off
        b.mkdirs(q.getParent())
        jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, False, True, conf)
        if self._found(target, file.table) != (file.rows, file.digest):
            b.delete(q, True)
            raise ValueError(f"{target}: the copy differs from {source}")
        return target


#: How published files are written.
PINNED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.block.row.count.limit": "122880", "parquet.writer.version": "v1"}


def digest_of(facts) -> str:
    """The two sums of a table's row digests as text."""
    return ":".join(f"{int(facts[k] or 0) % (1 << 64):016x}" for k in ("x", "y"))


@dataclass(frozen=True)
class CompactionPolicy:
    most_rows: int = 4_000_000
    most_bytes: int = 512 << 20
    head_files: int = 32  # the newest files wait until so many have come
    settled_head_files: int = 2
    inner_files: int = 2


def select_run(newest_first: Sequence[tuple[int, int]], policy: CompactionPolicy = CompactionPolicy(), settled: bool = False) -> tuple[int, int] | None:
    """The first run [i, j) of neighbouring files, newest first, that fits the size limits and is long
    enough: a run that begins at the newest file needs more files than one further in."""
    i = 0
    while i < len(newest_first):
        rows = size = 0
        j = i
        while j < len(newest_first) and rows + newest_first[j][0] <= policy.most_rows and size + newest_first[j][1] <= policy.most_bytes:
            rows, size, j = rows + newest_first[j][0], size + newest_first[j][1], j + 1
        head = policy.settled_head_files if settled else policy.head_files
        if j - i >= (head if i == 0 else policy.inner_files):
            return i, j
        i = max(j, i + 1)
    return None


def sealable_epochs(current_slot: int, lag: int, covered: Sequence[tuple[int, int]], sealed: Sequence[int]) -> list[int]:
    """Epochs that lie `lag` epochs back, are covered whole and are not sealed yet."""
    settled = range(min((epoch_of(a) for a, _ in covered), default=0), epoch_of(current_slot) - lag)
    inside = lambda e: any(a <= e * EPOCH_SLOTS and (e + 1) * EPOCH_SLOTS - 1 <= b for a, b in merge_coverage(covered))
    return [e for e in settled if e not in sealed and inside(e)]


def merge_coverage(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of closed integer ranges; adjacent ones join."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out
