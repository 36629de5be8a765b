"""A folder in any store that Spark reaches, with small JSON files that are made whole and once."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where it is unset, a session whose executors run
    in the driver gets a local folder; any other is refused, as its executors could not see each other's files."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"spark.checkpoint.dir is unset: {spark.sparkContext.master} needs a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of Parquet files in the shared folder: read again, it is the same rows in the same files."""
    path = f"{shared_dir(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Conflict(RuntimeError):
    """Another writer made the file."""


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    def _names(self, folder: str) -> list[str]:
        """Names in a folder below the root, in order."""
        fs, p = self._fs(f"{self.root}/{folder}")
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def _read(self, path: str) -> dict:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, path: str, content: bytes) -> str:
        """Write a small file below the root; gives its path."""
        fs, p = self._fs(f"{self.root}/{path}")
        out = fs.create(p, True)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        return f"{self.root}/{path}"

    def _make(self, path: str, content: dict) -> None:
        """Write beside, then rename without overwriting: the file is there whole, or another's is."""
        fs, tmp = self._fs(f"{self.root}/tmp/{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(content, indent=1).encode()))
        finally:
            out.close()
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        _, target = self._fs(path)
        fs.mkdirs(target.getParent())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), conf).rename(tmp, target, none)
        except Py4JJavaError as e:
            fs.delete(tmp, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(path) from e
            raise

    def _delete(self, paths: Iterable[str]) -> None:
        for path in paths:
            fs, p = self._fs(path)
            fs.delete(p, True)
