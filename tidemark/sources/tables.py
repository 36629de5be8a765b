"""Readers: Parquet tables and file lists, typed CSV, JSON arrays, NDJSON, zipped CSV."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: JSON objects beyond this many characters are refused by the typed JSON readers.
LONGEST_OBJECT = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parquet_files(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """An explicit list of files, merged by column name, with file_path; no files give a typed empty table."""
    if not paths:
        return empty(spark, schema).withColumn("file_path", F.lit(None).cast("string"))
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    df = df.select("*", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("file_path"))
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def numbered_rows(spark: SparkSession, path: str) -> DataFrame:
    """One Parquet file with the physical row number."""
    return spark.read.parquet(path).select("*", F.col("_metadata.row_index").alias("file_row_number"))


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def csv(spark: SparkSession, path: str | list[str], schema: StructType | None, header: bool = True) -> DataFrame:
    """Typed CSV, gzip by suffix; a bad cell fails the read.  Without a schema the types are inferred."""
    reader = spark.read.option("header", header).option("quote", '"').option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def json_array(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Files that hold one JSON array (or object) each."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("maxStringLen", LONGEST_OBJECT).json(path)


def ndjson(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def ndjson_with_quarantine(spark: SparkSession, path: str | list[str], schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines with their file): one bad line withholds its whole file."""
    wide = StructType([*schema.fields]).add("_corrupt_record", "string")
    lines = spark.read.text(path).where("trim(value) <> ''").select("value", F.input_file_name().alias("file_path"))
    raw = lines.select("file_path", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("file_path", "r.*")
    bad = raw.where("_corrupt_record is not null").select("file_path", "_corrupt_record")
    good = raw.where("_corrupt_record is null").drop("_corrupt_record").join(bad.select("file_path").distinct(), "file_path", "left_anti")
    return good, bad


def zipped_csv(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True) -> DataFrame:
    """Zip files that hold one CSV each; a file is read by one task, in pieces."""
    names = [f.name for f in schema.fields]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    members = [m for m in z.namelist() if not m.endswith("/")]
                    if len(members) != 1:
                        raise ValueError(f"expected one member, found {members}")
                    with z.open(members[0]) as f:
                        for part in pd.read_csv(f, dtype=str, names=names, header=0 if header else None, chunksize=100_000, keep_default_na=False):
                            yield part

    files = spark.read.format("binaryFile").load(path).select("content")
    text = files.mapInPandas(each, ", ".join(f"`{n}` string" for n in names))
    return text.select(*(F.when(F.col(f.name) != "", F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields))


def lz4_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file_path) of the lines of text files in lz4 frames; a file is read by one task, in pieces."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, name in zip(batch.column(0), batch.column(1), strict=True):
                with pa.CompressedInputStream(pa.BufferReader(content.as_buffer()), "lz4") as stream:
                    rest = b""
                    while piece := stream.read(1 << 22):
                        *lines, rest = (rest + piece).split(b"\n")
                        yield _lines(lines, name.as_py())
                    if rest:
                        yield _lines([rest], name.as_py())

    files = spark.read.format("binaryFile").load(path).select("content", "path")
    return files.mapInArrow(each, "value string, file_path string")


def _lines(lines: list[bytes], name: str) -> pa.RecordBatch:
    text = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines]
    return pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array([name] * len(text), pa.string())], names=["value", "file_path"])


def lz4_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Typed CSV without a header in lz4 frames."""
    row = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), {"mode": "FAILFAST"})
    return lz4_lines(spark, path).where("value <> ''").select(row.alias("r")).select("r.*")


def lz4_json(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Typed JSON lines in lz4 frames."""
    return lz4_lines(spark, path).where("value <> ''").select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def probe(spark: SparkSession, sql: str) -> DataFrame:
    """(place, name, type) of the columns of a query, which is analysed and not run."""
    fields = spark.sql(sql).schema.fields
    return spark.createDataFrame([(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], "place long, name string, type string")


def verified_csv(df: DataFrame, path: str) -> int:
    """Write CSV with a header and quoted texts, read it back, and compare header, count and rows as text; gives the count."""
    texts = df.select(*(F.col(c).cast("string") for c in df.columns))
    texts.write.option("header", True).option("quoteAll", True).option("nullValue", None).option("emptyValue", "").mode("errorifexists").csv(path)
    back = df.sparkSession.read.option("header", True).option("quote", '"').option("mode", "FAILFAST").csv(path)
    if back.columns != df.columns:
        raise ValueError(f"{path}: header {back.columns} instead of {df.columns}")
    same = lambda x: x.select(F.xxhash64(*(F.coalesce(F.col(c), F.lit("")) for c in df.columns)).alias("h")).agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    if tuple(same(back)) != tuple(same(texts)):
        raise ValueError(f"{path}: rows differ after reading back")
    return same(back)[0]


def json_rows(spark: SparkSession, parameter: str, schema: StructType) -> DataFrame:
    """A JSON array given as text, as a table."""
    one = spark.createDataFrame([(parameter,)], "j string")
    return one.select(F.inline(F.from_json("j", f"array<{schema.simpleString()}>")))
