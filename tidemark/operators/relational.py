"""Relational helpers: newest revisions, range and as-of joins, islands, nearest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.storage import written


def latest_revision(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of greatest order for each key.  An aggregate, not a window: partial results shrink
    before the shuffle, so a key of very many revisions costs no single task more."""
    rest = [c for c in df.columns if c not in key]
    newest = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return newest.select(*(F.col(c) if c in key else F.col(f"__row.{c}").alias(c) for c in df.columns))


def children_of_winners(children: DataFrame, parents: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows of the winning parent revisions only."""
    return children.join(parents.select(*on).distinct(), list(on), "left_semi")


def qualify(df: DataFrame, rank: Column, keep: int = 1) -> DataFrame:
    """Rows whose window rank is at most keep."""
    return df.withColumn("__rank", rank).where(F.col("__rank") <= keep).drop("__rank")


def range_join(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, width: int, how: str = "inner") -> DataFrame:
    """point BETWEEN low AND high as an equi-join on buckets of the given width, then a residual filter.

    Each interval is listed in the buckets it spans, so choose the width near the usual span: neither
    side is broadcast, and no nested loop arises.  how: inner, or left from the intervals; an interval with a
    null bound has no point, and repeated intervals stay repeated.
    """
    bucket = lambda c: F.expr(f"(`{c}` - pmod(`{c}`, {width})) div {width}")
    left = intervals.withColumn("__b", F.explode(F.sequence(bucket(low), bucket(high))))
    right = points.withColumn("__b", bucket(point))
    inside = F.col(point).between(F.col(low), F.col(high))
    pairs = left.join(right, "__b").where(inside).drop("__b")
    if how == "inner":
        return pairs
    met = left.join(right.select(point, F.col("__b").alias("__c")), (F.col("__b") == F.col("__c")) & inside, "left_semi").drop("__b").distinct()
    met = met.select(*(F.col(c).alias(f"__met_{c}") for c in intervals.columns))
    same = [F.col(c).eqNullSafe(F.col(f"__met_{c}")) for c in intervals.columns]
    return pairs.unionByName(intervals.join(met, same, "left_anti"), allowMissingColumns=True)


def merge_intervals(df: DataFrame, key: Sequence[str], low: str, high: str) -> DataFrame:
    """Union of overlapping or adjacent integer intervals [low, high] for each key."""
    w = Window.partitionBy(*key).orderBy(low, high)
    reach = F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = df.withColumn("__new", (reach.isNull() | (F.col(low) > reach + 1)).cast("int"))
    island = starts.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*key, "__island").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("__island")


def forward_fill(df: DataFrame, key: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """name: the last non-null value up to and including each row."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def last_in_window(df: DataFrame, key: Sequence[str], bucket: Column, order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """For each key and bucket the values of the last row in it."""
    picked = F.max_by(F.struct(*(F.col(c).alias(n) for n, c in values.items())), F.struct(*order))
    return df.groupBy(*key, bucket.alias("bucket")).agg(picked.alias("__row")).select(*key, "bucket", "__row.*")


def previous_bucket(df: DataFrame, key: Sequence[str], bucket: str, step: int, value: str, name: str) -> DataFrame:
    """name: value minus the value one bucket earlier; a gap gives null, as a lag would not."""
    before = df.select(*key, (F.col(bucket) + step).alias(bucket), F.col(value).alias("__before"))
    return df.join(before, [*key, bucket], "left").withColumn(name, F.col(value) - F.col("__before")).drop("__before")


def latest_before(left: DataFrame, right: DataFrame, key: Sequence[str], at: str, then: str, value: str, lookback: int, name: str) -> DataFrame:
    """name: the value of the latest right row with at - lookback <= then < at, for each left row.

    An as-of join as one sort: both sides are unioned per key, and the last right row is carried on.
    """
    null = F.lit(None)
    stamp = right.select(*key, F.col(then).alias("__t"), F.lit(1).alias("__side"), F.struct(F.col(then).alias("t"), F.col(value).alias("v")).alias("__seen"))
    rows = left.select(*key, F.col(at).alias("__t"), F.lit(0).alias("__side"), F.struct(*left.columns).alias("__left"))
    both = rows.unionByName(stamp, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy("__t", "__side", F.col("__seen.v")).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("__seen", ignorenulls=True).over(w)
    out = both.withColumn("__last", last).where("__side = 0")
    held = F.when(F.col("__last.t") >= F.col("__t") - lookback, F.col("__last.v")).otherwise(null)
    return out.select("__left.*", held.alias(name))


def nearest(df: DataFrame, key: Sequence[str], distance: Column, tie: Sequence[str], k: int) -> DataFrame:
    """The k rows of least distance for each key."""
    return qualify(df, F.row_number().over(Window.partitionBy(*key).orderBy(distance, *tie)), k)


def upper_median(value: str) -> Column:
    """The element at index n / 2 of the sorted values, as an aggregate."""
    ordered = F.array_sort(F.collect_list(value))
    return F.element_at(ordered, (F.size(ordered) / 2).cast("int") + 1)


ACCURACY = 10_000  # of approximate percentiles: they are off by n / ACCURACY ranks at most


def order_statistics(df: DataFrame, key: Sequence[str], value: str, share: float, ranks: dict[str, Column]) -> DataFrame:
    """key, n, and by name the value at each rank (1-based, an expression over n near share * n) among the non-null values of each key.

    Exact, and no task holds a key's values: of keys with more than ACCURACY rows approximate percentiles bracket the
    ranks, counts below the bracket say where in it they lie, and only the distinct values inside are sorted."""
    by = ["__all", *key]
    rows = df.where(F.col(value).isNotNull()).select(F.lit(0).alias("__all"), *key, F.col(value).alias("__v"))
    margin = 10.0 / ACCURACY
    steps = F.percentile_approx("__v", [max(0.0, share - margin), min(1.0, share + margin)], ACCURACY)
    total = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"), steps.alias("__steps"))
    few = F.col("n") <= ACCURACY
    bounds = total.select(*by, "n", F.when(few, F.col("__min")).otherwise(F.col("__steps")[0]).alias("__from"), F.when(few, F.col("__max")).otherwise(F.col("__steps")[1]).alias("__to"))
    # Repeated values are one row from here on.
    met = rows.groupBy(*by, "__v").agg(F.count("*").alias("__n")).join(bounds, by)
    below = met.groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col("__v") < F.col("__from"), F.col("__n"))), F.lit(0)).alias("__below"))
    inside = met.where(F.col("__v").between(F.col("__from"), F.col("__to"))).join(below, by)
    reach = F.col("__below") + F.sum("__n").over(Window.partitionBy(*by).orderBy("__v"))
    found = inside.withColumn("__reach", reach)
    values = (F.min(F.when(F.col("__reach") >= rank, F.col("__v"))).alias(name) for name, rank in ranks.items())
    return found.groupBy(*by, "n").agg(*values).drop("__all")


def numbered(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], name: str, count: str | None = None) -> DataFrame:
    """name: the row number (long) of each row among those of its key by order, and count: how many those are.

    A key may hold any share of the rows: they are written sorted by key and order, range by range, so that a row's
    place in its file less that of its key's first row there, and the counts of the files before, make its number."""
    rows = written(df.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order), "sorted")
    rows = rows.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    counts = rows.groupBy("__file", *key).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    every = Window.partitionBy(*key)  # a row for each file that holds the key; file names follow the ranges
    before = F.coalesce(F.sum("__n").over(every.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("__before", before - F.col("__first") + 1).withColumn("__of", F.sum("__n").over(every))
    counts = counts.select(F.col("__file").alias("__own"), "__before", "__of", *(F.col(c).alias(f"__key_{c}") for c in key))
    met = rows.join(counts, [F.col("__file") == F.col("__own"), *(F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in key)])
    out = met.select(*df.columns, (F.col("__at") + F.col("__before")).cast("long").alias(name), "__of")
    return out.withColumnRenamed("__of", count) if count else out.drop("__of")


def ordered_values(value: str, order: Sequence[str]) -> Column:
    """Values of a group as a list ordered by other columns, as an aggregate."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("__v")))), lambda s: s["__v"])


def merge_upsert(new: DataFrame, old: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows and those old rows whose key has no new one; columns by name."""
    ranked = new.withColumn("__rank", F.lit(1)).unionByName(old.withColumn("__rank", F.lit(2)), allowMissingColumns=True)
    columns = [c for c in ranked.columns if c != "__rank"]
    rest = [c for c in columns if c not in key]
    best = ranked.groupBy(*key).agg(F.min_by(F.struct(*rest), "__rank").alias("__row"))
    return best.select(*(F.col(c) if c in key else F.col(f"__row.{c}").alias(c) for c in columns))


def rows_differ(left: DataFrame, right: DataFrame) -> int:
    """Rows that two tables do not share, counted with repetition; 0 for equal multisets.

    One aggregate over both instead of two EXCEPT ALLs: rows are compared by value."""
    tagged = left.withColumn("__n", F.lit(1)).union(right.withColumn("__n", F.lit(-1)))
    counts = tagged.groupBy(*left.columns).agg(F.sum("__n").alias("__n"))
    return counts.agg(F.coalesce(F.sum(F.abs("__n")), F.lit(0))).first()[0]


def finite_or_null(*columns: str) -> Column:
    """True unless one of the columns is NaN or infinite; null counts as fine."""
    out = F.lit(True)
    for c in columns:
        out = out & (F.col(c).isNull() | (~F.isnan(c) & (F.abs(c) < float("inf"))))
    return out


def outside(value: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """True where value lies in none of the half-open ranges; for a short list of ranges."""
    out = F.lit(True)
    for low, high in ranges:
        out = out & ~((value >= low) & (value < high))
    return out
