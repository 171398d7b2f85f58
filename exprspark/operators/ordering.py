"""Ranks, adjusted p-values and exact quantiles that need a total order within a group.

A plain window over one contrast or one sample would sort that whole group in a single task. Here a group is first
reduced to its distinct values, these are dealt to ranges of bounded size in order of group and value, and only tables
with one row per group and range are windowed over whole groups. The way is the same at every size and for every type
that Spark can order; values are never converted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exprspark.session import Workspace



def is_value(df: DataFrame, value: str) -> Column:
    """Whether a row has a value to rank: neither NULL nor, in floating columns, NaN."""
    known = F.col(value).isNotNull()
    return known & ~F.isnan(value) if dict(df.dtypes)[value] in ("double", "float") else known


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by columns of the same names, NULL keys matching each other; the keys come once, from the left."""
    names = {k: f"{k}__other" for k in keys}
    renamed = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(renamed, same, how).drop(*names.values())


def ordered_counts(df: DataFrame, value: str, by: list[str], rows_per_range: int | None = None) -> DataFrame:
    """Distinct values per group as ``by + (value, n, upto, total, value_range)``.

    ``n`` rows share the value, ``upto`` rows are less or equal, ``total`` rows are in the group. NULL and NaN are no
    values. The ranges are written with their numbers, so that every use sees the same ones. Spark's shuffle decides
    how many ranges there are, from its partition count and the size it wants of a partition; ``rows_per_range`` sets
    their size, at the cost of a count.
    """
    space = Workspace(df.sparkSession, "ordered")
    distinct = df.filter(is_value(df, value)).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    order = [*by, value]
    dealt = distinct.repartitionByRange(max(1, -(-distinct.count() // rows_per_range)), *order) if rows_per_range else distinct.repartitionByRange(*order)
    cut = space.save(dealt.withColumn("value_range", F.spark_partition_id().cast("long")), "ranges")
    keys = [*by, "value_range"]
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("value_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*keys).agg(F.sum("n").alias("in_range")).select(
        *keys, F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("before"), F.sum("in_range").over(group).alias("total")
    )
    inside = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_on(cut.withColumn("inside", F.sum("n").over(inside)), sums, keys)
    return joined.select(*by, value, "n", (F.col("before") + F.col("inside")).alias("upto"), "total", "value_range")


def adjust_p(
    df: DataFrame,
    p: str = "pvalue",
    by: list[str] | None = None,
    out: str = "padj",
    rows_per_range: int | None = None,
) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values within each group; NULL and NaN p-values stay out and get NULL.

    Tied p-values share the smallest of their ``total * p / rank``, reached at the last tied rank, so the
    work runs over distinct p-values and is joined back.
    """
    by = by or []
    ranked = ordered_counts(df, p, by, rows_per_range)
    ranked = ranked.withColumn("step", F.col("total") * F.col(p) / F.col("upto"))
    keys = [*by, "value_range"]
    inside = Window.partitionBy(*keys).orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    later = group.orderBy(F.desc("value_range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranked.groupBy(*keys).agg(F.min("step").alias("lowest")).select(
        *keys, F.min("lowest").over(later).alias("later")
    )
    adjusted = join_on(ranked.withColumn("inside", F.min("step").over(inside)), ranges, keys)
    adjusted = adjusted.select(*by, p, F.least(F.lit(1.0), F.col("inside"), F.col("later")).alias(out))
    return join_on(df, adjusted, [*by, p], "left")


def rejections(df: DataFrame, p: str, by: list[str], alpha: float) -> DataFrame:
    """How many rows per group an adjusted p-value below ``alpha`` would select.

    It is the last rank whose own ``total * p / rank`` lies below ``alpha``; no reverse scan is needed.
    """
    ranked = ordered_counts(df, p, by)
    hit = F.col("total") * F.col(p) / F.col("upto") < alpha
    return ranked.groupBy(*by).agg(F.coalesce(F.max(F.when(hit, F.col("upto"))), F.lit(0)).alias("rejections"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Interpolated quantiles per group as ``by + (level, quantile)``, one row per probability in order.

    Only the one or two distinct values around each wanted position take part in the last aggregate.
    """
    by = by or []
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    ranked = ordered_counts(df, value, by, rows_per_range)
    places = F.transform(
        wanted, lambda p, i: F.struct(i.cast("int").alias("level"), (p * (F.col("total") - 1)).alias("place"))
    )
    # Zero-based positions upto - n .. upto - 1 hold this value.
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1

    def covers(place: Column) -> Column:
        return (F.floor(place) <= last) & (F.ceil(place) >= first)

    near = ranked.withColumn("value", F.col(value).cast("double")).select(
        *by, "value", first.alias("first"), last.alias("last"), F.inline(F.filter(places, lambda s: covers(s["place"])))
    )
    low = F.max(F.when(F.floor("place").between(F.col("first"), F.col("last")), F.col("value")))
    high = F.max(F.when(F.ceil("place").between(F.col("first"), F.col("last")), F.col("value")))
    weight = F.max(F.col("place") - F.floor("place"))
    return near.groupBy(*by, "level").agg((low + (high - low) * weight).alias("quantile"))


def global_positions(df: DataFrame, order: list[str], out: str = "position") -> DataFrame:
    """The rows with their place, from 1, in the total order of the given columns; no task sees more than its range.

    Rows are dealt to ranges, sorted there and written with range and row number; a range's offset is the sum of the
    counts before it, from a table with one row a range. That table also proves the order: a range that begins before
    its predecessor's end fails the job. Rows equal in all columns of the order have neighbouring places in any order.
    """
    key = F.struct(*order)
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    taken = {c.lower() for c in df.columns}
    part, row = (next(n for n in (f"{base}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken) for base in ("part", "row"))
    cut = cut.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    cut = Workspace(df.sparkSession, "positions").save(cut, "ranges")
    ends = cut.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
    ranges = Window.partitionBy(F.lit(0)).orderBy(part)
    ends = ends.select(part, F.sum("rows").over(ranges.rowsBetween(Window.unboundedPreceding, -1)).alias("offset"), "first", F.lag("last").over(ranges).alias("ended"))
    wrong = F.col("ended").isNotNull() & (F.col("ended") > F.col("first"))
    offset = F.when(wrong, F.raise_error(F.lit("ranges overlap")).cast("long")).otherwise(F.coalesce("offset", F.lit(0)))
    placed = cut.join(ends.select(part, offset.alias("offset")), part)
    return placed.select(*df.columns, (F.col("offset") + F.col(row) + 1).alias(out))


def top_per_group(df: DataFrame, k: int, order: list[Column], by: list[str] | None = None) -> DataFrame:
    """The first ``k`` rows in the given order, with their 1-based ``rank``.

    Without groups this is one distributed top-k. With groups, Spark's group-limit keeps only ``k`` rows
    per group and input task before the shuffle, so a hot group never gathers whole.
    """
    if not by:
        first = df.orderBy(*order).limit(k)
        return first.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
        F.col("rank") <= k
    )
