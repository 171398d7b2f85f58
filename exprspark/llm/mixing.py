"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its weight's share of all words, never above ``most`` times the words it has; what a
capped source can't use goes to the others by weight. Complete epochs are taken first. The fraction that is
left is a weighted sample without replacement: every document gets the key ``-ln(u) / quality`` with ``u``
from a hash of its id, text size and copy number, and the documents with the smallest keys are taken until
the remaining budget is met.

The sort within a source is spread over key ranges: a range is one of many equal parts of the key's own
scale, its word sum is a partial aggregate, and only sums are windowed per source. Rows are sorted only
inside the one range where a source's budget ends, so a source with a third of all rows is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exprspark.llm.words import free_name, text_of, word_count
from exprspark.session import Workspace

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
DOCS_PER_RANGE = 2_000
SEED = 17


def letter_share(text: Column) -> Column:
    """Default quality weight: 0.1 for a text without basic letters up to 1.0 for nothing but them."""
    letters = F.length(text) - F.length(F.regexp_replace(text, "[A-Za-z]+", ""))
    return F.lit(0.1) + F.lit(0.9) * letters / F.greatest(F.length(text), F.lit(1))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources in code-point order, NULL last, take the weights in turn. One aggregate per round fixes every
    source whose share exceeds its cap; a round fixes at least one weight class, so few rounds are needed.
    """
    spark = sizes.sparkSession
    space = Workspace(spark, "mix")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = space.save(
        totals.withColumn("place", placed).select(
            "source", "source_size", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).alias("weight")
        ),
        "sources",
    )
    cap = F.col("source_size") * float(most)
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        capped = F.col("weight") * level > cap
        rest, weight = table.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if not weight or rest / weight <= level:
            break
        level = rest / weight
    return table.select("source", "source_size", F.least(F.col("weight") * level, cap).alias("target"))


def draws(docs: DataFrame, quality: Column | None, seed: int, *more: str) -> DataFrame:
    """``source, size, draw`` of each row; e^-key lies in (0, 1), so equal parts of it hold comparable numbers of rows."""
    weight = letter_share(text_of()) if quality is None else quality
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11).cast("double") + 0.5) / F.lit(float(2**53))
    return docs.select(*more, "source", word_count(text_of()).alias("size"), F.pow(u, F.lit(1.0) / weight).alias("draw"))


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, quality: Column | None = None,
             seed: int = SEED, docs_per_range: int = DOCS_PER_RANGE) -> tuple[DataFrame, DataFrame, int]:
    """The written draws, the written plan of each source, and the number of key ranges.

    A source's plan is its complete epochs and the draw down to which one more copy is taken: all of the ranges
    before ``end_part``, and in that range the draws from ``cut`` up.
    """
    space = Workspace(docs.sparkSession, "mix")
    rows = space.save(draws(docs, quality, seed, "doc_id"), "rows")
    targets = source_targets(rows, weights, most)
    ranges = max(1, -(-rows.count() // docs_per_range))
    plan = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    plan = plan.select(F.col("source").alias("plan_source"), "source_size", "target", "epochs", "budget")
    # Range 0 holds the largest draws, that is the smallest keys.
    same = F.col("source").eqNullSafe(F.col("plan_source"))
    sums = rows.groupBy("source", part_of(ranges).alias("part")).agg(F.sum("size").alias("in_part"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "part", "in_part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before"))
    ends = (
        sums.join(plan, same)
        .filter((F.col("before") < F.col("budget")) & (F.col("before") + F.col("in_part") >= F.col("budget")))
        .select(F.col("source").alias("end_source"), F.col("part").alias("end_part"), "before", "budget")
    )
    end_rows = rows.withColumn("part", part_of(ranges)).join(
        ends, F.col("source").eqNullSafe(F.col("end_source")) & (F.col("part") == F.col("end_part"))
    )
    order = Window.partitionBy("source", "part").orderBy(F.desc("draw")).rangeBetween(Window.unboundedPreceding, 0)
    after = F.col("before") + F.sum("size").over(order)
    # The document that crosses the budget is taken if that comes nearer to it.
    cuts = (
        end_rows.select("end_source", "end_part", "draw", (after - F.col("size") / 2.0 <= F.col("budget")).alias("fits"))
        .groupBy("end_source", "end_part")
        .agg(F.min(F.when(F.col("fits"), F.col("draw"))).alias("cut"))
    )
    decided = plan.join(cuts, F.col("plan_source").eqNullSafe(F.col("end_source")), "left").select(
        "plan_source", "source_size", "target", "epochs", "end_part", "cut"
    )
    return rows, space.save(decided, "plan"), ranges


def part_of(ranges: int) -> Column:
    return F.floor((F.lit(1.0) - F.col("draw")) * ranges).cast("long")


def with_copies(rows: DataFrame, plan: DataFrame, ranges: int) -> DataFrame:
    """``rows`` (with ``source``, ``size`` and ``draw``) joined to their source's plan, with ``copies``."""
    part = part_of(ranges)
    extra = (part < F.col("end_part")) | ((part == F.col("end_part")) & (F.col("draw") >= F.col("cut")))
    copies = F.col("epochs") + F.coalesce(extra, F.lit(False)).cast("long")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    return joined.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, copies, taken``; options as ``mix_plan``.

    ``copies`` counts how often the mix takes the row, ``taken`` its words. Rows that repeat an id and a text
    draw the same key and share their fate. NULL text has size 0; NULL source is a source of its own; an empty
    table gives an empty result; documents without words are never taken; other columns play no part.
    """
    rows, plan, ranges = mix_plan(docs, **options)
    return with_copies(rows, plan, ranges).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each row repeated as often as the mix takes it; the columns of ``docs``.

    Only the plan, one row per source, is joined: texts are not shuffled while that table is small.
    """
    _, plan, ranges = mix_plan(docs, **options)
    row = free_name(docs, "mix_row")
    rows = draws(docs.withColumn(row, F.struct(*docs.columns)), options.get("quality"), options.get("seed", SEED), row)
    taken = with_copies(rows, plan, ranges).filter(F.col("copies") > 0)
    return taken.select(row, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(f"{row}.*")
