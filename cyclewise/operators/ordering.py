"""Order-dependent building blocks that stay skew-safe.

Spark has no row position, and an un-partitioned (or one-key) window puts a
whole group into one task.  The helpers here split an ordered group into
range buckets, do the cheap per-bucket totals on a small table, and add the
bucket offsets back, so the per-row work is always partitioned by
``(key, bucket)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def dense_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    out: str = "pos",
    total: str | None = None,
    coarse: Column | None = None,
) -> DataFrame:
    """1-based position of each row within ``keys`` by ``order``; with ``total``, also the rows of the key.

    ``coarse``, monotone in ``bucket``, groups the buckets: their running sums then go by group, and one more over
    the groups, so that no task holds a row per bucket.

    Rows with a NULL key are one group, rows with a NULL bucket come first in theirs; none is lost.

    ``bucket`` must be monotone in ``order`` (e.g. a coarse date or
    ``floor(t / S)``).  Counts per ``(keys, bucket)`` form a small table whose
    running sum gives each bucket's offset; rows are numbered inside their
    bucket only.  With ``keys=[]`` this is a global position without a
    single-partition window over the data.  Buckets of many rows keep that table small.
    """
    keys = list(keys)
    b = df.withColumn("_pb", bucket)
    level = (coarse if coarse is not None else F.lit(0)).alias("_pc")
    counts = b.groupBy(*keys, level, "_pb").agg(F.count(F.lit(1)).alias("_pn"))
    upto = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = [F.col(k).alias(f"_pk{i}") for i, k in enumerate(keys)]
    offsets = counts.select(
        *own, "_pc", F.col("_pb").alias("_pb2"), F.coalesce(F.sum("_pn").over(upto([*keys, "_pc"], "_pb")), F.lit(0)).alias("_poff"),
        *([F.sum("_pn").over(Window.partitionBy(*keys, "_pc")).alias(total)] if total else []),
    )
    if coarse is not None:
        groups = counts.groupBy(*keys, "_pc").agg(F.sum("_pn").alias("_gn"))
        by = keys or [F.lit(0)]
        groups = groups.select(
            *[F.col(k).alias(f"_gk{i}") for i, k in enumerate(keys)], F.col("_pc").alias("_gc"),
            F.coalesce(F.sum("_gn").over(upto(by, "_pc")), F.lit(0)).alias("_goff"), F.sum("_gn").over(Window.partitionBy(*by)).alias("_gt"),
        )
        on = F.col("_pc").eqNullSafe(F.col("_gc"))
        for i in range(len(keys)):
            on = on & F.col(f"_pk{i}").eqNullSafe(F.col(f"_gk{i}"))
        offsets = offsets.join(groups, on).withColumn("_poff", F.col("_poff") + F.col("_goff"))
        if total:
            offsets = offsets.withColumn(total, F.col("_gt"))
        offsets = offsets.drop("_gc", "_goff", "_gt", *[f"_gk{i}" for i in range(len(keys))])
    # a bucket's offset travels as a row ahead of the bucket's own: the rows are shuffled once and joined with nothing
    marks = offsets.select(
        *[F.col(f"_pk{i}").alias(k) for i, k in enumerate(keys)], F.col("_pb2").alias("_pb"), "_poff", *([total] if total else []), F.lit(True).alias("_pm"))
    rows = b.withColumn("_pm", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_pb").orderBy(F.col("_pm").desc(), *order)
    ahead = w.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select(
        *df.columns, "_pm", (F.row_number().over(w) - 1 + F.first("_poff").over(ahead)).cast("long").alias(out),
        *([F.first(total).over(ahead).alias(total)] if total else []))
    return placed.filter(~F.col("_pm")).drop("_pm")


def running_totals(
    df: DataFrame,
    part: str,
    order: str,
    cols: Sequence[str],
    buckets: int = 64,
    with_next: bool = False,
    accuracy: int = 10_000,
    few_parts: bool = False,
) -> DataFrame:
    """Cumulative sums of ``cols`` within ``part`` ordered by ``order``.

    ``order`` must be unique within ``part`` (pre-aggregate by value first).
    Adds ``cum_<c>`` for each column and, with ``with_next``, ``next_<order>``
    (the following value in the same part, NULL for the last one).

    Buckets are equal-count ranges from ``percentile_approx``; one value never
    straddles two buckets, so the result is exact whatever the approximation.
    With ``few_parts`` (a part is a feature) the ranges are sent to the rows, which
    a join by ``part`` would deal to as many tasks as there are parts.
    """
    small = F.broadcast if few_parts else lambda x: x
    probs = [i / buckets for i in range(1, buckets)]
    bounds = df.groupBy(part).agg(F.percentile_approx(order, probs, accuracy).alias("_bounds"))
    x = with_count_upto(df.join(small(bounds), part), "_rb", "_bounds", order, buckets).drop("_bounds")

    aggs = [F.sum(c).alias(f"_t_{c}") for c in cols]
    if with_next:
        aggs.append(F.min(order).alias("_bmin"))
    tot = x.groupBy(part, "_rb").agg(*aggs)
    wb = Window.partitionBy(part).orderBy("_rb")
    off_cols = [
        F.coalesce(F.sum(f"_t_{c}").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_o_{c}")
        for c in cols
    ]
    if with_next:
        off_cols.append(F.min("_bmin").over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("_nb"))
    off = tot.select(part, "_rb", *off_cols)
    x = x.join(small(off), [part, "_rb"])

    w = Window.partitionBy(part, "_rb").orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    outs = [(F.sum(c).over(run) + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in cols]
    if with_next:
        outs.append(F.coalesce(F.lead(order).over(w), F.col("_nb")).alias(f"next_{order}"))
    keep = [c for c in x.columns if not c.startswith("_")]
    return x.select(*keep, *outs)


def key_segment_bucket(unit: str, cycle: str, segment_rows: int = 1 << 16) -> Column:
    """Bucket for ``dense_positions`` over ``(unit, cycle)`` order: engine plus a cycle segment,
    so one very long engine is numbered by many tasks."""
    return F.struct(F.col(unit), F.floor(F.col(cycle) / F.lit(segment_rows)).alias("_cseg"))


def key_group(unit: str, units: int = 1024) -> Column:
    """Coarse bucket over :func:`key_segment_bucket`: so many consecutive engine ids."""
    return F.floor(F.col(unit) / F.lit(units))


def position_segments(pos: Column, segment_rows: int) -> Column:
    """0-based segment number of a 1-based dense position."""
    return F.floor((pos - F.lit(1)) / F.lit(segment_rows)).cast("long")


def with_count_upto(df: DataFrame, out: str, bounds: str, value: str, most: int) -> DataFrame:
    """Adds how many elements of the ascending array ``bounds``, of at most ``most`` elements, are <= ``value``.

    A binary search with a column per step: each is compiled, which a higher-order function is not.
    """
    x = df.withColumn(out, F.lit(0))
    for k in range(max(int(most), 1).bit_length() - 1, -1, -1):
        # beyond the end the element is null and the step is not taken
        step = F.lit(1 << k)
        x = x.withColumn(out, F.col(out) + F.when(F.get(F.col(bounds), F.col(out) + step - 1) <= F.col(value), step).otherwise(0))
    return x


def count_upto(bounds: Column, value: Column, most: int) -> Column:
    """:func:`with_count_upto` as one column, for few rows: a higher-order function."""
    steps = F.array(*[F.lit(1 << k) for k in range(max(int(most), 1).bit_length() - 1, -1, -1)])

    def forward(at: Column, step: Column) -> Column:
        # beyond the end the element is null and the step is not taken
        return F.when(F.get(bounds, at + step - 1) <= value, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), forward)
