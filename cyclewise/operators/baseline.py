"""Baseline CDF index: the distribution of a training table, written once by value range, looked up by readings.

For every feature the distinct values with their cumulative counts stand in ranges of about equal counts.  A sample is
compared with the baseline at the sample's own values: between two of them the sample's CDF is constant and the
baseline's only rises, so the largest distance is at a value or just before one.  A lookup reads the ranges
that hold sample values; the baseline is never counted again or copied per sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclewise.config import MONITORING_DEFAULTS
from cyclewise.operators import drift as dr
from cyclewise.operators.ordering import running_totals, with_count_upto
from cyclewise.session import cut_lineage, scratch_path

#: Value ranges per feature.
RANGES = 256
#: A sample of at most so many distinct values of a feature is ordered in one task.
WHOLE_VALUES = 1 << 16


def tall(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """``keys, feature, value`` for every finite value."""
    items = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value")) for f in features])
    return df.select(*keys, F.explode(items).alias("_x")).select(*keys, "_x.feature", "_x.value").filter(dr.finite(F.col("value")))


@dataclass
class BaselineIndex:
    """Reads an index written by :func:`build`."""

    spark: SparkSession
    path: str

    @property
    def ranges(self) -> DataFrame:
        """(feature, n_ref, bounds): the first value of each range but the open one below, one row per feature."""
        return self.spark.read.parquet(f"{self.path}/ranges")

    @property
    def values(self) -> DataFrame:
        """(feature, range, value, upto, before): baseline rows up to and below each distinct value."""
        return self.spark.read.parquet(f"{self.path}/values")

    def lookup(self, points: DataFrame) -> DataFrame:
        """``points`` (feature, value, ...) with ``n_ref`` and the baseline's ``upto`` (<= value) and ``before`` (< value).

        Points of a feature that the index does not know are dropped.
        """
        at = with_count_upto(points.join(F.broadcast(self.ranges), "feature"), "range", "bounds", "value", RANGES + 1).drop("bounds")
        touched = at.select("feature", "range").distinct()
        base = self.values.join(touched, ["feature", "range"], "left_semi").select(
            "feature", "range", "value", F.struct(F.col("value").alias("v"), "upto", "before").alias("_b"), F.lit(0).alias("_side"))
        asked = at.select("feature", "range", "value").distinct().withColumn("_b", F.lit(None).cast(base.schema["_b"].dataType)).withColumn("_side", F.lit(1))
        order = Window.partitionBy("feature", "range").orderBy("value", "_side").rowsBetween(Window.unboundedPreceding, 0)
        # a range starts at a baseline value, so the value before a point is in its range; below all values there is none
        found = base.unionByName(asked).withColumn("_b", F.last("_b", ignorenulls=True).over(order)).filter("_side = 1")
        found = found.select(
            F.col("feature").alias("_f"), F.col("value").alias("_v"), F.coalesce("_b.upto", F.lit(0)).alias("upto"),
            F.coalesce(F.when(F.col("_b.v") == F.col("value"), F.col("_b.before")).otherwise(F.col("_b.upto")), F.lit(0)).alias("before"))
        return at.drop("range").join(found, (F.col("feature") == F.col("_f")) & (F.col("value") == F.col("_v"))).drop("_f", "_v")


def build(baseline: DataFrame, features: list[str], path: str | None = None) -> BaselineIndex:
    """Counts the baseline once and writes its index under ``path`` (a folder of the shared scratch without one)."""
    spark = baseline.sparkSession
    path = path or scratch_path(spark, "baseline-index")
    counts = tall(baseline, [], features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("r"))
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    probs = [i / RANGES for i in range(RANGES)]
    bounds = counts.groupBy("feature").agg(
        F.sum("r").alias("n_ref"), F.array_sort(F.array_distinct(F.concat(F.array(F.min("value")), F.percentile_approx("value", probs)))).alias("bounds"))
    bounds.write.mode("overwrite").parquet(f"{path}/ranges")
    run = running_totals(counts, "feature", "value", ["r"], few_parts=True).select("feature", "value", F.col("cum_r").alias("upto"), (F.col("cum_r") - F.col("r")).alias("before"))
    index = BaselineIndex(spark, path)
    run = with_count_upto(run.join(F.broadcast(index.ranges.select("feature", "bounds")), "feature"), "range", "bounds", "value", RANGES + 1).drop("bounds")
    # a range's rows together and ranges in order, so that a lookup skips row groups
    run.repartition("feature", "range").sortWithinPartitions("feature", "range", "value").write.mode("overwrite").parquet(f"{path}/values")
    return index


def sample_ks(counts: DataFrame, index: BaselineIndex, keys: list[str]) -> DataFrame:
    """KS distance and p of each sample against the baseline.

    ``counts``: (keys, feature, value, c).  Output ``keys, feature, n_ref, n_cur, ks_d, ks_p``.  The baseline is looked
    up once per distinct value.  A sample's running counts are one window over its values; of a sample of more than
    ``WHOLE_VALUES`` values they go by value ranges, so a sample that holds most readings is many tasks.
    """
    whole = [*keys, "feature"]
    counts = cut_lineage(counts, "sample-counts")
    points = counts.select("feature", "value").distinct()
    met = counts.join(index.lookup(points), ["feature", "value"])
    # never more rows than values / WHOLE_VALUES
    large = counts.groupBy(*whole).agg(F.count(F.lit(1)).alias("_v"), F.sum("c").alias("n_cur")).filter(F.col("_v") > F.lit(WHOLE_VALUES))
    large = F.broadcast(cut_lineage(large.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(whole)], "n_cur"), "large-samples"))
    same = F.lit(True)
    for i, k in enumerate(whole):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    n, m = F.col("n_ref"), F.col("n_cur")
    here = F.abs(F.col("upto") / n - F.col("cum_c") / m)
    below = F.abs(F.col("before") / n - (F.col("cum_c") - F.col("c")) / m)

    def distances(run: DataFrame) -> DataFrame:
        return run.groupBy(*whole).agg(F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.max(F.greatest(here, below)).alias("ks_d"))

    own = Window.partitionBy(*whole)
    run = met.join(large, same, "left_anti")
    run = run.withColumn("n_cur", F.sum("c").over(own)).withColumn("cum_c", F.sum("c").over(own.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    split = met.join(large, same).drop(*[f"_k{i}" for i in range(len(whole))]).withColumn("pkey", F.to_json(F.struct(*whole)))
    per = distances(run).unionByName(distances(running_totals(split, "pkey", "value", ["c"])))
    p = dr.ks_pvalue(F.col("ks_d"), n.cast("double"), m.cast("double"))
    return per.select(*whole, n.cast("long").alias("n_ref"), m.cast("long").alias("n_cur"), "ks_d", p.alias("ks_p"))


def ks_table(counts: DataFrame, index: BaselineIndex, keys: list[str], cfg: dict | None = None) -> DataFrame:
    """``keys, feature, stattest, drift_score, threshold, drifted`` by the KS test."""
    limit = {**MONITORING_DEFAULTS, **(cfg or {})}["ks_p_threshold"]
    drifted: Column = F.col("ks_p") <= F.lit(limit)
    return sample_ks(counts, index, keys).select(
        *keys, "feature", F.lit("ks").alias("stattest"), F.col("ks_p").alias("drift_score"), F.lit(limit).alias("threshold"), drifted.alias("drifted"))
