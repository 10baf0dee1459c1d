"""Structured Streaming forms of the scorer and the drift check.

Each request row is complete, so scoring a micro-batch needs no state across
batches: ``foreachBatch`` runs the batch scorer on every micro-batch and
writes the batch's own folder of a Parquet sink.  The caller names the checkpoint: a query started
again with it goes on where it stopped, and a batch that is played again replaces its folder, so nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.config import DRIFT_MIN_READINGS
from cyclewise.operators import features as fe
from cyclewise.operators import scoring as sc
from cyclewise.operators.baseline import build, ks_table, tall
from cyclewise.session import cut_lineage, scratch_path


def _run(stream: DataFrame, handler, name: str, spark: SparkSession, checkpoint: str | None) -> None:
    q = (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_score(spark: SparkSession, source_dir: str, schema, state: fe.FeatureState, model, sink: str,
                 max_files_per_trigger: int = 16, checkpoint: str | None = None) -> DataFrame:
    """Request rows arriving as Parquet files -> scored requests in ``sink``, one folder per batch.

    Every request sits in one file, so any grouping of files into
    micro-batches holds whole requests; several files per trigger keep the
    per-batch job overhead low.  Returns the sink read back.
    """
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        sc.score_requests(batch, state, model).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    _run(src, handle, "stream-score", spark, checkpoint)
    return spark.read.parquet(sink)


def stream_drift(spark: SparkSession, source_dir: str, schema, baseline: DataFrame, state: fe.FeatureState,
                 sink: str, split: str = "split", max_files_per_trigger: int = 1, checkpoint: str | None = None,
                 cfg: dict | None = None) -> DataFrame:
    """Readings arriving as files, checked per ``split`` against the stored baseline; each batch gives its own rows.

    The state is the value counts per ``(split, feature)`` of all readings so far, one folder per batch: a batch adds its
    counts to the state of the batch before and tests the splits that it brought readings of, if they have
    enough by then.  A batch that is played again starts from the same state and replaces its folders.
    The baseline is indexed once and looked up by the readings.  Output ``(batch_id, split, feature, stattest,
    drift_score, threshold, drifted)``.
    """
    cols = sc.shared_columns(spark.createDataFrame([], schema), baseline, state.feature_columns)
    scaler = {c: state.scaler[c] for c in cols if c in state.scaler}
    index = build(baseline, cols)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = cut_lineage(fe.minmax_transform(batch.select(split, *cols), scaler), "stream-batch")
        new = tall(rows, [split], cols).groupBy(split, "feature", "value").agg(F.count(F.lit(1)).alias("c"))
        sizes = rows.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
        if batch_id > 0:
            new = new.unionByName(spark.read.parquet(f"{sink}/state/{batch_id - 1}/counts"))
            sizes = sizes.unionByName(spark.read.parquet(f"{sink}/state/{batch_id - 1}/sizes"))
        own = f"{sink}/state/{batch_id}"
        new.groupBy(split, "feature", "value").agg(F.sum("c").alias("c")).write.mode("overwrite").parquet(f"{own}/counts")
        sizes.groupBy(split).agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{own}/sizes")
        ready = spark.read.parquet(f"{own}/sizes").filter(F.col("n") >= DRIFT_MIN_READINGS).join(rows.select(split).distinct(), split, "left_semi")
        counts = spark.read.parquet(f"{own}/counts").join(ready, split, "left_semi")
        ks_table(counts, index, [split], cfg).write.mode("overwrite").parquet(f"{sink}/rows/batch_id={batch_id}")

    _run(src, handle, "stream-drift", spark, checkpoint)
    return spark.read.parquet(f"{sink}/rows")
