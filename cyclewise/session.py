"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "cyclewise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    return conf or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder; set a private one only in local mode (tests).

    On a cluster a folder of the driver's machine would be lost on the others, so an unset one is an error.
    """
    root = checkpoint_root(spark)
    if root is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set for {master}: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cyclewise-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = checkpoint_root(spark) or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/cyclewise/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Writes ``df`` as Parquet under the shared checkpoint folder and reads it back.

    Survives executor loss (the copy is on shared storage, not in executor
    memory), and later readers get columnar scans with column pruning, which
    matters for wide feature tables.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
