"""Helpers shared by the text operators: normalisation, row keys, scratch tables, batch walking."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.session import cut_lineage, scratch_path  # noqa: F401  (re-exported)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Longest run of texts handed to one numpy pass, in characters.  A longer single text is one pass of its own.
PASS_CHARS = 400_000


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else.

    Texts without any multi-byte character take the plain ``lower``; ``translate`` does the others.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_of(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def range_ranked(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> tuple[DataFrame, list]:
    """Writes ``df`` range-partitioned by ``order`` with the partition number as ``_part``.

    Returns the table and one row (part, rows) per part, so that a global position is a local one plus
    the offset of its part.  The list is as long as the partition count, whatever the data.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = cut_lineage(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), name)
    counts = out.groupBy("_part").count().orderBy("_part").collect()
    return out, [(r["_part"], r["count"]) for r in counts]


def passes(batches: Iterator[pd.DataFrame], text: str, limit: int = PASS_CHARS) -> Iterator[pd.DataFrame]:
    """Cuts Arrow batches into runs of at most ``limit`` characters, one whole text at least."""
    for pdf in batches:
        if not len(pdf):
            continue
        size = pdf[text].str.len().fillna(0).to_numpy()
        start, held = 0, 0
        for i, s in enumerate(size):
            if held and held + s > limit:
                yield pdf.iloc[start:i].reset_index(drop=True)
                start, held = i, 0
            held += s
        yield pdf.iloc[start:].reset_index(drop=True)


def bound_batches(spark, rows: int = 500) -> None:
    """Lowers the session's rows per Arrow batch, so that a batch of very long texts fits in a Python worker.

    Operators on whole texts call this; a smaller setting stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
