"""Exact deduplication with skew-safe combining, in DataFrame functions only.

The texts are deduplicated where they are read (map side of the first aggregate), the survivors merge per
salted digest group, and the winners of the salts combine once more per digest.  Every aggregate has the
whole normalised text among its keys, so equal digests of different texts never merge.  A group of copies
is spread over ``salts`` sub-groups by its ids; after the first aggregate it has at most ``salts`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import ascii_lower, text_of

#: Sub-groups of one digest.
SALTS = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal texts the row with
    the largest id stays.  Rows repeated with id and text each get a row, all of them ``kept`` if their id
    is the group's largest; a null id never wins over another, and a group of null ids only has keep_id null
    and its rows kept.  An empty table gives an empty result; other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(text_of(F.col(text_col))).alias("_t")).select(
        "doc_id",
        F.sha2("_t", 256).alias("text_sha256"),
        F.struct(F.xxhash64("_t").alias("h"), F.octet_length("_t").alias("n")).alias("_v"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("_salt"),
        "_t",
    )
    local = base.groupBy("text_sha256", "_v", "_salt", "_t").agg(F.max("doc_id").alias("_m"), F.count(F.lit(1)).alias("_n"))
    # at most `salts` rows of a text from here on; rows of one digest come together once
    groups = (
        local.repartition("text_sha256")
        .groupBy("text_sha256", "_v", "_t")
        .agg(F.max("_m").alias("keep_id"), F.sum("_n").alias("group_size"), F.collect_list("_salt").alias("_salts"))
        .withColumn("_texts", F.count(F.lit(1)).over(Window.partitionBy("text_sha256", "_v")))
        .select(
            "text_sha256", "_v", "group_size", F.explode("_salts").alias("_salt"),
            # membership goes by digest, second hash and length: two texts that share all three stop the job
            F.when(F.col("_texts") > 1, F.raise_error(F.lit("two different texts share SHA-256, xxhash64 and length")).cast("bigint"))
            .otherwise(F.col("keep_id")).alias("keep_id"),
        )
    )
    member = base.select("doc_id", "text_sha256", "_v", "_salt")
    out = member.join(groups, ["text_sha256", "_v", "_salt"])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: one row of each group of equal texts.

    A row repeated with id and text stays once.
    """
    own = docs.columns
    keep = exact_groups(docs, id_col, text_col, salts).filter("kept").groupBy(
        F.col("doc_id").alias("_kid"), F.col("text_sha256").alias("_ksha")
    ).agg(F.count(F.lit(1)).alias("_kn"))
    rows = docs.withColumn("_rsha", F.sha2(ascii_lower(text_of(F.col(text_col))), 256)).join(
        keep, F.col(id_col).eqNullSafe(F.col("_kid")) & (F.col("_rsha") == F.col("_ksha"))
    )
    # a repeated row has _kn > 1; only those go through a window
    once = rows.filter("_kn = 1").select(*[F.col(f"`{c}`") for c in own])
    w = Window.partitionBy("_kid", "_ksha").orderBy(F.lit(0))
    again = rows.filter("_kn > 1").withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(*[F.col(f"`{c}`") for c in own])
    return once.unionByName(again)
