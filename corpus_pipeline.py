"""The training-data pipeline over ``documents``: language ID, exact dedup, near dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet in the shared folder and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm import exact_dedup, langid, mixing, packing, setsketch
from cyclewise.llm.common import cut_lineage, table
from cyclewise.llm.queries import tokenizer_file


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no learned language: without a letter, or with few n-grams that a language has."""
    return langid.drop_unknown(docs, langid.fit(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    kept = setsketch.near_duplicates(docs, width=5, percent=80).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and offset."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mix_sources", mixing_stage),
    ("pack_sequences", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Language models, register sketches and tokens are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None
