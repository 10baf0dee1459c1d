"""Imports every query module so the registry is complete; flagship job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclewise.plans import (  # noqa: F401  (register queries)
    q_drift,
    q_features,
    q_lineage,
    q_metrics,
    q_pipeline,
    q_scoring,
    q_sources,
    q_validate,
)
from cyclewise.plans.registry import ORACLES, QUERIES


def all_queries():
    return QUERIES


def all_oracles() -> dict[str, str]:
    return {k: fn() for k, fn in ORACLES.items() if k in QUERIES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole train / cross-validate / evaluate job: gate -> features -> feature gate -> fit -> train, fold and
    hold-out metrics (one row)."""
    return QUERIES["pipeline_metrics"](spark, sf_dir)
