"""Bulk scoring of reading requests and the batch drift check against a
training baseline.  Each request plays the part of an engine
(``unit := request_id``), so every window and the lag fallback mean stay
inside one request: one caller's readings never leak into another's features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.config import (
    CYCLE,
    DRIFT_MIN_READINGS,
    DRIFT_MIN_SHARED_COLUMNS,
    MONITORING_DEFAULTS,
    PREDICT_MIN_READINGS,
    SHORT_REQUEST_WARN,
)
from cyclewise.operators import drift as dr
from cyclewise.operators import features as fe
from cyclewise.operators import model as md
from cyclewise.operators.baseline import BaselineIndex, build, ks_table, tall
from cyclewise.operators.validate import inference_violations

REQ = "request_id"

# Warning texts of the scorer.
VALIDATION_WARNING = (
    "Input validation warnings: %d issues detected. Predictions may be unreliable for out-of-distribution inputs."
)
SHORT_WARNING = (
    "Fewer than 5 cycles provided. Rolling window features may be unreliable. "
    "Provide at least 20 cycles for best accuracy."
)


def request_checks(rows: DataFrame, req: str = REQ, pos: str = "pos", cycle: str = CYCLE,
                   segment_rows: int = 1 << 16) -> DataFrame:
    """Per request: reading count, arrival order check, and which calls accept it.

    Scoring needs readings in ascending order, equal cycles allowed; the drift check only enough of them.
    ``pos`` is the 1-based arrival position.  Order is checked inside
    ``(request, position segment)`` windows and across segment boundaries on
    a per-segment summary (first / last cycle), so one huge request is many
    tasks.
    """
    seg = F.floor((F.col(pos) - F.lit(1)) / F.lit(segment_rows)).alias("_seg")
    x = rows.select(req, pos, cycle, seg)
    w = Window.partitionBy(req, "_seg").orderBy(pos)
    flagged = x.select(req, "_seg", pos, cycle, (F.lag(cycle).over(w) > F.col(cycle)).alias("_back"))
    per_seg = flagged.groupBy(req, "_seg").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.coalesce(F.col("_back").cast("int"), F.lit(0))).alias("_bad"),
        F.min_by(cycle, pos).alias("_first"),
        F.max_by(cycle, pos).alias("_last"),
    )
    ws = Window.partitionBy(req).orderBy("_seg")
    edges = per_seg.select(
        req, "_n", "_bad", F.coalesce((F.lag("_last").over(ws) > F.col("_first")).cast("int"), F.lit(0)).alias("_edge")
    )
    per = edges.groupBy(req).agg(
        F.sum("_n").alias("n_readings"), F.max(F.greatest("_bad", "_edge")).alias("_bad")
    )
    ordered = F.col("_bad") == 0
    return per.select(
        req,
        F.col("n_readings").cast("long").alias("n_readings"),
        ordered.alias("ordered"),
        (ordered & (F.col("n_readings") >= PREDICT_MIN_READINGS)).alias("accept_predict"),
        (F.col("n_readings") >= DRIFT_MIN_READINGS).alias("accept_drift"),
        (F.col("n_readings") < SHORT_REQUEST_WARN).alias("warn_short"),
    )


def score_requests(rows: DataFrame, state: fe.FeatureState, model, req: str = REQ) -> DataFrame:
    """Accepted requests -> soft gate -> features per request -> last reading -> prediction.

    Output ``(request_id, rul_prediction, input_cycles, warnings)``; the
    prediction is floored at 0 and rounded to 2 decimals.
    """
    checks = request_checks(rows, req)
    ok = checks.filter("accept_predict").select(req, "n_readings", "warn_short")
    good = rows.join(ok.select(req), req, "left_semi")
    issues = inference_violations(good.withColumnRenamed(req, "unit_number")).groupBy(
        F.col("unit_number").alias(req)
    ).agg(F.count(F.lit(1)).alias("n_issues"))
    last = fe.last_row_features(good, state, unit=req, pos="pos", counted=rows)
    scored = md.predict(model, fe.align_features(last, state.feature_columns, [req]), state.feature_columns, "_p")
    # floored at 0, so half-up on the binary value (x*100 + 0.5); identical in any IEEE engine
    pred = F.floor(F.greatest(F.col("_p"), F.lit(0.0)) * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)
    warns = F.filter(
        F.array(
            F.when(F.coalesce(F.col("n_issues"), F.lit(0)) > 0, F.format_string(VALIDATION_WARNING, F.col("n_issues"))),
            F.when(F.col("warn_short"), F.lit(SHORT_WARNING)),
        ),
        lambda x: x.isNotNull(),
    )
    return (
        scored.select(req, pred.alias("rul_prediction"))
        .join(ok, req)
        .join(issues, req, "left")
        .select(req, "rul_prediction", F.col("n_readings").alias("input_cycles"), warns.alias("warnings"))
    )


def shared_columns(batch: DataFrame, baseline: DataFrame, feature_columns: list[str]) -> list[str]:
    """Columns in the batch, the baseline and the feature list; fewer than 5 is an error."""
    shared = [c for c in feature_columns if c in set(batch.columns) and c in set(baseline.columns)]
    if len(shared) < DRIFT_MIN_SHARED_COLUMNS:
        raise ValueError(f"only {len(shared)} shared columns; at least {DRIFT_MIN_SHARED_COLUMNS} needed")
    return shared


def drift_check(rows: DataFrame, baseline: DataFrame | BaselineIndex, state: fe.FeatureState, req: str = REQ,
                columns: list[str] | None = None, cfg: dict | None = None) -> DataFrame:
    """Per request and shared column: KS test of its readings, scaled with the frozen scaler, against the training baseline.

    Requests of fewer than ``DRIFT_MIN_READINGS`` readings are left out.  ``baseline`` is the scaled training table or
    its index (then with ``columns``, the shared ones).  Output ``(request_id, feature, stattest, drift_score,
    threshold, drifted)``.
    """
    if isinstance(baseline, DataFrame):
        columns = shared_columns(rows, baseline, state.feature_columns)
        baseline = build(baseline, columns)
    enough = rows.groupBy(req).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= DRIFT_MIN_READINGS).select(req)
    good = rows.select(req, *columns).join(enough, req, "left_semi")
    scaled = fe.minmax_transform(good, {c: state.scaler[c] for c in columns if c in state.scaler})
    counts = tall(scaled, [req], columns).groupBy(req, "feature", "value").agg(F.count(F.lit(1)).alias("c"))
    return ks_table(counts, baseline, [req], cfg)


def drift_verdicts(rows: DataFrame, baseline: DataFrame | BaselineIndex, state: fe.FeatureState, req: str = REQ,
                   columns: list[str] | None = None, cfg: dict | None = None) -> DataFrame:
    """The drift endpoint's answer per request: ``(request_id, n_features, n_drifted, share_drifted, dataset_drift)``."""
    share = {**MONITORING_DEFAULTS, **(cfg or {})}["dataset_drift_share"]
    return dr.dataset_drift(drift_check(rows, baseline, state, req, columns, cfg), share, [req])
