"""End-to-end jobs: train/evaluate (E1) and monitor/retrain decision (E2).

Each stage is a lazy plan; the feature table is cut once (checkpoint to the
shared folder) because training, cross-validation and the feature gate all
read it, and a lost executor must not recompute the window pass.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.config import CYCLE, MODEL_DEFAULTS, MONITORING_DEFAULTS, TARGET, TRAINING_DEFAULTS, UNIT
from cyclewise.functions import lineage
from cyclewise.functions.rows import combine_rows
from cyclewise.operators import drift as dr
from cyclewise.operators import features as fe
from cyclewise.operators import metrics as mt
from cyclewise.operators import model as md
from cyclewise.operators import retrain as rt
from cyclewise.operators import validate as va
from cyclewise.session import cut_lineage, scratch_path
from cyclewise.sources import files, text


def fit_model(feats: DataFrame, columns: list[str], model_cfg: dict):
    return md.fit_folds(feats, columns, model_cfg)[None]


def train_evaluate(raw_train: DataFrame, raw_test: DataFrame, truth: DataFrame, feature_cfg: dict | None = None,
                   model_cfg: dict | None = None, folds: int | None = None, model_columns: list[str] | None = None,
                   audit_path: str | None = None):
    """Gate -> featurize -> feature gate -> fit -> train / CV / hold-out metrics.

    A table given as ``None`` is a failed dataset and stops the run at the gate.  The final model and the fold models
    are fitted together and score the feature table in one pass.  ``model_columns`` restricts the features that the
    model reads.  With ``audit_path`` the training table's fingerprint and the gate's result are added to the audit log
    there, also when the gate stops the run.

    Returns ``(metrics_row, model, state)``; ``metrics_row`` is one row with the train, CV and test metric sets and
    the feature gate's warnings.
    """
    model_cfg = {**MODEL_DEFAULTS, **(model_cfg or {})}
    folds = folds or TRAINING_DEFAULTS["cv_folds"]
    if raw_train is not None:
        text.require_integrity(text.raw_integrity(raw_train))
    report = cut_lineage(va.validation_report([
        va.gate_report("train", "RawSensorSchema", raw_train),
        va.gate_report("test", "RawSensorSchema", raw_test),
    ]), "gate-report")
    if audit_path and raw_train is not None:
        lineage.append_audit(lineage.audit_row(raw_train, report, "train_raw", with_time=True), audit_path)
    va.require_passed(report)
    feats, state = fe.fit_transform(raw_train, feature_cfg)
    # the gate, the fit and the scores read the features
    feats = cut_lineage(fe.feature_matrix(feats, state), "features")
    bad = va.feature_quality(feats, int(state.config["rul_cap"])).count()
    if bad:
        raise ValueError(f"feature gate failed: {bad} checks")
    cols = model_columns or state.feature_columns
    rows = md.with_folds(feats.select(UNIT, CYCLE, TARGET, *cols), md.group_kfold(feats, folds))
    models = md.fit_folds(rows, cols, model_cfg, TARGET, fold="fold")
    scored = md.predict_folds(models, rows, "predicted", oof="oof", keep=["fold", TARGET])
    scored = cut_lineage(scored, "train-scores")
    train_m = mt.regression_metrics(scored, TARGET, "predicted", "train_").select(
        "train_rmse", "train_mae", "train_r2", "train_asymmetric_score")
    cv = md.cv_rmse(scored, TARGET, "oof").select("cv_rmse_mean", "cv_rmse_std")
    test_m = md.last_cycle_eval(fe.last_row_features(raw_test, state), models[None], cols, truth)
    warn = F.array(*[F.lit(w) for w in va.feature_warnings(feats)]).cast("array<string>")
    return combine_rows(train_m, cv, test_m).withColumn("warnings", warn), models[None], state


def monitor(feats: DataFrame, model, columns: list[str], sensor_cols: list[str], cfg: dict | None = None,
            path: str | None = None) -> DataFrame:
    """Halve the feature table by position -> data drift -> prediction drift -> perturbation impact ->
    drift gate -> JSON summary under ``path`` -> retrain decision read from it (one row).

    The per-feature statistics are computed once and serve both the
    configured test (layer 1) and the automatic one (gate); the perturbed
    copy of each reference row is scored on the same row as the original.
    """
    cfg = cfg or {}
    halves = dr.half_split(feats.select(UNIT, CYCLE, *columns))
    halves = cut_lineage(halves, "monitor-halves")
    ref = halves.filter(F.col("side") == dr.REF)
    cur = halves.filter(F.col("side") == dr.CUR)
    stats = cut_lineage(dr.feature_stats(dr.value_counts(dr.stack_sides(ref, cur, columns))), "monitor-stats")
    test = cfg.get("drift_stattest", MONITORING_DEFAULTS["drift_stattest"])
    # psi bins the values; the other tests are all in the statistics
    table = dr.data_drift(ref, cur, columns, test, cfg) if test == "psi" else dr.drift_table(stats, test, cfg)
    table = cut_lineage(table, "monitor-table")
    pdrift = dr.prediction_drift(md.predict(model, ref, columns, keep=[]), md.predict(model, cur, columns, keep=[]))
    pert = [c for c in sensor_cols if c in columns]
    both = dr.perturb(ref, pert, [UNIT, CYCLE], suffix="__drifted")
    pairs = md.predict(model, md.predict(model, both, columns, "ref_pred"), columns, "drift_pred",
                       source={c: f"{c}__drifted" for c in pert}, keep=["ref_pred"])
    impact = dr.drift_impact(pairs)
    gate = dr.drift_gate(dr.drift_table(stats, "auto", cfg))
    path = path or scratch_path(feats.sparkSession, "drift-summary")
    write_drift_summary(path, dr.dataset_drift(table), table, pdrift, impact, gate)
    return decide_from_summary(feats.sparkSession, path)


SUMMARY_SCHEMA = (
    "data_drift struct<n_features:long,n_drifted:long,share_drifted:double,dataset_drift:boolean,"
    "features:array<struct<feature:string,stattest:string,drift_score:double,drifted:boolean>>>,"
    "prediction_drift struct<drift_detected:boolean,drift_score:double,threshold:double,"
    "reference_mean:double,reference_std:double,current_mean:double,current_std:double>,"
    "impact struct<mean_prediction_change:double,max_prediction_change:double,median_prediction_change:double,"
    "pct_predictions_changed_gt_10:double,reference_pred_mean:double,drifted_pred_mean:double>,"
    "gate struct<n_features:long,n_drifted:long,share_drifted:double,test_suite_passed:boolean>"
)


def write_drift_summary(path: str, data: DataFrame, table: DataFrame, prediction: DataFrame, impact: DataFrame, gate: DataFrame) -> None:
    """The monitor's one-row summary as JSON; its feature list is as long as the feature list."""
    whole = lambda df, name: df.select(F.struct(*df.columns).alias(name))
    features = table.agg(F.collect_list(F.struct("feature", "stattest", F.col("drift_score").cast("double").alias("drift_score"), "drifted")).alias("_f"))
    row = combine_rows(whole(data, "_d"), features, whole(prediction, "prediction_drift"), whole(impact, "impact"), whole(gate, "gate"))
    row = row.select(F.struct("_d.*", F.col("_f").alias("features")).alias("data_drift"), "prediction_drift", "impact", "gate")
    files.write_json(row, path)


def decide_from_summary(spark, path: str, cfg: dict | None = None) -> DataFrame:
    """The retrain decision from a written summary; without one, the answer is no."""
    try:
        row = files.read_json(spark, path, SUMMARY_SCHEMA)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return rt.retrain_decision(None, None, None, None, None, cfg)
    part = lambda name: row.filter(F.col(name).isNotNull()).select(f"{name}.*")
    top = row.select(F.explode("data_drift.features").alias("f")).select("f.*")
    return rt.retrain_decision(part("data_drift").drop("features"), top, part("prediction_drift"), part("impact"), part("gate"), cfg)
