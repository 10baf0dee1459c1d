"""Queries for metrics, evaluation protocols, histograms and models.

The metric queries score with a fixed linear model on two scaled sensors
(``60 - 40·s_3 + 10·s_2``), so every metric has an SQL oracle; the same
operators take a ridge or boosted-tree model in the pipelines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.config import CYCLE, ERROR_HIST_BINS, RUL_HIST_BINS, TARGET, UNIT
from cyclewise.operators import boosting
from cyclewise.operators import features as fe
from cyclewise.operators import metrics as mt
from cyclewise.operators import model as md
from cyclewise.plans.q_features import LI_SENSORS, fitted, sql_fitted_features, sql_scaled, sql_window_features
from cyclewise.plans.registry import oracle, query, rnd, sql_round
from cyclewise.session import cut_lineage
from cyclewise.sources.views import fleet_lineitem, holdout_split, train_split, with_views

SCORER = md.LinearModel(["s_3", "s_2"], [-40.0, 10.0], 60.0)
SQL_PRED = "((60.0 + -40.0 * s_3) + 10.0 * s_2)"
# reads rolling, lag and difference features, so that its queries run the windows
WINDOW_SCORER = md.LinearModel(["s_3", "s_2", "s_2_roll_mean_10", "s_3_roll_max_5", "s_2_lag_3", "s_3_diff"],
                               [-40.0, 10.0, 6.0, -3.0, 4.0, 2.0], 60.0)
SQL_WINDOW_PRED = ("((((((60.0 + -40.0 * s_3) + 10.0 * s_2) + 6.0 * s_2_roll_mean_10) + -3.0 * s_3_roll_max_5)"
                   " + 4.0 * s_2_lag_3) + 2.0 * s_3_diff)")
FOLDS = 5
METRIC_NAMES = ["rmse", "mae", "r2", "asymmetric_score", "samples", "pred_mean", "pred_std", "actual_mean", "actual_std"]


def train_scored(spark, sf):
    """Training engines: RUL label, frozen scaler, linear score."""
    train = train_split(fleet_lineitem(spark, sf))
    state = fe.fit_state(train)
    x = fe.minmax_transform(fe.rul_label(train, state.config["rul_cap"]), {s: state.scaler[s] for s in state.sensor_cols})
    return SCORER.transform(x), state


def holdout_features(spark, sf, last_only: bool = False):
    state = fe.fit_state(train_split(fleet_lineitem(spark, sf)))
    hold, truth = holdout_split(fleet_lineitem(spark, sf, ends=True))
    return (fe.last_row_features if last_only else fe.transform)(hold, state), truth


SQL_TRAIN_PAIRS = f"""
SELECT unit_number, time_cycles, CAST(rul AS DOUBLE) AS actual, {SQL_PRED} AS predicted FROM (
  SELECT s.*, CAST(least(max(time_cycles) OVER (PARTITION BY unit_number) - time_cycles, 125) AS INTEGER) AS rul
  FROM ({sql_scaled('li_train', 'li_train', LI_SENSORS)}) s)"""
_HOLD_FEATURES = sql_window_features(f"({sql_scaled('li_hold', 'li_train', LI_SENSORS)})", ["s_2", "s_3"], [5, 10], [3],
                                     ["unit_number", "time_cycles", "s_2 AS x2", "s_3 AS x3"])[0]
SQL_HOLD_PRED = f"SELECT unit_number, time_cycles, {SQL_WINDOW_PRED} AS predicted FROM ({_HOLD_FEATURES})"


def sql_metrics(src: str, prefix: str) -> str:
    e = "(predicted - actual)"
    phm = f"CASE WHEN {e} < 0 THEN exp(-{e} / 13.0) - 1 ELSE exp({e} / 10.0) - 1 END"
    return f"""
SELECT sqrt(avg({e} * {e})) AS {prefix}rmse, avg(abs({e})) AS {prefix}mae,
       1.0 - sum({e} * {e}) / (var_pop(actual) * count(*)) AS {prefix}r2,
       sum({phm}) AS {prefix}asymmetric_score, count(*) AS {prefix}samples,
       avg(predicted) AS pred_mean, stddev_pop(predicted) AS pred_std,
       avg(actual) AS actual_mean, stddev_pop(actual) AS actual_std
FROM ({src})"""


def _metric_cols(prefix):
    return [f"{prefix}{m}" if m in ("rmse", "mae", "r2", "asymmetric_score") else m for m in METRIC_NAMES if m != "samples"]


# ---------------------------------------------------------------- A4 / A5 / A6
@query("regression_metrics")
def q_regression_metrics(spark, sf):
    scored, _ = train_scored(spark, sf)
    return rnd(mt.regression_metrics(scored, TARGET, "predicted", "train_"), 4)


@oracle("regression_metrics")
def o_regression_metrics():
    return with_views(["li_train"], sql_round(sql_metrics(SQL_TRAIN_PAIRS, "train_"), _metric_cols("train_"), 4))


@query("phm_score")
def q_phm(spark, sf):
    scored, _ = train_scored(spark, sf)
    return rnd(mt.phm_score(scored, TARGET, "predicted"), 4)


@oracle("phm_score")
def o_phm():
    e = "(predicted - actual)"
    return with_views(["li_train"], sql_round(f"""
SELECT sum(CASE WHEN {e} < 0 THEN exp(-{e} / 13.0) - 1 ELSE exp({e} / 10.0) - 1 END) AS asymmetric_score,
       count(*) AS samples FROM ({SQL_TRAIN_PAIRS})""", ["asymmetric_score"], 4))


# ---------------------------------------------------------------- L8 / W6 / J1
@query("last_cycle_eval")
def q_last_cycle(spark, sf):
    feats, truth = holdout_features(spark, sf, last_only=True)
    return rnd(md.last_cycle_eval(feats, WINDOW_SCORER, WINDOW_SCORER.features, truth), 4)


@oracle("last_cycle_eval")
def o_last_cycle():
    src = f"""
SELECT p.predicted, CAST(t.rul AS DOUBLE) AS actual
FROM ({SQL_HOLD_PRED}) p
JOIN (SELECT unit_number, max(time_cycles) AS time_cycles FROM li_hold GROUP BY unit_number) l USING (unit_number, time_cycles)
JOIN li_truth t USING (unit_number)"""
    return with_views(["li_train", "li_hold", "li_truth"], sql_round(sql_metrics(src, "test_"), _metric_cols("test_"), 4))


# ---------------------------------------------------------------- K5
@query("prefix_eval")
def q_prefix_eval(spark, sf):
    feats, truth = holdout_features(spark, sf)
    return rnd(md.prefix_eval(WINDOW_SCORER.transform(feats), truth), 4)


@oracle("prefix_eval")
def o_prefix_eval():
    src = f"""
SELECT p.predicted, CAST(t.rul AS DOUBLE) AS actual FROM
  (SELECT predicted, row_number() OVER (ORDER BY unit_number, time_cycles) AS pos FROM ({SQL_HOLD_PRED})) p
JOIN (SELECT rul, row_number() OVER (ORDER BY unit_number) AS pos FROM li_truth) t USING (pos)"""
    return with_views(["li_train", "li_hold", "li_truth"], sql_round(sql_metrics(src, "test_"), _metric_cols("test_"), 4))


# ---------------------------------------------------------------- L9
@query("actual_vs_predicted")
def q_avp(spark, sf):
    scored, _ = train_scored(spark, sf)
    return rnd(md.actual_vs_predicted(scored), 6)


@oracle("actual_vs_predicted")
def o_avp():
    return with_views(["li_train"], sql_round(f"""
SELECT unit_number, time_cycles, actual, predicted,
       1.0 - sum((predicted - actual) * (predicted - actual)) OVER () / (var_pop(actual) OVER () * count(*) OVER ()) AS r2
FROM ({SQL_TRAIN_PAIRS})""", ["actual", "predicted", "r2"]))


# ---------------------------------------------------------------- A10 / A11
@query("error_histogram")
def q_error_hist(spark, sf):
    scored, _ = train_scored(spark, sf)
    return rnd(mt.histogram(scored, F.col("predicted") - F.col(TARGET), ERROR_HIST_BINS))


def sql_histogram(src: str, value: str, bins: int, part: str | None = None) -> str:
    pk = part or "_all"
    psel = part if part else "0"
    return f"""
WITH x AS (SELECT {psel} AS {pk}, CAST({value} AS DOUBLE) AS v FROM ({src}) WHERE v IS NOT NULL AND NOT isnan(v)),
st AS (SELECT {pk}, min(v) AS lo, max(v) AS hi FROM x GROUP BY {pk}),
c AS (SELECT x.{pk}, CAST(CASE WHEN hi > lo THEN least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) ELSE 0 END AS INTEGER) AS bin,
             count(*) AS n
      FROM x JOIN st USING ({pk}) GROUP BY ALL),
g AS (SELECT {pk}, lo, hi, CAST(b AS INTEGER) AS bin FROM st, range(0, {bins}) r(b))
SELECT {part + ', ' if part else ''}g.bin, lo + (hi - lo) / {bins} * g.bin AS bin_lo, lo + (hi - lo) / {bins} * (g.bin + 1) AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN c USING ({pk}, bin)"""


@oracle("error_histogram")
def o_error_hist():
    src = f"SELECT predicted - actual AS err FROM ({SQL_TRAIN_PAIRS})"
    return with_views(["li_train"], sql_round(sql_histogram(src, "err", ERROR_HIST_BINS), ["bin_lo", "bin_hi"]))


@query("rul_histogram")
def q_rul_hist(spark, sf):
    scored, _ = train_scored(spark, sf)
    tall = scored.select(
        F.explode(F.array(
            F.struct(F.lit("actual").alias("series"), F.col(TARGET).cast("double").alias("v")),
            F.struct(F.lit("predicted").alias("series"), F.col("predicted").alias("v")),
        )).alias("_x")
    ).select("_x.*")
    return rnd(mt.histogram(tall, "v", RUL_HIST_BINS, part="series"))


@oracle("rul_histogram")
def o_rul_hist():
    src = f"SELECT 'actual' AS series, actual AS v FROM ({SQL_TRAIN_PAIRS}) UNION ALL SELECT 'predicted', predicted FROM ({SQL_TRAIN_PAIRS})"
    return with_views(["li_train"], sql_round(sql_histogram(src, "v", RUL_HIST_BINS, "series"), ["bin_lo", "bin_hi"]))


# ---------------------------------------------------------------- L2
RIDGE_FEATURE = "s_3_roll_mean_5"


def sql_ridge(src: str, x: str, y: str, alpha: float = 1.0) -> str:
    return f"""
SELECT slope, my - slope * mx AS intercept FROM (
  SELECT sum((x - mx) * (y - my)) / (sum((x - mx) * (x - mx)) + {alpha}) AS slope, any_value(mx) AS mx, any_value(my) AS my
  FROM (SELECT {x} AS x, CAST({y} AS DOUBLE) AS y, avg({x}) OVER () AS mx, avg(CAST({y} AS DOUBLE)) OVER () AS my FROM ({src})))"""


#: The one-feature queries compute the windows that the feature needs.
RIDGE_CONFIG = {"rolling_window_sizes": [5], "lag_steps": []}


@query("ridge_fit")
def q_ridge(spark, sf):
    feats, _ = fe.fit_transform(train_split(fleet_lineitem(spark, sf)), RIDGE_CONFIG, columns=[RIDGE_FEATURE])
    feats = cut_lineage(feats.select(RIDGE_FEATURE, TARGET), "ridge-rows")  # both passes of the sums read it
    m = md.ridge_fit(feats, [RIDGE_FEATURE], TARGET, alpha=1.0)
    return rnd(spark.createDataFrame([(RIDGE_FEATURE, m.coefficients[0], m.intercept)], "feature string, coefficient double, intercept double"), 4)


@oracle("ridge_fit")
def o_ridge():
    sql, _ = sql_fitted_features()
    return with_views(["li_train"], sql_round(
        f"SELECT '{RIDGE_FEATURE}' AS feature, slope AS coefficient, intercept FROM ({sql_ridge(sql, RIDGE_FEATURE, TARGET)})",
        ["coefficient", "intercept"], 4))


# ---------------------------------------------------------------- L4 / L5
@query("kfold_contiguous")
def q_kfold(spark, sf):
    return md.kfold_contiguous(train_split(fleet_lineitem(spark, sf)), FOLDS).select(UNIT, CYCLE, "fold")


@oracle("kfold_contiguous")
def o_kfold():
    return with_views(["li_train"], f"""
SELECT unit_number, time_cycles, CAST(ntile({FOLDS}) OVER (ORDER BY unit_number, time_cycles) - 1 AS INTEGER) AS fold FROM li_train""")


@query("group_kfold")
def q_group_kfold(spark, sf):
    return md.group_kfold(train_split(fleet_lineitem(spark, sf)), FOLDS)


# one engine after the other, by the greedy rule itself
SQL_GROUP_FOLDS = f"""
WITH RECURSIVE eng AS (
  SELECT unit_number, n_rows, row_number() OVER (ORDER BY n_rows DESC, unit_number) AS i
  FROM (SELECT unit_number, count(*) AS n_rows FROM li_train GROUP BY unit_number)),
deal AS (
  SELECT 0::BIGINT AS i, 0::BIGINT AS fold, {[0] * FOLDS}::BIGINT[] AS loads
  UNION ALL
  SELECT e.i, list_position(loads, list_min(loads)) - 1,
         list_transform(loads, lambda x, j: CASE WHEN j = list_position(loads, list_min(loads)) THEN x + e.n_rows ELSE x END)
  FROM deal d JOIN eng e ON e.i = d.i + 1)
SELECT eng.unit_number, eng.n_rows, CAST(deal.fold AS INTEGER) AS fold FROM eng JOIN deal USING (i)"""


@oracle("group_kfold")
def o_group_kfold():
    return with_views(["li_train"], f"SELECT * FROM ({SQL_GROUP_FOLDS})")


# ---------------------------------------------------------------- L3 / A7
@query("cv_rmse")
def q_cv_rmse(spark, sf):
    """Group folds, one-feature ridge per fold, out-of-fold RMSE mean and std."""
    train = train_split(fleet_lineitem(spark, sf))
    feats, _ = fe.fit_transform(train, RIDGE_CONFIG, columns=[RIDGE_FEATURE])
    feats = cut_lineage(feats.select(UNIT, CYCLE, RIDGE_FEATURE, TARGET), "cv-rows")  # the sums and the scores read it
    data = md.with_folds(feats, md.group_kfold(train, FOLDS))
    oof = md.cv_predictions(data, [RIDGE_FEATURE], {"type": "ridge", "ridge": {"alpha": 1.0}})
    return rnd(md.cv_rmse(oof), 4)


@oracle("cv_rmse")
def o_cv_rmse():
    sql, _ = sql_fitted_features()
    x, y = RIDGE_FEATURE, TARGET
    body = f"""
WITH d AS (SELECT f.{x} AS x, CAST(f.{y} AS DOUBLE) AS y, g.fold FROM ({sql}) f JOIN ({SQL_GROUP_FOLDS}) g USING (unit_number)),
fs AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM d GROUP BY fold),
tot AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM fs),
m AS (SELECT fs.fold, (tot.sxy - fs.sxy - (tot.sx - fs.sx) * (tot.sy - fs.sy) / (tot.n - fs.n))
                      / ((tot.sxx - fs.sxx - (tot.sx - fs.sx) * (tot.sx - fs.sx) / (tot.n - fs.n)) + 1.0) AS slope,
             (tot.sx - fs.sx) / (tot.n - fs.n) AS mx, (tot.sy - fs.sy) / (tot.n - fs.n) AS my FROM fs, tot),
r AS (SELECT d.fold, sqrt(avg(((m.my - m.slope * m.mx) + m.slope * d.x - d.y) * ((m.my - m.slope * m.mx) + m.slope * d.x - d.y))) AS rmse
      FROM d JOIN m USING (fold) GROUP BY d.fold)
SELECT avg(rmse) AS cv_rmse_mean, stddev_pop(rmse) AS cv_rmse_std, count(*) AS n_folds FROM r"""
    return with_views(["li_train"], sql_round(body, ["cv_rmse_mean", "cv_rmse_std"], 4))


# ---------------------------------------------------------------- L1 / L6 / L7 / K1 (rows-only)
def _gbt(spark, sf):
    feats, state = fitted(spark, sf)
    feats = cut_lineage(fe.feature_matrix(feats, state), "features")  # the limits and the bins read it
    return md.gbt_fit(feats, state.feature_columns), state


@query("gbt_train_predict")
def q_gbt(spark, sf):
    """200 trees of depth 6; scores of the hold-out engines' last rows."""
    model, state = _gbt(spark, sf)
    hold, _ = holdout_split(fleet_lineitem(spark, sf, ends=True))
    last = fe.last_row_features(hold, state)
    return md.predict(model, last, state.feature_columns).select(UNIT, CYCLE, "predicted")


@query("feature_importance_topk")
def q_importance(spark, sf):
    """Top features of the 200 trees by mean split gain."""
    model, state = _gbt(spark, sf)
    return md.importance_topk(spark, model, state.feature_columns)


# a linear model has the same report with an oracle: two features, ranked by absolute coefficient
TWO_FEATURES = ["s_3_roll_mean_5", "s_2_roll_max_20"]


@query("linear_importance_topk")
def q_linear_importance(spark, sf):
    feats, _ = fitted(spark, sf, columns=TWO_FEATURES)
    feats = cut_lineage(feats.select(*TWO_FEATURES, TARGET), "ridge-rows")
    model = md.ridge_fit(feats, TWO_FEATURES, TARGET, alpha=1.0)
    return rnd(md.importance_topk(spark, model, TWO_FEATURES), 4)


@oracle("linear_importance_topk")
def o_linear_importance():
    sql, _ = sql_fitted_features()
    a, b = TWO_FEATURES
    body = f"""
WITH d AS (SELECT {a} AS a, {b} AS b, CAST(rul AS DOUBLE) AS y FROM ({sql})),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM d),
s AS (SELECT sum((a - ma) * (a - ma)) + 1.0 AS aa, sum((b - mb) * (b - mb)) + 1.0 AS bb, sum((a - ma) * (b - mb)) AS ab,
             sum((a - ma) * (y - my)) AS ay, sum((b - mb) * (y - my)) AS yb FROM d, m),
w AS (SELECT '{a}' AS feature, abs((ay * bb - yb * ab) / (aa * bb - ab * ab)) AS importance FROM s
      UNION ALL SELECT '{b}', abs((yb * aa - ay * ab) / (aa * bb - ab * ab)) FROM s)
SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM w"""
    return with_views(["li_train"], sql_round(body, ["importance"], 4))


# stump: one tree of one split over one feature of few values, against the best split by SQL
@query("gbt_stump")
def q_stump(spark, sf):
    """The first split of boosted trees on two sensors of few distinct values: feature, limit, gain and both leaves."""
    train = fe.rul_label(train_split(fleet_lineitem(spark, sf)), 125)
    model = boosting.fit_distributed(train, ["s_2", "s_4"], TARGET, {
        "n_estimators": 1, "max_depth": 1, "learning_rate": 1.0, "subsample": 1.0, "colsample_bytree": 1.0})
    tree = model.trees[0]
    k = int(tree.feature[0])
    row = (model.features[k], float(model.limits[k][tree.limit[0]]), float(tree.gain[0]), float(model.start + tree.value[1]), float(model.start + tree.value[2]))
    return rnd(spark.createDataFrame([row], "feature string, split double, gain double, left_value double, right_value double"), 3)


@oracle("gbt_stump")
def o_stump():
    body = """
WITH d AS (SELECT *, CAST(least(max(time_cycles) OVER (PARTITION BY unit_number) - time_cycles, 125) AS DOUBLE) AS y FROM li_train),
t AS (SELECT avg(y) AS my, count(*) AS n FROM d),
x AS (SELECT 's_2' AS feature, s_2 AS v, y FROM d UNION ALL SELECT 's_4', s_4, y FROM d),
c AS (SELECT feature, v, count(*) AS n, sum(my - y) AS g FROM x, t GROUP BY feature, v),
l AS (SELECT feature, v AS split, sum(n) OVER w AS ln, sum(g) OVER w AS lg, sum(n) OVER (PARTITION BY feature) AS tn,
             sum(g) OVER (PARTITION BY feature) AS tg FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)),
b AS (SELECT *, lg * lg / (ln + 1) + (tg - lg) * (tg - lg) / (tn - ln + 1) - tg * tg / (tn + 1) AS gain FROM l WHERE ln < tn)
SELECT feature, split, gain, my - lg / (ln + 1) AS left_value, my - (tg - lg) / (tn - ln + 1) AS right_value
FROM b, t ORDER BY gain DESC, feature, split LIMIT 1"""
    return with_views(["li_train"], sql_round(body, ["split", "gain", "left_value", "right_value"], 3))
