"""Queries for drift: per-feature tests, dataset share, gate, prediction drift,
keyed perturbation, impact, report table and the retrain decision.

Reference / current: first half of each engine's life vs the rest; the
current side of ``s_3`` is multiplied by 1.2 (the shifted case).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.config import CYCLE, UNIT
from cyclewise.operators import drift as dr
from cyclewise.operators import features as fe
from cyclewise.operators import retrain as rt
from cyclewise.plans.q_features import LI_SENSORS, sql_scaled
from cyclewise.plans.q_metrics import SCORER, SQL_PRED
from cyclewise.plans.registry import oracle, query, rnd, sql_round
from cyclewise.sources.views import fleet_events, fleet_lineitem, reference_current, train_split, with_engine_max, with_views

EV_FEATURES = ["s_2", "s_3", "s_band"]
REPORT_BINS = 20


def li_sides(spark, sf):
    ref, cur = reference_current(fleet_lineitem(spark, sf, ends=True))
    return ref, cur.withColumn("s_3", F.col("s_3") * F.lit(1.2))


def ev_sides(spark, sf):
    ev = fleet_events(spark, sf, ends=True).withColumn("s_band", F.floor(F.col("s_2") / F.lit(100.0)).cast("double"))
    return reference_current(ev)


SQL_LI_REF = "SELECT * FROM li_refcur WHERE side = 'reference'"
SQL_LI_CUR = "SELECT * REPLACE (s_3 * 1.2 AS s_3) FROM li_refcur WHERE side = 'current'"
SQL_EV_REF = "SELECT *, CAST(floor(s_2 / 100.0) AS DOUBLE) AS s_band FROM ev_refcur WHERE side = 'reference'"
SQL_EV_CUR = "SELECT *, CAST(floor(s_2 / 100.0) AS DOUBLE) AS s_band FROM ev_refcur WHERE side = 'current'"


# ---------------------------------------------------------------- SQL builders
def sql_stacked(ref: str, cur: str, features: list[str], group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    parts = []
    for side, src in (("reference", ref), ("current", cur)):
        for f in features:
            parts.append(f"SELECT {g}'{f}' AS feature, CAST({f} AS DOUBLE) AS value, '{side}' AS side FROM ({src})")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT * FROM ({body}) WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)"


def sql_stats(stacked: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {g}feature"
    return f"""
WITH cnt AS (SELECT {g}feature, value, sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) AS r,
                    sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) AS c
             FROM ({stacked}) GROUP BY ALL),
tot AS (SELECT {g}feature, sum(r) AS n_ref, sum(c) AS n_cur, sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) AS n_unique_ref,
               sum(r * value) AS sr, sum(r * value * value) AS sr2 FROM cnt GROUP BY ALL),
run AS (SELECT cnt.*, tot.n_ref, tot.n_cur,
               sum(r) OVER ({part} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / tot.n_ref AS fr,
               sum(c) OVER ({part} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / tot.n_cur AS fc,
               coalesce(lead(value) OVER ({part} ORDER BY value) - value, 0.0) AS step,
               r / tot.n_ref AS p, c / tot.n_cur AS q
        FROM cnt JOIN tot USING ({g}feature)),
per AS (SELECT {g}feature, max(abs(fr - fc)) AS ks_d, sum(abs(fr - fc) * step) AS wd,
               sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                   + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) AS js2
        FROM run GROUP BY ALL),
lam AS (SELECT per.*, tot.n_ref, tot.n_cur, tot.n_unique_ref,
               (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur))) * ks_d AS lam,
               sqrt(greatest(sr2 / n_ref - (sr / n_ref) * (sr / n_ref), 0.0)) AS sd
        FROM per JOIN tot USING ({g}feature))
SELECT {g}feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, CAST(n_unique_ref AS BIGINT) AS n_unique_ref,
       ks_d,
       CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2.0 * list_sum(list_transform(range(1, 101),
            lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))), 0.0), 1.0) END AS ks_p,
       wd / greatest(sd, 0.001) AS wasserstein_norm,
       sqrt(greatest(js2 / 2, 0.0)) AS jensenshannon
FROM lam"""


def sql_table(stats: str, stattest: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    ks = ("'ks'", "ks_p", "0.05", "ks_p <= 0.05")
    wd = ("'wasserstein'", "wasserstein_norm", "0.1", "wasserstein_norm >= 0.1")
    js = ("'jensenshannon'", "jensenshannon", "0.1", "jensenshannon >= 0.1")
    if stattest == "ks":
        pick = ks
    elif stattest == "wasserstein":
        pick = wd
    else:
        pick = tuple(
            f"CASE WHEN n_ref <= 1000 THEN {a} WHEN n_unique_ref <= 5 THEN {b} ELSE {c} END" for a, b, c in zip(ks, js, wd)
        )
    return f"""SELECT {g}feature, {pick[0]} AS stattest, CAST({pick[1]} AS DOUBLE) AS drift_score,
       CAST({pick[2]} AS DOUBLE) AS threshold, {pick[3]} AS drifted FROM ({stats})"""


def sql_li_stats() -> str:
    return sql_stats(sql_stacked(SQL_LI_REF, SQL_LI_CUR, LI_SENSORS))


# ---------------------------------------------------------------- M1
@query("ks_drift")
def q_ks(spark, sf):
    ref, cur = li_sides(spark, sf)
    st = dr.ks_stats(dr.stack_sides(ref, cur, LI_SENSORS))
    return rnd(st.select("feature", "n_ref", "n_cur", "ks_d", "ks_p", (F.col("ks_p") <= 0.05).alias("drifted")))


@oracle("ks_drift")
def o_ks():
    return with_views(["li_refcur"], sql_round(
        f"SELECT feature, n_ref, n_cur, ks_d, ks_p, ks_p <= 0.05 AS drifted FROM ({sql_li_stats()})", ["ks_d", "ks_p"]))


# ---------------------------------------------------------------- M4
@query("wasserstein_drift")
def q_wd(spark, sf):
    ref, cur = li_sides(spark, sf)
    return rnd(dr.data_drift(ref, cur, LI_SENSORS, "wasserstein"))


@oracle("wasserstein_drift")
def o_wd():
    return with_views(["li_refcur"], sql_round(sql_table(sql_li_stats(), "wasserstein"), ["drift_score", "threshold"]))


# ---------------------------------------------------------------- M5
@query("psi_drift")
def q_psi(spark, sf):
    ref, cur = li_sides(spark, sf)
    return rnd(dr.psi(ref, cur, LI_SENSORS))


@oracle("psi_drift")
def o_psi():
    st = sql_stacked(SQL_LI_REF, SQL_LI_CUR, LI_SENSORS)
    body = f"""
WITH st AS ({st}),
rg AS (SELECT feature, min(value) AS lo, max(value) AS hi,
              sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) AS n_ref, sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) AS n_cur,
              CAST(ceil(log2(count(*)) + 1.0) AS INTEGER) AS nb FROM st GROUP BY feature),
b AS (SELECT feature, CAST(CASE WHEN hi > lo THEN least(floor((value - lo) / (hi - lo) * nb), nb - 1) ELSE 0 END AS INTEGER) AS bin,
             sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) AS r, sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) AS c
      FROM st JOIN rg USING (feature) GROUP BY ALL),
s AS (SELECT feature, CASE WHEN r = 0 THEN 0.0001 ELSE r / n_ref END AS rs, CASE WHEN c = 0 THEN 0.0001 ELSE c / n_cur END AS cs
      FROM b JOIN rg USING (feature))
SELECT feature, 'psi' AS stattest, sum((cs - rs) * ln(cs / rs)) AS drift_score, CAST(0.1 AS DOUBLE) AS threshold,
       sum((cs - rs) * ln(cs / rs)) >= 0.1 AS drifted FROM s GROUP BY feature"""
    return with_views(["li_refcur"], sql_round(body, ["drift_score", "threshold"]))


# ---------------------------------------------------------------- M6
@query("auto_drift")
def q_auto(spark, sf):
    ref, cur = ev_sides(spark, sf)
    return rnd(dr.data_drift(ref, cur, EV_FEATURES, "auto"))


def sql_ev_stats() -> str:
    return sql_stats(sql_stacked(SQL_EV_REF, SQL_EV_CUR, EV_FEATURES))


@oracle("auto_drift")
def o_auto():
    return with_views(["ev_refcur"], sql_round(sql_table(sql_ev_stats(), "auto"), ["drift_score", "threshold"]))


# ---------------------------------------------------------------- M7 / A9
@query("dataset_drift")
def q_dataset_drift(spark, sf):
    ref, cur = li_sides(spark, sf)
    return rnd(dr.dataset_drift(dr.data_drift(ref, cur, LI_SENSORS, "ks")))


def sql_share(table: str) -> str:
    return f"""SELECT count(*) AS n_features, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted,
       CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS share_drifted FROM ({table})"""


@oracle("dataset_drift")
def o_dataset_drift():
    return with_views(["li_refcur"], sql_round(
        f"SELECT *, share_drifted >= 0.5 AS dataset_drift FROM ({sql_share(sql_table(sql_li_stats(), 'ks'))})", ["share_drifted"]))


# ---------------------------------------------------------------- M8
@query("drift_gate")
def q_gate(spark, sf):
    ref, cur = li_sides(spark, sf)
    return rnd(dr.drift_gate(dr.data_drift(ref, cur, LI_SENSORS, "auto")))


def sql_gate() -> str:
    return f"SELECT *, share_drifted < 0.3 AS test_suite_passed FROM ({sql_share(sql_table(sql_li_stats(), 'auto'))})"


@oracle("drift_gate")
def o_gate():
    return with_views(["li_refcur"], sql_round(sql_gate(), ["share_drifted"]))


# ---------------------------------------------------------------- M3
def _scaled_sides(spark, sf):
    state = fe.fit_state(train_split(fleet_lineitem(spark, sf)))
    ref, cur = reference_current(fleet_lineitem(spark, sf, ends=True))
    sc = {s: state.scaler[s] for s in state.sensor_cols}
    return SCORER.transform(fe.minmax_transform(ref, sc)), SCORER.transform(fe.minmax_transform(cur, sc))


@query("prediction_drift")
def q_pred_drift(spark, sf):
    ref, cur = _scaled_sides(spark, sf)
    return rnd(dr.prediction_drift(ref, cur))


def sql_prediction_drift() -> str:
    scaled = sql_scaled("li_refcur", "li_train", LI_SENSORS)
    preds = f"SELECT side, {SQL_PRED} AS predicted FROM ({scaled})"
    ref = f"SELECT predicted FROM ({preds}) WHERE side = 'reference'"
    cur = f"SELECT predicted FROM ({preds}) WHERE side = 'current'"
    st = sql_stats(sql_stacked(ref, cur, ["predicted"]))
    return f"""
SELECT wasserstein_norm >= 0.1 AS drift_detected, wasserstein_norm AS drift_score, CAST(0.1 AS DOUBLE) AS threshold,
       (SELECT avg(predicted) FROM ({ref})) AS reference_mean, (SELECT stddev_pop(predicted) FROM ({ref})) AS reference_std,
       (SELECT avg(predicted) FROM ({cur})) AS current_mean, (SELECT stddev_pop(predicted) FROM ({cur})) AS current_std
FROM ({st})"""


@oracle("prediction_drift")
def o_pred_drift():
    return with_views(["li_refcur", "li_train"], sql_round(
        sql_prediction_drift(), ["drift_score", "threshold", "reference_mean", "reference_std", "current_mean", "current_std"]))


# ---------------------------------------------------------------- M9 / M10
def _perturbed(spark, sf, parts):
    train = train_split(fleet_lineitem(spark, sf))
    return dr.perturb(train, LI_SENSORS, [UNIT, CYCLE], parts=parts).select(UNIT, CYCLE, *LI_SENSORS)


# values near 1e5 plus noise scaled by a summed std: compared at 4 decimals (about 1e-9 relative)
PERTURB_DIGITS = 4


@query("perturb_noise")
def q_noise(spark, sf):
    return rnd(_perturbed(spark, sf, (True, False)), PERTURB_DIGITS)


def _sql_u(expr: str) -> str:
    return f"((('0x' || substr(md5({expr}), 1, 8))::BIGINT + 1) / 4294967297.0)"


def sql_noise(keys: list[str], seed: int = 42) -> str:
    base = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + f", '{seed}')"
    u1 = _sql_u(f"concat_ws('|', {base}, 'a')")
    u2 = _sql_u(f"concat_ws('|', {base}, 'b')")
    return f"((sqrt(-2.0 * ln({u1})) * cos(2.0 * pi() * {u2})) * 0.15)"


def sql_sign(col: str, seed: int = 42) -> str:
    return f"(CASE WHEN ('0x' || substr(md5('{col}|{seed}'), 1, 8))::BIGINT % 2 = 0 THEN 1 ELSE -1 END)"


def sql_perturbed(src: str, cols: list[str], noise: bool, shift: bool, keys=(UNIT, CYCLE)) -> str:
    half = len(cols) // 2
    g1, g2 = cols[:half], cols[half:]
    stats = ", ".join([f"stddev_samp({c}) AS sd_{c}" for c in g1] + [f"max({c}) - min({c}) AS rg_{c}" for c in g2])
    repl = []
    if noise:
        repl += [f"CASE WHEN sd_{c} > 0 THEN {c} + {sql_noise(list(keys))} * sd_{c} ELSE {c} END AS {c}" for c in g1]
    if shift:
        repl += [f"CASE WHEN rg_{c} > 0 THEN {c} + 0.1 * rg_{c} * {sql_sign(c)} ELSE {c} END AS {c}" for c in g2]
    rep = f" REPLACE ({', '.join(repl)})" if repl else ""
    return f"WITH src AS MATERIALIZED ({src}) SELECT t.*{rep} FROM src t, (SELECT {stats} FROM src) st"


@oracle("perturb_noise")
def o_noise():
    return with_views(["li_train"], sql_round(
        f"SELECT unit_number, time_cycles, {', '.join(LI_SENSORS)} FROM ({sql_perturbed('SELECT * FROM li_train', LI_SENSORS, True, False)})",
        LI_SENSORS, PERTURB_DIGITS))


@query("perturb_shift")
def q_shift(spark, sf):
    return rnd(_perturbed(spark, sf, (False, True)), PERTURB_DIGITS)


@oracle("perturb_shift")
def o_shift():
    return with_views(["li_train"], sql_round(
        f"SELECT unit_number, time_cycles, {', '.join(LI_SENSORS)} FROM ({sql_perturbed('SELECT * FROM li_train', LI_SENSORS, False, True)})",
        LI_SENSORS, PERTURB_DIGITS))


# ---------------------------------------------------------------- M11 / A8
IMPACT_COLS = ["s_2", "s_3"]


def _impact(spark, sf):
    train = train_split(fleet_lineitem(spark, sf))
    state = fe.fit_state(train)
    scaled = fe.minmax_transform(train, {s: state.scaler[s] for s in state.sensor_cols}).select(UNIT, CYCLE, *LI_SENSORS)
    both = dr.perturb(scaled, IMPACT_COLS, [UNIT, CYCLE], suffix="__drifted")
    pairs = both.select(
        SCORER.prediction().alias("ref_pred"),
        SCORER.prediction({c: f"{c}__drifted" for c in IMPACT_COLS}).alias("drift_pred"),
    )
    return dr.drift_impact(pairs)


@query("drift_impact")
def q_impact(spark, sf):
    return rnd(_impact(spark, sf))


IMPACT_OUT = ["mean_prediction_change", "max_prediction_change", "pct_predictions_changed_gt_10",
              "reference_pred_mean", "drifted_pred_mean", "median_prediction_change"]


def sql_impact() -> str:
    scaled = f"SELECT unit_number, time_cycles, {', '.join(LI_SENSORS)} FROM ({sql_scaled('li_train', 'li_train', LI_SENSORS)})"
    drifted = sql_perturbed(scaled, IMPACT_COLS, True, True)
    return f"""
WITH p AS (SELECT a.unit_number, {SQL_PRED.replace('s_', 'a.s_')} AS ref_pred, {SQL_PRED.replace('s_', 'b.s_')} AS drift_pred
           FROM ({scaled}) a JOIN ({drifted}) b USING (unit_number, time_cycles)),
d AS (SELECT abs(drift_pred - ref_pred) AS d, ref_pred, drift_pred FROM p)
SELECT avg(d) AS mean_prediction_change, max(d) AS max_prediction_change,
       avg(CASE WHEN d > 10.0 THEN 1.0 ELSE 0.0 END) * 100.0 AS pct_predictions_changed_gt_10,
       avg(ref_pred) AS reference_pred_mean, avg(drift_pred) AS drifted_pred_mean, median(d) AS median_prediction_change
FROM d"""


@oracle("drift_impact")
def o_impact():
    return with_views(["li_train"], sql_round(sql_impact(), IMPACT_OUT))


# ---------------------------------------------------------------- M12
@query("drift_report_table")
def q_report_table(spark, sf):
    ref, cur = li_sides(spark, sf)
    return rnd(dr.drift_report_table(ref, cur, LI_SENSORS, REPORT_BINS))


@oracle("drift_report_table")
def o_report_table():
    st = sql_stacked(SQL_LI_REF, SQL_LI_CUR, LI_SENSORS)
    b = REPORT_BINS
    body = f"""
WITH st AS ({st}),
rg AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM st GROUP BY feature),
c AS (SELECT feature, side, CAST(CASE WHEN hi > lo THEN least(floor((value - lo) / (hi - lo) * {b}), {b - 1}) ELSE 0 END AS INTEGER) AS bin,
             count(*) AS n FROM st JOIN rg USING (feature) GROUP BY ALL),
g AS (SELECT feature, lo, hi, s.side, CAST(r.b AS INTEGER) AS bin
      FROM rg, (VALUES ('reference'), ('current')) s(side), range(0, {b}) r(b)),
v AS ({sql_table(sql_li_stats(), 'auto')})
SELECT g.feature, g.side, g.bin, lo + (hi - lo) / {b} * g.bin AS bin_lo, lo + (hi - lo) / {b} * (g.bin + 1) AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n, v.stattest, v.drift_score, v.threshold, v.drifted
FROM g LEFT JOIN c USING (feature, side, bin) JOIN v USING (feature)"""
    return with_views(["li_refcur"], sql_round(body, ["bin_lo", "bin_hi", "drift_score", "threshold"]))


# ---------------------------------------------------------------- M13
@query("retrain_decision")
def q_retrain(spark, sf):
    ref, cur = li_sides(spark, sf)
    table = dr.data_drift(ref, cur, LI_SENSORS, "ks")
    sref, scur = _scaled_sides(spark, sf)
    dec = rt.retrain_decision(
        dr.dataset_drift(table), table, dr.prediction_drift(sref, scur), _impact(spark, sf),
        dr.drift_gate(dr.data_drift(ref, cur, LI_SENSORS, "auto")),
    )
    return dec.select("should_retrain", F.array_join("reasons", "\n").alias("reasons"), "exit_code")


def sql_decision(ks: str, prediction: str, impact: str, gate: str) -> tuple[list[tuple[str, str]], str]:
    """CTEs and body of the retrain decision from the four layers' queries."""
    extra = [("ks", ks), ("share", sql_share("SELECT * FROM ks")),
             ("top", "SELECT list(feature ORDER BY drift_score, feature)[1:5] AS top FROM ks WHERE drifted"),
             ("pd", prediction), ("im", impact), ("gt", f"SELECT test_suite_passed FROM ({gate})")]
    extra.append(("flags", """SELECT share_drifted > 0.3 AS h1, drift_detected AS h2, mean_prediction_change > 10.0 AS h3,
                 NOT test_suite_passed AS h4, * FROM share, top, pd, im, gt"""))
    body = f"""
SELECT h1 OR h2 OR h3 OR h4 AS should_retrain,
       array_to_string(list_filter([
         CASE WHEN h1 THEN printf('DATA DRIFT: %.1f%% of features drifted (threshold: %.1f%%)', share_drifted * 100.0, 30.0)
              ELSE printf('Data drift OK: %.1f%% < %.1f%% threshold', share_drifted * 100.0, 30.0) END,
         CASE WHEN h1 AND len(top) > 0 THEN '  Top drifted features: [''' || array_to_string(top, ''', ''') || ''']' END,
         CASE WHEN h2 THEN printf('PREDICTION DRIFT: Detected (score=%.4f). Model output distribution has shifted.', drift_score)
              ELSE 'Prediction drift OK: not detected' END,
         CASE WHEN h3 THEN printf('CONCEPT DRIFT RISK: Mean prediction change = %.1f cycles, %.1f%% of predictions changed >10 cycles',
                                  mean_prediction_change, pct_predictions_changed_gt_10) END,
         CASE WHEN h4 THEN 'DRIFT TEST SUITE: FAILED — automated quality gate breached' END
       ], lambda x: x IS NOT NULL), chr(10)) AS reasons,
       CASE WHEN h1 OR h2 OR h3 OR h4 THEN 1 ELSE 0 END AS exit_code
FROM flags"""
    return extra, body


@oracle("retrain_decision")
def o_retrain():
    extra, body = sql_decision(sql_table(sql_li_stats(), "ks"), sql_prediction_drift(), sql_impact(), sql_gate())
    return with_views(["li_refcur", "li_train"], body, extra)


# ---------------------------------------------------------------- M1, small samples
def engine_halves(df, unit=UNIT, cycle=CYCLE):
    """Rows with ``side`` by the half of their engine's life."""
    m = with_engine_max(df)
    return m.withColumn("side", F.when(F.col(cycle) * 2 <= F.col("max_cycle"), F.lit(dr.REF)).otherwise(F.lit(dr.CUR)))


@query("ks_drift_small")
def q_ks_small(spark, sf):
    """Each engine's first half of life against its second: samples this small have an exact p-value."""
    halves = engine_halves(fleet_events(spark, sf, ends=True)).select(UNIT, F.lit("s_2").alias("feature"), F.col("s_2").alias("value"), "side")
    st = dr.feature_stats(dr.value_counts(halves.filter(dr.finite(F.col("value"))), [UNIT]), [UNIT])
    return rnd(st.select(UNIT, "n_ref", "n_cur", "ks_d", "ks_p", (F.col("ks_p") <= 0.05).alias("drifted")))


@oracle("ks_drift_small")
def o_ks_small():
    """Paths from (0, 0) to (n, m) of a draw without replacement, step by step; the share that ever gets d apart."""
    st = sql_stats("SELECT unit_number, 's_2' AS feature, s_2 AS value, side FROM ev_refcur", "unit_number")
    body = """
, z AS (SELECT unit_number, n_ref AS n, n_cur AS m, ks_d FROM st),
w AS (
  SELECT unit_number, 0 AS s, 0 AS i, 1.0::DOUBLE AS p, 0.0::DOUBLE AS gone, n, m, ks_d FROM z
  UNION ALL
  SELECT unit_number, s, i, sum(CASE WHEN abs(i / n - (s - i) / m) < ks_d - 1e-9 THEN q ELSE 0 END),
         sum(CASE WHEN abs(i / n - (s - i) / m) < ks_d - 1e-9 THEN 0 ELSE q END), n, m, ks_d
  FROM (SELECT unit_number, s + 1 AS s, i + g AS i, p * (CASE WHEN g = 1 THEN n - i ELSE m - (s - i) END) / (n + m - s) AS q, n, m, ks_d
        FROM w, (SELECT unnest([0, 1]) AS g) WHERE s < n + m AND p > 0) GROUP BY ALL)
SELECT unit_number, any_value(n)::BIGINT AS n_ref, any_value(m)::BIGINT AS n_cur, any_value(ks_d) AS ks_d, sum(gone) AS ks_p,
       round(sum(gone), 6) <= 0.05 AS drifted FROM w GROUP BY unit_number"""
    views = with_views(["ev_refcur"], "", [("st", st)]).replace("WITH ", "WITH RECURSIVE ", 1)
    return f"SELECT * REPLACE (round(ks_d, 6) AS ks_d, round(ks_p, 6) AS ks_p) FROM (\n{views}{body}\n) q"
