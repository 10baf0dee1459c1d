"""Queries for sources of features: RUL, drop, scaler, windows, feature matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.config import CYCLE, FEATURE_DEFAULTS, KEYS, TARGET, UNIT
from cyclewise.operators import features as fe
from cyclewise.plans.registry import oracle, query, rnd, sql_round
from cyclewise.sources.views import fleet_events, fleet_lineitem, holdout_split, train_split, with_views

LI_SENSORS = ["s_2", "s_3", "s_4", "s_7"]  # active lineitem sensors after the default drop list
EV_SENSORS = ["s_2", "s_3"]
WINDOWS = FEATURE_DEFAULTS["rolling_window_sizes"]
LAGS = FEATURE_DEFAULTS["lag_steps"]


# ---------------------------------------------------------------- SQL builders
def sql_scaled(src: str, fit_src: str, sensors: list[str]) -> str:
    """SELECT over ``src`` with ``sensors`` min-max scaled by bounds fitted on ``fit_src``."""
    mm = ", ".join(f"min({s}) AS mn_{s}, max({s}) AS mx_{s}" for s in sensors)
    scaled = ", ".join(
        f"CASE WHEN mx_{s} > mn_{s} THEN ({s} - mn_{s}) / (mx_{s} - mn_{s}) ELSE {s} - mn_{s} END AS {s}"
        for s in sensors
    )
    return f"SELECT t.* REPLACE ({scaled}) FROM {src} t CROSS JOIN (SELECT {mm} FROM {fit_src}) b"


def sql_window_features(src: str, sensors: list[str], windows: list[int], lags: list[int],
                        keep: list[str]) -> tuple[str, list[str]]:
    """Direct form: rolling frames, lag -> back-fill -> table mean, diff. Returns (sql, feature cols)."""
    part = f"PARTITION BY {UNIT} ORDER BY {CYCLE}"
    first = []
    for s in sensors:
        for w in windows:
            fr = f"OVER ({part} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            first += [
                f"avg({s}) {fr} AS {s}_roll_mean_{w}",
                f"coalesce(stddev_samp({s}) {fr}, 0.0) AS {s}_roll_std_{w}",
                f"min({s}) {fr} AS {s}_roll_min_{w}",
                f"max({s}) {fr} AS {s}_roll_max_{w}",
            ]
        first += [f"lag({s}, {k}) OVER ({part}) AS {s}_lagraw_{k}" for k in lags]
        first.append(f"coalesce({s} - lag({s}, 1) OVER ({part}), 0.0) AS {s}_diff")
    bf = ", ".join(
        f"first_value({s}_lagraw_{k} IGNORE NULLS) OVER ({part} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        f" AS {s}_lagbf_{k}"
        for s in sensors for k in lags
    )
    fill = ", ".join(f"coalesce({s}_lagbf_{k}, avg({s}_lagbf_{k}) OVER ()) AS {s}_lag_{k}" for s in sensors for k in lags)
    feats = fe.feature_names(sensors, windows, lags)
    others = [f for f in feats if "_lag_" not in f]
    sql = f"""
SELECT {', '.join(keep)}, {', '.join(others)}, {fill} FROM (
  SELECT *, {bf} FROM (
    SELECT *, {', '.join(first)} FROM {src}
  ) a
) b"""
    return sql, feats


# ---------------------------------------------------------------- W1 / P7
@query("rul_label")
def q_rul_label(spark, sf):
    return fe.rul_label(fleet_lineitem(spark, sf), 125).select(UNIT, CYCLE, TARGET)


@oracle("rul_label")
def o_rul_label():
    return with_views(["fleet_lineitem"], """
SELECT unit_number, time_cycles,
       CAST(least(max(time_cycles) OVER (PARTITION BY unit_number) - time_cycles, 125) AS INTEGER) AS rul
FROM fleet_lineitem""")


# ---------------------------------------------------------------- P1
@query("drop_sensors")
def q_drop_sensors(spark, sf):
    # the list holds indices that are absent (5, 10, ...) and present (1); both are fine
    return fe.drop_sensors(fleet_lineitem(spark, sf), FEATURE_DEFAULTS["drop_sensors"])


@oracle("drop_sensors")
def o_drop_sensors():
    return with_views(["fleet_lineitem"], "SELECT * EXCLUDE (s_1) FROM fleet_lineitem")


# ---------------------------------------------------------------- A2 / F3
@query("minmax_fit")
def q_minmax_fit(spark, sf):
    df = fleet_lineitem(spark, sf)
    return fe.minmax_fit(df, ["s_1"] + LI_SENSORS)


@oracle("minmax_fit")
def o_minmax_fit():
    parts = [
        f"SELECT {i} AS ord, '{s}' AS sensor, CAST(min({s}) AS DOUBLE) AS data_min, CAST(max({s}) AS DOUBLE) AS data_max "
        f"FROM fleet_lineitem"
        for i, s in enumerate(["s_1"] + LI_SENSORS)
    ]
    return with_views(["fleet_lineitem"], "\nUNION ALL\n".join(parts))


@query("minmax_transform")
def q_minmax_transform(spark, sf):
    """Scaler fitted on training engines, applied to hold-out engines (no clipping)."""
    df = fleet_lineitem(spark, sf)
    sensors = ["s_1"] + LI_SENSORS
    rows = fe.minmax_fit(train_split(df), sensors).collect()
    scaler = {r["sensor"]: (r["data_min"], r["data_max"]) for r in rows}
    hold, _ = holdout_split(fleet_lineitem(spark, sf, ends=True))
    return rnd(fe.minmax_transform(hold, scaler).select(*KEYS, *sensors))


@oracle("minmax_transform")
def o_minmax_transform():
    sensors = ["s_1"] + LI_SENSORS
    inner = sql_scaled("li_hold", "li_train", sensors)
    return with_views(["li_train", "li_hold"], sql_round(
        f"SELECT unit_number, time_cycles, {', '.join(sensors)} FROM ({inner})", sensors))


# ---------------------------------------------------------------- W2 / W3
def _events_windows(spark, sf, lags):
    df = fleet_events(spark, sf)
    return fe.window_features(df, EV_SENSORS, WINDOWS, lags)


@query("rolling_features")
def q_rolling(spark, sf):
    cols = [c for c in fe.feature_names(EV_SENSORS, WINDOWS, []) if "_roll_" in c]
    return rnd(_events_windows(spark, sf, [1]).select(*KEYS, *cols))


@oracle("rolling_features")
def o_rolling():
    sql, feats = sql_window_features("fleet_events", EV_SENSORS, WINDOWS, [1], KEYS)
    cols = [c for c in feats if "_roll_" in c]
    return with_views(["fleet_events"], sql_round(f"SELECT {', '.join(KEYS + cols)} FROM ({sql})", cols))


# ---------------------------------------------------------------- W4 (incl. engines shorter than k)
EV_LAGS = [1, 3, 5, 60]


@query("lag_features")
def q_lag(spark, sf):
    cols = [f"{s}_lag_{k}" for s in EV_SENSORS for k in EV_LAGS]
    return rnd(_events_windows(spark, sf, EV_LAGS).select(*KEYS, *cols))


@oracle("lag_features")
def o_lag():
    sql, _ = sql_window_features("fleet_events", EV_SENSORS, WINDOWS, EV_LAGS, KEYS)
    cols = [f"{s}_lag_{k}" for s in EV_SENSORS for k in EV_LAGS]
    return with_views(["fleet_events"], sql_round(f"SELECT {', '.join(KEYS + cols)} FROM ({sql})", cols))


# ---------------------------------------------------------------- W5
@query("diff_features")
def q_diff(spark, sf):
    df = fleet_lineitem(spark, sf)
    cols = [f"{s}_diff" for s in LI_SENSORS]
    return rnd(fe.window_features(df, LI_SENSORS, [1], [1]).select(*KEYS, *cols))


@oracle("diff_features")
def o_diff():
    cols = ", ".join(
        f"coalesce({s} - lag({s}, 1) OVER (PARTITION BY unit_number ORDER BY time_cycles), 0.0) AS {s}_diff"
        for s in LI_SENSORS
    )
    return with_views(["fleet_lineitem"], sql_round(
        f"SELECT unit_number, time_cycles, {cols} FROM fleet_lineitem", [f"{s}_diff" for s in LI_SENSORS]))


# ---------------------------------------------------------------- F1 / P3 / P5
def fitted(spark, sf, segment_rows: int = fe.DEFAULT_SEGMENT_ROWS, columns: list[str] | None = None):
    """Feature table and state fitted on the training engines of the lineitem fleet."""
    df = fleet_lineitem(spark, sf)
    return fe.fit_transform(train_split(df), segment_rows=segment_rows, columns=columns)


def sql_fitted_features() -> tuple[str, list[str]]:
    scaled = sql_scaled("li_train", "li_train", LI_SENSORS)
    src = f"""(SELECT s.*, CAST(least(max(time_cycles) OVER (PARTITION BY unit_number) - time_cycles, 125) AS INTEGER) AS rul
FROM ({scaled}) s)"""
    return sql_window_features(src, LI_SENSORS, WINDOWS, LAGS, KEYS + [TARGET])


@query("feature_matrix")
def q_feature_matrix(spark, sf):
    out, state = fitted(spark, sf)
    return rnd(fe.feature_matrix(out, state))


@oracle("feature_matrix")
def o_feature_matrix():
    sql, feats = sql_fitted_features()
    return with_views(["li_train"], sql_round(sql, feats))


# ---------------------------------------------------------------- F2
@query("transform_holdout")
def q_transform_holdout(spark, sf):
    state = fe.fit_state(train_split(fleet_lineitem(spark, sf)))
    hold, _ = holdout_split(fleet_lineitem(spark, sf, ends=True))
    return rnd(fe.feature_matrix(fe.transform(hold, state), state))


@oracle("transform_holdout")
def o_transform_holdout():
    scaled = sql_scaled("li_hold", "li_train", LI_SENSORS)
    sql, feats = sql_window_features(f"({scaled})", LI_SENSORS, WINDOWS, LAGS, KEYS)
    return with_views(["li_train", "li_hold"], sql_round(sql, feats))


# ---------------------------------------------------------------- P4
@query("align_features")
def q_align(spark, sf):
    """Events engines scored against the lineitem feature list: extra columns go, missing become 0."""
    state = fe.fit_state(train_split(fleet_lineitem(spark, sf)))
    ev = fe.transform(fleet_events(spark, sf), state)
    return rnd(fe.align_features(ev, state.feature_columns[:6] + ["s_9_lag_1"], KEYS))


@oracle("align_features")
def o_align():
    # first six lineitem feature names, sorted: s_2, s_2_diff, s_2_lag_1, s_2_lag_3, s_2_lag_5, s_2_roll_max_10
    scaled = sql_scaled("fleet_events", "li_train", ["s_2"])
    sql, _ = sql_window_features(f"(SELECT * EXCLUDE (s_3) FROM ({scaled}))", ["s_2"], WINDOWS, LAGS, KEYS)
    cols = ["s_2", "s_2_diff", "s_2_lag_1", "s_2_lag_3", "s_2_lag_5", "s_2_roll_max_10"]
    return with_views(["li_train", "fleet_events"], sql_round(
        f"SELECT {', '.join(KEYS + cols)}, CAST(0.0 AS DOUBLE) AS s_9_lag_1 FROM ({sql})", cols + ["s_9_lag_1"]))


# ---------------------------------------------------------------- F4
@query("state_roundtrip")
def q_state_roundtrip(spark, sf):
    """Save the fitted state to the shared folder, load it, and return its scaler table."""
    from cyclewise.session import scratch_path

    state = fe.fit_state(train_split(fleet_lineitem(spark, sf)))
    path = scratch_path(spark, "feature-state")
    state.save(spark, path)
    back = fe.FeatureState.load(spark, path)
    tbl = back.scaler_table(spark)
    return rnd(tbl.withColumn("n_features", F.lit(len(back.feature_columns)).cast("int")))


@oracle("state_roundtrip")
def o_state_roundtrip():
    n = len(fe.feature_names(LI_SENSORS, WINDOWS, LAGS))
    parts = [
        f"SELECT {i} AS ord, '{s}' AS sensor, CAST(min({s}) AS DOUBLE) AS data_min, "
        f"CAST(max({s}) AS DOUBLE) AS data_max, CAST({n} AS INTEGER) AS n_features FROM li_train"
        for i, s in enumerate(LI_SENSORS)
    ]
    return with_views(["li_train"], sql_round("\nUNION ALL\n".join(parts), ["data_min", "data_max"]))
