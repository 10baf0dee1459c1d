import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import features as fe

from frames import sensor_frame

CFG = {"rul_cap": 125, "drop_sensors": [1, 5, 10, 16, 18, 19], "rolling_window_sizes": [5, 10], "lag_steps": [1, 3]}


def test_rul_bounds_and_shape(sensors):
    out = fe.rul_label(sensors, 125).toPandas().sort_values(["unit_number", "time_cycles"])
    assert (out["rul"] >= 0).all() and (out["rul"] <= 125).all()
    last = out.groupby("unit_number").tail(1)
    assert (last["rul"] == 0).all()
    for _, g in out.groupby("unit_number"):
        assert (np.diff(g["rul"].to_numpy()) <= 0).all()


def test_drop_sensors(sensors):
    assert "s_1" not in fe.drop_sensors(sensors, [1, 5]).columns
    assert fe.drop_sensors(sensors, []).columns == sensors.columns
    assert fe.drop_sensors(sensors, [99]).columns == sensors.columns


def _pandas_windows(df: pd.DataFrame, sensors, windows, lags):
    df = df.sort_values(["unit_number", "time_cycles"]).reset_index(drop=True)
    g = df.groupby("unit_number")
    out = df[["unit_number", "time_cycles"]].copy()
    for s in sensors:
        for w in windows:
            r = g[s].rolling(w, min_periods=1)
            out[f"{s}_roll_mean_{w}"] = r.mean().reset_index(level=0, drop=True)
            out[f"{s}_roll_std_{w}"] = r.std().reset_index(level=0, drop=True).fillna(0.0)
            out[f"{s}_roll_min_{w}"] = r.min().reset_index(level=0, drop=True)
            out[f"{s}_roll_max_{w}"] = r.max().reset_index(level=0, drop=True)
        for k in lags:
            lagged = g[s].shift(k)
            filled = lagged.groupby(df["unit_number"]).bfill()
            out[f"{s}_lag_{k}"] = filled.fillna(filled.mean())
        out[f"{s}_diff"] = g[s].diff().fillna(0.0)
    return out


@pytest.mark.parametrize("segment_rows", [fe.DEFAULT_SEGMENT_ROWS, 7])
def test_windows_match_pandas(spark, segment_rows):
    pdf = sensor_frame((12, 3, 30))  # engine 2 is shorter than lag 5: table-mean fallback
    sens = ["s_2", "s_3"]
    got = fe.window_features(spark.createDataFrame(pdf), sens, [5, 10], [1, 3, 5], segment_rows=segment_rows).toPandas()
    got = got.sort_values(["unit_number", "time_cycles"]).reset_index(drop=True)
    want = _pandas_windows(pdf, sens, [5, 10], [1, 3, 5])
    for c in want.columns:
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_windows_with_gaps_match_pandas(spark):
    pdf = sensor_frame((15, 20))
    pdf.loc[[0, 3, 17, 18], "s_2"] = np.nan
    sens = ["s_2"]
    got = fe.window_features(spark.createDataFrame(pdf).withColumn("s_2", fe.nan_to_null("s_2")), sens, [5], [1, 3], segment_rows=6)
    got = got.toPandas().sort_values(["unit_number", "time_cycles"]).reset_index(drop=True)
    want = _pandas_windows(pdf, sens, [5], [1, 3])
    for c in ["s_2_lag_1", "s_2_lag_3", "s_2_roll_mean_5", "s_2_roll_max_5"]:
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-9, err_msg=c)


def test_no_cross_engine_leak(sensors):
    out, _ = fe.fit_transform(sensors, CFG)
    first = out.filter(F.col("time_cycles") == 1).select("s_2", "s_2_roll_mean_10", "s_2_roll_std_10", "s_2_diff").collect()
    for r in first:
        assert r["s_2_roll_mean_10"] == pytest.approx(r["s_2"])
        assert r["s_2_roll_std_10"] == 0.0 and r["s_2_diff"] == 0.0


def test_no_missing_after_fill(sensors):
    out, state = fe.fit_transform(sensors, CFG)
    m = fe.feature_matrix(out, state)
    nulls = m.select(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in state.feature_columns]).first()
    assert sum(nulls) == 0
    assert len(state.feature_columns) == 15 * (1 + 4 * 2 + 2 + 1)


def test_state_roundtrip_and_frozen_scaler(spark, sensors, tmp_path):
    _, state = fe.fit_transform(sensors, CFG)
    path = str(tmp_path / "state")
    state.save(spark, path)
    back = fe.FeatureState.load(spark, path)
    assert back.scaler == state.scaler and back.feature_columns == state.feature_columns
    shifted = sensors.withColumn("s_2", F.col("s_2") + 1000.0)
    lo, hi = state.scaler["s_2"]
    got = fe.transform(shifted, back).agg(F.min("s_2")).first()[0]
    assert got > 1.0  # not re-fitted, not clipped
    assert got == pytest.approx((sensors.agg(F.min("s_2")).first()[0] + 1000.0 - lo) / (hi - lo))


def test_unfitted_state_raises(sensors):
    with pytest.raises(RuntimeError):
        fe.transform(sensors, None)
    with pytest.raises(FileNotFoundError):
        fe.FeatureState.load(sensors.sparkSession, "/nonexistent/state")


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, t, 5.0) for t in range(1, 6)], "unit_number int, time_cycles int, s_1 double")
    rows = fe.minmax_fit(df, ["s_1"]).collect()
    out = fe.minmax_transform(df, {"s_1": (rows[0]["data_min"], rows[0]["data_max"])})
    assert {r[0] for r in out.select("s_1").collect()} == {0.0}


def test_align_features(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "unit_number int, a double, extra double")
    out = fe.align_features(df, ["a", "b"], ["unit_number"])
    assert out.columns == ["unit_number", "a", "b"]
    assert out.first()["b"] == 0.0


def _lags_by_hand(values, lags):
    """pandas form: shift, back-fill per unit."""
    import pandas as pd

    s = pd.Series(values, dtype="float64")
    return {k: s.shift(k).bfill() for k in lags}


def test_features_depend_on_own_rows_only(spark):
    """Cycles that start anywhere and have gaps, missing readings of a neighbour, NULL keys: each unit stands alone."""
    import pandas as pd
    from pyspark.sql import functions as F

    from cyclewise.operators import features as fe

    one = [(1, 100 + 3 * i, float(i * i)) for i in range(10)]
    two = [(2, 70000 * (i + 1), None if i in (2, 8, 9) else float(i)) for i in range(10)]
    none = [(None, 5, 1.5), (None, 9, 2.5)]
    schema = "unit_number int, time_cycles int, s_2 double"
    alone = spark.createDataFrame(one, schema)
    everyone = spark.createDataFrame(one + two + none, schema).repartition(5)
    for rows in (1 << 16, 4):
        full = fe.window_features(everyone, ["s_2"], [3], [1, 3], segment_rows=rows, lag_fill=False).toPandas()
        assert len(full) == 22
        own = fe.window_features(alone, ["s_2"], [3], [1, 3], segment_rows=rows, lag_fill=False).toPandas()
        pd.testing.assert_frame_equal(full[full.unit_number == 1].sort_values("time_cycles").reset_index(drop=True),
                                      own.sort_values("time_cycles").reset_index(drop=True), check_dtype=False)
        for unit, src in ((1, one), (2, two)):
            got = full[full.unit_number == unit].sort_values("time_cycles")
            for k, want in _lags_by_hand([v for _, _, v in src], [1, 3]).items():
                assert got[f"s_2_lag_{k}"].fillna(-1).tolist() == want.fillna(-1).tolist(), (unit, k, rows)
    filled = fe.window_features(everyone, ["s_2"], [3], [1, 3]).filter(F.col("s_2_lag_1").isNull()).count()
    assert filled == 0


def test_windows_far_from_zero_and_odd_sizes(spark):
    pdf = sensor_frame((40, 1, 25, 2))
    pdf["s_2"] = 1e9 + pdf["s_2"]
    pdf.loc[pdf.index % 6 == 2, "s_3"] = np.nan
    pdf.loc[pdf["unit_number"] == 2, "s_3"] = np.nan
    sens, windows = ["s_2", "s_3"], [1, 2, 6, 7, 13, 20]
    df = spark.createDataFrame(pdf).withColumn("s_3", fe.nan_to_null("s_3")).withColumn("note", F.lit("x")).repartition(5)
    for seg in (fe.DEFAULT_SEGMENT_ROWS, 11):
        got = fe.window_features(df, sens, windows, [2], segment_rows=seg, lag_fill=False).toPandas()
        got = got.sort_values(["unit_number", "time_cycles"]).reset_index(drop=True)
        want = _pandas_windows(pdf, sens, windows, [2])
        exact = pdf.assign(s_2=pdf["s_2"] - 1e9)
        near = _pandas_windows(exact, ["s_2"], windows, [])
        for c in want.columns:
            if "_lag_" in c:
                continue
            scale = near[c] if c in near and "std" in c else want[c]
            np.testing.assert_allclose(got[c].to_numpy(dtype=float), scale.to_numpy(dtype=float), rtol=1e-6 if "std" in c else 1e-9, atol=1e-6, err_msg=c)
        assert set(got["note"]) == {"x"} and len(got) == len(pdf)


def test_windows_carry_beyond_segments(spark):
    """A reading that is missing to the end of its segment takes the next known one, segments away."""
    rows = [(1, t, None if 5 <= t <= 40 else float(t)) for t in range(1, 61)]
    df = spark.createDataFrame(rows, "unit_number int, time_cycles int, s_2 double").repartition(4)
    whole, cut = ({r.time_cycles: r.s_2_lag_3 for r in fe.window_features(df, ["s_2"], [5], [3], segment_rows=s, lag_fill=False).collect()} for s in (1000, 7))
    assert whole == cut
    assert cut[10] == 41.0 and cut[60] == 57.0 and cut[1] == 1.0


def test_windows_of_an_empty_table(spark):
    df = spark.createDataFrame([], "unit_number int, time_cycles int, s_2 double")
    assert fe.window_features(df, ["s_2"], [5], [1]).count() == 0
