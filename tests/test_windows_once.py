"""The window features: rows shuffled once, features not written, only the asked-for ones computed, last rows alone."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import boosting
from cyclewise.operators import features as fe
from cyclewise.operators import model as md
from cyclewise.plans import q_metrics as qm


@pytest.fixture(scope="module")
def odd(spark):
    """Engines of 1, 2, 7, 40 rows with gaps, missing readings at both ends, and one without an id."""
    rng = np.random.default_rng(11)
    rows = [(u, 3 * t + 5, 0.0, float(rng.normal()) if rng.random() > 0.3 else None, float(rng.normal()))
            for u, n in ((1, 1), (2, 2), (3, 7), (4, 40), (None, 9)) for t in range(n)]
    return spark.createDataFrame(rows, "unit_number int, time_cycles int, setting_1 double, s_2 double, s_3 double").repartition(3)


CFG = {"rolling_window_sizes": [5], "lag_steps": [1, 3]}


def rows_of(df):
    pdf = df.toPandas().sort_values(["unit_number", "time_cycles"], na_position="first").reset_index(drop=True)
    return pdf[sorted(pdf.columns)]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_short_units_are_shuffled_once_and_match_segments(spark, odd):
    args = (odd, ["s_2", "s_3"], [5, 12], [1, 3])
    whole, cut = fe.window_features(*args, lag_fill=False), fe.window_features(*args, lag_fill=False, segment_rows=13)
    assert exchanges(whole) == 1 and exchanges(cut) > 1
    pd.testing.assert_frame_equal(rows_of(whole), rows_of(cut), check_dtype=False)
    filled = fe.window_features(*args)
    lags = [c for c in whole.columns if "_lag_" in c]
    means = whole.agg(*[F.avg(c).alias(c) for c in lags]).first().asDict()
    for seg in (1 << 16, 13):
        assert fe.window_lag_means(odd, ["s_2", "s_3"], [1, 3], segment_rows=seg) == pytest.approx(means, abs=1e-12)
    pd.testing.assert_frame_equal(rows_of(filled), rows_of(whole.fillna(means)), check_dtype=False)


def test_fit_transform_writes_nothing_and_prunes(spark, odd, monkeypatch):
    def written(*_):
        raise AssertionError("the features are not written")

    monkeypatch.setattr("cyclewise.session.scratch_path", written)
    out, state = fe.fit_transform(odd, CFG)
    few, same = fe.fit_transform(odd, CFG, columns=["s_2_lag_3", "s_3_roll_max_5"])
    assert few.columns == [*odd.columns, "rul", "s_3_roll_max_5", "s_2_lag_3"]
    assert same.lag_means == pytest.approx(state.lag_means) and same.feature_columns == state.feature_columns
    assert state.feature_columns == fe.feature_names(["s_2", "s_3"], [5], [1, 3])
    pd.testing.assert_frame_equal(rows_of(few), rows_of(out)[sorted(few.columns)])


def test_last_rows_match_all_rows(spark, odd):
    _, state = fe.fit_transform(odd, CFG)
    every = fe.fill_lags(fe.transform(odd, state, lag_fill=False), state.lag_means)
    want = rows_of(md.last_rows(every))
    for last in (fe.last_row_features(odd, state), fe.last_row_features(odd, state, segment_rows=8)):
        pd.testing.assert_frame_equal(rows_of(last)[list(want.columns)], want)
    assert exchanges(fe.last_row_features(odd, state)) == 1


def test_sample_by_keys_of_the_rows_and_kept_columns(spark, odd):
    out, _ = fe.fit_transform(odd, CFG)
    labels = fe.rul_label(odd)
    sets = [{r["_key"] for r in s.select("_key").collect()} for s in (
        boosting.labelled_sample(out, ["unit_number", "time_cycles"], 20), boosting.labelled_sample(out, ["unit_number", "time_cycles"], 20, labels))]
    assert sets[0] == sets[1] and len(sets[0]) == 20
    model = md.gbt_fit(out, ["s_3"], params={"n_estimators": 3, "max_depth": 2})
    whole, kept = md.predict(model, out, ["s_3"]), md.predict(model, out, ["s_3"], keep=["rul"])
    assert kept.columns == ["rul", "predicted"]
    assert sorted(map(tuple, whole.select("rul", "predicted").collect())) == sorted(map(tuple, kept.collect()))
    bare = boosting.BoostedTrees(["s_3"], [np.empty(0)], 2.5)
    assert [r["predicted"] for r in md.predict(bare, out, ["s_3"], keep=[]).collect()] == [2.5] * out.count()


def test_one_feature_queries_compute_one_feature(spark, monkeypatch):
    asked = []
    real = fe.fit_transform
    monkeypatch.setattr(fe, "fit_transform", lambda *a, **k: asked.append(k.get("columns")) or real(*a, **k))
    for q in (qm.q_ridge, qm.q_linear_importance):
        q(spark, "/root/testdata/sf0.001").collect()
    assert asked == [[qm.RIDGE_FEATURE], qm.TWO_FEATURES]
