import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.functions import lineage as lg
from cyclewise.operators import drift as dr
from cyclewise.operators import retrain as rt


def _frame(spark, cols: dict):
    names = list(cols)
    rows = list(zip(*[map(float, cols[n]) for n in names]))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def _ecdf_d(a, b):
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return float(np.max(np.abs(fa - fb))), float(np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)))


def test_ks_and_wasserstein_match_brute_force(spark):
    rng = np.random.default_rng(42)
    a, b = rng.normal(0, 1, 300).round(2), rng.normal(0.3, 1, 250).round(2)
    st = dr.feature_stats(dr.value_counts(dr.stack_sides(_frame(spark, {"x": a}), _frame(spark, {"x": b}), ["x"]))).first()
    d, w = _ecdf_d(a, b)
    assert st["ks_d"] == pytest.approx(d)
    assert st["wasserstein_norm"] == pytest.approx(w / np.std(a))
    assert 0.0 <= st["ks_p"] <= 1.0


def test_prediction_drift_detects_shift(spark):
    rng = np.random.default_rng(42)
    base = rng.normal(50, 10, 200)
    same = dr.prediction_drift(_frame(spark, {"predicted": base}), _frame(spark, {"predicted": base})).first()
    moved = dr.prediction_drift(_frame(spark, {"predicted": base}), _frame(spark, {"predicted": rng.normal(100, 10, 200)})).first()
    assert not same["drift_detected"] and same["drift_score"] == 0.0
    assert moved["drift_detected"] and moved["current_mean"] > 90


def test_dataset_drift_and_gate(spark):
    rng = np.random.default_rng(3)
    ref = _frame(spark, {f"f{i}": rng.normal(size=200) for i in range(4)})
    cur = _frame(spark, {f"f{i}": rng.normal(loc=3.0 if i < 3 else 0.0, size=200) for i in range(4)})
    table = dr.data_drift(ref, cur, [f"f{i}" for i in range(4)], "ks")
    s = dr.dataset_drift(table).first()
    assert s["n_drifted"] == 3 and s["dataset_drift"]
    assert not dr.drift_gate(table).first()["test_suite_passed"]


def test_perturb_changes_keeps_shape_no_nan_and_is_partition_free(spark):
    rng = np.random.default_rng(5)
    pdf = {"unit_number": np.repeat([1, 2], 50), "time_cycles": np.tile(np.arange(1, 51), 2),
           "a": rng.normal(size=100), "b": rng.normal(size=100), "c": np.full(100, 7.0)}
    df = _frame(spark, pdf)
    one = dr.perturb(df.coalesce(1), ["a", "b", "c"], ["unit_number", "time_cycles"]).orderBy("unit_number", "time_cycles").toPandas()
    many = dr.perturb(df.repartition(8), ["a", "b", "c"], ["unit_number", "time_cycles"]).orderBy("unit_number", "time_cycles").toPandas()
    assert one.shape == (100, 5) and not one.isna().any().any()
    assert not np.allclose(one["a"], pdf["a"])  # noise on the first half
    assert np.allclose(one["c"], 7.0)  # range 0: unchanged
    np.testing.assert_allclose(one.to_numpy(), many.to_numpy())


def test_exact_median_narrowing(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=2001)
    df = _frame(spark, {"v": x})
    assert dr.exact_rank_value(df, "v", 1001, buckets=8) == pytest.approx(np.median(x))
    assert dr.exact_median(_frame(spark, {"v": x[:2000]}), "v") == pytest.approx(np.median(x[:2000]))


def test_psi_zero_for_equal_samples(spark):
    x = np.arange(100.0)
    r = dr.psi(_frame(spark, {"x": x}), _frame(spark, {"x": x}), ["x"]).first()
    assert r["drift_score"] == pytest.approx(0.0) and not r["drifted"]


def test_retrain_decision(spark):
    data = spark.createDataFrame([(0.5,)], "share_drifted double")
    feats = spark.createDataFrame([("s_3", 0.001, True), ("s_2", 0.2, False)], "feature string, drift_score double, drifted boolean")
    pred = spark.createDataFrame([(False, 0.05)], "drift_detected boolean, drift_score double")
    gate = spark.createDataFrame([(True,)], "test_suite_passed boolean")
    row = rt.retrain_decision(data, feats, pred, None, gate).first()
    assert row["should_retrain"] and row["exit_code"] == 1
    assert row["reasons"][0] == "DATA DRIFT: 50.0% of features drifted (threshold: 30.0%)"
    assert row["reasons"][1] == "  Top drifted features: ['s_3']"
    quiet = rt.retrain_decision(spark.createDataFrame([(0.1,)], "share_drifted double"), None, pred, None, gate).first()
    assert not quiet["should_retrain"] and quiet["reasons"][0].startswith("Data drift OK: 10.0%")


def test_fingerprint_order_free_and_sensitive(spark):
    df = spark.createDataFrame([(i, float(i) / 3) for i in range(100)], "k int, v double")
    a = lg.table_fingerprint(df.repartition(1)).first()
    b = lg.table_fingerprint(df.orderBy(F.desc("k")).repartition(7)).first()
    c = lg.table_fingerprint(df.filter("k > 0")).first()
    assert a["fingerprint"] == b["fingerprint"] and len(a["fingerprint"]) == 12
    assert c["fingerprint"] != a["fingerprint"]


def test_flatten_struct(spark):
    df = spark.sql("SELECT named_struct('xgboost', named_struct('max_depth', 6), 'tags', array(1, 2)) AS model, 3 AS n")
    out = lg.flatten_struct(df)
    assert out.columns == ["model.xgboost.max_depth", "model.tags", "n"]
    assert out.first()["model.tags"] == "[1, 2]"


def test_stats_against_plain_cdfs(spark):
    rng = np.random.default_rng(11)
    x, y = rng.normal(size=400).round(3), rng.normal(0.2, 1, 300).round(3)
    stats = dr.feature_stats(dr.value_counts(dr.stack_sides(_frame(spark, {"x": x}), _frame(spark, {"x": y}), ["x"]))).first()
    v = np.unique(np.concatenate([x, y]))
    gap = np.abs(np.searchsorted(np.sort(x), v, "right") / 400 - np.searchsorted(np.sort(y), v, "right") / 300)
    assert stats.ks_d == pytest.approx(gap.max(), rel=1e-12)
    assert stats.wasserstein_norm == pytest.approx((gap[:-1] * np.diff(v)).sum() / x.std(), rel=1e-9)


def test_rank_of_repeated_values(spark):
    """Any repetition and any number of ranges give the same value."""
    x = np.concatenate([np.zeros(3), np.full(4998, 5.0)])
    df = _frame(spark, {"v": x})
    for buckets in (2, 8, 1024):
        assert [dr.exact_rank_value(df, "v", k, buckets=buckets) for k in (1, 3, 4, 2500, 5001)] == [0.0, 0.0, 5.0, 5.0, 5.0]
        assert dr.exact_rank_value(df, "v", 5002, buckets=buckets) is None
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 3000):
        y = rng.integers(0, max(2, n // 3), n).astype(float)
        assert dr.exact_median(_frame(spark, {"v": y}), "v") == np.median(y)
        assert dr.exact_rank_value(_frame(spark, {"v": y}), "v", (n + 1) // 2, buckets=3) == np.sort(y)[(n + 1) // 2 - 1]


def test_psi_is_selectable(spark):
    rng = np.random.default_rng(3)
    ref, cur = _frame(spark, {"x": rng.normal(size=500)}), _frame(spark, {"x": rng.normal(1, 1, 500)})
    row = dr.data_drift(ref, cur, ["x"], "psi").first()
    assert row.stattest == "psi" and row.drifted


def test_decision_without_summary_and_with_absent_layers(spark):
    row = rt.retrain_decision(None, None, None, None, None).first()
    assert (row.should_retrain, list(row.reasons), row.exit_code) == (False, [rt.NO_SUMMARY], 0)
    gate = spark.createDataFrame([(True,)], "test_suite_passed boolean")
    row = rt.retrain_decision(None, None, None, None, gate).first()
    assert not row.should_retrain and row.reasons[0].startswith("Data drift OK: 0.0%") and row.reasons[1] == "Prediction drift OK: not detected"
    data = spark.createDataFrame([(0.9,)], "share_drifted double")
    for test, first in (("ks", "b"), ("wasserstein", "a")):
        top = spark.createDataFrame([("a", test, 0.9, True), ("b", test, 0.2, True)], "feature string, stattest string, drift_score double, drifted boolean")
        assert rt.retrain_decision(data, top, None, None, None).first().reasons[1].startswith(f"  Top drifted features: ['{first}'")


def test_fingerprint_of_exact_bits(spark):
    fp = lambda rows, t: lg.table_fingerprint(spark.createDataFrame(rows, t)).first().fingerprint
    d = "x double"
    seen = [fp([(v,)], d) for v in (0.12341, 0.12344, float("nan"), float("inf"), float("-inf"), 1e300, None, 0.0)]
    assert len(set(seen)) == len(seen)
    t = "a string, b string"
    seen = [fp([r], t) for r in (("a|", "b"), ("a", "|b"), (None, ""), ("", None), ("", ""))]
    assert len(set(seen)) == len(seen)


def test_positions_with_null_keys_and_groups(spark):
    from pyspark.sql import functions as F

    from cyclewise.operators.ordering import dense_positions

    rows = [(u, t) for u in (None, 1, 2, 5000) for t in range(5)] + [(1, None)]
    df = spark.createDataFrame(rows, "u int, t int").repartition(4)
    own = dense_positions(df, ["u"], ["t"], F.floor(F.col("t") / 2), total="n").collect()
    assert len(own) == 21 and sorted((r.pos, r.n) for r in own if r.u == 1) == [(i, 6) for i in range(1, 7)]
    assert [r.t for r in sorted((r for r in own if r.u is None), key=lambda r: r.pos)] == [0, 1, 2, 3, 4]
    whole = dense_positions(df.filter("u is not null and t is not null"), [], ["u", "t"], F.struct("u", "t"), total="n", coarse=F.floor(F.col("u") / 1024)).collect()
    assert [(r.u, r.t) for r in sorted(whole, key=lambda r: r.pos)] == [(u, t) for u in (1, 2, 5000) for t in range(5)]
    assert {r.n for r in whole} == {15}


def test_decision_from_written_summary(spark):
    from cyclewise.plans import jobs
    from cyclewise.session import scratch_path

    assert list(jobs.decide_from_summary(spark, scratch_path(spark, "no-summary")).first().reasons) == [rt.NO_SUMMARY]
    table = spark.createDataFrame([("a", "ks", 0.01, 0.05, True), ("b", "ks", 0.5, 0.05, False)],
                                  "feature string, stattest string, drift_score double, threshold double, drifted boolean")
    pred = spark.createDataFrame([(True, 0.25, 0.1, 1.0, 1.0, 2.0, 1.0)], "drift_detected boolean, drift_score double, threshold double, "
                                 "reference_mean double, reference_std double, current_mean double, current_std double")
    impact = dr.drift_impact(_frame(spark, {"ref_pred": np.array([1.0, 2.0]), "drift_pred": np.array([2.0, 30.0])}))
    path = scratch_path(spark, "summary")
    args = (dr.dataset_drift(table), table, pred, impact, dr.drift_gate(table))
    jobs.write_drift_summary(path, *args)
    assert jobs.decide_from_summary(spark, path).first() == rt.retrain_decision(*args).first()
