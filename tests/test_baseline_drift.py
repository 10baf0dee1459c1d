import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.config import SENSORS, SETTINGS
from cyclewise.operators import baseline as bl
from cyclewise.operators import drift as dr
from cyclewise.operators import features as fe
from cyclewise.operators import scoring as sc
from cyclewise.operators.ordering import count_upto
from cyclewise.plans import jobs
from cyclewise.session import scratch_path
from cyclewise.streaming import streams

from frames import plausible_frame


def brute_ks(a, b):
    grid = np.unique(np.r_[a, b])
    upto = lambda x: np.searchsorted(np.sort(x), grid, side="right") / len(x)
    return np.abs(upto(a) - upto(b)).max()


def test_binary_search(spark):
    rows = [(float(v), [float(b) for b in range(0, n, 2)]) for n in (0, 1, 2, 9, 40) for v in (-1, 0, 0.5, 7, 8, 8.5, 100)]
    got = spark.createDataFrame(rows, "v double, b array<double>").select("v", "b", count_upto(F.col("b"), F.col("v"), 20).alias("n")).collect()
    assert all(r.n == sum(x <= r.v for x in r.b) for r in got)


def test_lookup_and_ks_equal_counting(spark):
    rng = np.random.default_rng(4)
    base = {"a": rng.normal(size=3000).round(2), "b": np.repeat(5.0, 3000), "c": rng.integers(0, 4, 3000).astype(float)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*base.values())], "a double, b double, c double").repartition(6)
    index = bl.build(df, ["a", "b", "c"])
    points = [(f, float(v)) for f in "abc" for v in (-99, -0.5, 0, 0.005, 1, 2.5, 5, 5.01, 99)] + [("unknown", 1.0)]
    for r in index.lookup(spark.createDataFrame(points, "feature string, value double")).collect():
        x = base[r.feature]
        assert (r.upto, r.before, r.n_ref) == ((x <= r.value).sum(), (x < r.value).sum(), 3000), r
    samples = {k: {"a": rng.normal(k, 1, 40 + k).round(2), "b": np.repeat(5.0 if k else 4.0, 40 + k), "c": rng.integers(0, 5, 40 + k).astype(float)} for k in range(3)}
    rows = [(k, *map(float, r)) for k, s in samples.items() for r in zip(*s.values())]
    counts = bl.tall(spark.createDataFrame(rows, "k int, a double, b double, c double"), ["k"], ["a", "b", "c"]).groupBy("k", "feature", "value").agg(F.count("*").alias("c"))
    for r in bl.sample_ks(counts, index, ["k"]).collect():
        assert r.ks_d == pytest.approx(brute_ks(base[r.feature], samples[r.k][r.feature]), abs=1e-12)
        assert (r.n_ref, r.n_cur) == (3000, 40 + r.k)


def test_exact_ranks(spark):
    rng = np.random.default_rng(8)
    for x in (rng.normal(size=5001), np.repeat([3.0, 1.0, 2.0], [4000, 1, 999]), np.r_[np.full(3000, 1e300), rng.normal(size=2000) * 1e-300], np.array([5.0])):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(4)
        s = np.sort(x)
        ranks = sorted({1, len(x), (len(x) + 1) // 2, max(1, len(x) // 3), len(x) + 1})
        assert dr.exact_ranks(df, "v", ranks) == {k: float(s[k - 1]) if k <= len(x) else None for k in ranks}
        assert dr.exact_median(df, "v") == np.median(x)
    assert dr.exact_median(spark.createDataFrame([], "v double"), "v") is None


def requests(n_req=6, n=14):
    pdf = plausible_frame(n_engines=n_req, n_cycles=n).rename(columns={"unit_number": "request_id"})
    pdf.insert(1, "pos", pdf["time_cycles"])
    pdf = pdf[(pdf["request_id"] != 2) | (pdf["time_cycles"] <= 3)].copy()  # too short for a check
    pdf.loc[pdf["request_id"] == 3, SENSORS[1:9]] *= 2.0  # far from the baseline
    pdf["split"] = pdf["request_id"] % 2
    return pdf


def test_requests_are_checked_each_by_itself(spark):
    pdf, train = requests(), spark.createDataFrame(plausible_frame(3, 40))
    state = fe.fit_state(train)
    base = fe.minmax_transform(train.select(*state.sensor_cols), state.scaler)
    out = {r["request_id"]: r for r in sc.drift_verdicts(spark.createDataFrame(pdf.drop(columns="split")).repartition(5), base, state).collect()}
    assert set(out) == {1, 3, 4, 5, 6}
    assert out[3]["dataset_drift"] is (out[3]["share_drifted"] >= 0.5) and out[3]["n_drifted"] > out[1]["n_drifted"]
    alone = sc.drift_check(spark.createDataFrame(pdf[pdf["request_id"] == 4].drop(columns="split")), base, state).orderBy("feature").collect()
    among = sc.drift_check(spark.createDataFrame(pdf.drop(columns="split")), base, state).filter("request_id = 4").orderBy("feature").collect()
    assert alone == among
    with pytest.raises(ValueError, match="shared columns"):
        sc.drift_check(spark.createDataFrame(pdf), base.select("s_2", "s_3"), state)


def test_stream_drift_rows_per_batch_replay_and_restart(spark):
    pdf, train = requests(), spark.createDataFrame(plausible_frame(3, 40))
    state = fe.fit_state(train)
    base = fe.minmax_transform(train.select(*state.sensor_cols), state.scaler)
    src, sink, mark = (scratch_path(spark, f"test-drift-{x}") for x in ("src", "sink", "mark"))
    schema = "request_id long, pos long, time_cycles long, " + ", ".join(f"{c} double" for c in SETTINGS + SENSORS) + ", split long"
    waves = [pdf[pdf["request_id"].isin(ids)] for ids in ([1, 2], [3, 4], [5, 6])]
    put = lambda w: spark.createDataFrame(w).coalesce(1).write.mode("append").parquet(src)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    put(waves[0])
    put(waves[1])
    first = streams.stream_drift(spark, src, schema, base, state, sink, checkpoint=mark)
    assert {r["batch_id"] for r in first.select("batch_id").distinct().collect()} == {0, 1}
    before = rows(first)
    put(waves[2])
    whole = streams.stream_drift(spark, src, schema, base, state, sink, checkpoint=mark)  # goes on with batch 2
    after = rows(whole)
    assert after != before and {r[-1] for r in after} == {0, 1, 2}
    at_last = rows(whole.filter("batch_id = 2").select("split", "feature", "drift_score", "drifted"))
    again = streams.stream_drift(spark, src, schema, base, state, sink)  # played again from the start: the same rows
    assert rows(again) == after
    # the last batch's rows are those of all readings together
    good = fe.minmax_transform(spark.createDataFrame(pdf), state.scaler)
    cols = sc.shared_columns(good, base, state.feature_columns)
    counts = bl.tall(good, ["split"], cols).groupBy("split", "feature", "value").agg(F.count("*").alias("c"))
    want = bl.ks_table(counts, bl.build(base, cols), ["split"])
    names = ["split", "feature", "drift_score", "drifted"]
    assert rows(want.select(*names)) == at_last


@pytest.mark.parametrize("test", ["ks", "psi", "wasserstein"])
def test_monitor_job_with_each_test(spark, test):
    train = spark.createDataFrame(plausible_frame(4, 30))
    feats, state = fe.fit_transform(train, {"rolling_window_sizes": [5], "lag_steps": [1]})
    feats = fe.feature_matrix(feats, state)
    model = jobs.fit_model(feats, state.feature_columns, {"type": "ridge"})
    path = scratch_path(spark, "test-summary")
    row = jobs.monitor(feats, model, state.feature_columns, state.sensor_cols, {"drift_stattest": test}, path).first()
    summary = spark.read.json(path).first()
    assert {f["stattest"] for f in summary["data_drift"]["features"]} == {test}
    assert row["exit_code"] in (0, 1) and row["should_retrain"] == (row["exit_code"] == 1)


def test_pruned_ks_equals_whole_ks_and_shuffles_less(spark):
    rng = np.random.default_rng(12)
    a = {"x": rng.normal(size=6000), "y": rng.normal(size=6000), "z": rng.integers(0, 3, 6000).astype(float), "w": np.full(6000, 2.0), "t": rng.random(6000)}
    b = {"x": rng.normal(0.3, 1, 5000), "y": rng.normal(size=5000), "z": rng.integers(0, 3, 5000).astype(float), "w": np.full(5000, 2.0), "t": rng.random(5000) + 5}
    ref, cur = (spark.createDataFrame([tuple(map(float, r)) for r in zip(*s.values())], ", ".join(f"{c} double" for c in s)).repartition(4) for s in (a, b))
    st = dr.stack_sides(ref, cur, list(a))
    got = {r["feature"]: r for r in dr.ks_stats(st).collect()}
    for f in a:
        assert got[f]["ks_d"] == pytest.approx(brute_ks(a[f], b[f]), abs=1e-12) and (got[f]["n_ref"], got[f]["n_cur"]) == (6000, 5000)
    whole = {r["feature"]: r["ks_d"] for r in dr.feature_stats(dr.value_counts(st)).collect()}
    assert {f: r["ks_d"] for f, r in got.items()} == pytest.approx(whole)
    x, hist = dr.ks_ranges(st)
    shuffled = x.join(hist.filter("upper > lower"), ["feature", "range"], "left_semi").groupBy("feature").count().collect()
    rows = {r["feature"]: r["count"] for r in shuffled}
    assert rows["x"] < 2200 and rows.get("t", 0) < 100  # of 11,000
