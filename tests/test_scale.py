"""Plans that must not put a feature into one task, shuffle rows twice or hold a table per sample in the driver."""

import bisect

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import baseline as bl
from cyclewise.operators import drift as dr
from cyclewise.operators.ordering import dense_positions, with_count_upto


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def sides(spark):
    rng = np.random.default_rng(3)
    rows = lambda shift: [(float(a), float(b)) for a, b in zip(rng.normal(shift, 1, 300), rng.integers(0, 9, 300))]
    make = lambda shift: spark.createDataFrame(rows(shift), "a double, b double")
    return make(0.0), make(0.3)


def test_values_are_not_shuffled_by_feature(spark, no_auto_broadcast):
    ref, cur = sides(spark)
    stacked = dr.stack_sides(ref, cur, ["a", "b"])
    x, _ = dr.ks_ranges(stacked)
    for df in (x, dr.psi(ref, cur, ["a", "b"]), dr.side_histogram(stacked, 5)):
        plan = physical(df)
        assert "hashpartitioning(feature" not in plan.split("BroadcastHashJoin", 1)[1].split("BroadcastExchange")[0]
        assert "BroadcastHashJoin" in plan
    fast = {r["feature"]: (r["ks_d"], r["ks_p"]) for r in dr.ks_stats(stacked).collect()}
    whole = {r["feature"]: (r["ks_d"], r["ks_p"]) for r in dr.feature_stats(dr.value_counts(stacked)).collect()}
    assert all(fast[f] == pytest.approx(whole[f], abs=1e-12) for f in ("a", "b"))


def test_dense_positions_join_no_rows(spark, no_auto_broadcast):
    rows = [(k, t, i) for k in (1, 2, None) for i, t in enumerate([5, 1, 1, None, 17, 9])]
    df = spark.createDataFrame(rows, "k int, t int, i int")
    out = dense_positions(df, ["k"], ["t", "i"], F.floor(F.col("t") / 4), out="pos", total="n")
    assert "Join" not in physical(out)
    assert out.columns == ["k", "t", "i", "pos", "n"]
    got = {(r["k"], r["i"]): (r["pos"], r["n"]) for r in out.collect()}
    order = [3, 1, 2, 0, 5, 4]
    assert got == {(k, i): (p, 6) for k in (1, 2, None) for p, i in enumerate(order, 1)}


def test_count_upto_by_columns(spark):
    bounds = [1.0, 2.0, 2.0, 7.5]
    df = spark.createDataFrame([(v, bounds) for v in (0.0, 1.0, 2.0, 7.0, 8.0)], "v double, b array<double>")
    got = {r["v"]: r["n"] for r in with_count_upto(df, "n", "b", "v", 4).collect()}
    assert got == {v: bisect.bisect_right(bounds, v) for v in got}


@pytest.mark.parametrize("whole_values", [1, 1 << 16])
def test_sample_ks_of_small_and_split_samples(spark, monkeypatch, whole_values):
    monkeypatch.setattr(bl, "WHOLE_VALUES", whole_values)
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, 500)
    index = bl.build(spark.createDataFrame([(float(v),) for v in base], "a double"), ["a"])
    samples = {k: rng.normal(0.1 * k, 1, 40).round(1) for k in range(3)}
    counts = spark.createDataFrame([(k, "a", float(v)) for k, x in samples.items() for v in x], "k int, feature string, value double")
    counts = counts.groupBy("k", "feature", "value").agg(F.count(F.lit(1)).alias("c"))
    got = {r["k"]: r for r in bl.sample_ks(counts, index, ["k"]).collect()}
    for k, x in samples.items():
        at = np.concatenate([base, x])
        cdf = lambda v: np.searchsorted(np.sort(v), at, side="right") / len(v)
        d = np.abs(cdf(base) - cdf(x)).max()
        assert got[k]["ks_d"] == pytest.approx(d, abs=1e-12) and (got[k]["n_ref"], got[k]["n_cur"]) == (500, 40)
        assert got[k]["ks_p"] == pytest.approx(dr.exact_ks_p(d, 500, 40), abs=1e-12)


def test_ks_p_of_an_empty_side_and_of_large_samples(spark):
    df = spark.createDataFrame([(0.01, 20000.0, 30000.0), (0.0, 20000.0, 30000.0), (0.5, 0.0, 3.0), (None, 5.0, 3.0)], "d double, n double, m double")
    got = [r["p"] for r in df.select(dr.ks_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    en = (20000 * 30000 / 50000) ** 0.5
    lam = (en + 0.12 + 0.11 / en) * 0.01
    want = 2 * sum((-1) ** (j - 1) * np.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    assert got[0] == pytest.approx(want, abs=1e-12) and got[1:] == [1.0, None, None]


def test_half_up_and_fixed_point_as_decimals_round(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from cyclewise.functions import lineage as lg

    values = [0.0, -0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370495.5, 2.0**62, -(2.0**63), 1e300, float("nan"), float("inf"), 0.00005, 12.34565]
    got, none = lg.half_up(np.array(values))
    for v, g, n in zip(values, got, none):
        want = int(Decimal(v).quantize(Decimal(1), ROUND_HALF_UP)) if abs(v) <= 2.0**63 else None
        assert (None if n else g) == want, v
    df = spark.createDataFrame([(1, v, "a|b") for v in values] + [(None, None, None)], "k int, x double, t string")
    by_columns = [r[0] for r in df.select(F.round(F.col("x") * F.lit(10000.0)).try_cast("long")).collect()]
    assert [r["x"] for r in lg.fixed_point(df).collect()] == by_columns
    fused = lg.table_fingerprint(df, digits=4).first()
    assert fused == lg.table_fingerprint(lg.fixed_point(df)).first()


def test_wide_fingerprint_and_gate_leave_the_row_columns_to_batches(spark):
    """One projection of 26 texts or 70 rules is a method that the JVM does not compile."""
    import hashlib

    from frames import plausible_frame

    from cyclewise.functions import lineage as lg
    from cyclewise.operators import validate as va

    pdf = plausible_frame()
    pdf.loc[3, "s_2"], pdf.loc[4, "s_3"] = np.nan, 1e6
    df = spark.createDataFrame(pdf).repartition(3)
    for plan in (lg.table_fingerprint(df, digits=4), va.violations(df, va.RAW_RULES), va.gate_report("d", "s", df)):
        assert "MapInArrow" in physical(plan) and "md5" not in physical(plan)
    found = {(r["check"], r["column"], r["unit_number"], r["time_cycles"], r["failure_value"]) for r in va.raw_violations(df).collect()}
    assert found == {("not_nullable", "s_2", 1, 4, None), ("s_3 above physical maximum", "s_3", 1, 5, 1e6)}
    assert va.gate_report("d", "s", df).first()["error_count"] == 2
    empty = va.gate_report("d", "s", df.limit(0)).first()
    assert (empty["n_rows"], empty["error_count"]) == (0, 0)

    rows = [(1, -7, "é|x", 2.5, True), (None, 2**62, None, float("nan"), None)]
    small = spark.createDataFrame(rows, "i int, l long, t string, d double, b boolean")
    hexes = [r["h"] for r in small.select(F.hex(F.xxhash64("d")).alias("h")).collect()]
    texts = [f"1:1|2:-7|3:é|x|{len(hexes[0])}:{hexes[0]}|4:true", f"~|19:{2**62}|~|{len(hexes[1])}:{hexes[1]}|~"]
    want = sum(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in texts)
    assert lg.table_fingerprint(small).first()[:2] == (2, want)
    assert lg.table_fingerprint(small.limit(0)).first()[:2] == (0, 0)


def test_versions_are_written_by_the_scan_s_tasks(spark, tmp_path, monkeypatch):
    """No fixed number of tasks writes a table of any size."""
    from cyclewise.plans import q_lineage as ql

    rows = [(i, i % 7, i % 16, i % 3, "A", "O") for i in range(400)]
    spark.createDataFrame(rows, ", ".join(f"{c} {'string' if 'status' in c or 'flag' in c else 'long'}" for c in ql.EXACT_COLUMNS)) \
        .repartition(9).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(ql, "scratch_path", lambda s, name: f"{tmp_path}/{name}")
    path = ql._version(spark, str(tmp_path), False)
    assert spark.read.parquet(path).count() == 400
    written = {f.split("part-")[1][:5] for f in spark.read.parquet(path).inputFiles()}
    tasks = spark.read.parquet(f"{tmp_path}/lineitem.parquet").rdd.getNumPartitions()
    assert len(written) == tasks
