"""Two-sample drift tests per feature, dataset-level drift, the CI gate, and the
keyed what-if perturbation with its impact on predictions.

Common plan
-----------
Reference and current are stacked into ``(feature, value, side)`` and reduced
to counts per ``(feature, value)`` (partial + final aggregation, so repeated
values never travel twice).  Empirical CDFs are running sums over value order
inside each feature; :func:`cyclewise.operators.ordering.running_totals`
splits every feature into value ranges so one huge feature is many tasks.
All statistics of all features come out of that one counts table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cyclewise.config import MONITORING_DEFAULTS, PERTURB_DEFAULTS
from cyclewise.operators.ordering import running_totals, with_count_upto
from cyclewise.session import cut_lineage

REF, CUR = "reference", "current"


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def stack_sides(ref: DataFrame, cur: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, value, side)`` for every finite value of every feature on both sides."""

    def tall(df: DataFrame, side: str) -> DataFrame:
        items = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value")) for f in features])
        return df.select(F.explode(items).alias("_x"), F.lit(side).alias("side")).select("_x.feature", "_x.value", "side")

    out = tall(ref, REF).unionByName(tall(cur, CUR))
    return out.filter(finite(F.col("value")))


def value_counts(stacked: DataFrame, part: list[str] | None = None) -> DataFrame:
    keys = (part or []) + ["feature"]
    return stacked.groupBy(*keys, "value").agg(
        F.sum((F.col("side") == REF).cast("long")).alias("r"),
        F.sum((F.col("side") == CUR).cast("long")).alias("c"),
    )


#: Samples of at most so many values have an exact KS p-value.
EXACT_KS_ROWS = 10_000


def exact_ks_p(d: float, n: int, m: int) -> float:
    """P(D >= d) for two samples of a common continuous distribution, exactly.

    The pooled values in order are a draw without replacement: a walk from (0, 0) to (n, m).  The probability of all
    walks that are still closer than ``d`` is carried from diagonal to diagonal, what gets ``d`` apart is added up, so
    that small p-values keep their digits.
    """
    i = np.arange(n + 1)
    p, gone = np.zeros(n + 1), 0.0
    p[0] = 1.0
    for s in range(n + m):
        j = s - i
        right = np.where((j >= 0) & (j <= m), p * (n - i) / (n + m - s), 0.0)
        stay = np.where((j >= 0) & (j <= m), p * (m - j) / (n + m - s), 0.0)
        p = stay
        p[1:] += right[:-1]
        j = s + 1 - i
        apart = np.abs(i / n - j / m) >= d - 1e-9
        gone += p[apart].sum()
        p[apart] = 0.0
    return float(min(max(gone, 0.0), 1.0))


def asymptotic_ks_p(d: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Asymptotic two-sample KS p-value with Stephens' small-sample correction; 1 when λ < 0.2, NaN for an empty side."""
    with np.errstate(divide="ignore", invalid="ignore"):
        en = np.sqrt(n * m / (n + m))
        lam = np.where(en > 0, (en + 0.12 + 0.11 / en) * d, np.nan)
    out = np.where(np.isnan(lam), np.nan, 1.0)
    rest = np.flatnonzero(lam >= 0.2)
    total = np.zeros(len(rest))
    for j in range(1, 101):
        total += (-1.0) ** (j - 1) * np.exp(-2.0 * j * j * lam[rest] * lam[rest])
    out[rest] = np.clip(2.0 * total, 0.0, 1.0)
    return out


@F.pandas_udf(DoubleType())
def _ks_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    d, n, m = (x.to_numpy(float, na_value=np.nan) for x in (d, n, m))
    out = asymptotic_ks_p(d, n, m)
    # the walk's table lives in numpy, a test at a time
    for i in np.flatnonzero((np.fmax(n, m) <= EXACT_KS_ROWS) & (np.fmin(n, m) >= 1) & ~np.isnan(d + n + m)):
        out[i] = exact_ks_p(d[i], int(n[i]), int(m[i]))
    return pd.Series(out)


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Two-sample KS p-value: exact for samples of at most ``EXACT_KS_ROWS`` values, else asymptotic."""
    return _ks_p(d, n, m)


def feature_stats(counts: DataFrame, part: list[str] | None = None) -> DataFrame:
    """Per feature: sizes, distinct reference values, KS D and p, Wasserstein-1, reference std, JS distance.

    ``counts`` is the output of :func:`value_counts`.
    """
    keys = (part or []) + ["feature"]
    pk = "pkey"
    # three passes read the counts: the values are aggregated once
    c = cut_lineage(counts, "value-counts").withColumn(pk, F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]) if part else F.col("feature"))
    tot = c.groupBy(pk).agg(
        F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"),
        F.sum((F.col("r") > 0).cast("long")).alias("n_unique_ref"),
        F.sum(F.col("r") * F.col("value")).alias("_sr"), F.sum(F.col("r") * F.col("value") * F.col("value")).alias("_sr2"),
    )
    few = F.broadcast if not part else lambda x: x  # a row per feature; a shuffle by feature has a task per feature
    run = running_totals(c, pk, "value", ["r", "c"], with_next=True, few_parts=not part).join(few(tot), pk)
    fr = F.try_divide(F.col("cum_r"), F.col("n_ref"))
    fc = F.try_divide(F.col("cum_c"), F.col("n_cur"))
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    p = F.try_divide(F.col("r"), F.col("n_ref"))
    q = F.try_divide(F.col("c"), F.col("n_cur"))
    mid = (p + q) / 2
    js_term = F.when(p > 0, p * F.log(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log(q / mid)).otherwise(0.0)
    per = run.groupBy(pk).agg(
        *[F.first(k).alias(k) for k in keys],
        F.max(F.abs(fr - fc)).alias("ks_d"),
        F.sum(F.abs(fr - fc) * step).alias("wasserstein"),
        F.sum(js_term).alias("_js2"),
    )
    out = per.join(tot, pk)
    mean = F.try_divide(F.col("_sr"), F.col("n_ref"))
    std_pop = F.sqrt(F.greatest(F.try_divide(F.col("_sr2"), F.col("n_ref")) - mean * mean, F.lit(0.0)))
    return out.select(
        *keys,
        F.col("n_ref").cast("long").alias("n_ref"),
        F.col("n_cur").cast("long").alias("n_cur"),
        F.col("n_unique_ref").cast("long").alias("n_unique_ref"),
        "ks_d",
        ks_pvalue(F.col("ks_d"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double")).alias("ks_p"),
        (F.col("wasserstein") / F.greatest(std_pop, F.lit(0.001))).alias("wasserstein_norm"),
        F.sqrt(F.greatest(F.col("_js2") / 2, F.lit(0.0))).alias("jensenshannon"),
    )


#: Value ranges per feature of the pruned KS test.
KS_RANGES = 256


def ks_ranges(stacked: DataFrame, ranges: int = KS_RANGES) -> tuple[DataFrame, DataFrame]:
    """``stacked`` with the ``range`` of each value, and per feature and range what bounds the KS distance in it.

    Ranges start at approximate quantiles of both sides together.  ``rs, cs`` are the counts below a range, ``re, ce`` those
    up to its end.  Both CDFs only rise, so inside a range they are at most ``upper`` apart; ``lower`` is the largest
    distance at the end of any range of the feature.
    """
    probs = [i / ranges for i in range(1, ranges)]
    bounds = stacked.groupBy("feature").agg(F.percentile_approx("value", probs, 10 * ranges).alias("_bounds"))
    # a row per feature is sent to the values: a join by feature would deal them to one task per feature
    x = with_count_upto(stacked.join(F.broadcast(bounds), "feature"), "range", "_bounds", "value", ranges).drop("_bounds")
    hist = x.groupBy("feature", "range").agg(
        F.sum((F.col("side") == REF).cast("long")).alias("r"), F.sum((F.col("side") == CUR).cast("long")).alias("c"))
    hist = cut_lineage(hist, "ks-ranges")  # features x ranges rows
    upto, whole = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("feature")
    hist = hist.select("feature", "range", "r", "c", F.sum("r").over(upto).alias("re"), F.sum("c").over(upto).alias("ce"),
                       F.sum("r").over(whole).alias("n_ref"), F.sum("c").over(whole).alias("n_cur"))
    share = lambda k, n: F.try_divide(k, F.col(n))
    rs, cs = F.col("re") - F.col("r"), F.col("ce") - F.col("c")
    hist = hist.withColumn("rs", rs).withColumn("cs", cs)
    upper = F.greatest(share(F.col("re"), "n_ref") - share(cs, "n_cur"), share(F.col("ce"), "n_cur") - share(rs, "n_ref"))
    lower = F.max(F.abs(share(F.col("re"), "n_ref") - share(F.col("ce"), "n_cur"))).over(whole)
    return x, hist.withColumn("upper", upper).withColumn("lower", lower)


def ks_stats(stacked: DataFrame, ranges: int = KS_RANGES) -> DataFrame:
    """``(feature, n_ref, n_cur, ks_d, ks_p)``: as :func:`feature_stats`, but only values of the ranges that can hold the
    largest distance are shuffled."""
    x, hist = ks_ranges(stacked, ranges)
    open_ranges = hist.filter(F.col("upper") > F.col("lower")).select("feature", "range", "rs", "cs", "n_ref", "n_cur")
    inside = x.join(F.broadcast(open_ranges), ["feature", "range"]).groupBy("feature", "range", "value").agg(
        F.sum((F.col("side") == REF).cast("long")).alias("r"), F.sum((F.col("side") == CUR).cast("long")).alias("c"),
        *[F.first(k).alias(k) for k in ("rs", "cs", "n_ref", "n_cur")])
    run = Window.partitionBy("feature", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    fr = F.try_divide(F.col("rs") + F.sum("r").over(run), F.col("n_ref"))
    fc = F.try_divide(F.col("cs") + F.sum("c").over(run), F.col("n_cur"))
    found = inside.select("feature", F.abs(fr - fc).alias("_d")).groupBy("feature").agg(F.max("_d").alias("_d"))
    per = hist.groupBy("feature").agg(F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.max("lower").alias("_low"))
    out = per.join(found, "feature", "left").withColumn("ks_d", F.greatest("_low", "_d"))
    p = ks_pvalue(F.col("ks_d"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return out.select("feature", "n_ref", "n_cur", "ks_d", p.alias("ks_p"))


def drift_table(stats: DataFrame, stattest: str = "ks", cfg: dict | None = None, part: list[str] | None = None) -> DataFrame:
    """``(feature, stattest, drift_score, threshold, drifted)`` for a fixed test or ``auto``.

    ``ks``: score = p-value, drifted when p <= 0.05.  ``wasserstein``: normed
    distance >= 0.1.  ``auto``: at most 1000 reference rows -> KS; otherwise at
    most 5 distinct values -> Jensen-Shannon (>= 0.1), else Wasserstein.
    """
    m = dict(MONITORING_DEFAULTS)
    m.update(cfg or {})
    row = lambda name, column, limit, hit: (F.lit(name), F.col(column), F.lit(m[limit]), hit(F.col(column), F.lit(m[limit])))
    tests = {
        "ks": lambda: row("ks", "ks_p", "ks_p_threshold", lambda x, t: x <= t),
        "wasserstein": lambda: row("wasserstein", "wasserstein_norm", "wasserstein_threshold", lambda x, t: x >= t),
        "jensenshannon": lambda: row("jensenshannon", "jensenshannon", "jensenshannon_threshold", lambda x, t: x >= t),
    }
    if stattest == "auto":
        small = F.col("n_ref") <= F.lit(m["auto_small_sample"])
        low = F.col("n_unique_ref") <= F.lit(m["auto_low_cardinality"])
        three = zip(tests["ks"](), tests["jensenshannon"](), tests["wasserstein"](), strict=True)
        pick = tuple(F.when(small, a).when(low, b).otherwise(c) for a, b, c in three)
    elif stattest in tests:
        pick = tests[stattest]()
    else:
        raise ValueError(f"unknown stattest {stattest!r}")
    names = ("stattest", "drift_score", "threshold", "drifted")
    return stats.select(*(part or []), "feature", *[e.alias(n) for e, n in zip(pick, names)])


def data_drift(ref: DataFrame, cur: DataFrame, features: list[str], stattest: str = "ks", cfg: dict | None = None) -> DataFrame:
    """Layer 1: per-feature drift between two tables; ``psi`` bins the values, the other tests compare distributions."""
    if stattest == "psi":
        return psi(ref, cur, features, {**MONITORING_DEFAULTS, **(cfg or {})}["psi_threshold"])
    if stattest == "ks":
        return drift_table(ks_stats(stack_sides(ref, cur, features)), stattest, cfg)
    return drift_table(feature_stats(value_counts(stack_sides(ref, cur, features))), stattest, cfg)


def psi(ref: DataFrame, cur: DataFrame, features: list[str], threshold: float = MONITORING_DEFAULTS["psi_threshold"]) -> DataFrame:
    """Population stability index on shared equal-width bins (Sturges count over both sides).

    Empty shares become 0.0001; ``psi = sum((c - r) * ln(c / r))``.
    """
    st = stack_sides(ref, cur, features)
    rng = st.groupBy("feature").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"),
        F.sum((F.col("side") == REF).cast("long")).alias("n_ref"),
        F.sum((F.col("side") == CUR).cast("long")).alias("n_cur"),
    ).withColumn("n_bins", F.ceil(F.log2(F.col("n_ref") + F.col("n_cur")) + F.lit(1.0)).cast("int"))
    w = F.col("_hi") - F.col("_lo")
    b = F.when(w > 0, F.least(F.floor((F.col("value") - F.col("_lo")) / w * F.col("n_bins")), F.col("n_bins") - 1)).otherwise(0)
    binned = st.join(F.broadcast(rng), "feature").groupBy("feature", b.cast("int").alias("bin")).agg(
        F.sum((F.col("side") == REF).cast("long")).alias("r"), F.sum((F.col("side") == CUR).cast("long")).alias("c")
    ).join(rng.select("feature", "n_ref", "n_cur"), "feature")
    rs = F.try_divide(F.col("r"), F.col("n_ref"))
    cs = F.try_divide(F.col("c"), F.col("n_cur"))
    rs = F.when(rs == 0, F.lit(0.0001)).otherwise(rs)
    cs = F.when(cs == 0, F.lit(0.0001)).otherwise(cs)
    out = binned.groupBy("feature").agg(F.sum((cs - rs) * F.log(cs / rs)).alias("drift_score"))
    return out.select(
        "feature", F.lit("psi").alias("stattest"), "drift_score", F.lit(float(threshold)).alias("threshold"),
        (F.col("drift_score") >= F.lit(float(threshold))).alias("drifted"),
    )


def dataset_drift(table: DataFrame, share: float = MONITORING_DEFAULTS["dataset_drift_share"], part: list[str] | None = None) -> DataFrame:
    """Drifted count and share; the dataset drifts when the share reaches ``share``."""
    g = table.groupBy(*(part or [])) if part else table
    out = g.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum(F.col("drifted").cast("long")).alias("n_drifted"),
    ).withColumn("share_drifted", F.col("n_drifted").cast("double") / F.col("n_features"))
    return out.withColumn("dataset_drift", F.col("share_drifted") >= F.lit(float(share)))


def drift_gate(table: DataFrame, max_share: float = MONITORING_DEFAULTS["drift_share_threshold"]) -> DataFrame:
    """CI gate: passes while the share of drifted features is below ``max_share``."""
    s = dataset_drift(table)
    return s.select("n_features", "n_drifted", "share_drifted", (F.col("share_drifted") < F.lit(float(max_share))).alias("test_suite_passed"))


def prediction_drift(ref_pred: DataFrame, cur_pred: DataFrame, col: str = "predicted",
                     threshold: float = MONITORING_DEFAULTS["prediction_drift_threshold"]) -> DataFrame:
    """Layer 2: normed Wasserstein distance of two prediction samples, plus their means and stds."""
    r = ref_pred.select(F.col(col).alias("prediction"))
    c = cur_pred.select(F.col(col).alias("prediction"))
    st = feature_stats(value_counts(stack_sides(r, c, ["prediction"])))
    moments = r.agg(F.avg("prediction").alias("reference_mean"), F.stddev_pop("prediction").alias("reference_std")).unionByName(
        c.agg(F.avg("prediction").alias("current_mean"), F.stddev_pop("prediction").alias("current_std")), allowMissingColumns=True
    ).agg(*[F.first(x, ignorenulls=True).alias(x) for x in ("reference_mean", "reference_std", "current_mean", "current_std")])
    score = st.select(F.col("wasserstein_norm").alias("drift_score"))
    from cyclewise.functions.rows import combine_rows

    out = combine_rows(score, moments)
    return out.select(
        (F.col("drift_score") >= F.lit(float(threshold))).alias("drift_detected"),
        "drift_score", F.lit(float(threshold)).alias("threshold"),
        "reference_mean", "reference_std", "current_mean", "current_std",
    )


# ------------------------------------------------------------------ perturbation (M9, M10)
def _u32(s: Column) -> Column:
    """First 32 bits of ``md5(s)`` as a non-negative integer."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long")


def keyed_normal(keys: list[str], seed: int) -> Column:
    """Standard normal per row from its keys (Box-Muller over two md5 uniforms).

    Independent of partitioning and task retries, so a lost executor
    recomputes the same noise.
    """
    base = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    u1 = (_u32(F.concat_ws("|", base, F.lit("a"))) + 1) / F.lit(4294967297.0)
    u2 = (_u32(F.concat_ws("|", base, F.lit("b"))) + 1) / F.lit(4294967297.0)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def column_sign(name: str, seed: int) -> int:
    """+1 or -1 per column name and seed (md5 parity; same rule as the SQL oracle)."""
    import hashlib

    h = int(hashlib.md5(f"{name}|{seed}".encode()).hexdigest()[:8], 16)
    return 1 if h % 2 == 0 else -1


def perturb(df: DataFrame, cols: list[str], keys: list[str], noise_factor: float = PERTURB_DEFAULTS["noise_factor"],
            shift_factor: float = PERTURB_DEFAULTS["shift_factor"], seed: int = PERTURB_DEFAULTS["seed"],
            parts: tuple[bool, bool] = (True, True), suffix: str | None = None) -> DataFrame:
    """What-if drift: first half of ``cols`` gets one shared noise value per row times the column's sample std;
    second half shifts by ``± shift_factor × range``.  Columns with std 0 / range 0 are left as they are.

    Column stats are one aggregate read back as literals (three numbers per column).
    """
    present = [c for c in cols if c in df.columns]
    half = len(present) // 2
    g1, g2 = present[:half], present[half:]
    stats = df.agg(
        *[F.stddev_samp(c).alias(f"sd_{i}") for i, c in enumerate(g1)],
        *[(F.max(c) - F.min(c)).alias(f"rg_{i}") for i, c in enumerate(g2)],
    ).first() if present else None
    noise = keyed_normal(keys, seed) * F.lit(float(noise_factor))
    repl: dict[str, Column] = {}
    if parts[0]:
        for i, c in enumerate(g1):
            sd = stats[f"sd_{i}"]
            if sd is not None and sd > 0:
                repl[c] = F.col(c) + noise * F.lit(float(sd))
    if parts[1]:
        for i, c in enumerate(g2):
            rg = stats[f"rg_{i}"]
            if rg is not None and rg > 0:
                repl[c] = F.col(c) + F.lit(float(shift_factor * rg * column_sign(c, seed)))
    if suffix is not None:
        # keep the originals and add the perturbed copies next to them, so both
        # versions of a row can be scored in one projection (no self-join)
        return df.select("*", *[(repl[c] if c in repl else F.col(c)).alias(f"{c}{suffix}") for c in present])
    return df.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ impact (M11, A8)
def exact_ranks(df: DataFrame, col: str, ranks: list[int], buckets: int = 1024) -> dict[int, float | None]:
    """The values of the given ranks (1-based, ascending), exactly, without one task holding the column.

    Two approximate quantiles bracket all ranks; one aggregate counts the rows below, at, between and above them.  A
    rank on a bracket is answered; the others go on in the open region that holds them, as a rule half of a
    ``buckets``-th of the rows and always smaller, as its brackets are left out.
    """
    accuracy = 10 * buckets
    x = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n = x.count()
    out: dict[int, float | None] = {k: None for k in ranks if not 1 <= k <= n}
    todo = [(x, n, 0, sorted({k for k in ranks if 1 <= k <= n}))]  # rows, how many, how many below them, ranks
    while todo:
        x, n, skip, wanted = todo.pop()
        if not wanted:
            continue
        slack = 2.0 / accuracy
        probs = [max(0.0, (wanted[0] - skip - 1) / n - slack), min(1.0, (wanted[-1] - skip) / n + slack)]
        lo, hi = x.agg(F.percentile_approx("v", probs, accuracy).alias("q")).first()["q"]
        v = F.col("v")
        tests = [v < lo, v == lo, (v > lo) & (v < hi), (v == hi) & (v > lo), v > hi]
        counts = x.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests)]).first()
        for i, (test, size) in enumerate(zip(tests, counts, strict=True)):
            mine = [k for k in wanted if skip < k <= skip + size]
            if i in (1, 3):
                out |= {k: float(lo if i == 1 else hi) for k in mine}
            elif mine:
                todo.append((x.filter(test), size, skip, mine))
            skip += size
    return out


def exact_rank_value(df: DataFrame, col: str, k: int, buckets: int = 1024) -> float | None:
    """The ``k``-th smallest value, None beyond the rows."""
    return exact_ranks(df, col, [k], buckets)[k]


def exact_median(df: DataFrame, col: str) -> float | None:
    """Median as numpy defines it: the middle value, or the mean of the two middle values."""
    n = df.filter(F.col(col).isNotNull()).count()
    if n == 0:
        return None
    middle = sorted({(n + 1) // 2, n // 2 + 1})
    found = exact_ranks(df, col, middle)
    return sum(found[k] for k in middle) / len(middle)


def drift_impact(pairs: DataFrame, ref: str = "ref_pred", drifted: str = "drift_pred",
                 limit: float = 10.0) -> DataFrame:
    """Mean, max and median absolute change, share of changes above ``limit`` (%), and both means."""
    # the pairs are scored once; the median's passes read one narrow column
    d = cut_lineage(pairs.select(F.abs(F.col(drifted) - F.col(ref)).alias("_d"), ref, drifted), "impact-pairs")
    med = exact_median(d, "_d")
    return d.agg(
        F.avg("_d").alias("mean_prediction_change"),
        F.max("_d").alias("max_prediction_change"),
        (F.avg((F.col("_d") > F.lit(limit)).cast("double")) * F.lit(100.0)).alias("pct_predictions_changed_gt_10"),
        F.avg(ref).alias("reference_pred_mean"),
        F.avg(drifted).alias("drifted_pred_mean"),
    ).withColumn("median_prediction_change", F.lit(med).cast("double"))


# ------------------------------------------------------------------ report table (M12)
def side_histogram(stacked: DataFrame, bins: int = 20) -> DataFrame:
    """Per feature and side, counts in ``bins`` equal-width bins over the feature's range on both sides.

    ``(feature, side, bin, bin_lo, bin_hi, n)``, empty bins included.
    """
    rng = stacked.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    w = F.col("_hi") - F.col("_lo")
    b = F.when(w > 0, F.least(F.floor((F.col("value") - F.col("_lo")) / w * F.lit(bins)), F.lit(bins - 1))).otherwise(0)
    counts = stacked.join(F.broadcast(rng), "feature").groupBy("feature", "side", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(
        "feature", "_lo", "_hi",
        F.explode(F.array(F.lit(REF), F.lit(CUR))).alias("side"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return grid.join(counts, ["feature", "side", "bin"], "left").select(
        "feature", "side", "bin",
        (F.col("_lo") + step * F.col("bin")).alias("bin_lo"),
        (F.col("_lo") + step * (F.col("bin") + 1)).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    )


def drift_report_table(ref: DataFrame, cur: DataFrame, features: list[str], bins: int = 20, cfg: dict | None = None) -> DataFrame:
    """Data behind the drift report: side-by-side histograms with the automatic test's verdict per feature."""
    st = stack_sides(ref, cur, features)
    hist = side_histogram(st, bins)
    verdict = drift_table(feature_stats(value_counts(st)), "auto", cfg)
    return hist.join(verdict, "feature")


# ------------------------------------------------------------------ half split (K4)
def half_split(df: DataFrame, unit: str = "unit_number", cycle: str = "time_cycles") -> DataFrame:
    """Adds ``side``: the first ``floor(n / 2)`` rows in ``(unit, cycle)`` order are the reference.

    The global position comes from per-engine counts and a row number inside
    each engine (:func:`dense_positions`), never from a single-task window.
    """
    from cyclewise.operators.ordering import dense_positions, key_group, key_segment_bucket

    n = df.count()
    pos = dense_positions(df, keys=[], order=[unit, cycle], bucket=key_segment_bucket(unit, cycle), out="_hpos", coarse=key_group(unit))
    return pos.withColumn("side", F.when(F.col("_hpos") <= F.lit(n // 2), F.lit(REF)).otherwise(F.lit(CUR))).drop("_hpos")
