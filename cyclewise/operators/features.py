"""Per-engine features: RUL label, sensor drop, min-max scaling, rolling / lag /
difference windows, and the fitted state that makes training and scoring agree.

Window plan
-----------
All rolling, lag and diff columns come from one shuffle and sort by ``(unit, segment)``: a series is cut into
segments of ``segment_rows`` positions and the last ``halo`` rows of each segment are copied into the next one, so
every row sees the rows that it would see on the whole series.  One very long engine therefore becomes many tasks
instead of one.  If no unit has more rows than a segment, rows go by unit alone and are numbered where they are
computed, so that nothing else is shuffled.  The sorted rows are computed by whole Arrow columns (:mod:`cyclewise.operators.rolling`): measured
against window functions in one projection, this takes a tenth of the CPU time.  Halo copies are dropped after it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cyclewise.config import CYCLE, FEATURE_DEFAULTS, KEYS, SETTINGS, TARGET, UNIT
from cyclewise.operators.ordering import dense_positions, position_segments
from cyclewise.operators.rolling import feature_batches, lag_sum_batches

DEFAULT_SEGMENT_ROWS = 1 << 16


def nan_to_null(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


# ------------------------------------------------------------------ W1, P1
def rul_label(df: DataFrame, rul_cap: int | None = 125, unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """``rul = min(max_cycle - cycle, cap)`` from a per-engine max table (no engine-wide window)."""
    eng = df.groupBy(F.col(unit).alias("_unit")).agg(F.max(cycle).alias("_max_cycle"))
    out = df.join(eng, F.col(unit).eqNullSafe(F.col("_unit"))).drop("_unit")
    rul = F.col("_max_cycle") - F.col(cycle)
    if rul_cap is not None:
        rul = F.least(rul, F.lit(int(rul_cap)))
    return out.withColumn(TARGET, rul.cast("int")).drop("_max_cycle")


def drop_sensors(df: DataFrame, sensors_to_drop: list[int]) -> DataFrame:
    """Drops ``s_<i>`` for each index; absent names are ignored."""
    return df.drop(*[f"s_{i}" for i in sensors_to_drop])


# ------------------------------------------------------------------ A2, F3
def minmax_fit(df: DataFrame, sensors: list[str]) -> DataFrame:
    """One pass of ``min``/``max`` per sensor; a tall state table ``(ord, sensor, data_min, data_max)``.

    NaN is treated as missing (skipped), like the pandas-based fit.
    """
    row = df.agg(
        *[agg(nan_to_null(s)).alias(f"_{tag}{i}") for i, s in enumerate(sensors) for agg, tag in ((F.min, "mn"), (F.max, "mx"))]
    )
    items = [
        F.struct(
            F.lit(i).alias("ord"),
            F.lit(s).alias("sensor"),
            F.col(f"_mn{i}").cast("double").alias("data_min"),
            F.col(f"_mx{i}").cast("double").alias("data_max"),
        )
        for i, s in enumerate(sensors)
    ]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def scaled(x: Column, lo: float | None, hi: float | None) -> Column:
    """Min-max scaling with frozen bounds; a constant column maps to ``x - min``."""
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    if hi > lo:
        return (x - F.lit(lo)) / F.lit(hi - lo)
    return x - F.lit(lo)


def minmax_transform(df: DataFrame, scaler: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Scales the sensors named in ``scaler`` that are present; no clipping of new data."""
    return df.select(*[scaled(nan_to_null(c), *scaler[c]).alias(c) if c in scaler else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ W2-W5
def feature_names(sensors: list[str], windows: list[int], lags: list[int]) -> list[str]:
    names = list(sensors)
    for s in sensors:
        for w in windows:
            names += [f"{s}_roll_mean_{w}", f"{s}_roll_std_{w}", f"{s}_roll_min_{w}", f"{s}_roll_max_{w}"]
        names += [f"{s}_lag_{k}" for k in lags]
        names.append(f"{s}_diff")
    return sorted(names)


def most_unit_rows(df: DataFrame, unit: str = UNIT) -> int:
    """Rows of the unit that has most."""
    return df.groupBy(unit).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0


def _halo(windows: list[int], lags: list[int]) -> int:
    return max([w - 1 for w in windows] + lags + [1])


def _sorted_segments(x: DataFrame, sensors: list[str], unit: str, pos: str, seg_rows: int, halo: int) -> DataFrame:
    """Rows with their place ``_p`` among the ``_n`` of their unit, by ``(unit, segment)`` and in order, with the halo of
    each segment and, for the units that have several, a row for the next known reading beyond it."""
    x = dense_positions(x, [unit], [pos], F.floor(F.col(pos) / F.lit(seg_rows)), out="_p", total="_n")
    x = x.withColumn("_seg", position_segments(F.col("_p"), seg_rows))
    in_halo = ((F.col("_p") - F.lit(1)) % F.lit(seg_rows)) >= F.lit(seg_rows - halo)
    rows = x.withColumn(
        "_wseg",
        F.explode(F.when(in_halo, F.array(F.col("_seg"), F.col("_seg") + F.lit(1))).otherwise(F.array(F.col("_seg")))),
    ).drop("_seg").withColumn("_kp", F.lit(None).cast("array<double>"))
    # per segment of a long unit, the next known reading beyond it
    known = {s: F.col(s).isNotNull() for s in sensors}
    firsts = x.filter(F.col("_n") > seg_rows).groupBy(unit, "_seg").agg(
        F.max("_n").alias("_n"), *[F.min(F.when(known[s], F.col("_p"))).alias(f"_fp{i}") for i, s in enumerate(sensors)],
        *[F.min_by(F.col(s), F.when(known[s], F.col("_p"))).alias(f"_fv{i}") for i, s in enumerate(sensors)],
    )
    later = Window.partitionBy(unit).orderBy(F.col("_seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
    first = lambda c: F.last(c, ignorenulls=True).over(later)
    ends = firsts.select(
        F.col(unit), F.lit(1 << 53).alias("_p"), "_n", F.col("_seg").alias("_wseg"),
        F.array(*[F.coalesce(first(f"_fp{i}").cast("double"), F.lit(float("nan"))) for i in range(len(sensors))]).alias("_kp"),
        *[first(f"_fv{i}").alias(s) for i, s in enumerate(sensors)],
    )
    rows = rows.unionByName(ends, allowMissingColumns=True) if sensors else rows
    return rows.repartition(F.col(unit), F.col("_wseg")).sortWithinPartitions(unit, "_wseg", "_p")


def window_features(
    df: DataFrame,
    sensors: list[str],
    windows: list[int],
    lags: list[int],
    unit: str = UNIT,
    pos: str = CYCLE,
    segment_rows: int = DEFAULT_SEGMENT_ROWS,
    lag_fill: bool = True,
    last_only: bool = False,
    columns: list[str] | None = None,
    unit_rows: int | None = None,
) -> DataFrame:
    """Rolling mean / sample std / min / max, back-filled lags, first differences.

    Rows are numbered 1..n per ``unit`` by ``pos``, which may have gaps and start anywhere; only that number is used
    from then on, so a unit's features depend on its own rows alone.

    * rolling: at least one row, std of a single row is 0; NaN counts as missing.
    * lag k: ``x[i-k]``; empty ones take the next known lag of the same
      engine (back-fill), i.e. the first known ``x[p]`` with ``max(i-k, 1) <= p <= n-k``; a lag still empty takes
      the table-wide mean of that lag column (``lag_fill=False`` leaves it NULL: used when every
      ``unit`` is a separate request whose data must not mix).
    * diff: ``x[i] - x[i-1]``, first row 0.

    ``last_only`` gives out each unit's last row, ``columns`` computes the named features only.  ``unit_rows`` says how
    many rows a unit has at most, if that is known; otherwise they are counted.
    """
    windows = sorted(set(windows))
    lags = sorted(set(lags))
    halo = _halo(windows, lags)
    seg_rows = max(int(segment_rows), halo + 1)
    whole = (most_unit_rows(df, unit) if unit_rows is None else unit_rows) <= seg_rows
    if whole:
        sorted_rows = df.repartition(F.col(unit)).sortWithinPartitions(unit, pos)
    else:
        sorted_rows = _sorted_segments(df, sensors, unit, pos, seg_rows, halo)
    names = [f"{s}_{t}" for s in sensors for w in windows for t in (f"roll_mean_{w}", f"roll_std_{w}", f"roll_min_{w}", f"roll_max_{w}")]
    lag_cols = [f"{s}_lag_{k}" for s in sensors for k in lags]
    made = [c for c in (*names, *lag_cols, *(f"{s}_diff" for s in sensors)) if columns is None or c in columns]
    schema = df.select(*df.columns, *[F.lit(0.0).alias(c) for c in made]).schema
    schema = StructType([StructField(f.name, f.dataType, True) for f in schema])
    out = sorted_rows.mapInArrow(
        feature_batches(list(df.columns), unit, sensors, windows, lags, seg_rows, schema.names, whole, halo + 1 if last_only else None), schema)
    lag_cols = [c for c in lag_cols if c in made]
    if not lag_fill or not lag_cols:
        return out
    return fill_lags(out, window_lag_means(df, sensors, lags, unit, pos, segment_rows, 1 if whole else seg_rows + 1))


def window_lag_means(df: DataFrame, sensors: list[str], lags: list[int], unit: str = UNIT, pos: str = CYCLE,
                     segment_rows: int = DEFAULT_SEGMENT_ROWS, unit_rows: int | None = None) -> dict[str, float]:
    """Mean of each lag column of :func:`window_features`, which is not written for it: tasks give out sums."""
    lags = sorted(set(lags))
    if not lags or not sensors:
        return {}
    narrow = df.select(*dict.fromkeys([unit, pos, *sensors]))
    seg_rows = max(int(segment_rows), _halo([], lags) + 1)
    whole = (most_unit_rows(narrow, unit) if unit_rows is None else unit_rows) <= seg_rows
    rows = narrow.repartition(F.col(unit)).sortWithinPartitions(unit, pos) if whole else _sorted_segments(narrow, sensors, unit, pos, seg_rows, _halo([], lags))
    sums = rows.mapInArrow(lag_sum_batches(unit, sensors, lags, seg_rows, whole), "column string, total double, n long")
    found = sums.groupBy("column").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # a row per lag column
    return {r["column"]: r["total"] / r["n"] for r in found if r["n"]}


def fill_lags(features: DataFrame, means: dict[str, float]) -> DataFrame:
    return features.select(*[F.coalesce(F.col(c), F.lit(means[c])).alias(c) if c in means else F.col(c) for c in features.columns])


# ------------------------------------------------------------------ F1-F4, P3-P4
@dataclass
class FeatureState:
    """Fitted state: scaler bounds per sensor, active sensors, feature list, config."""

    config: dict
    sensor_cols: list[str]
    scaler: dict[str, tuple[float | None, float | None]]
    feature_columns: list[str] = field(default_factory=list)
    #: fit-time mean of each lag column, for readings that have none (a request too short for it)
    lag_means: dict[str, float] = field(default_factory=dict)

    def scaler_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, s, self.scaler[s][0], self.scaler[s][1]) for i, s in enumerate(self.sensor_cols)]
        return spark.createDataFrame(rows, "ord int, sensor string, data_min double, data_max double")

    def save(self, spark: SparkSession, path: str) -> None:
        """State table in Parquet + one JSON row of config / column lists."""
        self.scaler_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
        meta = json.dumps(
            {"config": self.config, "sensor_cols": self.sensor_cols, "feature_columns": self.feature_columns, "lag_means": self.lag_means}
        )
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureState:
        try:
            meta_row = spark.read.schema("meta string").json(f"{path}/meta").first()
            rows = spark.read.parquet(f"{path}/scaler").orderBy("ord").collect()
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            raise FileNotFoundError(f"feature state not found: {path}") from exc
        if meta_row is None:
            raise FileNotFoundError(f"feature state not found: {path}")
        meta = json.loads(meta_row["meta"])
        scaler = {r["sensor"]: (r["data_min"], r["data_max"]) for r in rows}
        return cls(meta["config"], meta["sensor_cols"], scaler, meta["feature_columns"], meta.get("lag_means", {}))


def _cfg(config: dict | None) -> dict:
    cfg = dict(FEATURE_DEFAULTS)
    cfg.update(config or {})
    return cfg


def fit_transform(
    df: DataFrame, config: dict | None = None, segment_rows: int = DEFAULT_SEGMENT_ROWS, columns: list[str] | None = None,
) -> tuple[DataFrame, FeatureState]:
    """RUL -> drop -> fit scaler -> scale -> rolling / lag / diff; records the feature list.

    The features are a plan: who reads them more than once writes them.  ``columns`` computes the named features only;
    the state names all.
    """
    cfg = _cfg(config)
    unit_rows = most_unit_rows(df)
    kept = drop_sensors(df, cfg.get("drop_sensors", []))
    sensors = [c for c in kept.columns if c.startswith("s_")]
    state_rows = minmax_fit(kept, sensors).collect()  # one row per sensor
    scaler = {r["sensor"]: (r["data_min"], r["data_max"]) for r in state_rows}
    scaled_rows = minmax_transform(kept, scaler)
    windows, lags = cfg["rolling_window_sizes"], cfg["lag_steps"]
    means = window_lag_means(scaled_rows, sensors, lags, segment_rows=segment_rows, unit_rows=unit_rows)
    out = rul_label(scaled_rows, cfg.get("rul_cap", 125))
    feats = sorted({*out.columns, *feature_names(sensors, windows, lags)} - {*KEYS, *SETTINGS, TARGET})
    out = window_features(out, sensors, windows, lags, segment_rows=segment_rows, lag_fill=False, columns=columns, unit_rows=unit_rows)
    return fill_lags(out, {c: m for c, m in means.items() if c in out.columns}), FeatureState(cfg, sensors, scaler, feats, means)


def transform(
    df: DataFrame, state: FeatureState | None, unit: str = UNIT, pos: str = CYCLE,
    segment_rows: int = DEFAULT_SEGMENT_ROWS, lag_fill: bool = True,
) -> DataFrame:
    """Same steps with frozen state and no RUL; refuses an unfitted state."""
    if state is None or not state.scaler or state.sensor_cols is None:
        raise RuntimeError("feature state is not fitted: fit first or load a saved state")
    cfg = state.config
    out = drop_sensors(df, cfg.get("drop_sensors", []))
    sensors = [c for c in state.sensor_cols if c in out.columns]
    out = minmax_transform(out, {s: state.scaler[s] for s in sensors})
    return window_features(
        out, sensors, cfg["rolling_window_sizes"], cfg["lag_steps"], unit=unit, pos=pos, segment_rows=segment_rows,
        lag_fill=lag_fill,
    )


def last_row_features(df: DataFrame, state: FeatureState, unit: str = UNIT, pos: str = CYCLE,
                      segment_rows: int = DEFAULT_SEGMENT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Features of each unit's last row by ``pos``, one row per unit, with frozen state.

    Only the rows that the last one's windows reach are kept before the windows run.  A lag that a short unit does not
    have takes the fit-time mean.  ``counted`` holds the same units with as many rows or more, and is cheaper to count.
    """
    if state is None or not state.scaler:
        raise RuntimeError("feature state is not fitted: fit first or load a saved state")
    cfg = state.config
    tail = drop_sensors(df, cfg.get("drop_sensors", []))
    sensors = [c for c in state.sensor_cols if c in tail.columns]
    tail = minmax_transform(tail, {s: state.scaler[s] for s in sensors})
    out = window_features(tail, sensors, cfg["rolling_window_sizes"], cfg["lag_steps"], unit=unit, pos=pos, segment_rows=segment_rows,
                          lag_fill=False, last_only=True, unit_rows=most_unit_rows(df if counted is None else counted, unit))
    return fill_lags(out, state.lag_means)


def align_features(df: DataFrame, feature_columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Trained feature order; missing columns become 0.0, extra columns are dropped."""
    present = set(df.columns)
    keep = [c for c in (keep or []) if c in present]
    return df.select(
        *keep,
        *[F.col(c).cast("double").alias(c) if c in present else F.lit(0.0).alias(c) for c in feature_columns],
    )


def feature_matrix(df: DataFrame, state: FeatureState, keys: list[str] = KEYS) -> DataFrame:
    """Keys + features in canonical (sorted) order + target when present."""
    keep = list(keys) + ([TARGET] if TARGET in df.columns else [])
    return align_features(df, state.feature_columns, keep)


def fit_state(df: DataFrame, config: dict | None = None, with_lag_means: bool = False) -> FeatureState:
    """The fitted state alone (scaler bounds, sensors, feature list): one aggregate; the lag means, which only the
    scoring of short requests needs, take one more over the lag windows."""
    cfg = _cfg(config)
    kept = drop_sensors(df, cfg.get("drop_sensors", []))
    sensors = [c for c in kept.columns if c.startswith("s_")]
    rows = minmax_fit(kept, sensors).collect()
    scaler = {r["sensor"]: (r["data_min"], r["data_max"]) for r in rows}
    feats = feature_names(sensors, cfg["rolling_window_sizes"], cfg["lag_steps"])
    means = {}
    if with_lag_means:
        means = window_lag_means(minmax_transform(kept.select(*KEYS, *sensors), scaler), sensors, cfg["lag_steps"])
    return FeatureState(cfg, sensors, scaler, feats, means)
