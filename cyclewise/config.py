"""Column layout, rule tables and default parameters.

Everything here is plain data passed to the operators; nothing reads files.
"""

from __future__ import annotations

UNIT = "unit_number"
CYCLE = "time_cycles"
KEYS = [UNIT, CYCLE]
SETTINGS = ["setting_1", "setting_2", "setting_3"]
SENSORS = [f"s_{i}" for i in range(1, 22)]
RAW_COLUMNS = KEYS + SETTINGS + SENSORS
RAW_COLUMN_COUNT = 26
TARGET = "rul"

# --- Fixed values (must equal the behaviour being re-created) -------------
# Plausible range per sensor, (low, high), for sensors s_1 .. s_21 in order.
SENSOR_BOUNDS: dict[str, tuple[float, float]] = {
    "s_1": (440.0, 520.0),
    "s_2": (637.0, 650.0),
    "s_3": (1555.0, 1620.0),
    "s_4": (1280.0, 1420.0),
    "s_5": (0.0, 25.0),
    "s_6": (0.0, 25.0),
    "s_7": (340.0, 560.0),
    "s_8": (2387.0, 2390.0),
    "s_9": (9000.0, 9500.0),
    "s_10": (1.25, 1.35),
    "s_11": (40.0, 50.0),
    "s_12": (375.0, 560.0),
    "s_13": (2387.0, 2390.0),
    "s_14": (8090.0, 8200.0),
    "s_15": (8.0, 9.0),
    "s_16": (0.01, 0.05),
    "s_17": (300.0, 400.0),
    "s_18": (2380.0, 2400.0),
    "s_19": (100.0, 100.1),
    "s_20": (14.0, 40.0),
    "s_21": (20.0, 25.0),
}
# Widening of the bounds: raw gate (low x 0.5, high x 2.0),
# inference gate (low x 0.8, high x 1.2).
RAW_GATE_FACTORS = (0.5, 2.0)
INFERENCE_GATE_FACTORS = (0.8, 1.2)
# Asymmetric score: early d<0 -> exp(-d/13)-1, late d>=0 -> exp(d/10)-1.
PHM_EARLY_DIVISOR = 13.0
PHM_LATE_DIVISOR = 10.0
# Validation report keeps the first 20 errors; feature gate warns below 30 columns.
REPORT_MAX_ERRORS = 20
FEATURE_MIN_COLUMNS = 30
# Scoring: predict needs >= 1 reading, drift check >= 10, warn below 5;
# drift check needs >= 5 shared columns.
PREDICT_MIN_READINGS = 1
DRIFT_MIN_READINGS = 10
SHORT_REQUEST_WARN = 5
DRIFT_MIN_SHARED_COLUMNS = 5
# Impact: share of predictions that moved by more than 10 cycles; retrain when
# the mean change exceeds 10.
IMPACT_CHANGE_LIMIT = 10.0
# Histograms: 50 bins for errors, 40 for the RUL distributions.
ERROR_HIST_BINS = 50
RUL_HIST_BINS = 40
# Top features in the importance report.
IMPORTANCE_TOP_N = 20
# ---------------------------------------------------------------------------

FEATURE_DEFAULTS: dict = {
    "rul_cap": 125,
    "drop_sensors": [1, 5, 10, 16, 18, 19],
    "rolling_window_sizes": [5, 10, 20],
    "lag_steps": [1, 3, 5],
}

MODEL_DEFAULTS: dict = {
    "type": "gbt",
    "gbt": {
        "n_estimators": 200,
        "max_depth": 6,
        "learning_rate": 0.1,
        "subsample": 0.8,
        "colsample_bytree": 0.8,
        "random_state": 42,
    },
    "ridge": {"alpha": 1.0},
}

TRAINING_DEFAULTS: dict = {"cv_folds": 5}

MONITORING_DEFAULTS: dict = {
    "drift_share_threshold": 0.3,
    "prediction_drift_threshold": 0.1,
    "drift_stattest": "ks",
    "ks_p_threshold": 0.05,
    "wasserstein_threshold": 0.1,
    "psi_threshold": 0.1,
    "jensenshannon_threshold": 0.1,
    "dataset_drift_share": 0.5,
    "auto_small_sample": 1000,
    "auto_low_cardinality": 5,
}

RETRAIN_DEFAULTS: dict = {
    "trigger_on_data_drift": True,
    "trigger_on_prediction_drift": True,
    "min_drift_share": 0.3,
}

PERTURB_DEFAULTS: dict = {"noise_factor": 0.15, "shift_factor": 0.1, "seed": 42}


def feature_config(**overrides) -> dict:
    cfg = dict(FEATURE_DEFAULTS)
    cfg.update(overrides)
    return cfg


def active_sensors(columns: list[str], drop_sensors: list[int]) -> list[str]:
    """Sensor columns present in ``columns`` after the drop list, in table order."""
    dropped = {f"s_{i}" for i in drop_sensors}
    return [c for c in columns if c.startswith("s_") and c not in dropped]
