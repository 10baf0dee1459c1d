"""Queries for scoring requests, the batch drift check, and their streaming forms.

State: scaler fitted on the training engines of the 26-column lineitem view
(15 active sensors); model: the fixed linear scorer of the metric queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.config import SENSORS, SETTINGS
from cyclewise.operators import features as fe
from cyclewise.operators import scoring as sc
from cyclewise.plans.q_features import sql_window_features
from cyclewise.plans.q_metrics import SQL_WINDOW_PRED, WINDOW_SCORER
from cyclewise.plans.registry import oracle, query, rnd, sql_round
from cyclewise.session import scratch_path
from cyclewise.sources.views import fleet_full, request_rows, train_split, with_views
from cyclewise.streaming import streams

ACTIVE = [s for s in SENSORS if s not in {f"s_{i}" for i in fe.FEATURE_DEFAULTS["drop_sensors"]}]


def full_state(spark, sf, lag_means: bool = False):
    return fe.fit_state(train_split(fleet_full(spark, sf)), with_lag_means=lag_means)


def baseline(spark, sf, state):
    train = train_split(fleet_full(spark, sf))
    return fe.minmax_transform(train.select(*state.sensor_cols), {s: state.scaler[s] for s in state.sensor_cols})


def _sql_scaled_full(src: str, cols: list[str]) -> str:
    mm = ", ".join(f"min({s}) AS mn_{s}, max({s}) AS mx_{s}" for s in cols)
    rep = ", ".join(
        f"CASE WHEN mx_{s} > mn_{s} THEN ({s} - mn_{s}) / (mx_{s} - mn_{s}) ELSE {s} - mn_{s} END AS {s}" for s in cols
    )
    return f"SELECT t.* REPLACE ({rep}) FROM ({src}) t CROSS JOIN (SELECT {mm} FROM full_train) b"


# ---------------------------------------------------------------- P9 / P10
@query("request_order_check")
def q_order(spark, sf):
    return sc.request_checks(request_rows(spark, sf))


SQL_CHECKS = """
SELECT request_id, count(*) AS n_readings, max(coalesce(CAST(back AS INTEGER), 0)) = 0 AS ordered FROM (
  SELECT request_id, lag(time_cycles) OVER (PARTITION BY request_id ORDER BY pos) > time_cycles AS back FROM request_rows)
GROUP BY request_id"""


@oracle("request_order_check")
def o_order():
    return with_views(["request_rows"], f"""
SELECT request_id, n_readings, ordered, ordered AND n_readings >= 1 AS accept_predict,
       n_readings >= 10 AS accept_drift, n_readings < 5 AS warn_short FROM ({SQL_CHECKS})""")


# ---------------------------------------------------------------- R1
@query("score_requests")
def q_score(spark, sf):
    out = sc.score_requests(request_rows(spark, sf), full_state(spark, sf, lag_means=True), WINDOW_SCORER)
    return rnd(out.withColumn("warnings", F.array_join("warnings", "\n")))


def sql_scored_requests() -> str:
    from cyclewise.operators.validate import INFERENCE_RULES
    from cyclewise.plans.q_validate import sql_violations

    scaled = _sql_scaled_full("SELECT request_id AS unit_number, pos AS time_cycles, s_2, s_3 FROM request_rows", ["s_2", "s_3"])
    part = "PARTITION BY unit_number ORDER BY time_cycles"
    fit, _ = sql_window_features(f"({_sql_scaled_full('SELECT unit_number, time_cycles, s_2, s_3 FROM full_train', ['s_2', 's_3'])})",
                                 ["s_2"], [5], [3], ["unit_number"])
    viol = sql_violations("(SELECT * FROM request_rows WHERE request_id IN (SELECT request_id FROM ok))", INFERENCE_RULES,
                          unit="request_id")
    return f"""
WITH chk AS ({SQL_CHECKS}),
ok AS (SELECT request_id, n_readings FROM chk WHERE ordered AND n_readings >= 1),
iss AS (SELECT unit_number AS request_id, count(*) AS n_issues FROM ({viol}) GROUP BY unit_number),
f AS (SELECT unit_number AS request_id, s_2, s_3,
             avg(s_2) OVER ({part} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s_2_roll_mean_10,
             max(s_3) OVER ({part} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS s_3_roll_max_5,
             coalesce(lag(s_2, 3) OVER ({part}), (SELECT avg(s_2_lag_3) FROM ({fit}))) AS s_2_lag_3,
             coalesce(s_3 - lag(s_3, 1) OVER ({part}), 0.0) AS s_3_diff,
             row_number() OVER (PARTITION BY unit_number ORDER BY time_cycles DESC) AS back
      FROM ({scaled}) WHERE unit_number IN (SELECT request_id FROM ok)),
p AS (SELECT request_id, floor(greatest({SQL_WINDOW_PRED}, 0.0) * 100.0 + 0.5) / 100.0 AS rul_prediction FROM f WHERE back = 1)
SELECT p.request_id, p.rul_prediction, ok.n_readings AS input_cycles,
       array_to_string(list_filter([
         CASE WHEN coalesce(iss.n_issues, 0) > 0 THEN printf('{sc.VALIDATION_WARNING}', iss.n_issues) END,
         CASE WHEN ok.n_readings < 5 THEN '{sc.SHORT_WARNING}' END], lambda x: x IS NOT NULL), chr(10)) AS warnings
FROM p JOIN ok USING (request_id) LEFT JOIN iss USING (request_id)"""


@oracle("score_requests")
def o_score():
    return with_views(["request_rows", "full_train"], sql_round(f"SELECT * FROM ({sql_scored_requests()})", ["rul_prediction"]))


# ---------------------------------------------------------------- M2 / P8
@query("drift_check_batch")
def q_drift_check(spark, sf):
    """Every request's share of drifted columns and flag; requests with too few readings have no row."""
    state = full_state(spark, sf)
    return rnd(sc.drift_verdicts(request_rows(spark, sf), baseline(spark, sf, state), state))


@query("drift_check_details")
def q_drift_details(spark, sf):
    """Every request's test per column."""
    state = full_state(spark, sf)
    return rnd(sc.drift_check(request_rows(spark, sf), baseline(spark, sf, state), state))


def sql_sample_ks(cur: str, keys: str) -> str:
    """KS of each sample (``keys``, sensors; a subquery) against the baseline by ASOF joins at the sample's values."""
    ref = _sql_scaled_full("SELECT * FROM full_train", ACTIVE)
    tall = lambda src, k: "\nUNION ALL\n".join(f"SELECT {k}'{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM ({src})" for f in ACTIVE)
    fine = "value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)"
    return f"""
WITH rc AS (SELECT feature, value, count(*) AS r FROM ({tall(ref, '')}) WHERE {fine} GROUP BY ALL),
rr AS (SELECT feature, value, sum(r) OVER (PARTITION BY feature ORDER BY value) AS upto, sum(r) OVER (PARTITION BY feature) AS n_ref FROM rc),
cc AS (SELECT {keys}, feature, value, count(*) AS c FROM ({tall(cur, keys + ', ')}) WHERE {fine} GROUP BY ALL),
cr AS (SELECT *, sum(c) OVER (PARTITION BY {keys}, feature ORDER BY value) AS cum, sum(c) OVER (PARTITION BY {keys}, feature) AS n_cur FROM cc),
le AS (SELECT cr.*, coalesce(rr.upto, 0) AS upto FROM cr ASOF LEFT JOIN rr ON cr.feature = rr.feature AND cr.value >= rr.value),
lt AS (SELECT le.*, coalesce(rr.upto, 0) AS before FROM le ASOF LEFT JOIN rr ON le.feature = rr.feature AND le.value > rr.value),
d AS (SELECT {keys}, feature, any_value(n_ref) AS n, any_value(n_cur) AS m,
             max(greatest(abs(upto / n_ref - cum / n_cur), abs(before / n_ref - (cum - c) / n_cur))) AS ks_d
      FROM lt JOIN (SELECT feature, any_value(n_ref) AS n_ref FROM rr GROUP BY feature) t USING (feature) GROUP BY ALL),
l AS (SELECT *, (sqrt(n * m / (n + m)) + 0.12 + 0.11 / sqrt(n * m / (n + m))) * ks_d AS lam FROM d),
s AS (SELECT {keys}, feature, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2.0 * list_sum(list_transform(range(1, 101),
        lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))), 0.0), 1.0) END AS p FROM l)
SELECT {keys}, feature, 'ks' AS stattest, CAST(p AS DOUBLE) AS drift_score, CAST(0.05 AS DOUBLE) AS threshold, p <= 0.05 AS drifted FROM s"""


SQL_ENOUGH = "(SELECT * FROM request_rows WHERE request_id IN (SELECT request_id FROM request_rows GROUP BY request_id HAVING count(*) >= 10))"


def sql_drift_check() -> str:
    return sql_sample_ks(_sql_scaled_full(f"SELECT * FROM {SQL_ENOUGH}", ACTIVE), "request_id")


@oracle("drift_check_batch")
def o_drift_check():
    return with_views(["request_rows", "full_train"], sql_round(f"""
SELECT request_id, count(*) AS n_features, CAST(sum(CAST(drifted AS INTEGER)) AS BIGINT) AS n_drifted,
       sum(CAST(drifted AS INTEGER)) / count(*) AS share_drifted, sum(CAST(drifted AS INTEGER)) / count(*) >= 0.5 AS dataset_drift
FROM ({sql_drift_check()}) GROUP BY request_id""", ["share_drifted"]))


@oracle("drift_check_details")
def o_drift_details():
    return with_views(["request_rows", "full_train"], sql_round(f"SELECT * FROM ({sql_drift_check()})", ["drift_score", "threshold"]))


# ---------------------------------------------------------------- R2 / R3
STREAM_SCHEMA = (
    "request_id int, pos int, time_cycles int, "
    + ", ".join(f"{c} double" for c in SETTINGS + SENSORS)
    + ", split int"
)


def _stream_source(spark, sf) -> str:
    """Request rows split by ``request_id % 3`` into partition folders of a new folder; whole requests per file."""
    path = scratch_path(spark, "request-stream")
    rows = request_rows(spark, sf).withColumn("split", F.pmod(F.col("request_id"), F.lit(3)).cast("int"))
    rows.repartition("request_id").write.partitionBy("split").parquet(path)
    return path


@query("stream_score")
def q_stream_score(spark, sf):
    state = full_state(spark, sf, lag_means=True)
    src = _stream_source(spark, sf)
    out = streams.stream_score(spark, src, STREAM_SCHEMA, state, WINDOW_SCORER, scratch_path(spark, "stream-score-sink"))
    return rnd(out.drop("batch_id").withColumn("warnings", F.array_join("warnings", "\n")))


@oracle("stream_score")
def o_stream_score():
    return o_score()


def _arrivals(spark, sf) -> str:
    """Request rows as three files that arrive one after the other, by ``request_id % 3``; ``split`` is ``request_id % 2``."""
    path = scratch_path(spark, "arrivals")
    rows = request_rows(spark, sf).withColumn("split", F.pmod(F.col("request_id"), F.lit(2)).cast("int"))
    for k in range(3):
        rows.filter(F.pmod(F.col("request_id"), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(path)
    return path


@query("stream_drift")
def q_stream_drift(spark, sf):
    """A row per batch, split and column: the drift of all readings up to that batch."""
    state = full_state(spark, sf)
    out = streams.stream_drift(spark, _arrivals(spark, sf), STREAM_SCHEMA, baseline(spark, sf, state), state, scratch_path(spark, "stream-drift-sink"))
    return rnd(out.withColumn("batch_id", F.col("batch_id").cast("long")))


@oracle("stream_drift")
def o_stream_drift():
    cur = _sql_scaled_full("SELECT b.batch_id, request_id % 2 AS split, q.* FROM request_rows q JOIN (SELECT unnest([0, 1, 2]) AS batch_id) b ON q.request_id % 3 <= b.batch_id", ACTIVE)
    body = f"SELECT * REPLACE (CAST(batch_id AS BIGINT) AS batch_id, CAST(split AS INTEGER) AS split) FROM ({sql_sample_ks(cur, 'batch_id, split')})"
    return with_views(["request_rows", "full_train"], sql_round(body, ["drift_score", "threshold"]))
