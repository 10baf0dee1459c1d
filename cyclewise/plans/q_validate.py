"""Queries for the gates: raw and inference violations, feature quality, report, first errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.config import CYCLE, TARGET, UNIT
from cyclewise.operators import features as fe
from cyclewise.operators import validate as va
from cyclewise.plans.q_features import EV_SENSORS, WINDOWS, LAGS, sql_window_features
from cyclewise.plans.registry import oracle, query, rnd, sql_round
from cyclewise.session import scratch_path
from cyclewise.sources import files
from cyclewise.sources.views import events_full, fleet_events, fleet_full, with_defects, with_views


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_violations(src: str, rules: list[va.Rule], unit: str = UNIT, cycle: str = CYCLE) -> str:
    """One scan: a list of failure structs per row, unnested."""
    items = []
    for r in rules:
        c = r.column
        if r.kind == "not_null":
            fail, val = f"({c} IS NULL OR isnan({c}))" if c not in (UNIT, CYCLE) else f"{c} IS NULL", "CAST(NULL AS DOUBLE)"
        elif r.kind == "ge":
            fail, val = f"{c} < {r.bound!r}", f"CAST({c} AS DOUBLE)"
        else:
            fail, val = f"{c} > {r.bound!r}", f"CAST({c} AS DOUBLE)"
        items.append(f"CASE WHEN {fail} THEN {{'chk': {_sql_str(r.check)}, 'col': '{c}', 'v': {val}}} END")
    return f"""
SELECT e.chk AS "check", e.col AS "column", unit_number, time_cycles, e.v AS failure_value FROM (
  SELECT CAST({unit} AS INTEGER) AS unit_number, CAST({cycle} AS INTEGER) AS time_cycles,
         unnest(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)) AS e
  FROM {src}) t"""


# ---------------------------------------------------------------- V1 / V4
@query("raw_violations")
def q_raw_violations(spark, sf):
    return rnd(va.raw_violations(with_defects(fleet_full(spark, sf))))


@oracle("raw_violations")
def o_raw_violations():
    return with_views(["full_defects"], sql_round(sql_violations("full_defects", va.RAW_RULES), ["failure_value"]))


# ---------------------------------------------------------------- V2
@query("inference_violations")
def q_inference_violations(spark, sf):
    return rnd(va.inference_violations(with_defects(events_full(spark, sf), 23, 29)))


@oracle("inference_violations")
def o_inference_violations():
    return with_views(["events_defects"], sql_round(sql_violations("events_defects", va.INFERENCE_RULES), ["failure_value"]))


# ---------------------------------------------------------------- V3
def _inject(df):
    """Feature-gate fixture: NaN, +inf and out-of-range RUL planted by rule."""
    c = F.col(CYCLE)
    u = F.col(UNIT)
    return df.select(
        *[
            (F.when(c % 41 == 0, F.lit(float("nan"))).otherwise(F.col(x)).alias(x) if x == "s_2_roll_mean_5"
             else F.when(c % 43 == 0, F.lit(float("inf"))).otherwise(F.col(x)).alias(x) if x == "s_3"
             else F.when((c == 1) & (u % 7 == 0), F.lit(-5)).when((c == 2) & (u % 9 == 0), F.lit(200)).otherwise(F.col(x)).alias(x)
             if x == TARGET else F.col(x))
            for x in df.columns
        ]
    )


@query("feature_quality")
def q_feature_quality(spark, sf):
    out, state = fe.fit_transform(fleet_events(spark, sf))
    return va.feature_quality(_inject(fe.feature_matrix(out, state)), rul_cap=125)


@oracle("feature_quality")
def o_feature_quality():
    src = """(SELECT f.*, CAST(least(max(time_cycles) OVER (PARTITION BY unit_number) - time_cycles, 125) AS INTEGER) AS rul
FROM (SELECT t.* REPLACE (
   CASE WHEN mx_s_2 > mn_s_2 THEN (s_2 - mn_s_2) / (mx_s_2 - mn_s_2) ELSE s_2 - mn_s_2 END AS s_2,
   CASE WHEN mx_s_3 > mn_s_3 THEN (s_3 - mn_s_3) / (mx_s_3 - mn_s_3) ELSE s_3 - mn_s_3 END AS s_3)
 FROM fleet_events t CROSS JOIN (SELECT min(s_2) AS mn_s_2, max(s_2) AS mx_s_2, min(s_3) AS mn_s_3, max(s_3) AS mx_s_3
                                 FROM fleet_events) b) f)"""
    sql, feats = sql_window_features(src, EV_SENSORS, WINDOWS, LAGS, [UNIT, CYCLE, TARGET])
    inj = f"""
SELECT * REPLACE (
  CASE WHEN time_cycles % 41 = 0 THEN CAST('nan' AS DOUBLE) ELSE s_2_roll_mean_5 END AS s_2_roll_mean_5,
  CASE WHEN time_cycles % 43 = 0 THEN CAST('inf' AS DOUBLE) ELSE s_3 END AS s_3,
  CAST(CASE WHEN time_cycles = 1 AND unit_number % 7 = 0 THEN -5
            WHEN time_cycles = 2 AND unit_number % 9 = 0 THEN 200 ELSE rul END AS INTEGER) AS rul)
FROM ({sql})"""
    cols = [UNIT, CYCLE, TARGET] + feats
    items = []
    for col in cols:
        is_d = col not in (UNIT, CYCLE, TARGET)
        miss = f"({col} IS NULL OR isnan({col}))" if is_d else f"{col} IS NULL"
        items.append(f"{{'chk': 'no_nan', 'col': '{col}', 'n': CAST(sum(CASE WHEN {miss} THEN 1 ELSE 0 END) AS BIGINT), "
                     f"'d': '%d NaN values found'}}")
        if is_d:
            items.append(f"{{'chk': 'no_infinity', 'col': '{col}', 'n': CAST(sum(CASE WHEN isinf({col}) THEN 1 ELSE 0 END) AS BIGINT), "
                         f"'d': '%d infinite values found'}}")
    items.append("{'chk': 'rul_non_negative', 'col': 'rul', 'n': CAST(sum(CASE WHEN rul < 0 THEN 1 ELSE 0 END) AS BIGINT), "
                 "'d': 'Found %d negative RUL values'}")
    items.append("{'chk': 'rul_cap', 'col': 'rul', 'n': CAST(sum(CASE WHEN rul > 125 THEN 1 ELSE 0 END) AS BIGINT), "
                 "'d': 'Found %d RUL values > 125'}")
    return with_views(["fleet_events"], f"""
SELECT e.chk AS "check", e.col AS "column", e.n AS n, printf(e.d, e.n) AS detail FROM (
  SELECT unnest([{', '.join(items)}]) AS e FROM ({inj}) q) t
WHERE e.n > 0""")


# ---------------------------------------------------------------- V5 / K3
def _raw_sets(spark, sf):
    full = with_defects(fleet_full(spark, sf))
    train = full.filter(F.col(UNIT) % 5 != 0)
    test = full.filter(F.col(UNIT) % 5 == 0)
    return [("train", train), ("test", test)]


def _report(spark, sf):
    parts, errs = [], []
    for name, df in _raw_sets(spark, sf):
        v = va.raw_violations(df)
        parts.append(va.gate_report(name, "RawSensorSchema", df))
        errs.append(v.withColumn("dataset", F.lit(name)))
    return va.validation_report(parts), errs


@query("validation_report")
def q_validation_report(spark, sf):
    rep, _ = _report(spark, sf)
    return rep.withColumn("n_warnings", F.size("warnings")).drop("warnings")


SQL_REPORT_SETS = {
    "train": "SELECT * FROM full_defects WHERE unit_number % 5 <> 0",
    "test": "SELECT * FROM full_defects WHERE unit_number % 5 = 0",
}


def sql_report() -> tuple[list[tuple[str, str]], str]:
    ctes = []
    rows = []
    for name, body in SQL_REPORT_SETS.items():
        ctes.append((f"raw_{name}", body))
        ctes.append((f"viol_{name}", sql_violations(f"raw_{name}", va.RAW_RULES)))
        rows.append(f"""SELECT '{name}' AS dataset, 'RawSensorSchema' AS schema_name,
  (SELECT count(*) FROM viol_{name}) = 0 AS passed, (SELECT count(*) FROM raw_{name}) AS n_rows,
  26 AS n_columns, (SELECT count(*) FROM viol_{name}) AS error_count, 0 AS n_warnings""")
    body = "SELECT *, min(CAST(passed AS INTEGER)) OVER () = 1 AS overall_passed FROM (" + "\nUNION ALL\n".join(rows) + ")"
    return ctes, body


@oracle("validation_report")
def o_validation_report():
    ctes, body = sql_report()
    return with_views(["full_defects"], body, ctes)


@query("validation_missing_table")
def q_missing_table(spark, sf):
    """The gate over a table that is there and one that is not: the missing one is a failed dataset."""
    parts = [va.gate_report("suppliers", "KeySchema", files.table_or_none(spark, f"{sf}/supplier.parquet"), [va.Rule("not_nullable", "s_suppkey", "not_null")]),
             va.gate_report("engines", "RawSensorSchema", files.table_or_none(spark, f"{sf}/engines.parquet"))]
    return va.validation_report(parts).withColumn("warnings", F.array_join("warnings", "\n"))


@oracle("validation_missing_table")
def o_missing_table():
    return """
SELECT *, min(CAST(passed AS INTEGER)) OVER () = 1 AS overall_passed FROM (
  SELECT 'suppliers' AS dataset, 'KeySchema' AS schema_name, count(*) FILTER (s_suppkey IS NULL) = 0 AS passed, count(*) AS n_rows,
         (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE supplier)) AS n_columns, count(*) FILTER (s_suppkey IS NULL) AS error_count, '' AS warnings FROM supplier
  UNION ALL SELECT 'engines', 'RawSensorSchema', false, 0, 0, 1, 'dataset not found: engines')"""


@query("validation_errors")
def q_validation_errors(spark, sf):
    _, errs = _report(spark, sf)
    allv = errs[0].unionByName(errs[1])
    return rnd(va.first_errors(allv, [UNIT, CYCLE, "column", "check"]))


@oracle("validation_errors")
def o_validation_errors():
    ctes, _ = sql_report()
    body = """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY unit_number, time_cycles, "column", "check") AS INTEGER) AS error_rank
  FROM (SELECT *, 'train' AS dataset FROM viol_train UNION ALL SELECT *, 'test' AS dataset FROM viol_test))
WHERE error_rank <= 20"""
    return with_views(["full_defects"], sql_round(body, ["failure_value"]), ctes)


# ---------------------------------------------------------------- S6
@query("json_report_roundtrip")
def q_json_roundtrip(spark, sf):
    """The validation report written as JSON lines and read back with its schema."""
    rep, _ = _report(spark, sf)
    path = scratch_path(spark, "report-json")
    files.write_json(rep, path)
    back = files.read_json(spark, path, rep.schema)
    return back.withColumn("n_warnings", F.size("warnings")).drop("warnings")


@oracle("json_report_roundtrip")
def o_json_roundtrip():
    return o_validation_report()
