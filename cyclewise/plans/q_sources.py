"""Queries for sources and sinks: text parsing, truth file, summaries, integrity, file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.config import CYCLE, RAW_COLUMNS, TARGET, UNIT
from cyclewise.plans.registry import oracle, query, rnd, sql_round
from cyclewise.session import scratch_path
from cyclewise.sources import files, text
from cyclewise.sources.views import (
    fleet_full,
    fleet_lineitem,
    holdout_split,
    request_bodies,
    with_defects,
    with_views,
)

DOUBLES = [c for c in RAW_COLUMNS if c not in (UNIT, CYCLE)]


# ---------------------------------------------------------------- S1
@query("parse_sensor_lines")
def q_parse(spark, sf):
    """The defect fixture written as blank-separated text (NULL as ``nan``), parsed back."""
    path = scratch_path(spark, "sensor-text")
    text.sensor_text(with_defects(fleet_full(spark, sf))).write.text(path)
    return rnd(text.parse_sensor_lines(spark, path))


@oracle("parse_sensor_lines")
def o_parse():
    return with_views(["full_defects"], sql_round("SELECT * FROM full_defects", DOUBLES))


# ---------------------------------------------------------------- S3 / S2
def _truth_file(spark, sf) -> str:
    """Hold-out truth written one value per line in engine order (the truth file's layout)."""
    _, truth = holdout_split(fleet_lineitem(spark, sf, ends=True))
    path = scratch_path(spark, "truth-text")
    truth.orderBy(UNIT).select(F.concat(F.col(TARGET).cast("string"), F.lit(" ")).alias("value")).write.text(path)
    return path


@query("truth_with_key")
def q_truth_key(spark, sf):
    return text.read_truth(spark, _truth_file(spark, sf))


@oracle("truth_with_key")
def o_truth_key():
    return with_views(["li_truth"], """
SELECT CAST(row_number() OVER (ORDER BY unit_number) AS INTEGER) AS unit_number, rul FROM li_truth""")


@query("truth_count_check")
def q_truth_count(spark, sf):
    series, _ = holdout_split(fleet_lineitem(spark, sf, ends=True))
    return text.truth_count_check(series, text.read_truth(spark, _truth_file(spark, sf)))


@oracle("truth_count_check")
def o_truth_count():
    return with_views(["li_hold", "li_truth"], """
SELECT n_engines, n_truth, n_engines = n_truth AS consistent FROM
  (SELECT count(DISTINCT unit_number) AS n_engines FROM li_hold),
  (SELECT count(*) AS n_truth FROM li_truth)""")


# ---------------------------------------------------------------- S8 / A1
@query("load_summary")
def q_load_summary(spark, sf):
    _, truth = holdout_split(fleet_lineitem(spark, sf, ends=True))
    return text.load_summary(fleet_lineitem(spark, sf), truth)


@oracle("load_summary")
def o_load_summary():
    return with_views(["fleet_lineitem", "li_truth"], """
SELECT n_rows, n_engines, max_cycle, rul_min, rul_max FROM
  (SELECT count(*) AS n_rows, count(DISTINCT unit_number) AS n_engines, max(time_cycles) AS max_cycle FROM fleet_lineitem),
  (SELECT min(rul) AS rul_min, max(rul) AS rul_max FROM li_truth)""")


# ---------------------------------------------------------------- P6
@query("raw_integrity")
def q_raw_integrity(spark, sf):
    return text.raw_integrity(with_defects(fleet_full(spark, sf)))


@oracle("raw_integrity")
def o_raw_integrity():
    miss = " OR ".join(
        f"{c} IS NULL" if c in (UNIT, CYCLE) else f"({c} IS NULL OR isnan({c}))" for c in RAW_COLUMNS
    )
    return with_views(["full_defects"], f"""
SELECT {len(RAW_COLUMNS)} AS n_columns, n_rows, n_missing_rows, n_bad_unit, n_bad_cycle,
       n_missing_rows = 0 AND n_bad_unit = 0 AND n_bad_cycle = 0 AS passed
FROM (SELECT count(*) AS n_rows,
             CAST(coalesce(sum(CASE WHEN {miss} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_missing_rows,
             CAST(coalesce(sum(CASE WHEN unit_number < 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad_unit,
             CAST(coalesce(sum(CASE WHEN time_cycles < 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad_cycle
      FROM full_defects)""")


# ---------------------------------------------------------------- S4
@query("parquet_roundtrip")
def q_parquet(spark, sf):
    path = scratch_path(spark, "parquet")
    files.write_parquet(fleet_full(spark, sf), path)
    return rnd(files.read_parquet(spark, path))


@oracle("parquet_roundtrip")
def o_parquet():
    return with_views(["fleet_full"], sql_round("SELECT * FROM fleet_full", DOUBLES))


# ---------------------------------------------------------------- S5
@query("csv_roundtrip")
def q_csv(spark, sf):
    _, truth = holdout_split(fleet_lineitem(spark, sf, ends=True))
    path = scratch_path(spark, "csv")
    files.write_csv(truth, path)
    return files.read_csv(spark, path, "unit_number int, rul int")


@oracle("csv_roundtrip")
def o_csv():
    return with_views(["li_truth"], "SELECT unit_number, rul FROM li_truth")


# ---------------------------------------------------------------- S7
@query("request_parse")
def q_request_parse(spark, sf):
    return rnd(files.parse_requests(request_bodies(spark, sf)))


@oracle("request_parse")
def o_request_parse():
    return with_views(["request_rows"], sql_round("SELECT * FROM request_rows", DOUBLES))


@query("request_reject")
def q_request_reject(spark, sf):
    """Bodies in which every 5th request has a field taken away, every 6th one turned to text and every 9th is no object."""
    bodies = request_bodies(spark, sf)
    rid = F.col("request_id")
    broken = (
        F.when(rid % 9 == 0, F.lit("[1, 2]"))
        .when(rid % 5 == 0, F.regexp_replace("body", '"s_4":[^,}]*,', ""))
        .when(rid % 6 == 0, F.regexp_replace("body", '"s_2":[^,}]*', '"s_2":"n/a"'))
        .otherwise(F.col("body"))
    )
    return files.request_verdicts(bodies.withColumn("body", broken))


@oracle("request_reject")
def o_request_reject():
    return with_views(["request_rows"], """
SELECT request_id, request_id % 9 <> 0 AS well_formed,
       CASE WHEN request_id % 9 = 0 THEN 0 ELSE count(*) END AS n_readings,
       CASE WHEN request_id % 9 <> 0 AND (request_id % 5 = 0 OR request_id % 6 = 0) THEN count(*) ELSE 0 END AS n_bad_readings,
       request_id % 9 <> 0 AND request_id % 5 <> 0 AND request_id % 6 <> 0 AS accepted
FROM request_rows GROUP BY request_id""")
