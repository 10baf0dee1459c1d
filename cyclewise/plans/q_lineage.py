"""Queries for lineage: table fingerprint, struct flattening, audit row."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.config import CYCLE, RAW_COLUMNS, UNIT
from cyclewise.functions import lineage as lg
from cyclewise.operators import validate as va
from cyclewise.plans.registry import oracle, query
from cyclewise.plans.q_validate import sql_violations
from cyclewise.session import scratch_path
from cyclewise.sources.views import fleet_full, fleet_lineitem, table, train_split, with_views


def sql_fingerprint(src: str, cols: list[str], doubles: set[str]) -> str:
    canon = ", ".join(
        f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '~')"
        for t in (f"CAST(CAST(round({c} * 10000.0) AS BIGINT) AS VARCHAR)" if c in doubles else f"CAST({c} AS VARCHAR)" for c in cols)
    )
    return f"""
SELECT n_rows, checksum, substr(sha256(CAST(checksum AS VARCHAR) || ':' || CAST(n_rows AS VARCHAR)), 1, 12) AS fingerprint FROM (
  SELECT count(*) AS n_rows, CAST(coalesce(sum(('0x' || substr(md5(concat_ws('|', {canon})), 1, 8))::BIGINT), 0) AS BIGINT) AS checksum
  FROM ({src}))"""


#: Digits that the engines' fingerprints share.
DIGITS = 4
DOUBLES = {c for c in RAW_COLUMNS if c not in (UNIT, CYCLE)}


# ---------------------------------------------------------------- G1
@query("table_fingerprint")
def q_fingerprint(spark, sf):
    return lg.table_fingerprint(fleet_full(spark, sf), digits=DIGITS)


@oracle("table_fingerprint")
def o_fingerprint():
    return with_views(["fleet_full"], sql_fingerprint("SELECT * FROM fleet_full", RAW_COLUMNS, DOUBLES))


# ---------------------------------------------------------------- G2
@query("flatten_struct")
def q_flatten(spark, sf):
    """Per-engine run record nested as ``{unit, stats: {rows, max_cycle, quantity: {min, max}}, params: {windows}}``."""
    eng = fleet_lineitem(spark, sf).groupBy(UNIT).agg(
        F.count(F.lit(1)).alias("rows"), F.max(CYCLE).alias("max_cycle"),
        F.min("s_2").alias("qmin"), F.max("s_2").alias("qmax"),
    )
    nested = eng.select(
        UNIT,
        F.struct("rows", "max_cycle", F.struct(F.col("qmin").alias("min"), F.col("qmax").alias("max")).alias("quantity")).alias("stats"),
        F.struct(F.array(F.lit(5), F.lit(10), F.lit(20)).alias("windows"), F.lit("gbt").alias("type")).alias("params"),
    )
    return lg.flatten_struct(nested)


@oracle("flatten_struct")
def o_flatten():
    return with_views(["fleet_lineitem"], """
SELECT unit_number, count(*) AS "stats.rows", max(time_cycles) AS "stats.max_cycle",
       min(s_2) AS "stats.quantity.min", max(s_2) AS "stats.quantity.max",
       '[5, 10, 20]' AS "params.windows", 'gbt' AS "params.type"
FROM fleet_lineitem GROUP BY unit_number""")


# ---------------------------------------------------------------- G3
@query("audit_row")
def q_audit(spark, sf):
    train = train_split(fleet_full(spark, sf))
    rep = va.dataset_report("train", "RawSensorSchema", train, va.raw_violations(train))
    return lg.audit_row(train, rep, "train_raw", digits=DIGITS)


@oracle("audit_row")
def o_audit():
    fp = sql_fingerprint("SELECT * FROM full_train", RAW_COLUMNS, DOUBLES)
    viol = sql_violations("full_train", va.RAW_RULES)
    return with_views(["full_train"], f"""
SELECT 'train_raw' AS dataset, fingerprint AS data_hash, n_rows, {len(RAW_COLUMNS)} AS n_columns,
       (SELECT count(*) FROM ({viol})) = 0 AS validation_passed
FROM ({fp})""")


# ---------------------------------------------------------------- G1, exact form
EXACT_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]


@query("table_fingerprint_exact")
def q_fingerprint_exact(spark, sf):
    """Integer and text columns, whose canonical text another engine shares without rounding."""
    return lg.table_fingerprint(table(spark, sf, "lineitem").select(*EXACT_COLUMNS))


@oracle("table_fingerprint_exact")
def o_fingerprint_exact():
    return sql_fingerprint("SELECT * FROM lineitem", EXACT_COLUMNS, set())


# ---------------------------------------------------------------- G1, tree over two versions
def _version(spark, sf, second: bool) -> str:
    """The integer columns of lineitem by ``grp = l_suppkey % 8``; the second version has other rows in group 3, none in
    group 6 and a group 9."""
    rows = table(spark, sf, "lineitem").select(*EXACT_COLUMNS[:4], F.pmod("l_suppkey", F.lit(8)).cast("int").alias("grp"))
    if second:
        rows = rows.filter("grp <> 6").withColumn("l_partkey", F.when((F.col("grp") == 3) & (F.col("l_linenumber") == 7), F.lit(0)).otherwise(F.col("l_partkey")))
        rows = rows.withColumn("grp", F.when((F.col("grp") == 1) & (F.col("l_linenumber") == 1), F.lit(9)).otherwise(F.col("grp")))
    path = scratch_path(spark, "versions")
    rows.write.partitionBy("grp").parquet(path)
    return path


@query("fingerprint_changes")
def q_changes(spark, sf):
    """The partitions that differ between two versions of a table, by their fingerprint trees."""
    trees = [lg.fingerprint_tree(lg.file_fingerprints(spark, _version(spark, sf, second))) for second in (False, True)]
    return lg.changed_parts(*trees)


@oracle("fingerprint_changes")
def o_changes():
    return """
WITH a AS (SELECT l_suppkey % 8 AS g, * FROM lineitem),
b AS (SELECT CASE WHEN g = 1 AND l_linenumber = 1 THEN 9 ELSE g END AS g, l_orderkey,
             CASE WHEN g = 3 AND l_linenumber = 7 THEN 0 ELSE l_partkey END AS l_partkey, l_suppkey, l_linenumber FROM a WHERE g <> 6),
x AS (SELECT g, count(*) AS n, sum(hash(l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS h FROM a GROUP BY g),
y AS (SELECT g, count(*) AS n, sum(hash(l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS h FROM b GROUP BY g)
SELECT 'grp=' || coalesce(x.g, y.g) AS part, CASE WHEN x.g IS NULL THEN 'added' WHEN y.g IS NULL THEN 'removed' ELSE 'changed' END AS change,
       x.n AS rows_before, y.n AS rows_after
FROM x FULL JOIN y ON x.g = y.g WHERE x.h IS DISTINCT FROM y.h"""


# ---------------------------------------------------------------- G3, the log
@query("audit_log")
def q_audit_log(spark, sf):
    """Two records appended to an audit log and read back: the table with its gate's result, then its training part."""
    path, full = scratch_path(spark, "audit-log"), fleet_full(spark, sf)
    for name, rows in (("all", full), ("train", train_split(full))):
        report = va.gate_report(name, "RawSensorSchema", rows)
        lg.append_audit(lg.audit_row(rows, report, name, with_time=True, digits=DIGITS), path)
    log = lg.read_audit(spark, path)
    return log.withColumn("timed", F.col("logged_at").rlike("^[0-9]{8}-[0-9]{6}$")).drop("logged_at")


@oracle("audit_log")
def o_audit_log():
    one = lambda name, src: f"""
SELECT '{name}' AS dataset, fingerprint AS data_hash, n_rows, CAST({len(RAW_COLUMNS)} AS INTEGER) AS n_columns,
       (SELECT count(*) FROM ({sql_violations(src, va.RAW_RULES)})) = 0 AS validation_passed, true AS timed
FROM ({sql_fingerprint(f'SELECT * FROM {src}', RAW_COLUMNS, DOUBLES)})"""  # noqa: E731
    return with_views(["fleet_full", "full_train"], one("all", "fleet_full") + "\nUNION ALL" + one("train", "full_train"))
