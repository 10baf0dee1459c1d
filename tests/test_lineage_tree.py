import pytest
from pyspark.sql import functions as F

from cyclewise.functions import lineage as lg
from cyclewise.operators import drift as dr
from cyclewise.plans import jobs
from cyclewise.session import cut_lineage, scratch_path

from frames import plausible_frame


def table(spark, n=400):
    return spark.range(n).select((F.col("id") % 4).cast("int").alias("grp"), F.col("id"), F.concat(F.lit("v"), F.col("id")).alias("v"))


def test_tree_root_is_the_table_and_only_new_files_are_read(spark):
    path = scratch_path(spark, "tree")
    table(spark).repartition(3).write.partitionBy("grp").parquet(path)
    leaves = cut_lineage(lg.file_fingerprints(spark, path), "leaves")
    root = lg.fingerprint_tree(leaves).filter("depth = 0").first()
    whole = lg.table_fingerprint(spark.read.parquet(path)).first()
    assert (root.n_rows, root.checksum, root.fingerprint) == tuple(whole)
    assert lg.file_fingerprints(spark, path, leaves).exceptAll(leaves).count() == 0
    # what is known is not read again: false figures of a known file stay
    lied = leaves.withColumn("checksum", F.lit(0).cast("long"))
    spark.createDataFrame([(1000, "new")], "id long, v string").withColumn("grp", F.lit(9)).write.mode("append").partitionBy("grp").parquet(path)
    again = lg.file_fingerprints(spark, path, lied).filter("checksum <> 0").collect()
    assert [r.file.split("/")[0] for r in again] == ["grp=9"]
    assert lg.changed_parts(lg.fingerprint_tree(leaves), lg.fingerprint_tree(lg.file_fingerprints(spark, path))).collect() == [("grp=9", "added", None, 1)]


def test_rewritten_files_do_not_count_but_values_do(spark):
    a, b, c = (scratch_path(spark, f"tree-{x}") for x in "abc")
    table(spark).repartition(3).write.partitionBy("grp").parquet(a)
    table(spark).repartition(5).orderBy(F.col("id").desc()).write.partitionBy("grp").parquet(b)
    table(spark).filter("grp <> 1").withColumn("v", F.when(F.col("id") == 7, "other").otherwise(F.col("v"))).write.partitionBy("grp").parquet(c)
    trees = [lg.fingerprint_tree(lg.file_fingerprints(spark, p)) for p in (a, b, c)]
    assert lg.changed_parts(trees[0], trees[1]).count() == 0
    assert sorted(tuple(r) for r in lg.changed_parts(trees[0], trees[2]).collect()) == [("grp=1", "removed", 100, None), ("grp=3", "changed", 100, 100)]


def test_training_job_writes_its_audit_row(spark):
    train = spark.createDataFrame(plausible_frame(5, 30))
    truth = spark.createDataFrame([(u, 10) for u in range(1, 6)], "unit_number int, rul int")
    path = scratch_path(spark, "audit")
    cfg = {"rolling_window_sizes": [5], "lag_steps": [1]}
    row, _, state = jobs.train_evaluate(train, train, truth, cfg, {"type": "ridge"}, folds=2, audit_path=path)
    assert row.first()["warnings"] == [] and len(state.feature_columns) >= 30
    with pytest.raises(ValueError, match="validation failed"):
        jobs.train_evaluate(train.withColumn("s_2", F.lit(1e9)), train, truth, cfg, {"type": "ridge"}, folds=2, audit_path=path)
    log = lg.read_audit(spark, path).orderBy("logged_at").collect()
    assert [r["validation_passed"] for r in log].count(True) == 1 and len(log) == 2
    assert len({r["data_hash"] for r in log}) == 2 and all(len(r["logged_at"]) == 15 for r in log)
    few = jobs.train_evaluate(train.select("unit_number", "time_cycles", *[c for c in train.columns if c.startswith("setting")], *[f"s_{i}" for i in range(1, 22)]),
                              train, truth, {"rolling_window_sizes": [], "lag_steps": []}, {"type": "ridge"}, folds=2)[0].first()
    assert len(few["warnings"]) in (0, 1)


def test_exact_ks_p_against_all_walks():
    from itertools import combinations

    for n, m in ((1, 1), (3, 4), (5, 5), (2, 7), (6, 4)):
        walks = []
        for picked in combinations(range(n + m), n):
            i = j = 0
            far = 0.0
            for s in range(n + m):
                i, j = (i + 1, j) if s in picked else (i, j + 1)
                far = max(far, abs(i / n - j / m))
            walks.append(far)
        for d in sorted(set(walks)):
            assert dr.exact_ks_p(d, n, m) == pytest.approx(sum(w >= d - 1e-12 for w in walks) / len(walks), abs=1e-12)
    assert dr.exact_ks_p(1.0, 300, 300) < 1e-100 and dr.exact_ks_p(0.0, 50, 20) == 1.0
