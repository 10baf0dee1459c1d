"""Results must not depend on partitioning; streams must equal their batch form."""

import pandas as pd
from pyspark.sql import functions as F

from cyclewise.config import SENSORS, SETTINGS
from cyclewise.operators import drift as dr
from cyclewise.operators import features as fe
from cyclewise.operators import model as md
from cyclewise.operators import scoring as sc
from cyclewise.session import scratch_path
from cyclewise.streaming import streams

from frames import plausible_frame, sensor_frame


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_partition_count_invariance(spark):
    pdf = sensor_frame((40, 25, 33))
    order = ["unit_number", "time_cycles"]
    results = []
    for parts in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        df = spark.createDataFrame(pdf).repartition(parts)
        w = fe.window_features(df.select("unit_number", "time_cycles", "s_2"), ["s_2"], [5, 10], [1, 3])
        results.append((
            _rows(w, order),
            _rows(dr.half_split(df).select("unit_number", "time_cycles", "side"), order),
            _rows(md.kfold_contiguous(df, 5).select("unit_number", "time_cycles", "fold"), order),
            _rows(md.group_kfold(df, 3), ["unit_number"]),
        ))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def _requests(n_req=6, n=12):
    pdf = plausible_frame(n_engines=n_req, n_cycles=n).rename(columns={"unit_number": "request_id"})
    pdf.insert(1, "pos", pdf["time_cycles"])
    pdf = pdf[(pdf["request_id"] != 2) | (pdf["time_cycles"] <= 3)].copy()  # a short request
    pdf["split"] = pdf["request_id"] % 3
    return pdf


def test_stream_score_equals_batch(spark):
    pdf = _requests()
    rows = spark.createDataFrame(pdf)
    state = fe.fit_state(spark.createDataFrame(plausible_frame(3, 30)))
    model = md.LinearModel(["s_3", "s_2"], [-40.0, 10.0], 60.0)
    batch = sc.score_requests(rows.drop("split"), state, model)
    src = scratch_path(spark, "test-stream-src")
    rows.repartition("request_id").write.partitionBy("split").parquet(src)
    schema = ("request_id long, pos long, time_cycles long, " + ", ".join(f"{c} double" for c in SETTINGS + SENSORS)
              + ", split int")
    sink, mark = scratch_path(spark, "test-stream-sink"), scratch_path(spark, "test-stream-mark")
    out = streams.stream_score(spark, src, schema, state, model, sink, checkpoint=mark)
    before = out.count()
    out = streams.stream_score(spark, src, schema, state, model, sink, checkpoint=mark)  # started again: nothing new
    assert out.count() == before
    out = streams.stream_score(spark, src, schema, state, model, sink)  # played again from the start: replaced, not added
    assert out.count() == before
    got = sorted((r["request_id"], r["rul_prediction"], r["input_cycles"], tuple(r["warnings"])) for r in out.collect())
    want = sorted((r["request_id"], r["rul_prediction"], r["input_cycles"], tuple(r["warnings"])) for r in batch.collect())
    assert got == want and len(got) == 6
    short = [g for g in got if g[0] == 2][0]
    assert short[2] == 3 and any("Fewer than 5 cycles" in w for w in short[3])


def test_request_order_check(spark):
    pdf = _requests()
    swap = (pdf["request_id"] == 4) & pdf["time_cycles"].isin([2, 3])
    pdf.loc[swap, "pos"] = pdf.loc[swap, "pos"].map({2: 3, 3: 2})
    chk = {r["request_id"]: r for r in sc.request_checks(spark.createDataFrame(pdf)).collect()}
    assert not chk[4]["ordered"] and not chk[4]["accept_predict"]
    assert chk[1]["ordered"] and chk[1]["accept_drift"] and not chk[1]["warn_short"]
    assert chk[2]["warn_short"] and not chk[2]["accept_drift"]


def test_request_order_check_across_segments(spark):
    # segment_rows=8: positions 1-8 and 9-16 are different segments; request 2 drops
    # from cycle 12 (pos 8) to cycle 9 (pos 9), i.e. exactly across the boundary
    rows = [(1, p, p) for p in range(1, 21)] + [(2, p, 12 if p == 8 else p) for p in range(1, 21)]
    df = spark.createDataFrame(rows, "request_id int, pos int, time_cycles int")
    chk = {r["request_id"]: r["ordered"] for r in sc.request_checks(df, segment_rows=8).collect()}
    assert chk == {1: True, 2: False}
    ties = [(4, p, c) for p, c in enumerate([5, 6, 6, 7, 8], start=1)] + [(5, p, 20 - p) for p in range(1, 12)]
    chk = {r["request_id"]: r for r in sc.request_checks(spark.createDataFrame(ties, df.schema)).collect()}
    assert chk[4]["accept_predict"] and not chk[5]["accept_predict"] and chk[5]["accept_drift"]
    inside = [(3, p, 5 if p == 11 else p) for p in range(1, 21)]  # drop inside the second segment
    chk = {r["request_id"]: r["ordered"] for r in sc.request_checks(spark.createDataFrame(inside, df.schema), segment_rows=8).collect()}
    assert chk == {3: False}
