"""Tasks that hold fewer rows than a window or lag reaches back."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import features as fe
from cyclewise.operators.rolling import Groups


@pytest.mark.parametrize("n", range(1, 8))
def test_shift_by_more_rows_than_there_are(n):
    a = np.arange(n, dtype=float)
    for rows in range(1, 25):
        got = Groups(np.r_[True, np.zeros(n - 1, bool)]).shift(a, rows, np.nan)
        want = np.r_[np.full(min(rows, n), np.nan), a[: max(n - rows, 0)]]
        assert np.array_equal(got, want, equal_nan=True), (n, rows)


def test_last_rows_of_few_short_units(spark):
    """Requests of three readings each, dealt over many tasks: some task has two or three rows in all."""
    rows = [(u, t, float(10 * u + t)) for u in range(40) for t in range(1, 4)]
    df = spark.createDataFrame(rows, "unit_number int, time_cycles int, s_2 double")
    state = fe.fit_state(df, {"drop_sensors": []})
    got = {r["unit_number"]: r for r in fe.last_row_features(df, state).collect()}
    low, high = 1.0, 393.0
    for u in range(40):
        x = (np.array([10 * u + t for t in range(1, 4)]) - low) / (high - low)
        assert got[u]["s_2_roll_mean_5"] == pytest.approx(x.mean()) and got[u]["s_2_roll_std_20"] == pytest.approx(x.std(ddof=1))
        assert (got[u]["s_2_roll_min_10"], got[u]["s_2_roll_max_10"]) == pytest.approx((x[0], x[2]))
        assert got[u]["s_2_diff"] == pytest.approx(x[2] - x[1])
    alone = fe.transform(df.filter("unit_number = 7").coalesce(1), state, lag_fill=False).orderBy(F.desc("time_cycles")).first()
    assert alone["s_2_roll_mean_20"] == pytest.approx(got[7]["s_2_roll_mean_20"])


def test_stream_of_short_requests(spark, tmp_path):
    """A micro-batch may be one request of three readings."""
    from cyclewise.operators.model import LinearModel
    from cyclewise.streaming import streams
    from frames import plausible_frame

    pdf = plausible_frame(30, 3)
    df = spark.createDataFrame(pdf)
    state = fe.fit_state(df, with_lag_means=True)
    requests = df.withColumnRenamed("unit_number", "request_id").withColumn("pos", F.col("time_cycles"))
    requests.filter("request_id = 4").coalesce(1).write.parquet(f"{tmp_path}/in")
    model = LinearModel(["s_2_roll_mean_10"], [100.0], 0.0)
    out = streams.stream_score(spark, f"{tmp_path}/in", requests.schema, state, model, f"{tmp_path}/sink")
    got = {r["request_id"]: r["rul_prediction"] for r in out.collect()}
    low, high = pdf["s_2"].min(), pdf["s_2"].max()
    x = pdf.loc[pdf["unit_number"] == 4, "s_2"]
    assert got == {4: pytest.approx(100.0 * ((x - low) / (high - low)).mean(), abs=0.0051)}
