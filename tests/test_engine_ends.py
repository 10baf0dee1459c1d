"""An engine's last cycle comes with the fleet views: rows are not shuffled again for it."""

import datetime as dt

import pytest

from cyclewise.plans import q_drift as qd
from cyclewise.sources import views

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Suppliers of 1, 2, 9 and 40 lines, repeated lines, lines without a supplier or a date; users likewise."""
    out = tmp_path_factory.mktemp("sf")
    keys = [(u, i) for u, n in ((0, 1), (1, 2), (5, 9), (7, 40), (None, 6)) for i in range(n)]
    lines = [(u, None if i % 11 == 10 else DAY + dt.timedelta(days=37 * i), i, 1, 3 * i, 1.0 + i % 50, 900.0 + 7 * i, 0.01 * (i % 10), 0.02) for u, i in keys]
    kinds = "l_suppkey long, l_shipdate timestamp, l_orderkey long, l_linenumber int, l_partkey long"
    kinds += ", l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(lines + lines[3:8], kinds).write.parquet(f"{out}/lineitem.parquet")
    events = [(u, DAY + dt.timedelta(days=i), i, 10.0 * i, f'{{"k": {i}}}') for u, i in keys]
    spark.createDataFrame(events + events[3:8], "user_id long, ts timestamp, event_id long, value double, props string").write.parquet(f"{out}/events.parquet")
    return str(out)


def rows(df):
    return sorted(df.collect(), key=str)


def test_sides_and_holdout_join_nothing(spark, folder):
    for view in (views.fleet_lineitem, views.fleet_events, views.fleet_full):
        plain, ended = view(spark, folder), view(spark, folder, ends=True)
        assert "max_cycle" not in plain.columns
        for split in (views.reference_current, views.holdout_split):
            for old, new in zip(split(plain), split(ended), strict=True):
                assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString()
                assert new.columns == old.columns and rows(new) == rows(old)
        assert rows(ended.drop("max_cycle")) == rows(plain)


def test_scored_sides_join_nothing(spark, folder):
    for sides in (qd._scaled_sides, qd.li_sides, qd.ev_sides):
        for side in sides(spark, folder):
            assert "Join" not in side._jdf.queryExecution().optimizedPlan().toString()
            assert side.count()
