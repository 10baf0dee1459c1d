"""Shared fixtures: one local session, small seeded sensor tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from frames import sensor_frame  # noqa: E402

from cyclewise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 8, app="cyclewise-tests")
    yield s


@pytest.fixture(scope="session")
def sensors_pd():
    return sensor_frame()


@pytest.fixture(scope="session")
def sensors(spark, sensors_pd):
    return spark.createDataFrame(sensors_pd).repartition(3)
