from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagetrail.session import configure  # noqa: E402
from pagetrail.sources.schema import EVENTS, ITEM  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
T0 = 1_704_153_600_000_000  # 2024-01-02 00:00 UTC
SECOND = 1_000_000
MINUTE = 60 * SECOND


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return configure(session)


def param(key, text=None, number=None, real=None, double=None):
    return (key, (text, number, real, double))


def item(item_id, price=None, quantity=None, **more):
    given = {"item_id": item_id, "price": price, "quantity": quantity, **more}
    return tuple(given.get(name) for name in ITEM.names)


@pytest.fixture(scope="session")
def export(spark):
    """Export rows from tuples (user, micros after T0, event name, parameters, items, date)."""

    def make(*rows):
        def day(micros):
            return "20240101" if micros < 0 else f"2024010{2 + micros // (1440 * MINUTE)}"

        full = []
        for row in rows:
            user, at, name, params, items, date = (*row, *[None] * (6 - len(row)))
            if isinstance(params, dict):
                params = [param(k, v) for k, v in params.items()]
            full.append((date or day(at), T0 + at, name, user, params, items))
        return spark.createDataFrame(full, EVENTS)

    return make
