"""Queries over events without a value, a time or a user, against their SQL."""

import os

import duckdb
import pytest
from test_zero_prices import same


@pytest.fixture(scope="module")
def holes(sf, tmp_path_factory):
    """The smallest tables; some events have no value (the last one of a day, too), others no time or no user."""
    to = tmp_path_factory.mktemp("holes")
    for f in os.listdir(sf):
        if not f.startswith("events"):
            os.symlink(f"{sf}/{f}", to / f)
    less = "CASE WHEN event_id % 4 = 1 THEN NULL ELSE value END AS value, CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS ts, CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id"
    duckdb.execute(f"COPY (SELECT * REPLACE ({less}) FROM '{sf}/events.parquet') TO '{to}/events.parquet' (FORMAT parquet)")
    return str(to)


def test_j18_without_values(spark, holes):
    same(spark, "j18_value_fingerprint", holes)


def test_w32_without_times(spark, holes):
    same(spark, "w32_growth", holes)
