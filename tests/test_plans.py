"""Plan-shape tests: the scale properties the builders are designed for."""

import datetime as dt
import os
from decimal import Decimal

import pytest

import __spark_entry__ as E
from contrail.plans import silver
from contrail.registry import REGISTRY

from .conftest import SF001

STREAMING = {"stream_user_events", "stream_flights", "stream_quarantine", "stream_dedup"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - STREAMING))
def test_no_cartesian_or_nested_loop_and_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_flagship_trims_groups_before_shuffle_and_aggregates_partially(spark):
    p = plan(E.entry(spark))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "partial_avg" in p and "partial_min" in p and "partial_max" in p


def test_boarding_filter_and_columns_reach_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "boarding")
    spark.createDataFrame(
        [("e1", "f1", "passenger_scanned", "p1", Decimal("5.00"), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "event_id string, flight_id string, event_type string, passenger_id string, baggage_weight decimal(10,2), "
        "event_time timestamp, ingestion_time timestamp").write.parquet(path)
    p = plan(silver.build_boarding_summary(spark.read.parquet(path), audit=False))
    assert "EqualTo(event_type,passenger_scanned)" in p  # pushed to parquet
    assert "passenger_id" not in p.split("ReadSchema:")[1].split("\n")[0]  # pruned


def test_most_popular_reads_the_join_once(spark):
    p = plan(E.queries()["monthly_most_popular"](spark, SF001))
    assert "Expand" in p  # one grouping-sets pass ranks all three labels
    assert p.count("FileScan parquet") <= 5


def _join_columns(df) -> list[set[str]]:
    """Columns that every join of the optimized plan puts out."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Join":
            out = node.output()
            found.append({out.apply(i).name() for i in range(out.size())})
        below = node.children()
        todo += [below.apply(i) for i in range(below.size())]
    return found


@pytest.mark.parametrize("name", ["silver_weather_summary_from_samples", "silver_flight_weather"])
def test_flights_meet_no_waypoints_one_by_one(spark, name):
    joins = _join_columns(E.queries()[name](spark, SF001))
    bridge = [c for c in joins if c & {"_lat", "point_latitude"} and c & {"flight_id", "silver_flight_id", "o_orderkey"}]
    assert joins and not bridge  # flights are reduced to their routes and dates first
