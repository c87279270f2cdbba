"""Monthly marts from partials: equal to a full rebuild after any loads, and only changed months are read and written."""

import datetime as dt
import os
import random

import pytest

from contrail import schema
from contrail.plans import gold, partials, silver
from contrail.sources.layout import Layout, read_table

FLIGHT = "flight_id string, routes_id string, flight_date date, scheduled_departure timestamp"
EVENT = "flight_event_id string, flight_id string, event_type string, event_time timestamp, delay_reason string"
BOOKING = "booked_ticket_id string, flight_id string, booking_date date, order_method string"
ROUTE = "routes_id string, airport_origin string, airport_destination string"


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def flights(spark, n=40):
    at = [dt.datetime(2023, 1, 1) + dt.timedelta(days=9 * i, hours=i % 5) for i in range(n)]
    return spark.createDataFrame([(f"f{i}", f"r{i % 4}", None if i == 7 else t.date(), t) for i, t in enumerate(at)], FLIGHT)


def events(seed, n, first=0):
    r, out = random.Random(seed), []
    for i in range(n):
        f = r.choice([0, 0, 0, *range(45)])  # flight 0 is hot, some flights are unknown
        at = dt.datetime(2023, 1, 1) + dt.timedelta(days=9 * f, hours=f % 5, seconds=r.randint(-4000, 9000))
        out.append((f"e{first + i:05d}", f"f{f}", r.choice([schema.DEPARTURE_EVENT, "landing"]), r.choice([at, at, None]),
                    r.choice([None, "fog", "strike", "crew"])))
    return out


def as_rows(df):
    return sorted(str([None if v is None else round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))])
                  for r in df.collect())


def full(flights, events):
    return gold.build_monthly_delays(flights, events, silver.build_delay_reasons(events, flights, audit=False), audit=False)


def test_delays_equal_a_full_rebuild_after_every_load(spark, layout):
    f, seen = flights(spark), []
    for load, rows in (("a", events(1, 300)), ("b", events(2, 40, 300)), ("empty", []), ("late", events(3, 5, 340))):
        seen += rows
        df = spark.createDataFrame(rows, EVENT)
        for _ in range(2 if load in ("b", "late") else 1):  # the load runs again: nothing counts twice
            partials.add_delays(spark, layout, load, df, f, audit=False)
        want = full(f, spark.createDataFrame(seen, EVENT))
        assert as_rows(read_table(spark, layout, "gold", "gold_dim_monthly_delays")) == as_rows(want)


def test_nothing_loaded_yet(spark, layout):
    assert partials.add_delays(spark, layout, "none", spark.createDataFrame([], EVENT), flights(spark)) == []
    assert partials.read_state(spark, layout, partials.DELAYS) is None


def test_a_load_reads_and_writes_its_months_alone(spark, layout):
    f = flights(spark)
    partials.add_delays(spark, layout, "a", spark.createDataFrame(events(1, 300), EVENT), f, audit=False)
    mart = os.path.join(layout.path("gold", "gold_dim_monthly_delays"))

    def files():
        return {d: sorted(n for n in names if n.endswith(".parquet")) for d, _, names in os.walk(mart) if "month=" in d}

    before = files()
    one = spark.createDataFrame([("x1", "f1", schema.DEPARTURE_EVENT, dt.datetime(2023, 1, 10, 3), "fog"), ("x2", "f7", "landing", None, "fog")], EVENT)
    months = partials.add_delays(spark, layout, "b", one, f, audit=False)
    assert sorted(months, key=str) == [(2023, 1), (None, None)]
    after = files()
    assert {os.path.relpath(d, mart) for d in after if after[d] != before.get(d)} == {
        "year=2023/month=1", "year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__"}
    pruned = partials.read_state(spark, layout, partials.DELAYS, months)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [coalesce" in plan
    assert {(r.year, r.month) for r in pruned.select("year", "month").distinct().collect()} == {(2023, 1), (None, None)}


def test_most_popular_equals_a_full_rebuild(spark, layout):
    r, f, seen = random.Random(5), flights(spark), []
    routes = spark.createDataFrame([(f"r{i}", f"o{i % 2}", None if i == 3 else f"d{i}") for i in range(4)], ROUTE)
    for n, size in enumerate((200, 30, 4)):
        rows = [(f"b{n}-{i}", f"f{r.choice([0, 0, *range(45)])}", r.choice([None, *(dt.date(2023, m, 3) for m in range(1, 13))]),
                 r.choice(["online", "desk", None])) for i in range(size)]
        seen += rows
        for _ in range(2 if n == 1 else 1):
            partials.add_bookings(spark, layout, str(n), spark.createDataFrame(rows, BOOKING), f, routes, audit=False)
        want = gold.build_monthly_most_popular(spark.createDataFrame(seen, BOOKING), f, routes, key="flight", method="column", audit=False)
        assert as_rows(read_table(spark, layout, "gold", "gold_dim_monthly_most_popular")) == as_rows(want)
