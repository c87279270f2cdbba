"""The as-of join against a search per row, with hot keys that span partitions."""

import datetime as dt
import random

import pytest

from contrail.operators import asof_join
from contrail.plans import gold


@pytest.mark.parametrize("seed", range(4))
def test_against_a_search_per_row(spark, seed):
    r = random.Random(seed)
    hot = ["a"] * 6 + ["b", "c", None, "d\x00", ""]
    left = [(i, r.choice(hot), r.choice(["x", "x", "y", None]), r.choice([None, *range(60)])) for i in range(600)] + [(7, "a", "x", 30)] * 300
    right = {}
    for i in range(120):
        right[(r.choice(hot), r.choice(["x", "y", None]), r.choice([None, *range(60)]))] = i
    rows = [(k, c, t, v) for (k, c, t), v in right.items()]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # eight ranges: the hot key spans several
    try:
        got = asof_join(spark.createDataFrame(left, "id int, k string, c string, t int"), spark.createDataFrame(rows, "k string, c string, began int, v int"),
                        ["k", "c"], "t", "began")
        assert got.columns == ["id", "k", "c", "t", "match"]
        got = sorted((str((g.id, g.k, g.c, g.t)), g.match.v if g.match else None) for g in got.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)

    def search(k, c, t):
        found = [(b, v) for (x, y, b), v in right.items() if None not in (k, c, t, b) and (x, y) == (k, c) and b <= t]
        return max(found)[1] if found else None

    assert got == sorted((str(row), search(*row[1:])) for row in left)


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", 3)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 2, 9)], "k string, began int, v int")
    assert asof_join(left, right.limit(0), ["k"], "t", "began").first().match is None
    assert asof_join(left.limit(0), right, ["k"], "t", "began").count() == 0


def test_prices_in_force(spark):
    d = lambda n: dt.date(2024, 1, n)
    prices = [("p1", "f", "first", 10.0, 1.0, d(1), d(20)),  # replaced on the 5th, though it ends later
              ("p2", "f", "first", 20.0, 1.0, d(5), d(8)), ("p9", "f", "first", 99.0, 1.0, d(5), d(30)),  # same day: the lowest id
              ("p3", "f", "first", 30.0, None, d(15), None), ("p4", "f", "business", 40.0, 0.0, d(1), d(2)), ("p5", None, "first", 50.0, 0.0, d(1), None)]
    p = spark.createDataFrame(prices, "price_id string, silver_flight_id string, ticket_class string, ticket_price double, luggage_fee double, start_date date, end_date date")
    book = [("b0", "f", "first", dt.date(2023, 12, 31)), ("b1", "f", "first", d(1)), ("b2", "f", "first", d(4)), ("b3", "f", "first", d(5)), ("b4", "f", "first", d(8)),
            ("b5", "f", "first", d(9)), ("b6", "f", "first", d(15)), ("b7", "f", "first", dt.date(2030, 1, 1)), ("b8", "f", "business", d(3)), ("b9", None, "first", d(3)),
            ("b10", "f", "first", None), ("b11", "g", "first", d(3))]
    b = spark.createDataFrame(book, "booked_ticket_id string, flight_id string, ticket_class string, booking_date date")
    got = {r.booked_ticket_id: r.price_id for r in gold.price_at_booking(p, b).collect()}
    assert got == {"b0": None, "b1": "p1", "b2": "p1", "b3": "p2", "b4": "p2", "b5": None, "b6": "p3", "b7": "p3", "b8": None, "b9": None, "b10": None, "b11": None}
    gaps = {r.booked_ticket_id for r in gold.unpriced_bookings(p, b, on_date=True).collect()}
    assert gaps == {k for k, v in got.items() if v is None}
