"""Builder semantics on hand-written frames (edge cases from FIXTURES §4)."""

import datetime as dt
from decimal import Decimal

from contrail.plans import gold, silver

D = dt.date
TS = dt.datetime


def test_boarding_summary_zero_baggage_gives_null_ratio(spark):
    ev = spark.createDataFrame([
        ("e1", "f1", "passenger_scanned", "p1", Decimal("0.00"), TS(2024, 1, 2, 8)),
        ("e2", "f1", "passenger_scanned", "p2", Decimal("0.00"), TS(2024, 1, 1, 8)),
        ("e3", "f1", "bag_loaded", "p2", Decimal("9.00"), TS(2024, 1, 1, 8)),
        ("e4", "f2", "passenger_scanned", "p3", Decimal("10.50"), TS(2024, 1, 3, 8)),
        ("e5", "f2", None, "p3", Decimal("1.00"), TS(2024, 1, 3, 8)),
    ], "event_id string, flight_id string, event_type string, passenger_id string, baggage_weight decimal(10,2), event_time timestamp")
    out = {r.flight_id: r for r in silver.build_boarding_summary(ev, audit=False).collect()}
    assert out["f1"].passenger_count == 2 and out["f1"].baggage_count == 0
    assert out["f1"].avg_baggage_weight is None and out["f1"].avg_baggage_per_passenger == 0.0
    assert out["f1"].boarding_date == D(2024, 1, 1)
    assert out["f2"].avg_baggage_weight == 10.5 and out["f2"].passenger_count == 1


def test_cancelation_rate_counts_each_booking_once(spark):
    b = spark.createDataFrame([("t1", D(2024, 1, 5)), ("t2", D(2024, 1, 6)), ("t3", D(2024, 2, 1))],
                              "booked_ticket_id string, booking_date date")
    e = spark.createDataFrame([("t1", "canceled"), ("t1", "canceled"), ("t2", "class upgrade")],
                              "booked_ticket_id string, event_type string")
    out = {(r.year, r.month): r for r in silver.build_cancelation_rate(b, e, audit=False).collect()}
    assert (out[(2024, 1)].total_booking, out[(2024, 1)].total_cancelation, out[(2024, 1)].cancelation_rate) == (2, 1, 0.5)
    assert out[(2024, 2)].cancelation_rate == 0.0


def _flights(spark):
    return spark.createDataFrame([
        ("f1", "r1", D(2024, 1, 1), TS(2024, 1, 1, 10), TS(2024, 1, 1, 12)),
        ("f2", "r1", D(2024, 1, 2), TS(2024, 1, 2, 10), TS(2024, 1, 2, 11)),
        ("f3", "r2", D(2024, 2, 1), TS(2024, 2, 1, 10), TS(2024, 2, 1, 11)),
    ], "flight_id string, routes_id string, flight_date date, scheduled_departure timestamp, scheduled_arrival timestamp")


def test_monthly_delays_signed_and_missing_reason_kept(spark):
    fl = _flights(spark)
    ev = spark.createDataFrame([
        ("e1", "f1", "actual_departure", "crew", TS(2024, 1, 1, 10, 30)),
        ("e2", "f2", "actual_departure", "weather", TS(2024, 1, 2, 9, 50)),
        ("e3", "f2", "delay_reported", "weather", TS(2024, 1, 2, 9, 50)),
        ("e4", "f3", "actual_departure", None, TS(2024, 2, 1, 10, 0)),
    ], "flight_event_id string, flight_id string, event_type string, delay_reason string, event_time timestamp")
    reasons = silver.build_delay_reasons(ev, fl, audit=False)
    out = {(r.year, r.month): r for r in gold.build_monthly_delays(fl, ev, reasons, audit=False).collect()}
    jan = out[(2024, 1)]
    assert (jan.minimal_delay, jan.maximal_delay, jan.average_delay) == (-10.0, 30.0, 10.0)
    assert jan.most_frequent_delay == "weather"  # 2 weather rows vs 1 crew
    assert out[(2024, 2)].most_frequent_delay is None
    joined = {(r.year, r.month): r.most_frequent_delay
              for r in gold.build_monthly_delays(fl, ev, reasons, reason_path="join", audit=False).collect()}
    assert joined == {k: v.most_frequent_delay for k, v in out.items()}


def test_most_popular_ties_alphabetical(spark):
    fl = _flights(spark)
    routes = spark.createDataFrame([("r1", "PAR", "TLV"), ("r2", "AMS", "BER")],
                                   "routes_id string, airport_origin string, airport_destination string")
    b = spark.createDataFrame([("f1", "f1", D(2024, 3, 1), "web"), ("f3", "f3", D(2024, 3, 2), "app")],
                              "booked_ticket_id string, flight_id string, booking_date date, order_method string")
    r = gold.build_monthly_most_popular(b, fl, routes, key="flight", method="column", audit=False).first()
    assert (r.most_popular_origin, r.most_popular_destination, r.most_popular_order_method) == ("AMS", "BER", "app")
    lit = gold.build_monthly_most_popular(b, fl, routes, audit=False).first()
    assert lit.most_popular_order_method == "online"


def test_revenue_null_fee_drops_term_and_ratio(spark):
    p = spark.createDataFrame([
        ("p1", "t1", "first", Decimal("100.00"), Decimal("10.00"), D(2024, 1, 1), D(2024, 1, 9), True),
        ("p2", "t2", "economy", Decimal("50.00"), None, D(2024, 1, 1), D(2024, 1, 9), True),
    ], "price_id string, silver_flight_id string, ticket_class string, ticket_price decimal(12,2), "
       "luggage_fee decimal(12,2), start_date date, end_date date, actual boolean")
    b = spark.createDataFrame([("t1", "c1", "first", "web", D(2024, 1, 1), "t1"), ("t2", "c2", "economy", "web", D(2024, 1, 1), "t2")],
                              "booked_ticket_id string, customer_passport_id string, ticket_class string, order_method string, "
                              "booking_date date, flight_id string")
    rate = spark.createDataFrame([(2024, 1, 0.25)], "year int, month int, cancelation_rate double")
    r = gold.build_monthly_revenue(p, b, rate, audit=False).first()
    assert r.total_revenue == 110.0 and r.average_ticket_price == 75.0 and r.max_revenue_class == "first"
    assert r.revenue_per_passenger == 110.0 and r.cancelation_rate == 0.25
    r2 = gold.build_monthly_revenue(p, b, rate, key="flight", audit=False).first()
    assert r2.total_revenue == 110.0 and r2.revenue_per_passenger == 55.0


def test_report_drops_months_missing_in_a_dimension(spark):
    mk = lambda name, rows: spark.createDataFrame(rows, f"year int, month int, {name} string")
    delays = mk("delays_id", [(2024, 1, "d1"), (2024, 2, "d2")])
    info = mk("flights_info_id", [(2024, 1, "i1"), (2024, 2, "i2")])
    rev = mk("revenue_id", [(2024, 1, "r1")])
    pop = mk("metrics_id", [(2024, 1, "m1"), (2024, 2, "m2")])
    out = gold.build_performance_report(delays, info, rev, pop, audit=False).collect()
    assert [(r.year, r.month, r.revenue_id) for r in out] == [(2024, 1, "r1")]


def test_ml_boarding_on_empty_input_is_one_null_row_and_training_ids_null(spark):
    fl = spark.createDataFrame([], "flight_id string, routes_id string, possible_passenger_amount int, "
                                   "possible_luggage_weight int, scheduled_departure timestamp")
    b = gold.build_ml_boarding_data(fl, audit=False).collect()
    assert len(b) == 1 and b[0].max_passenger_capacity is None
    fl2 = _flights(spark)
    ev = spark.createDataFrame([("e1", "f1", "actual_departure", TS(2024, 1, 1, 10, 5))],
                               "flight_event_id string, flight_id string, event_type string, event_time timestamp")
    routes_dim = spark.createDataFrame([], "routes_id string, route_id string")
    weather_dim = spark.createDataFrame([], "weather_id string, majority_weather_condition string")
    boarding_dim = spark.createDataFrame([], "boarding_data_id string")
    r = gold.build_ml_training(fl2, ev, routes_dim, weather_dim, boarding_dim, audit=False).first()
    assert (r.weather_id, r.route_id, r.boarding_data_id, r.delay_in_minutes) == (None, None, None, 5.0)


def test_clean_flights_drops_self_routes_and_dedupes(spark):
    df = spark.createDataFrame([("f1", "A", "B"), ("f1", "A", "C"), ("f2", "A", "A"), ("f3", None, "B")],
                               "flight_id string, origin string, destination string")
    assert [tuple(r) for r in silver.build_clean_flights(df).collect()] == [("f1", "A", "B")]


def test_weather_summary_majority_tie_and_averages(spark):
    fw = spark.createDataFrame([("f1", "rain", 10.0), ("f1", "fog", 20.0), ("f1", None, None)],
                               "silver_flight_id string, weather_condition string, temperature double")
    from pyspark.sql import functions as F
    fw = fw.withColumns({"humidity": F.lit(50.0), "wind_speed": F.lit(1.0), "wind_direction": F.lit(90.0)})
    r = silver.build_weather_summary(fw, audit=False).first()
    assert r.majority_weather_condition == "fog" and r.average_temperature == 15.0


def test_uuid_id_mode_gives_distinct_random_ids(spark):
    from pyspark.sql import functions as F
    fl = _flights(spark).withColumns({"possible_passenger_amount": F.lit(180), "possible_luggage_weight": F.lit(9000)})
    out = gold.build_ml_boarding_data(fl, id_mode="uuid", audit=False).first()
    assert len(out.boarding_data_id) == 36
    hashed = gold.build_ml_boarding_data(fl, audit=False).first()
    assert len(hashed.boarding_data_id) == 64


def test_flight_weather_has_a_row_per_sample_however_many_flights_share_it(spark):
    import datetime as dt
    from contrail.plans import silver
    day = dt.date(2024, 1, 1)
    samples = spark.createDataFrame([(f"s{i}", 1.0, 2.0, 3.0, day, "rain", 5.0, 6.0, 7.0, 8.0) for i in range(4)],
                                    "weather_sample_id string, latitude double, longitude double, height double, sample_for_date date,"
                                    " current_weather_condition string, temperature double, humidity double, wind_speed double, wind_direction double")
    points = spark.createDataFrame([("r", 0, 1.0, 2.0, 3.0)],
                                   "route_id string, way_point_number int, point_latitude double, point_longitude double, point_height double")
    flights = spark.createDataFrame([(f"f{i}", "r", day) for i in range(50)], "flight_id string, routes_id string, flight_date date")
    out = silver.build_flight_weather(samples, points, flights, audit=False).collect()
    assert sorted((r.weather_sample_id, r.silver_flight_id) for r in out) == [(f"s{i}", "f0") for i in range(4)]
    each = silver.build_weather_summary_from_samples(samples, points, flights, audit=False)
    assert each.count() == 50


def test_weather_summary_of_flights_stored_twice_or_under_several_days(spark):
    import datetime as dt
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    samples = spark.createDataFrame(
        [(1.0, d1, "rain", 10.0), (1.0, d1, "rain", 20.0), (1.0, d1, "fog", 30.0), (1.0, d2, "fog", 40.0), (1.0, d2, "fog", None), (1.0, d2, None, 60.0)],
        "latitude double, sample_for_date date, current_weather_condition string, temperature double").selectExpr(
        "*", "2D longitude", "3D height", "50D humidity", "1D wind_speed", "90D wind_direction")
    points = spark.createDataFrame([("r", 0, 1.0, 2.0, 3.0), ("r", 1, 1.0, 2.0, 3.0), ("far", 0, 9.0, 2.0, 3.0)],
                                   "route_id string, way_point_number int, point_latitude double, point_longitude double, point_height double")
    flights = spark.createDataFrame([("one", "r", d1), ("twice", "r", d1), ("twice", "r", d1), ("days", "r", d1), ("days", "r", d2), ("days", "r", d2),
                                     (None, "r", d1), (None, "r", d2), ("lost", "far", d1), ("part", "far", d1), ("part", "r", d2), ("none", None, d1), ("never", "r", None)],
                                    "flight_id string, routes_id string, flight_date date")
    out = silver.build_weather_summary_from_samples(samples, points, flights, audit=False).collect()
    got = {r.flight_id: (r.average_temperature, r.majority_weather_condition) for r in out}
    assert len(out) == 5 and got == {"one": (20.0, "rain"), "twice": (20.0, "rain"), "days": ((60.0 + 2 * 100.0) / 7, "fog"),
                                     None: (32.0, "fog"), "part": (50.0, "fog")}


def test_unpriced_bookings_are_reported(spark):
    from contrail.plans import gold
    prices = spark.createDataFrame([("f1", "first", False)], "silver_flight_id string, ticket_class string, actual boolean")
    books = spark.createDataFrame([("b1", "f1", "first"), ("b2", "f1", "economy"), ("b3", None, "first"), ("b4", "f1", None)],
                                  "booked_ticket_id string, flight_id string, ticket_class string")
    got = {r.booked_ticket_id for r in gold.unpriced_bookings(prices, books).collect()}
    assert got == {"b2", "b3", "b4"}


def test_weather_summary_shuffles_stored_flights_once(spark, tmp_dir):
    import re
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    points = spark.createDataFrame([("r", 0, 1.0, 2.0, 3.0)], "route_id string, way_point_number int, point_latitude double, point_longitude double, point_height double")
    samples = spark.createDataFrame([(1.0, d1, 10.0), (1.0, d2, 40.0)], "latitude double, sample_for_date date, temperature double").selectExpr(
        "*", "2D longitude", "3D height", "50D humidity", "1D wind_speed", "90D wind_direction", "'fog' current_weather_condition")
    spark.createDataFrame([("one", "r", d1), ("days", "r", d1), ("days", "r", d2), ("days", "r", d2)],
                          "flight_id string, routes_id string, flight_date date").write.parquet(f"{tmp_dir}/flights")
    df = silver.build_weather_summary_from_samples(samples, points, spark.read.parquet(f"{tmp_dir}/flights"), audit=False)
    assert {r.flight_id: r.average_temperature for r in df.collect()} == {"one": 10.0, "days": 30.0}
    ran = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # flights under one day and flights under several take their days from the same shuffle
    assert re.search(r"ReusedExchange \[.*\], Exchange hashpartitioning\(\w*flight_id#\d+, \d+\)", ran)
