"""Silver builders: bronze (or raw) DataFrames → clean, conformed tables.

Every builder is a pure function of DataFrames; the caller decides where to
write. None of them collects to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail import schema
from contrail.functions.columns import month_of, safe_ratio, surrogate_key, year_of
from contrail.operators.ranking import latest_per_key
from contrail.operators.shaping import conform, with_audit


LOADED = "ingestion_time"


def _conformed(table: str, df: DataFrame, audit: bool, optional: tuple[str, ...] = ()) -> DataFrame:
    """The table's columns; with ``audit`` also the load time bronze carries, or now where it has none."""
    spec = list(schema.SILVER[table])
    if audit and LOADED in df.columns:
        spec.append(((LOADED,), LOADED, None))
    out = conform(df, spec, optional=optional)
    return with_audit(out, LOADED) if audit else out


def build_silver_routes(bronze_routes: DataFrame, audit: bool = True) -> DataFrame:
    return _conformed("silver_routes", bronze_routes, audit)


def build_silver_flights(bronze_flights: DataFrame, audit: bool = True) -> DataFrame:
    """Conform flights and derive ``flight_date`` from the scheduled departure
    when the source has none (the gold jobs need it; bronze never carries it)."""
    out = _conformed("silver_flights", bronze_flights, audit, optional=("flight_date",))
    return out.withColumn("flight_date", F.coalesce(F.col("flight_date"), F.to_date("scheduled_departure")))


def build_silver_waypoints(bronze_points: DataFrame, audit: bool = True) -> DataFrame:
    return _conformed("silver_waypoint_sampling_weather_points", bronze_points, audit)


def build_silver_ticket_prices(bronze_prices: DataFrame, audit: bool = True) -> DataFrame:
    return _conformed("silver_ticket_prices", bronze_prices, audit)


def build_silver_customers(bronze_customers: DataFrame, audit: bool = True) -> DataFrame:
    return _conformed("silver_customers", bronze_customers, audit)


def build_silver_flights_events(bronze_events: DataFrame, audit: bool = True) -> DataFrame:
    return _conformed("silver_flights_events", bronze_events, audit)


def build_silver_booked_tickets(bronze_bookings: DataFrame, audit: bool = True) -> DataFrame:
    return _conformed("silver_booked_tickets", bronze_bookings, audit)


def build_silver_ticket_events(bronze_events: DataFrame, audit: bool = True) -> DataFrame:
    return _conformed("silver_ticket_events", bronze_events, audit)


def build_clean_flights(bronze_flights: DataFrame, key: str = "flight_id") -> DataFrame:
    """Generic bronze clean: drop self-routes (NULL on either side drops the
    row too) and keep one row per ``key`` — deterministically the latest by
    ``ingestion_time`` and then by the other columns, instead of an arbitrary
    ``dropDuplicates`` survivor."""
    kept = bronze_flights.where(F.col("origin") != F.col("destination"))
    return latest_per_key(kept, [key])


def build_boarding_summary(boarding_events: DataFrame, audit: bool = True) -> DataFrame:
    """Per flight: scanned passengers, bags with weight, total and average weights.

    One filter pushed to the scan and one partially-aggregated group-by, so a
    flight holding a third of all scans still costs one buffer per map task.
    ``baggage_count`` counts scans carrying a positive weight and
    ``boarding_date`` is the first scan date. Ratios are NULL on a zero count.
    """
    scans = boarding_events.where(F.col("event_type") == schema.BOARDING_SCAN)
    w = F.col("baggage_weight")
    agg = scans.groupBy("flight_id").agg(
        F.count("event_type").alias("passenger_count"),
        F.count_if(w > 0).alias("baggage_count"),
        F.sum(w).cast(schema.MONEY).alias("total_baggage_weight"),
        F.min(F.to_date("event_time")).alias("boarding_date"),
    )
    out = agg.select(
        "flight_id", "passenger_count", "baggage_count", "total_baggage_weight",
        safe_ratio("total_baggage_weight", "passenger_count").alias("avg_baggage_per_passenger"),
        safe_ratio("total_baggage_weight", "baggage_count").alias("avg_baggage_weight"),
        "boarding_date",
    )
    return with_audit(out) if audit else out


def _route_points(waypoints: DataFrame) -> DataFrame:
    return waypoints.select(
        F.col("route_id").alias("_route"), F.col("way_point_number").alias("waypoint_sampling_number"),
        F.col("point_latitude").alias("_lat"), F.col("point_longitude").alias("_lon"),
        F.col("point_height").alias("_h"))


def _flight_days(flights: DataFrame) -> DataFrame:
    """Flights by their route and date; a flight without either has no place."""
    return flights.select(
        F.col("flight_id").alias("silver_flight_id"), F.col("routes_id").alias("_route"),
        F.col("flight_date").alias("_sdate")).where("_route is not null and _sdate is not null")


def build_flight_weather(weather_raw: DataFrame, waypoints: DataFrame, flights: DataFrame,
                         audit: bool = True) -> DataFrame:
    """Tie each raw weather sample to a flight: one row per sample, which is the table's key.

    A sample belongs to the flights whose route has a waypoint at its exact
    (lat, lon, height) on its date. Many flights can share such a place and
    day, so flights are reduced to the smallest per route and day, and these
    with their waypoints to the smallest (flight, waypoint number) per place
    and day, before the samples join them: the output grows with the samples,
    not with samples x flights. Every flight's own averages come from
    ``build_weather_summary_from_samples``, which uses all of them.
    """
    keys = ["_lat", "_lon", "_h", "_sdate"]
    # in a struct a NULL id counts, as the smallest
    least = _flight_days(flights).groupBy("_route", "_sdate").agg(F.min(F.struct("silver_flight_id")).alias("_flight"))
    first = (least.join(_route_points(waypoints), "_route").groupBy(*keys)
             .agg(F.min(F.struct("_flight.silver_flight_id", "waypoint_sampling_number")).alias("_at")))
    w = weather_raw.select(
        "weather_sample_id", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"),
        F.col("height").alias("_h"), F.to_date("sample_for_date").alias("_sdate"),
        F.col("current_weather_condition").alias("weather_condition"),
        "temperature", "humidity", "wind_speed", "wind_direction")
    out = w.join(first, keys).select(
        "weather_sample_id", F.col("_at.silver_flight_id").alias("silver_flight_id"),
        F.col("_at.waypoint_sampling_number").alias("waypoint_sampling_number"), "weather_condition",
        "temperature", "humidity", "wind_speed", "wind_direction", F.col("_sdate").alias("sample_for_date"),
    )
    return with_audit(out) if audit else out


_WEATHER_MEASURES = {"temperature": "average_temperature", "humidity": "average_humidity",
                     "wind_speed": "average_wind_speed", "wind_direction": "average_wind_direction"}


def build_weather_summary(flight_weather: DataFrame, audit: bool = True) -> DataFrame:
    """Per flight: average measures and the majority weather condition.

    Single pass: aggregate by (flight, condition) — carrying partial sums and
    counts — then roll up to the flight. The majority is the condition with
    the most samples, ties to the alphabetically first (a ``min`` over a
    (−count, condition) struct); NULL conditions never win.
    """
    fw = flight_weather.withColumnRenamed("silver_flight_id", "flight_id")
    by_cond = fw.groupBy("flight_id", "weather_condition").agg(*_weather_sums())
    return _rolled_weather(by_cond, ["flight_id"], audit)


def build_weather_summary_from_samples(weather_raw: DataFrame, waypoints: DataFrame, flights: DataFrame,
                                       audit: bool = True) -> DataFrame:
    """The weather summary without the sample x flight product.

    A flight's weather follows from its route and date. Samples are summed per
    (place, date, condition), these sums per (route, date, condition), and a
    flight meets its day once, as a finished row. Only flights stored under
    several routes or dates add up the sums of theirs.
    """
    at = weather_raw.select(
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), F.col("height").alias("_h"),
        F.to_date("sample_for_date").alias("_sdate"), F.col("current_weather_condition").alias("weather_condition"),
        *_WEATHER_MEASURES)
    keys, day = ["_lat", "_lon", "_h", "_sdate"], ["_route", "_sdate"]
    totals = ["n", *(f"{k}_{m}" for m in _WEATHER_MEASURES for k in ("s", "n"))]
    sums = at.groupBy(*keys, "weather_condition").agg(*_weather_sums())
    flown = _flight_days(flights)
    points = flown.select(*day).distinct().join(_route_points(waypoints), "_route")
    by_cond = sums.join(points, keys).groupBy(*day, "weather_condition").agg(*[F.sum(c).alias(c) for c in totals])
    stays = flown.groupBy("silver_flight_id", *day).agg(F.count(F.lit(1)).alias("_times"))
    stays = stays.withColumn("_days", F.count(F.lit(1)).over(Window.partitionBy("silver_flight_id")))
    # _times > 0 always holds: as both parts read the same columns, they share the shuffles of the flights
    once = (stays.where("_days = 1 and _times > 0").join(_rolled_weather(by_cond, day, audit=False), day)
            .drop("_times", "_days", *day))
    more = (stays.where("_days > 1").join(by_cond, day).groupBy("silver_flight_id", "weather_condition")
            .agg(*[F.sum(F.col(c) * F.col("_times")).alias(c) for c in totals]))
    out = (once.unionByName(_rolled_weather(more, ["silver_flight_id"], audit=False))
           .withColumnRenamed("silver_flight_id", "flight_id"))
    return with_audit(out) if audit else out


def _weather_sums() -> list:
    partial = [F.count(F.lit(1)).alias("n")]
    for m in _WEATHER_MEASURES:
        partial += [F.sum(m).alias(f"s_{m}"), F.count(m).alias(f"n_{m}")]
    return partial


def _rolled_weather(by_cond: DataFrame, keys: list[str], audit: bool) -> DataFrame:
    cond = F.col("weather_condition")
    rolled = by_cond.groupBy(*keys).agg(
        *[F.try_divide(F.sum(f"s_{m}"), F.sum(f"n_{m}")).alias(out) for m, out in _WEATHER_MEASURES.items()],
        F.min(F.when(cond.isNotNull(), F.struct((-F.col("n")).alias("k"), cond.alias("c"))))["c"]
         .alias("majority_weather_condition"),
    )
    return with_audit(rolled) if audit else rolled


def build_delay_reasons(flights_events: DataFrame, flights: DataFrame, audit: bool = True) -> DataFrame:
    """Occurrences of each delay reason per (year, month) of the flight date.

    ``silver_flight_event`` is one representative event of the group (the
    smallest id), which keeps the reference's event-based join well defined.
    """
    # Count per (flight, reason) before the join (exact: sums of counts, min of
    # mins), so a flight holding a third of all events joins as a few rows.
    ev = (flights_events.where(F.col("delay_reason").isNotNull())
          .groupBy("flight_id", "delay_reason")
          .agg(F.count(F.lit(1)).alias("_n"), F.min("flight_event_id").alias("_first")))
    fl = flights.select("flight_id", "flight_date")
    j = ev.join(fl, "flight_id").withColumns({"year": year_of("flight_date"), "month": month_of("flight_date")})
    agg = j.groupBy("year", "month", "delay_reason").agg(
        F.sum("_n").alias("total_occurences"),
        F.min("_first").alias("silver_flight_event"),
    )
    out = agg.select(
        surrogate_key("delay_reason", "year", "month", "delay_reason").alias("delay_id"),
        "silver_flight_event", "total_occurences", "year", "month", "delay_reason",
    )
    return with_audit(out) if audit else out


def build_cancelation_rate(booked_tickets: DataFrame, ticket_events: DataFrame, audit: bool = True) -> DataFrame:
    """Per (year, month) of booking date: bookings, canceled bookings, rate.

    Canceled ids are de-duplicated with a partial aggregation before the join,
    so repeated cancel events neither fan out the join nor double count.
    """
    canceled = (ticket_events.where(F.col("event_type") == schema.CANCELED)
                .groupBy("booked_ticket_id").agg(F.lit(True).alias("_canceled")))
    b = booked_tickets.select("booked_ticket_id", "booking_date")
    j = b.join(canceled, "booked_ticket_id", "left")
    agg = j.groupBy(year_of("booking_date").alias("year"), month_of("booking_date").alias("month")).agg(
        F.count(F.lit(1)).alias("total_booking"),
        F.count("_canceled").alias("total_cancelation"),
    )
    out = agg.withColumn("cancelation_rate", safe_ratio("total_cancelation", "total_booking"))
    return with_audit(out) if audit else out
