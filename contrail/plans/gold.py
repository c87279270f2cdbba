"""Gold builders: monthly reporting marts and ML feature tables.

Scale notes that apply throughout:
- big inputs are aggregated to (year, month[, label]) grain *before* any
  window or dimension join, so windows and dimension joins only ever see a
  few rows per month;
- month-grain and single-row results are the only sides we hint to
  broadcast (bounded by construction); everything else is left to AQE, which
  broadcasts from measured runtime sizes or shuffles and splits skew;
- ids are deterministic hashes of the natural key (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail import schema
from contrail.functions.columns import minutes_between, month_of, safe_ratio, surrogate_key, year_of
from contrail.operators.asof import asof_join
from contrail.operators.joins import align_periods, attach_scalar
from contrail.operators.ranking import most_frequent_many, top_n_per_group
from contrail.operators.shaping import with_audit

PERIOD = ["year", "month"]


def _key(id_mode: str, namespace: str, *cols):
    """Row id: stable hash of the natural key, or ``uuid()`` (the reference's
    per-run random ids, still built-in so no Python worker is involved)."""
    if id_mode == "uuid":
        return F.expr("uuid()")
    return surrogate_key(namespace, *cols)


def _finish(df: DataFrame, cols: list[str], audit: bool) -> DataFrame:
    out = df.select(*cols)
    return with_audit(out) if audit else out


def _departures(flights: DataFrame, flights_events: DataFrame) -> DataFrame:
    dep = (flights_events.where(F.col("event_type") == schema.DEPARTURE_EVENT)
           .select("flight_event_id", "flight_id", "event_time"))
    return flights.join(dep, "flight_id")


def build_monthly_delays(flights: DataFrame, flights_events: DataFrame, delay_reasons: DataFrame,
                         reason_path: str = "columns", id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Monthly departure-delay statistics plus the most frequent delay reason.

    Delay = signed minutes from scheduled to actual departure (interval form,
    whole seconds). Months without a reason keep a NULL reason (left join).
    ``reason_path="columns"`` ranks the reason table on its own (year, month,
    delay_reason) columns; ``"join"`` resolves the month through the
    representative event and its flight, as the reference does.
    """
    j = _departures(flights.select("flight_id", "flight_date", "scheduled_departure"), flights_events)
    j = j.select(year_of("flight_date").alias("year"), month_of("flight_date").alias("month"),
                 minutes_between("scheduled_departure", "event_time").alias("delay_minutes"))
    stats = j.groupBy(*PERIOD).agg(
        F.avg("delay_minutes").alias("average_delay"),
        F.min("delay_minutes").alias("minimal_delay"),
        F.max("delay_minutes").alias("maximal_delay"),
    )
    if reason_path == "join":
        ev = flights_events.select(F.col("flight_event_id").alias("silver_flight_event"), "flight_id",
                                   F.col("delay_reason").alias("_reason"))
        fl = flights.select("flight_id", "flight_date")
        r = (delay_reasons.select("silver_flight_event", "total_occurences")
             .join(ev, "silver_flight_event").join(fl, "flight_id")
             .select(year_of("flight_date").alias("year"), month_of("flight_date").alias("month"),
                     F.col("_reason").alias("delay_reason"), "total_occurences"))
    else:
        r = delay_reasons.select(*PERIOD, "delay_reason", "total_occurences")
    return delays_of(stats, r, id_mode, audit)


def delays_of(stats: DataFrame, reasons: DataFrame, id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Monthly delays from one row of statistics per month and occurrences per month and reason."""
    top = top_n_per_group(reasons, PERIOD, [F.col("total_occurences").desc(), F.col("delay_reason").asc()], 1)
    top = top.select(*PERIOD, F.col("delay_reason").alias("most_frequent_delay"))
    out = stats.join(F.broadcast(top), PERIOD, "left")  # month grain: bounded
    out = out.withColumn("delays_id", _key(id_mode, "delays", "year", "month"))
    return _finish(out, ["delays_id", "most_frequent_delay", "average_delay", "minimal_delay", "maximal_delay",
                         "year", "month"], audit)


def delay_rows(flights: DataFrame, flights_events: DataFrame) -> DataFrame:
    """The rows behind monthly delays, from one join: per departure its whole seconds of delay (``delay_reason`` NULL),
    per event with a reason the reason and the event's id."""
    e = flights_events.select("flight_event_id", "flight_id", "event_type", "event_time", "delay_reason")
    e = e.where((F.col("event_type") == schema.DEPARTURE_EVENT) | F.col("delay_reason").isNotNull())
    j = flights.select("flight_id", "flight_date", "scheduled_departure").join(e, "flight_id")
    seconds = (F.col("event_time") - F.col("scheduled_departure")).cast("long")
    none = F.lit(None)
    kinds = F.array(
        F.when(F.col("event_type") == schema.DEPARTURE_EVENT, F.struct(
            none.cast("string").alias("delay_reason"), seconds.alias("seconds"), none.cast("string").alias("event"))),
        F.when(F.col("delay_reason").isNotNull(), F.struct(
            F.col("delay_reason"), none.cast("long").alias("seconds"), F.col("flight_event_id").cast("string").alias("event"))))
    return j.select(year_of("flight_date").alias("year"), month_of("flight_date").alias("month"), F.inline(F.array_compact(kinds)))


def build_monthly_flight_info(flights: DataFrame, boarding_summary: DataFrame, id_mode: str = "hash",
                              audit: bool = True) -> DataFrame:
    """Flights with a boarding summary, per month of the flight date."""
    j = flights.select("flight_id", "flight_date").join(
        boarding_summary.select("flight_id", "passenger_count"), "flight_id")
    agg = j.groupBy(year_of("flight_date").alias("year"), month_of("flight_date").alias("month")).agg(
        F.count("flight_id").alias("total_flights"),
        F.sum("passenger_count").cast("bigint").alias("total_passengers_number"),
        F.avg("passenger_count").alias("average_passengers_number_on_flight"),
    )
    out = agg.withColumn("flights_info_id", _key(id_mode, "flight_info", "year", "month"))
    return _finish(out, ["flights_info_id", "total_flights", "total_passengers_number",
                         "average_passengers_number_on_flight", "year", "month"], audit)


def _priced_bookings_literal(prices: DataFrame, bookings: DataFrame) -> DataFrame:
    """Reference join: price.silver_flight_id = booking.booked_ticket_id; the
    class comes from the price side. One row per (price, booking) match."""
    b = bookings.select(F.col("booked_ticket_id").alias("silver_flight_id"),
                        F.col("customer_passport_id"))
    p = prices.select("silver_flight_id", "ticket_class", "ticket_price", "luggage_fee", "start_date")
    return p.join(b, "silver_flight_id").withColumn("_n", F.lit(1).cast("bigint"))


def _priced_bookings_by_flight(prices: DataFrame, bookings: DataFrame) -> DataFrame:
    """Each booking priced by its own flight and class.

    One price per (flight, class) is chosen first — the row with the latest
    start date (then lowest price id) — and bookings are counted
    per (flight, class, passenger) before the join, so a flight holding a
    third of all bookings joins as a handful of pre-aggregated rows.
    """
    p = prices.select(
        F.col("silver_flight_id").alias("flight_id"), "ticket_class", "ticket_price", "luggage_fee",
        "start_date", "price_id")
    p = top_n_per_group(p, ["flight_id", "ticket_class"],
                        [F.col("start_date").desc(), F.col("price_id").asc()], 1).drop("price_id")
    b = (bookings.where(F.col("flight_id").isNotNull())
         .groupBy("flight_id", "ticket_class", "customer_passport_id").agg(F.count(F.lit(1)).alias("_n")))
    return p.join(b, ["flight_id", "ticket_class"])


def price_at_booking(prices: DataFrame, bookings: DataFrame) -> DataFrame:
    """``bookings`` with the price in force for their flight and class on the booking date: ``price_id, ticket_price,
    luggage_fee, start_date`` (NULL: none).

    A price is in force from its start date to its end date (both included; no end: open) or to the day before the
    next price of its flight and class starts, if that is earlier: a new price replaces the one before. Of prices
    that start on the same day the lowest (price id, price, fee, end) counts. Days that no price covers are gaps.
    """
    own = ["price_id", "ticket_price", "luggage_fee", "end_date"]
    p = (prices.groupBy(F.col("silver_flight_id").alias("flight_id"), "ticket_class", "start_date")
         .agg(F.min(F.struct(*own)).alias("p")).select("flight_id", "ticket_class", "start_date", "p.*"))
    j = asof_join(bookings, p, ["flight_id", "ticket_class"], "booking_date", "start_date", "__price")
    price = F.col("__price")
    valid = price["end_date"].isNull() | (F.col("booking_date") <= price["end_date"])
    return j.select(*bookings.columns, *[F.when(valid, price[c]).alias(c) for c in ["price_id", "ticket_price", "luggage_fee", "start_date"]])


def _priced_bookings_on_date(prices: DataFrame, bookings: DataFrame) -> DataFrame:
    """Each booking at the price in force on its booking date, counted per flight, class, date and passenger first."""
    b = (bookings.where(F.col("flight_id").isNotNull())
         .groupBy("flight_id", "ticket_class", "booking_date", "customer_passport_id").agg(F.count(F.lit(1)).alias("_n")))
    return price_at_booking(prices, b).where(F.col("start_date").isNotNull())


def unpriced_bookings(ticket_prices: DataFrame, booked_tickets: DataFrame, on_date: bool = False) -> DataFrame:
    """The bookings that ``key="flight"`` cannot price: no price of their flight and class, or no flight or class.

    ``on_date``: those that ``key="valid"`` cannot price, the gaps of ``price_at_booking`` included.
    """
    if on_date:
        return price_at_booking(ticket_prices, booked_tickets).where(F.col("start_date").isNull()).select(*booked_tickets.columns)
    known = F.col("flight_id").isNotNull() & F.col("ticket_class").isNotNull()
    priced = ticket_prices.select(F.col("silver_flight_id").alias("flight_id"), "ticket_class").where(known).distinct()
    open_ = booked_tickets.where(known).join(priced, ["flight_id", "ticket_class"], "left_anti")
    return open_.select(*booked_tickets.columns).unionByName(booked_tickets.where(~known))


def build_monthly_revenue(ticket_prices: DataFrame, booked_tickets: DataFrame, cancelation_rate: DataFrame,
                          key: str = "literal", per_passenger: str | None = None, id_mode: str = "hash",
                          audit: bool = True) -> DataFrame:
    """Monthly revenue by month of the price start date.

    ``key``: ``"literal"`` joins as the reference does, ``"flight"`` takes the
    latest price of the booking's flight and class, ``"valid"`` the one in force
    on the booking date (``price_at_booking``).

    total = Σ(price + fee) per booking (a NULL fee drops that term, as the
    reference's ``sum(a + b)``), average price = Σprice / #priced bookings,
    top revenue class (ties alphabetical), cancelation rate of the month.
    ``per_passenger``: ``"literal"`` = total / 1 (reference), ``"distinct"``
    = total / distinct passengers; default literal for ``key="literal"``.

    One aggregation at (month, class) grain — (month, class, passenger) for
    the distinct ratio — feeds every measure; totals and the top class come
    from one window pass over it.
    """
    per_passenger = per_passenger or ("literal" if key == "literal" else "distinct")
    if key == "literal":
        j = _priced_bookings_literal(ticket_prices, booked_tickets)
    elif key == "flight":
        j = _priced_bookings_by_flight(ticket_prices, booked_tickets)
    elif key == "valid":
        j = _priced_bookings_on_date(ticket_prices, booked_tickets)
    else:
        raise ValueError(f"unknown key mode {key!r}")
    n = F.col("_n")
    j = j.withColumns({"year": year_of("start_date"), "month": month_of("start_date")})
    measures = [F.sum((F.col("ticket_price") + F.col("luggage_fee")) * n).alias("class_revenue"),
                F.sum(F.col("ticket_price") * n).alias("price_sum"),
                F.sum(F.when(F.col("ticket_price").isNotNull(), n)).alias("price_n")]
    if per_passenger == "distinct":
        # (month, class, passenger) grain; a passenger's first row in a month
        # is marked so distinct passengers sum up in the class aggregate below.
        fine = j.groupBy(*PERIOD, "ticket_class", "customer_passport_id").agg(*measures)
        first = F.row_number().over(Window.partitionBy(*PERIOD, "customer_passport_id")
                                    .orderBy(F.col("ticket_class").asc_nulls_last()))
        fine = fine.withColumn("_first", F.when(F.col("customer_passport_id").isNotNull() & (first == 1), 1)
                               .otherwise(0))
        by_class = fine.groupBy(*PERIOD, "ticket_class").agg(
            F.sum("class_revenue").alias("class_revenue"), F.sum("price_sum").alias("price_sum"),
            F.sum("price_n").alias("price_n"), F.sum("_first").alias("passengers"))
    else:
        by_class = j.groupBy(*PERIOD, "ticket_class").agg(*measures, F.lit(None).cast("bigint").alias("passengers"))
    # One window pass over the (month, class) frame yields the month totals and
    # the top class together, so the priced join feeds a single consumer.
    w = Window.partitionBy(*PERIOD)
    ranked = by_class.select(
        *PERIOD, "ticket_class",
        F.sum("class_revenue").over(w).alias("_total"), F.sum("price_sum").over(w).alias("_psum"),
        F.sum("price_n").over(w).alias("_pn"), F.sum("passengers").over(w).alias("_pax"),
        F.row_number().over(w.orderBy(F.col("class_revenue").desc_nulls_last(),
                                      F.col("ticket_class").asc_nulls_last())).alias("_rn"))
    month = ranked.where(F.col("_rn") == 1).select(
        *PERIOD, F.col("ticket_class").alias("max_revenue_class"),
        F.col("_total").cast("double").alias("total_revenue"),
        F.try_divide(F.col("_psum").cast("double"), F.col("_pn")).alias("average_ticket_price"),
        "_pax")
    if per_passenger == "distinct":
        month = month.withColumn("revenue_per_passenger", safe_ratio("total_revenue", "_pax"))
    else:
        month = month.withColumn("revenue_per_passenger", F.col("total_revenue") / F.lit(1))
    rate = cancelation_rate.select(*PERIOD, "cancelation_rate")
    out = (month.join(rate, PERIOD, "left")
           .withColumn("revenue_id", _key(id_mode, "revenue", "year", "month")))
    return _finish(out, ["revenue_id", "max_revenue_class", "total_revenue", "revenue_per_passenger",
                         "average_ticket_price", "cancelation_rate", "year", "month"], audit)


def build_monthly_most_popular(booked_tickets: DataFrame, flights: DataFrame, routes: DataFrame,
                               key: str = "literal", method: str = "literal", id_mode: str = "hash",
                               audit: bool = True) -> DataFrame:
    """Most popular origin, destination and order method per booking month.

    ``key="literal"`` joins booking id to flight id (reference); ``"flight"``
    uses the booking's own ``flight_id``. ``method="literal"`` reports the
    constant ``"online"`` (reference), ``"column"`` the real order method.
    The booking ⋈ flight ⋈ route join is counted once at (month, origin,
    destination, method) grain and all three rankings come from one
    grouping-sets pass over that small frame, so the join runs once.
    """
    return popular_of(booked_routes(booked_tickets, flights, routes, key, method), id_mode, audit)


def booked_routes(booked_tickets: DataFrame, flights: DataFrame, routes: DataFrame, key: str = "literal",
                  method: str = "literal") -> DataFrame:
    """Bookings (``_w``) per booking month, origin, destination and order method."""
    bkey = "booked_ticket_id" if key == "literal" else "flight_id"
    m = F.lit(schema.ORDER_METHOD_LITERAL) if method == "literal" else F.col("order_method")
    b = booked_tickets.select(F.col(bkey).alias("_fid"), year_of("booking_date").alias("year"),
                              month_of("booking_date").alias("month"), m.alias("method"))
    if key == "literal":
        b = b.withColumn("_w", F.lit(1).cast("bigint"))  # one booking per id: nothing to pre-aggregate
    else:
        # many bookings per flight: count them per (flight, month, method) map-side
        # before the join, so a hot flight joins as a handful of rows
        b = b.groupBy("_fid", *PERIOD, "method").agg(F.count(F.lit(1)).alias("_w"))
    f = flights.select(F.col("flight_id").alias("_fid"), "routes_id")
    r = routes.select("routes_id", "airport_origin", "airport_destination")
    j = b.join(f, "_fid").join(r, "routes_id")
    return j.groupBy(*PERIOD, "airport_origin", "airport_destination", "method").agg(F.sum("_w").alias("_w"))


def popular_of(counts: DataFrame, id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Most popular origin, destination and method per month of ``booked_routes`` counts."""
    out = most_frequent_many(counts, PERIOD, {"airport_origin": "most_popular_origin",
                                              "airport_destination": "most_popular_destination",
                                              "method": "most_popular_order_method"}, weight="_w")
    out = out.withColumn("metrics_id", _key(id_mode, "most_popular", "year", "month"))
    return _finish(out, ["metrics_id", "most_popular_origin", "most_popular_destination",
                         "most_popular_order_method", "year", "month"], audit)


def _four_dims(delays: DataFrame, flight_info: DataFrame, revenue: DataFrame, popular: DataFrame) -> DataFrame:
    return align_periods([flight_info, revenue, delays, popular], PERIOD)


def build_performance_report(delays: DataFrame, flight_info: DataFrame, revenue: DataFrame, popular: DataFrame,
                             id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Star-schema fact: the four monthly dimension ids for months present in all four."""
    j = _four_dims(delays.select(*PERIOD, "delays_id"), flight_info.select(*PERIOD, "flights_info_id"),
                   revenue.select(*PERIOD, "revenue_id"), popular.select(*PERIOD, "metrics_id"))
    out = j.withColumn("report_id", _key(id_mode, "report", "year", "month"))
    return _finish(out, ["report_id", "revenue_id", "flights_info_id", "metrics_id", "delays_id", "year", "month"],
                   audit)


def build_monthly_aggregates(delays: DataFrame, flight_info: DataFrame, revenue: DataFrame, popular: DataFrame,
                             id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Flat monthly KPI table from the four dimensions."""
    j = _four_dims(delays.select(*PERIOD, "average_delay"), flight_info.select(*PERIOD, "total_flights"),
                   revenue.select(*PERIOD, "total_revenue"),
                   popular.select(*PERIOD, "most_popular_destination", "most_popular_order_method"))
    out = j.withColumn("aggregate_id", _key(id_mode, "aggregate", "year", "month"))
    return _finish(out, ["aggregate_id", "year", "month", "total_flights", "total_revenue", "average_delay",
                         "most_popular_destination", "most_popular_order_method"], audit)


def build_ml_routes(routes: DataFrame, flights: DataFrame, id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Average scheduled flight time per route.

    Flights are aggregated per ``routes_id`` first (partial aggregation), then
    joined to the route dimension; ``route_id`` is a stable hash of
    ``routes_id`` and both are kept so the training fact can join.
    """
    per_route = flights.groupBy("routes_id").agg(F.avg(minutes_between("scheduled_departure", "scheduled_arrival"))
                                                 .alias("time_of_flight"))
    r = routes.select("routes_id", "airport_origin", "airport_destination", "distance_km")
    out = r.join(per_route, "routes_id").withColumn("route_id", _key(id_mode, "route", "routes_id"))
    return _finish(out, ["route_id", "routes_id", "airport_origin", "airport_destination", "time_of_flight",
                         "distance_km"], audit)


def build_ml_weather(weather_summary: DataFrame, flights: DataFrame | None = None,
                     waypoints: DataFrame | None = None, id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Per majority weather condition: flight count and average conditions.

    ``average_height`` is NULL unless flights and waypoints are given; then it
    is the mean over flights of their route's average waypoint height.
    """
    ws = weather_summary
    if flights is not None and waypoints is not None:
        h = waypoints.groupBy(F.col("route_id").alias("routes_id")).agg(F.avg("point_height").alias("_h"))
        fr = flights.select("flight_id", "routes_id").join(h, "routes_id", "left").select("flight_id", "_h")
        ws = ws.join(fr, "flight_id", "left")
        height = F.avg("_h")
    else:
        height = F.lit(None).cast("double")
    agg = ws.groupBy("majority_weather_condition").agg(
        F.count(F.lit(1)).alias("number_of_most_common_condition"),
        height.alias("average_height"),
        *[F.avg(c).alias(c) for c in ["average_temperature", "average_humidity", "average_wind_speed",
                                      "average_wind_direction"]],
    )
    out = agg.withColumn("weather_id", _key(id_mode, "weather", "majority_weather_condition"))
    return _finish(out, ["weather_id", "majority_weather_condition", "number_of_most_common_condition",
                         "average_height", "average_temperature", "average_humidity", "average_wind_speed",
                         "average_wind_direction"], audit)


def build_ml_boarding_data(flights: DataFrame, id_mode: str = "hash", audit: bool = True) -> DataFrame:
    """Fleet-wide capacity maxima: a global aggregate, exactly one row."""
    agg = flights.agg(F.max("possible_passenger_amount").alias("max_passenger_capacity"),
                      F.max("possible_luggage_weight").alias("max_luggage_weight_capacity"))
    out = agg.withColumn("boarding_data_id", _key(id_mode, "boarding"))
    return _finish(out, ["boarding_data_id", "max_passenger_capacity", "max_luggage_weight_capacity"], audit)


def build_ml_training(flights: DataFrame, flights_events: DataFrame, routes_dim: DataFrame,
                      weather_dim: DataFrame, boarding_dim: DataFrame, weather: str = "first",
                      weather_summary: DataFrame | None = None, id_mode: str = "hash",
                      audit: bool = True) -> DataFrame:
    """One training row per actual departure.

    delay = (epoch(actual) − epoch(scheduled)) / 60; route id by left join on
    ``routes_id``; boarding id = the (single) boarding dimension row;
    weather id = smallest id (``weather="first"``, the reference's one-row
    pick made deterministic) or, with ``"per_flight"``, the id of the
    flight's own majority condition. Single-row picks are attached with a
    broadcast join instead of a driver-side ``collect``.
    """
    j = _departures(flights.select("flight_id", "routes_id", "scheduled_departure"), flights_events)
    j = j.withColumn("delay_in_minutes", minutes_between("scheduled_departure", "event_time"))
    j = j.join(routes_dim.select("routes_id", "route_id"), "routes_id", "left")
    if weather == "per_flight":
        if weather_summary is None:
            raise ValueError("weather='per_flight' needs weather_summary")
        cond = weather_summary.select("flight_id", "majority_weather_condition")
        wid = weather_dim.select("majority_weather_condition", "weather_id")
        j = j.join(cond, "flight_id", "left").join(wid, "majority_weather_condition", "left")
    else:
        j = attach_scalar(j, weather_dim, ["weather_id"])
    j = attach_scalar(j, boarding_dim, ["boarding_data_id"])
    out = j.withColumn("training_set_id", _key(id_mode, "training", "flight_event_id"))
    return _finish(out, ["training_set_id", "weather_id", "route_id", "boarding_data_id", "delay_in_minutes"], audit)
