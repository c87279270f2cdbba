"""Airline tables derived from the driver's TPC-H-style test tables.

Each function maps the generic test tables onto one airline table shape
(silver shape unless the name says bronze). They are plain projections and
equi-joins, so Catalyst prunes columns and pushes filters into the parquet
scans, and every table grows with its source table.

The derivation rules (key arithmetic, constants, value maps) are fixed
values shared with the DuckDB oracle SQL, which states them independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (they must equal the oracle SQL):
# route ids are origin*25+destination, the step from one nation's ids to the next's.
NATIONS = 25
WAYPOINTS_PER_ROUTE = 3
DELAY_REASONS = {0: "weather", 1: "technical", 2: "crew", 3: "security"}  # key = orderkey % 5; 4 -> NULL
PRICE_CLASS = {"A": "first", "N": "business"}  # returnflag -> ticket class, else economy
BOOKING_CLASS = {0: "first", 1: "business", 2: "economy"}  # orderkey % 3
BOARDING_EVENT = {"A": "passenger_scanned", "R": "bag_loaded"}  # returnflag, else gate_closed
WEATHER = {0: "clear", 1: "rain", 2: "storm", 3: "fog"}  # suppkey % 4
TICKET_EVENT = {"purchase": "canceled", "view": "class upgrade", "click": "added luggage",
                "error": "request to cancel"}  # other event types pass through unchanged
COUNTRY = {0: "FR", 1: "DE", 2: "IL"}  # user_id % 3


class Tables:
    """Lazy parquet readers for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        """A derived airline view, built once per ``Tables`` (views reuse views)."""
        if name not in self._views:
            self._views[name] = VIEWS[name](self)
        return self._views[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:  # one footer read per table, not per use
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]


def _case(key: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(mins=n.cast("int"))


def routes(t: Tables) -> DataFrame:
    """All ordered (origin, destination) pairs of the nations in the table (25 × 24 = 600 routes).

    The fixed nation dimension is gathered into one list and paired with itself
    by two explodes: one scan, no join. Its size does not follow the data's.
    """
    n = t.nation.agg(F.collect_list(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))).alias("all"))
    j = (n.select("all", F.explode("all").alias("from")).select("from", F.explode("all").alias("to"))
         .select(F.col("from.key").alias("o"), F.col("from.name").alias("o_name"),
                 F.col("to.key").alias("d"), F.col("to.name").alias("d_name"))
         .where(F.col("o") != F.col("d")))
    o, d = F.col("o"), F.col("d")
    return j.select(
        (o * NATIONS + d).cast("string").alias("routes_id"),
        F.col("o_name").alias("airport_origin"),
        F.col("d_name").alias("airport_destination"),
        (o * 7 - 84).cast("double").alias("latitude_origin"),
        (o * 14 - 168).cast("double").alias("longitude_origin"),
        (d * 7 - 84).cast("double").alias("latitude_destination"),
        (d * 14 - 168).cast("double").alias("longitude_destination"),
        (F.abs(o - d) * 100 + 50).cast("double").alias("distance_km"),
    )


def waypoints(t: Tables) -> DataFrame:
    """Three sampling points per route: origin, midpoint (high) and destination."""
    r = t.view("routes").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(WAYPOINTS_PER_ROUTE - 1))))
    k = F.col("k")
    return r.select(
        F.col("routes_id").alias("route_id"),
        k.cast("int").alias("way_point_number"),
        (F.col("latitude_origin") + (F.col("latitude_destination") - F.col("latitude_origin")) * k / 2).alias("point_latitude"),
        (F.col("longitude_origin") + (F.col("longitude_destination") - F.col("longitude_origin")) * k / 2).alias("point_longitude"),
        F.when(k == 1, F.lit(10000)).otherwise(F.lit(500)).cast("double").alias("point_height"),
    )


def flights(t: Tables) -> DataFrame:
    """One flight per order; the route starts at the customer's nation."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    j = o.join(c, "o_custkey")
    k, n = F.col("o_orderkey"), F.col("c_nationkey")
    dep = F.col("o_orderdate") + _hours(k % 24)
    return j.select(
        k.cast("string").alias("flight_id"),
        (n * NATIONS + (n + 1 + k % 24) % NATIONS).cast("string").alias("routes_id"),
        (50 + k % 250).cast("int").alias("possible_passenger_amount"),
        (1000 + k % 9000).cast("int").alias("possible_luggage_weight"),
        F.col("o_orderdate").cast("date").alias("flight_date"),
        dep.alias("scheduled_departure"),
        (dep + _minutes(60 + k % 600)).alias("scheduled_arrival"),
    )


def legacy_flights(t: Tables) -> DataFrame:
    """Bronze flights in the legacy (origin, destination) shape.

    Four orders share one ``flight_id`` (duplicates to dedupe) and one in
    three rows flies to its own origin (rows the clean step drops).
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n_o = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("origin"))
    n_d = t.nation.select(F.col("n_nationkey").alias("_dk"), F.col("n_name").alias("destination"))
    k = F.col("o_orderkey")
    j = (o.join(c, "o_custkey").join(F.broadcast(n_o), "c_nationkey")  # 25-row fixed dimension
         .withColumn("_dk", ((F.col("c_nationkey") + k % 3) % NATIONS).cast("int"))
         .join(F.broadcast(n_d), "_dk"))
    return j.select(
        (k - k % 4).cast("string").alias("flight_id"),
        "origin", "destination",
        F.col("o_orderdate").cast("date").alias("flight_date"),
        (F.col("o_orderdate") + _hours(k % 24)).alias("departure_time"),
    )


def flights_events(t: Tables) -> DataFrame:
    """Two events per order: departure (a gate change where the status is P) and delay report."""
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    o = o.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    k = F.col("o_orderkey")
    return o.select(
        (k * 2 + F.col("k")).cast("string").alias("flight_event_id"),
        k.cast("string").alias("flight_id"),
        F.when(F.col("k") == 1, "delay_reported").when(F.col("o_orderstatus") == "P", "gate_changed")
         .otherwise("actual_departure").alias("event_type"),
        _case(k % 5, DELAY_REASONS).alias("delay_reason"),
        (F.col("o_orderdate") + _hours(k % 24) + _minutes((k * 37) % 181 - 20)).alias("event_time"),
    )


def boarding_events(t: Tables) -> DataFrame:
    """Bronze boarding events, one per line item (event_id is not unique)."""
    li = t.lineitem
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("event_id"),
        F.col("l_orderkey").cast("string").alias("flight_id"),
        _case(F.col("l_returnflag"), BOARDING_EVENT, "gate_closed").alias("event_type"),
        F.col("l_partkey").cast("string").alias("passenger_id"),
        F.col("l_quantity").cast("decimal(10,2)").alias("baggage_weight"),
        F.col("l_shipdate").alias("event_time"),
    )


def ticket_prices(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("price_id"),
        F.col("l_orderkey").cast("string").alias("silver_flight_id"),
        _case(F.col("l_returnflag"), PRICE_CLASS, "economy").alias("ticket_class"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("ticket_price"),
        F.col("l_quantity").cast("decimal(12,2)").alias("luggage_fee"),
        F.col("l_shipdate").cast("date").alias("start_date"),
        (F.col("l_shipdate") + F.make_dt_interval(days=(F.col("l_partkey") % 97 - 1).cast("int"))).cast("date").alias("end_date"),
        (F.col("l_linestatus") == "O").alias("actual"),
    )


def booked_tickets(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select(
        k.cast("string").alias("booked_ticket_id"),
        (k - k % 4).cast("string").alias("flight_id"),
        F.col("o_custkey").cast("string").alias("customer_passport_id"),
        _case(k % 3, BOOKING_CLASS).alias("ticket_class"),
        F.col("o_orderpriority").alias("order_method"),
        F.col("o_orderdate").cast("date").alias("booking_date"),
    )


def customers(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = c.join(F.broadcast(n), "c_nationkey")  # 25-row fixed dimension
    k = F.col("c_custkey")
    return j.select(
        k.cast("string").alias("customer_passport_id"),
        F.col("c_name").alias("customer_first_name"),
        F.col("c_name").alias("customer_last_name"),
        F.col("n_name").alias("customer_nationality"),
        F.when(k % 50 == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com"))).alias("customer_email"),
        F.lower("c_mktsegment").alias("customer_membership_tier"),
        F.date_add(F.lit("1960-01-01").cast("date"), (k % 15000).cast("int")).alias("customer_date_of_birth"),
    )


def ticket_events(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_id").cast("string").alias("booked_ticket_id"),
        _case(F.col("event_type"), TICKET_EVENT, F.col("event_type")).alias("event_type"),
        F.col("ts").alias("event_time"),
    )


def _weather_measures() -> list[Column]:
    q = F.col("l_quantity")
    return [
        (q - 10).alias("temperature"),
        (F.round(F.col("l_discount") * 100).cast("int") * 10).cast("double").alias("humidity"),
        (q / 2).alias("wind_speed"),
        (F.col("l_partkey") % 361).cast("double").alias("wind_direction"),
    ]


def weather_raw(t: Tables) -> DataFrame:
    """Bronze weather samples located at the coordinates of a route waypoint.

    Line items join their order on the numeric key (the flight id is only
    its string form), then the route's waypoint on (route, point number).
    """
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_partkey", "l_suppkey")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    k, n = F.col("l_orderkey"), F.col("c_nationkey")
    f = o.join(c, "o_custkey").select(
        "l_orderkey", (n * NATIONS + (n + 1 + k % 24) % NATIONS).cast("string").alias("routes_id"),
        F.col("o_orderdate").cast("date").alias("flight_date"))
    w = F.broadcast(t.view("waypoints"))  # three per pair of the 25 nations, whatever the size of the data
    j = (li.join(f, "l_orderkey")
         .join(w, (F.col("route_id") == F.col("routes_id")) & (F.col("way_point_number") == F.col("l_linenumber") % 3)))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("weather_sample_id"),
        F.col("point_latitude").alias("latitude"),
        F.col("point_longitude").alias("longitude"),
        F.col("point_height").alias("height"),
        *_weather_measures(),
        _case(F.col("l_suppkey") % 4, WEATHER).alias("current_weather_condition"),
        F.col("flight_date").alias("sample_for_date"),
    )


def flight_weather(t: Tables) -> DataFrame:
    """Silver flight weather in direct form (sample already tied to a flight)."""
    li = t.lineitem
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("weather_sample_id"),
        F.col("l_orderkey").cast("string").alias("silver_flight_id"),
        F.col("l_linenumber").alias("waypoint_sampling_number"),
        *_weather_measures(),
        _case(F.col("l_suppkey") % 4, WEATHER).alias("weather_condition"),
    )


def _user_payload(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("string")
    return t.events.select("event_type", F.concat(
        F.lit('{"event_ts":"'), F.substring(ts, 1, 10), F.lit("T"), F.substring(ts, 12, 8),
        F.lit('Z","user_id":"u'), F.col("user_id").cast("string"),
        F.lit('","name":"'), F.col("event_type"),
        F.lit('","country":"'), _case(F.col("user_id") % 3, COUNTRY), F.lit('"}'),
    ).alias("value"))


def users_json(t: Tables) -> DataFrame:
    """The user-topic message payload: one JSON document per event."""
    return _user_payload(t).select("value")


def users_json_dirty(t: Tables) -> DataFrame:
    """The same payload with damage derived from the event type: ``error``
    events arrive truncated (malformed JSON), ``signup`` events carry an
    unparseable timestamp; every other message is intact."""
    p = _user_payload(t)
    v, et = F.col("value"), F.col("event_type")
    return p.select(
        F.when(et == "error", F.expr("substring(value, 1, length(value) - 3)"))
         .when(et == "signup", F.replace(v, F.lit('"event_ts":"'), F.lit('"event_ts":"x')))
         .otherwise(v).alias("value"))


def users_json_repeated(t: Tables) -> DataFrame:
    """The payload with every ``purchase`` message delivered twice."""
    p = _user_payload(t)
    return p.select("value").unionByName(p.where(F.col("event_type") == "purchase").select("value"))


def flights_json(t: Tables) -> DataFrame:
    """The flight-topic message payload, one JSON document per flight."""
    f = t.view("flights")
    return f.select(F.to_json(F.struct(
        F.col("flight_id"),
        F.col("routes_id").alias("route_id"),
        F.date_format("scheduled_departure", "yyyy-MM-dd'T'HH:mm:ss").alias("scheduled_departure"),
        F.date_format("scheduled_arrival", "yyyy-MM-dd'T'HH:mm:ss").alias("scheduled_arrival"),
        F.col("possible_passenger_amount").alias("max_passenger_capacity"),
    )).alias("value"))


VIEWS = {
    "routes": routes, "waypoints": waypoints, "flights": flights, "flights_events": flights_events,
    "legacy_flights": legacy_flights,
    "boarding_events": boarding_events, "ticket_prices": ticket_prices, "booked_tickets": booked_tickets,
    "customers": customers, "ticket_events": ticket_events, "weather_raw": weather_raw,
    "flight_weather": flight_weather, "users_json": users_json, "flights_json": flights_json,
    "users_json_dirty": users_json_dirty, "users_json_repeated": users_json_repeated,
}


class Airline:
    """Lazy, memoised access to the fixture views: ``Airline(spark, d).flights``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tables = Tables(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS:
            raise AttributeError(name)
        return self.tables.view(name)


def bronze_tables(a: Airline) -> dict[str, DataFrame]:
    """The ten bronze tables, physical (typo'd) column names and a load time,
    derived from the fixture views — the inputs of a full layer run."""
    from contrail import schema

    def phys(df: DataFrame, table: str) -> DataFrame:
        return df.withColumnsRenamed(schema.BRONZE_NAMES[table]).withColumn("ingestion_time", F.current_timestamp())

    return {
        "routes_raw": phys(a.routes, "silver_routes"),
        "flights": phys(a.flights.drop("flight_date"), "silver_flights"),
        "route_weather_points": phys(a.waypoints, "silver_waypoint_sampling_weather_points"),
        "ticket_prices": phys(a.ticket_prices, "silver_ticket_prices"),
        "registered_customers": phys(a.customers, "silver_customers"),
        "flight_events_raw": phys(a.flights_events, "silver_flights_events"),
        "booked_tickets_raw": phys(a.booked_tickets, "silver_booked_tickets"),
        "ticket_events_raw": phys(a.ticket_events, "silver_ticket_events"),
        "flight_weather_raw_api": a.weather_raw.withColumn("ingestion_time", F.current_timestamp()),
        "boarding_events_raw": a.boarding_events.withColumn("ingestion_time", F.current_timestamp()),
    }
