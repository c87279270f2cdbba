"""Named queries over a scale-factor directory of the driver's test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``: it derives the airline
tables from the test tables (``sources.fixtures``) and runs one builder or
operator over the whole tables. Audit columns are left out so results are
comparable with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schema
from contrail.plans import gold, partials, quality, runs, silver
from contrail.schema import BRONZE_SCHEMAS
from contrail.session import materialize
from contrail.sources.fixtures import Airline, bronze_tables
from contrail.sources.layout import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
#: Load time of the tables that queries check or compare.
LOAD_TIME = "2024-02-03 04:05:06"


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def bronze(df: DataFrame, table: str) -> DataFrame:
    """Present a silver-shaped fixture with the bronze physical column names."""
    return df.withColumnsRenamed(schema.BRONZE_NAMES[table])


# ---------------------------------------------------------------- silver
@query("silver_routes")
def q_silver_routes(spark, d):
    return silver.build_silver_routes(bronze(Airline(spark, d).routes, "silver_routes"), audit=False)


@query("silver_flights")
def q_silver_flights(spark, d):
    raw = bronze(Airline(spark, d).flights, "silver_flights").drop("flight_date")
    return silver.build_silver_flights(raw, audit=False)


@query("silver_waypoints")
def q_silver_waypoints(spark, d):
    t = "silver_waypoint_sampling_weather_points"
    return silver.build_silver_waypoints(bronze(Airline(spark, d).waypoints, t), audit=False)


@query("silver_ticket_prices")
def q_silver_ticket_prices(spark, d):
    return silver.build_silver_ticket_prices(bronze(Airline(spark, d).ticket_prices, "silver_ticket_prices"),
                                             audit=False)


@query("silver_customers")
def q_silver_customers(spark, d):
    return silver.build_silver_customers(bronze(Airline(spark, d).customers, "silver_customers"), audit=False)


@query("silver_flights_events")
def q_silver_flights_events(spark, d):
    return silver.build_silver_flights_events(bronze(Airline(spark, d).flights_events, "silver_flights_events"),
                                              audit=False)


@query("silver_booked_tickets")
def q_silver_booked_tickets(spark, d):
    return silver.build_silver_booked_tickets(bronze(Airline(spark, d).booked_tickets, "silver_booked_tickets"),
                                              audit=False)


@query("silver_ticket_events")
def q_silver_ticket_events(spark, d):
    return silver.build_silver_ticket_events(Airline(spark, d).ticket_events, audit=False)


@query("silver_boarding_summary")
def q_boarding_summary(spark, d):
    return silver.build_boarding_summary(Airline(spark, d).boarding_events, audit=False)


@query("silver_flight_weather")
def q_flight_weather(spark, d):
    a = Airline(spark, d)
    return silver.build_flight_weather(a.weather_raw, a.waypoints, a.flights, audit=False)


@query("silver_weather_summary")
def q_weather_summary(spark, d):
    return silver.build_weather_summary(Airline(spark, d).flight_weather, audit=False)


@query("silver_weather_summary_from_samples")
def q_weather_summary_from_samples(spark, d):
    """T13 from T12's own inputs, without building their product."""
    a = Airline(spark, d)
    return silver.build_weather_summary_from_samples(a.weather_raw, a.waypoints, a.flights, audit=False)


@query("silver_delay_reasons")
def q_delay_reasons(spark, d):
    a = Airline(spark, d)
    return silver.build_delay_reasons(a.flights_events, a.flights, audit=False)


@query("silver_cancelation_rate")
def q_cancelation_rate(spark, d):
    a = Airline(spark, d)
    return silver.build_cancelation_rate(a.booked_tickets, a.ticket_events, audit=False)


@query("bronze_clean_flights")
def q_clean_flights(spark, d):
    return silver.build_clean_flights(Airline(spark, d).legacy_flights)


# ---------------------------------------------------------------- gold
def _delays(a: Airline, reason_path: str = "columns") -> DataFrame:
    reasons = silver.build_delay_reasons(a.flights_events, a.flights, audit=False)
    return gold.build_monthly_delays(a.flights, a.flights_events, reasons, reason_path=reason_path, audit=False)


def _flight_info(a: Airline) -> DataFrame:
    return gold.build_monthly_flight_info(a.flights, silver.build_boarding_summary(a.boarding_events, audit=False),
                                          audit=False)


def _revenue(a: Airline, key: str) -> DataFrame:
    rate = silver.build_cancelation_rate(a.booked_tickets, a.ticket_events, audit=False)
    return gold.build_monthly_revenue(a.ticket_prices, a.booked_tickets, rate, key=key, audit=False)


def _popular(a: Airline, key: str, method: str) -> DataFrame:
    return gold.build_monthly_most_popular(a.booked_tickets, a.flights, a.routes, key=key, method=method, audit=False)


@query("monthly_delays")
def q_monthly_delays(spark, d):
    return _delays(Airline(spark, d))


@query("monthly_delays_event_path")
def q_monthly_delays_join(spark, d):
    return _delays(Airline(spark, d), reason_path="join")


@query("monthly_flight_info")
def q_monthly_flight_info(spark, d):
    return _flight_info(Airline(spark, d))


@query("monthly_revenue_literal")
def q_revenue_literal(spark, d):
    return _revenue(Airline(spark, d), "literal")


@query("monthly_revenue_by_flight")
def q_revenue_by_flight(spark, d):
    return _revenue(Airline(spark, d), "flight")


@query("monthly_revenue_valid_price")
def q_revenue_valid(spark, d):
    """T20 with every booking at the price in force on its booking date."""
    return _revenue(Airline(spark, d), "valid")


@query("price_at_booking")
def q_price_at_booking(spark, d):
    """Every booking with the price in force for its flight and class on the booking date, if any."""
    a = Airline(spark, d)
    return gold.price_at_booking(a.ticket_prices, a.booked_tickets).select(
        "booked_ticket_id", "flight_id", "ticket_class", "booking_date", "price_id", "ticket_price", "luggage_fee", "start_date")


@query("unpriced_bookings_on_date")
def q_unpriced_on_date(spark, d):
    a = Airline(spark, d)
    return gold.unpriced_bookings(a.ticket_prices, a.booked_tickets, on_date=True)


@query("monthly_most_popular_literal")
def q_popular_literal(spark, d):
    return _popular(Airline(spark, d), "literal", "literal")


@query("monthly_most_popular")
def q_popular(spark, d):
    return _popular(Airline(spark, d), "flight", "column")


def _loads(df: DataFrame, key: str, day: str) -> dict[str, DataFrame]:
    """The whole table as three loads: by its date, but for a tenth of the rows and those without a date, which arrive last."""
    late = F.col(day).isNull() | (F.pmod(F.xxhash64(key), F.lit(10)) == 0)
    return {"base": df.where(~late & (F.year(day) < 1998)), "next": df.where(~late & (F.year(day) >= 1998)), "late": df.where(late)}


@query("monthly_delays_by_loads")
def q_delays_by_loads(spark, d):
    """T16, T18 from partials: events in three loads, one of them run twice; read back from the mart."""
    a, layout = Airline(spark, d), _new_layout(spark)
    loads = _loads(a.flights_events, "flight_event_id", "event_time")
    for name in ("base", "late", "next", "late"):
        partials.add_delays(spark, layout, name, loads[name], a.flights, audit=False)
    return read_table(spark, layout, "gold", "gold_dim_monthly_delays")


@query("monthly_most_popular_by_loads")
def q_popular_by_loads(spark, d):
    """T21, F9 from label counts: bookings in three loads, one of them run twice; read back from the mart."""
    a, layout = Airline(spark, d), _new_layout(spark)
    loads = _loads(a.booked_tickets, "booked_ticket_id", "booking_date")
    for name in ("base", "late", "next", "late"):
        partials.add_bookings(spark, layout, name, loads[name], a.flights, a.routes, audit=False)
    return read_table(spark, layout, "gold", "gold_dim_monthly_most_popular")


def _dims(a: Airline):
    return _delays(a), _flight_info(a), _revenue(a, "literal"), _popular(a, "literal", "literal")


@query("monthly_performance_report")
def q_report(spark, d):
    return gold.build_performance_report(*_dims(Airline(spark, d)), audit=False)


@query("monthly_aggregates")
def q_aggregates(spark, d):
    return gold.build_monthly_aggregates(*_dims(Airline(spark, d)), audit=False)


@query("ml_routes")
def q_ml_routes(spark, d):
    a = Airline(spark, d)
    return gold.build_ml_routes(a.routes, a.flights, audit=False)


def _ml_weather(a: Airline) -> DataFrame:
    ws = silver.build_weather_summary(a.flight_weather, audit=False)
    return gold.build_ml_weather(ws, a.flights, a.waypoints, audit=False)


@query("ml_weather")
def q_ml_weather(spark, d):
    return _ml_weather(Airline(spark, d))


@query("ml_weather_from_samples")
def q_ml_weather_from_samples(spark, d):
    """T12's inputs to T13 to T25."""
    a = Airline(spark, d)
    ws = silver.build_weather_summary_from_samples(a.weather_raw, a.waypoints, a.flights, audit=False)
    return gold.build_ml_weather(ws, a.flights, a.waypoints, audit=False)


@query("unpriced_bookings")
def q_unpriced(spark, d):
    a = Airline(spark, d)
    return gold.unpriced_bookings(a.ticket_prices, a.booked_tickets)


@query("ml_boarding_data")
def q_ml_boarding(spark, d):
    return gold.build_ml_boarding_data(Airline(spark, d).flights, audit=False)


def _training(a: Airline, weather: str) -> DataFrame:
    routes_dim = gold.build_ml_routes(a.routes, a.flights, audit=False)
    boarding_dim = gold.build_ml_boarding_data(a.flights, audit=False)
    ws = silver.build_weather_summary(a.flight_weather, audit=False)
    weather_dim = gold.build_ml_weather(ws, a.flights, a.waypoints, audit=False)
    return gold.build_ml_training(a.flights, a.flights_events, routes_dim, weather_dim, boarding_dim,
                                  weather=weather, weather_summary=ws, audit=False)


@query("ml_training")
def q_ml_training(spark, d):
    return _training(Airline(spark, d), "first")


@query("ml_training_per_flight")
def q_ml_training_pf(spark, d):
    return _training(Airline(spark, d), "per_flight")


# ---------------------------------------------------------------- data quality
class LazyTables(Mapping):
    """Name → DataFrame, built on first use (a rule set that touches three
    tables never plans the other twenty)."""

    def __init__(self, factories: dict):
        self._f, self._built = factories, {}

    def __getitem__(self, name):
        if name not in self._built:
            self._built[name] = self._f[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._f)

    def __len__(self):
        return len(self._f)


def silver_tables(a: Airline) -> LazyTables:
    """The thirteen silver tables built from the fixtures (no audit column)."""
    return LazyTables({
        "silver_routes": lambda: a.routes, "silver_flights": lambda: a.flights,
        "silver_waypoint_sampling_weather_points": lambda: a.waypoints,
        "silver_ticket_prices": lambda: a.ticket_prices, "silver_customers": lambda: a.customers,
        "silver_flights_events": lambda: a.flights_events,
        "silver_boarding_summary": lambda: silver.build_boarding_summary(a.boarding_events, audit=False),
        "silver_agg_frequent_delay_reasons": lambda: silver.build_delay_reasons(a.flights_events, a.flights,
                                                                                audit=False),
        "silver_flight_weather": lambda: silver.build_flight_weather(a.weather_raw, a.waypoints, a.flights,
                                                                     audit=False),
        "silver_weather_summary": lambda: silver.build_weather_summary(a.flight_weather, audit=False),
        "silver_agg_cancelation_rate": lambda: silver.build_cancelation_rate(a.booked_tickets, a.ticket_events,
                                                                             audit=False),
        "silver_ticket_events": lambda: a.ticket_events, "silver_booked_tickets": lambda: a.booked_tickets,
    })


def gold_tables(a: Airline, dims: Callable[[], Mapping] | None = None) -> LazyTables:
    """The ten gold tables built from the fixtures (reference key modes);
    facts and aggregates join the dimensions of ``dims()``, by default these."""
    class Dims:
        def __getitem__(self, name):
            return (dims() if dims else built)[name].drop("ingestion_time")

    t = Dims()

    def ws():
        return silver.build_weather_summary(a.flight_weather, audit=False)

    built = LazyTables({
        "gold_dim_monthly_delays": lambda: _delays(a),
        "gold_dim_monthly_flight_info": lambda: _flight_info(a),
        "gold_dim_monthly_revenue": lambda: _revenue(a, "literal"),
        "gold_dim_monthly_most_popular": lambda: _popular(a, "literal", "literal"),
        "gold_fact_monthly_performance_report": lambda: gold.build_performance_report(*_dims_of(t), audit=False),
        "gold_monthly_aggregates": lambda: gold.build_monthly_aggregates(*_dims_of(t), audit=False),
        "gold_dim_ml_routes": lambda: gold.build_ml_routes(a.routes, a.flights, audit=False),
        "gold_dim_ml_weather": lambda: gold.build_ml_weather(ws(), a.flights, a.waypoints, audit=False),
        "gold_dim_ml_boarding_data": lambda: gold.build_ml_boarding_data(a.flights, audit=False),
        "gold_fact_ml_training": lambda: gold.build_ml_training(
            a.flights, a.flights_events, t["gold_dim_ml_routes"], t["gold_dim_ml_weather"],
            t["gold_dim_ml_boarding_data"], audit=False),
    })
    return built


def _dims_of(t):
    return (t["gold_dim_monthly_delays"], t["gold_dim_monthly_flight_info"], t["gold_dim_monthly_revenue"],
            t["gold_dim_monthly_most_popular"])


def recomputed_tables(a: Airline) -> LazyTables:
    """Detail-level monthly totals recomputed from silver, for consistency checks."""
    def counts():
        scanned = (a.boarding_events.where(F.col("event_type") == schema.BOARDING_SCAN)
                   .select("flight_id").distinct())
        return (a.flights.join(scanned, "flight_id")
                .groupBy(F.year("flight_date").cast("int").alias("year"),
                         F.month("flight_date").cast("int").alias("month"))
                .agg(F.count(F.lit(1)).alias("total_flights")))

    def revenue():
        p, b = a.ticket_prices, a.booked_tickets.select(F.col("booked_ticket_id").alias("silver_flight_id"))
        return (p.join(b, "silver_flight_id")
                .groupBy(F.year("start_date").cast("int").alias("year"),
                         F.month("start_date").cast("int").alias("month"))
                .agg(F.sum(F.col("ticket_price") + F.col("luggage_fee")).cast("double").alias("total_revenue")))

    return LazyTables({"recomputed_flight_counts": counts, "recomputed_revenue": revenue})


def consistency_rules() -> list:
    return [quality.consistent("gold_dim_monthly_flight_info", ("year", "month"), "total_flights",
                               "recomputed_flight_counts", "total_flights"),
            quality.consistent("gold_dim_monthly_revenue", ("year", "month"), "total_revenue",
                               "recomputed_revenue", "total_revenue", tol=1e-6)]


# name -> (layer, rule factory); layer decides which tables are built.
DQ_SETS = {
    "dq_bronze": ("bronze", lambda: quality.select_rules(quality.bronze_rules(BRONZE_SCHEMAS), *quality.ROW_KINDS)),
    "dq_not_null": ("silver", lambda: quality.select_rules(quality.silver_rules(), "not_null")),
    "dq_range": ("silver", lambda: quality.select_rules(quality.silver_rules(), "range")),
    "dq_bounds": ("silver", lambda: quality.select_rules(quality.silver_rules(), "min", "max")),
    "dq_pk_unique": ("silver", lambda: quality.select_rules(quality.silver_rules(), "unique")),
    "dq_fk": ("silver", lambda: quality.select_rules(quality.silver_rules(), "fk")),
    "dq_enum": ("silver", lambda: quality.select_rules(quality.silver_rules(), "enum")),
    "dq_order": ("silver", lambda: quality.select_rules(quality.silver_rules(), "order")),
    "dq_derived": ("silver", lambda: quality.select_rules(quality.silver_rules(), "derived")),
    "dq_rate": ("all", lambda: [r for r in quality.silver_rules() + quality.gold_rules()
                                if r.kind == "range" and r.columns[0].endswith("rate")]),
    "dq_kpi_not_null": ("gold", lambda: quality.select_rules(quality.gold_rules(), "not_null")),
    "dq_dim_completeness": ("gold", quality.completeness_rules),
    "dq_dim_keys": ("gold", lambda: quality.select_rules(quality.gold_rules(), "unique")),
    "dq_aggregate_consistency": ("all", consistency_rules),
    "dq_date_logic": ("silver", quality.date_logic_rules),
    "dq_silver_report": ("silver", lambda: [r for r in quality.silver_rules() if r.kind not in ("required", "types")]),
    "dq_gold_report": ("gold", lambda: [r for r in quality.gold_rules() if r.kind not in ("required", "types")]),
}


#: Tables that take joins or aggregation to build, by the start of their names.
BUILT = ("silver_boarding_summary", "silver_agg", "silver_flight_weather", "silver_weather_summary", "gold_")
#: What gold facts and aggregates read.
FACT_DIMS = {"gold_fact_monthly_performance_report": runs.MONTHLY[:4], "gold_monthly_aggregates": runs.MONTHLY[:4],
             "gold_fact_ml_training": runs.ML[:3]}


def _dq_tables(spark, a: Airline, layer: str, rules) -> Mapping:
    """A layer's tables as a layer run leaves them, with a fixed load time.

    A built table that more than one pass or table reads is written once, all such tables at the same time
    where they don't need each other; one that is read once, for all its rows and keys together, is checked as
    it is built, with its columns pruned.
    """
    from contrail.plans.graph import WRITTEN, LayerRunError, Step, run_graph

    if layer == "bronze":
        return LazyTables({n: lambda df=df: df.withColumn("ingestion_time", F.lit(LOAD_TIME).cast("timestamp"))
                           for n, df in bronze_tables(a).items()})
    at_hand: dict[str, DataFrame] = {}
    sources: dict[str, Callable[[], DataFrame]] = {}
    if layer in ("silver", "all"):
        sources.update(silver_tables(a)._f)
    if layer in ("gold", "all"):
        sources.update(gold_tables(a, lambda: tables)._f)
    if layer == "all":
        sources.update(recomputed_tables(a)._f)

    def load(name: str) -> DataFrame:
        return at_hand[name] if name in at_hand else sources[name]().withColumn("ingestion_time", F.lit(LOAD_TIME).cast("timestamp"))

    tables = LazyTables({n: lambda n=n: load(n) for n in sources})
    uses = quality.table_uses(rules, one_pass=True)
    for fact, dims in FACT_DIMS.items():
        if fact in uses:
            uses.update({n: uses.get(n, 0) + 1 for n in dims})
    shared = [n for n, times in uses.items() if times > 1 and n in sources and n.startswith(BUILT)]

    def write(name: str):
        def run(written):
            at_hand.update(written)
            return materialize(spark, load(name), name)
        return run

    done = run_graph(spark, [Step(n, write(n), tuple(d for d in FACT_DIMS.get(n, ()) if d in shared)) for n in shared])
    if any(o.status != WRITTEN for o in done.values()):
        raise LayerRunError(done)
    at_hand.update({n: o.table for n, o in done.items()})
    tables._built.clear()
    return tables


def _register_dq(name: str, layer: str, factory) -> None:
    @query(name)
    def _q(spark, d):
        rules = factory()
        return quality.run_checks(spark, _dq_tables(spark, Airline(spark, d), layer, rules), rules, one_pass=True)


for _name, (_layer, _factory) in DQ_SETS.items():
    _register_dq(_name, _layer, _factory)


# ---------------------------------------------------------------- streaming
def _run_stream(spark: SparkSession, payload: DataFrame, schema_, ts_cols, ts_type="timestamp",
                quarantine=False, name="stream") -> tuple[DataFrame, DataFrame | None]:
    """Land ``payload`` as message files, stream them through the ingest with
    an ``available_now`` trigger, and read the sinks back."""
    from contrail.session import scratch_path
    from contrail.streaming import ingest

    base = scratch_path(spark, name)
    payload.write.text(f"{base}/in")
    src = ingest.stream_source(spark, "text", path=f"{base}/in")
    qs = ingest.ingest_json_topic(spark, src, schema_, ts_cols, f"{base}/out", f"{base}/chk",
                                  trigger="available_now", ts_type=ts_type,
                                  quarantine=f"{base}/bad" if quarantine else None)
    ingest.run_to_completion(qs)
    out = spark.read.parquet(f"{base}/out")
    bad = spark.read.parquet(f"{base}/bad") if quarantine else None
    return out, bad


@query("stream_user_events")
def q_stream_users(spark, d):
    from contrail.streaming.ingest import USER_EVENT_SCHEMA
    out, _ = _run_stream(spark, Airline(spark, d).users_json, USER_EVENT_SCHEMA, ["event_ts"], name="users")
    return out


@query("stream_flights")
def q_stream_flights(spark, d):
    from contrail.streaming.ingest import FLIGHT_EVENT_SCHEMA
    out, _ = _run_stream(spark, Airline(spark, d).flights_json, FLIGHT_EVENT_SCHEMA,
                         ["scheduled_departure", "scheduled_arrival"], ts_type="timestamp_ntz", name="flights")
    return out


@query("stream_quarantine")
def q_stream_quarantine(spark, d):
    from contrail.streaming.ingest import USER_EVENT_SCHEMA
    _, bad = _run_stream(spark, Airline(spark, d).users_json_dirty, USER_EVENT_SCHEMA, ["event_ts"],
                         quarantine=True, name="quarantine")
    return bad


@query("stream_dedup")
def q_stream_dedup(spark, d):
    """Repeated deliveries dropped, over four micro-batches that each span the
    whole month, so most rows of the later ones are days late: every distinct
    message is kept once. A repeat is recognised by the whole message: two
    distinct events can share a user and a second."""
    from contrail.session import scratch_path
    from contrail.sources.layout import Layout, read_table
    from contrail.streaming import ingest
    base = scratch_path(spark, "dedup")
    Airline(spark, d).users_json_repeated.repartition(4).write.text(f"{base}/in")
    layout = Layout(warehouse=f"{base}/lake")
    ingest.run_to_completion(ingest.ingest_user_events(
        spark, layout, source=ingest.stream_source(spark, "text", path=f"{base}/in", per_trigger=1), trigger="available_now", dedup=True))
    return read_table(spark, layout, "bronze", "events_raw")


# ---------------------------------------------------------------- generic operators
@query("top_n_per_group")
def q_top_n(spark, d):
    """The three longest scheduled flights of every route."""
    from contrail.functions.columns import minutes_between
    from contrail.operators.ranking import top_n_per_group
    f = Airline(spark, d).flights.select(
        "routes_id", "flight_id", minutes_between("scheduled_departure", "scheduled_arrival").alias("minutes"))
    return top_n_per_group(f, ["routes_id"], [F.col("minutes").desc(), F.col("flight_id").asc()], 3,
                           rank_col="rank")


@query("most_frequent")
def q_most_frequent(spark, d):
    """Most common nationality in each membership tier, with its count."""
    from contrail.operators.ranking import most_frequent
    c = Airline(spark, d).customers
    return most_frequent(c, ["customer_membership_tier"], "customer_nationality", "top_nationality",
                         count_col="customers")


@query("align_periods")
def q_align_periods(spark, d):
    """Bookings/cancelations and boarded flights side by side for every month
    present in either table (full outer alignment)."""
    from contrail.operators.joins import align_periods
    a = Airline(spark, d)
    rate = silver.build_cancelation_rate(a.booked_tickets, a.ticket_events, audit=False)
    info = _flight_info(a)
    return align_periods([rate.select("year", "month", "total_booking", "total_cancelation"),
                          info.select("year", "month", "total_flights")], how="full")


@query("latest_per_key")
def q_latest(spark, d):
    """One boarding event per (non-unique) event id: the latest scan."""
    from contrail.operators.ranking import latest_per_key
    e = Airline(spark, d).boarding_events
    order = [F.col("event_time").desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in
                                                       ["flight_id", "event_type", "passenger_id", "baggage_weight"]]
    return latest_per_key(e, ["event_id"], order)


# ---------------------------------------------------------------- load time, stored layers
_CONFORMED = {
    "silver_routes": ("silver_routes", "routes", silver.build_silver_routes),
    "silver_flights": ("silver_flights", "flights", silver.build_silver_flights),
    "silver_waypoints": ("silver_waypoint_sampling_weather_points", "waypoints", silver.build_silver_waypoints),
    "silver_ticket_prices": ("silver_ticket_prices", "ticket_prices", silver.build_silver_ticket_prices),
    "silver_customers": ("silver_customers", "customers", silver.build_silver_customers),
    "silver_flights_events": ("silver_flights_events", "flights_events", silver.build_silver_flights_events),
    "silver_booked_tickets": ("silver_booked_tickets", "booked_tickets", silver.build_silver_booked_tickets),
    "silver_ticket_events": ("silver_ticket_events", "ticket_events", silver.build_silver_ticket_events),
}


def _loaded(spark, d, name: str) -> DataFrame:
    """The bronze form of a fixture, with a fixed load time."""
    table, view, _ = _CONFORMED[name]
    raw = getattr(Airline(spark, d), view)
    raw = raw if name == "silver_ticket_events" else bronze(raw, table)
    return raw.withColumn("ingestion_time", F.lit(LOAD_TIME).cast("timestamp"))


def _register_load_time(name: str) -> None:
    @query(f"{name}_load_time")
    def _q(spark, d):
        return _CONFORMED[name][2](_loaded(spark, d, name), audit=True)


for _name in _CONFORMED:
    _register_load_time(_name)


def _layer_table(spark, d, name: str, by: str) -> DataFrame:
    """A bronze table written and read by path, its silver table written and read by ``by``."""
    from contrail.session import scratch_path
    from contrail.sources.layout import Layout, ensure_layer, read_table, write_table
    import uuid
    layout = Layout(warehouse=scratch_path(spark, "layer"))
    write_table(_loaded(spark, d, name), layout, "bronze", name)
    layer = "silver" if by == "path" else f"silver_{uuid.uuid4().hex}"
    if by == "table":
        ensure_layer(spark, layout, layer)
    write_table(_CONFORMED[name][2](read_table(spark, layout, "bronze", name)), layout, layer, name, by=by)
    return read_table(spark, layout, layer, name, by=by)


@query("layer_silver_flights")
def q_layer_by_path(spark, d):
    """A1, B1: written and read by path."""
    return _layer_table(spark, d, "silver_flights", "path")


@query("layer_silver_ticket_prices")
def q_layer_by_name(spark, d):
    """A2, A3, B3, B6: written as a managed table of a fresh namespace and read by name."""
    return _layer_table(spark, d, "silver_ticket_prices", "table")


@query("orphans")
def q_orphans(spark, d):
    """E6 as rows: events whose flight is not among the larger flights."""
    from contrail.operators.joins import orphans
    a = Airline(spark, d)
    return orphans(a.flights_events, a.flights.where("possible_passenger_amount >= 100"), "flight_id").select("flight_event_id", "flight_id")


# ---------------------------------------------------------------- layer runs
def _outcomes(run, spark, layout, **options) -> DataFrame:
    return run(spark, layout, validate=False, on_failure="report", **options)["_outcomes"]


def _new_layout(spark):
    from contrail.session import scratch_path
    from contrail.sources.layout import Layout
    return Layout(warehouse=scratch_path(spark, "lake"))


@query("run_silver_layer")
def q_run_silver(spark, d):
    """R1: bronze to silver, every table as soon as its inputs are written; rows and status of each.

    Two silver tables read the weather samples, so these are joined once and stored as bronze.
    """
    from contrail.sources.layout import write_table
    layout, b, name = _new_layout(spark), bronze_tables(Airline(spark, d)), "flight_weather_raw_api"
    write_table(b[name], layout, "bronze", name)
    b[name] = read_table(spark, layout, "bronze", name)
    return _outcomes(runs.run_silver, spark, layout, bronze=b)


@query("run_gold_monthly_layer")
def q_run_gold_monthly(spark, d):
    """R3: four monthly dimensions at once, then report and aggregates from the stored ones."""
    return _outcomes(runs.run_gold_monthly, spark, _new_layout(spark), s=silver_tables(Airline(spark, d)))


@query("run_gold_ml_layer")
def q_run_gold_ml(spark, d):
    """R2: three dimensions at once, then the training fact."""
    return _outcomes(runs.run_gold_ml, spark, _new_layout(spark), s=silver_tables(Airline(spark, d)))


@query("run_gold_ml_failure")
def q_run_gold_ml_failure(spark, d):
    """B8: the silver weather lacks a column, so the weather dimension fails and the fact that needs it is
    skipped; the other two dimensions are written."""
    s = {n: t for n, t in silver_tables(Airline(spark, d)).items()
         if n in ("silver_routes", "silver_flights", "silver_flights_events", "silver_weather_summary", "silver_waypoint_sampling_weather_points")}
    s["silver_weather_summary"] = s["silver_weather_summary"].drop("average_temperature")
    return _outcomes(runs.run_gold_ml, spark, _new_layout(spark), s=s).select("table_name", "rows_written", "status", F.col("error").isNotNull().alias("has_error"))
