"""Layer runs: build a layer from the one below, write it, validate it.

Each run writes its tables through the ``Layout`` and hands back DataFrames
re-read from storage, so the next layer starts from a materialised table —
lineage is cut at every layer boundary and a lost executor only replays the
current job. A run is a graph of steps (``plans.graph``): tables whose inputs
are stored are built at once, e.g. the three ML dimensions and then the fact.
A step that fails leaves the others written; the run then raises
``LayerRunError``, or with ``on_failure="report"`` returns what there is with
the outcomes under ``_outcomes``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from contrail.plans import gold, quality, silver
from contrail.plans.graph import WRITTEN, LayerRunError, Outcome, Step, outcome_table, run_graph
from contrail.schema import BRONZE_SCHEMAS
from contrail.session import materialize
from contrail.sources.layout import Layout, ensure_layer, read_table, write_table
from contrail.sources.synth import seed_layer

# bronze table → (silver table, builder). Builders taking more inputs follow.
_SILVER_CONFORM = {
    "routes_raw": ("silver_routes", silver.build_silver_routes),
    "flights": ("silver_flights", silver.build_silver_flights),
    "route_weather_points": ("silver_waypoint_sampling_weather_points", silver.build_silver_waypoints),
    "ticket_prices": ("silver_ticket_prices", silver.build_silver_ticket_prices),
    "registered_customers": ("silver_customers", silver.build_silver_customers),
    "flight_events_raw": ("silver_flights_events", silver.build_silver_flights_events),
    "booked_tickets_raw": ("silver_booked_tickets", silver.build_silver_booked_tickets),
    "ticket_events_raw": ("silver_ticket_events", silver.build_silver_ticket_events),
}


class _Writer:
    """Writes the tables of one layer run and validates them.

    Row-level rules of a table ride on its write as ``observe`` metrics (no
    second scan); key, FK and metadata rules run on the stored tables once
    the layer is complete.
    """

    def __init__(self, spark: SparkSession, layout: Layout, layer: str, rules=None):
        self.spark, self.layout, self.layer = spark, layout, layer
        if layout.catalog:
            ensure_layer(spark, layout, layer)
        self.rules = list(rules or [])
        self.observed: dict[str, DataFrame] = {}
        self.done: set = set()

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        if not self.layout.catalog:
            df, obs, rs = quality.observe_row_rules(df, name, self.rules)
        else:
            obs, rs = None, []  # a catalog may shuffle before the write and count a retried stage twice: check the stored table
        write_table(df, self.layout, self.layer, name)
        if rs:
            self.observed[name] = quality.observed_results(self.spark, obs, rs)
            self.done.update(rs)
        return read_table(self.spark, self.layout, self.layer, name)

    def report(self, tables: Mapping[str, DataFrame], abort: bool = False) -> DataFrame:
        rest = [r for r in self.rules if r not in self.done]
        seen = [self.observed[n] for n in sorted(self.observed)]
        out = reduce(lambda a, b: a.union(b), seen + [quality.run_checks(self.spark, tables, rest)])
        out = materialize(self.spark, out, f"{self.layer}-quality")  # checked once, read as often as wanted
        if abort:
            quality.abort_if_errors(out)
        return out


def run_bronze(spark: SparkSession, layout: Layout, seed: bool = False, n: int = 10,
               validate: bool = True, legacy: bool = False, abort: bool = False) -> DataFrame | None:
    """R4: optionally seed the bronze tables, then validate regardless
    (columns, declared types, non-NULL ids); ``abort`` raises on a failed rule."""
    if seed:
        seed_layer(spark, layout, BRONZE_SCHEMAS, n)
    if not validate:
        return None
    tables = {}
    for name in BRONZE_SCHEMAS:
        try:
            tables[name] = read_table(spark, layout, "bronze", name)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
                raise  # only a missing table is left to the required rule to report
    out = materialize(spark, quality.run_checks(spark, tables, quality.bronze_rules(BRONZE_SCHEMAS, legacy=legacy)),
                      "bronze-quality")
    if abort:
        quality.abort_if_errors(out)
    return out


def _run(spark: SparkSession, w: _Writer, steps: list[Step], workers: int, validate: bool, abort: bool,
         on_failure: str) -> dict[str, DataFrame]:
    """Run the steps, validate what was written, and tell about what was not."""
    outcomes: dict[str, Outcome] = run_graph(spark, steps, workers)
    out = {n: o.table for n, o in outcomes.items() if o.status == WRITTEN}
    failed = len(out) < len(outcomes)
    if failed and on_failure == "raise":
        raise LayerRunError(outcomes)
    if on_failure == "report":
        out["_outcomes"] = outcome_table(spark, outcomes)
    if validate:
        out["_quality"] = w.report({n: t for n, t in out.items() if not n.startswith("_")}, abort)
    return out


def _step(w: _Writer, name: str, build, *needs: str) -> Step:
    """The table ``name`` from the needed ones, in order, written and read back."""
    return Step(name, lambda t: w(name, build(*[t[n] for n in needs])), needs)


def run_silver(spark: SparkSession, layout: Layout, bronze: Mapping[str, DataFrame] | None = None,
               validate: bool = True, abort: bool = False, workers: int = 4, on_failure: str = "raise") -> dict[str, DataFrame]:
    """R1: every silver table (the six the reference builds and the seven it
    only specifies), each as soon as its inputs are written, then validated."""
    b = dict(bronze) if bronze is not None else {n: read_table(spark, layout, "bronze", n) for n in BRONZE_SCHEMAS}
    w = _Writer(spark, layout, "silver", quality.silver_rules() + quality.select_rules(
        quality.date_logic_rules(), "cross_order") if validate else None)
    steps = [_step(w, name, lambda src=src, build=build: build(b[src])) for src, (name, build) in _SILVER_CONFORM.items() if src in b]
    made = {s.name for s in steps}
    if "boarding_events_raw" in b:
        steps.append(_step(w, "silver_boarding_summary", lambda: silver.build_boarding_summary(b["boarding_events_raw"])))
    places = ("silver_waypoint_sampling_weather_points", "silver_flights")
    if "flight_weather_raw_api" in b and set(places) <= made:
        samples = b["flight_weather_raw_api"]
        steps.append(_step(w, "silver_flight_weather", lambda p, f: silver.build_flight_weather(samples, p, f), *places))
        steps.append(_step(w, "silver_weather_summary", lambda p, f: silver.build_weather_summary_from_samples(samples, p, f), *places))
    if {"silver_flights_events", "silver_flights"} <= made:
        steps.append(_step(w, "silver_agg_frequent_delay_reasons", silver.build_delay_reasons, "silver_flights_events", "silver_flights"))
    if {"silver_booked_tickets", "silver_ticket_events"} <= made:
        steps.append(_step(w, "silver_agg_cancelation_rate", silver.build_cancelation_rate, "silver_booked_tickets", "silver_ticket_events"))
    return _run(spark, w, steps, workers, validate, abort, on_failure)


MONTHLY = ["gold_dim_monthly_delays", "gold_dim_monthly_flight_info", "gold_dim_monthly_revenue",
           "gold_dim_monthly_most_popular", "gold_fact_monthly_performance_report", "gold_monthly_aggregates"]
ML = ["gold_dim_ml_routes", "gold_dim_ml_weather", "gold_dim_ml_boarding_data", "gold_fact_ml_training"]


def _gold_rules(names: list[str]) -> list:
    return [r for r in quality.gold_rules() if r.table in names and (r.kind != "fk" or r.params[0] in names)]


def run_gold_monthly(spark: SparkSession, layout: Layout, s: Mapping[str, DataFrame] | None = None,
                     revenue_key: str = "literal", popular_key: str = "literal", popular_method: str = "literal",
                     validate: bool = True, abort: bool = False, workers: int = 4, on_failure: str = "raise") -> dict[str, DataFrame]:
    """R3: the four monthly dimensions at once, then the report fact and the flat
    aggregates, which join the stored dimensions."""
    s = s or {n: read_table(spark, layout, "silver", n) for n in
              ["silver_flights", "silver_flights_events", "silver_agg_frequent_delay_reasons",
               "silver_boarding_summary", "silver_ticket_prices", "silver_booked_tickets",
               "silver_agg_cancelation_rate", "silver_routes"]}
    w = _Writer(spark, layout, "gold", _gold_rules(MONTHLY) if validate else None)
    steps = [
        _step(w, MONTHLY[0], lambda: gold.build_monthly_delays(
            s["silver_flights"], s["silver_flights_events"], s["silver_agg_frequent_delay_reasons"])),
        _step(w, MONTHLY[1], lambda: gold.build_monthly_flight_info(s["silver_flights"], s["silver_boarding_summary"])),
        _step(w, MONTHLY[2], lambda: gold.build_monthly_revenue(
            s["silver_ticket_prices"], s["silver_booked_tickets"], s["silver_agg_cancelation_rate"], key=revenue_key)),
        _step(w, MONTHLY[3], lambda: gold.build_monthly_most_popular(
            s["silver_booked_tickets"], s["silver_flights"], s["silver_routes"], key=popular_key, method=popular_method)),
        _step(w, MONTHLY[4], gold.build_performance_report, *MONTHLY[:4]),
        _step(w, MONTHLY[5], gold.build_monthly_aggregates, *MONTHLY[:4]),
    ]
    return _run(spark, w, steps, workers, validate, abort, on_failure)


def run_gold_ml(spark: SparkSession, layout: Layout, s: Mapping[str, DataFrame] | None = None,
                weather: str = "first", validate: bool = True, abort: bool = False, workers: int = 4,
                on_failure: str = "raise") -> dict[str, DataFrame]:
    """R2: routes, weather and boarding dimensions at once, then the training fact."""
    s = s or {n: read_table(spark, layout, "silver", n) for n in
              ["silver_routes", "silver_flights", "silver_flights_events", "silver_weather_summary",
               "silver_waypoint_sampling_weather_points"]}
    w = _Writer(spark, layout, "gold", _gold_rules(ML) if validate else None)
    steps = [
        _step(w, ML[0], lambda: gold.build_ml_routes(s["silver_routes"], s["silver_flights"])),
        _step(w, ML[1], lambda: gold.build_ml_weather(
            s["silver_weather_summary"], s["silver_flights"], s.get("silver_waypoint_sampling_weather_points"))),
        _step(w, ML[2], lambda: gold.build_ml_boarding_data(s["silver_flights"])),
        _step(w, ML[3], lambda routes, weather_dim, boarding: gold.build_ml_training(
            s["silver_flights"], s["silver_flights_events"], routes, weather_dim, boarding, weather=weather,
            weather_summary=s["silver_weather_summary"]), *ML[:3]),
    ]
    return _run(spark, w, steps, workers, validate, abort, on_failure)


def run_clean_flights(spark: SparkSession, layout: Layout, source: str = "flights_raw",
                      target: str = "flights_clean", key: str = "flight_id") -> DataFrame:
    """T4 as a job: bronze legacy flights → drop self-routes, one row per key → silver."""
    cleaned = silver.build_clean_flights(read_table(spark, layout, "bronze", source), key=key)
    write_table(cleaned, layout, "silver", target)
    return read_table(spark, layout, "silver", target)
