"""SQL oracle for the data-quality engine: each rule compiled to one DuckDB
scalar subquery, over CTEs that rebuild the silver and gold tables in SQL."""

from __future__ import annotations

from oracle import queries as Q
from oracle.views import with_views


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return repr(v)


def _count(rule) -> str:
    k, p, c, t = rule.kind, rule.params, rule.columns, CTE_OF.get(rule.table, rule.table)
    if p == ("missing",):
        return "SELECT NULL"
    if k == "not_null":
        cond = f"{c[0]} IS NULL"
    elif k == "range":
        cond = f"{c[0]} < {_lit(p[0])} OR {c[0]} > {_lit(p[1])}"
    elif k == "min":
        cond = f"{c[0]} {'<=' if p[1] else '<'} {_lit(p[0])}"
    elif k == "max":
        cond = f"{c[0]} > {_lit(p[0])}"
    elif k == "enum":
        cond = f"{c[0]} NOT IN ({', '.join(_lit(v) for v in p)})"
    elif k == "order":
        cond = f"{c[0]} {'>=' if p[0] else '>'} {c[1]}"
    elif k == "derived":
        cond = (f"abs(CAST({c[1]} AS DOUBLE) / NULLIF(CAST({c[2]} AS DOUBLE), 0) - CAST({c[0]} AS DOUBLE))"
                f" > {_lit(p[0])}")
    elif k == "unique":
        cols = ", ".join(c)
        return f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {cols} HAVING count(*) > 1)"
    elif k == "fk":
        parent, pcol = p
        return (f"SELECT count(*) FROM {t} x WHERE x.{c[0]} IS NULL OR NOT EXISTS "
                f"(SELECT 1 FROM {parent} y WHERE y.{pcol} = x.{c[0]})")
    elif k == "consistent":
        keys, other, ocol, tol = p
        on = " AND ".join(f"a.{key} = b.{key}" for key in keys)
        ks = ", ".join(keys)
        return (f"SELECT count(*) FROM (SELECT {ks}, CAST({c[0]} AS DOUBLE) AS va FROM {t}) a FULL OUTER JOIN "
                f"(SELECT {ks}, CAST({ocol} AS DOUBLE) AS vb FROM {other}) b ON {on} "
                f"WHERE va IS NULL OR vb IS NULL OR abs(va - vb) > {_lit(tol)}")
    elif k == "cross_order":
        key, other, okey = p
        return (f"SELECT count(*) FROM {t} a JOIN {other} b ON a.{key} = b.{okey} "
                f"WHERE a.{c[0]} > b.{c[1]}")
    else:
        raise ValueError(f"no SQL for rule kind {k}")
    return f"SELECT count(*) FILTER (WHERE {cond}) FROM {t}"


def rules_sql(rules) -> str:
    rows = [f"SELECT {_lit(r.table)} AS table_name, {_lit(r.kind)} AS rule, {_lit(','.join(r.columns))} AS column_name, "
            f"CAST(({_count(r)}) AS BIGINT) AS violations, {_lit(r.severity)} AS severity" for r in rules]
    body = "\nUNION ALL\n".join(rows)
    return f"SELECT table_name, rule, column_name, violations, violations = 0 AS passed, severity FROM (\n{body}\n)"


BRONZE_CTES = [
    ("bronze_routes_raw", "SELECT *, routes_id AS route_id FROM routes"),
    ("bronze_flights", "SELECT flight_id, scheduled_arrival AS schedualed_arrival, scheduled_departure AS schedualed_departure FROM flights"),
    ("bronze_ticket_prices", "SELECT price_id, ticket_price AS price, luggage_fee FROM ticket_prices"),
    ("bronze_booked_tickets_raw", "SELECT * FROM booked_tickets"),
    ("bronze_flight_weather_raw_api", "SELECT * FROM weather_raw"),
    ("bronze_registered_customers", "SELECT * FROM customers"),
    ("bronze_route_weather_points", "SELECT route_id, point_latitude AS latitude, point_longitude AS longitude FROM waypoints"),
    ("bronze_boarding_events_raw", "SELECT * FROM boarding_events"),
    ("bronze_flight_events_raw", "SELECT flight_event_id AS event_id, event_time FROM flights_events"),
    ("bronze_ticket_events_raw", "SELECT * FROM ticket_events"),
]
BRONZE_VIEWS = ("routes", "flights", "waypoints", "ticket_prices", "customers", "flights_events", "boarding_events",
                "weather_raw", "ticket_events", "booked_tickets")
#: Bronze tables whose name is also a view's go by another name in SQL.
CTE_OF = {name.removeprefix("bronze_"): name for name, _ in BRONZE_CTES}

SILVER_CTES = [
    ("silver_routes", "SELECT * FROM routes"), ("silver_flights", "SELECT * FROM flights"),
    ("silver_waypoint_sampling_weather_points", "SELECT * FROM waypoints"),
    ("silver_ticket_prices", "SELECT * FROM ticket_prices"), ("silver_customers", "SELECT * FROM customers"),
    ("silver_flights_events", "SELECT * FROM flights_events"),
    ("silver_boarding_summary", Q.BOARDING_SUMMARY), ("silver_agg_frequent_delay_reasons", Q.DELAY_REASONS),
    ("silver_flight_weather", Q.FLIGHT_WEATHER), ("silver_weather_summary", Q.WEATHER_SUMMARY),
    ("silver_agg_cancelation_rate", Q.CANCELATION_RATE), ("silver_ticket_events", "SELECT * FROM ticket_events"),
    ("silver_booked_tickets", "SELECT * FROM booked_tickets"),
]
SILVER_VIEWS = ("routes", "flights", "waypoints", "ticket_prices", "customers", "flights_events", "boarding_events",
                "weather_raw", "flight_weather", "ticket_events", "booked_tickets")

GOLD_CTES = Q._dims_ctes() + Q.ML_CTES + [
    ("gold_dim_monthly_delays", "SELECT * FROM dim_delays"),
    ("gold_dim_monthly_flight_info", "SELECT * FROM dim_flight_info"),
    ("gold_dim_monthly_revenue", "SELECT * FROM dim_revenue"),
    ("gold_dim_monthly_most_popular", "SELECT * FROM dim_popular"),
    ("gold_fact_monthly_performance_report", Q.REPORT), ("gold_monthly_aggregates", Q.AGGREGATES),
    ("gold_dim_ml_routes", "SELECT * FROM ml_routes"), ("gold_dim_ml_weather", "SELECT * FROM ml_weather"),
    ("gold_dim_ml_boarding_data", "SELECT * FROM ml_boarding"),
    ("gold_fact_ml_training", Q.ml_training("first")),
]
GOLD_VIEWS = ("flights", "flights_events", "boarding_events", "ticket_prices", "booked_tickets", "ticket_events",
              "routes", "flight_weather", "waypoints")

RECOMPUTE_CTES = [
    ("recomputed_flight_counts", """SELECT CAST(year(f.flight_date) AS INT) AS year, CAST(month(f.flight_date) AS INT) AS month,
 count(*) AS total_flights FROM flights f JOIN (SELECT DISTINCT flight_id FROM boarding_events WHERE event_type = 'passenger_scanned') s
 ON f.flight_id = s.flight_id GROUP BY ALL"""),
    ("recomputed_revenue", """SELECT CAST(year(p.start_date) AS INT) AS year, CAST(month(p.start_date) AS INT) AS month,
 CAST(sum(p.ticket_price + p.luggage_fee) AS DOUBLE) AS total_revenue
 FROM ticket_prices p JOIN booked_tickets b ON p.silver_flight_id = b.booked_ticket_id GROUP BY ALL"""),
]


def _loaded(ctes) -> list:
    """The layers' tables with their load time, as the queries check them."""
    return [(n, f"SELECT *, TIMESTAMP '{Q.LOAD_TIME}' AS ingestion_time FROM ({body})"
             if n.startswith(("silver_", "gold_", "bronze_")) else body) for n, body in ctes]


def dq_sql(rules, layer: str) -> str:
    if layer == "bronze":
        return with_views(rules_sql(rules), *BRONZE_VIEWS, ctes=_loaded(BRONZE_CTES))
    if layer == "silver":
        return with_views(rules_sql(rules), *SILVER_VIEWS, ctes=_loaded(SILVER_CTES))
    if layer == "gold":
        return with_views(rules_sql(rules), *GOLD_VIEWS, ctes=_loaded(GOLD_CTES))
    # both layers plus recomputed detail totals
    ctes = SILVER_CTES + [c for c in GOLD_CTES if c[0] not in dict(SILVER_CTES)] + RECOMPUTE_CTES
    return with_views(rules_sql(rules), *sorted(set(SILVER_VIEWS) | set(GOLD_VIEWS)), ctes=_loaded(ctes))
