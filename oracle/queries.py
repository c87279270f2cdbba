"""DuckDB SQL oracles, one per registered query name.

Conventions shared with the Spark side: year/month are INT; money sums are
exact decimals cast to DOUBLE; averages of money are CAST(sum AS DOUBLE) /
count; ids are sha256 of 'namespace|key|…'; ties in rankings go to the
alphabetically smallest label.
"""

from __future__ import annotations

from oracle.views import with_views as W

#: Fixed load time of the ``*_load_time`` and ``dq_*`` queries.
LOAD_TIME = "2024-02-03 04:05:06"


def _ym(c: str) -> str:
    return f"CAST(year({c}) AS INT) AS year, CAST(month({c}) AS INT) AS month"


def _id(ns: str, *keys: str) -> str:
    parts = ", ".join([f"'{ns}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"sha256(concat_ws('|', {parts}))"


def _mins(a: str, b: str) -> str:
    return f"CAST(date_diff('second', {a}, {b}) AS DOUBLE) / 60.0"


# ------------------------------------------------------------ shared CTEs
BOARDING_SUMMARY = f"""
SELECT flight_id, count(event_type) AS passenger_count, count(*) FILTER (WHERE baggage_weight > 0) AS baggage_count,
 CAST(sum(baggage_weight) AS DECIMAL(12,2)) AS total_baggage_weight,
 CAST(CAST(sum(baggage_weight) AS DECIMAL(12,2)) AS DOUBLE) / NULLIF(count(event_type), 0) AS avg_baggage_per_passenger,
 CAST(CAST(sum(baggage_weight) AS DECIMAL(12,2)) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE baggage_weight > 0), 0) AS avg_baggage_weight,
 min(CAST(event_time AS DATE)) AS boarding_date
FROM boarding_events WHERE event_type = 'passenger_scanned' GROUP BY flight_id"""

WEATHER_SUMMARY = """
SELECT a.*, m.weather_condition AS majority_weather_condition FROM
 (SELECT silver_flight_id AS flight_id, avg(temperature) AS average_temperature, avg(humidity) AS average_humidity,
   avg(wind_speed) AS average_wind_speed, avg(wind_direction) AS average_wind_direction FROM flight_weather GROUP BY 1) a
 LEFT JOIN (SELECT flight_id, weather_condition FROM
   (SELECT silver_flight_id AS flight_id, weather_condition,
      row_number() OVER (PARTITION BY silver_flight_id ORDER BY count(*) DESC, weather_condition) AS rn
    FROM flight_weather WHERE weather_condition IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) m USING (flight_id)"""

DELAY_REASONS = f"""
SELECT {_id('delay_reason', 'year', 'month', 'delay_reason')} AS delay_id, silver_flight_event, total_occurences, year, month, delay_reason FROM
 (SELECT {_ym('f.flight_date')}, e.delay_reason, count(*) AS total_occurences, min(e.flight_event_id) AS silver_flight_event
  FROM flights_events e JOIN flights f ON e.flight_id = f.flight_id WHERE e.delay_reason IS NOT NULL GROUP BY ALL)"""

CANCELATION_RATE = f"""
SELECT {_ym('b.booking_date')}, count(*) AS total_booking, count(c.booked_ticket_id) AS total_cancelation,
 CAST(count(c.booked_ticket_id) AS DOUBLE) / NULLIF(count(*), 0) AS cancelation_rate
FROM booked_tickets b LEFT JOIN (SELECT DISTINCT booked_ticket_id FROM ticket_events WHERE event_type = 'canceled') c
 ON b.booked_ticket_id = c.booked_ticket_id GROUP BY ALL"""

DIM_DELAYS = f"""
SELECT {_id('delays', 's.year', 's.month')} AS delays_id, t.most_frequent_delay, s.average_delay, s.minimal_delay, s.maximal_delay, s.year, s.month
FROM (SELECT {_ym('f.flight_date')}, avg({_mins('f.scheduled_departure', 'e.event_time')}) AS average_delay,
        min({_mins('f.scheduled_departure', 'e.event_time')}) AS minimal_delay, max({_mins('f.scheduled_departure', 'e.event_time')}) AS maximal_delay
      FROM flights f JOIN flights_events e ON f.flight_id = e.flight_id WHERE e.event_type = 'actual_departure' GROUP BY ALL) s
LEFT JOIN (SELECT year, month, delay_reason AS most_frequent_delay FROM
   (SELECT year, month, delay_reason, row_number() OVER (PARTITION BY year, month ORDER BY total_occurences DESC, delay_reason) AS rn
    FROM delay_reasons) WHERE rn = 1) t ON s.year = t.year AND s.month = t.month"""

DIM_FLIGHT_INFO = f"""
SELECT {_id('flight_info', 'year', 'month')} AS flights_info_id, total_flights, total_passengers_number, average_passengers_number_on_flight, year, month FROM
 (SELECT {_ym('f.flight_date')}, count(f.flight_id) AS total_flights, CAST(sum(s.passenger_count) AS BIGINT) AS total_passengers_number,
   avg(s.passenger_count) AS average_passengers_number_on_flight
  FROM flights f JOIN boarding_summary s ON f.flight_id = s.flight_id GROUP BY ALL)"""

PRICED_LITERAL = f"""
SELECT p.ticket_class, p.ticket_price, p.luggage_fee, b.customer_passport_id, {_ym('p.start_date')}
FROM ticket_prices p JOIN booked_tickets b ON p.silver_flight_id = b.booked_ticket_id"""

PRICED_BY_FLIGHT = f"""
SELECT p.ticket_class, p.ticket_price, p.luggage_fee, b.customer_passport_id, {_ym('p.start_date')}
FROM (SELECT * FROM (SELECT silver_flight_id, ticket_class, ticket_price, luggage_fee, start_date,
        row_number() OVER (PARTITION BY silver_flight_id, ticket_class ORDER BY start_date DESC, price_id) AS rn
      FROM ticket_prices) WHERE rn = 1) p
JOIN booked_tickets b ON b.flight_id = p.silver_flight_id AND b.ticket_class = p.ticket_class"""


def dim_revenue(per_passenger: str) -> str:
    rpp = ("m.total_revenue / 1" if per_passenger == "literal"
           else "m.total_revenue / NULLIF(CAST(x.passengers AS DOUBLE), 0)")
    return f"""
SELECT {_id('revenue', 'm.year', 'm.month')} AS revenue_id, t.max_revenue_class, m.total_revenue, {rpp} AS revenue_per_passenger,
 m.average_ticket_price, c.cancelation_rate, m.year, m.month
FROM (SELECT year, month, CAST(sum(ticket_price + luggage_fee) AS DOUBLE) AS total_revenue,
        CAST(sum(ticket_price) AS DOUBLE) / count(ticket_price) AS average_ticket_price FROM priced GROUP BY ALL) m
LEFT JOIN (SELECT year, month, ticket_class AS max_revenue_class FROM
   (SELECT year, month, ticket_class, row_number() OVER (PARTITION BY year, month
      ORDER BY sum(ticket_price + luggage_fee) DESC NULLS LAST, ticket_class) AS rn FROM priced
    GROUP BY year, month, ticket_class) WHERE rn = 1) t
 ON m.year = t.year AND m.month = t.month
LEFT JOIN (SELECT year, month, count(DISTINCT customer_passport_id) AS passengers FROM priced GROUP BY ALL) x
 ON m.year = x.year AND m.month = x.month
LEFT JOIN cancelation_rate c ON m.year = c.year AND m.month = c.month"""


def _top(src: str, label: str, out: str) -> str:
    return f"""(SELECT year, month, {label} AS {out} FROM
   (SELECT year, month, {label}, row_number() OVER (PARTITION BY year, month ORDER BY count(*) DESC, {label}) AS rn
    FROM {src} WHERE {label} IS NOT NULL GROUP BY year, month, {label}) WHERE rn = 1)"""


def dim_popular(key: str, method: str) -> str:
    bkey = "b.booked_ticket_id" if key == "literal" else "b.flight_id"
    m = "'online'" if method == "literal" else "b.order_method"
    return f"""
SELECT {_id('most_popular', 'o.year', 'o.month')} AS metrics_id, o.most_popular_origin, d.most_popular_destination,
 me.most_popular_order_method, o.year, o.month
FROM {_top('booked_route', 'airport_origin', 'most_popular_origin')} o
JOIN {_top('booked_route', 'airport_destination', 'most_popular_destination')} d ON o.year = d.year AND o.month = d.month
JOIN {_top('booked_route', 'method', 'most_popular_order_method')} me ON o.year = me.year AND o.month = me.month""", f"""
SELECT {_ym('b.booking_date')}, r.airport_origin, r.airport_destination, {m} AS method
FROM booked_tickets b JOIN flights f ON {bkey} = f.flight_id JOIN routes r ON f.routes_id = r.routes_id"""


ML_ROUTES = f"""
SELECT {_id('route', 'r.routes_id')} AS route_id, r.routes_id, r.airport_origin, r.airport_destination, t.time_of_flight, r.distance_km
FROM routes r JOIN (SELECT routes_id, avg({_mins('scheduled_departure', 'scheduled_arrival')}) AS time_of_flight FROM flights GROUP BY 1) t
 ON r.routes_id = t.routes_id"""

ML_WEATHER = f"""
SELECT {_id('weather', 'majority_weather_condition')} AS weather_id, majority_weather_condition, count(*) AS number_of_most_common_condition,
 avg(h) AS average_height, avg(average_temperature) AS average_temperature, avg(average_humidity) AS average_humidity,
 avg(average_wind_speed) AS average_wind_speed, avg(average_wind_direction) AS average_wind_direction
FROM (SELECT ws.*, rh.h FROM weather_summary ws LEFT JOIN flights f ON ws.flight_id = f.flight_id
      LEFT JOIN (SELECT route_id, avg(point_height) AS h FROM waypoints GROUP BY 1) rh ON rh.route_id = f.routes_id)
GROUP BY majority_weather_condition"""

ML_BOARDING = f"""
SELECT {_id('boarding')} AS boarding_data_id, max(possible_passenger_amount) AS max_passenger_capacity,
 max(possible_luggage_weight) AS max_luggage_weight_capacity FROM flights"""


def ml_training(weather: str) -> str:
    if weather == "first":
        wsel, wjoin = "(SELECT min(weather_id) FROM ml_weather)", ""
    else:
        wsel = "mw.weather_id"
        wjoin = ("LEFT JOIN weather_summary ws ON ws.flight_id = f.flight_id "
                 "LEFT JOIN ml_weather mw ON mw.majority_weather_condition = ws.majority_weather_condition")
    return f"""
SELECT {_id('training', 'e.flight_event_id')} AS training_set_id, {wsel} AS weather_id, mr.route_id,
 (SELECT min(boarding_data_id) FROM ml_boarding) AS boarding_data_id, {_mins('f.scheduled_departure', 'e.event_time')} AS delay_in_minutes
FROM flights f JOIN flights_events e ON f.flight_id = e.flight_id AND e.event_type = 'actual_departure'
LEFT JOIN ml_routes mr ON mr.routes_id = f.routes_id {wjoin}"""


def _dims_ctes() -> list[tuple[str, str]]:
    body, src = dim_popular("literal", "literal")
    return [("delay_reasons", DELAY_REASONS), ("dim_delays", DIM_DELAYS),
            ("boarding_summary", BOARDING_SUMMARY), ("dim_flight_info", DIM_FLIGHT_INFO),
            ("cancelation_rate", CANCELATION_RATE), ("priced", PRICED_LITERAL), ("dim_revenue", dim_revenue("literal")),
            ("booked_route", src), ("dim_popular", body)]


_DIM_VIEWS = ("flights", "flights_events", "boarding_events", "ticket_prices", "booked_tickets", "ticket_events",
              "routes")
_DIM_JOIN = """FROM dim_flight_info fi JOIN dim_revenue rv ON fi.year = rv.year AND fi.month = rv.month
JOIN dim_delays dl ON fi.year = dl.year AND fi.month = dl.month
JOIN dim_popular pp ON fi.year = pp.year AND fi.month = pp.month"""


REPORT = f"""
SELECT {_id('report', 'fi.year', 'fi.month')} AS report_id, rv.revenue_id, fi.flights_info_id, pp.metrics_id, dl.delays_id, fi.year, fi.month
{_DIM_JOIN}"""
AGGREGATES = f"""
SELECT {_id('aggregate', 'fi.year', 'fi.month')} AS aggregate_id, fi.year, fi.month, fi.total_flights, rv.total_revenue, dl.average_delay,
 pp.most_popular_destination, pp.most_popular_order_method
{_DIM_JOIN}"""
FLIGHT_WEATHER_LINK = """
SELECT r.weather_sample_id, f.flight_id AS silver_flight_id, w.way_point_number AS waypoint_sampling_number,
 r.current_weather_condition AS weather_condition, r.temperature, r.humidity, r.wind_speed, r.wind_direction,
 CAST(r.sample_for_date AS DATE) AS sample_for_date
FROM weather_raw r JOIN waypoints w ON r.latitude = w.point_latitude AND r.longitude = w.point_longitude AND r.height = w.point_height
JOIN flights f ON f.routes_id = w.route_id AND f.flight_date = CAST(r.sample_for_date AS DATE)"""
FLIGHT_WEATHER = """
SELECT weather_sample_id, silver_flight_id, waypoint_sampling_number, weather_condition, temperature, humidity, wind_speed, wind_direction, sample_for_date
FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, height, sample_for_date, sample_row ORDER BY silver_flight_id, waypoint_sampling_number) AS rn
  FROM (SELECT r.weather_sample_id, f.flight_id AS silver_flight_id, w.way_point_number AS waypoint_sampling_number,
    r.current_weather_condition AS weather_condition, r.temperature, r.humidity, r.wind_speed, r.wind_direction,
    CAST(r.sample_for_date AS DATE) AS sample_for_date, r.latitude, r.longitude, r.height, r.sample_row
   FROM (SELECT *, row_number() OVER () AS sample_row FROM weather_raw) r
   JOIN waypoints w ON r.latitude = w.point_latitude AND r.longitude = w.point_longitude AND r.height = w.point_height
   JOIN flights f ON f.routes_id = w.route_id AND f.flight_date = CAST(r.sample_for_date AS DATE))) WHERE rn = 1"""
ML_CTES = [("weather_summary", WEATHER_SUMMARY), ("ml_weather", ML_WEATHER), ("ml_routes", ML_ROUTES),
           ("ml_boarding", ML_BOARDING)]


def _silver_gold() -> dict[str, str]:
    q: dict[str, str] = {}
    for name, view in [("silver_routes", "routes"), ("silver_flights", "flights"), ("silver_waypoints", "waypoints"),
                       ("silver_ticket_prices", "ticket_prices"), ("silver_customers", "customers"),
                       ("silver_flights_events", "flights_events"), ("silver_booked_tickets", "booked_tickets"),
                       ("silver_ticket_events", "ticket_events")]:
        q[name] = W(f"SELECT * FROM {view}", view)
    q["silver_boarding_summary"] = W(BOARDING_SUMMARY, "boarding_events")
    q["silver_flight_weather"] = W(FLIGHT_WEATHER, "weather_raw", "waypoints", "flights")
    q["silver_weather_summary"] = W(WEATHER_SUMMARY, "flight_weather")
    q["silver_delay_reasons"] = W(DELAY_REASONS, "flights_events", "flights")
    q["silver_cancelation_rate"] = W(CANCELATION_RATE, "booked_tickets", "ticket_events")
    q["bronze_clean_flights"] = W("""
SELECT flight_id, origin, destination, flight_date, departure_time FROM
 (SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY origin NULLS LAST, destination NULLS LAST,
    flight_date NULLS LAST, departure_time NULLS LAST) AS rn FROM legacy_flights WHERE origin <> destination) WHERE rn = 1""",
                                  "legacy_flights")

    q["monthly_delays"] = W(DIM_DELAYS, "flights", "flights_events", ctes=[("delay_reasons", DELAY_REASONS)])
    q["monthly_delays_event_path"] = q["monthly_delays"]
    q["monthly_delays_by_loads"] = q["monthly_delays"]
    q["monthly_flight_info"] = W(DIM_FLIGHT_INFO, "flights", "boarding_events",
                                 ctes=[("boarding_summary", BOARDING_SUMMARY)])
    q["monthly_revenue_literal"] = W(dim_revenue("literal"), "ticket_prices", "booked_tickets", "ticket_events",
                                     ctes=[("cancelation_rate", CANCELATION_RATE), ("priced", PRICED_LITERAL)])
    q["monthly_revenue_by_flight"] = W(dim_revenue("distinct"), "ticket_prices", "booked_tickets", "ticket_events",
                                       ctes=[("cancelation_rate", CANCELATION_RATE), ("priced", PRICED_BY_FLIGHT)])
    for name, key, method in [("monthly_most_popular_literal", "literal", "literal"),
                              ("monthly_most_popular", "flight", "column")]:
        body, src = dim_popular(key, method)
        q[name] = W(body, "booked_tickets", "flights", "routes", ctes=[("booked_route", src)])
    q["monthly_most_popular_by_loads"] = q["monthly_most_popular"]
    q["monthly_performance_report"] = W(REPORT, *_DIM_VIEWS, ctes=_dims_ctes())
    q["monthly_aggregates"] = W(AGGREGATES, *_DIM_VIEWS, ctes=_dims_ctes())
    q["ml_routes"] = W(ML_ROUTES, "routes", "flights")
    q["ml_weather"] = W(ML_WEATHER, "flight_weather", "flights", "waypoints",
                        ctes=[("weather_summary", WEATHER_SUMMARY)])
    q["ml_boarding_data"] = W(ML_BOARDING, "flights")
    ml_ctes = ML_CTES
    q["ml_training"] = W(ml_training("first"), "flights", "flights_events", "routes", "flight_weather", "waypoints",
                         ctes=ml_ctes)
    q["ml_training_per_flight"] = W(ml_training("per_flight"), "flights", "flights_events", "routes",
                                    "flight_weather", "waypoints", ctes=ml_ctes)
    return q


ORACLES: dict[str, str] = {}
ORACLES.update(_silver_gold())


def _dq() -> dict[str, str]:
    from oracle.quality import dq_sql
    from oracle.rules import rule_sets
    return {name: dq_sql(rules, layer) for name, (layer, rules) in rule_sets().items()}


ORACLES.update(_dq())

USER_PAYLOAD = """SELECT event_type, concat('{"event_ts":"', substr(CAST(ts AS VARCHAR),1,10), 'T', substr(CAST(ts AS VARCHAR),12,8), 'Z","user_id":"u',
 CAST(user_id AS VARCHAR), '","name":"', event_type, '","country":"', CASE user_id%3 WHEN 0 THEN 'FR' WHEN 1 THEN 'DE' ELSE 'IL' END, '"}') AS value FROM events"""
USERS_PARSED = """SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_ts, 'u' || CAST(user_id AS VARCHAR) AS user_id, event_type AS name,
 CASE user_id%3 WHEN 0 THEN 'FR' WHEN 1 THEN 'DE' ELSE 'IL' END AS country FROM events"""

ORACLES["stream_user_events"] = USERS_PARSED
ORACLES["stream_dedup"] = f"SELECT DISTINCT * FROM ({USERS_PARSED})"
ORACLES["stream_flights"] = W("""SELECT flight_id, routes_id AS route_id, scheduled_departure, scheduled_arrival,
 possible_passenger_amount AS max_passenger_capacity FROM flights""", "flights")
ORACLES["stream_quarantine"] = W("""
SELECT CASE WHEN event_type = 'error' THEN substr(value, 1, length(value) - 3) ELSE replace(value, '"event_ts":"', '"event_ts":"x') END AS value,
 CASE WHEN event_type = 'error' THEN 'malformed' ELSE 'bad_timestamp' END AS reason
FROM payload WHERE event_type IN ('error', 'signup')""", ctes=[("payload", USER_PAYLOAD)])

ORACLES["top_n_per_group"] = W(f"""
SELECT routes_id, flight_id, minutes, rank FROM (SELECT routes_id, flight_id, {_mins('scheduled_departure', 'scheduled_arrival')} AS minutes,
 CAST(row_number() OVER (PARTITION BY routes_id ORDER BY date_diff('second', scheduled_departure, scheduled_arrival) DESC, flight_id) AS INT) AS rank
 FROM flights) WHERE rank <= 3""", "flights")
ORACLES["most_frequent"] = W("""
SELECT customer_membership_tier, top_nationality, customers FROM (SELECT customer_membership_tier, customer_nationality AS top_nationality,
 count(*) AS customers, row_number() OVER (PARTITION BY customer_membership_tier ORDER BY count(*) DESC, customer_nationality) AS rn
 FROM customers WHERE customer_nationality IS NOT NULL GROUP BY customer_membership_tier, customer_nationality) WHERE rn = 1""", "customers")
ORACLES["align_periods"] = W("""
SELECT coalesce(c.year, i.year) AS year, coalesce(c.month, i.month) AS month, c.total_booking, c.total_cancelation, i.total_flights
FROM cancelation_rate c FULL OUTER JOIN dim_flight_info i ON c.year = i.year AND c.month = i.month""",
                             "booked_tickets", "ticket_events", "flights", "boarding_events",
                             ctes=[("cancelation_rate", CANCELATION_RATE), ("boarding_summary", BOARDING_SUMMARY),
                                   ("dim_flight_info", DIM_FLIGHT_INFO)])
ORACLES["latest_per_key"] = W("""
SELECT event_id, flight_id, event_type, passenger_id, baggage_weight, event_time FROM (SELECT *, row_number() OVER (PARTITION BY event_id
 ORDER BY event_time DESC NULLS LAST, flight_id NULLS LAST, event_type NULLS LAST, passenger_id NULLS LAST, baggage_weight NULLS LAST) AS rn
 FROM boarding_events) WHERE rn = 1""", "boarding_events")

for _name in ("silver_routes", "silver_flights", "silver_waypoints", "silver_ticket_prices", "silver_customers",
              "silver_flights_events", "silver_booked_tickets", "silver_ticket_events"):
    ORACLES[f"{_name}_load_time"] = f"SELECT *, TIMESTAMP '{LOAD_TIME}' AS ingestion_time FROM ({ORACLES[_name]})"
for _name in ("silver_flights", "silver_ticket_prices"):
    ORACLES[f"layer_{_name}"] = ORACLES[f"{_name}_load_time"]
ORACLES["orphans"] = W("""SELECT e.flight_event_id, e.flight_id FROM flights_events e LEFT JOIN departed f ON e.flight_id = f.flight_id
WHERE f.flight_id IS NULL""", "flights_events", "flights", ctes=[("departed", "SELECT DISTINCT flight_id FROM flights WHERE possible_passenger_amount >= 100")])
ORACLES["silver_weather_summary_from_samples"] = W(WEATHER_SUMMARY, "weather_raw", "waypoints", "flights",
                                                   ctes=[("flight_weather", FLIGHT_WEATHER_LINK)])
ORACLES["ml_weather_from_samples"] = W(ML_WEATHER, "weather_raw", "waypoints", "flights", ctes=[
    ("flight_weather", FLIGHT_WEATHER_LINK), ("weather_summary", WEATHER_SUMMARY)])
ORACLES["unpriced_bookings"] = W("""SELECT * FROM booked_tickets b WHERE NOT EXISTS
 (SELECT 1 FROM ticket_prices p WHERE p.silver_flight_id = b.flight_id AND p.ticket_class = b.ticket_class)""", "booked_tickets", "ticket_prices")

# a price is in force to its end, or to the day before the next one of its flight and class starts
IN_FORCE = """SELECT silver_flight_id, ticket_class, price_id, ticket_price, luggage_fee, start_date,
 least(coalesce(end_date, DATE '9999-12-31'), coalesce(lead(start_date) OVER (PARTITION BY silver_flight_id, ticket_class ORDER BY start_date) - INTERVAL 1 DAY,
   DATE '9999-12-31')) AS last_day
FROM (SELECT *, row_number() OVER (PARTITION BY silver_flight_id, ticket_class, start_date ORDER BY price_id NULLS FIRST, ticket_price NULLS FIRST,
   luggage_fee NULLS FIRST, end_date NULLS FIRST) AS rn FROM ticket_prices WHERE start_date IS NOT NULL) WHERE rn = 1"""
AT_BOOKING = """SELECT b.*, p.price_id, p.ticket_price, p.luggage_fee, p.start_date FROM booked_tickets b LEFT JOIN in_force p
 ON p.silver_flight_id = b.flight_id AND p.ticket_class = b.ticket_class AND b.booking_date BETWEEN p.start_date AND p.last_day"""
ORACLES["price_at_booking"] = W(f"""SELECT booked_ticket_id, flight_id, ticket_class, booking_date, price_id, ticket_price, luggage_fee, start_date
FROM ({AT_BOOKING})""", "booked_tickets", "ticket_prices", ctes=[("in_force", IN_FORCE)])
ORACLES["unpriced_bookings_on_date"] = W(f"SELECT b.* EXCLUDE (price_id, ticket_price, luggage_fee, start_date) FROM ({AT_BOOKING}) b WHERE start_date IS NULL",
                                         "booked_tickets", "ticket_prices", ctes=[("in_force", IN_FORCE)])
ORACLES["monthly_revenue_valid_price"] = W(dim_revenue("distinct"), "ticket_prices", "booked_tickets", "ticket_events", ctes=[
    ("cancelation_rate", CANCELATION_RATE), ("in_force", IN_FORCE),
    ("priced", f"SELECT {_ym('start_date')}, ticket_class, ticket_price, luggage_fee, customer_passport_id FROM ({AT_BOOKING}) WHERE start_date IS NOT NULL")])


def _written(tables: dict[str, str], **other: str) -> str:
    """Rows and status of the tables of a layer run, from each table's own SQL; ``other``: tables not written, with their status."""
    parts = [f"SELECT '{t}' AS table_name, count(*) AS rows_written, 'written' AS status FROM ({ORACLES[q]})" for t, q in tables.items()]
    return " UNION ALL ".join(parts + [f"SELECT '{t}', NULL, '{status}'" for t, status in other.items()])


_SILVER_RUN = {
    "silver_routes": "silver_routes", "silver_flights": "silver_flights", "silver_waypoint_sampling_weather_points": "silver_waypoints",
    "silver_ticket_prices": "silver_ticket_prices", "silver_customers": "silver_customers", "silver_flights_events": "silver_flights_events",
    "silver_booked_tickets": "silver_booked_tickets", "silver_ticket_events": "silver_ticket_events", "silver_boarding_summary": "silver_boarding_summary",
    "silver_flight_weather": "silver_flight_weather", "silver_weather_summary": "silver_weather_summary_from_samples",
    "silver_agg_frequent_delay_reasons": "silver_delay_reasons", "silver_agg_cancelation_rate": "silver_cancelation_rate"}
ORACLES["run_silver_layer"] = f"SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({_written(_SILVER_RUN)})"
ORACLES["run_gold_monthly_layer"] = "SELECT *, CAST(NULL AS VARCHAR) AS error FROM (" + _written({
    "gold_dim_monthly_delays": "monthly_delays", "gold_dim_monthly_flight_info": "monthly_flight_info", "gold_dim_monthly_revenue": "monthly_revenue_literal",
    "gold_dim_monthly_most_popular": "monthly_most_popular_literal", "gold_fact_monthly_performance_report": "monthly_performance_report",
    "gold_monthly_aggregates": "monthly_aggregates"}) + ")"
ORACLES["run_gold_ml_layer"] = "SELECT *, CAST(NULL AS VARCHAR) AS error FROM (" + _written({
    "gold_dim_ml_routes": "ml_routes", "gold_dim_ml_weather": "ml_weather", "gold_dim_ml_boarding_data": "ml_boarding_data",
    "gold_fact_ml_training": "ml_training"}) + ")"
ORACLES["run_gold_ml_failure"] = "SELECT *, status <> 'written' AS has_error FROM (" + _written(
    {"gold_dim_ml_routes": "ml_routes", "gold_dim_ml_boarding_data": "ml_boarding_data"}, gold_dim_ml_weather="failed", gold_fact_ml_training="skipped") + ")"
