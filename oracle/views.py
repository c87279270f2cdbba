"""The airline fixture views as SQL CTEs over the driver's test tables.

Same derivation as ``contrail.sources.fixtures`` but written independently
in SQL, so a query and its oracle only share the source tables.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {
    "routes": ([], """
SELECT CAST(o.n_nationkey*25+d.n_nationkey AS VARCHAR) AS routes_id, o.n_name AS airport_origin, d.n_name AS airport_destination,
 CAST(o.n_nationkey*7-84 AS DOUBLE) AS latitude_origin, CAST(o.n_nationkey*14-168 AS DOUBLE) AS longitude_origin,
 CAST(d.n_nationkey*7-84 AS DOUBLE) AS latitude_destination, CAST(d.n_nationkey*14-168 AS DOUBLE) AS longitude_destination,
 CAST(abs(o.n_nationkey-d.n_nationkey)*100+50 AS DOUBLE) AS distance_km FROM nation o CROSS JOIN nation d WHERE o.n_nationkey<>d.n_nationkey"""),
    "waypoints": (["routes"], """
SELECT routes_id AS route_id, CAST(k AS INT) AS way_point_number, latitude_origin+(latitude_destination-latitude_origin)*k/2 AS point_latitude,
 longitude_origin+(longitude_destination-longitude_origin)*k/2 AS point_longitude, CAST(CASE WHEN k=1 THEN 10000 ELSE 500 END AS DOUBLE) AS point_height
 FROM routes CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k UNION ALL SELECT 2 AS k) x"""),
    "flights": ([], """
SELECT CAST(o_orderkey AS VARCHAR) AS flight_id, CAST(c_nationkey*25+(c_nationkey+1+o_orderkey%24)%25 AS VARCHAR) AS routes_id,
 CAST(50+o_orderkey%250 AS INT) AS possible_passenger_amount, CAST(1000+o_orderkey%9000 AS INT) AS possible_luggage_weight, CAST(o_orderdate AS DATE) AS flight_date,
 o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey%24 AS INT) AS scheduled_departure,
 o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey%24 AS INT) + INTERVAL '1' MINUTE * CAST(60+o_orderkey%600 AS INT) AS scheduled_arrival
 FROM orders JOIN customer ON o_custkey=c_custkey"""),
    "legacy_flights": ([], """
SELECT CAST(o_orderkey-o_orderkey%4 AS VARCHAR) AS flight_id, no.n_name AS origin, nd.n_name AS destination, CAST(o_orderdate AS DATE) AS flight_date,
 o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey%24 AS INT) AS departure_time
 FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation no ON no.n_nationkey=c_nationkey JOIN nation nd ON nd.n_nationkey=(c_nationkey+o_orderkey%3)%25"""),
    "flights_events": ([], """
SELECT CAST(o_orderkey*2+k AS VARCHAR) AS flight_event_id, CAST(o_orderkey AS VARCHAR) AS flight_id,
 CASE WHEN k=1 THEN 'delay_reported' WHEN o_orderstatus='P' THEN 'gate_changed' ELSE 'actual_departure' END AS event_type,
 CASE o_orderkey%5 WHEN 0 THEN 'weather' WHEN 1 THEN 'technical' WHEN 2 THEN 'crew' WHEN 3 THEN 'security' ELSE NULL END AS delay_reason,
 o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey%24 AS INT) + INTERVAL '1' MINUTE * CAST((o_orderkey*37)%181-20 AS INT) AS event_time
 FROM orders CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) x"""),
    "boarding_events": ([], """
SELECT CAST(l_orderkey*10+l_linenumber AS VARCHAR) AS event_id, CAST(l_orderkey AS VARCHAR) AS flight_id,
 CASE l_returnflag WHEN 'A' THEN 'passenger_scanned' WHEN 'R' THEN 'bag_loaded' ELSE 'gate_closed' END AS event_type,
 CAST(l_partkey AS VARCHAR) AS passenger_id, CAST(l_quantity AS DECIMAL(10,2)) AS baggage_weight, l_shipdate AS event_time FROM lineitem"""),
    "ticket_prices": ([], """
SELECT CAST(l_orderkey*10+l_linenumber AS VARCHAR) AS price_id, CAST(l_orderkey AS VARCHAR) AS silver_flight_id,
 CASE l_returnflag WHEN 'A' THEN 'first' WHEN 'N' THEN 'business' ELSE 'economy' END AS ticket_class, CAST(l_extendedprice AS DECIMAL(12,2)) AS ticket_price,
 CAST(l_quantity AS DECIMAL(12,2)) AS luggage_fee, CAST(l_shipdate AS DATE) AS start_date, CAST(l_shipdate + INTERVAL '1' DAY * CAST(l_partkey%97-1 AS INT) AS DATE) AS end_date,
 l_linestatus='O' AS actual FROM lineitem"""),
    "booked_tickets": ([], """
SELECT CAST(o_orderkey AS VARCHAR) AS booked_ticket_id, CAST(o_orderkey-o_orderkey%4 AS VARCHAR) AS flight_id, CAST(o_custkey AS VARCHAR) AS customer_passport_id,
 CASE o_orderkey%3 WHEN 0 THEN 'first' WHEN 1 THEN 'business' ELSE 'economy' END AS ticket_class, o_orderpriority AS order_method, CAST(o_orderdate AS DATE) AS booking_date FROM orders"""),
    "customers": ([], """
SELECT CAST(c_custkey AS VARCHAR) AS customer_passport_id, c_name AS customer_first_name, c_name AS customer_last_name, n_name AS customer_nationality,
 CASE WHEN c_custkey%50=7 THEN NULL ELSE concat('c', CAST(c_custkey AS VARCHAR), '@example.com') END AS customer_email, lower(c_mktsegment) AS customer_membership_tier,
 CAST(TIMESTAMP '1960-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey%15000 AS INT) AS DATE) AS customer_date_of_birth FROM customer JOIN nation ON c_nationkey=n_nationkey"""),
    "ticket_events": ([], """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(event_id AS VARCHAR) AS booked_ticket_id, CASE event_type WHEN 'purchase' THEN 'canceled' WHEN 'view' THEN 'class upgrade'
 WHEN 'click' THEN 'added luggage' WHEN 'error' THEN 'request to cancel' ELSE event_type END AS event_type, ts AS event_time FROM events"""),
    "weather_raw": (["flights", "waypoints"], """
SELECT CAST(l_orderkey*10+l_linenumber AS VARCHAR) AS weather_sample_id, w.point_latitude AS latitude, w.point_longitude AS longitude, w.point_height AS height,
 l_quantity-10 AS temperature, CAST(CAST(round(l_discount*100) AS INT)*10 AS DOUBLE) AS humidity, l_quantity/2 AS wind_speed, CAST(l_partkey%361 AS DOUBLE) AS wind_direction,
 CASE l_suppkey%4 WHEN 0 THEN 'clear' WHEN 1 THEN 'rain' WHEN 2 THEN 'storm' ELSE 'fog' END AS current_weather_condition,
 f.flight_date AS sample_for_date FROM lineitem JOIN flights f ON CAST(l_orderkey AS VARCHAR)=f.flight_id JOIN waypoints w ON w.route_id=f.routes_id AND w.way_point_number=l_linenumber%3"""),
    "flight_weather": ([], """
SELECT CAST(l_orderkey*10+l_linenumber AS VARCHAR) AS weather_sample_id, CAST(l_orderkey AS VARCHAR) AS silver_flight_id, l_linenumber AS waypoint_sampling_number, l_quantity-10 AS temperature,
 CAST(CAST(round(l_discount*100) AS INT)*10 AS DOUBLE) AS humidity, l_quantity/2 AS wind_speed, CAST(l_partkey%361 AS DOUBLE) AS wind_direction,
 CASE l_suppkey%4 WHEN 0 THEN 'clear' WHEN 1 THEN 'rain' WHEN 2 THEN 'storm' ELSE 'fog' END AS weather_condition FROM lineitem"""),
}


def with_views(body: str, *names: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it needs (dependencies first),
    followed by the query's own ``ctes`` in the given order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = [(n, VIEWS[n][1]) for n in order] + list(ctes or [])
    if not parts:
        return body.strip()
    head = ",\n".join(f"{n} AS ({q.strip()})" for n, q in parts)
    return f"WITH {head}\n{body.strip()}"
