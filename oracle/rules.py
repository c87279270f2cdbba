"""The data-quality rules of every ``dq_*`` query, stated here anew.

Nothing is imported from the library, so a rule that its engine forgets or
changes shows as a missing or different row. One line per rule kind under
the name of its table:

    not_null COL...           one rule per column
    range COL LOW HIGH        min COL LOW | above COL LOW (strictly)
    enum COL VALUE|VALUE...   order FIRST SECOND | before FIRST SECOND (strictly)
    derived TARGET NUMERATOR DENOMINATOR
    unique COL...             fk COL PARENT [PARENT_COL]
    missing KIND COL          a rule on a column the table lacks

A line that starts with ``warn`` has that severity.
"""

from __future__ import annotations

from typing import NamedTuple

# The layers' rules.
SILVER = """
silver_routes
 not_null routes_id airport_origin airport_destination latitude_origin longitude_origin latitude_destination longitude_destination distance_km ingestion_time
 range latitude_origin -90 90
 range longitude_origin -180 180
 range latitude_destination -90 90
 range longitude_destination -180 180
 above distance_km 0
 unique routes_id
silver_flights
 not_null flight_id routes_id scheduled_departure scheduled_arrival
 unique flight_id
 fk routes_id silver_routes
 min possible_passenger_amount 0
 min possible_luggage_weight 0
 before scheduled_departure scheduled_arrival
silver_waypoint_sampling_weather_points
 not_null route_id way_point_number point_latitude point_longitude point_height ingestion_time
 range point_latitude -90 90
 range point_longitude -180 180
 unique route_id way_point_number
 fk route_id silver_routes routes_id
silver_ticket_prices
 not_null price_id silver_flight_id ticket_class ticket_price
 unique price_id
 enum ticket_class first|business|economy
 min ticket_price 0
 min luggage_fee 0
 order start_date end_date
 fk silver_flight_id silver_flights flight_id
silver_customers
 not_null customer_passport_id customer_email
 unique customer_passport_id
silver_flights_events
 not_null flight_event_id flight_id event_type event_time ingestion_time
 unique flight_event_id
 fk flight_id silver_flights
 enum delay_reason weather|technical|crew|security
silver_boarding_summary
 not_null flight_id boarding_date passenger_count baggage_count total_baggage_weight avg_baggage_per_passenger avg_baggage_weight ingestion_time
 unique flight_id
 fk flight_id silver_flights
 derived avg_baggage_weight total_baggage_weight baggage_count
 derived avg_baggage_per_passenger total_baggage_weight passenger_count
silver_agg_frequent_delay_reasons
 not_null delay_id silver_flight_event total_occurences ingestion_time
 unique delay_id
 fk silver_flight_event silver_flights_events flight_event_id
 enum delay_reason weather|technical|crew|security
silver_flight_weather
 not_null weather_sample_id silver_flight_id weather_condition
 range temperature -100 60
 range humidity 0 100
 min wind_speed 0
 range wind_direction 0 360
 unique weather_sample_id
 enum weather_condition clear|rain|storm|fog
silver_weather_summary
 not_null flight_id majority_weather_condition
 range average_humidity 0 100
 unique flight_id
 enum majority_weather_condition clear|rain|storm|fog
silver_agg_cancelation_rate
 not_null total_booking total_cancelation cancelation_rate
 order total_cancelation total_booking
 range cancelation_rate 0 1
 unique year month
silver_ticket_events
 not_null event_id booked_ticket_id event_type event_time ingestion_time
 unique event_id
 enum event_type canceled|class upgrade|added luggage|request to cancel
 fk booked_ticket_id silver_booked_tickets
silver_booked_tickets
 not_null booked_ticket_id ticket_class customer_passport_id
 unique booked_ticket_id
 enum ticket_class first|business|economy
 fk customer_passport_id silver_customers
"""

GOLD = """
gold_dim_monthly_delays
 not_null delays_id most_frequent_delay average_delay minimal_delay maximal_delay year month ingestion_time
 unique delays_id
 unique year month
 warn min average_delay 0
 order average_delay maximal_delay
 order minimal_delay average_delay
gold_dim_monthly_flight_info
 not_null flights_info_id total_flights total_passengers_number average_passengers_number_on_flight year month ingestion_time
 unique flights_info_id
 unique year month
 min total_passengers_number 0
 min average_passengers_number_on_flight 0
gold_dim_monthly_revenue
 not_null revenue_id max_revenue_class total_revenue revenue_per_passenger average_ticket_price cancelation_rate year month ingestion_time
 unique revenue_id
 unique year month
 min total_revenue 0
 min revenue_per_passenger 0
 range cancelation_rate 0 1
gold_dim_monthly_most_popular
 not_null metrics_id most_popular_origin most_popular_destination most_popular_order_method year month
 unique metrics_id
 unique year month
gold_fact_monthly_performance_report
 not_null report_id revenue_id flights_info_id metrics_id delays_id year month
 unique report_id
 unique year month
 fk revenue_id gold_dim_monthly_revenue
 fk flights_info_id gold_dim_monthly_flight_info
 fk metrics_id gold_dim_monthly_most_popular
 fk delays_id gold_dim_monthly_delays
gold_monthly_aggregates
 not_null aggregate_id year month total_flights total_revenue average_delay most_popular_destination most_popular_order_method
 unique aggregate_id
 unique year month
gold_dim_ml_routes
 not_null route_id airport_origin airport_destination time_of_flight distance_km ingestion_time
 unique route_id
 min time_of_flight 0
 above distance_km 0
gold_dim_ml_weather
 not_null weather_id majority_weather_condition number_of_most_common_condition average_height average_temperature average_humidity average_wind_speed average_wind_direction ingestion_time
 unique weather_id
 min average_temperature -100
 min average_humidity 0
gold_dim_ml_boarding_data
 not_null boarding_data_id max_passenger_capacity max_luggage_weight_capacity
 unique boarding_data_id
gold_fact_ml_training
 not_null training_set_id weather_id route_id boarding_data_id delay_in_minutes ingestion_time
 unique training_set_id
 warn min delay_in_minutes 0
 fk route_id gold_dim_ml_routes
 fk weather_id gold_dim_ml_weather
 fk boarding_data_id gold_dim_ml_boarding_data
"""

BRONZE = """
routes_raw
 not_null route_id
 range latitude_origin -90 90
 range longitude_origin -180 180
 range latitude_destination -90 90
 range longitude_destination -180 180
flights
 not_null flight_id schedualed_arrival schedualed_departure
ticket_prices
 not_null price_id
 min price 0
 min luggage_fee 0
booked_tickets_raw
 not_null booked_ticket_id
 missing min ticket_price
flight_weather_raw_api
 not_null weather_sample_id sample_for_date
 range latitude -90 90
 range longitude -180 180
registered_customers
 not_null customer_passport_id
route_weather_points
 not_null route_id
 range latitude -90 90
 range longitude -180 180
boarding_events_raw
 not_null event_id event_time ingestion_time
flight_events_raw
 not_null event_id event_time
ticket_events_raw
 not_null event_id event_time
"""


class Rule(NamedTuple):
    table: str
    kind: str
    columns: tuple[str, ...]
    params: tuple = ()
    severity: str = "error"


def _number(text: str):
    return float(text) if "." in text else int(text)


def parsed(text: str) -> list[Rule]:
    rules, table = [], ""
    for line in filter(None, text.splitlines()):
        if not line.startswith(" "):
            table = line
            continue
        line = line.strip()
        severity = "error"
        if line.startswith("warn "):
            severity, line = "warn", line[5:]
        kind, rest = line.split(" ", 1)
        a = rest.split()
        if kind == "not_null":
            rules += [Rule(table, kind, (c,), (), severity) for c in a]
        elif kind == "range":
            rules.append(Rule(table, kind, (a[0],), (_number(a[1]), _number(a[2])), severity))
        elif kind in ("min", "above"):
            rules.append(Rule(table, "min", (a[0],), (_number(a[1]), kind == "above"), severity))
        elif kind in ("order", "before"):
            rules.append(Rule(table, "order", tuple(a), (kind == "before",), severity))
        elif kind == "enum":
            column, values = rest.split(" ", 1)
            rules.append(Rule(table, kind, (column,), tuple(values.split("|")), severity))
        elif kind == "derived":
            rules.append(Rule(table, kind, tuple(a), (0.001,), severity))
        elif kind == "unique":
            rules.append(Rule(table, kind, tuple(a), (), severity))
        elif kind == "fk":
            rules.append(Rule(table, kind, (a[0],), (a[1], a[-1] if len(a) > 2 else a[0]), severity))
        elif kind == "missing":
            rules.append(Rule(table, a[0], (a[1],), ("missing",), severity))
        else:
            raise ValueError(line)
    return rules


def _of(rules: list[Rule], *kinds: str) -> list[Rule]:
    return [r for r in rules if r.kind in kinds]


def rule_sets() -> dict[str, tuple[str, list[Rule]]]:
    """Query name to (layer, rules)."""
    silver, gold = parsed(SILVER), parsed(GOLD)
    return {
        "dq_bronze": ("bronze", parsed(BRONZE)),
        "dq_not_null": ("silver", _of(silver, "not_null")),
        "dq_range": ("silver", _of(silver, "range")),
        "dq_bounds": ("silver", _of(silver, "min")),
        "dq_pk_unique": ("silver", _of(silver, "unique")),
        "dq_fk": ("silver", _of(silver, "fk")),
        "dq_enum": ("silver", _of(silver, "enum")),
        "dq_order": ("silver", _of(silver, "order")),
        "dq_derived": ("silver", _of(silver, "derived")),
        "dq_rate": ("all", [r for r in silver + gold if r.kind == "range" and r.columns[0].endswith("rate")]),
        "dq_kpi_not_null": ("gold", _of(gold, "not_null")),
        "dq_dim_completeness": ("gold", _of(gold, "fk")),
        "dq_dim_keys": ("gold", _of(gold, "unique")),
        "dq_aggregate_consistency": ("all", [
            Rule("gold_dim_monthly_flight_info", "consistent", ("total_flights",),
                 (("year", "month"), "recomputed_flight_counts", "total_flights", 0.000001)),
            Rule("gold_dim_monthly_revenue", "consistent", ("total_revenue",),
                 (("year", "month"), "recomputed_revenue", "total_revenue", 0.000001))]),
        "dq_date_logic": ("silver", [
            Rule("silver_booked_tickets", "cross_order", ("booking_date", "flight_date"), ("flight_id", "silver_flights", "flight_id")),
            Rule("silver_ticket_prices", "order", ("start_date", "end_date"), (False,)),
            Rule("silver_flights", "order", ("scheduled_departure", "scheduled_arrival"), (True,)),
            Rule("silver_booked_tickets", "cross_order", ("booking_date", "event_time"),
                 ("booked_ticket_id", "silver_ticket_events", "booked_ticket_id")),
            Rule("silver_flights", "cross_order", ("flight_date", "event_time"), ("flight_id", "silver_flights_events", "flight_id"), "warn")]),
        "dq_silver_report": ("silver", silver),
        "dq_gold_report": ("gold", gold),
    }
