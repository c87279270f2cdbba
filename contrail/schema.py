"""Canonical table specs: target columns, types and accepted source names.

The reference disagrees with itself on many column names (typos in bronze,
renamed columns in the validators); each canonical column below lists every
physical name it accepts, first match wins. These lists are data, not code.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data model (enumerations from the validators).
TICKET_CLASSES = ["first", "business", "economy"]
TICKET_EVENT_TYPES = ["canceled", "class upgrade", "added luggage", "request to cancel"]
# Kinds of delay and weather: the data model calls them enumerations and names no values; these are ours.
DELAY_REASONS = ["weather", "technical", "crew", "security"]
WEATHER_CONDITIONS = ["clear", "rain", "storm", "fog"]
CANCELED = "canceled"
DEPARTURE_EVENT = "actual_departure"
BOARDING_SCAN = "passenger_scanned"
ORDER_METHOD_LITERAL = "online"

S, I, D, L, B, DT, TS = "string", "int", "double", "bigint", "boolean", "date", "timestamp"
MONEY = "decimal(12,2)"
WEIGHT = "decimal(10,2)"
# Timestamps keep their input type (timestamp or timestamp_ntz): the spec
# type None means "no cast".
KEEP = None

SILVER = {
    "silver_routes": [
        (["routes_id", "route_id"], "routes_id", S),
        (["airport_origin"], "airport_origin", S),
        (["airport_destination"], "airport_destination", S),
        (["latitude_origin"], "latitude_origin", D),
        (["longitude_origin"], "longitude_origin", D),
        (["latitude_destination"], "latitude_destination", D),
        (["longitude_destination"], "longitude_destination", D),
        (["distance_km"], "distance_km", D),
    ],
    "silver_flights": [
        (["flight_id"], "flight_id", S),
        (["routes_id", "route_id"], "routes_id", S),
        (["possible_passenger_amount", "max_passenger_capacity"], "possible_passenger_amount", I),
        (["possible_luggage_weight", "possible_luggage_weight_kg", "max_luggage_weight_capacity",
          "max_lagguge_weight_capacity"], "possible_luggage_weight", I),
        (["flight_date"], "flight_date", DT),
        (["scheduled_departure", "schedualed_departure"], "scheduled_departure", KEEP),
        (["scheduled_arrival", "schedualed_arrival"], "scheduled_arrival", KEEP),
    ],
    "silver_waypoint_sampling_weather_points": [
        (["route_id", "routes_id"], "route_id", S),
        (["way_point_number"], "way_point_number", I),
        (["point_latitude", "latitude"], "point_latitude", D),
        (["point_longitude", "longitude"], "point_longitude", D),
        (["point_height", "height"], "point_height", D),
    ],
    "silver_ticket_prices": [
        (["price_id"], "price_id", S),
        (["silver_flight_id", "flight_id"], "silver_flight_id", S),
        (["ticket_class", "class"], "ticket_class", S),
        (["ticket_price", "price"], "ticket_price", MONEY),
        (["luggage_fee"], "luggage_fee", MONEY),
        (["start_date"], "start_date", DT),
        (["end_date"], "end_date", DT),
        (["actual"], "actual", B),
    ],
    "silver_customers": [
        (["customer_passport_id", "passenger_passport_id"], "customer_passport_id", S),
        (["customer_first_name", "passenger_first_name"], "customer_first_name", S),
        (["customer_last_name", "passenger_last_name"], "customer_last_name", S),
        (["customer_nationality", "passenger_nationality"], "customer_nationality", S),
        (["customer_email", "passenger_email"], "customer_email", S),
        (["customer_membership_tier", "customer_membership"], "customer_membership_tier", S),
        (["customer_date_of_birth", "date_of_birth"], "customer_date_of_birth", DT),
    ],
    "silver_flights_events": [
        (["flight_event_id", "event_id"], "flight_event_id", S),
        (["flight_id"], "flight_id", S),
        (["event_type"], "event_type", S),
        (["delay_reason"], "delay_reason", S),
        (["event_time"], "event_time", KEEP),
    ],
    "silver_booked_tickets": [
        (["booked_ticket_id"], "booked_ticket_id", S),
        (["customer_passport_id", "passenger_passport_id"], "customer_passport_id", S),
        (["ticket_class", "class"], "ticket_class", S),
        (["order_method"], "order_method", S),
        (["booking_date"], "booking_date", DT),
        (["flight_id"], "flight_id", S),
    ],
    "silver_ticket_events": [
        (["event_id"], "event_id", S),
        (["booked_ticket_id"], "booked_ticket_id", S),
        (["event_type"], "event_type", S),
        (["event_time"], "event_time", KEEP),
    ],
}

# Fixed values. Bronze physical names the reference jobs read (typos included), used to
# present fixture tables in bronze shape: canonical → physical.
BRONZE_NAMES = {
    "silver_routes": {"routes_id": "route_id"},
    "silver_flights": {"routes_id": "route_id", "possible_passenger_amount": "max_passenger_capacity",
                       "possible_luggage_weight": "max_lagguge_weight_capacity",
                       "scheduled_departure": "schedualed_departure", "scheduled_arrival": "schedualed_arrival"},
    "silver_waypoint_sampling_weather_points": {"point_latitude": "latitude", "point_longitude": "longitude",
                                                "point_height": "height"},
    "silver_ticket_prices": {"silver_flight_id": "flight_id", "ticket_class": "class", "ticket_price": "price"},
    "silver_customers": {"customer_nationality": "passenger_nationality", "customer_email": "passenger_email"},
    "silver_flights_events": {"flight_event_id": "event_id"},
    "silver_booked_tickets": {"customer_passport_id": "passenger_passport_id", "ticket_class": "class"},
    "silver_ticket_events": {},
}

# Fixed values. Required columns per table (Q1), canonical names.
REQUIRED = {
    "silver_routes": ["routes_id", "airport_origin", "airport_destination", "latitude_origin", "longitude_origin",
                      "latitude_destination", "longitude_destination", "distance_km"],
    "silver_flights": ["flight_id", "routes_id", "possible_passenger_amount", "flight_date", "scheduled_departure",
                       "scheduled_arrival", "possible_luggage_weight"],
    "silver_waypoint_sampling_weather_points": ["route_id", "way_point_number", "point_latitude", "point_longitude",
                                                "point_height"],
    "silver_ticket_prices": ["price_id", "silver_flight_id", "ticket_class", "ticket_price", "luggage_fee",
                             "start_date", "end_date", "actual"],
    "silver_customers": ["customer_passport_id", "customer_first_name", "customer_last_name",
                         "customer_date_of_birth", "customer_nationality", "customer_email",
                         "customer_membership_tier"],
    "silver_flights_events": ["flight_event_id", "flight_id", "event_type", "event_time"],
    "silver_boarding_summary": ["flight_id", "boarding_date", "passenger_count", "baggage_count",
                                "total_baggage_weight", "avg_baggage_per_passenger", "avg_baggage_weight"],
    "silver_agg_frequent_delay_reasons": ["delay_id", "silver_flight_event", "total_occurences"],
    "silver_flight_weather": ["weather_sample_id", "silver_flight_id", "waypoint_sampling_number", "temperature",
                              "humidity", "wind_speed", "wind_direction", "weather_condition", "sample_for_date"],
    "silver_weather_summary": ["flight_id", "average_temperature", "average_humidity", "average_wind_speed",
                               "average_wind_direction", "majority_weather_condition"],
    "silver_agg_cancelation_rate": ["total_booking", "total_cancelation", "cancelation_rate"],
    "silver_ticket_events": ["event_id", "booked_ticket_id", "event_type", "event_time"],
    "silver_booked_tickets": ["booked_ticket_id", "ticket_class", "customer_passport_id", "order_method",
                              "booking_date"],
    "gold_dim_monthly_delays": ["delays_id", "most_frequent_delay", "average_delay", "minimal_delay",
                                "maximal_delay", "year", "month"],
    "gold_dim_monthly_flight_info": ["flights_info_id", "total_flights", "total_passengers_number",
                                     "average_passengers_number_on_flight", "year", "month"],
    "gold_dim_monthly_revenue": ["revenue_id", "max_revenue_class", "total_revenue", "revenue_per_passenger",
                                 "average_ticket_price", "cancelation_rate", "year", "month"],
    "gold_dim_monthly_most_popular": ["metrics_id", "most_popular_origin", "most_popular_destination",
                                      "most_popular_order_method", "year", "month"],
    "gold_fact_monthly_performance_report": ["report_id", "revenue_id", "flights_info_id", "metrics_id",
                                             "delays_id", "year", "month"],
    "gold_monthly_aggregates": ["aggregate_id", "year", "month", "total_flights", "total_revenue",
                                "average_delay", "most_popular_destination", "most_popular_order_method"],
    "gold_fact_ml_training": ["training_set_id", "weather_id", "route_id", "boarding_data_id", "delay_in_minutes"],
    "gold_dim_ml_routes": ["route_id", "airport_origin", "airport_destination", "time_of_flight", "distance_km"],
    "gold_dim_ml_weather": ["weather_id", "majority_weather_condition", "number_of_most_common_condition",
                            "average_height", "average_temperature", "average_humidity", "average_wind_speed",
                            "average_wind_direction"],
    "gold_dim_ml_boarding_data": ["boarding_data_id", "max_passenger_capacity", "max_luggage_weight_capacity"],
}

# The load time is required of the nineteen tables the validators name; the others carry it, too, when a layer run writes them.
NOT_VALIDATED = {"gold_dim_monthly_most_popular", "gold_fact_monthly_performance_report", "gold_monthly_aggregates",
                 "gold_dim_ml_boarding_data"}
REQUIRED = {t: cols if t in NOT_VALIDATED else [*cols, "ingestion_time"] for t, cols in REQUIRED.items()}

# Types of the tables that are aggregated or built, not conformed.
BUILT_TYPES = {
    "silver_boarding_summary": {"flight_id": S, "passenger_count": L, "baggage_count": L, "total_baggage_weight": MONEY,
                                "avg_baggage_per_passenger": D, "avg_baggage_weight": D, "boarding_date": DT},
    "silver_agg_frequent_delay_reasons": {"delay_id": S, "silver_flight_event": S, "total_occurences": L, "year": I,
                                          "month": I, "delay_reason": S},
    "silver_flight_weather": {"weather_sample_id": S, "silver_flight_id": S, "waypoint_sampling_number": I,
                              "weather_condition": S, "temperature": D, "humidity": D, "wind_speed": D,
                              "wind_direction": D, "sample_for_date": DT},
    "silver_weather_summary": {"flight_id": S, "average_temperature": D, "average_humidity": D,
                               "average_wind_speed": D, "average_wind_direction": D,
                               "majority_weather_condition": S},
    "silver_agg_cancelation_rate": {"year": I, "month": I, "total_booking": L, "total_cancelation": L,
                                    "cancelation_rate": D},
    "gold_dim_monthly_delays": {"delays_id": S, "most_frequent_delay": S, "average_delay": D, "minimal_delay": D,
                                "maximal_delay": D, "year": I, "month": I},
    "gold_dim_monthly_flight_info": {"flights_info_id": S, "total_flights": L, "total_passengers_number": L,
                                     "average_passengers_number_on_flight": D, "year": I, "month": I},
    "gold_dim_monthly_revenue": {"revenue_id": S, "max_revenue_class": S, "total_revenue": D,
                                 "revenue_per_passenger": D, "average_ticket_price": D, "cancelation_rate": D,
                                 "year": I, "month": I},
    "gold_dim_monthly_most_popular": {"metrics_id": S, "most_popular_origin": S, "most_popular_destination": S,
                                      "most_popular_order_method": S, "year": I, "month": I},
    "gold_fact_monthly_performance_report": {"report_id": S, "revenue_id": S, "flights_info_id": S, "metrics_id": S,
                                             "delays_id": S, "year": I, "month": I},
    "gold_monthly_aggregates": {"aggregate_id": S, "year": I, "month": I, "total_flights": L, "total_revenue": D,
                                "average_delay": D, "most_popular_destination": S, "most_popular_order_method": S},
    "gold_dim_ml_routes": {"route_id": S, "airport_origin": S, "airport_destination": S, "time_of_flight": D,
                           "distance_km": D},
    "gold_dim_ml_weather": {"weather_id": S, "majority_weather_condition": S, "number_of_most_common_condition": L,
                            "average_height": D, "average_temperature": D, "average_humidity": D,
                            "average_wind_speed": D, "average_wind_direction": D},
    "gold_dim_ml_boarding_data": {"boarding_data_id": S, "max_passenger_capacity": I,
                                  "max_luggage_weight_capacity": I},
    "gold_fact_ml_training": {"training_set_id": S, "weather_id": S, "route_id": S, "boarding_data_id": S,
                              "delay_in_minutes": D},
}

# The three tables the legacy bronze validator expects.
LEGACY_BRONZE = {
    "airports": ["iata", "city", "country"],
    "aircrafts": ["aircraft_id", "model", "capacity"],
    "flights": ["flight_id", "origin", "destination", "flight_date", "departure_time"],
}

S, I, D, F_, B, DT, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.FloatType(), T.BooleanType(), \
    T.DateType(), T.TimestampType()
DEC = T.DecimalType(12, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The ten bronze tables of the data model (ERD types; decimals 12,2).
BRONZE_SCHEMAS: dict[str, T.StructType] = {
    "routes_raw": _schema(("route_id", S), ("airport_origin", S), ("airport_destination", S),
                          ("latitude_origin", D), ("longitude_origin", D), ("latitude_destination", D),
                          ("longitude_destination", D), ("distance_km", F_)),
    "flights": _schema(("flight_id", S), ("route_id", S), ("max_passenger_capacity", I),
                       ("max_lagguge_weight_capacity", I), ("schedualed_arrival", TS), ("schedualed_departure", TS)),
    "ticket_prices": _schema(("price_id", S), ("flight_id", S), ("class", S), ("price", DEC), ("luggage_fee", DEC),
                             ("start_date", DT), ("end_date", DT), ("actual", B)),
    "booked_tickets_raw": _schema(("booked_ticket_id", S), ("passenger_passport_id", S), ("passenger_first_name", S),
                                  ("passenger_last_name", S), ("passenger_nationality", S), ("passenger_email", S),
                                  ("order_method", S), ("date_of_birth", DT), ("booking_date", DT),
                                  ("ticket_price", F_), ("class", S), ("luggage_class", S)),
    "flight_weather_raw_api": _schema(("weather_sample_id", S), ("latitude", D), ("longitude", D), ("height", D),
                                      ("temperature", D), ("humidity", D), ("wind_speed", D), ("wind_direction", D),
                                      ("current_weather_condition", S), ("sample_for_date", TS)),
    "registered_customers": _schema(("customer_passport_id", S), ("customer_first_name", S),
                                    ("customer_last_name", S), ("passenger_nationality", S), ("passenger_email", S),
                                    ("customer_date_of_birth", DT), ("customer_membership_tier", S)),
    "route_weather_points": _schema(("route_id", S), ("way_point_number", I), ("latitude", D), ("longitude", D),
                                    ("height", D)),
    "boarding_events_raw": _schema(("event_id", S), ("flight_id", S), ("event_type", S), ("passenger_id", S),
                                   ("baggage_weight", T.DecimalType(10, 2)), ("event_time", TS),
                                   ("ingestion_time", TS)),
    "flight_events_raw": _schema(("event_id", S), ("flight_id", S), ("event_type", S), ("delay_reason", S),
                                 ("event_time", TS)),
    "ticket_events_raw": _schema(("event_id", S), ("booked_ticket_id", S), ("event_type", S), ("event_time", TS)),
}
