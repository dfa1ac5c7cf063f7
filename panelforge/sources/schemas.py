"""Schemas of raw records and stream messages, stated once."""

from __future__ import annotations

# Field names and types of the record layouts.
TRAFFIC_RAW = """
source string, provider string, city string, segment_id string, segment_name string, weather_cell_id string,
district string, lat double, lon double, geometry string, event_time string, ingestion_time string, time_bucket string,
timestamp string, currentSpeed double, freeFlowSpeed double, jamFactor double, confidence double,
currentTravelTime double, freeFlowTravelTime double, roadClosure boolean, raw string
"""
WEATHER_RAW = """
source string, provider string, city string, weather_cell_id string, point_id string, lat double, lon double,
event_time string, ingestion_time string, time_bucket string, timestamp string, api_dt long, temp double,
feels_like double, humidity double, pressure double, visibility double, rain_1h double, wind_speed double,
wind_deg double, clouds int, weather_id int, weather_main string, weather_desc string, raw string
"""
NEWS_RAW = """
source string, provider string, event_type string, external_id string, title string, summary string, source_url string,
published_at string, city_hint string, ingestion_time string, content string, html string, author string, tags string,
language string, encoding string, http_status string
"""
TOPICS = {
    "events.news": """
        event_id string, source string, source_url string, crawled_at timestamp, published_at timestamp, title string,
        content string, event_type string, severity int, location_entity string, lat double, lon double,
        snapped_segment_id string, snap_distance_m double, event_confidence double, city string,
        mirrored_sources string, raw_html_path string""",
    "traffic.realtime.tomtom": """
        segment_id string, current_speed double, free_flow_speed double, jam_factor double, congestion_ratio double,
        confidence double, latitude double, longitude double, functional_road_class string, road_closure boolean,
        source string, timestamp string""",
    "weather.current": """
        city string, latitude double, longitude double, temperature double, feels_like double, humidity int,
        pressure int, visibility int, wind_speed double, wind_degree int, rain_1h double, rain_3h double,
        cloudiness int, description string, weather_main string, source string, timestamp string""",
}
TOPIC_TABLES = {
    "events.news": "bronze_events_raw",
    "traffic.realtime.tomtom": "bronze_traffic_raw",
    "weather.current": "bronze_weather_raw",
}


def topic_schema(topic: str) -> str:
    if topic not in TOPICS:
        raise ValueError(f"unknown topic: {topic}")
    return TOPICS[topic]


def topic_table(topic: str) -> str:
    return TOPIC_TABLES.get(topic, f"bronze_{topic.replace('.', '_')}_raw")
