"""Schemas of the raw tables."""

_SHARED = ("source string, ingest_time timestamp, raw_loaded_at timestamp, raw_sync_run_id string, "
           "raw_sync_started_at timestamp, raw_source_file_name string, raw_source_file_id string, "
           "ingest_batch_id string")
_STATION = ("station_name string, timestamp_utc timestamp, parameter string, value float, aqi_reported int, "
            "unit string, quality_flag string, raw_payload string, ingest_date date")

RAW_SCHEMAS = {
    "raw_openweather_measurements": f"{_SHARED}, ward_code string, ward_name string, province_name string, "
        "latitude double, longitude double, timestamp_utc timestamp, parameter string, value float, "
        "aqi_reported smallint, quality_flag string, raw_payload string, ingest_date date",
    "raw_aqiin_measurements": f"{_SHARED}, {_STATION}",
    "raw_waqi_measurements": f"{_SHARED}, {_STATION}",
    "dim_waqi_stations": "station_id bigint, station_name string, latitude double, longitude double, "
        "city_url string, updated_at timestamp",
    "raw_tomtom_traffic": f"{_SHARED}, traffic_source string, ward_code string, ward_name string, "
        "province_name string, latitude double, longitude double, nearest_highway_type string, "
        "distance_to_road_km float, timestamp_utc timestamp, current_speed float, free_flow_speed float, "
        "current_travel_time int, free_flow_travel_time int, confidence float, road_closure smallint, "
        "raw_payload string",
    "raw_openweather_meteorology": f"{_SHARED}, province_name string, weather_cluster string, cluster_lat double, "
        "cluster_lon double, timestamp_utc timestamp, temp float, feels_like float, temp_min float, "
        "temp_max float, pressure int, humidity smallint, visibility bigint, wind_speed float, wind_deg int, "
        "clouds_all smallint, raw_payload string",
    "raw_tomtom_traffic_hourly": "source string, station_name string, latitude double, longitude double, "
        "hour_utc timestamp, congestion_ratio float, data_quality_flag string, updated_at timestamp",
    "ingestion_control": "source string, last_run timestamp, last_success timestamp, records_ingested bigint, "
        "lag_seconds bigint, error_message string, updated_at timestamp",
}

SEED_SCHEMAS = {
    "pollutants": "pollutant_key string, display_name string, unit string, epa_aqi_bp_lo double, "
        "epa_aqi_bp_hi double, conc_bp_lo double, conc_bp_hi double, health_effects string",
    "source_calibration": "source string, parameter string, location_scope string, calibration_factor double, "
        "calibration_method string, notes string",
    "vn_traffic_profile": "location_type string, hour int, weight double",
}
