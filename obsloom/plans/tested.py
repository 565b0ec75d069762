"""What the declared data tests ask of the tables."""

# Columns that must be unique, have a value, or be found in another table.
UNIQUE = {
    "stg_obs_daily": ["station_date_id"],
    "stg_obs_hourly": ["station_time_id"],
    "stg_obs_stations": ["station_id"],
    "stg_city_coord": ["uace"],
    "stg_city_pop": ["city_pop_id"],
    "city_coord_and_pop": ["city_coord_pop_id"],
    "mart_city_dim": ["city_coord_pop_id"],
    "mart_city_station_bridge": ["station_city_match_id"],
    "mart_date_dim": ["date_key"],
    "mart_hour_dim": ["hour"],
    "mart_obs_window_fact": ["station_anchor_obs_id"],
    "mart_stations_dim": ["station_id"],
    "mart_station_obs_qc_obt": ["station_id"],
}
NOT_NULL = {
    "stg_obs_daily": ["station_date_id", "obs_date"],
    "stg_obs_hourly": ["station_time_id", "obs_time"],
    "stg_obs_stations": ["station_id"],
    "stg_city_coord": ["uace"],
    "stg_city_pop": ["city_pop_id", "city_name"],
    "city_coord_and_pop": ["city_coord_pop_id"],
    "mart_city_dim": ["city_coord_pop_id"],
    "mart_city_station_bridge": ["station_city_match_id", "station_id"],
    "mart_date_dim": ["date_key"],
    "mart_hour_dim": ["hour"],
    "mart_obs_fact": ["station_id", "obs_date"],
    "mart_obs_window_fact": ["station_anchor_obs_id", "station_anchor_id", "station_id"],
    "mart_stations_dim": ["station_id"],
    "mart_station_obs_qc_obt": ["station_id"],
}
RELATIONSHIPS = [("mart_city_station_bridge", "city_dim_id", "mart_city_dim", "city_coord_pop_id")]
