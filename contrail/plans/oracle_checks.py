"""The declared checks as fixed SQL: (name, table, count of violations)."""

# One line for each check.
CHECKS = (
    ('unique__raw.flights__rownames', 'raw.flights',
     'SELECT count(*) FROM (SELECT (rownames) AS x FROM raw_flights WHERE TRUE AND (rownames) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__raw.flights__rownames', 'raw.flights',
     'SELECT count(*) FROM raw_flights WHERE TRUE AND (rownames) IS NULL'),
    ('not_null__raw.flights__carrier', 'raw.flights',
     'SELECT count(*) FROM raw_flights WHERE TRUE AND (carrier) IS NULL'),
    ('not_null__raw.flights__origin', 'raw.flights',
     'SELECT count(*) FROM raw_flights WHERE TRUE AND (origin) IS NULL'),
    ('accepted_values__raw.flights__origin', 'raw.flights',
     "SELECT count(*) FROM raw_flights WHERE TRUE AND (origin) IS NOT NULL AND (origin) NOT IN ('CLI', 'ERR', 'PUR', 'SIG', 'VIE')"),
    ('not_null__raw.weather__origin', 'raw.weather',
     'SELECT count(*) FROM raw_weather WHERE TRUE AND (origin) IS NULL'),
    ('not_null__raw.weather__time_hour', 'raw.weather',
     'SELECT count(*) FROM raw_weather WHERE TRUE AND (time_hour) IS NULL'),
    ('unique__raw.planes__tailnum', 'raw.planes',
     'SELECT count(*) FROM (SELECT (tailnum) AS x FROM raw_planes WHERE TRUE AND (tailnum) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__raw.planes__tailnum', 'raw.planes',
     'SELECT count(*) FROM raw_planes WHERE TRUE AND (tailnum) IS NULL'),
    ('unique__raw.airlines__carrier', 'raw.airlines',
     'SELECT count(*) FROM (SELECT (carrier) AS x FROM raw_airlines WHERE TRUE AND (carrier) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__raw.airlines__carrier', 'raw.airlines',
     'SELECT count(*) FROM raw_airlines WHERE TRUE AND (carrier) IS NULL'),
    ('unique__raw.airports__faa', 'raw.airports',
     'SELECT count(*) FROM (SELECT (faa) AS x FROM raw_airports WHERE TRUE AND (faa) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__raw.airports__faa', 'raw.airports',
     'SELECT count(*) FROM raw_airports WHERE TRUE AND (faa) IS NULL'),
    ('unique__raw.ourairports_airports__id', 'raw.ourairports_airports',
     'SELECT count(*) FROM (SELECT (id) AS x FROM raw_ourairports WHERE TRUE AND (id) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__raw.ourairports_airports__id', 'raw.ourairports_airports',
     'SELECT count(*) FROM raw_ourairports WHERE TRUE AND (id) IS NULL'),
    ('unique__raw.ourairports_airports__ident', 'raw.ourairports_airports',
     'SELECT count(*) FROM (SELECT (ident) AS x FROM raw_ourairports WHERE TRUE AND (ident) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__raw.ourairports_airports__ident', 'raw.ourairports_airports',
     'SELECT count(*) FROM raw_ourairports WHERE TRUE AND (ident) IS NULL'),
    ('unique__raw.openflights_airlines__airline_id', 'raw.openflights_airlines',
     'SELECT count(*) FROM (SELECT (airline_id) AS x FROM raw_openflights WHERE TRUE AND (airline_id) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__raw.openflights_airlines__airline_id', 'raw.openflights_airlines',
     'SELECT count(*) FROM raw_openflights WHERE TRUE AND (airline_id) IS NULL'),
    ('unique__stg_flight__flight_key', 'stg_flight',
     'SELECT count(*) FROM (SELECT (flight_key) AS x FROM s_flight WHERE TRUE AND (flight_key) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__stg_flight__flight_key', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND (flight_key) IS NULL'),
    ('not_null__stg_flight__flight_date', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND (flight_date) IS NULL'),
    ('not_null__stg_flight__carrier_code', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND (carrier_code) IS NULL'),
    ('relationships__stg_flight__carrier_code', 'stg_flight',
     'SELECT count(*) FROM s_flight c WHERE TRUE AND c.carrier_code IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_carrier WHERE s_carrier.carrier_code = c.carrier_code)'),
    ('not_null__stg_flight__origin_code', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND (origin_code) IS NULL'),
    ('not_null__stg_flight__scheduled_departure_minute', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND (scheduled_departure_minute) IS NULL'),
    ('within_range__stg_flight__scheduled_departure_minute', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND ((scheduled_departure_minute) < 0 OR (scheduled_departure_minute) > 1439)'),
    ('non_negative__stg_flight__distance_miles', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND (distance_miles) < 0'),
    ('non_negative__stg_flight__air_time_minutes', 'stg_flight',
     'SELECT count(*) FROM s_flight WHERE TRUE AND (air_time_minutes) < 0'),
    ('unique__stg_weather__origin_code_observed_hour_utc', 'stg_weather',
     'SELECT count(*) FROM (SELECT (concat(origin_code, cast(observed_hour_utc as string))) AS x FROM s_weather WHERE TRUE AND (concat(origin_code, cast(observed_hour_utc as string))) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__stg_weather__origin_code', 'stg_weather',
     'SELECT count(*) FROM s_weather WHERE TRUE AND (origin_code) IS NULL'),
    ('not_null__stg_weather__observed_hour_utc', 'stg_weather',
     'SELECT count(*) FROM s_weather WHERE TRUE AND (observed_hour_utc) IS NULL'),
    ('within_range__stg_weather__wind_speed_mph', 'stg_weather',
     'SELECT count(*) FROM s_weather WHERE (wind_speed_mph is not null) AND ((wind_speed_mph) < 0 OR (wind_speed_mph) > 200)'),
    ('unique__stg_plane__tail_number', 'stg_plane',
     'SELECT count(*) FROM (SELECT (tail_number) AS x FROM s_plane WHERE TRUE AND (tail_number) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__stg_plane__tail_number', 'stg_plane',
     'SELECT count(*) FROM s_plane WHERE TRUE AND (tail_number) IS NULL'),
    ('non_negative__stg_plane__seat_count', 'stg_plane',
     'SELECT count(*) FROM s_plane WHERE TRUE AND (seat_count) < 0'),
    ('within_range__stg_plane__manufactured_year', 'stg_plane',
     'SELECT count(*) FROM s_plane WHERE (manufactured_year is not null) AND ((manufactured_year) < 1950 OR (manufactured_year) > 2013)'),
    ('unique__stg_carrier__carrier_code', 'stg_carrier',
     'SELECT count(*) FROM (SELECT (carrier_code) AS x FROM s_carrier WHERE TRUE AND (carrier_code) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__stg_carrier__carrier_code', 'stg_carrier',
     'SELECT count(*) FROM s_carrier WHERE TRUE AND (carrier_code) IS NULL'),
    ('not_null__stg_carrier__carrier_name', 'stg_carrier',
     'SELECT count(*) FROM s_carrier WHERE TRUE AND (carrier_name) IS NULL'),
    ('unique__stg_airport_reference__ident', 'stg_airport_reference',
     'SELECT count(*) FROM (SELECT (ident) AS x FROM s_ref WHERE TRUE AND (ident) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__stg_airport_reference__ident', 'stg_airport_reference',
     'SELECT count(*) FROM s_ref WHERE TRUE AND (ident) IS NULL'),
    ('unique__stg_airport_reference__iata_code', 'stg_airport_reference',
     'SELECT count(*) FROM (SELECT (iata_code) AS x FROM s_ref WHERE (iata_code is not null) AND (iata_code) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('unique__stg_airport__airport_code', 'stg_airport',
     'SELECT count(*) FROM (SELECT (airport_code) AS x FROM s_airport WHERE TRUE AND (airport_code) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__stg_airport__airport_code', 'stg_airport',
     'SELECT count(*) FROM s_airport WHERE TRUE AND (airport_code) IS NULL'),
    ('accepted_values__stg_airport__source_system', 'stg_airport',
     "SELECT count(*) FROM s_airport WHERE TRUE AND (source_system) IS NOT NULL AND (source_system) NOT IN ('faa_matched_iata', 'faa_matched_local', 'faa_only', 'reference_only')"),
    ('within_range__stg_airport__latitude', 'stg_airport',
     'SELECT count(*) FROM s_airport WHERE TRUE AND ((latitude) < -90 OR (latitude) > 90)'),
    ('within_range__stg_airport__longitude', 'stg_airport',
     'SELECT count(*) FROM s_airport WHERE TRUE AND ((longitude) < -180 OR (longitude) > 180)'),
    ('unique__dim_date__date_key', 'dim_date',
     'SELECT count(*) FROM (SELECT (date_key) AS x FROM d_date WHERE TRUE AND (date_key) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_date__date_key', 'dim_date',
     'SELECT count(*) FROM d_date WHERE TRUE AND (date_key) IS NULL'),
    ('unique__dim_date__date_day', 'dim_date',
     'SELECT count(*) FROM (SELECT (date_day) AS x FROM d_date WHERE TRUE AND (date_day) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_date__date_day', 'dim_date',
     'SELECT count(*) FROM d_date WHERE TRUE AND (date_day) IS NULL'),
    ('within_range__dim_date__calendar_month', 'dim_date',
     'SELECT count(*) FROM d_date WHERE TRUE AND ((calendar_month) < 1 OR (calendar_month) > 12)'),
    ('unique__dim_airport__airport_key', 'dim_airport',
     'SELECT count(*) FROM (SELECT (airport_key) AS x FROM d_airport WHERE TRUE AND (airport_key) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_airport__airport_key', 'dim_airport',
     'SELECT count(*) FROM d_airport WHERE TRUE AND (airport_key) IS NULL'),
    ('unique__dim_airport__airport_code', 'dim_airport',
     'SELECT count(*) FROM (SELECT (airport_code) AS x FROM d_airport WHERE TRUE AND (airport_code) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_airport__airport_code', 'dim_airport',
     'SELECT count(*) FROM d_airport WHERE TRUE AND (airport_code) IS NULL'),
    ('not_null__dim_airport__airport_name', 'dim_airport',
     'SELECT count(*) FROM d_airport WHERE TRUE AND (airport_name) IS NULL'),
    ('non_negative__dim_airport__flight_count_2013', 'dim_airport',
     'SELECT count(*) FROM d_airport WHERE TRUE AND (flight_count_2013) < 0'),
    ('unique__dim_carrier__carrier_key', 'dim_carrier',
     'SELECT count(*) FROM (SELECT (carrier_key) AS x FROM d_carrier WHERE TRUE AND (carrier_key) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_carrier__carrier_key', 'dim_carrier',
     'SELECT count(*) FROM d_carrier WHERE TRUE AND (carrier_key) IS NULL'),
    ('unique__dim_carrier__carrier_code', 'dim_carrier',
     'SELECT count(*) FROM (SELECT (carrier_code) AS x FROM d_carrier WHERE TRUE AND (carrier_code) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_carrier__carrier_code', 'dim_carrier',
     'SELECT count(*) FROM d_carrier WHERE TRUE AND (carrier_code) IS NULL'),
    ('unique__dim_aircraft__aircraft_key', 'dim_aircraft',
     'SELECT count(*) FROM (SELECT (aircraft_key) AS x FROM d_aircraft WHERE TRUE AND (aircraft_key) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_aircraft__aircraft_key', 'dim_aircraft',
     'SELECT count(*) FROM d_aircraft WHERE TRUE AND (aircraft_key) IS NULL'),
    ('unique__dim_aircraft__tail_number', 'dim_aircraft',
     'SELECT count(*) FROM (SELECT (tail_number) AS x FROM d_aircraft WHERE TRUE AND (tail_number) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__dim_aircraft__tail_number', 'dim_aircraft',
     'SELECT count(*) FROM d_aircraft WHERE TRUE AND (tail_number) IS NULL'),
    ('accepted_values__dim_aircraft__size_class', 'dim_aircraft',
     "SELECT count(*) FROM d_aircraft WHERE TRUE AND (size_class) IS NOT NULL AND (size_class) NOT IN ('regional', 'narrowbody', 'widebody', 'unknown')"),
    ('non_negative__dim_aircraft__age_years_in_2013', 'dim_aircraft',
     'SELECT count(*) FROM d_aircraft WHERE (age_years_in_2013 is not null) AND (age_years_in_2013) < 0'),
    ('unique__fct_flight__flight_key', 'fct_flight',
     'SELECT count(*) FROM (SELECT (flight_key) AS x FROM fct WHERE TRUE AND (flight_key) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__fct_flight__flight_key', 'fct_flight',
     'SELECT count(*) FROM fct WHERE TRUE AND (flight_key) IS NULL'),
    ('not_null__fct_flight__date_key', 'fct_flight',
     'SELECT count(*) FROM fct WHERE TRUE AND (date_key) IS NULL'),
    ('relationships__fct_flight__date_key', 'fct_flight',
     'SELECT count(*) FROM fct c WHERE TRUE AND c.date_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_date WHERE d_date.date_key = c.date_key)'),
    ('not_null__fct_flight__carrier_key', 'fct_flight',
     'SELECT count(*) FROM fct WHERE TRUE AND (carrier_key) IS NULL'),
    ('relationships__fct_flight__carrier_key', 'fct_flight',
     'SELECT count(*) FROM fct c WHERE TRUE AND c.carrier_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_carrier WHERE d_carrier.carrier_key = c.carrier_key)'),
    ('not_null__fct_flight__origin_airport_key', 'fct_flight',
     'SELECT count(*) FROM fct WHERE TRUE AND (origin_airport_key) IS NULL'),
    ('relationships__fct_flight__origin_airport_key', 'fct_flight',
     'SELECT count(*) FROM fct c WHERE TRUE AND c.origin_airport_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_airport WHERE d_airport.airport_key = c.origin_airport_key)'),
    ('not_null__fct_flight__destination_airport_key', 'fct_flight',
     'SELECT count(*) FROM fct WHERE TRUE AND (destination_airport_key) IS NULL'),
    ('relationships__fct_flight__destination_airport_key', 'fct_flight',
     'SELECT count(*) FROM fct c WHERE TRUE AND c.destination_airport_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_airport WHERE d_airport.airport_key = c.destination_airport_key)'),
    ('relationships__fct_flight__aircraft_key', 'fct_flight',
     'SELECT count(*) FROM fct c WHERE (tail_number is not null) AND c.aircraft_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_aircraft WHERE d_aircraft.aircraft_key = c.aircraft_key)'),
    ('non_negative__fct_flight__distance_miles', 'fct_flight',
     'SELECT count(*) FROM fct WHERE TRUE AND (distance_miles) < 0'),
    ('within_range__fct_flight__scheduled_departure_hour_local', 'fct_flight',
     'SELECT count(*) FROM fct WHERE TRUE AND ((scheduled_departure_hour_local) < 0 OR (scheduled_departure_hour_local) > 23)'),
    ('unique__mart_carrier_performance__carrier_code', 'mart_carrier_performance',
     'SELECT count(*) FROM (SELECT (carrier_code) AS x FROM m_carrier WHERE TRUE AND (carrier_code) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__mart_carrier_performance__carrier_code', 'mart_carrier_performance',
     'SELECT count(*) FROM m_carrier WHERE TRUE AND (carrier_code) IS NULL'),
    ('non_negative__mart_carrier_performance__flight_count', 'mart_carrier_performance',
     'SELECT count(*) FROM m_carrier WHERE TRUE AND (flight_count) < 0'),
    ('within_range__mart_carrier_performance__cancellation_rate_pct', 'mart_carrier_performance',
     'SELECT count(*) FROM m_carrier WHERE TRUE AND ((cancellation_rate_pct) < 0 OR (cancellation_rate_pct) > 100)'),
    ('within_range__mart_carrier_performance__arrival_delay_rate_pct', 'mart_carrier_performance',
     'SELECT count(*) FROM m_carrier WHERE TRUE AND ((arrival_delay_rate_pct) < 0 OR (arrival_delay_rate_pct) > 100)'),
    ('unique__mart_route_performance__route_code', 'mart_route_performance',
     'SELECT count(*) FROM (SELECT (route_code) AS x FROM m_route WHERE TRUE AND (route_code) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__mart_route_performance__route_code', 'mart_route_performance',
     'SELECT count(*) FROM m_route WHERE TRUE AND (route_code) IS NULL'),
    ('not_null__mart_route_performance__destination_name', 'mart_route_performance',
     'SELECT count(*) FROM m_route WHERE TRUE AND (destination_name) IS NULL'),
    ('within_range__mart_route_performance__cancellation_rate_pct', 'mart_route_performance',
     'SELECT count(*) FROM m_route WHERE TRUE AND ((cancellation_rate_pct) < 0 OR (cancellation_rate_pct) > 100)'),
    ('within_range__mart_route_performance__avg_ground_speed_mph', 'mart_route_performance',
     'SELECT count(*) FROM m_route WHERE (avg_ground_speed_mph is not null) AND ((avg_ground_speed_mph) < 50 OR (avg_ground_speed_mph) > 800)'),
    ('unique__mart_weather_impact__condition_type_condition_band', 'mart_weather_impact',
     'SELECT count(*) FROM (SELECT (concat(condition_type, condition_band)) AS x FROM m_weather WHERE TRUE AND (concat(condition_type, condition_band)) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('accepted_values__mart_weather_impact__condition_type', 'mart_weather_impact',
     "SELECT count(*) FROM m_weather WHERE TRUE AND (condition_type) IS NOT NULL AND (condition_type) NOT IN ('visibility', 'precipitation', 'wind')"),
    ('within_range__mart_weather_impact__departure_delay_rate_pct', 'mart_weather_impact',
     'SELECT count(*) FROM m_weather WHERE TRUE AND ((departure_delay_rate_pct) < 0 OR (departure_delay_rate_pct) > 100)'),
    ('unique__mart_daily_operations__date_day_origin_code', 'mart_daily_operations',
     'SELECT count(*) FROM (SELECT (concat(cast(date_day as string), origin_code)) AS x FROM m_daily WHERE TRUE AND (concat(cast(date_day as string), origin_code)) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__mart_daily_operations__date_day', 'mart_daily_operations',
     'SELECT count(*) FROM m_daily WHERE TRUE AND (date_day) IS NULL'),
    ('not_null__mart_daily_operations__origin_code', 'mart_daily_operations',
     'SELECT count(*) FROM m_daily WHERE TRUE AND (origin_code) IS NULL'),
    ('accepted_values__mart_daily_operations__origin_code', 'mart_daily_operations',
     "SELECT count(*) FROM m_daily WHERE TRUE AND (origin_code) IS NOT NULL AND (origin_code) NOT IN ('CLI', 'ERR', 'PUR', 'SIG', 'VIE')"),
    ('non_negative__mart_daily_operations__flight_count', 'mart_daily_operations',
     'SELECT count(*) FROM m_daily WHERE TRUE AND (flight_count) < 0'),
    ('unique__mart_aircraft_utilization__tail_number', 'mart_aircraft_utilization',
     'SELECT count(*) FROM (SELECT (tail_number) AS x FROM m_aircraft WHERE TRUE AND (tail_number) IS NOT NULL GROUP BY x HAVING count(*) > 1)'),
    ('not_null__mart_aircraft_utilization__tail_number', 'mart_aircraft_utilization',
     'SELECT count(*) FROM m_aircraft WHERE TRUE AND (tail_number) IS NULL'),
    ('within_range__mart_aircraft_utilization__flights_per_active_day', 'mart_aircraft_utilization',
     'SELECT count(*) FROM m_aircraft WHERE TRUE AND ((flights_per_active_day) < 1 OR (flights_per_active_day) > 30)'),
)
