"""Independent SQL (DuckDB dialect) for every registered query.

These statements are written from the contracts, not generated from the
DataFrame code: they are the yardstick the Spark results are compared with.
Shared building blocks are kept as CTE text and stitched per query.
Arithmetic is forced to DOUBLE wherever Spark computes in double, and integer
results are cast to BIGINT, so types agree as well as values.
"""

from __future__ import annotations

from contrail.plans.oracle_checks import CHECKS
from contrail.sources.schemas import RAW_SCHEMAS


def _hhmm(m: str) -> str:
    return f"(({m}) // 60 * 100 + ({m}) % 60)"


def _minute(c: str) -> str:
    return f"(({c}) // 100 * 60 + ({c}) % 100) % 1440"


def rhu(x: str, d: int) -> str:
    """Round half away from zero by scaling (same rule as round_half_up)."""
    s = f"{10 ** d}.0::DOUBLE"
    return f"(round(({x})::DOUBLE * {s}) / {s})"


def pct(num: str, den: str, d: int = 2) -> str:
    return rhu(f"100.0::DOUBLE * ({num})::DOUBLE / ({den})::DOUBLE", d)


def key(x: str) -> str:
    return f"md5(coalesce(CAST({x} AS VARCHAR), '^missing^'))"


RAW = f"""
f0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d,
         o_orderkey % 41 = 0 AS canc,
         o_orderkey % 41 <> 0 AND o_orderkey % 53 = 7 AS dive,
         300 + (o_orderkey * 7) % 1200 AS smin,
         (o_orderkey * 37) % 200 - 20 AS ddel,
         30 + (o_custkey * 11 + o_orderkey) % 300 AS blk,
         (o_orderkey * 7 + o_custkey) % 150 AS di
  FROM orders),
f1 AS (SELECT *, (smin + blk + 20) % 1440 AS samin, ddel + (k * 13) % 41 - 20 AS adel FROM f0),
raw_flights AS (
  SELECT k AS rownames, year(d)::BIGINT AS year, month(d)::BIGINT AS month, day(d)::BIGINT AS day,
    CASE WHEN NOT canc THEN {_hhmm('(smin + ddel) % 1440')} END AS dep_time,
    {_hhmm('smin')} AS sched_dep_time,
    CASE WHEN NOT canc THEN ddel END AS dep_delay,
    CASE WHEN NOT canc AND NOT dive THEN {_hhmm('(samin + adel + 1440) % 1440')} END AS arr_time,
    CASE WHEN NOT canc THEN {_hhmm('samin')} END AS sched_arr_time,
    CASE WHEN NOT canc AND NOT dive THEN adel END AS arr_delay,
    'C' || CAST(c % 16 AS VARCHAR) AS carrier,
    1000 + c % 4000 AS flight,
    CASE WHEN k % 97 = 0 THEN '  ' ELSE 'N' || CAST(c AS VARCHAR) END AS tailnum,
    CASE k % 5 WHEN 0 THEN 'CLI' WHEN 1 THEN 'ERR' WHEN 2 THEN 'PUR' WHEN 3 THEN 'SIG' ELSE 'VIE' END AS origin,
    'S' || CAST(di AS VARCHAR) AS dest,
    CASE WHEN NOT canc AND NOT dive THEN blk + k % 11 - 5 END AS air_time,
    100 + di * 17 AS distance,
    {_hhmm('smin')} // 100 AS hour,
    {_hhmm('smin')} % 100 AS minute,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(k % 720) AS time_hour
  FROM f1),
raw_weather AS (
  SELECT event_id AS rownames, upper(substr(event_type, 1, 3)) AS origin,
    year(ts)::BIGINT AS year, month(ts)::BIGINT AS month, day(ts)::BIGINT AS day, hour(ts)::BIGINT AS hour,
    CASE WHEN event_id % 29 <> 0 THEN value END AS temp,
    value - 5.0::DOUBLE AS dewp,
    CAST(event_id % 100 AS DOUBLE) AS humid,
    (event_id * 10) % 360 AS wind_dir,
    CASE WHEN event_id % 101 = 0 THEN value + 1000.0::DOUBLE ELSE value / 4.0::DOUBLE END AS wind_speed,
    CASE WHEN event_id % 3 <> 0 THEN value / 2.0::DOUBLE END AS wind_gust,
    CAST(event_id % 8 AS DOUBLE) / 20.0::DOUBLE AS precip,
    990.0::DOUBLE + CAST(event_id % 40 AS DOUBLE) AS pressure,
    CAST((event_id * 7) % 12 AS DOUBLE) AS visib,
    date_trunc('hour', ts) AS time_hour
  FROM events),
raw_planes AS (
  SELECT p_partkey AS rownames, 'N' || CAST(p_partkey * 2 AS VARCHAR) AS tailnum,
    1960 + p_partkey % 54 AS year, p_type AS type, p_brand AS manufacturer,
    CASE WHEN p_partkey % 50 = 0 THEN ' ' ELSE p_name END AS model,
    1 + p_partkey % 4 AS engines, CAST(p_size * 8 AS BIGINT) AS seats, CAST(NULL AS BIGINT) AS speed,
    CASE p_partkey % 3 WHEN 0 THEN 'Turbo-fan' WHEN 1 THEN 'Turbo-jet' ELSE 'Reciprocating' END AS engine
  FROM part),
raw_airlines AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS rownames, 'C' || CAST(n_nationkey AS VARCHAR) AS carrier,
         '  ' || n_name AS name
  FROM nation),
raw_airports AS (
  SELECT s_suppkey + 1 AS rownames, 'S' || CAST(s_suppkey AS VARCHAR) AS faa, s_name AS name,
    CAST(s_suppkey % 180 AS DOUBLE) - 90.0::DOUBLE AS lat,
    CAST((s_suppkey * 7) % 360 AS DOUBLE) - 180.0::DOUBLE AS lon,
    s_suppkey % 3000 AS alt, CAST(-5 - s_nationkey % 4 AS BIGINT) AS tz, 'A' AS dst,
    'Zone/' || CAST(s_nationkey AS VARCHAR) AS tzone
  FROM supplier
  UNION ALL
  SELECT 0, st, 'Hub ' || st, 40.0::DOUBLE, -74.0::DOUBLE, 10, -5, 'A', 'America/New_York'
  FROM (SELECT DISTINCT upper(substr(event_type, 1, 3)) AS st FROM events)),
raw_ourairports AS (
  SELECT p_partkey AS id, 'P' || CAST(p_partkey AS VARCHAR) AS ident,
    CASE p_partkey % 3 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport' ELSE 'small_airport' END AS type,
    p_name AS name,
    CAST(p_partkey % 180 AS DOUBLE) - 90.0::DOUBLE AS latitude_deg,
    CAST(p_partkey % 360 AS DOUBLE) - 180.0::DOUBLE AS longitude_deg,
    p_partkey % 5000 AS elevation_ft, 'NA' AS continent,
    'N' || CAST(p_partkey % 25 AS VARCHAR) AS iso_country,
    'R' || CAST(p_partkey % 50 AS VARCHAR) AS iso_region,
    CASE WHEN p_partkey % 10 = 0 THEN '' ELSE 'City' || CAST(p_partkey % 97 AS VARCHAR) END AS municipality,
    CASE WHEN p_partkey % 2 = 0 THEN 'yes' ELSE 'no' END AS scheduled_service,
    'I' || CAST(p_partkey AS VARCHAR) AS icao_code,
    CASE WHEN p_partkey % 4 = 0 THEN 'S' || CAST(p_partkey // 4 * 3 AS VARCHAR) END AS iata_code,
    CAST(NULL AS VARCHAR) AS gps_code,
    CASE p_partkey % 4 WHEN 1 THEN 'S' || CAST(p_partkey // 8 * 3 + 1 AS VARCHAR)
                       WHEN 3 THEN 'S' || CAST(p_partkey // 4 * 3 AS VARCHAR) END AS local_code,
    CAST(NULL AS VARCHAR) AS home_link, CAST(NULL AS VARCHAR) AS wikipedia_link,
    CAST(NULL AS VARCHAR) AS keywords
  FROM part),
raw_openflights AS (
  SELECT s_suppkey AS airline_id, s_name AS name, CAST(NULL AS VARCHAR) AS alias,
    CASE WHEN s_suppkey % 7 <> 0 THEN 'C' || CAST(s_suppkey % 25 AS VARCHAR) END AS iata,
    'X' || CAST(s_suppkey AS VARCHAR) AS icao, 'CALL' || CAST(s_nationkey AS VARCHAR) AS callsign,
    'NATION_' || CAST(s_nationkey AS VARCHAR) AS country,
    CASE WHEN s_suppkey % 3 = 0 THEN 'N' ELSE 'Y' END AS active
  FROM supplier)"""

STAGING = f"""
s_flight AS (
  SELECT rownames AS flight_key, make_date(year, month, day) AS flight_date, carrier AS carrier_code,
    flight::BIGINT AS flight_number, nullif(trim(tailnum), '') AS tail_number, origin AS origin_code,
    dest AS destination_code,
    {_minute('sched_dep_time')} AS scheduled_departure_minute,
    {_minute('sched_arr_time')} AS scheduled_arrival_minute,
    {_minute('dep_time')} AS actual_departure_minute,
    {_minute('arr_time')} AS actual_arrival_minute,
    dep_delay::BIGINT AS departure_delay_minutes, arr_delay::BIGINT AS arrival_delay_minutes,
    air_time::BIGINT AS air_time_minutes, distance::BIGINT AS distance_miles,
    time_hour AS scheduled_departure_hour_utc,
    dep_time IS NULL AS is_cancelled,
    dep_time IS NOT NULL AND arr_delay IS NULL AS is_diverted
  FROM raw_flights),
w_ren AS (
  SELECT origin AS origin_code, time_hour AS observed_hour_utc, temp AS temperature_f, dewp AS dew_point_f,
    humid AS relative_humidity_pct, wind_dir::BIGINT AS wind_direction_deg,
    CASE WHEN wind_speed <= 200 THEN wind_speed END AS wind_speed_mph,
    CASE WHEN wind_gust <= 200 THEN wind_gust END AS wind_gust_mph,
    precip AS precipitation_in, pressure AS sea_level_pressure_mb, visib AS visibility_miles
  FROM raw_weather),
s_weather AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY origin_code, observed_hour_utc
      ORDER BY temperature_f NULLS LAST, temperature_f NULLS LAST, dew_point_f NULLS LAST,
               relative_humidity_pct NULLS LAST, wind_direction_deg NULLS LAST, wind_speed_mph NULLS LAST,
               wind_gust_mph NULLS LAST, precipitation_in NULLS LAST, sea_level_pressure_mb NULLS LAST,
               visibility_miles NULLS LAST) AS rk
    FROM w_ren) WHERE rk = 1),
s_plane AS (
  SELECT tailnum AS tail_number, year::BIGINT AS manufactured_year, nullif(trim(type), '') AS airframe_type,
    nullif(trim(manufacturer), '') AS manufacturer, nullif(trim(model), '') AS model,
    engines::BIGINT AS engine_count, seats::BIGINT AS seat_count, nullif(trim(engine), '') AS engine_type
  FROM raw_planes),
of_active AS (
  SELECT nullif(trim(iata), '') AS code, nullif(trim(name), '') AS of_name, nullif(trim(icao), '') AS icao_code,
    nullif(trim(callsign), '') AS callsign, nullif(trim(country), '') AS country, active = 'Y' AS is_active
  FROM raw_openflights WHERE nullif(trim(iata), '') IS NOT NULL AND active = 'Y'),
of_best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY of_name NULLS LAST,
      icao_code NULLS LAST, callsign NULLS LAST, country NULLS LAST, is_active NULLS LAST) AS rk
    FROM of_active) WHERE rk = 1),
s_carrier AS (
  SELECT a.carrier AS carrier_code, nullif(trim(a.name), '') AS carrier_name, b.icao_code, b.callsign,
    b.country, coalesce(b.is_active, false) AS is_active_in_openflights
  FROM raw_airlines a LEFT JOIN of_best b ON a.carrier = b.code),
s_ref AS (
  SELECT ident, nullif(trim(type), '') AS airport_type, nullif(trim(name), '') AS airport_name,
    nullif(trim(iso_country), '') AS iso_country, nullif(trim(iso_region), '') AS iso_region,
    nullif(trim(municipality), '') AS municipality, scheduled_service = 'yes' AS has_scheduled_service,
    latitude_deg AS latitude, longitude_deg AS longitude, elevation_ft::BIGINT AS elevation_ft,
    nullif(trim(iata_code), '') AS iata_code, nullif(trim(local_code), '') AS local_code
  FROM raw_ourairports),
ref_iata AS (
  SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY iata_code ORDER BY ident) AS rk
    FROM s_ref WHERE iata_code IS NOT NULL) WHERE rk = 1),
ref_local AS (
  SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY local_code ORDER BY ident) AS rk
    FROM s_ref WHERE local_code IS NOT NULL AND iata_code IS NULL) WHERE rk = 1),
ap_matched AS (
  SELECT ap.faa AS airport_code, nullif(trim(ap.name), '') AS airport_name, ap.lat AS latitude,
    ap.lon AS longitude, ap.alt::BIGINT AS elevation_ft, ap.tz::BIGINT AS utc_offset_hours,
    nullif(trim(ap.tzone), '') AS time_zone,
    coalesce(i.airport_type, l.airport_type) AS airport_type,
    coalesce(i.iso_country, l.iso_country) AS iso_country,
    coalesce(i.iso_region, l.iso_region) AS iso_region,
    coalesce(i.municipality, l.municipality) AS municipality,
    coalesce(i.has_scheduled_service, l.has_scheduled_service) AS has_scheduled_service,
    CASE WHEN i.ident IS NOT NULL THEN 'faa_matched_iata'
         WHEN l.ident IS NOT NULL THEN 'faa_matched_local' ELSE 'faa_only' END AS source_system
  FROM raw_airports ap
  LEFT JOIN ref_iata i ON ap.faa = i.iata_code
  LEFT JOIN ref_local l ON ap.faa = l.local_code),
endpoints AS (
  SELECT origin_code AS airport_code FROM s_flight
  UNION
  SELECT destination_code FROM s_flight),
s_airport AS (
  SELECT * FROM ap_matched
  UNION ALL
  SELECT e.airport_code, i.airport_name, i.latitude, i.longitude, i.elevation_ft,
    CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), i.airport_type, i.iso_country, i.iso_region,
    i.municipality, i.has_scheduled_service, 'reference_only'
  FROM endpoints e JOIN ref_iata i ON e.airport_code = i.iata_code
  WHERE e.airport_code NOT IN (SELECT airport_code FROM ap_matched))"""

WAREHOUSE = f"""
spine AS (
  SELECT CAST(unnest(generate_series(min(flight_date), max(flight_date), INTERVAL 1 DAY)) AS DATE) AS date_day
  FROM s_flight),
hol AS (
  SELECT make_date(y, h.m, h.dd) AS holiday_date, h.holiday_name
  FROM (SELECT DISTINCT year(date_day) AS y FROM spine) yrs,
       (VALUES (1, 1, 'New Years Day'), (7, 4, 'Independence Day'), (11, 11, 'Veterans Day'),
               (12, 25, 'Christmas Day')) AS h(m, dd, holiday_name)
  UNION ALL
  SELECT CAST(make_date(y, h.m, 1) + CAST((h.dow - dayofweek(make_date(y, h.m, 1)) + 7) % 7 + 7 * (h.nth - 1) AS INTEGER) AS DATE), h.holiday_name
  FROM (SELECT DISTINCT year(date_day) AS y FROM spine) yrs,
       (VALUES (1, 1, 3, 'Martin Luther King Jr Day'), (2, 1, 3, 'Washingtons Birthday'), (9, 1, 1, 'Labor Day'),
               (10, 1, 2, 'Columbus Day'), (11, 4, 4, 'Thanksgiving Day')) AS h(m, dow, nth, holiday_name)
  UNION ALL
  SELECT CAST(make_date(y, 5, 31) - CAST((dayofweek(make_date(y, 5, 31)) + 6) % 7 AS INTEGER) AS DATE), 'Memorial Day'
  FROM (SELECT DISTINCT year(date_day) AS y FROM spine) yrs),
d_date AS (
  SELECT {key('s.date_day')} AS date_key, s.date_day,
    year(s.date_day)::BIGINT AS calendar_year, quarter(s.date_day)::BIGINT AS calendar_quarter,
    month(s.date_day)::BIGINT AS calendar_month, monthname(s.date_day) AS month_name,
    day(s.date_day)::BIGINT AS day_of_month, dayofweek(s.date_day)::BIGINT AS day_of_week,
    dayname(s.date_day) AS day_name, weekofyear(s.date_day)::BIGINT AS week_of_year,
    dayofweek(s.date_day) IN (0, 6) AS is_weekend,
    h.holiday_date IS NOT NULL AS is_holiday, h.holiday_name
  FROM spine s LEFT JOIN hol h ON s.date_day = h.holiday_date),
usage AS (
  SELECT code, sum(n)::BIGINT AS n FROM (
    SELECT destination_code AS code, count(*) AS n FROM s_flight GROUP BY destination_code
    UNION ALL
    SELECT origin_code, count(*) FROM s_flight GROUP BY origin_code) GROUP BY code),
d_airport AS (
  SELECT {key('a.airport_code')} AS airport_key, a.airport_code, a.airport_name, a.municipality,
    a.iso_country, a.iso_region, a.airport_type, a.latitude, a.longitude, a.elevation_ft, a.time_zone,
    a.utc_offset_hours, coalesce(a.has_scheduled_service, false) AS has_scheduled_service,
    a.source_system, a.airport_code IN ('CLI', 'ERR', 'PUR', 'SIG', 'VIE') AS is_nyc_origin,
    coalesce(u.n, 0)::BIGINT AS flight_count_2013
  FROM s_airport a LEFT JOIN usage u ON a.airport_code = u.code),
d_carrier AS (
  SELECT {key('carrier_code')} AS carrier_key, carrier_code, carrier_name, icao_code, callsign, country,
    is_active_in_openflights
  FROM s_carrier),
d_aircraft AS (
  SELECT {key('f.tail_number')} AS aircraft_key, f.tail_number, p.manufacturer, p.model, p.airframe_type,
    p.engine_type, p.engine_count, p.seat_count, p.manufactured_year,
    (2013 - p.manufactured_year)::BIGINT AS age_years_in_2013,
    CASE WHEN p.seat_count IS NULL THEN 'unknown' WHEN p.seat_count < 100 THEN 'regional'
         WHEN p.seat_count < 200 THEN 'narrowbody' ELSE 'widebody' END AS size_class,
    p.tail_number IS NOT NULL AS has_reference_record
  FROM (SELECT DISTINCT tail_number FROM s_flight WHERE tail_number IS NOT NULL) f
  LEFT JOIN s_plane p ON f.tail_number = p.tail_number),
fct AS (
  SELECT f.flight_key, {key('f.flight_date')} AS date_key, {key('f.carrier_code')} AS carrier_key,
    {key('f.origin_code')} AS origin_airport_key, {key('f.destination_code')} AS destination_airport_key,
    {key('f.tail_number')} AS aircraft_key, f.flight_date, f.carrier_code, f.flight_number,
    f.tail_number, f.origin_code, f.destination_code, f.origin_code || '-' || f.destination_code AS route_code,
    f.scheduled_departure_hour_utc, f.scheduled_departure_minute, f.scheduled_arrival_minute,
    f.actual_departure_minute, f.actual_arrival_minute,
    f.scheduled_departure_minute // 60 AS scheduled_departure_hour_local,
    f.departure_delay_minutes, f.arrival_delay_minutes, f.air_time_minutes, f.distance_miles,
    f.is_cancelled, f.is_diverted,
    coalesce(f.departure_delay_minutes > 15, false) AS is_departure_delayed,
    coalesce(f.arrival_delay_minutes > 15, false) AS is_arrival_delayed,
    f.arrival_delay_minutes - f.departure_delay_minutes AS delay_change_in_air_minutes,
    w.temperature_f AS origin_temperature_f, w.wind_speed_mph AS origin_wind_speed_mph,
    w.precipitation_in AS origin_precipitation_in, w.visibility_miles AS origin_visibility_miles,
    coalesce(w.precipitation_in > 0, false) AS origin_had_precipitation,
    coalesce(w.visibility_miles < 3, false) AS origin_had_low_visibility
  FROM s_flight f LEFT JOIN s_weather w
    ON f.origin_code = w.origin_code AND f.scheduled_departure_hour_utc = w.observed_hour_utc)"""


MARTS = f"""
m_carrier AS (
  SELECT c.carrier_code, c.carrier_name, a.n::BIGINT AS flight_count, a.canc::BIGINT AS cancelled_count,
    a.dive::BIGINT AS diverted_count, a.ddel::BIGINT AS departure_delayed_count,
    a.adel::BIGINT AS arrival_delayed_count, a.dests::BIGINT AS destination_count,
    a.tails::BIGINT AS aircraft_count,
    {pct('a.canc', 'a.n')} AS cancellation_rate_pct, {pct('a.ddel', 'a.n')} AS departure_delay_rate_pct,
    {pct('a.adel', 'a.n')} AS arrival_delay_rate_pct,
    {rhu('a.avg_dep', 2)} AS avg_departure_delay_minutes, {rhu('a.avg_arr', 2)} AS avg_arrival_delay_minutes,
    {rhu('a.med_arr', 2)} AS median_arrival_delay_minutes, {rhu('a.p90_arr', 2)} AS p90_arrival_delay_minutes,
    {rhu('a.avg_chg', 2)} AS avg_delay_change_in_air_minutes, a.dist::BIGINT AS total_distance_miles
  FROM (
    SELECT carrier_key, count(*) AS n,
      count(*) FILTER (WHERE is_cancelled) AS canc, count(*) FILTER (WHERE is_diverted) AS dive,
      count(*) FILTER (WHERE is_departure_delayed) AS ddel, count(*) FILTER (WHERE is_arrival_delayed) AS adel,
      count(DISTINCT destination_code) AS dests, count(DISTINCT tail_number) AS tails,
      avg(departure_delay_minutes) AS avg_dep, avg(arrival_delay_minutes) AS avg_arr,
      quantile_cont(arrival_delay_minutes, 0.5) AS med_arr, quantile_cont(arrival_delay_minutes, 0.9) AS p90_arr,
      avg(delay_change_in_air_minutes) AS avg_chg, sum(distance_miles) AS dist
    FROM fct GROUP BY carrier_key) a
  JOIN d_carrier c ON a.carrier_key = c.carrier_key),
m_route AS (
  SELECT a.route_code, a.origin_code, a.destination_code, d.airport_name AS destination_name,
    d.municipality AS destination_city, d.iso_region AS destination_region, a.dist::BIGINT AS distance_miles,
    a.n::BIGINT AS flight_count, a.carriers::BIGINT AS carrier_count, a.canc::BIGINT AS cancelled_count,
    a.adel::BIGINT AS arrival_delayed_count,
    {pct('a.canc', 'a.n')} AS cancellation_rate_pct, {pct('a.adel', 'a.n')} AS arrival_delay_rate_pct,
    {rhu('a.avg_arr', 2)} AS avg_arrival_delay_minutes, {rhu('a.avg_air', 2)} AS avg_air_time_minutes,
    {rhu('a.dist::DOUBLE / nullif(a.avg_air, 0.0::DOUBLE) * 60.0::DOUBLE', 1)} AS avg_ground_speed_mph
  FROM (
    SELECT route_code, origin_code, destination_code, origin_airport_key, destination_airport_key,
      count(*) AS n, count(DISTINCT carrier_code) AS carriers,
      count(*) FILTER (WHERE is_cancelled) AS canc, count(*) FILTER (WHERE is_arrival_delayed) AS adel,
      avg(arrival_delay_minutes) AS avg_arr, avg(air_time_minutes) AS avg_air, min(distance_miles) AS dist
    FROM fct GROUP BY route_code, origin_code, destination_code, origin_airport_key, destination_airport_key) a
  JOIN d_airport d ON a.destination_airport_key = d.airport_key),
banded AS (
  SELECT *,
    CASE WHEN origin_visibility_miles IS NULL THEN 'unknown'
         WHEN origin_visibility_miles < 1 THEN 'visibility under 1 mile'
         WHEN origin_visibility_miles < 3 THEN 'visibility 1 to 3 miles'
         WHEN origin_visibility_miles < 10 THEN 'visibility 3 to 10 miles'
         ELSE 'visibility 10 miles or more' END AS vis_band,
    CASE WHEN origin_precipitation_in IS NULL THEN 'unknown'
         WHEN origin_precipitation_in = 0 THEN 'no precipitation'
         WHEN origin_precipitation_in < 0.05::DOUBLE THEN 'light precipitation'
         WHEN origin_precipitation_in < 0.2::DOUBLE THEN 'moderate precipitation'
         ELSE 'heavy precipitation' END AS pre_band,
    CASE WHEN origin_wind_speed_mph IS NULL THEN 'unknown'
         WHEN origin_wind_speed_mph < 10 THEN 'wind under 10 mph'
         WHEN origin_wind_speed_mph < 20 THEN 'wind 10 to 20 mph'
         WHEN origin_wind_speed_mph < 30 THEN 'wind 20 to 30 mph'
         ELSE 'wind 30 mph or more' END AS wind_band
  FROM fct),
stacked AS (
  SELECT 'visibility' AS condition_type, vis_band AS condition_band, * FROM banded
  UNION ALL SELECT 'precipitation', pre_band, * FROM banded
  UNION ALL SELECT 'wind', wind_band, * FROM banded),
m_weather AS (
  SELECT condition_type, condition_band, count(*)::BIGINT AS flight_count,
    count(*) FILTER (WHERE is_cancelled)::BIGINT AS cancelled_count,
    count(*) FILTER (WHERE is_departure_delayed)::BIGINT AS departure_delayed_count,
    {pct('count(*) FILTER (WHERE is_cancelled)', 'count(*)')} AS cancellation_rate_pct,
    {pct('count(*) FILTER (WHERE is_departure_delayed)', 'count(*)')} AS departure_delay_rate_pct,
    {rhu('avg(departure_delay_minutes)', 2)} AS avg_departure_delay_minutes,
    {rhu('quantile_cont(departure_delay_minutes, 0.5)', 2)} AS median_departure_delay_minutes,
    {rhu('quantile_cont(departure_delay_minutes, 0.9)', 2)} AS p90_departure_delay_minutes
  FROM stacked WHERE condition_band <> 'unknown' GROUP BY condition_type, condition_band),
m_daily AS (
  SELECT d.date_day, d.calendar_month, d.month_name, d.day_name, d.is_weekend, d.is_holiday, d.holiday_name,
    a.origin_code, a.n::BIGINT AS flight_count, a.canc::BIGINT AS cancelled_count,
    a.ddel::BIGINT AS departure_delayed_count,
    {pct('a.canc', 'a.n')} AS cancellation_rate_pct, {pct('a.ddel', 'a.n')} AS departure_delay_rate_pct,
    {rhu('a.avg_dep', 2)} AS avg_departure_delay_minutes, a.max_dep::BIGINT AS max_departure_delay_minutes,
    round(CAST(a.sum_p / a.np AS DECIMAL(20, 10)), 4)::DOUBLE AS avg_precipitation_in,
    a.min_v AS min_visibility_miles, a.max_w AS max_wind_speed_mph
  FROM (
    SELECT date_key, origin_code, count(*) AS n, count(*) FILTER (WHERE is_cancelled) AS canc,
      count(*) FILTER (WHERE is_departure_delayed) AS ddel, avg(departure_delay_minutes) AS avg_dep,
      max(departure_delay_minutes) AS max_dep,
      sum(CAST(origin_precipitation_in AS DECIMAL(18, 2)))::DOUBLE AS sum_p,
      count(origin_precipitation_in) AS np,
      min(origin_visibility_miles) AS min_v, max(origin_wind_speed_mph) AS max_w
    FROM fct GROUP BY date_key, origin_code) a
  JOIN d_date d ON a.date_key = d.date_key),
m_aircraft AS (
  SELECT c.tail_number, c.manufacturer, c.model, c.size_class, c.seat_count, c.manufactured_year,
    c.age_years_in_2013, c.has_reference_record, a.n::BIGINT AS flight_count,
    a.days::BIGINT AS active_day_count, a.carriers::BIGINT AS carrier_count, a.routes::BIGINT AS route_count,
    a.air::BIGINT AS total_air_time_minutes, a.dist::BIGINT AS total_distance_miles,
    {rhu('a.n::DOUBLE / nullif(a.days::DOUBLE, 0.0::DOUBLE)', 2)} AS flights_per_active_day,
    {rhu('a.avg_arr', 2)} AS avg_arrival_delay_minutes
  FROM (
    SELECT aircraft_key, count(*) AS n, count(DISTINCT flight_date) AS days,
      count(DISTINCT carrier_code) AS carriers, count(DISTINCT route_code) AS routes,
      sum(air_time_minutes) AS air, sum(distance_miles) AS dist, avg(arrival_delay_minutes) AS avg_arr
    FROM fct WHERE tail_number IS NOT NULL GROUP BY aircraft_key) a
  JOIN d_aircraft c ON a.aircraft_key = c.aircraft_key)"""


def with_model(body: str) -> str:
    return f"WITH {RAW},{STAGING},{WAREHOUSE},{MARTS}\n{body}"


DELAY_BY_HOUR = with_model(f"""
SELECT scheduled_departure_hour_local, count(*)::BIGINT AS flight_count,
  count(*) FILTER (WHERE is_departure_delayed)::BIGINT AS departure_delayed_count,
  {pct('count(*) FILTER (WHERE is_departure_delayed)', 'count(*)')} AS departure_delay_rate_pct,
  {rhu('avg(departure_delay_minutes)', 1)} AS avg_departure_delay_minutes
FROM fct GROUP BY scheduled_departure_hour_local ORDER BY 1""")

HOLIDAY_EFFECT = with_model(f"""
SELECT d.is_holiday, count(*)::BIGINT AS flight_count,
  count(*) FILTER (WHERE f.is_departure_delayed)::BIGINT AS departure_delayed_count,
  count(*) FILTER (WHERE f.is_arrival_delayed)::BIGINT AS arrival_delayed_count,
  count(*) FILTER (WHERE f.is_cancelled)::BIGINT AS cancelled_count,
  {pct('count(*) FILTER (WHERE f.is_departure_delayed)', 'count(*)')} AS departure_delay_rate_pct,
  {pct('count(*) FILTER (WHERE f.is_arrival_delayed)', 'count(*)')} AS arrival_delay_rate_pct,
  {pct('count(*) FILTER (WHERE f.is_cancelled)', 'count(*)')} AS cancellation_rate_pct
FROM fct f JOIN d_date d ON f.date_key = d.date_key GROUP BY d.is_holiday ORDER BY 1""")

WORST_DAYS = with_model("""
SELECT date_day, origin_code, flight_count, cancelled_count, cancellation_rate_pct FROM m_daily
ORDER BY cancellation_rate_pct DESC NULLS LAST, flight_count DESC, date_day, origin_code LIMIT 10""")


ORACLES: dict[str, str] = {
    "stg_flight": with_model("SELECT * FROM s_flight"),
    "stg_weather": with_model("SELECT * FROM s_weather"),
    "stg_plane": with_model("SELECT * FROM s_plane"),
    "stg_carrier": with_model("SELECT * FROM s_carrier"),
    "stg_airport_reference": with_model("SELECT * FROM s_ref"),
    "stg_airport": with_model("SELECT * FROM s_airport"),
    "dim_date": with_model("SELECT * FROM d_date"),
    "dim_airport": with_model("SELECT * FROM d_airport"),
    "dim_carrier": with_model("SELECT * FROM d_carrier"),
    "dim_aircraft": with_model("SELECT * FROM d_aircraft"),
    "fct_flight": with_model("SELECT * FROM fct"),
    "mart_carrier_performance": with_model("SELECT * FROM m_carrier ORDER BY flight_count DESC, carrier_code"),
    "mart_route_performance": with_model("SELECT * FROM m_route ORDER BY flight_count DESC, route_code"),
    "mart_weather_impact": with_model("SELECT * FROM m_weather ORDER BY condition_type, condition_band"),
    "mart_daily_operations": with_model("SELECT * FROM m_daily ORDER BY date_day, origin_code"),
    "mart_aircraft_utilization": with_model("SELECT * FROM m_aircraft ORDER BY flight_count DESC, tail_number"),
    "delay_by_hour": DELAY_BY_HOUR,
    "holiday_effect": HOLIDAY_EFFECT,
    "worst_days": WORST_DAYS,
}


# --- data-quality checks ---------------------------------------------------

def dq_report_sql() -> str:
    arms = [f"SELECT '{name}' AS check_name, '{table}' AS table_name, ({sql})::BIGINT AS violations" for name, table, sql in CHECKS]
    return with_model(", report AS (\n" + "\nUNION ALL\n".join(arms) +
                      ")\nSELECT check_name, table_name, violations, violations = 0 AS passed FROM report")


DQ_CANCELLED = with_model("""
SELECT flight_key, 77::BIGINT AS actual_departure_minute, arrival_delay_minutes FROM fct
WHERE is_cancelled AND flight_key % 2 = 0""")

DQ_RECONCILE = with_model("""
SELECT source_rows, fact_rows FROM (
  SELECT (SELECT count(*) FROM raw_flights)::BIGINT AS source_rows, (SELECT count(*) FROM fct WHERE flight_key % 13 <> 0)::BIGINT AS fact_rows)
WHERE source_rows <> fact_rows""")

DQ_COVERAGE = with_model(f"""
SELECT total_flights, matched_flights, {pct('matched_flights', 'total_flights')} AS coverage_pct FROM (
  SELECT count(*)::BIGINT AS total_flights, count(origin_temperature_f)::BIGINT AS matched_flights FROM fct)
WHERE 100.0::DOUBLE * matched_flights::DOUBLE / total_flights::DOUBLE < 99.0::DOUBLE""")

DQ_FK_DESTINATION = with_model("""
SELECT f.* FROM fct f WHERE f.destination_airport_key IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM d_airport d WHERE d.airport_key = f.destination_airport_key)""")

# --- write-path jobs ------------------------------------------------------

MONTHLY_RELOAD = with_model("""
SELECT year, month, count(*)::BIGINT AS rows,
  sum(distance + CASE WHEN year = 1998 AND month = 2 THEN 7 ELSE 0 END)::BIGINT AS distance
FROM raw_flights WHERE NOT (year = 1999 AND month = 3) GROUP BY year, month""")

def source_files_sql() -> str:
    """Digest of each raw source; blank text is NULL in a delimited file."""
    arms = []
    for name, schema in RAW_SCHEMAS.items():
        table = "raw_" + {"ourairports_airports": "ourairports", "openflights_airlines": "openflights"}.get(name, name)
        filled = " + ".join(f"CASE WHEN nullif(trim(CAST({f.name} AS VARCHAR)), '') IS NULL THEN 0 ELSE 1 END" for f in schema.fields)
        whole = " + ".join(f"coalesce({f.name}, 0)" for f in schema.fields if f.dataType.simpleString() == "bigint")
        at = "time_hour" if "time_hour" in schema.fieldNames() else "CAST(NULL AS TIMESTAMP)"
        arms.append(f"SELECT '{name}' AS source, count(*)::BIGINT AS rows, sum({filled})::BIGINT AS filled, "
                    f"sum({whole})::BIGINT AS whole_sum, min({at}) AS first_at, max({at}) AS last_at FROM {table}")
    return with_model("\nUNION ALL\n".join(arms))


SCHEMA_DRIFT = with_model("""
SELECT year, month, count(*)::BIGINT AS rows,
  (CASE WHEN year = 1998 AND month = 2 THEN count(*) ELSE 0 END)::BIGINT AS gates,
  CASE WHEN year = 1998 AND month = 2 THEN sum(rownames % 10)::BIGINT END AS gate_sum
FROM raw_flights GROUP BY year, month""")

CORRECTION = """
SELECT o_orderkey::BIGINT AS order_key,
  o_totalprice::DOUBLE + CASE WHEN o_orderkey % 5 = 0 THEN 1000.0::DOUBLE ELSE 0.0::DOUBLE END AS price,
  CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS revision,
  CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey % 7 + 1) % 7 ELSE o_orderkey % 7 END::BIGINT AS bucket
FROM orders"""

NULL_PARTITION = """
SELECT o_orderkey::BIGINT AS order_key, o_totalprice::DOUBLE AS price,
  CASE WHEN o_orderkey % 7 <= 1 AND o_orderkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS revision,
  CASE WHEN o_orderkey % 7 > 1 THEN o_orderkey % 7 END::BIGINT AS bucket
FROM orders"""

FULL_LOAD_COUNTS = with_model("""
SELECT 'airlines' AS table_name, count(*)::BIGINT AS rows FROM raw_airlines
UNION ALL SELECT 'airports', count(*) FROM raw_airports
UNION ALL SELECT 'flights', count(*) FROM raw_flights
UNION ALL SELECT 'openflights_airlines', count(*) FROM raw_openflights
UNION ALL SELECT 'ourairports_airports', count(*) FROM raw_ourairports
UNION ALL SELECT 'planes', count(*) FROM raw_planes
UNION ALL SELECT 'weather', count(*) FROM raw_weather""")

AUDIT_RECENT = with_model("""
, audit AS (
  SELECT TIMESTAMP '2024-02-01 06:00:00' AS loaded_at, 'flights' AS table_name,
    printf('%04d-%02d', year, month) AS month, count(*)::BIGINT AS rows FROM raw_flights GROUP BY year, month
  UNION ALL
  SELECT TIMESTAMP '2024-02-01 06:00:01', 'weather', printf('%04d-%02d', year, month), count(*)
  FROM raw_weather GROUP BY year, month
  UNION ALL SELECT TIMESTAMP '2024-02-01 06:00:02', 'planes', '-', count(*) FROM raw_planes
  UNION ALL SELECT TIMESTAMP '2024-02-01 06:00:03', 'airlines', '-', count(*) FROM raw_airlines
  UNION ALL SELECT TIMESTAMP '2024-02-01 06:00:04', 'airports', '-', count(*) FROM raw_airports
  UNION ALL SELECT TIMESTAMP '2024-02-01 06:00:05', 'ourairports_airports', '-', count(*) FROM raw_ourairports
  UNION ALL SELECT TIMESTAMP '2024-02-01 06:00:06', 'openflights_airlines', '-', count(*) FROM raw_openflights)
SELECT * FROM audit ORDER BY loaded_at DESC, table_name, month DESC LIMIT 10""")

CSV_ROUNDTRIP = with_model("""
SELECT carrier_code, carrier_name || ', "Intl"' AS carrier_name, icao_code, callsign, country,
  is_active_in_openflights FROM s_carrier""")

_SNAP_T = ("TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-03-01 00:00:00'")


def _snap_row(name_expr: str, country_expr: str, frm: str, to: str | None, upd: str) -> str:
    return (f"SELECT ident, airport_type, {name_expr} AS airport_name, municipality, {country_expr} AS iso_country, "
            f"iso_region, has_scheduled_service, md5(ident || '||' || CAST({frm} AS VARCHAR)) AS version_id, "
            f"{frm} AS valid_from, {to or 'CAST(NULL AS TIMESTAMP)'} AS valid_to, {upd} AS updated_at FROM snap_src")


def snapshot_sql() -> str:
    t1, t2, t3 = _SNAP_T
    arms = [
        _snap_row("airport_name", "iso_country", t1, None, t1) + " WHERE r IN (1, 3, 4)",
        _snap_row("airport_name", "iso_country", t1, t2, t2) + " WHERE r IN (0, 2)",
        _snap_row("airport_name || ' II'", "iso_country", t2, t3, t3) + " WHERE r = 0",
        _snap_row("airport_name", "iso_country", t3, None, t3) + " WHERE r IN (0, 2)",
    ]
    return with_model(", snap_src AS (SELECT *, CAST(substr(ident, 2) AS BIGINT) % 5 AS r FROM s_ref)\n"
                      + "\nUNION ALL\n".join(arms))


ORACLES.update({
    "dq_report": dq_report_sql(),
    "dq_cancelled_times": DQ_CANCELLED,
    "dq_reconcile": DQ_RECONCILE,
    "dq_coverage": DQ_COVERAGE,
    "dq_fk_destination": DQ_FK_DESTINATION,
    "incremental_fact": with_model("SELECT * FROM fct"),
    "streamed_fact": with_model("SELECT * FROM fct"),
    "full_refresh_fact": with_model("SELECT * FROM fct"),
    "monthly_reload": MONTHLY_RELOAD,
    "schema_drift_reload": SCHEMA_DRIFT,
    "source_files": source_files_sql(),
    "incremental_correction": CORRECTION,
    "incremental_null_partition": NULL_PARTITION,
    "full_load_counts": FULL_LOAD_COUNTS,
    "audit_recent": AUDIT_RECENT,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "snap_airport_reference": snapshot_sql(),
})


# --- operators straight on the generated tables ---------------------------

LINEITEM_FIRST_SHIPMENT = """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST,
             l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST, l_returnflag NULLS LAST,
             l_linestatus NULLS LAST, l_shipdate NULLS LAST) AS rk
  FROM lineitem) WHERE rk = 1"""

LINEITEM_BANDS = f"""
WITH b AS (
  SELECT *,
    CASE WHEN l_quantity IS NULL THEN 'unknown' WHEN l_quantity < 10 THEN 'quantity under 10'
         WHEN l_quantity < 25 THEN 'quantity 10 to 25' WHEN l_quantity < 40 THEN 'quantity 25 to 40'
         ELSE 'quantity 40 or more' END AS qb,
    CASE WHEN l_discount IS NULL THEN 'unknown' WHEN l_discount = 0 THEN 'no discount'
         WHEN l_discount < 0.05::DOUBLE THEN 'small discount' WHEN l_discount < 0.08::DOUBLE THEN 'medium discount'
         ELSE 'large discount' END AS db,
    CASE WHEN l_tax IS NULL THEN 'unknown' WHEN l_tax = 0 THEN 'no tax'
         WHEN l_tax < 0.04::DOUBLE THEN 'low tax' WHEN l_tax < 0.07::DOUBLE THEN 'medium tax'
         ELSE 'high tax' END AS tb
  FROM lineitem),
s AS (
  SELECT 'quantity' AS condition_type, qb AS condition_band, * FROM b
  UNION ALL SELECT 'discount', db, * FROM b
  UNION ALL SELECT 'tax', tb, * FROM b)
SELECT condition_type, condition_band, count(*)::BIGINT AS line_count,
  count(*) FILTER (WHERE l_returnflag = 'R')::BIGINT AS returned_count,
  {pct("count(*) FILTER (WHERE l_returnflag = 'R')", 'count(*)')} AS returned_rate_pct,
  {rhu('avg(l_quantity)', 2)} AS avg_quantity,
  {rhu('quantile_cont(l_quantity, 0.5)', 2)} AS median_quantity,
  {rhu('quantile_cont(l_quantity, 0.9)', 2)} AS p90_quantity
FROM s WHERE condition_band <> 'unknown' GROUP BY condition_type, condition_band"""

LINEITEM_BEST_PART = """
WITH best AS (
  SELECT p_brand, p_name AS best_name, p_partkey AS best_partkey FROM (
    SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name NULLS LAST, p_partkey NULLS LAST) AS rk
    FROM part WHERE p_brand IS NOT NULL) WHERE rk = 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand AS brand, b.best_name, b.best_partkey
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN best b ON p.p_brand = b.p_brand"""

LINEITEM_KEY_USAGE = """
SELECT key_value, sum(n)::BIGINT AS usage_count FROM (
  SELECT l_partkey AS key_value, count(*) AS n FROM lineitem GROUP BY l_partkey
  UNION ALL
  SELECT l_suppkey, count(*) FROM lineitem GROUP BY l_suppkey) GROUP BY key_value"""

ORACLES.update({
    "lineitem_first_shipment": LINEITEM_FIRST_SHIPMENT,
    "lineitem_bands": LINEITEM_BANDS,
    "lineitem_best_part": LINEITEM_BEST_PART,
    "lineitem_key_usage": LINEITEM_KEY_USAGE,
})


DQ_ROWS = {
    "dq_unique_rows": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS unique_field,
  count(*)::BIGINT AS n_records
FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "dq_not_null_rows": with_model("""
SELECT flight_key, flight_date, origin_code, is_cancelled FROM s_flight WHERE actual_departure_minute IS NULL"""),
    "dq_accepted_values_rows": with_model("""
SELECT rownames, origin FROM raw_flights WHERE origin IS NOT NULL AND origin NOT IN ('CLI', 'ERR', 'PUR')"""),
    "dq_range_rows": with_model("""
SELECT rownames, origin, wind_speed FROM raw_weather WHERE wind_speed < 0 OR wind_speed > 200"""),
}
ORACLES.update(DQ_ROWS)


FUNCTION_QUERIES = {
    "customer_clean": """
SELECT c_custkey AS customer_key, nullif(trim(raw_name), '') AS customer_name,
  nullif(trim(c_mktsegment), '') AS segment,
  coalesce(nullif(trim(raw_name), ''), nullif(trim(c_mktsegment), '')) AS display_name
FROM (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN '   ' ELSE ' ' || c_name || ' ' END AS raw_name FROM customer)""",
    "order_clock_minutes": """
SELECT o_orderkey, clock_hhmm, (clock_hhmm // 100 * 60 + clock_hhmm % 100) % 1440 AS minute_of_day,
  ((clock_hhmm // 100 * 60 + clock_hhmm % 100) % 1440) // 60 AS hour_of_day
FROM (SELECT o_orderkey, o_orderkey % 2401 AS clock_hhmm FROM orders)""",
    "order_keys": """
SELECT o_orderkey, md5(coalesce(CAST(o_orderkey AS VARCHAR), '^missing^')) AS order_key,
  md5(concat_ws('||', coalesce(CAST(o_orderkey AS VARCHAR), '^missing^'),
                      coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '^missing^'),
                      coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END, '^missing^'))) AS order_version_key
FROM orders""",
    "clamped_readings": """
SELECT event_id, CASE WHEN value <= 200 THEN value END AS reading,
  coalesce(CASE WHEN value <= 200 THEN value END > 100, false) AS is_high
FROM events""",
    "part_size_classes": """
SELECT p_partkey, size, CASE WHEN size IS NULL THEN 'unknown' WHEN size < 10 THEN 'small'
  WHEN size < 30 THEN 'medium' ELSE 'large' END AS size_class
FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_size END AS size FROM part)""",
}
ORACLES.update(FUNCTION_QUERIES)


# --- loading, publishing -----------------------------------------------------

ORACLES.update({
    "gated_build": with_model("""
SELECT *, 'non_negative__stg_flight__distance_miles' AS refused_by FROM m_carrier"""),
    "rejected_rows": with_model("""
SELECT 'flights' AS source, 'distance' AS "column", 'n/a' AS value, count(*)::BIGINT AS rows, NULL::BIGINT AS key_sum
FROM raw_flights WHERE rownames % 101 = 3 HAVING count(*) > 0
UNION ALL SELECT 'planes', 'seats', '12x', count(*), NULL FROM raw_planes WHERE rownames % 7 = 2 HAVING count(*) > 0
UNION ALL SELECT 'planes', 'year', 'MCM', count(*), NULL FROM raw_planes WHERE rownames % 14 = 2 HAVING count(*) > 0
UNION ALL SELECT 'flights', NULL, NULL, count(*), sum(rownames)::BIGINT FROM raw_flights WHERE rownames % 101 <> 3
UNION ALL SELECT 'planes', NULL, NULL, count(*), sum(rownames)::BIGINT FROM raw_planes WHERE rownames % 7 <> 2
UNION ALL SELECT 'airlines', NULL, NULL, count(*), sum(rownames)::BIGINT FROM raw_airlines"""),
    "seeded_calendar": with_model("""
SELECT * EXCLUDE (is_holiday, holiday_name), is_holiday AND calendar_year = 1995 AS is_holiday,
  CASE WHEN calendar_year = 1995 THEN holiday_name END AS holiday_name FROM d_date"""),
    "empty_targets": with_model("""
SELECT 'flights' AS table_name, 20::BIGINT AS columns, 0::BIGINT AS rows_before, count(*)::BIGINT AS rows_after FROM raw_flights
UNION ALL SELECT 'weather', 16, 0, count(*) FROM raw_weather"""),
    "audit_now": with_model("""
SELECT table_name, rows, true AS is_current FROM (
  SELECT 'airlines' AS table_name, count(*)::BIGINT AS rows FROM raw_airlines
  UNION ALL SELECT 'airports', count(*) FROM raw_airports
  UNION ALL SELECT 'flights', count(*) FROM raw_flights
  UNION ALL SELECT 'openflights_airlines', count(*) FROM raw_openflights
  UNION ALL SELECT 'ourairports_airports', count(*) FROM raw_ourairports
  UNION ALL SELECT 'planes', count(*) FROM raw_planes
  UNION ALL SELECT 'weather', count(*) FROM raw_weather)"""),
})
