"""Declared schemas of the raw sources, the load audit and the seed.

Schemas are declared rather than inferred: inference needs a second pass over
the files and guesses ``int`` where the warehouse contract says ``bigint``.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, TS = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


FLIGHTS = _schema(
    ("rownames", L), ("year", L), ("month", L), ("day", L), ("dep_time", L),
    ("sched_dep_time", L), ("dep_delay", L), ("arr_time", L), ("sched_arr_time", L),
    ("arr_delay", L), ("carrier", S), ("flight", L), ("tailnum", S), ("origin", S),
    ("dest", S), ("air_time", L), ("distance", L), ("hour", L), ("minute", L),
    ("time_hour", TS),
)

WEATHER = _schema(
    ("rownames", L), ("origin", S), ("year", L), ("month", L), ("day", L), ("hour", L),
    ("temp", D), ("dewp", D), ("humid", D), ("wind_dir", L), ("wind_speed", D),
    ("wind_gust", D), ("precip", D), ("pressure", D), ("visib", D), ("time_hour", TS),
)

PLANES = _schema(
    ("rownames", L), ("tailnum", S), ("year", L), ("type", S), ("manufacturer", S),
    ("model", S), ("engines", L), ("seats", L), ("speed", L), ("engine", S),
)

AIRLINES = _schema(("rownames", L), ("carrier", S), ("name", S))

AIRPORTS = _schema(
    ("rownames", L), ("faa", S), ("name", S), ("lat", D), ("lon", D), ("alt", L),
    ("tz", L), ("dst", S), ("tzone", S),
)

OURAIRPORTS = _schema(
    ("id", L), ("ident", S), ("type", S), ("name", S), ("latitude_deg", D),
    ("longitude_deg", D), ("elevation_ft", L), ("continent", S), ("iso_country", S),
    ("iso_region", S), ("municipality", S), ("scheduled_service", S), ("icao_code", S),
    ("iata_code", S), ("gps_code", S), ("local_code", S), ("home_link", S),
    ("wikipedia_link", S), ("keywords", S),
)

OPENFLIGHTS = _schema(
    ("airline_id", L), ("name", S), ("alias", S), ("iata", S), ("icao", S),
    ("callsign", S), ("country", S), ("active", S),
)

LOAD_AUDIT = T.StructType([
    T.StructField("loaded_at", T.TimestampNTZType(), False),
    T.StructField("table_name", S, False),
    T.StructField("month", S, True),
    T.StructField("rows", L, False),
    T.StructField("source_file", S, False),
])

HOLIDAYS = T.StructType([
    T.StructField("holiday_date", T.DateType(), True),
    T.StructField("holiday_name", S, True),
])

RAW_SCHEMAS: dict[str, T.StructType] = {
    "flights": FLIGHTS,
    "weather": WEATHER,
    "planes": PLANES,
    "airlines": AIRLINES,
    "airports": AIRPORTS,
    "ourairports_airports": OURAIRPORTS,
    "openflights_airlines": OPENFLIGHTS,
}

