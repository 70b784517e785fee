"""The seven raw flight-domain sources, derived from the generated star-schema
tables by integer arithmetic.

Mapping (one raw row per driver row, so every source grows with the data):

* ``flights``              <- ``orders``    (order = scheduled departure)
* ``weather``              <- ``events``    (event = one station reading)
* ``planes``               <- ``part``
* ``airlines``             <- ``nation``
* ``airports``             <- ``supplier`` plus the stations seen in ``events``
* ``ourairports_airports`` <- ``part``      (global airport reference)
* ``openflights_airlines`` <- ``supplier``  (several candidates per carrier code)

Every derived value is an integer expression of the row's keys (or a plain
copy of a column), written the same way in the SQL oracle, so both engines
produce bit-identical inputs.  The derivations are narrow projections — no
shuffle — except the station list (one distinct over ``events``).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from contrail.sources import schemas

# The station code list (first three letters of each event type,
# upper case, in alphabetical order) and the origin of the hourly timeline.
STATIONS = ("CLI", "ERR", "PUR", "SIG", "VIE")
TIMELINE_START = "2024-01-01 00:00:00"
HOURS_IN_TIMELINE = 720
ENGINE_TYPES = ("Turbo-fan", "Turbo-jet", "Reciprocating")
AIRPORT_TYPES = ("large_airport", "medium_airport", "small_airport")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Expressions are SQL text: a whole projection is parsed in one call, where
# Column objects take a call to the JVM for every operator.

def _s(prefix: str, c: str) -> str:
    return f"concat('{prefix}', CAST({c} AS STRING))"


def _pick(values: tuple[str, ...], index: str) -> str:
    told = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({told}), CAST({index} + 1 AS INT))"


def _hhmm(minute: str) -> str:
    return f"({minute}) div 60 * 100 + ({minute}) % 60"


STATION_CODE = "upper(substring(event_type, 1, 3))"


def _typed(df: DataFrame, schema, columns: dict[str, str]) -> DataFrame:
    """Columns of the declared raw schema, except that ``time_hour`` keeps the
    zone-less type of the driver tables (already UTC wall time)."""
    kinds = {f.name: "timestamp_ntz" if f.name == "time_hour" else f.dataType.simpleString() for f in schema.fields}
    return df.selectExpr(*[f"CAST({columns[name]} AS {kind}) AS {name}" for name, kind in kinds.items()])


def flights(orders: DataFrame) -> DataFrame:
    # Step 1: the per-order integers every column is derived from, computed
    # once (kept as separate columns so the optimiser does not inline them
    # into every use and blow up the generated code).
    base = orders.selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "o_orderdate AS d",
        "o_orderkey % 41 = 0 AS cancelled",
        "o_orderkey % 41 != 0 AND o_orderkey % 53 = 7 AS diverted",
        "300 + (o_orderkey * 7) % 1200 AS smin",
        "(o_orderkey * 37) % 200 - 20 AS ddel",
        "30 + (o_custkey * 11 + o_orderkey) % 300 AS blk",
        "(o_orderkey * 7 + o_custkey) % 150 AS di")
    base = base.selectExpr("*", "(smin + blk + 20) % 1440 AS samin", "ddel + (k * 13) % 41 - 20 AS adel", f"{_hhmm('smin')} AS sched")
    flown = "NOT cancelled AND NOT diverted"
    return _typed(base, schemas.FLIGHTS, {
        "rownames": "k", "year": "year(d)", "month": "month(d)", "day": "dayofmonth(d)",
        "dep_time": f"CASE WHEN NOT cancelled THEN {_hhmm('(smin + ddel) % 1440')} END",
        "sched_dep_time": "sched",
        "dep_delay": "CASE WHEN NOT cancelled THEN ddel END",
        "arr_time": f"CASE WHEN {flown} THEN {_hhmm('(samin + adel + 1440) % 1440')} END",
        "sched_arr_time": f"CASE WHEN NOT cancelled THEN {_hhmm('samin')} END",
        "arr_delay": f"CASE WHEN {flown} THEN adel END",
        "carrier": _s("C", "c % 16"),
        "flight": "1000 + c % 4000",
        "tailnum": f"CASE WHEN k % 97 = 0 THEN '  ' ELSE {_s('N', 'c')} END",
        "origin": _pick(STATIONS, "k % 5"),
        "dest": _s("S", "di"),
        "air_time": f"CASE WHEN {flown} THEN blk + k % 11 - 5 END",
        "distance": "100 + di * 17",
        "hour": "sched div 100", "minute": "sched % 100",
        "time_hour": f"timestampadd(HOUR, k % {HOURS_IN_TIMELINE}, TIMESTAMP_NTZ '{TIMELINE_START}')",
    })


def weather(events: DataFrame) -> DataFrame:
    base = events.selectExpr("event_id AS e", "CAST(value AS DOUBLE) AS v", "ts", "event_type")
    return _typed(base, schemas.WEATHER, {
        "rownames": "e", "origin": STATION_CODE,
        "year": "year(ts)", "month": "month(ts)", "day": "dayofmonth(ts)", "hour": "hour(ts)",
        "temp": "CASE WHEN e % 29 != 0 THEN v END",
        "dewp": "v - 5.0D", "humid": "CAST(e % 100 AS DOUBLE)", "wind_dir": "(e * 10) % 360",
        "wind_speed": "CASE WHEN e % 101 = 0 THEN v + 1000.0D ELSE v / 4.0D END",
        "wind_gust": "CASE WHEN e % 3 != 0 THEN v / 2.0D END",
        "precip": "CAST(e % 8 AS DOUBLE) / 20.0D",
        "pressure": "990.0D + CAST(e % 40 AS DOUBLE)",
        "visib": "CAST((e * 7) % 12 AS DOUBLE)",
        "time_hour": "make_timestamp_ntz(year(ts), month(ts), dayofmonth(ts), hour(ts), 0, 0)",
    })


def planes(part: DataFrame) -> DataFrame:
    return _typed(part.selectExpr("*", "p_partkey AS p"), schemas.PLANES, {
        "rownames": "p", "tailnum": _s("N", "p * 2"), "year": "1960 + p % 54", "type": "p_type", "manufacturer": "p_brand",
        "model": "CASE WHEN p % 50 = 0 THEN ' ' ELSE p_name END",
        "engines": "1 + p % 4", "seats": "p_size * 8", "speed": "NULL", "engine": _pick(ENGINE_TYPES, "p % 3"),
    })


def airlines(nation: DataFrame) -> DataFrame:
    return _typed(nation, schemas.AIRLINES, {"rownames": "n_nationkey + 1", "carrier": _s("C", "n_nationkey"), "name": "concat('  ', n_name)"})


def airports(supplier: DataFrame, events: DataFrame) -> DataFrame:
    served = _typed(supplier.selectExpr("*", "s_suppkey AS s"), schemas.AIRPORTS, {
        "rownames": "s + 1", "faa": _s("S", "s"), "name": "s_name",
        "lat": "CAST(s % 180 AS DOUBLE) - 90.0D", "lon": "CAST((s * 7) % 360 AS DOUBLE) - 180.0D", "alt": "s % 3000",
        "tz": "-5 - s_nationkey % 4", "dst": "'A'", "tzone": _s("Zone/", "s_nationkey"),
    })
    hubs = _typed(events.selectExpr(f"{STATION_CODE} AS code").distinct(), schemas.AIRPORTS, {
        "rownames": "0", "faa": "code", "name": "concat('Hub ', code)", "lat": "40.0D", "lon": "-74.0D", "alt": "10", "tz": "-5",
        "dst": "'A'", "tzone": "'America/New_York'",
    })
    return served.unionByName(hubs)


def ourairports(part: DataFrame) -> DataFrame:
    return _typed(part.selectExpr("*", "p_partkey AS p"), schemas.OURAIRPORTS, {
        "id": "p", "ident": _s("P", "p"), "type": _pick(AIRPORT_TYPES, "p % 3"), "name": "p_name",
        "latitude_deg": "CAST(p % 180 AS DOUBLE) - 90.0D", "longitude_deg": "CAST(p % 360 AS DOUBLE) - 180.0D", "elevation_ft": "p % 5000",
        "continent": "'NA'", "iso_country": _s("N", "p % 25"), "iso_region": _s("R", "p % 50"),
        "municipality": f"CASE WHEN p % 10 = 0 THEN '' ELSE {_s('City', 'p % 97')} END",
        "scheduled_service": "CASE WHEN p % 2 = 0 THEN 'yes' ELSE 'no' END",
        "icao_code": _s("I", "p"),
        "iata_code": f"CASE WHEN p % 4 = 0 THEN {_s('S', 'p div 4 * 3')} END",
        "gps_code": "NULL",
        "local_code": f"CASE WHEN p % 4 = 1 THEN {_s('S', 'p div 8 * 3 + 1')} WHEN p % 4 = 3 THEN {_s('S', 'p div 4 * 3')} END",
        "home_link": "NULL", "wikipedia_link": "NULL", "keywords": "NULL",
    })


def openflights(supplier: DataFrame) -> DataFrame:
    return _typed(supplier.selectExpr("*", "s_suppkey AS s", "s_nationkey AS n"), schemas.OPENFLIGHTS, {
        "airline_id": "s", "name": "s_name", "alias": "NULL",
        "iata": f"CASE WHEN s % 7 != 0 THEN {_s('C', 's % 25')} END",
        "icao": _s("X", "s"), "callsign": _s("CALL", "n"), "country": _s("NATION_", "n"),
        "active": "CASE WHEN s % 3 = 0 THEN 'N' ELSE 'Y' END",
    })


class RawSources(Mapping):
    """The seven raw sources over ``sf_dir``, each made when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        def t(name: str) -> DataFrame:
            return read_driver(spark, sf_dir, name)

        self._makers = {
            "flights": lambda: flights(t("orders")),
            "weather": lambda: weather(t("events")),
            "planes": lambda: planes(t("part")),
            "airlines": lambda: airlines(t("nation")),
            "airports": lambda: airports(t("supplier"), t("events")),
            "ourairports_airports": lambda: ourairports(t("part")),
            "openflights_airlines": lambda: openflights(t("supplier")),
        }
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def raw_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    """All seven raw sources as lazy DataFrames over ``sf_dir``."""
    return RawSources(spark, sf_dir)
