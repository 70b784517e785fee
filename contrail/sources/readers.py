"""Source registry and readers (CSV files, seeds, Parquet tables)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.sources import schemas


@dataclass(frozen=True)
class Source:
    """One raw input: file name, load mode and CSV dialect."""

    name: str
    file: str
    monthly: bool = False
    header: bool = True
    nullstr: str | None = None
    columns: tuple[str, ...] = ()
    multiline: bool = False  # quoted fields may hold line breaks (one split for each file)
    schema: T.StructType | None = field(default=None, compare=False, hash=False)

    def declared_schema(self) -> T.StructType:
        return self.schema if self.schema is not None else schemas.RAW_SCHEMAS[self.name]


# The seven raw sources.  Monthly sources are loaded month by month into a
# (year, month)-partitioned table; the rest are replaced whole.  The airline
# reference file has no header and uses \N as its null token.
SOURCES: tuple[Source, ...] = (
    Source("flights", "flights.csv", monthly=True),
    Source("weather", "weather.csv", monthly=True),
    Source("planes", "planes.csv"),
    Source("airlines", "airlines.csv"),
    Source("airports", "airports.csv"),
    Source("ourairports_airports", "ourairports_airports.csv"),
    Source("openflights_airlines", "openflights_airlines.dat", header=False, nullstr="\\N",
           columns=("airline_id", "name", "alias", "iata", "icao", "callsign", "country", "active")),
)

SOURCES_BY_NAME = {s.name: s for s in SOURCES}


#: Columns that a read with ``on_bad="keep"`` adds.
BAD, FILE, RECORD = "_bad", "_file", "_record"
REJECT_COLUMNS = (BAD, FILE, RECORD)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _typed_sql(f: T.StructField) -> str:
    """A text column as its declared type, NULL where it is empty or doesn't fit."""
    name = _quoted(f.name)
    if isinstance(f.dataType, T.StringType):
        return f"nullif({name}, '') AS {name}"
    return f"try_cast(nullif(trim({name}), '') AS {f.dataType.simpleString()}) AS {name}"


def _strict_sql(f: T.StructField, file: str) -> str:
    """A text column as its declared type; a value that doesn't fit fails the job."""
    if isinstance(f.dataType, T.StringType):
        return _typed_sql(f)
    name, kind = _quoted(f.name), f.dataType.simpleString()
    says = f"{file}: column {f.name} holds ".replace("'", "\\'")
    bad = f"CAST(raise_error(concat('{says}', trim({name}), ', which is no {kind}')) AS {kind})"
    return f"CASE WHEN trim({name}) != '' AND try_cast(trim({name}) AS {kind}) IS NULL THEN {bad} ELSE try_cast(nullif(trim({name}), '') AS {kind}) END AS {name}"


def _bad_sql(f: T.StructField) -> str:
    name, label = _quoted(f.name), f.name.replace("'", "\\'")
    return (f"CASE WHEN trim({name}) != '' AND try_cast(trim({name}) AS {f.dataType.simpleString()}) IS NULL "
            f"THEN named_struct('column', '{label}', 'value', {name}, 'kind', '{f.dataType.simpleString()}') END")


def read_source(spark: SparkSession, src: Source, raw_dir: str, infer: bool = False, on_bad: str = "fail") -> DataFrame:
    """Lazy scan of one delimited source, in parallel splits.

    Columns are found by the names in the header, whatever their order; a
    declared column that the file lacks is an error, and columns that the file
    has beyond the declared ones follow as text, so that a load sees the drift.
    Empty fields are NULL.  A value that doesn't fit its declared type, or a record
    with another number of fields, fails the job; with ``on_bad="keep"`` the row stays
    and three columns say what is wrong (``_bad``: column, value and kind of each bad
    field; ``_file``; ``_record``: the fields as text), for the loader to take out
    (see ``contrail.operators.rejects``).  ``infer=True`` samples every row (a full extra
    pass) and is only meant for exploring a new file.
    """
    path = f"{raw_dir.rstrip('/')}/{src.file}"
    keep = on_bad == "keep"
    reader = (spark.read
              .option("header", str(src.header).lower())
              .option("quote", '"')
              .option("escape", '"')
              .option("multiLine", str(src.multiline).lower())
              .option("mode", "PERMISSIVE" if infer or keep else "FAILFAST"))
    if src.nullstr is not None:
        reader = reader.option("nullValue", src.nullstr)
    if infer:
        df = reader.option("inferSchema", "true").option("samplingRatio", 1.0).csv(path)
        return df.toDF(*src.columns) if src.columns else df
    declared = src.declared_schema()
    if src.columns:
        names = list(src.columns)
    else:
        # One line of the file: its header.
        names = reader.option("enforceSchema", "false").csv(path).columns
    missing = [f.name for f in declared.fields if f.name not in names]
    if missing:
        raise ValueError(f"{src.file} lacks the columns {', '.join(missing)}")
    extra = [T.StructField(c, T.StringType()) for c in names if c not in declared.fieldNames()]
    fields = [*declared.fields, *extra]
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    bad = f"filter(array({', '.join(_bad_sql(f) for f in fields if not isinstance(f.dataType, T.StringType))}), x -> x IS NOT NULL)"
    typed = [_typed_sql(f) for f in fields]
    if keep:
        text = text.add("_corrupt", T.StringType())
        broken = "named_struct('column', CAST(NULL AS STRING), 'value', _corrupt, 'kind', 'record')"
        rows = reader.option("columnNameOfCorruptRecord", "_corrupt").schema(text).csv(path)
        return rows.selectExpr(*typed, f"CASE WHEN _corrupt IS NOT NULL THEN array({broken}) ELSE {bad} END AS {BAD}", f"_metadata.file_name AS {FILE}",
                               f"coalesce(_corrupt, concat_ws(',', {', '.join(_quoted(c) for c in names)})) AS {RECORD}")
    return reader.schema(text).csv(path).selectExpr(*[_strict_sql(f, src.file) for f in fields])


# The 2013 US federal holiday seed (date, name), in calendar order.
US_HOLIDAYS_2013 = (
    ("2013-01-01", "New Years Day"),
    ("2013-01-21", "Martin Luther King Jr Day"),
    ("2013-02-18", "Washingtons Birthday"),
    ("2013-05-27", "Memorial Day"),
    ("2013-07-04", "Independence Day"),
    ("2013-09-02", "Labor Day"),
    ("2013-10-14", "Columbus Day"),
    ("2013-11-11", "Veterans Day"),
    ("2013-11-28", "Thanksgiving Day"),
    ("2013-12-25", "Christmas Day"),
)


def read_seed(spark: SparkSession, rows=US_HOLIDAYS_2013, path: str | None = None) -> DataFrame:
    """The holiday seed as a typed DataFrame (from a CSV file or in-line rows)."""
    if path is not None:
        return (spark.read.option("header", "true").schema(schemas.HOLIDAYS).csv(path))
    data = [(dt.date.fromisoformat(d), n) for d, n in rows]
    return spark.createDataFrame(data, schemas.HOLIDAYS)


# US federal holidays by date (month, day, name, first year) and by
# weekday (month, weekday, which one of the month, name; -1: the last one).
FIXED_DATE_HOLIDAYS = (
    (1, 1, "New Years Day", None),
    (6, 19, "Juneteenth National Independence Day", 2021),
    (7, 4, "Independence Day", None),
    (11, 11, "Veterans Day", None),
    (12, 25, "Christmas Day", None),
)
WEEKDAY_HOLIDAYS = (
    (1, "MON", 3, "Martin Luther King Jr Day"),
    (2, "MON", 3, "Washingtons Birthday"),
    (5, "MON", -1, "Memorial Day"),
    (9, "MON", 1, "Labor Day"),
    (10, "MON", 2, "Columbus Day"),
    (11, "THU", 4, "Thanksgiving Day"),
)


def _nth_weekday(year, month: int, weekday: str, nth: int):
    if nth < 0:  # the first one after the last week began
        return F.next_day(F.date_sub(F.last_day(F.make_date(year, F.lit(month), F.lit(1))), 7), weekday)
    first = F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1), weekday)
    return F.date_add(first, 7 * (nth - 1))


def holidays_for_years(years: DataFrame, year_col: str = "year") -> DataFrame:
    """The federal holidays of every year in ``years`` (one generator, no join):
    ten, and an eleventh from 2021 on."""
    year = F.col(year_col)
    entries = []
    for m, d, name, since in FIXED_DATE_HOLIDAYS:
        day = F.make_date(year, F.lit(m), F.lit(d))
        entries.append((day if since is None else F.when(year >= since, day), name))
    entries += [(_nth_weekday(year, m, weekday, nth), name) for m, weekday, nth, name in WEEKDAY_HOLIDAYS]
    rows = F.array(*[F.struct(day.alias("holiday_date"), F.lit(name).alias("holiday_name")) for day, name in entries])
    return years.select(F.explode(rows).alias("h")).select("h.holiday_date", "h.holiday_name").where("holiday_date is not null")
