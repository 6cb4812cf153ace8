"""Landed source files to typed, quality-flagged tables.

Files are what the upstream services deliver: JSON records for bores and their
readings, CSV for rainfall and surface water. Everything is read as text under a
declared schema and coerced here; an unreadable date or number becomes NULL.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from aquifold import schemas
from aquifold.functions import AsOf, as_date

# Field names of the delivered records, newest interface first (fixed values).
WELL_FIELDS = {
    "DHNO": ["DHNO", "dh_no"], "NAME": ["NAME", "dh_name"], "LAT": ["LAT", "lat"],
    "LON": ["LON", "lon"], "AQUIFER": ["AQUIFER", "aquifer"],
}
READING_FIELDS = {
    "OBS_DATE": ["OBS_DATE", "obs_date"], "DTW": ["DTW", "water_level"], "TDS": ["TDS", "tds"],
    "PUMPING": ["PUMPING"],
}

WELL_COLUMNS = [n for n in schemas.names(schemas.WELLS) if n != "well_id"]
READING_COLUMNS = ["source_dh_no"] + [n for n in schemas.names(schemas.READINGS) if n != "well_id"]


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header-bearing CSV files under ``schema``: columns by name in any order, others left out, absent ones NULL.

    Only the header is read ahead; files of one path must agree on it. A value that does not fit its type is NULL.
    """
    header = spark.read.option("header", True).csv(path).schema
    raw = spark.read.schema(header).option("header", True).option("enforceSchema", False).csv(path)
    given = {name.strip().lower(): name for name in header.names}
    return raw.select(*[
        (F.trim(F.col(f"`{given[f.name.lower()]}`")) if f.name.lower() in given else F.lit(None).cast("string"))
        .try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    return read_csv_by_name(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(path)


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "csv") -> DataFrame:
    """One table under its declared schema; CSV needs a header line."""
    return _read(spark, path, schemas.TABLES[name], fmt)


def read_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> dict[str, DataFrame]:
    return {name: read_table(spark, path, name, fmt) for name, path in paths.items()}


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """A table that may not have been generated yet: absent means empty."""
    try:
        return _read(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def folder_value(name: str) -> Column:
    """Value of a ``name=value`` folder in the path a row was read from, as text."""
    return F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]+)/", 1))


def arrival_time() -> Column:
    return F.col("_metadata.file_modification_time").alias("arrived_at")


def read_json_records(
    spark: SparkSession,
    path: str | list[str],
    fields: dict[str, list[str]],
    array_files: bool = False,
    folders: tuple[str, ...] = (),
) -> DataFrame:
    """Records as text columns named by ``fields``; each takes its first name that a record has.

    One record per line, or one JSON array per file with ``array_files``. Records
    are parsed as maps, so no pass over the data is spent on inferring a schema.
    ``folders`` names ``key=value`` folders to keep as columns.
    """
    text = spark.read.text(path, wholetext=array_files)
    if array_files:
        record = F.explode(F.from_json("value", "array<map<string,string>>"))
    else:
        record = F.from_json("value", "map<string,string>")
    records = text.select(
        record.alias("record"), arrival_time(), *[folder_value(name).alias(f"folder_{name}") for name in folders]
    ).filter(F.col("record").isNotNull())
    return records.select(
        *[F.coalesce(*[F.col("record")[n] for n in names]).alias(column) for column, names in fields.items()],
        *[F.col(f"folder_{name}").alias(name) for name in folders],
        "arrived_at",
    )


def csv_lines(reader: DataFrameReader | DataStreamReader, path: str, folders: tuple[str, ...] = ()) -> DataFrame:
    """Lines of CSV files with their file, arrival time and ``folders`` values; of a batch or streaming reader.

    Files are read as lines, so that each can have a header of its own; quoted line ends are not supported.
    """
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        arrival_time(), *[folder_value(name).alias(name) for name in folders],
    )


#: Folders of the landed layout that tell stations and sites apart.
UNIT_FOLDERS = ("station_id", "site_id", "metric")


def no_lines(spark: SparkSession, folders: tuple[str, ...] = ()) -> DataFrame:
    """``csv_lines`` of nothing landed."""
    schema = "value string, _file string, _block bigint, arrived_at timestamp"
    return spark.createDataFrame([], schema + "".join(f", {name} string" for name in folders))


def headers(lines: DataFrame) -> DataFrame:
    """(_file, _header): the first line of every file; what leaves a task is one line a file."""
    first = lines.filter(F.col("_block") == 0).withColumn("_line", F.monotonically_increasing_id())
    return first.groupBy("_file").agg(F.min_by("value", "_line").alias("_header"))


#: Wanted columns: name to the header names it may have, in any letter case, and the place it has under none of them.
Wanted = dict[str, tuple[tuple[str, ...], int | None]]
RAIN_COLUMNS: Wanted = {"date": (("date", "date2"), 0), "rain": (("rain", "daily_rain", "rainfall"), None)}
SURFACE_COLUMNS: Wanted = {"timestamp": (("timestamp", "date"), 0), "value": (("value",), 1)}


def by_header(lines: DataFrame, wanted: Wanted) -> DataFrame:
    """The wanted columns as text, found in each file by its own header, whatever the others' order and columns.

    ``missing`` names the wanted columns a line's file lacks. All files are one read and one plan,
    however many there are: the header travels with the lines as a joined column.
    """
    index = headers(lines)
    # One number, the widest header, bounds the cells a line is split into.
    width = index.agg(F.max(F.size(F.split("_header", ",")))).first()[0] or 1
    cells = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in cells)
    options = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}

    def split(column: str, name: str, df: DataFrame) -> DataFrame:
        df = df.withColumn("_cells", F.from_csv(column, schema, options))
        return df.withColumn(name, F.array(*[F.col(f"_cells.{c}") for c in cells])).drop("_cells")

    index = split("_header", "_names", index.withColumn("_header", F.ltrim("_header", F.lit("\ufeff"))))
    lowered = F.transform("_names", lambda n: F.lower(F.trim(n)))

    def place(names: tuple[str, ...], otherwise: int | None) -> Column:
        at = [F.nullif(F.array_position(lowered, F.lit(n)), F.lit(0)) for n in names]
        if otherwise is not None:
            at.append(F.when(F.get("_names", F.lit(otherwise)).isNotNull(), F.lit(otherwise + 1)))
        return F.coalesce(*at).cast("int")

    index = index.select("_file", "_header", *[place(*w).alias(f"_at_{name}") for name, w in wanted.items()])
    lacking = F.filter(F.array(*[F.when(F.col(f"_at_{n}").isNull(), n) for n in wanted]), lambda n: n.isNotNull())
    rows = lines.join(index, "_file").filter(F.ltrim("value", F.lit("\ufeff")) != F.col("_header"))
    rows = split("value", "_values", rows).withColumn("missing", lacking)
    own = [c for c in lines.columns if c not in ("value", "_block")]
    return rows.select(*own, "missing", *[F.get("_values", F.col(f"_at_{n}") - 1).alias(n) for n in wanted])


def _first_present(df: DataFrame, *names: str) -> Column:
    """First non-null value among the columns the frame has."""
    present = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def to_number(text: Column) -> Column:
    """A plain decimal number, with or without exponent; anything else (also ``5d`` or ``NaN``) is NULL."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), trimmed.try_cast("double"))


#: Date formats tried in turn after ISO dates and timestamps; the day comes before the month.
DAY_FORMATS = (
    "yyyyMMdd", "yyyy/M/d", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy",
    "d/M/yyyy H:mm", "d/M/yyyy H:mm:ss", "yyyy/M/d H:mm:ss",
)


#: What the letters of a date format stand for in a text's shape.
_SHAPES = {"yyyy": "[0-9]{4}", "MMMM": "[A-Za-z]{3,}", "MMM": "[A-Za-z]{3}", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "mm": "[0-9]{2}", "ss": "[0-9]{2}"}
_ISO_SHAPE = "^[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}([T ].*)?)?)?$"


def _shape(fmt: str) -> str:
    tokens = [m.group() for m in re.finditer(r"([A-Za-z])\1*|.", fmt)]
    return "^" + "".join(_SHAPES.get(t, "[0-9]{1,2}" if t.isalpha() else re.escape(t)) for t in tokens) + "$"


def _by_shape(text: Column, kind: str, formats: tuple[str, ...]) -> Column:
    """The text's shape chooses the one parser it goes through; texts of no known shape go through none."""
    parsed = F.when(text.rlike(_ISO_SHAPE), text.try_cast(kind))
    for fmt in formats:
        parsed = parsed.when(text.rlike(_shape(fmt)), F.try_to_timestamp(text, F.lit(fmt)).cast(kind))
    return parsed


def to_moment(text: Column, formats: tuple[str, ...] = DAY_FORMATS) -> Column:
    """Timestamp of an ISO date or timestamp, or of one of ``formats``."""
    return _by_shape(F.trim(text), "timestamp", formats)


def to_day(text: Column, formats: tuple[str, ...] = DAY_FORMATS) -> Column:
    """Day of an ISO date or timestamp, or of one of ``formats``; an unreadable one is NULL."""
    return _by_shape(F.trim(text), "date", formats)


def unreadable_days(raw: DataFrame, column: str) -> DataFrame:
    """Number of rows whose day is missing or in no known format, and so dropped by the normalisers."""
    return raw.agg(F.count_if(to_day(F.col(column)).isNull()).alias("unreadable"), F.count(F.lit(1)).alias("rows"))


def _carried(raw: DataFrame) -> list[Column]:
    """Arrival time, kept if the raw frame has it, to order repeated deliveries of a key."""
    return [F.col("arrived_at")] if "arrived_at" in raw.columns else []


def _value(column: str | Column) -> Column:
    return column if isinstance(column, Column) else F.lit(column)


def flag_level_quality(level: Column) -> Column:
    return F.when((level < 0) | (level > 300), "suspect").otherwise("measured")


def flag_rain_quality(mm: Column) -> Column:
    return F.when(mm < 0, "suspect").otherwise("measured")


# Name patterns of coastal aquifers and districts (fixed values).
COASTAL_AQUIFER = "coast"
COASTAL_AREA = "McLaren|Willunga"


def coastal_flag(aquifer: Column, area: Column) -> Column:
    """1 for a coastal aquifer or an area of the coastal districts, in any letter case."""
    by_aquifer = F.coalesce(aquifer, F.lit("")).rlike(f"(?i){COASTAL_AQUIFER}")
    by_area = F.coalesce(area, F.lit("")).rlike(f"(?i){COASTAL_AREA}")
    return (by_aquifer | by_area).cast("int")


def normalise_wells(raw: DataFrame, management_area: str | Column) -> DataFrame:
    """Bores of one area (or of the area column given), one row per drillhole."""
    named = raw.select(
        _first_present(raw, "DHNO", "dh_no").alias("source_dh_no"),
        _first_present(raw, "NAME", "dh_name").alias("location_name"),
        to_number(_first_present(raw, "LAT", "lat")).alias("latitude"),
        to_number(_first_present(raw, "LON", "lon")).alias("longitude"),
        _first_present(raw, "AQUIFER", "aquifer").alias("aquifer_name"),
        _value(management_area).alias("management_area"),
    ).withColumn("coastal_flag", coastal_flag(F.col("aquifer_name"), F.col("management_area")))
    return first_per_drillhole(named.select(*WELL_COLUMNS))


def first_per_drillhole(wells: DataFrame) -> DataFrame:
    """One row per drillhole number: the first by area, then by the other columns."""
    order = ["management_area"] + [c for c in wells.columns if c not in ("source_dh_no", "management_area")]
    first = Window.partitionBy("source_dh_no").orderBy(*order)
    return wells.withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place")


def normalise_readings(raw: DataFrame, source_dh_no: str | Column, dropped: Observation | None = None) -> DataFrame:
    """Typed, flagged readings; ``dropped`` observes how many rows there were and how many had no readable day."""
    pumping = (
        F.coalesce(to_number(F.col("PUMPING").cast("string")), F.lit(0.0)).try_cast("int")
        if "PUMPING" in raw.columns else F.lit(0)
    )
    typed = (
        raw.select(
            _value(source_dh_no).cast("string").alias("source_dh_no"),
            to_day(_first_present(raw, "OBS_DATE", "obs_date")).alias("reading_date"),
            to_number(_first_present(raw, "DTW", "water_level")).alias("water_level_mbgl"),
            to_number(_first_present(raw, "TDS", "tds")).alias("tds_mg_per_l"),
            pumping.alias("pumping_event"),
            *_carried(raw),
        )
        .withColumn("data_quality_flag", flag_level_quality(F.col("water_level_mbgl")))
    )
    if dropped is not None:
        typed = typed.observe(dropped, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reading_date").isNull()).alias("dropped"))
    return typed.filter(F.col("reading_date").isNotNull()).select(*READING_COLUMNS, *_carried(raw))


def _header(df: DataFrame, wanted: tuple[str, ...], position: int | None) -> Column:
    """Column whose header matches one of ``wanted`` in any case, else the one at ``position``."""
    by_name = {name.strip().lower(): name for name in df.columns}
    by_name.pop("arrived_at", None)
    for name in wanted:
        if name in by_name:
            return F.col(f"`{by_name[name]}`").cast("string")
    if position is None or position >= len(df.columns):
        raise ValueError(f"none of {wanted} among {df.columns}")
    return F.col(f"`{df.columns[position]}`").cast("string")


def normalise_rainfall(
    raw: DataFrame, station_id: str | Column, station_name: str | Column, management_area: str | Column
) -> DataFrame:
    return (
        raw.select(
            _value(station_id).cast("string").alias("station_id"),
            _value(station_name).alias("station_name"),
            _value(management_area).alias("management_area"),
            to_day(_header(raw, ("date", "date2"), 0)).alias("obs_date"),
            to_number(_header(raw, ("rain", "daily_rain", "rainfall"), None)).alias("rainfall_mm"),
            *_carried(raw),
        )
        .withColumn("data_quality_flag", flag_rain_quality(F.col("rainfall_mm")))
        .filter(F.col("obs_date").isNotNull())
    )


def normalise_surface(
    raw: DataFrame, site_id: str | Column, site_name: str | Column, metric_name: str | Column
) -> DataFrame:
    return raw.select(
        _value(site_id).cast("string").alias("site_id"),
        _value(site_name).alias("site_name"),
        to_moment(_header(raw, ("timestamp", "date"), 0)).alias("reading_datetime"),
        _value(metric_name).alias("metric_name"),
        to_number(_header(raw, ("value",), 1)).alias("metric_value"),
        F.lit("measured").alias("data_quality_flag"),
        *_carried(raw),
    ).filter(F.col("reading_datetime").isNotNull())


def collect_all(spark: SparkSession, frames: list[DataFrame], empty: T.StructType) -> DataFrame:
    """All frames of a source in one; none gives a typed empty table."""
    if not frames:
        return spark.createDataFrame([], empty)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def history_window(df: DataFrame, column: str, as_of: AsOf, years: int = 5) -> DataFrame:
    """Rows dated within the last ``365 * years`` days up to ``as_of``."""
    return df.filter(in_window(column, as_of, years))


def in_window(column: str, as_of: AsOf, years: int = 5) -> Column:
    today = as_date(as_of)
    return F.col(column).cast("date").between(F.date_sub(today, 365 * years), today)
