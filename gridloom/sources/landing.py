"""Landed CSV and JSON Lines files as all-string rows."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import strip
from gridloom.schemas import RAW_READINGS, RAW_TELEMETRY, RAW_WEATHER, Table


@dataclass(frozen=True)
class Landing:
    """A kind of landed file.

    ``fields`` maps each column to the value it takes when the header lacks it; a column
    that is present but blank stays ``""``. ``needed`` must be in the header.
    """

    source_table: str
    pattern: str
    fields: Mapping[str, str]
    needed: tuple[str, ...]
    table: Table | None = None
    file_format: str = "csv"
    unstripped: frozenset[str] = field(default_factory=frozenset)


METER_FILES = Landing(
    "raw.raw_meter_readings",
    "readings_*.csv",
    {"meter_id": "", "reading_timestamp": "", "consumption_kwh": "", "unit": "kWh"},
    ("meter_id", "reading_timestamp", "consumption_kwh"),
    RAW_READINGS,
)
WEATHER_FILES = Landing(
    "raw.raw_weather_data",
    "weather*.csv",
    dict.fromkeys(
        ("location_id", "observation_time", "temperature_c", "humidity_pct", "wind_speed_ms",
         "cloud_cover_pct", "precipitation_mm"),
        "",
    ),
    ("location_id", "observation_time"),
    RAW_WEATHER,
)
TELEMETRY_FILES = Landing(
    "raw.raw_equipment_telemetry",
    "telemetry_*.json",
    dict.fromkeys(("equipment_id", "sensor_type", "reading_timestamp", "sensor_value", "unit"), ""),
    (),
    RAW_TELEMETRY,
    file_format="json",
)
CUSTOMER_FILE = Landing(
    "raw.raw_customers",
    "customers.csv",
    dict.fromkeys(("customer_id", "customer_name", "tariff_type", "signup_date", "status"), ""),
    ("customer_id",),
    unstripped=frozenset({"signup_date"}),
)
LOCATION_FILE = Landing(
    "raw.raw_locations",
    "locations.csv",
    {"location_id": "", "address": "", "city": "", "region": "", "country": "UK", "latitude": "",
     "longitude": "", "timezone": "Europe/London"},
    ("location_id",),
    unstripped=frozenset({"latitude", "longitude"}),
)
METER_FILE = Landing(
    "raw.raw_meters",
    "meters.csv",
    dict.fromkeys(("meter_id", "customer_id", "meter_type", "install_date", "location_id", "status"), ""),
    ("meter_id",),
    unstripped=frozenset({"install_date"}),
)


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """(source_file, path) of the files directly inside ``directory``.

    Spark lists them; the contents are not read because only ``path`` is selected.
    """
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"source directory not found: {directory}") from error
        raise
    return found.select(F.substring_index("path", "/", -1).alias("source_file"), "path")


def _base_name() -> Column:
    """The file's plain base name; Spark's metadata column shows special characters encoded."""
    shown = F.col("_metadata.file_name")
    decoded = F.url_decode(F.replace(shown, F.lit("+"), F.lit("%2B")))
    return F.when(shown.contains("%"), decoded).otherwise(shown).alias("_source_file")


def group_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files with the same header line, which Spark may read together.

    Spark matches the columns of later files by position, so files whose header
    differs need a read of their own. The first lines are found by a scan of the files as text
    on the executors; the driver gets each distinct header once, with the paths it must
    hand to the reader.
    """
    if not paths:
        return {}
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    bare = lambda path: path.split(":", 1)[-1].lstrip("/")
    given = {bare(path): path for path in paths}  # the metadata shows special characters encoded
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in found:  # an empty file has no line, and so no header and no rows
        header = tuple(next(csv.reader([row.header.removeprefix("\ufeff")]), ()))
        if header:
            groups[header] += [given[bare(unquote(path))] for path in row.paths]
    return {header: sorted(group) for header, group in groups.items()}


def missing_columns(headers: Mapping[tuple[str, ...], Sequence[str]], landing: Landing) -> dict[str, list[str]]:
    """Needed columns that the headers lack, for the files that lack any."""
    found: dict[str, list[str]] = {}
    for header, group in headers.items():
        lacking = [name for name in landing.needed if name not in header]
        if lacking:
            found |= dict.fromkeys(group, lacking)
    return found


def _read_csv_group(
    spark: SparkSession, header: tuple[str, ...], paths: list[str], landing: Landing, multi_line: bool
) -> DataFrame:
    missing = [name for name in landing.needed if name not in header]
    if missing:
        raise ValueError(f"columns {missing} missing from the header of {paths[0]}")
    schema = ", ".join(f"_c{i} string" for i in range(len(header))) + ", _malformed string"
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", "_malformed")
        .csv(paths)
    )
    # Spark reads a blank field and a field missing from a short row both as NULL. Only the
    # latter may stay NULL, so fields of malformed rows are counted: separators outside quotes.
    unquoted = F.regexp_replace("_malformed", r'"(?:[^"]|"")*"', "")
    fields_seen = F.coalesce(
        F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1, F.lit(len(header))
    )
    position = {name: i for i, name in enumerate(header)}  # the last of repeated names counts

    def value(name: str, default: str):
        if name not in position:
            return F.lit(default).alias(name)
        i = position[name]
        text = F.coalesce(F.col(f"_c{i}"), F.when(fields_seen > i, F.lit("")))
        return (text if name in landing.unstripped else strip(text)).alias(name)

    return rows.select(
        *[value(name, default) for name, default in landing.fields.items()],
        _base_name(),
        F.col("_metadata.file_block_start").alias("_file_pos"),
    )


def read_landed(
    spark: SparkSession, paths: Sequence[str], landing: Landing, multi_line: bool = False,
    headers: Mapping[tuple[str, ...], Sequence[str]] | None = None,
) -> DataFrame:
    """String rows of the given files with ``_source_file`` and ``_file_pos``.

    ``multi_line`` allows quoted line breaks, at the price of one task per file. ``headers`` are
    those of :func:`group_by_header`, if they are known already.
    """
    paths = list(paths)
    columns = [*landing.fields, "_source_file", "_file_pos"]
    if landing.file_format == "json":
        schema = ", ".join(f"{name} string" for name in landing.fields)
        parts = [
            spark.read.schema(schema).json(paths).select(
                *landing.fields,
                _base_name(),
                F.col("_metadata.file_block_start").alias("_file_pos"),
            )
        ] if paths else []
    else:
        groups = group_by_header(spark, paths) if headers is None else headers
        parts = [_read_csv_group(spark, h, list(group), landing, multi_line) for h, group in sorted(groups.items())]
    if not parts:
        ddl = ", ".join(f"{c} string" for c in columns[:-1]) + ", _file_pos bigint"
        return spark.createDataFrame([], ddl)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
