"""The daily run and the backfill of a range of days."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.keys import date_key, instant
from gridloom.operators import quality
from gridloom.operators.calendar import build_dim_date, build_dim_time
from gridloom.operators.dims import build_dim_meter, customer_changes, upsert_dim_location
from gridloom.operators.fact import FACT_UPDATE_COLS, build_fact_consumption, meter_profile
from gridloom.operators.merge import insert_if_absent
from gridloom.operators.quantiles import value_states
from gridloom.operators.staging import READINGS, TELEMETRY, WEATHER, Stage
from gridloom.plans.ingest import ingest_files, ingest_reference
from gridloom.plans.ledger import batches_of, load_summary
from gridloom.schemas import (
    DIM_CUSTOMER, DIM_DATE, DIM_LOCATION, DIM_METER, DIM_TIME, DQ_CHECK_RESULTS, DQ_PIPELINE_METRICS,
    DQ_QUARANTINE, FACT_CONSUMPTION, LOAD_LEDGER, RAW_CUSTOMERS, RAW_LOCATIONS, RAW_METERS,
    READING_STATES, STG_READINGS, STG_TELEMETRY, STG_WEATHER, Table,
)
from gridloom.sources.landing import METER_FILES, TELEMETRY_FILES, WEATHER_FILES, Landing, list_files
from gridloom.sources.warehouse import Warehouse

STATUS = "step string, status string, rows bigint"
SHARED_WEATHER = "weather.csv"


@dataclass(frozen=True)
class Feed:
    """A landed kind of file with its staging rules and target."""

    landing: Landing
    stage: Stage
    target: Table
    surrogate: str
    update_cols: tuple[str, ...]

    @property
    def moment(self) -> str:
        return self.stage.keys[-1]


METER_FEED = Feed(
    METER_FILES, READINGS, STG_READINGS, "meter_reading_id",
    ("consumption_kwh", "_raw_id", "_batch_id", "_loaded_at"),
)
WEATHER_FEED = Feed(
    WEATHER_FILES, WEATHER, STG_WEATHER, "weather_id",
    ("temperature_c", "humidity_pct", "wind_speed_ms", "cloud_cover_pct", "precipitation_mm",
     "_raw_id", "_batch_id", "_loaded_at"),
)
TELEMETRY_FEED = Feed(
    TELEMETRY_FILES, TELEMETRY, STG_TELEMETRY, "telemetry_id",
    ("sensor_value", "unit", "_raw_id", "_batch_id", "_loaded_at"),
)


def stage_batches(
    wh: Warehouse, feed: Feed, batch_ids: Sequence[str], run_ts: datetime, mode: str = "default"
) -> list[date]:
    """Quarantine and stage the batches; returns the days whose partitions were rewritten.

    The staging surrogate is the raw id of the row that first created the staged row:
    unique, kept on later updates, and free of any global numbering.
    """
    batch_ids = list(batch_ids)
    raw = wh.read(feed.landing.table)
    valid, rejected = feed.stage.split(raw, batch_ids, run_ts, mode)
    wh.insert_if_absent(
        DQ_QUARANTINE,
        rejected,
        (F.col("source_table") == feed.stage.source_table) & F.col("_batch_id").isin(batch_ids),
    )
    day = feed.target.partition_by[0]
    # Calendar days of the valid rows, found without the de-duplication shuffle.
    days = feed.stage.typed_rows(valid, mode).select(F.to_date(feed.moment).alias(day)).distinct()
    touched = sorted(r[0] for r in days.collect())
    updates = feed.stage.stage(raw, batch_ids, mode).withColumns(
        {
            feed.surrogate: F.col("_raw_id"),
            "_loaded_at": instant(run_ts),
            day: F.to_date(feed.moment),
        }
    )
    wh.upsert(feed.target, updates, touched, feed.update_cols)
    return touched


def refresh_calendar(wh: Warehouse) -> None:
    """Seed the fixed calendar dimensions; existing rows are never changed."""
    for table, rows in ((DIM_DATE, build_dim_date(wh.spark)), (DIM_TIME, build_dim_time(wh.spark))):
        stored = wh.read(table)
        if stored.isEmpty():
            wh.replace(table, insert_if_absent(stored, rows, table.keys).coalesce(1))


def refresh_dimensions(wh: Warehouse, run_ts: datetime, policy: str = "contiguous") -> None:
    refresh_calendar(wh)
    still_open, closed = customer_changes(
        wh.read_open(DIM_CUSTOMER), wh.read(DIM_CUSTOMER), wh.read(RAW_CUSTOMERS), run_ts, policy
    )
    wh.replace_open(DIM_CUSTOMER, still_open, closed)
    wh.replace(DIM_LOCATION, upsert_dim_location(wh.read(DIM_LOCATION), wh.read(RAW_LOCATIONS)))
    wh.replace(
        DIM_METER,
        build_dim_meter(wh.read(DIM_METER), wh.read(RAW_METERS), wh.read(DIM_CUSTOMER), wh.read(DIM_LOCATION)),
    )


def refresh_fact(
    wh: Warehouse, batch_ids: Sequence[str], days: Sequence[date], run_ts: datetime
) -> None:
    """Build and merge the fact rows of the batches; ``days`` prunes staging, weather and fact."""
    days = list(days)
    if not days:
        return
    stg = wh.read(STG_READINGS).filter(F.col("reading_date").isin(days))
    weather = wh.read(STG_WEATHER).filter(F.col("observation_date").isin(days))
    profile = meter_profile(wh.read(DIM_METER), wh.read(DIM_CUSTOMER), wh.read(DIM_LOCATION))
    rows = build_fact_consumption(
        stg, profile, wh.read(DIM_DATE), wh.read(DIM_TIME), weather, list(batch_ids), stg_id="meter_reading_id"
    ).withColumns(
        {"consumption_id": F.col("_stg_id"), "_loaded_at": instant(run_ts)}
    )
    keys = [int(d.strftime("%Y%m%d")) for d in days]
    wh.upsert(FACT_CONSUMPTION, rows, keys, (*FACT_UPDATE_COLS, "_loaded_at"))


def day_files(prefix: str, ds: str, suffix: str, listed: Sequence[str]) -> list[str]:
    """``<prefix>_<ds>.<suffix>`` and, for a day delivered in pieces, ``<prefix>_<ds>.partN.<suffix>``."""
    shape = re.compile(rf"{prefix}_{re.escape(ds)}(\.part\d+)?\.{suffix}")
    return [name for name in listed if shape.fullmatch(name)]


def weather_files(days: Sequence[str], listed: Sequence[str]) -> list[str]:
    """Each day's own files, else the shared one, in day order without repeats."""
    chosen: list[str] = []
    for ds in days:
        own = day_files("weather", ds, "csv", listed) or [n for n in listed if n == SHARED_WEATHER]
        chosen += [name for name in own if name not in chosen]
    return chosen


def _names(wh: Warehouse, directory: str) -> list[str]:
    """File names in a folder, none when it does not exist."""
    try:
        return sorted(r.source_file for r in list_files(wh.spark, directory).select("source_file").collect())
    except FileNotFoundError:
        return []


def run_days(
    wh: Warehouse, landing_dir: str, days: Sequence[date], run_ts: datetime, mode: str = "default"
) -> DataFrame:
    """Ingest, stage, refresh dimensions and build the fact for a set of days in one pass.

    Readings lie in ``meter_readings/``, everything else in ``landing_dir`` itself.
    Missing weather or telemetry skips its step; missing readings skip the fact.
    """
    spark = wh.spark
    texts = [d.isoformat() for d in days]
    readings_dir = f"{landing_dir}/meter_readings"
    listed, readings = _names(wh, landing_dir), _names(wh, readings_dir)
    steps: list[tuple[str, str, int]] = []

    reference = ingest_reference(wh, landing_dir, run_ts).agg(F.sum("rows_read")).first()[0]
    steps.append(("ingest_reference", "success" if reference is not None else "skipped", reference or 0))

    plans = (
        (METER_FEED, readings_dir, [n for t in texts for n in day_files("readings", t, "csv", readings)]),
        (WEATHER_FEED, landing_dir, weather_files(texts, listed)),
        (TELEMETRY_FEED, landing_dir, [n for t in texts for n in day_files("telemetry", t, "json", listed)]),
    )
    staged: dict[str, tuple[list[str], list[date]]] = {}
    for feed, folder, names in plans:
        short = feed.target.name.split("/")[1]
        if not names:
            steps += [(f"ingest_{short[4:]}", "skipped", 0), (short, "skipped", 0)]
            staged[short] = ([], [])
            continue
        loaded = load_summary(ingest_files(wh, feed.landing, folder, run_ts, "*", names)).first()
        steps.append((f"ingest_{short[4:]}", "success" if loaded.loaded else "skipped", loaded.total_rows))
        found = batches_of(wh.read(LOAD_LEDGER), feed.stage.source_table, names)
        batches = [found[n] for n in names]
        touched = stage_batches(wh, feed, batches, run_ts, mode)
        part = feed.target.partition_by[0]
        count = wh.read(feed.target).filter(F.col(part).isin(touched) & F.col("_batch_id").isin(batches)).count()
        steps.append((short, "success", count))
        staged[short] = (batches, touched)

    refresh_dimensions(wh, run_ts)
    for table in (DIM_CUSTOMER, DIM_LOCATION, DIM_METER):
        steps.append((table.name.split("/")[1], "success", wh.read(table).count()))

    batches, touched = staged["stg_meter_readings"]
    refresh_fact(wh, batches, touched, run_ts)
    keys = [int(d.strftime("%Y%m%d")) for d in touched]
    facts = wh.read(FACT_CONSUMPTION).filter(F.col("date_key").isin(keys)).count() if batches else 0
    steps.append(("fact_consumption", "success" if batches else "skipped", facts))
    return spark.createDataFrame(steps, STATUS)


def run_day(wh: Warehouse, landing_dir: str, ds: date, run_ts: datetime, mode: str = "default") -> DataFrame:
    return run_days(wh, landing_dir, [ds], run_ts, mode)


def backfill(
    wh: Warehouse, landing_dir: str, start: date, end: date, run_ts: datetime, mode: str = "default"
) -> DataFrame:
    """All days from ``start`` to ``end`` as one set-based run; the later file wins, as day by day."""
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    return run_days(wh, landing_dir, days, run_ts, mode)


# --- data quality over the warehouse ---------------------------------------


def log_checks(
    wh: Warehouse, execution_date: date, run_ts: datetime, days: Sequence[date] | None = None
) -> DataFrame:
    """Check staging and fact, log the outcome for ``execution_date`` and return it.

    A repeated run replaces the day's log.
    ``days`` limits the check to the partitions a run has rewritten. That keeps it as
    large as the run, and uniqueness is still proven: a key lies in one partition.
    """
    no_limit = 1 << 62
    plans = (
        (STG_READINGS, [quality.not_blank("meter_id"), quality.max_length("meter_id", 50),
                        quality.in_range("consumption_kwh", 0, 10000)]),
        (STG_WEATHER, [quality.not_blank("location_id"), quality.in_range("temperature_c", -60, 60),
                       quality.in_range("humidity_pct", 0, 100)]),
        (STG_TELEMETRY, [quality.not_blank("equipment_id"), quality.max_length("sensor_type", 50)]),
        (FACT_CONSUMPTION, [quality.in_range("cost_usd", 0, 10000),
                            quality.Check("has_temperature", F.col("temperature_c").isNull(), "info", no_limit)]),
    )
    logged: list[DataFrame] = []
    for table, checks in plans:
        rows, part = wh.read(table), table.partition_by[0]
        if days is not None:
            values = [int(d.strftime("%Y%m%d")) for d in days] if part == "date_key" else list(days)
            rows = rows.filter(F.col(part).isin(values))
        name = table.name.replace("/", ".")
        required = [quality.not_null(c) for c in table.required]
        for result in (
            quality.run_checks(rows, [*required, *checks], name, execution_date),
            quality.duplicate_check(rows, table.keys, name, execution_date),
        ):
            started = time.monotonic()
            outcome = result.collect()  # one row per check
            elapsed = int((time.monotonic() - started) * 1000)
            logged.append(
                wh.spark.createDataFrame(outcome, result.schema).withColumns(
                    {"execution_time_ms": F.lit(elapsed), "created_at": instant(run_ts)}
                )
            )
    wh.overwrite_partitions(DQ_CHECK_RESULTS, reduce(DataFrame.unionByName, logged))
    return wh.read(DQ_CHECK_RESULTS).filter(F.col("execution_date") == F.lit(execution_date))


def refresh_states(wh: Warehouse, days: Sequence[date]) -> None:
    """Rebuild the mergeable states of consumption for the days whose staging has changed.

    Bounds of any period then come from :func:`period_states`, without its readings.
    """
    if not days:
        return
    stg = wh.read(STG_READINGS).filter(F.col("reading_date").isin(list(days)))
    states = value_states(stg, ["reading_date", "meter_id"], "consumption_kwh")
    wh.overwrite_partitions(READING_STATES, states)


def period_states(wh: Warehouse, start: date, end: date) -> DataFrame:
    return wh.read(READING_STATES).filter(F.col("reading_date").between(F.lit(start), F.lit(end)))


def log_metrics(wh: Warehouse, execution_date: date, run_ts: datetime) -> DataFrame:
    """Row counts of the run's day; a repeated run replaces the day's rows."""
    fact = wh.read(FACT_CONSUMPTION).filter(F.col("date_key") == date_key(F.lit(execution_date).cast("date")))
    metrics = {
        "fact_rows": F.count(F.lit(1)),
        "total_kwh": F.coalesce(F.sum("consumption_kwh"), F.lit(0)),
        "total_cost_usd": F.coalesce(F.sum("cost_usd"), F.lit(0)),
    }
    rows = quality.metric_rows(fact, metrics, "fact_consumption", execution_date).withColumns(
        {"details": F.lit(None).cast("string"), "created_at": instant(run_ts)}
    )
    wh.overwrite_partitions(DQ_PIPELINE_METRICS, rows)
    return wh.read(DQ_PIPELINE_METRICS).filter(F.col("execution_date") == F.lit(execution_date))


def resolve(wh: Warehouse, source_table: str, batch_ids: Sequence[str], condition, note: str, at: datetime) -> None:
    """Resolve matching quarantine rows; only the partitions of the given batches are rewritten."""
    rows = wh.read(DQ_QUARANTINE).filter(
        (F.col("source_table") == source_table) & F.col("_batch_id").isin(list(batch_ids))
    )
    wh.swap_partitions(DQ_QUARANTINE, quality.resolve_quarantine(rows, condition, note, at))
