"""Customer, location and meter dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.tariff import customer_segment
from gridloom.operators.scd2 import scd2_changes, scd2_merge, settle_changes
from gridloom.operators.surrogate import number_settled
from gridloom.session import staged

TRACKED = ("customer_name", "tariff_type", "status")


def _customer_rules(run_ts: datetime, policy: str) -> dict:
    return {
        "key": "customer_id",
        "tracked": TRACKED,
        "derived": {"segment": customer_segment(F.col("tariff_type"))},
        "valid_from": F.col("signup_date"),
        "run_ts": run_ts,
        "surrogate": "customer_key",
        "policy": policy,
    }


def merge_dim_customer(
    dim: DataFrame, raw_customers: DataFrame, run_ts: datetime, policy: str = "contiguous"
) -> DataFrame:
    return scd2_merge(dim, raw_customers, **_customer_rules(run_ts, policy))


def customer_changes(
    open_versions: DataFrame, versions: DataFrame, raw_customers: DataFrame, run_ts: datetime, policy: str = "contiguous"
) -> tuple[DataFrame, DataFrame]:
    """(open rows, newly closed rows) of a merge; earlier closed versions are neither read nor rewritten.

    ``versions`` gives the highest surrogate used so far.
    """
    changes = scd2_changes(open_versions, raw_customers, **_customer_rules(run_ts, policy))
    return settle_changes(changes, versions, "customer_id", "customer_key")


def type1_changes(dim: DataFrame, rows: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Known keys overwritten in place, others kept, new keys flagged ``_is_new`` and without a surrogate.

    One full outer join; ``rows`` has at most one row a key. A NULL key is a key like any other.
    """
    old = dim.withColumn("_old", F.lit(True)).alias("o")
    new = rows.withColumn("_new", F.lit(True)).alias("n")
    pairs = old.join(new, F.col(f"o.{natural}").eqNullSafe(F.col(f"n.{natural}")), "full_outer")
    kinds = {f.name: f.dataType for f in dim.schema}

    def value(name: str) -> Column:
        if name == surrogate:
            return F.col(f"o.{name}")
        given = F.col(f"n.{name}").cast(kinds[name])
        return F.when(F.col("_new"), given).otherwise(F.col(f"o.{name}")).alias(name)

    return pairs.select(*[value(c) for c in dim.columns], F.col("_old").isNull().alias("_is_new"))


def _upsert_dim(dim: DataFrame, rows: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Type 1: known keys are overwritten in place, new keys get the next surrogates.

    The changes are written once to shared scratch; numbering reads that, not the dimension.
    """
    done = staged(type1_changes(dim, rows, natural, surrogate), "dimension")
    highest = done.agg(F.max(surrogate)).first()[0]
    added = number_settled(done.filter("_is_new"), highest, surrogate, [natural])
    return done.filter("NOT _is_new").unionByName(added).select(*dim.columns)


def upsert_dim_location(dim: DataFrame, raw_locations: DataFrame) -> DataFrame:
    rows = raw_locations.select(*[c for c in dim.columns if c != "location_key"])
    return _upsert_dim(dim, rows, "location_id", "location_key")


def resolve_meters(raw_meters: DataFrame, dim_customer: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Meters with the keys of their current customer and their location; either may be NULL."""
    customers = dim_customer.filter("is_current").select("customer_id", "customer_key")
    locations = dim_location.select("location_id", "location_key")
    return (
        raw_meters.join(customers, "customer_id", "left")
        .join(locations, "location_id", "left")
        .select("meter_id", "meter_type", "install_date", "status", "customer_key", "location_key")
    )


def build_dim_meter(
    dim: DataFrame, raw_meters: DataFrame, dim_customer: DataFrame, dim_location: DataFrame
) -> DataFrame:
    rows = resolve_meters(raw_meters, dim_customer, dim_location)
    return _upsert_dim(dim, rows, "meter_id", "meter_key")
