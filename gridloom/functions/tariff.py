"""Cost, demand and segment rules."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price per kWh by (tariff type, peak hour); anything else costs DEFAULT_RATE.
TARIFF_RATES: dict[tuple[str, bool], Decimal] = {
    ("residential", True): Decimal("0.28"),
    ("residential", False): Decimal("0.12"),
    ("commercial", True): Decimal("0.22"),
}
DEFAULT_RATE = Decimal("0.10")
# Fixed value: four quarter-hour readings make one hour.
DEMAND_FACTOR = Decimal("4.0")


def tariff_rate(
    tariff_type: Column,
    is_peak: Column,
    rates: Mapping[tuple[str, bool], Decimal] = TARIFF_RATES,
    default: Decimal = DEFAULT_RATE,
) -> Column:
    """Exact, case-sensitive tariff match."""
    hits = [
        F.when((tariff_type == F.lit(name)) & (is_peak == F.lit(peak)), F.lit(rate))
        for (name, peak), rate in rates.items()
    ]
    return F.coalesce(*hits, F.lit(default))


def energy_cost(kwh: Column, rate: Column) -> Column:
    """Fails beyond DECIMAL(10,2), which only a rate above 4 can bring about for a staged reading."""
    return (kwh * rate).cast("decimal(10,2)")


def peak_demand(kwh: Column) -> Column:
    return (kwh * F.lit(DEMAND_FACTOR)).cast("decimal(10,2)")


def demand_fits(kwh: Column) -> Column:
    """Whether the peak demand of a reading can be stored."""
    return (kwh * F.lit(DEMAND_FACTOR)).try_cast("decimal(10,2)").isNotNull()


def customer_segment(tariff_type: Column) -> Column:
    name = F.lower(tariff_type)
    return (
        F.when(name.contains("commercial"), F.lit("commercial"))
        .when(name.contains("industrial"), F.lit("industrial"))
        .otherwise(F.lit("residential"))
    )
