"""Text clean-up and shape tests, all built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(value: Column) -> Column:
    return F.trim(value, F.lit(WHITESPACE))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def looks_like_date(value: Column) -> Column:
    """Prefix test only: ``2024-13-45 junk`` passes."""
    return value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")


def looks_like_number(value: Column) -> Column:
    r"""``5.`` and ``-5`` pass; ``.5``, ``1e3``, ``+5`` and blanks do not. ``\z`` refuses a final newline."""
    return value.rlike(r"^-?[0-9]+\.?[0-9]*\z")


def is_negative_number(value: Column) -> Column:
    """For text that passed :func:`looks_like_number`; holds for any length, and ``-0`` is not negative."""
    return value.startswith("-") & value.rlike("[1-9]")
