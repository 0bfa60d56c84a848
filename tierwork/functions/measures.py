"""Counts, shares and status words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The status words of a check.
PASS = "PASS"
WARNING = "WARNING"
FAIL = "FAIL"
INFO = "INFO"


def percentage(part: Column, total: Column) -> Column:
    """``part`` of ``total`` in percent, two decimals; 0.0 when there is nothing to divide by."""
    share = F.try_divide(part.cast("double"), total.cast("double"))
    return F.coalesce(F.round(share * 100, 2), F.lit(0.0))


def percentage_text(part: Column, total: Column) -> Column:
    return F.concat(percentage(part, total).cast("string"), F.lit("%"))


def status(found: Column, when_found: str) -> Column:
    """``when_found`` if anything was found, else PASS."""
    return F.when(found > 0, F.lit(when_found)).otherwise(F.lit(PASS))
