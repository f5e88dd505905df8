"""Rounding that does not depend on the order in which values were added up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOISE_DIGITS = 9


def steady_round(value: Column, digits: int) -> Column:
    """Half-up rounding of a sum or mean; the noise of its last bits is rounded away first."""
    return F.round(F.round(value, NOISE_DIGITS), digits)
