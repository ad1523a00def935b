"""Expressions that are computed once for a row, also where lambdas use them many times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value), with value bound as a lambda variable, which the optimizer doesn't copy into the lambdas of body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
