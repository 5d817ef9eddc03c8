"""Keep the optimizer from copying a costly expression into the filters above it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """``value`` for use in a projection, computed once per row.

    A filter on a projected column is moved below the projection together with
    a copy of its expression, which is then computed twice. Filters on the
    output of a generator stay above it, so the value is wrapped as a generator
    of exactly one row.
    """
    return F.explode(F.array(value))
