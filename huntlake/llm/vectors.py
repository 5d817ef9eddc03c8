"""Vectors as integers: which rows take part, exact scaling, batches as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scaled components beyond this could let a squared distance leave 64 bits.
MOST = 1 << 27


def finite(vector: Column) -> Column:
    """Whether a vector is there and every component is a finite number; true for an empty one."""
    components = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(components, F.lit(False))


def integers(vector: Column, scale: int, most: int = MOST) -> Column:
    """floor(scale * x) of each component, x as double; raises at ``most`` and beyond, rather than be inexact."""

    def scaled(x: Column) -> Column:
        floor = F.floor(F.lit(float(scale)) * x.cast("double"))
        far = F.raise_error(F.lit(f"a component times {scale} is beyond {most}"))
        return F.when(F.abs(x.cast("double")) * F.lit(float(scale)) < F.lit(float(most)), floor).otherwise(far).cast("int")

    return F.transform(vector, scaled)


def matrix(column: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    """The lists of a column, NULL ones left out, as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def floor_mean(total: int, count: int) -> int:
    return int(total) // int(count)
