"""Embedding rows as vectors of whole numbers, the form in which the vector operators compare and add exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest whole number of a component; with it squared distances and sums stay within 64 bits.
MOST = 1 << 24


def finite(vector: str) -> Column:
    """Whether there is a vector without null, infinite or undefined components."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component; one beyond ``MOST`` is an error, as its squares would not fit."""

    def number(x: Column) -> Column:
        n = F.lit(float(scale)) * x.cast("double")
        told = F.raise_error(F.concat(F.lit(f"a component times {scale} is beyond {MOST}: "), x.cast("string"))).cast("bigint")
        return F.when(F.abs(n) <= MOST, F.floor(n)).otherwise(told)

    return F.transform(vector, number)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
