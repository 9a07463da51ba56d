"""Vectors as rows of whole numbers.

A row takes part when it has a vector of finite components, of the length of
the vector with the least ``vec_id`` among such rows. ``floor(scale * x)`` is
cut to +-``LIMIT``, so that sums of products of up to 2048 components are exact
in floating point.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 21


def usable(rows: DataFrame, parts: int = 1) -> DataFrame:
    """``vec_id, label, vector`` (array of double) of the rows that take part; the
    length of their vectors is a multiple of ``parts``."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = rows.select("vec_id", "label", vector.alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0) & finite)
    first = F.struct(F.col("vec_id").isNull(), F.col("vec_id"), F.size("vector"))
    length = found.agg(F.min_by(F.size("vector"), first)).first()[0]
    return found.where(F.size("vector") == F.lit(length or 0))


def matrix(column, scale: int) -> np.ndarray:
    """Whole numbers (as float64) of an Arrow column of equally long vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(column):
        return np.zeros((0, 0))
    return np.clip(np.floor(flat * float(scale)), -LIMIT, LIMIT).reshape(len(column), -1)
