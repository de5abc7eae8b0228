"""Vectors of a table: which take part, and their bytes for work inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def takes_part(embedding: Column) -> Column:
    """False for null, empty and zero vectors and those with null or non-finite components."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(embedding, lambda x: x != 0)
    return F.coalesce(~bad & ~zero, F.lit(False))


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part, repeated rows once, of
    the commonest length (ties: the longer)."""
    good = rows.filter(F.col("vec_id").isNotNull() & takes_part(F.col("embedding")))
    sizes = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    good = good.filter(F.size("embedding") == (sizes.n if sizes else 0))
    return good.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")).distinct()


def matrix(column) -> np.ndarray:
    """Arrow lists of one length as a matrix."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def stacked(column) -> np.ndarray:
    """Arrow binaries of one length, each the doubles of a vector, as a matrix."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.float64).reshape(len(parts), -1)
