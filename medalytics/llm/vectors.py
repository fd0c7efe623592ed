"""Vectors as columns: which ones count, and Arrow lists as matrices."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector that is not null, not empty, not zero, and has finite numbers only."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """An Arrow column of lists of one length as a matrix of doubles."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def blocks_of(count: int, size: int) -> int:
    return max(1, -(-count // size))


def block(ident: str, count, seed: int = 0) -> Column:
    """Block number of a row in [0, count)."""
    return F.pmod(F.xxhash64(F.col(ident), F.lit(seed)), count if isinstance(count, Column) else F.lit(count)).cast("int")


def spread(df: DataFrame, name: str, count) -> DataFrame:
    """Repeat every row for each block number in [0, count)."""
    last = count - 1 if isinstance(count, Column) else F.lit(count - 1)
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), last.cast("int"))))
