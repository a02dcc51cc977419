"""Embedding columns as numpy arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Whether a vector takes part in comparisons: not null or zero, all components finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def lengths(vectors: DataFrame) -> list[int]:
    """The different numbers of components; vectors of different length are never compared."""
    found = sorted(r[0] for r in vectors.select(F.size("embedding").alias("n")).distinct().limit(65).collect())
    if len(found) > 64:
        raise ValueError("embeddings have more than 64 different lengths")
    return found


def matrix(column, dim: int):
    """Rows of a pandas column of arrays, in double precision."""
    import numpy as np

    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), dim)


def packed(values) -> list[bytes]:
    return [row.tobytes() for row in values]


def unpacked(column, dim: int, dtype: str = "f8"):
    import numpy as np

    return np.frombuffer(b"".join(column), dtype=dtype).reshape(len(column), dim)


def units(values):
    """Vectors of length 1; scaled first, so that no square is lost or overflows."""
    import numpy as np

    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a, b):
    """Cosines of rows of two equally long arrays of units; the same for a pair wherever it stands."""
    return (a * b).sum(axis=1)
