"""Integer vectors of an embeddings table, packed into blocks of bounded size."""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest absolute value of a component: products of a few thousand of them then fit 64 bits.
LARGEST = 1 << 25


def usable(vector: str = "embedding") -> Column:
    """True where the vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def integers(scale: int, vector: str = "embedding") -> Column:
    """floor(scale * x) of every component, with x as double; a component beyond LARGEST is an error."""
    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * float(scale))
        return F.when(F.abs(y) <= LARGEST, y).otherwise(F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("long"))

    return F.transform(vector, whole)


def matrix_of(lists, width: int) -> np.ndarray:
    """Rows of integers as an array of ``width`` columns; shorter rows are filled up with zeros."""
    out = np.zeros((len(lists), width), dtype=np.int32)
    for k, row in enumerate(lists):
        out[k, :len(row)] = row
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T as 64-bit integers, by floating point where no sum can reach 2 ** 53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    top = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if top < 1 << 53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def squares(a: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) ** 2).sum(axis=1)
