"""Reading vector columns in Arrow batches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is not null, not empty and holds finite numbers only."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(~odd, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of one width without nulls as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
