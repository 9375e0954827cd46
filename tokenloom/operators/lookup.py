"""Joining rows with a table of one row per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to this many values (rows times values per row) a table may be broadcast.
BROADCAST_VALUES = 16_000_000


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    values_per_row: int,
    how: str = "inner",
    broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """``rows`` with the matching row of ``table``, which has each key once; null matches null.

    A table within the limit is broadcast and the rows stay where they are. A larger one
    is joined by a shuffle of both sides; the rows of a hot key are then split over tasks
    by adaptive execution, as the table's side of it is a single row.
    """
    named = table.withColumnRenamed(key, "__key")
    small = table.count() * values_per_row <= broadcast_values
    side = F.broadcast(named) if small else named.hint("merge")
    return rows.join(side, F.col(key).eqNullSafe(F.col("__key")), how).drop("__key")
