"""Running positions over a whole table without a single-task window."""

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.session import stored


def count_below(bounds: Column, n: int, value: Column) -> Column:
    """How many of the ``n`` sorted bounds are smaller than the value, by halving steps."""
    if not n:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(n.bit_length()))]

    def step_up(found: Column, step: Column) -> Column:
        return F.when(F.get(bounds, found + step - 1) < value, found + step).otherwise(found)

    return F.aggregate(F.lit(steps), F.lit(0), step_up)


def starts(sizes: DataFrame, key: str, size: str, into: str, buckets: int | None = None) -> tuple[DataFrame, int]:
    """``key, into``: the sum of ``size`` over all rows with a smaller key. Also the total.

    Only keys and sizes are stored, shuffled and sorted; what belongs to a key is joined
    where it is needed. The key must be a number, and a key that is null or occurs twice is
    an error. Its quantiles cut the rows into buckets of about equal size whatever the keys
    look like. Sums run inside the buckets; the bucket totals - one row per bucket - are put
    in front.
    """
    rows = stored(sizes.select(key, F.col(size).cast("long").alias("own_size")), "sizes")
    if buckets is None:
        buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / buckets for i in range(1, buckets)]
    summary = rows.agg(
        F.percentile_approx(key, cuts, F.lit(20 * buckets)).alias("bounds") if cuts else F.array().alias("bounds"),
        F.coalesce(F.sum("own_size"), F.lit(0)).alias("total"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("nulls"),
    ).first()
    if summary["nulls"]:
        raise ValueError(f"{summary['nulls']} rows without a {key}")
    bounds = sorted(set(summary["bounds"] or []))
    bucketed = rows.withColumn("bucket", count_below(F.lit(bounds), len(bounds), F.col(key)))

    # One row per bucket, as many as there are shuffle partitions at most, whatever the input.
    sums = {r.bucket: r.n for r in bucketed.groupBy("bucket").agg(F.sum("own_size").alias("n")).collect()}
    offsets = [0, *accumulate(sums.get(bucket) or 0 for bucket in range(len(bounds)))]

    ordered = Window.partitionBy("bucket").orderBy(key)
    local = bucketed.withColumn(into, F.coalesce(F.sum("own_size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # Equal keys fall into one bucket, side by side.
    twice = F.lag(key).over(ordered) == F.col(key)
    unique = F.when(twice, F.raise_error(F.concat(F.lit(f"{key} occurs twice: "), F.col(key).cast("string")))).otherwise(F.col(into))
    placed = local.withColumn(into, unique.cast("long"))
    return placed.select(key, (F.col(into) + F.get(F.lit(offsets).cast("array<bigint>"), F.col("bucket"))).alias(into)), summary["total"]
