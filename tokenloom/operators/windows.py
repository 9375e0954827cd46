"""Token ids as one stream, its training windows and random batches of them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.positions import starts
from tokenloom.session import stored

# Starts are broadcast up to this batch size, joined by shuffle beyond.
BROADCAST_STARTS = 1_000_000
# Rows with more ids are cut into pieces of this size before they are cut into blocks.
PIECE = 16_384


def default_block(m: int) -> int:
    """Ids per block: small enough to copy cheaply, with at most an eighth repeated."""
    return max(256, 8 * m)


def place_documents(encoded: DataFrame, key: str = "doc_id", ids: str = "ids") -> tuple[DataFrame, int]:
    """Adds ``doc_start``, the stream position of the first id of each row. Also the length."""
    sizes = encoded.select(key, F.coalesce(F.size(ids), F.lit(0)).alias("n_ids"))
    found, total = starts(sizes, key, "n_ids", "doc_start")
    return encoded.select(key, ids, F.coalesce(F.size(ids), F.lit(0)).alias("n_ids")).join(found, key), int(total)


def token_stream(encoded: DataFrame, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``gpos, doc_id, token_id`` with the ids of all rows in key order."""
    placed, _ = place_documents(encoded, key, ids)
    each = placed.select("doc_start", key, F.posexplode(ids).alias("pos", "token_id"))
    return each.select((F.col("doc_start") + F.col("pos")).alias("gpos"), key, "token_id")


def segments_of(placed: DataFrame, m: int, block: int, ids: str) -> DataFrame:
    """``block_no, at, part``: the stream cut into blocks, each with the next m ids repeated.

    A row is cut into slices, not into single ids. A block is block + m ids at most.
    """
    pieces = placed.where("n_ids > 0").select(
        "doc_start", ids, F.explode(F.sequence(F.lit(0), F.floor((F.col("n_ids") - 1) / PIECE))).alias("piece")
    )
    pieces = pieces.select(
        (F.col("doc_start") + F.col("piece") * PIECE).alias("doc_start"),
        F.slice(ids, (F.col("piece") * PIECE + 1).cast("int"), F.lit(PIECE)).alias(ids),
    )
    last = F.col("doc_start") + F.size(ids) - 1
    first_block = F.greatest(F.lit(0), F.floor((F.col("doc_start") - m) / block))
    touched = pieces.select(
        "doc_start", ids, F.explode(F.sequence(first_block, F.floor(last / block))).alias("block_no")
    )
    low = F.greatest(F.lit(0), F.col("block_no") * block - F.col("doc_start"))
    high = F.least(F.size(ids), (F.col("block_no") + 1) * block + m - F.col("doc_start"))
    cut = touched.select(
        "block_no",
        (F.col("doc_start") + low).alias("at"),
        F.slice(F.col(ids), (low + 1).cast("int"), F.greatest(F.lit(0), high - low).cast("int")).alias("part"),
    )
    return cut.where(F.size("part") > 0)


def blocks_of(segments: DataFrame, block: int) -> DataFrame:
    """``block_start, run``: the ids from the block's start on."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "part")))
    return segments.groupBy("block_no").agg(ordered.alias("parts")).select(
        (F.col("block_no") * block).alias("block_start"),
        F.flatten(F.transform("parts", lambda p: p["part"])).alias("run"),
    )


def _window(run, offset, m: int):
    return F.slice(run, (offset + 1).cast("int"), F.lit(m))


def lm_windows(encoded: DataFrame, m: int, block: int | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``start, x, y`` for every start with m + 1 ids: x are m ids, y the same moved by one."""
    placed, _ = place_documents(encoded, key, ids)
    return windows_of(placed, m, block or default_block(m), ids)


def windows_of(placed: DataFrame, m: int, block: int, ids: str) -> DataFrame:
    """All windows of rows with their ``doc_start`` and ``n_ids``."""
    blocks = blocks_of(segments_of(placed, m, block, ids), block)
    n_starts = F.least(F.lit(block), F.size("run") - m)
    starts = blocks.where(n_starts > 0).select(
        "block_start", "run", F.explode(F.sequence(F.lit(0), n_starts - 1)).alias("offset")
    )
    return starts.select(
        (F.col("block_start") + F.col("offset")).alias("start"),
        _window(F.col("run"), F.col("offset"), m).alias("x"),
        _window(F.col("run"), F.col("offset") + 1, m).alias("y"),
    )


def windows_at(
    encoded: DataFrame, samples: DataFrame, m: int, block: int | None = None, key: str = "doc_id", ids: str = "ids",
    broadcast_starts: int = BROADCAST_STARTS,
) -> DataFrame:
    """``sample_id, start, x, y`` for given ``sample_id, start``; starts past the last window give no row."""
    placed, _ = place_documents(encoded, key, ids)
    return windows_from(placed, samples, m, block or default_block(m), ids, broadcast_starts)


def windows_from(placed: DataFrame, samples: DataFrame, m: int, block: int, ids: str, broadcast_starts: int = BROADCAST_STARTS) -> DataFrame:
    """The windows at given starts of rows with their ``doc_start`` and ``n_ids``."""
    wanted = stored(samples.withColumn("block_no", F.floor(F.col("start") / block)), "starts")
    bounded = wanted.count() <= broadcast_starts
    # Only blocks that hold a start are put together.
    needed = wanted.select("block_no").distinct()
    segments = segments_of(placed, m, block, ids).join(F.broadcast(needed) if bounded else needed, "block_no", "left_semi")
    blocks = blocks_of(segments, block).withColumn("block_no", F.floor(F.col("block_start") / block))
    found = blocks.join(F.broadcast(wanted) if bounded else wanted, "block_no")
    offset = F.col("start") - F.col("block_start")
    return found.where(offset + m < F.size("run")).select(
        "sample_id",
        "start",
        _window(F.col("run"), offset, m).alias("x"),
        _window(F.col("run"), offset + 1, m).alias("y"),
    )


def lm_batch(
    encoded: DataFrame, batch_size: int, m: int, seed: int, block: int | None = None, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """``sample_id, start, x, y``: starts drawn uniformly and independently, with replacement.

    A start is a hash of seed and sample number, so a repeated task draws the same ones.
    """
    placed, total = place_documents(encoded, key, ids)
    if total <= m:
        raise ValueError(f"a stream of {total} ids has no window of {m}")
    return windows_from(placed, draws(encoded.sparkSession, batch_size, total - m, seed), m, block or default_block(m), ids)


def draws(spark: SparkSession, batch_size: int, n_starts: int, seed: int) -> DataFrame:
    """``sample_id, start``."""
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(n_starts))
    return spark.range(batch_size).select(F.col("id").alias("sample_id"), start.alias("start"))
