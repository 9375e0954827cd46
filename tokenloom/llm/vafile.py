"""Exact top-k search over vector approximations.

Each block of candidates keeps, per dimension, cells of equal width. A query scans the cells
for bounds of its scores, then reads exact vectors from the highest upper bound down until
no unread one can enter its k best.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import run_starts, whole_groups
from tokenloom.llm.vectors import finite, matrix

CELLS = 16
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4_096
#: Queries whose bounds are held at once, and exact vectors read at once.
SCANNED = 256
READ = 64
#: Up to here sums of products are exact in doubles.
EXACT = float(1 << 53)


def _cells(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest value of each vector's cell, per dimension."""
    low, high = data.min(axis=0), data.max(axis=0)
    wide = np.maximum(1.0, np.ceil((high - low + 1) / CELLS))
    floor = low + np.floor((data - low) / wide) * wide
    return floor, np.minimum(high, floor + wide - 1)


def block_top(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int):
    """``query_id, vec_id, score`` of the k best of one block for each query; vectors hold whole numbers."""
    found_q, found_v, found_s = [], [], []
    most = np.abs(queries).max(initial=0.0) * np.abs(data).max(initial=0.0) * max(1, data.shape[1])
    if most >= EXACT:  # Python's whole numbers have no limit; bounds in doubles would not be sure
        whole = [[int(x) for x in row] for row in data.tolist()]
        for q, own in zip(queries.tolist(), query_ids.tolist()):
            scores = [(-sum(int(x) * y for x, y in zip(q, v)), i) for v, i in zip(whole, ids.tolist()) if i != own]
            for score, i in sorted(scores)[:k]:
                found_q.append(own), found_v.append(i), found_s.append(-score)
        return found_q, found_v, found_s
    floor, ceiling = _cells(data)
    for at in range(0, len(queries), SCANNED):
        part = queries[at : at + SCANNED]
        above, below = np.maximum(part, 0), np.minimum(part, 0)
        upper = above @ ceiling.T + below @ floor.T
        lower = above @ floor.T + below @ ceiling.T
        for row, (q, own) in enumerate(zip(part, query_ids[at : at + SCANNED].tolist())):
            open_to = np.flatnonzero(ids != own)
            sure = lower[row, open_to]
            if len(open_to) > k:
                least = np.partition(sure, len(sure) - k)[len(sure) - k]
                open_to = open_to[upper[row, open_to] >= least]
            open_to = open_to[np.argsort(-upper[row, open_to], kind="stable")]
            best_s, best_v = np.empty(0), np.empty(0, dtype=np.int64)
            for low in range(0, len(open_to), READ):
                if len(best_s) == k and best_s[-1] > upper[row, open_to[low]]:
                    break
                read = open_to[low : low + READ]
                best_s, best_v = np.append(best_s, data[read] @ q), np.append(best_v, ids[read])
                order = np.lexsort((best_v, -best_s))[:k]
                best_s, best_v = best_s[order], best_v[order]
            found_q += [own] * len(best_v)
            found_v += best_v.tolist()
            found_s += [int(x) for x in best_s]
    return found_q, found_v, found_s


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["width", "data_block", "query_block"]
        for table in whole_groups(batches, keys):
            starts = run_starts([table[c].to_numpy() for c in keys])
            out = ([], [], [])
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                part = table.slice(start, end - start)
                asks = part["asks"].to_numpy()
                if not asks.any() or asks.all():
                    continue
                numbers = np.floor(256.0 * matrix(part["vector"], part["width"][0].as_py()))
                ids = part["id"].to_numpy()
                for own, more in zip(out, block_top(numbers[asks], ids[asks], numbers[~asks], ids[~asks], k)):
                    own.extend(more)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["query_id", "vec_id", "score"])

    return run


def top_k(
    rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``rows`` with the highest score for each query.

    Components are floor(256 * x); the score is their inner product; ties go to the smaller
    id. A query's own id is no candidate. Vectors that are null, empty or hold null or
    non-finite components, and rows without id, take no part; vectors of different widths
    do not meet. A query id that occurs in several rows counts once, with any of its vectors.
    Candidates and queries are dealt into blocks by hash, and each block of queries meets
    each block of candidates in one task; only k rows of each leave it.
    """

    def read(table: DataFrame) -> DataFrame:
        numbers = table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        numbers = numbers.where(finite("vector") & F.col("id").isNotNull())
        return numbers.withColumn("width", F.size("vector").cast("long"))

    data, asked = read(rows), read(queries).dropDuplicates(["id"])
    data_blocks = max(1, -(-data.count() // block_rows))
    query_blocks = max(1, -(-asked.count() // block_queries))

    def dealt(table: DataFrame, own: str, n: int, other: str, m: int, asks: bool) -> DataFrame:
        return table.select("id", "vector", "width", F.pmod(F.xxhash64("id"), F.lit(n)).cast("long").alias(own),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other),
                            F.lit(asks).alias("asks"))

    both = dealt(data, "data_block", data_blocks, "query_block", query_blocks, False).unionByName(
        dealt(asked, "query_block", query_blocks, "data_block", data_blocks, True))
    at = ["width", "data_block", "query_block"]
    best = both.repartition(*at).sortWithinPartitions(*at).mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    # At most k rows of a query come from each block of candidates.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
