"""Scoring operators over tables of vectors and logits."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions import arrays as ar
from tokenloom.operators.lookup import BROADCAST_VALUES, lookup_join
from tokenloom.operators.positions import count_below, starts
from tokenloom.session import stored


def embedding_lookup(
    sequences: DataFrame,
    vectors: DataFrame,
    width: int,
    key: str = "doc_id",
    ids: str = "ids",
    vec_id: str = "vec_id",
    vector: str = "embedding",
    broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """``key, pos, token_id, vector`` for each id of each sequence; an id without vector is an error."""
    each = sequences.select(key, F.posexplode(ids).alias("pos", "token_id"))
    table = vectors.select(F.col(vec_id).cast("int").alias("token_id"), F.col(vector).alias("vector"))
    found = lookup_join(each, table, "token_id", width, "left", broadcast_values)
    checked = F.coalesce(F.col("vector"), F.raise_error(F.lit("id without a vector")))
    return found.select(key, "pos", "token_id", checked.alias("vector"))


def _rows_of(lists: pa.ListArray, width: int) -> np.ndarray:
    """The lists that are not null, as rows; one of another width or with a null in it is an error."""
    lengths = lists.value_lengths().drop_null().to_numpy(zero_copy_only=False)
    if (lengths != width).any():
        raise ValueError(f"a vector of width {lengths[lengths != width][0]} instead of {width}")
    flat = lists.flatten()
    if flat.null_count:
        raise ValueError("a vector holds a null")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _lists_of(matrix: np.ndarray, missing: pa.Array | None = None) -> pa.ListArray:
    """Rows as lists; ``missing`` tells where null lists stand between them."""
    n, width = matrix.shape
    if missing is None or not missing.true_count:
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.reshape(-1)))
    sizes = np.where(missing.to_numpy(zero_copy_only=False), 0, width)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)), mask=missing)


def _project_with(weights: np.ndarray):
    @F.arrow_udf("array<double>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield _lists_of(_rows_of(vectors, weights.shape[1]) @ weights.T, vectors.is_null())

    return project


def vector_project(
    rows: DataFrame,
    weights: DataFrame,
    width: int,
    vector: str = "embedding",
    out: str = "projected",
    row_no: str = "row_no",
    weight: str = "weights",
    block_values: int = BROADCAST_VALUES,
    block_rows: int = 8192,
) -> DataFrame:
    """Adds ``out = W x`` for a weight table of one row ``row_no, weights`` per output; null stays null.

    A matrix of up to ``block_values`` values goes to the tasks and the vectors stay where
    they are. A larger one stays a table: blocks of its rows meet blocks of vectors, one
    product per task, and the parts of a vector's result are put together by its row.
    """
    n_outputs = weights.count()
    if n_outputs * width <= block_values:
        matrix = [r[0] for r in weights.orderBy(row_no).select(weight).collect()]
        if any(len(r) != width for r in matrix):
            raise ValueError(f"weights of another width than {width}")
        if not matrix:
            return rows.withColumn(out, F.when(F.col(vector).isNotNull(), F.array().cast("array<double>")))
        return rows.withColumn(out, _project_with(np.array(matrix, dtype=np.float64))(F.col(vector)))
    return _project_by_blocks(rows, weights, width, vector, out, row_no, weight, max(1, block_values // width), block_rows)


def _project_by_blocks(rows, weights, width, vector, out, row_no, weight, per_block, block_rows) -> DataFrame:
    ranks, n_outputs = starts(weights.select(row_no, F.lit(1).alias("one")), row_no, "one", "place")
    blocks = -(-n_outputs // per_block)
    base = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "project")
    parts = max(1, -(-base.count() // block_rows))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = base.where(F.col(vector).isNotNull()).select(
        "__row", F.col(vector).alias("x"), F.pmod(F.xxhash64("__row"), F.lit(parts)).cast("int").alias("part"), each(blocks).alias("block"))
    right = weights.join(ranks, row_no).select(
        F.floor(F.col("place") / per_block).cast("int").alias("of_block"), "place", F.col(weight).alias("w"), each(parts).alias("of_part"))

    def multiply(cell: tuple, vectors: pa.Table, own: pa.Table) -> pa.Table:
        own = own.sort_by("place")
        x, w = (_rows_of(t.column(c).combine_chunks(), width) for t, c in ((vectors, "x"), (own, "w")))
        return pa.table({"__row": vectors.column("__row"), "block": pa.array([cell[0].as_py()] * len(x), pa.int32()),
                         "values": _lists_of(x @ w.T)})

    cells = left.groupBy("block", "part").cogroup(right.groupBy("of_block", "of_part"))
    done = cells.applyInArrow(multiply, "__row bigint, block int, values array<double>")
    # One part per block of outputs, so the list is as long as the result is made of blocks.
    whole = done.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("block", "values"))).alias("parts"))
    whole = whole.select("__row", F.flatten(F.transform("parts", lambda p: p["values"])).alias(out))
    return base.drop(out).join(whole, "__row", "left").drop("__row")


def rms_normalize(
    rows: DataFrame, vector: str = "embedding", gain: list[float] | None = None, eps: float = 1e-5, out: str = "normalized"
) -> DataFrame:
    return rows.withColumn(out, ar.rms_normalized(F.col(vector), gain, eps))


def group_softmax(
    rows: DataFrame, group: str, score: str, out: str = "p", broadcast_values: int = BROADCAST_VALUES
) -> DataFrame:
    """Adds the softmax of ``score`` over all rows of the same group; null is a group like any other.

    Two aggregations give each group's maximum and sum of exponentials; both combine
    map-side, so a group of any size is never gathered in one task.
    """
    scored = rows.withColumn("score_value", F.col(score).cast("double"))
    tops = stored(scored.groupBy(group).agg(F.max("score_value").alias("top")), "softmax")
    slim = scored.select(group, "score_value")
    shifted = lookup_join(slim, tops, group, 1, broadcast_values=broadcast_values)
    sums = shifted.groupBy(group).agg(
        F.first("top").alias("top"), F.sum(F.exp(F.col("score_value") - F.col("top"))).alias("denominator")
    )
    found = lookup_join(scored, stored(sums, "softmax"), group, 2, broadcast_values=broadcast_values)
    weight = F.exp(F.col("score_value") - F.col("top")) / F.col("denominator")
    return found.withColumn(out, weight).drop("score_value", "top", "denominator")


PARTIAL = "batch {0}, q_id bigint, k_block int, top double, mass double, pooled array<double>"
#: Partial results of a query that are put together at once.
MERGED = 64

Mask = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _merged(partials: DataFrame) -> DataFrame:
    """Partials of MERGED neighbouring key blocks as one: on a common maximum and added, in a fixed order."""
    grouped = partials.groupBy("batch", "q_id", F.floor(F.col("k_block") / MERGED).cast("int").alias("k_block")).agg(
        F.max("top").alias("top"), F.array_sort(F.collect_list(F.struct(F.col("k_block").alias("no"), F.col("top").alias("own"), "mass", "pooled"))).alias("parts"))
    factor = lambda p: F.exp(p["own"] - F.col("top"))
    mass = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["mass"] * factor(p))
    zero = F.transform(F.get("parts", F.lit(0))["pooled"], lambda x: F.lit(0.0))
    pooled = F.aggregate("parts", zero, lambda acc, p: F.zip_with(acc, p["pooled"], lambda a, b: a + b * factor(p)))
    return grouped.select("batch", "q_id", "k_block", "top", mass.alias("mass"), pooled.alias("pooled"))


def _met(q_side: DataFrame, k_side: DataFrame):
    """Both sides by batch and pair of blocks. Other names on one side, as both may come from one table."""
    at = ["batch", "q_block", "k_block"]
    named = k_side.select(*(F.col(c).alias(f"of_{c}") for c in at), *(c for c in k_side.columns if c not in at))
    return q_side.groupBy(*at).cogroup(named.groupBy(*(f"of_{c}" for c in at)))


def _pooled(cells, width: int, mask: Mask | None, batch_type: str, most_blocks: int) -> DataFrame:
    """Cells of query and key blocks to ``batch, q_id, pooled``."""
    scale = float(width) ** 0.5

    def partial(cell: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            q, k = (_rows_of(t.column(n).combine_chunks(), width) for t, n in ((left, "q"), (right, "k")))
            v = right.column("v").combine_chunks()
            v = _rows_of(v, v.value_lengths()[0].as_py())
            q_ids, k_ids = left.column("q_id").to_numpy(), right.column("k_id").to_numpy()
            if len(np.unique(q_ids)) < len(q_ids):
                raise ValueError(f"a query id occurs twice in batch {cell[0]}")
            scores = (q @ k.T) / scale
            allowed = np.ones(scores.shape, dtype=bool) if mask is None else mask(q_ids[:, None], k_ids[None, :])
            seen = allowed.any(axis=1)
            scores = np.where(allowed, scores, -np.inf)[seen]
            top = scores.max(axis=1) if len(scores) else np.zeros(0)
            with np.errstate(invalid="ignore"):
                weights = np.exp(scores - top[:, None])
            q_ids, mass, pooled = q_ids[seen], weights.sum(axis=1), weights @ v
        else:
            q_ids, top, mass, pooled = np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros((0, 1))
        n = len(q_ids)
        return pa.table({
            "batch": pa.array([cell[0].as_py()] * n, cell[0].type), "q_id": pa.array(q_ids, pa.int64()),
            "k_block": pa.array([cell[2].as_py()] * n, pa.int32()), "top": pa.array(top, pa.float64()),
            "mass": pa.array(mass, pa.float64()), "pooled": _lists_of(pooled)})

    partials = cells.applyInArrow(partial, PARTIAL.format(batch_type))
    while True:
        partials = _merged(partials)
        if most_blocks <= MERGED:
            break
        most_blocks = -(-most_blocks // MERGED)
    return partials.select("batch", "q_id", F.transform("pooled", lambda x: x / F.col("mass")).alias("pooled"))


def attention_pool(queries: DataFrame, keys: DataFrame, width: int, mask: Mask | None = None, block: int = 2048) -> DataFrame:
    """``batch, q_id, pooled``: for each query the softmax-weighted mean of the values.

    ``queries`` has ``batch, q_id, q``; ``keys`` has ``batch, k_id, k, v``. Weights are
    ``softmax(q.k / sqrt(width))`` over the keys of the same batch that
    ``mask(q_ids[:, None], k_ids[None, :])`` allows; a query without any gives no row.
    Null vectors take no part, a NaN score gives NaN, a query id twice in a batch is an error.

    Pairs are never rows. Both sides are cut into blocks of about ``block`` rows by a
    hash, each pair of blocks is one matrix product, and a query gets one partial result
    (maximum, sum of weights, weighted sum) per key block. So a batch of any size is
    spread over many tasks, each holding two blocks, and partials are merged in steps.
    """
    queries = queries.where("q is not null").withColumn("q_id", F.col("q_id").cast("long"))
    keys = keys.where("k is not null and v is not null").withColumn("k_id", F.col("k_id").cast("long"))
    sizes = queries.select("batch", F.lit(1).alias("q"), F.lit(0).alias("k")).unionByName(
        keys.select("batch", F.lit(0).alias("q"), F.lit(1).alias("k")))
    n_blocks = stored(sizes.groupBy("batch").agg(*(F.ceil(F.sum(s) / block).cast("int").alias(f"{s}_blocks") for s in "qk")), "blocks")
    most = n_blocks.agg(F.coalesce(F.max("k_blocks"), F.lit(0))).first()[0]
    n_blocks = n_blocks.where("q_blocks > 0 and k_blocks > 0").withColumnRenamed("batch", "of_batch")

    def dealt(rows: DataFrame, row_id: str, own: str, other: str) -> DataFrame:
        found = rows.join(n_blocks, F.col("batch").eqNullSafe(F.col("of_batch"))).drop("of_batch")
        placed = found.withColumn(f"{own}_block", F.pmod(F.xxhash64(row_id), F.col(f"{own}_blocks")).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        return placed.withColumn(f"{other}_block", every).drop("q_blocks", "k_blocks")

    cells = _met(dealt(queries, "q_id", "q", "k"), dealt(keys, "k_id", "k", "q"))
    return _pooled(cells, width, mask, queries.schema["batch"].dataType.simpleString(), most)


def causal_pool(
    rows: DataFrame, width: int, batch: str, position: str, vector: str = "embedding", block: int = 2048
) -> DataFrame:
    """``batch, q_id, pooled`` where a row sees the rows of its sequence up to its own position.

    Blocks are ranges of positions, so pairs of blocks with later keys are never made.
    Null vectors and null positions take no part.
    """
    slim = rows.where(F.col(vector).isNotNull() & F.col(position).isNotNull()).select(
        F.col(batch).alias("batch"), F.col(position).cast("long").alias("at"), F.col(vector).alias("x"))
    # Quantiles over all sequences give fine ranges; a sequence's block is a run of them with about ``block`` rows.
    n_rows = slim.count()
    fine = min(10_000, max(1, -(-4 * n_rows // block)))
    cuts = slim.agg(F.percentile_approx("at", [i / fine for i in range(1, fine)], F.lit(20 * fine))).first()[0] if fine > 1 else []
    bounds = sorted(set(cuts or []))
    slim = slim.withColumn("range", count_below(F.lit(bounds), len(bounds), F.col("at")))
    before = Window.partitionBy("batch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sequence and range, not per row.
    ranges = slim.groupBy("batch", "range").agg(F.count(F.lit(1)).alias("n"))
    ranges = ranges.withColumn("block_no", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / block).cast("int"))
    last = F.max("block_no").over(Window.partitionBy("batch"))
    ranges = stored(ranges.select(F.col("batch").alias("of_batch"), F.col("range").alias("of_range"), "block_no", last.alias("last")), "ranges")
    most = ranges.agg(F.coalesce(F.max("last"), F.lit(-1))).first()[0] + 1
    placed = slim.join(ranges, F.col("batch").eqNullSafe(F.col("of_batch")) & (F.col("range") == F.col("of_range")))
    q_side = placed.select("batch", F.col("block_no").alias("q_block"), F.explode(F.sequence(F.lit(0), "block_no")).alias("k_block"),
                           F.col("at").alias("q_id"), F.col("x").alias("q"))
    k_side = placed.select("batch", F.explode(F.sequence("block_no", "last")).alias("q_block"), F.col("block_no").alias("k_block"),
                           F.col("at").alias("k_id"), F.col("x").alias("k"), F.col("x").alias("v"))
    return _pooled(_met(q_side, k_side), width, lambda q, k: k <= q, slim.schema["batch"].dataType.simpleString(), most)


def cross_entropy(rows: DataFrame, logits: Column, target: Column) -> DataFrame:
    """``loss, n_rows``: mean of ``logsumexp(logits) - logits[target]``, safe for large logits."""
    at_target = F.get(ar.doubles(logits), target.cast("int"))
    checked = F.coalesce(at_target, F.raise_error(F.lit("target outside the logits")).cast("double"))
    return rows.agg(F.avg(ar.log_sum_exp(logits) - checked).alias("loss"), F.count(F.lit(1)).alias("n_rows"))


def clip_l2_norm(rows: DataFrame, max_norm: float, vector: str = "embedding", out: str = "clipped") -> DataFrame:
    """Scales all vectors by ``max_norm / (norm + 1e-6)`` if below 1; the norm is over all rows.

    Rows without a vector stay without one.
    """
    squares = rows.agg(F.coalesce(F.sum(ar.sum_of_squares(F.col(vector))), F.lit(0.0)).alias("squares"))
    rows = rows.withColumn("scale", F.least(F.lit(1.0), F.lit(max_norm) / (F.sqrt(squares.scalar()) + F.lit(1e-6))))
    return rows.withColumn(out, F.transform(ar.doubles(F.col(vector)), lambda x: x * F.col("scale"))).drop("scale")
