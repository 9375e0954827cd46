"""Near-duplicate vectors by binary codes of a random rotation with correction factors.

A unit vector is rotated at random and kept as the signs of its components, that is as the
nearest corner of a cube. The stored factor, its inner product with that corner, turns the
product of another vector with the corner into an unbiased estimate of the cosine, with an
error bound. Only pairs whose bound reaches the threshold are computed from the vectors.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Forest, gathered, run_starts, stored, tiled, whole_groups
from tokenloom.llm.components import components
from tokenloom.llm.vectors import finite, matrix

THRESHOLD = 0.98
#: Rotations at least, bits of a code by which pairs meet, and bands at least. Each rotation gives width / BAND_BITS bands.
ROTATIONS = 4
BAND_BITS = 16
BANDS = 16
#: Standard deviations that the error bound of an estimate covers.
CONFIDENCE = 4.0
SEED = 20_260
TILE_ROWS = 1024
COMPARED = 256
#: Pairs computed exactly at once.
CHECKED = 16_384


def rotation(width: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    normal = np.random.default_rng([SEED, width, number]).standard_normal((width, width))
    q, r = np.linalg.qr(normal)
    return q * np.sign(np.diag(r))


def turns_of(width: int) -> int:
    """As many rotations as give BANDS bands."""
    return max(ROTATIONS, -(-BANDS // (width // min(BAND_BITS, width))))


def rotations(width: int, known: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """All rotations of a width, made once for what ``known`` belongs to."""
    if width not in known:
        known[width] = [rotation(width, number) for number in range(turns_of(width))]
    return known[width]


def _bands(unit: np.ndarray, turns: list[np.ndarray]) -> np.ndarray:
    """Parts of the sign codes under each rotation: vectors with a large cosine agree in one at least."""
    width = unit.shape[1]
    bits = min(BAND_BITS, width)
    weights = 1 << np.arange(bits, dtype=np.int64)
    found = []
    for turn in turns:
        signs = (unit @ turn) > 0
        for low in range(0, width - bits + 1, bits):
            found.append(signs[:, low : low + bits] @ weights)
    return np.stack(found, axis=1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        ids, groups, widths = (batch.column(i).to_numpy() for i in range(3))
        for width in np.unique(widths).tolist():
            chosen = np.flatnonzero(widths == width)
            bands = _bands(_unit(matrix(batch.column(3).take(pa.array(chosen)), width)), rotations(width, known))
            n, each = bands.shape
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(ids[chosen], each)),
                pa.array(np.repeat(groups[chosen], each)),
                pa.array(np.repeat(widths[chosen], each)),
                pa.array(np.tile(np.arange(each, dtype=np.int32), n)),
                pa.array(bands.ravel()),
            ], ["id", "label", "width", "band", "code"])


def _estimates(rotated: np.ndarray, side: slice, rest: slice) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines between the rows of two slices, and their error bounds."""
    width = rotated.shape[1]
    corner = np.where(rotated[rest] > 0, 1.0, -1.0) / np.sqrt(width)
    factor = (corner * rotated[rest]).sum(axis=1)
    bound = CONFIDENCE * np.sqrt(np.maximum(0.0, 1 - factor**2)) / factor / np.sqrt(max(1, width - 1))
    return (rotated[side] @ corner.T) / factor, bound


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``a, b, n``: with b null, a has n more links; else a and b are connected."""
    keys = ["label", "width", "band", "code", "left_part", "right_part"]
    known: dict[int, list[np.ndarray]] = {}
    for table in whole_groups(batches, keys):
        starts = run_starts([table[k].to_numpy() for k in keys])
        ends = np.append(starts[1:], table.num_rows)
        ids, copies, parts = (table[k].to_numpy() for k in ("id", "copies", "part"))
        widths, band = table["width"].to_numpy(), table["band"].to_numpy()
        across = table["left_part"].to_numpy() != table["right_part"].to_numpy()
        vectors = table["vector"].combine_chunks()
        a, b, n = [], [], []
        for start, end in zip(starts.tolist(), ends.tolist()):
            if end - start < 2:
                continue
            exact = matrix(vectors.slice(start, end - start), int(widths[start]))
            unit = _unit(exact)
            turns = rotations(unit.shape[1], known)
            bands, rotated = _bands(unit, turns), unit @ turns[0]
            earlier, forest = int(band[start]), Forest(end - start)
            own, side = copies[start:end], parts[start:end]
            links = np.zeros(end - start, dtype=np.int64)
            for low in range(0, end - start, COMPARED):
                rows = slice(low, min(low + COMPARED, end - start))
                estimate, bound = _estimates(rotated, rows, slice(low, end - start))
                i, j = np.nonzero(np.triu(estimate + bound >= THRESHOLD, 1))
                if across[start]:
                    keep = side[i + low] != side[j + low]
                    i, j = i[keep], j[keep]
                i, j = i + low, j + low
                for at in range(0, len(i), CHECKED):
                    x, y = i[at : at + CHECKED], j[at : at + CHECKED]
                    # A pair counts in the first band it shares, and only if its exact cosine says so.
                    first = ~(bands[x, :earlier] == bands[y, :earlier]).any(axis=1)
                    x, y = x[first], y[first]
                    sure = np.einsum("ij,ij->i", unit[x], unit[y]) >= THRESHOLD
                    x, y = x[sure], y[sure]
                    np.add.at(links, x, own[y])
                    np.add.at(links, y, own[x])
                    for one, other in zip(x.tolist(), y.tolist()):
                        if forest.join(one, other):
                            a.append(ids[start + one])
                            b.append(ids[start + other])
                            n.append(0)
            linked = np.flatnonzero(links)
            a += ids[start + linked].tolist()
            b += [None] * len(linked)
            n += links[linked].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])


def near_duplicate_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``key, n_links, component_id, kept`` for each row: links to rows of the same label with a cosine of THRESHOLD.

    Equal vectors of a label are one class whose size counts in ``n_links``; classes meet in
    bands of their codes and large groups are cut into tiles. Null, zero and non-finite
    vectors, rows with a null label or id, and vectors of different widths link with
    nothing. A repeated row counts as another vector.
    """
    numbers = rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    some = F.exists("vector", lambda x: x != 0.0)
    able = finite("vector") & some & F.col("label").isNotNull() & F.col("id").isNotNull()
    # Rows that can't link are left out of the class join, not sent to one task of a null key.
    good = numbers.where(able)
    classes = stored(
        good.groupBy("label", "vector").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "classes")
    by_id = classes.select(F.col("first_id").alias("id"), "label", F.size("vector").cast("long").alias("width"),
                           "vector", "copies")
    bands = by_id.select("id", "label", "width", "vector").mapInArrow(
        _band_rows, "id bigint, label bigint, width bigint, band int, code bigint")
    at = ["label", "width", "band", "code"]
    tiles = tiled(bands, at, F.xxhash64("id"), TILE_ROWS).join(by_id.select("id", "vector", "copies"), "id")
    found = stored(gathered(tiles, at, ["part"]).mapInArrow(_tile_links, "a bigint, b bigint, n bigint"), "vector-links")
    more = found.where("b is null").groupBy(F.col("a").alias("first_id")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "first_id")
    known = classes.join(more, "first_id", "left").join(roots, "first_id", "left").select(
        "label", "vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("root", "first_id").alias("component_id"))
    linked = good.join(known, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = numbers.where(~able).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(key), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
