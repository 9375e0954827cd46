"""Near duplicates by SimHash: fingerprints of word shingles, linked within a few bits."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Forest, as_bytes, gathered, run_starts, stored, tiled, whole_groups
from tokenloom.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
#: A fingerprint is cut into so many blocks; pairs within DISTANCE bits agree in SHARED of them.
BLOCKS = 5
SHARED = BLOCKS - DISTANCE
TILE_ROWS = 4096
#: Shingles whose bits are counted at once.
COUNTED = 1 << 15
COMPARED = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number.

    Words are runs of bytes other than ASCII white space, with A-Z in lower case. A bit is 1
    if it is set in over half of the shingle hashes. No word gives zero.
    """
    words = as_bytes(text).lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = iter([b" ".join(words)])
        n = 1
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    counts = np.zeros(BITS, dtype=np.int64)
    digest, left = xxhash.xxh64_intdigest, n
    while left:
        take = min(left, COUNTED)
        hashes = np.fromiter((digest(next(parts), SEED) for _ in range(take)), dtype="<u8", count=take)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(take, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        left -= take
    packed = np.packbits(2 * counts > n, bitorder="little")
    return int(packed.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.int64)
        # Further columns go along.
        names = ["id", "print", *batch.schema.names[2:]]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), *batch.columns[2:]], names)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, print``: one row per row of ``docs``."""
    return docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(
        _fingerprints, "id bigint, print bigint")


def _block_masks() -> list[int]:
    """A mask for each choice of SHARED blocks, as signed 64-bit numbers."""
    bounds = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    blocks = [((1 << bounds[i + 1]) - 1) ^ ((1 << bounds[i]) - 1) for i in range(BLOCKS)]
    masks = [sum(chosen) for chosen in combinations(blocks, SHARED)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _close_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each tile, links that connect what its close pairs connect: fewer than its rows."""
    keys = ["mask_no", "block", "left_part", "right_part"]
    for table in whole_groups(batches, keys):
        starts = run_starts([table[k].to_numpy() for k in keys])
        ends = np.append(starts[1:], table.num_rows)
        prints = table["print"].to_numpy().view(np.uint64)
        ids, parts = table["id"].to_numpy(), table["part"].to_numpy()
        across = table["left_part"].to_numpy() != table["right_part"].to_numpy()
        a, b = [], []
        for start, end in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            own, forest = prints[start:end], Forest(end - start)
            for low in range(0, end - start, COMPARED):
                near = np.bitwise_count(own[low : low + COMPARED, None] ^ own[None, low:]) <= DISTANCE
                if across[start]:  # pairs within one part meet in a tile of their own
                    side = parts[start:end]
                    near &= side[low : low + COMPARED, None] != side[None, low:]
                i, j = np.nonzero(np.triu(near, 1))
                for x, y in zip((i + low).tolist(), (j + low).tolist()):
                    if forest.join(x, y):
                        a.append(ids[start + x])
                        b.append(ids[start + y])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def close_links(distinct: DataFrame) -> DataFrame:
    """``a, b``: links between the ids of distinct fingerprints (``print, id``) within DISTANCE bits.

    Pairs that close agree in SHARED whole blocks. They meet in the table of such a choice
    of blocks and are compared bit by bit. Links are as many as connect the same fingerprints.
    """
    masks = F.array(*(F.lit(m) for m in _block_masks()))
    rows = distinct.select("id", "print", F.posexplode(masks).alias("mask_no", "mask"))
    rows = rows.select("id", "print", "mask_no", F.col("print").bitwiseAND(F.col("mask")).alias("block"))
    tiles = tiled(rows, ["mask_no", "block"], F.xxhash64("print"), TILE_ROWS)
    return gathered(tiles, ["mask_no", "block"], ["part"]).mapInArrow(_close_pairs, "a bigint, b bigint")


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, component_id`` for each row of ``docs``.

    Equal fingerprints are one class, so copies never become pairs. A null text is an empty
    one. A row without id takes no part in linking and gets the component of its
    fingerprint, if any row with an id has the same. Repeated rows stay repeated.
    """
    prints = stored(fingerprints(docs, key, text), "simhash")
    classes = prints.groupBy("print").agg(F.min("id").alias("first_id"))
    classes = stored(classes.where("first_id is not null"), "simhash-classes")
    roots = components(close_links(classes.select("print", F.col("first_id").alias("id"))))
    known = classes.join(roots.withColumnRenamed("node", "first_id"), "first_id", "left")
    known = known.select("print", F.coalesce("root", "first_id").alias("component_id"))
    digits = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return prints.join(known, "print", "left").select(F.col("id").alias(key), digits, "component_id")


def near_duplicates_removed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``, one row for each group of near duplicates: that with the smallest id.

    Groups are of texts, not of ids: different texts under one id that are no near duplicates stay
    apart, and of several under the smallest id of a group the one with the smallest digest stays.
    Repeated rows stay once. Null and empty texts are one group. Rows without id are kept, as
    nothing tells them apart from others. An empty table gives an empty one.
    """
    digest = F.xxhash64(F.col(text).cast("string"))
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint"), F.col(text).cast("string"), digest.alias("digest"))
    prints = stored(rows.mapInArrow(_fingerprints, "id bigint, print bigint, digest bigint"), "simhash-rows")
    classes = stored(prints.groupBy("print").agg(F.min(F.struct("id", "digest")).alias("first")), "simhash-texts")
    roots = components(close_links(classes.select("print", F.col("print").alias("id"))))
    known = classes.join(roots.withColumnRenamed("node", "print"), "print", "left")
    kept = known.groupBy(F.coalesce("root", "print").alias("root")).agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.id").alias(key), F.col("first.digest").alias("__digest"))
    chosen = docs.withColumn("__digest", digest).join(kept, [key, "__digest"], "left_semi").dropDuplicates([key, "__digest"])
    return chosen.select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))
