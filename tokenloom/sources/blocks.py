"""The token stream kept as blocks in the order of their numbers, so that a batch reads the blocks it draws."""

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators import windows as win
from tokenloom.session import exists, read_text, stored, write_text

#: Ids of a block: the least that is read for a window.
BLOCK = 4096
#: Ids of a file, bytes of a row group and blocks of a page; the bounds of the last two tell which blocks they hold.
FILE_IDS = 1 << 25
ROW_GROUP_BYTES = 16 << 20
PAGE_BLOCKS = 8
#: Blocks that a filter names one by one; a larger batch meets the blocks in a join.
NAMED_BLOCKS = 4096
MANIFEST = "manifest.json"


def write_blocks(encoded: DataFrame, folder: str, block: int = BLOCK, key: str = "doc_id", ids: str = "ids") -> "BlockStore":
    """Writes the ids of all rows, in key order, as blocks of equal size; the last may be shorter.

    Positions are computed once, here, and one shuffle brings the slices of a block together and
    the blocks in order. A manifest is written last: a store without one was not written to its end. Null and
    empty rows have no ids; a key that is null or occurs twice is an error.
    """
    if block < 1:
        raise ValueError("a block holds an id at least")
    spark = encoded.sparkSession
    placed, total = win.place_documents(encoded, key, ids)
    n_blocks = -(-total // block)
    files = max(-(-total // FILE_IDS), min(spark.sparkContext.defaultParallelism, -(-n_blocks // 64)), 1)
    # Slices dealt by ranges of blocks are grouped by block where they are.
    slices = win.segments_of(placed, 0, block, ids).repartitionByRange(files, "block_no")
    blocks = win.blocks_of(slices, block).select((F.col("block_start") / block).cast("long").alias("block_no"), "run")
    rows = blocks.sortWithinPartitions("block_no")
    bounds = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.page.row.count.limit": PAGE_BLOCKS}
    rows.write.options(**bounds).parquet(f"{folder}/blocks")
    write_text(spark, f"{folder}/{MANIFEST}", json.dumps({"block": block, "n_ids": total}))
    return BlockStore(spark, folder)


def _among(column: str, values: list[int], at_once: int) -> Column:
    """Whether a column is among the values, in lists that are short enough to be held against the bounds of row groups."""
    terms = [F.col(column).isin(values[i : i + at_once]) for i in range(0, len(values), at_once)]
    while len(terms) > 1:
        terms = [reduce(Column.__or__, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0] if terms else F.lit(False)


class BlockStore:
    """Blocks as ``write_blocks`` left them. Windows of any length are cut from them."""

    def __init__(self, spark: SparkSession, folder: str):
        if not exists(spark, f"{folder}/{MANIFEST}"):
            raise ValueError(f"{folder}: no manifest, so the blocks are not whole")
        found = json.loads(read_text(spark, f"{folder}/{MANIFEST}"))
        self.spark, self.block, self.n_ids = spark, found["block"], found["n_ids"]
        self.table = spark.read.schema("block_no bigint, run array<int>").parquet(f"{folder}/blocks")
        held = self.table.count()
        if held != -(-self.n_ids // self.block):
            raise ValueError(f"{folder}: {held} blocks do not hold {self.n_ids} ids")

    def blocks(self, numbers: list[int]) -> DataFrame:
        """``block_no, run`` of some blocks; the filter reaches row groups and pages of the files."""
        # Longer lists are only held against their least and greatest value.
        at_once = int(self.spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold", "10"))
        return self.table.where(_among("block_no", sorted(numbers), max(1, at_once)))

    def _placed(self, blocks: DataFrame) -> DataFrame:
        return blocks.select((F.col("block_no") * self.block).alias("doc_start"), "run", F.size("run").alias("n_ids"))

    def windows(self, m: int) -> DataFrame:
        """``start, x, y`` for every start with m + 1 ids, as ``lm_windows`` gives; no positions are computed again."""
        return win.windows_of(self._placed(self.table), m, max(self.block, win.default_block(m)), "run")

    def windows_at(self, samples: DataFrame, m: int, named_blocks: int = NAMED_BLOCKS) -> DataFrame:
        """``sample_id, start, x, y`` for given ``sample_id, start``; starts without a whole window give no row."""
        samples = stored(samples.where(F.col("start").between(0, self.n_ids - m - 1)), "drawn")
        numbers = F.sequence(F.floor(F.col("start") / self.block), F.floor((F.col("start") + m) / self.block))
        needed = samples.select(F.explode(numbers).alias("block_no")).distinct()
        few = needed.limit(named_blocks + 1).collect()
        if len(few) <= named_blocks:
            blocks = self.blocks([r.block_no for r in few])
        else:
            blocks = self.table.join(needed, "block_no", "left_semi")
        return win.windows_from(self._placed(blocks), samples, m, self.block, "run")

    def batch(self, batch_size: int, m: int, seed: int, named_blocks: int = NAMED_BLOCKS) -> DataFrame:
        """``sample_id, start, x, y`` at the starts that ``lm_batch`` draws from the same ids and seed."""
        if self.n_ids <= m:
            raise ValueError(f"a stream of {self.n_ids} ids has no window of {m}")
        return self.windows_at(win.draws(self.spark, batch_size, self.n_ids - m, seed), m, named_blocks)
