"""Helpers that several operators share."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.session import shared_folder


def stored(table: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, survives lost executors."""
    folder = shared_folder(table.sparkSession, purpose)
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def as_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty, stray surrogates cannot fail."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new combination of values starts, for sorted columns."""
    change = np.zeros(len(columns[0]), dtype=bool)
    if len(change):
        change[0] = True
    for values in columns:
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that end where a group ends, for input sorted by integer keys without nulls.

    Memory holds one group and one batch at most.
    """
    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.table(batch)
        starts = run_starts([table[k].to_numpy() for k in keys])
        cut = int(starts[-1])
        if waiting and any(waiting[0][k][0].as_py() != table[k][0].as_py() for k in keys):
            if cut == 0:
                yield pa.concat_tables(waiting)
                waiting = [table]
                continue
        if cut:
            yield pa.concat_tables([*waiting, table.slice(0, cut)])
            waiting = [table.slice(cut)]
        else:
            waiting.append(table)
    if waiting:
        yield pa.concat_tables(waiting)


def tiled(rows: DataFrame, key: list[str], spread_by: Column, size: int) -> DataFrame:
    """Rows of groups with two or more rows, dealt into tiles so that each pair meets in one tile.

    A group of up to ``size`` rows is one tile. A larger one is cut into parts, and there is
    a tile for each two parts (``part`` tells a row's own; ``left_part <= right_part``). No
    tile holds more than about twice ``size`` rows, whatever the share of one key.
    """
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    parts = F.ceil(F.col("group_rows") / size).cast("int")
    dealt = rows.join(sizes, key).withColumn("part", F.pmod(spread_by, parts).cast("int"))
    others = F.explode(F.sequence(F.lit(0), parts - 1)).alias("other_part")
    each = dealt.select("*", others).drop("group_rows")
    return each.withColumns({
        "left_part": F.least("part", "other_part"), "right_part": F.greatest("part", "other_part"),
    }).drop("other_part")


def gathered(tiles: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Tiles of one key each in one partition, sorted, for ``whole_groups``."""
    at = [*key, "left_part", "right_part"]
    return tiles.repartition(*at).sortWithinPartitions(*at, *order)


class Forest:
    """Union-find over the positions of one batch; the smaller root wins."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart until now."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


#: Long texts are worked on in parts of about so many bytes.
PART_BYTES = 1 << 22


def segments(text: bytes, blank: bytes = b" ", size: int = PART_BYTES) -> Iterator[bytes]:
    """The text in parts that end before a blank, so that no word is cut; each longer than ``size`` only by a word."""
    start = 0
    while len(text) - start > size:
        cut = text.find(blank, start + size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text
