"""Connected components of a table of links."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Forest, stored

EDGE_SCHEMA = "a bigint, b bigint"


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one batch as stars around its smallest nodes: never more links than before."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(nodes))
        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
            forest.join(x, y)
        roots = nodes[[forest.root(x) for x in range(len(nodes))]]
        apart = roots != nodes
        yield pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(roots[apart])], ["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.where("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return joined.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (``a, b``) that is not a root: root is the smallest node reachable.

    Alternates large and small stars until nothing changes. Each step keeps at most one
    link per node and smaller neighbour, a node with many links is aggregated before the
    shuffle, and each round is written to the shared folder. Null ends and loops link nothing.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = stored(edges.mapInArrow(_local_stars, EDGE_SCHEMA).distinct(), "links")
    mark = None
    while True:
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark or not found[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = found
        edges = stored(_small_star(_large_star(edges)), "links")
