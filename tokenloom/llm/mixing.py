"""Mixing sources to target weights: each document is taken 0 to 3 times so that sources meet their word budgets.

Whole passes come first. For the rest of a budget, documents are counted by exact size: of
each size the same share is taken, and a bounded-knapsack search over the counts left fills
what remains to the word. Which documents of a size are taken is decided by a seeded hash.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import stored

#: What sources weigh in code point order, repeating, and how often a document may be taken.
WEIGHTS = (5, 2, 1)
MOST = 3
#: The search fits so many words at least, and so many documents of the largest size.
SEARCHED = 1 << 16
WINDOW = 8
#: Documents of one source and size are ranked in so many parts by hash.
HASH_PARTS = 1024
SEED = 7
#: Runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def fitted(sizes: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum to ``budget``, or to the greatest sum below it within reach.

    Sizes are distinct and positive, ``counts`` says how many there are of each. An equal share
    of every size is taken first. Then documents go back, the smallest first, until the search
    has as much to fill as WINDOW times the largest size or SEARCHED words, or all went back;
    the search is over every sum up to that, whatever the sizes. So it is exact whenever
    all documents went back, and otherwise chooses among the sums of that many words.
    """
    total = float((sizes * counts).sum())
    budget = int(min(budget + 0.5, total))
    if not total or budget <= 0:
        return np.zeros_like(counts)
    taken = np.minimum(counts, np.floor(counts * (budget / total)).astype(np.int64))
    order = np.argsort(-sizes, kind="stable")
    left = budget - int((sizes * taken).sum())
    while left < 0:  # only by rounding of very large counts
        largest = order[taken[order] > 0][0]
        taken[largest] -= 1
        left += int(sizes[largest])
    window = max(SEARCHED, WINDOW * int(sizes.max()))
    for i in order.tolist():  # rounding down leaves less than one document of each size
        spare = min(int(counts[i] - taken[i]), max(0, left - window) // int(sizes[i]))
        taken[i] += spare
        left -= spare * int(sizes[i])
    for i in order[::-1].tolist():
        back = min(int(taken[i]), max(0, window - left) // int(sizes[i]))
        taken[i] -= back
        left += back * int(sizes[i])
    return taken + _knapsack(sizes, counts - taken, left)


def _knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: numbers of each size with the greatest sum up to ``budget``.

    Dynamic programming over the sums that can be reached, one bit each: a Python integer
    holds them all, and adding documents is a shift. The counts of a size are bundles of one,
    two, four and so on, so a size takes as many shifts as its count has bits. Sums are counted
    in the sizes' greatest common divisor.
    """
    step = int(np.gcd.reduce(sizes)) if len(sizes) else 1
    budget //= step
    bundles = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, rest, many = int(sizes[i]) // step, min(int(counts[i]), budget * step // int(sizes[i])), 1
        while rest:
            bundles.append((i, min(many, rest), size * min(many, rest)))
            rest, many = rest - bundles[-1][1], many * 2
    within, reached = (1 << (budget + 1)) - 1, 1
    # Sums are kept after every so many bundles, and made again in between on the way back.
    stride, kept, done = math.isqrt(len(bundles)) + 1, [], 0
    for done, (_, _, size) in enumerate(bundles):
        if done % stride == 0:
            kept.append(reached)
        if reached >> budget:
            break
        reached |= reached << size & within
    else:
        done = len(bundles)
    chosen = np.zeros_like(counts)
    at = reached.bit_length() - 1
    for block in reversed(range(len(kept))):
        own = bundles[block * stride : min((block + 1) * stride, done)]
        before = [kept[block]]
        for _, _, size in own[:-1]:
            before.append(before[-1] | before[-1] << size & within)
        for (i, many, size), sums in zip(reversed(own), reversed(before)):
            if not sums >> at & 1:
                chosen[i] += many
                at -= size
    return chosen


def _fit_sources(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    sizes, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    budget = float(rows["rest"].iloc[0])
    return pd.DataFrame({"source_no": keys[0], "size": sizes, "wanted": fitted(sizes, counts, budget)})


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to ``weight, source_size``: shares of all words by weight, at most MOST times a source's size.

    The excess of sources above is shared among the others by weight, until none is above.
    """
    row = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.sum("weight").alias("weight")).first()
    words, free_words, free_weight = float(row["words"]), float(row["words"]), float(row["weight"] or 1)
    most = F.col("source_size").cast("double") * MOST
    while True:
        rate = free_words / free_weight if free_weight else 0.0
        full = F.col("weight") * F.lit(rate) > most
        found = sources.where(full).agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
        held, weight = float(found["words"]) * MOST, float((row["weight"] or 1) - found["weight"])
        if (words - held, weight) == (free_words, free_weight):
            return sources.withColumn("target", F.when(full, most).otherwise(F.col("weight") * F.lit(rate)))
        free_words, free_weight = words - held, weight


def _sized(docs: DataFrame, key: str, text: str, source: str, carried: list[str]) -> DataFrame:
    words = F.regexp_count(F.col(text).cast("string"), F.lit(WORD))
    return docs.select(
        F.col(key).alias("id"), F.col(source).cast("string").alias("source_name"),
        F.coalesce(words, F.lit(0)).cast("long").alias("size"),
        F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(1 << 40)).alias("draw"),
        F.struct(*carried).alias("row") if carried else F.lit(None).cast("int").alias("row"))


def _times(docs: DataFrame, key: str, text: str, source: str, carried: list[str]) -> DataFrame:
    """``id, size, source_size, target, times, row``; row holds the carried columns."""
    base = stored(_sized(docs, key, text, source, []), "mix-sizes")
    per_source = stored(base.groupBy("source_name").agg(F.sum("size").alias("source_size")), "mix-sources")
    # One row for each source name; only names and sums are ordered here.
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source_name"))) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), (rank % len(WEIGHTS)).cast("int") + 1)
    known = targets(stored(
        per_source.select("source_name", "source_size", rank.alias("source_no"), weight.alias("weight")), "mix-weights"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    known = known.withColumn("passes", F.least(passes, F.lit(MOST)).cast("long"))
    known = known.select(F.col("source_name").alias("name"), "source_no", "source_size", "target", "passes",
                         (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"))
    known = stored(known, "mix-targets")
    part = (F.col("draw") % HASH_PARTS).cast("int").alias("part")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(known, F.col("source_name").eqNullSafe(F.col("name"))).drop("name", "source_name").withColumn("part", part)

    parts = placed(base).where("size > 0").groupBy("source_no", "size", "part").agg(
        F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest"))
    parts = stored(parts, "mix-parts")
    histogram = parts.groupBy("source_no", "size").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"))
    wanted = histogram.groupBy("source_no").applyInPandas(_fit_sources, "source_no int, size long, wanted long")
    wanted = stored(wanted.where("wanted > 0"), "mix-wanted")
    # Documents of a size are taken in the order of part, draw and id, so a part is full, empty or cut.
    before = Window.partitionBy("source_no", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    open_parts = parts.join(wanted, ["source_no", "size"]).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    open_parts = stored(open_parts.where("before < wanted").select(
        "source_no", "size", "part", "n", (F.col("wanted") - F.col("before")).alias("from_part")), "mix-open")
    full = open_parts.where("n <= from_part").select("source_no", "size", "part", F.lit(1).alias("extra"))
    cut = open_parts.where("n > from_part").select("source_no", "size", "part", "from_part")
    rows = placed(_sized(docs, key, text, source, carried) if carried else base)
    at = ["source_no", "size", "part"]
    # Only rows of parts that are cut need an order. There is one such part for each source and size at most.
    order = Window.partitionBy(*at).orderBy("draw", "id")
    drawn = rows.join(full, at, "left").join(cut, at, "left")
    ranked = drawn.where("from_part is not null").withColumn("extra", (F.row_number().over(order) <= F.col("from_part")).cast("int"))
    every = drawn.where("from_part is null").unionByName(ranked)
    times = F.when(F.col("size") > 0, F.col("passes") + F.coalesce("extra", F.lit(0))).otherwise(0)
    return every.select("id", "size", "source_size", "target", times.cast("int").alias("times"), "row")


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key, size, source_size, target, taken`` for each row of ``docs``; ``taken`` counts words with repeats.

    A null text has no word; a null source is a source of its own. A document without words
    is not taken. Repeated rows are documents of their own; of rows with the same id,
    source and size any may be the one that is taken once more.
    """
    return _times(docs, key, text, source, []).select(
        F.col("id").alias(key), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The columns of ``docs``, each row as often as the mix takes it."""
    chosen = _times(docs, key, text, source, docs.columns).where("times > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
