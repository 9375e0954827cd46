"""Divergence of the sources of a language: which differ most, and by which terms.

Counts of terms are smoothed shares (prices) in exact integers. A price depends on a count
only, so whole count levels are priced at once: with an indicator column for each (group,
level), the product of the transposed matrix with itself says for each two levels of two
groups how many terms have both. It is made in blocks of rows and tiles of columns, and
only of levels above zero; what has level zero follows from the margins.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import run_starts, segments, stored

#: Documents a kept term stands in, the scale of prices and what is added to each count, ranks of part ``term``.
LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
ADDED = 2
TOP_TERMS = 10
#: A task holds so many counts before it passes them on, a product so many rows and columns.
HELD = 400_000
ROWS = (4096, 1024, 256, 64, 16)
COLUMNS = 1024

#: ASCII letters become lower case, other ASCII characters blanks; the rest stays.
_FOLD = bytes(b | 0x20 if chr(b).isascii() and chr(b).isalpha() else b if b > 127 else 0x20 for b in range(256))

_COUNT_SCHEMA = "lang string, source string, term binary, n bigint, docs bigint"
_JOINT_SCHEMA = "lang string, g int, a bigint, h int, b bigint, terms bigint"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size: runs of ASCII letters and non-ASCII characters."""
    for part in segments(text.translate(_FOLD)):
        yield part.split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term and group as a task sees them; an empty term stands for the group itself."""
    occurrences: dict[tuple, Counter] = defaultdict(Counter)
    documents: dict[tuple, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for group, counts in occurrences.items():
            found, seen = list(counts), documents[group]
            columns = [
                pa.array([group[0]] * (len(found) + 1), pa.string()), pa.array([group[1]] * (len(found) + 1), pa.string()),
                pa.array([b"", *found], pa.binary()), pa.array([0, *counts.values()], pa.int64()),
                pa.array([0, *(seen[t] for t in found)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        occurrences.clear()
        documents.clear()

    held = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for group, text in zip(zip(langs, sources), batch.column(2)):
            counts, seen = occurrences[group], set()
            before = len(counts)
            for terms in terms_of(text.as_py()):
                counts.update(terms)
                seen.update(terms)
            documents[group].update(seen)
            held += len(counts) - before
            if held > HELD:
                yield from flush()
                held = 0
    yield from flush()


def _block_rows(codes: np.ndarray, starts: np.ndarray, row: int) -> int:
    """How many rows from ``row`` on have few enough different columns to be one block."""
    for n in ROWS:
        end = min(row + n, len(starts) - 1)
        if len(np.unique(codes[starts[row] : starts[end]])) <= COLUMNS or n == ROWS[-1]:
            return end - row
    return 1


def joint_cells(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells ``(i, j, n)`` above zero, ``i <= j``, of the product of the transposed indicator matrix with itself.

    Row r of the matrix has ones in the columns ``codes[starts[r]:starts[r + 1]]``. Sums of
    ones in single precision are exact, as a block has far fewer than 2**24 rows.
    """
    width, cells, row = int(codes.max()) + 1 if len(codes) else 1, [], 0
    while row < len(starts) - 1:
        n = _block_rows(codes, starts, row)
        own = codes[starts[row] : starts[row + n]]
        columns, at = np.unique(own, return_inverse=True)
        block = np.zeros((n, len(columns)), dtype=np.float32)
        block[np.repeat(np.arange(n), np.diff(starts[row : row + n + 1])), at] = 1
        for left in range(0, len(columns), COLUMNS):
            for right in range(left, len(columns), COLUMNS):
                product = block[:, left : left + COLUMNS].T @ block[:, right : right + COLUMNS]
                i, j = np.nonzero(product if left < right else np.triu(product))
                cells.append((columns[left + i] * width + columns[right + j], product[i, j].astype(np.int64)))
        row += n
    if not cells:
        return (np.empty(0, np.int64),) * 3
    keys, at = np.unique(np.concatenate([c[0] for c in cells]), return_inverse=True)
    sums = np.zeros(len(keys), dtype=np.int64)
    np.add.at(sums, at, np.concatenate([c[1] for c in cells]))
    return keys // width, keys % width, sums


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column(0).dictionary_encode()
        lang_no = langs.indices.to_numpy()
        lists = batch.column(1)
        ends, flat = lists.offsets.to_numpy(), lists.flatten()
        levels = np.stack([flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy()], axis=1)
        bounds = [*run_starts([lang_no]).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            starts = ends[low : high + 1].astype(np.int64) - ends[0]
            columns, codes = np.unique(levels[starts[0] : starts[-1]], axis=0, return_inverse=True)
            i, j, n = joint_cells(codes.reshape(-1).astype(np.int64), starts - starts[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs.dictionary[lang_no[low]].as_py()] * len(n), pa.string()),
                 pa.array(columns[i, 0].astype(np.int32)), pa.array(columns[i, 1]),
                 pa.array(columns[j, 0].astype(np.int32)), pa.array(columns[j, 1]), pa.array(n)],
                ["lang", "g", "a", "h", "b", "terms"])


def price(count: str, total: str, kept: str) -> Column:
    """``1 + floor(SCALE * (count + ADDED) / (total + ADDED * kept))``, by decimals, as products may pass 64 bits."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10, 0)) * cast({count} + {ADDED} as decimal(19, 0))) "
        f"div (cast({total} as decimal(19, 0)) + {ADDED} * cast({kept} as decimal(16, 0)))")


def gap(p: str, q: str) -> str:
    """SQL of ``floor((p - q)**2 / (p + q))``; prices are below 2**30, so 64 bits hold it."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group its distance to each other source of the
    language (part ``pair``), and the terms it has more of than the language as a whole (part ``term``).

    Null texts, languages and sources are empty ones; a group without terms has counts of zero,
    a language without kept terms distances of zero. Repeated rows are documents of their own.
    An empty table gives an empty result. Texts are read in parts, so their length has no bound.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    seen = rows.mapInArrow(_counted, _COUNT_SCHEMA).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    seen = stored(seen.withColumn("term", F.col("term").cast("string")), "divergence-counts")

    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = seen.where("term = ''").select("lang", "source", F.row_number().over(in_lang).alias("g"))
    groups = stored(groups, "divergence-names")
    terms = seen.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = terms.where(F.col("docs") >= LEAST_DOCUMENTS).select("lang", "term", "n")
    level = F.struct("g", F.col("own").alias("n"))
    by_term = seen.where("term <> ''").select("lang", "source", "term", F.col("n").alias("own")).join(groups, ["lang", "source"])
    # A term has one level for each source at most.
    kept = stored(by_term.join(terms, ["lang", "term"]).groupBy("lang", "term", "n").agg(F.collect_list(level).alias("levels")), "divergence-terms")
    each = kept.select("lang", "term", "n", F.inline("levels").alias("g", "own"))

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    totals = each.groupBy("lang", "g").agg(F.sum("own").alias("total"))
    known = groups.join(sizes, "lang", "left").join(totals, ["lang", "g"], "left").na.fill(0, ["kept", "lang_total", "total"])
    # A language without kept terms has no price; its distances are zero.
    known = stored(known.withColumn("zero", F.when(F.col("kept") > 0, price("0", "total", "kept")).otherwise(1)), "divergence-groups")

    joint = kept.sortWithinPartitions("lang", "n").select("lang", "levels").mapInArrow(_products, _JOINT_SCHEMA)
    joint = stored(joint.groupBy("lang", "g", "a", "h", "b").agg(F.sum("terms").alias("terms")), "divergence-joint")
    pairs = _pairs(joint, known)
    above = each.join(known, ["lang", "g"]).select(
        "lang", "source", "term", price("own", "total", "kept").alias("p"), price("n", "lang_total", "kept").alias("q")).where("p > q")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(above)


def _pairs(joint: DataFrame, known: DataFrame) -> DataFrame:
    """Both directions of each pair of groups with its value, as level zero everywhere plus what each level adds."""
    g = known.select("lang", "g", F.col("zero").alias("g0"), F.col("total").alias("g_total"), "kept")
    h = known.select("lang", F.col("g").alias("h"), F.col("zero").alias("h0"), F.col("total").alias("h_total"))
    base = g.join(h, "lang").where("g < h").select("lang", "g", "h", F.expr(f"kept * {gap('g0', 'h0')}").alias("value"))

    margin = joint.where("g = h").join(g, ["lang", "g"]).select(
        "lang", "g", "g0", "terms", price("a", "g_total", "kept").alias("p"))
    added = f"terms * ({gap('p', 'h0')} - {gap('g0', 'h0')})"
    one = margin.join(h, "lang").where("g <> h").select(
        "lang", F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h"), F.expr(added).alias("value"))

    both = joint.where("g <> h").join(g, ["lang", "g"]).join(h, ["lang", "h"]).select(
        "lang", "g", "h", "terms", "g0", "h0", price("a", "g_total", "kept").alias("p"), price("b", "h_total", "kept").alias("q"))
    added = f"terms * ({gap('p', 'q')} - {gap('p', 'h0')} - {gap('g0', 'q')} + {gap('g0', 'h0')})"
    two = both.select("lang", "g", "h", F.expr(added).alias("value"))

    values = base.unionByName(one).unionByName(two).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct("g", F.col("h").alias("other")), F.struct(F.col("h").alias("g"), F.col("g").alias("other")))).alias("e")
    each = values.select("lang", "value", ends).select("lang", "e.*", "value")
    names = known.select("lang", "g", "source")
    others = known.select("lang", F.col("g").alias("other"), F.col("source").alias("item"))
    return each.join(names, ["lang", "g"]).join(others, ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
