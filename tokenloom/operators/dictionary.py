"""A kept table of encoded words: a word is merged once for all tasks, corpora and runs of a tokenizer."""

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators.tokenizer import Tokenizer, gathered, ids_by_arrow, list_bounds
from tokenloom.operators.words import pretoken_counts
from tokenloom.session import listed, read_text, stored, write_text

#: The most frequent words go to every task, within all three bounds; the others meet their ids in a join.
HOT_WORDS = 65_536
HOT_LENGTH = 1_024
HOT_BYTES = 32 << 20
#: So many parts are put together into one.
COMPACT_PARTS = 16
#: Stands for a word whose ids are still to come.
HOLE = -(1 << 31)
#: Rows with about so many ids are filled at once.
AT_ONCE = 1 << 18
_SCHEMA = "token string, ids array<int>"


def version_of(tokenizer: Tokenizer) -> str:
    """A digest of all that ids depend on."""
    entries = sorted((token_id, token.hex()) for token_id, token in tokenizer.vocab.items())
    merges = [(left.hex(), right.hex()) for left, right in tokenizer.merges]
    return hashlib.sha256(json.dumps([entries, merges, tokenizer.specials]).encode()).hexdigest()


def _known_ids(words: list[str], lists: list[list[int]]):
    """Arrow function from lists of tokens to their ids, with a hole for each word not given.

    ``cold`` has these words, each once, and ``places`` for each hole, in order, which of them it stands for.
    """
    n_words = len(words)

    @F.arrow_udf("struct<ids:array<int>,places:array<int>,cold:array<string>>")
    def known_and_cold(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = np.array([*map(len, lists), 1], dtype=np.int64)
        pool = np.array([*(i for ids in lists for i in ids), HOLE], dtype=np.int32)
        for tokens in batches:
            found = tokens.flatten().dictionary_encode()
            known = pa.array(words, found.dictionary.type)
            places = pc.index_in(found.dictionary, value_set=known).fill_null(n_words).to_numpy(zero_copy_only=False)
            indices = found.indices.to_numpy(zero_copy_only=False)
            codes = places[indices] if len(indices) else np.zeros(0, dtype=np.int64)
            holes, bounds = np.flatnonzero(codes == n_words), list_bounds(tokens)
            row = np.searchsorted(bounds, holes, side="right") - 1
            n_distinct = max(len(found.dictionary), 1)
            once, at = np.unique(row * n_distinct + indices[holes], return_inverse=True)
            ends = np.searchsorted(once, np.arange(len(bounds)) * n_distinct)
            cold_words = found.dictionary.take(pa.array(once % n_distinct, pa.int64())).cast(pa.string())
            parts = [
                gathered(tokens, codes, sizes, pool),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(holes, bounds), pa.int32()), pa.array(at - ends[row], pa.int32())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cold_words),
            ]
            yield pa.StructArray.from_arrays(parts, ["ids", "places", "cold"])

    return known_and_cold


def _filled(ids: pa.Array, places: pa.Array, words: pa.Array) -> pa.Array:
    """Ids of rows with their holes filled in order by the ids of the words in these places."""
    bounds = list_bounds(ids)
    # Rows of about so many ids at once: beside the ids, only what these need is held.
    cuts = np.unique([*np.searchsorted(bounds, np.arange(0, int(bounds[-1]), AT_ONCE)).tolist(), 0, len(ids)])
    parts = [_filled_part(*(x.slice(low, high - low) for x in (ids, places, words))) for low, high in zip(cuts, cuts[1:])]
    return pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *parts])


def _filled_part(ids: pa.Array, places: pa.Array, words: pa.Array) -> pa.Array:
    values, place = (x.flatten().to_numpy(zero_copy_only=False) for x in (ids, places))
    holes = np.flatnonzero(values == HOLE)
    row = np.repeat(np.arange(len(ids)), np.diff(list_bounds(places)))
    found, first = words.flatten(), list_bounds(words)
    # The words of a row come in any order; each place has one.
    n_own, own_row = np.diff(first), np.repeat(np.arange(len(ids)), np.diff(first))
    own_place = found.field("place").to_numpy(zero_copy_only=False)
    if len(holes) != len(place) or (own_place >= n_own[own_row]).any() or (place >= n_own[row]).any():
        raise ValueError("a word without its ids")
    at = np.full(len(found), -1, dtype=np.int64)
    at[first[own_row] + own_place] = np.arange(len(found))
    if (at < 0).any():
        raise ValueError("a word without its ids")
    word = at[first[row] + place]
    lists = found.field("ids")
    pool, starts = lists.flatten().to_numpy(zero_copy_only=False), list_bounds(lists)
    lengths = np.diff(starts)[word]
    sizes = np.ones(len(values), dtype=np.int64)
    sizes[holes] = lengths
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.repeat(values, sizes)
    # The i-th of a word's ids goes to the i-th place after where its hole began.
    nth = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(ends[holes], lengths) + nth] = pool[np.repeat(starts[word], lengths) + nth]
    return pa.ListArray.from_arrays(pa.array(ends[list_bounds(ids)], pa.int32()), pa.array(out, pa.int32()))


class WordDictionary:
    """``token, ids`` of one tokenizer, below a folder that several tokenizers may share.

    Words are written as immutable parts; a manifest that appears by one rename says which parts make a
    version, so a part whose writer stopped is never read. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, tokenizer: Tokenizer):
        self.spark, self.tokenizer = spark, tokenizer
        self.folder = f"{folder.rstrip('/')}/{version_of(tokenizer)}"

    def _versions(self) -> list[str]:
        return [n for n in listed(self.spark, f"{self.folder}/versions") if n.endswith(".json")]

    def _parts(self) -> list[str]:
        versions = self._versions()
        return json.loads(read_text(self.spark, f"{self.folder}/versions/{versions[-1]}")) if versions else []

    def _read(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(*(f"{self.folder}/parts/{p}" for p in parts))

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.folder}/parts/{name}")
        return name

    def table(self) -> DataFrame:
        """``token, ids`` as of the last version; each token once."""
        return self._read(self._parts())

    def extend(self, words: DataFrame, token: str = "token") -> int:
        """Merges the words that are not kept yet and keeps them. Returns how many these are."""
        parts = self._parts()
        wanted = words.select(F.col(token).alias("token")).where("token IS NOT NULL").distinct()
        new = wanted.join(self._read(parts), "token", "left_anti") if parts else wanted
        added = self._write(new.select("token", ids_by_arrow(self.tokenizer)(F.array("token")).alias("ids")))
        n_new = self._read([added]).count()
        if n_new:
            parts = [*parts, added]
            if len(parts) > COMPACT_PARTS:
                parts = [self._write(self._read(parts))]
            write_text(self.spark, f"{self.folder}/versions/{len(self._versions()):020d}.json", json.dumps(parts))
        return n_new

    def _hot(self, counts: DataFrame, hot_words: int) -> tuple[list[str], list[list[int]]]:
        """The most frequent words with their ids, within the bounds."""
        best = counts.where(F.length("token") <= HOT_LENGTH).orderBy(F.desc("n"), "token").limit(hot_words)
        # At most ``hot_words`` rows of bounded length.
        up_to = Window.orderBy(F.desc("n"), "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        best = best.withColumn("held", F.sum(5 * F.octet_length("token")).over(up_to)).where(F.col("held") <= HOT_BYTES)
        rows = self.table().join(F.broadcast(best.select("token")), "token").collect()
        return [r.token for r in rows], [r.ids for r in rows]

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids", hot_words: int = HOT_WORDS) -> DataFrame:
        """Replaces the text of each row by its token ids, as ``encode_documents`` does; null gives null.

        Words are counted first, and new ones are kept. Frequent words get their ids in the task that
        reads the row; a row's other words, each once, meet the table by one shuffle of words. Other columns
        pass as they are; rows may repeat.
        """
        # The text is read twice; what the words give is stored, as both the counts and the new words come from it.
        counts = stored(pretoken_counts(docs, self.tokenizer.specials, text), "words")
        self.extend(counts)
        known = _known_ids(*self._hot(counts, hot_words))
        others = [c for c in docs.columns if c not in (text, ids)]
        rows = docs.select(
            F.struct(F.lit(0).alias("of_row"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(others))).alias("other"),
            known(tx.tokens(F.col(text), self.tokenizer.specials)).alias("found"),
        )
        # Stored, so that row numbers are the same in all that follows.
        rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "other", "found.*"), "rows")
        has_cold = F.coalesce(F.size("cold") > 0, F.lit(False))
        waiting = rows.where(has_cold)
        words = waiting.select("row", F.posexplode("cold").alias("place", "token")).join(self.table(), "token")
        words = words.groupBy("row").agg(F.collect_list(F.struct("place", "ids")).alias("words"))
        # A row without its words is an error, not a row that goes.
        none = F.array().cast("array<struct<place:int,ids:array<int>>>")
        fill = F.arrow_udf(_filled, "array<int>")
        waiting = waiting.select("row", "other", "ids", "places").join(words, "row", "left")
        filled = waiting.select("other", fill("ids", "places", F.coalesce("words", none)).alias("ids"))
        both = rows.where(~has_cold).select("other", "ids").unionByName(filled)
        return both.select(*(F.col(f"other.c{i}").alias(c) for i, c in enumerate(others)), F.col("ids").alias(ids))
