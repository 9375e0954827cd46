"""Collocations: phrases whose words stand together more often than their parts explain.

Counts come from a suffix tree over words, cut off at the depth of the longest phrase, which
is never whole anywhere. Its suffixes are partitioned vertically: a first word that begins
few enough suffixes is a prefix of its own, a more frequent one is extended to two words, and
a pair that is still too frequent to three. Prefixes are dealt into groups whose suffixes fit
a memory budget, each group builds its subtrees alone, and a phrase's count is the total of
the leaves below it.
"""

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import segments, stored, whole_groups

#: What a candidate occurs at least, the score's scale, the share of a longer phrase that drops a shorter one, ranks shown.
LEAST = 10
SCALE = 1_000_000
DROP_PERCENT = 50
TOP = 2000
#: Suffixes that a group may hold, and how many prefixes may be extended at each depth at most: a larger corpus has a larger budget.
BUDGET = 1 << 20
EXTENDED = 1 << 16
#: A task holds so many counts or suffixes before it passes them on; word numbers take 21 bits.
HELD_WORDS = 200_000
HELD_SUFFIXES = 3 << 17
SENT_ROWS = 1 << 16
HELD_LANGS = 8
_BITS = 21
#: Candidates of a language are ranked in so many parts first.
RANK_PARTS = 64

#: A-Z become lower case, tabs blanks; what ends a piece becomes a full stop.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 46 if b in _ENDS else b for b in range(256))
_END = b"."


def marked_words(text: bytes) -> Iterator[list[bytes]]:
    """Words in lists of bounded size, with a full stop where a piece ends."""
    for part in segments(text.translate(_FOLD)):
        yield part.replace(_END, b" . ").split()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language put together up to a bounded size, with a piece end between two."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = defaultdict(list)
        size = 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            by_lang[lang].append(text)
            size += len(text)
            if size > 1 << 22:
                yield from ((lang, _END.join(texts)) for lang, texts in by_lang.items())
                by_lang, size = defaultdict(list), 0
        yield from ((lang, _END.join(texts)) for lang, texts in by_lang.items())


_COUNTED = "lang string, phrase binary, n bigint"


def _counted(lang: str, counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
        ["lang", "phrase", "n"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = defaultdict(Counter)
    for lang, text in _texts(batches):
        for words in marked_words(text):
            held[lang].update(words)
        if len(held[lang]) > HELD_WORDS:
            counts = held.pop(lang)
            counts.pop(_END, None)
            yield _counted(lang, counts)
    for lang, counts in held.items():
        counts.pop(_END, None)
        yield _counted(lang, counts)


def _pair_counts(frequent: dict[str, set[bytes]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of pairs that begin with a frequent word. A word at the end of a piece begins none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        for lang, text in _texts(batches):
            firsts, last = frequent.get(lang, ()), _END
            if not firsts:
                continue
            for words in marked_words(text):
                following = [last, *words]
                held[lang].update(b"%b %b" % (a, b) for a, b in zip(following, words) if a in firsts and b != _END)
                last = words[-1] if words else last
            if len(held[lang]) > HELD_WORDS:
                yield _counted(lang, held.pop(lang))
        yield from (_counted(lang, counts) for lang, counts in held.items())

    return run


class _Numbers(dict):
    """Numbers of words in the order they come; the end of a piece is 0."""

    def __init__(self):
        super().__init__({_END: 0})
        self.next = count(1).__next__

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.next()
        return number


class _Suffixes:
    """Suffixes of one language as a task sees them, cut off at three words, equal ones counted; a word alone is no suffix here."""

    def __init__(self):
        self.numbers, self.waiting, self.size = _Numbers(), [], 0
        self.codes, self.times = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, words: list[bytes]) -> None:
        """All suffixes but the last two, whose next words are not known."""
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        first, second, third = ids[:-2], ids[1:-1], ids[2:]
        codes = (first << 2 * _BITS) | (second << _BITS) | third
        self.waiting.append(codes[(first > 0) & (second > 0)])
        self.size += len(codes)
        if self.size > HELD_SUFFIXES:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            fresh, times = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.codes, at = np.unique(np.concatenate([self.codes, fresh]), return_inverse=True)
            every, self.times = np.concatenate([self.times, times]), np.zeros(len(self.codes), np.int64)
            np.add.at(self.times, at, every)
        self.waiting, self.size = [], 0

    def full(self) -> bool:
        return len(self.codes) > HELD_SUFFIXES or len(self.numbers) > HELD_WORDS

    def rows(self, lang: str, extended: set[bytes]) -> Iterator[pa.RecordBatch]:
        """``lang, pair, third, depth, n``: a suffix as its first two words and the third, if any; depth is the number of words in its prefix."""
        self.settle()
        words, mask = [b"", *list(self.numbers)[1:]], (1 << _BITS) - 1
        table = pa.array(words, pa.binary())
        is_first = np.fromiter((w in extended for w in words), bool, len(words))
        numbers = ((self.numbers.get(a), self.numbers.get(b)) for a, _, b in (e.partition(b" ") for e in extended) if b)
        pairs = np.array([a << _BITS | b for a, b in numbers if a is not None and b is not None], dtype=np.int64)
        for low in range(0, len(self.codes), SENT_ROWS):
            codes, times = self.codes[low : low + SENT_ROWS], self.times[low : low + SENT_ROWS]
            first, second, third = (table.take(pa.array(n)) for n in (codes >> 2 * _BITS, codes >> _BITS & mask, codes & mask))
            depth = 1 + is_first[codes >> 2 * _BITS].astype(np.int32) + np.isin(codes >> _BITS, pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pc.binary_join_element_wise(first, second, pa.scalar(b" ", pa.binary())), third,
                 pa.array(depth, pa.int32()), pa.array(times)], ["lang", "pair", "third", "depth", "n"])


def _suffixes(extended: dict[str, set[bytes]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Suffixes] = defaultdict(_Suffixes)
        for lang, text in _texts(batches):
            waiting: list[bytes] = []
            for words in chain(marked_words(text), [[_END, _END]]):
                waiting += words
                if len(waiting) > 2:
                    held[lang].add(waiting)
                    waiting = waiting[-2:]
                if held[lang].full():
                    yield from held.pop(lang).rows(lang, extended.get(lang, set()))
            if len(held) > HELD_LANGS:
                for name in list(held):
                    yield from held.pop(name).rows(name, extended.get(name, set()))
        for lang, own in held.items():
            yield from own.rows(lang, extended.get(lang, set()))

    return run


def _subtrees(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nodes of depth two and three of the subtrees of whole groups, as far as ``least`` suffixes lie below them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, ["group_no"]):
            # Batch by batch, so that the strings of a group are not copied once more.
            lang, pair, third = (group[c].dictionary_encode().combine_chunks() for c in ("lang", "pair", "third"))
            times = group["n"].to_numpy()
            node = pair.indices.to_numpy().astype(np.int64) * len(lang.dictionary) + lang.indices.to_numpy()
            totals = np.zeros(len(pair.dictionary) * len(lang.dictionary), np.int64)
            np.add.at(totals, node, times)
            inner = np.flatnonzero(totals >= least)
            # Leaves below smaller nodes are smaller still; an empty third word is the end of a piece.
            below = (totals[node] >= least) & (pc.binary_length(third.dictionary).to_numpy() > 0)[third.indices.to_numpy()]
            keys, at = np.unique(node[below] * len(third.dictionary) + third.indices.to_numpy()[below], return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, at, times[below])
            leaf = keys[sums >= least]
            above, last = leaf // max(1, len(third.dictionary)), leaf % max(1, len(third.dictionary))
            both, n_langs = np.concatenate([inner, above]), len(lang.dictionary)
            pairs = pair.dictionary.take(pa.array(both // n_langs))
            longer = pc.binary_join_element_wise(pairs[len(inner) :], third.dictionary.take(pa.array(last)), " ")
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(both % n_langs)), pa.concat_arrays([pairs[: len(inner)], longer]),
                 pa.array(np.concatenate([totals[inner], sums[sums >= least]]))], ["lang", "phrase", "n"])

    return run


def _over(counts: DataFrame, budget: int) -> dict[str, set[bytes]]:
    """Phrases above the budget. Their counts sum to no more than the corpus, so there are EXTENDED at most."""
    found: dict[str, set[bytes]] = defaultdict(set)
    for row in counts.where(F.col("n") > budget).select("lang", F.col("phrase").cast("binary").alias("phrase")).collect():
        found[row["lang"]].add(bytes(row["phrase"]))
    return dict(found)


def _group_no(lang: str, prefix: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(F.col(lang), prefix), F.lit(groups)).cast("int")


def _group_number(words: DataFrame, pairs: DataFrame | None, total: int, budget: int) -> int:
    """The number of groups, doubled until none holds more than two budgets; longer prefixes are single leaves."""
    prefixes = words.where(F.col("n") <= budget)
    if pairs is not None:
        prefixes = prefixes.unionByName(pairs.where(F.col("n") <= budget))
    groups = max(1, -(-total // budget))
    while True:
        load = prefixes.groupBy(_group_no("lang", F.col("phrase"), groups).alias("group_no")).agg(F.sum("n").alias("load"))
        if (load.agg(F.max("load").alias("most")).first()["most"] or 0) <= 2 * budget:
            return groups
        groups *= 2


def phrase_counts(docs: DataFrame, text: str, lang: str, least: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n`` of all words, and of all phrases of two and three words that occur ``least`` times."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))

    def summed(counts: DataFrame) -> DataFrame:
        sums = counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        return stored(sums.withColumn("phrase", F.col("phrase").cast("string")), "phrases-counts")

    words = summed(rows.mapInArrow(_word_counts, _COUNTED))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    budget = max(budget, total // EXTENDED)
    extended, pairs = _over(words, budget), None
    if extended:
        pairs = summed(rows.mapInArrow(_pair_counts(extended), _COUNTED))
        for name, found in _over(pairs, budget).items():
            extended[name] |= found
    groups = _group_number(words, pairs, total, budget)

    suffixes = rows.mapInArrow(_suffixes(extended), "lang string, pair binary, third binary, depth int, n bigint")
    suffixes = suffixes.withColumns({"pair": F.col("pair").cast("string"), "third": F.col("third").cast("string")})
    prefix = F.when(F.col("depth") == 1, F.substring_index("pair", " ", 1)).when(F.col("depth") == 2, F.col("pair"))
    prefix = prefix.otherwise(F.concat_ws(" ", "pair", "third"))
    grouped = suffixes.select(_group_no("lang", prefix, groups).alias("group_no"), "lang", "pair", "third", "n")
    grouped = grouped.repartition("group_no").sortWithinPartitions("group_no")
    each = grouped.mapInArrow(_subtrees(least), "lang string, phrase string, n bigint")
    # The leaves of a pair above the budget lie in several groups; its total was counted on the way.
    if pairs is not None and any(b" " in phrase for found in extended.values() for phrase in found):
        over = pairs.where(F.col("n") > budget)
        each = each.join(F.broadcast(over.select("lang", "phrase")), ["lang", "phrase"], "left_anti").unionByName(over)
    return words, stored(each.where(F.col("n") >= least), "phrases-nodes")


def _decimal(value: str, digits: int) -> str:
    return f"cast({value} as decimal({digits}, 0))"


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    Null texts are empty, a null language is ``und``. Words and pieces of any length count;
    texts are read in parts. Repeated rows count again. An empty table gives an empty result.
    """
    words, nodes = phrase_counts(docs, text, lang, least, budget)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least).unionByName(nodes)
    frequent = stored(frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times")), "phrases-frequent")
    size = F.size(F.split("phrase", " "))

    def part(first: int, last: Column | int) -> Column:
        return F.array_join(F.slice(F.split("phrase", " "), first, last), " ")

    # Each way of cutting a candidate is a row; its parts occur as often as it does, so they are in the table.
    cuts = nodes.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("head"), part(F.col("k") + 1, size).alias("tail"))
    heads = frequent.select("lang", F.col("part").alias("head"), F.col("times").alias("l"))
    tails = frequent.select("lang", F.col("part").alias("tail"), F.col("times").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr(f"({_decimal(str(SCALE), 7)} * {_decimal('a', 15)} * {_decimal('a', 15)}) div ({_decimal('l', 15)} * {_decimal('r', 15)})")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    inner = F.explode(F.array(part(1, 2), part(2, 2))).alias("phrase")
    longer = nodes.where(size == 3).select("lang", inner, F.col("n").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left")
    dropped = F.expr(f"cast(100 as decimal(3, 0)) * longer >= cast({DROP_PERCENT} as decimal(3, 0)) * a")
    kept = kept.where(F.col("longer").isNull() | ~dropped).drop("longer")

    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part_no = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part_no")
    first = kept.select("*", F.row_number().over(Window.partitionBy("lang", part_no).orderBy(*order)).alias("in_part"))
    ranked = first.where(F.col("in_part") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
