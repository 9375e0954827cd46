"""Exact byte-level BPE training on an inverted index of words.

The index is a table of postings: one row for each word and each distinct pair of adjacent
tokens in it, partitioned by pair. A merge touches only words below the pairs it merges, and
these are read from the partitions of those pairs. A changed word leaves its postings by
rows with the negative count and enters the ones of its new form, so the index is kept by
differences, which are put together once they outgrow it; pair counts likewise.

A round takes many merges. It ranks the pairs and reads the *runs* of the best ones: the
longest stretches of words in which each adjacent pair is a candidate. Runs are summed
over all words, and as long as the best count lies above that of every pair outside, the
merges done on the runs are the merges of the corpus (see ``planned``). Only ranked pairs
and runs, both bounded in number, reach the driver.
"""

import math
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import symbols as sym
from tokenloom.operators import vocab as vb
from tokenloom.operators import words as wd
from tokenloom.session import delete, shared_folder


@dataclass
class TrainedBpe:
    vocab: DataFrame
    merges: DataFrame


#: Pairs that are ranked in a round at most, and runs of them that may reach the driver: with more runs, fewer pairs are taken.
CANDIDATES = 1024
RUNS = 100_000
#: Words of one partition of the index.
WORDS_PER_TASK = 200_000
#: Postings that a task sorts and writes, about.
POSTINGS_PER_TASK = 1 << 18
#: Differences are put together with the index after so many rounds, or when they hold as many rows.
ROUNDS_PER_EPOCH = 8


def _greater_first(token: bytes) -> tuple[int, ...]:
    """A key under which greater byte strings come first."""
    return (*(255 - b for b in token), 256)


def planned(runs: Iterable[tuple[str, int]], table: sym.SymbolTable, floor: int, known, limit: int) -> list[str]:
    """Merge rules, in order, that one-by-one training does next, from ``run, n``.

    Every candidate pair lies inside runs, with its neighbours as far as these are candidates,
    too; so the counts of pairs inside are exact at the start and after each merge. A pair
    across the border of a run, whatever its two tokens have grown to, occurs at most as
    often as the pair of symbols at that border, which is no candidate: ``floor`` at most. So
    a merge whose count is above ``floor`` is the next one. That holds as long as a token is
    made in one way: a merge whose bytes are already a token is done, but is the last one.
    """
    texts, times = [], []
    counts: dict[str, int] = defaultdict(int)
    where: dict[str, set[int]] = defaultdict(set)
    for i, (run, n) in enumerate(runs):
        texts.append(run)
        times.append(n)
        for at in range(len(run) - 1):
            counts[run[at : at + 2]] += n
            where[run[at : at + 2]].add(i)

    def entry(pair: str):
        return -counts[pair], *(_greater_first(table.token_of(c)) for c in pair), pair

    queue, rules = [entry(pair) for pair in counts], []
    heapify(queue)
    while len(rules) < limit and queue:
        n, _, _, pair = heappop(queue)
        if counts.get(pair, 0) != -n:
            continue  # its count has changed since, and a newer entry is in the queue
        if -n <= floor:
            break
        left, right = (table.token_of(c) for c in pair)
        last = left + right in known or left + right in table.index
        rules.append(table.merge_rule(left, right))
        if last:
            break
        joined = rules[-1][2]
        changes: dict[str, int] = defaultdict(int)
        for i in where.pop(pair):
            old, own = texts[i], times[i]
            new = texts[i] = old.replace(pair, joined)
            if new == old:
                continue
            for at in range(len(old) - 1):
                changes[old[at : at + 2]] -= own
            for at in range(len(new) - 1):
                changes[new[at : at + 2]] += own
                if joined in new[at : at + 2]:
                    where[new[at : at + 2]].add(i)
        for pair, change in changes.items():
            if not change:
                continue
            counts[pair] += change
            if counts[pair] > 0:
                heappush(queue, entry(pair))
            else:
                del counts[pair]
    return rules


def _point(character: str) -> str:
    return f"\\x{{{ord(character):x}}}"


def _starts(pairs: Iterable[str]) -> str:
    """Pattern of a symbol with which one of the pairs starts."""
    after: dict[str, list[str]] = defaultdict(list)
    for left, right in sorted(pairs):
        after[left].append(right)
    return "|".join(f"{_point(left)}(?=[{''.join(map(_point, rights))}])" for left, rights in after.items())


def _any_of(pairs: Iterable[str]) -> str:
    return f"(?s)(?:{_starts(pairs)})."


def runs_of(word: Column, pairs: Iterable[str]) -> Column:
    """The longest stretches of a word whose adjacent pairs are all among ``pairs``."""
    # Possessive, so that a run of any length is matched without recursion.
    return F.regexp_extract_all(word, F.lit(f"(?s)(?:{_starts(pairs)})++."), F.lit(0))


# Long words are cut into pieces that overlap by one symbol, because finding the i-th symbol of a string takes i steps.
_DISTINCT_PAIRS = """array_distinct(flatten(transform(sequence(0, (length(word) - 2) div 64), p ->
    transform(sequence(1, least(64, length(word) - 1 - 64 * p)), i -> substr(substr(word, 64 * p + 1, 65), i, 2)))))"""


class _Index:
    """Postings and pair counts of one training, in folders below the shared one."""

    def __init__(self, spark: SparkSession, folder: str, words_per_task: int, rounds_per_epoch: int):
        # An own session, so that the settings do not leak into the caller's.
        self.spark, self.folder = spark.newSession(), folder
        self.words_per_task, self.rounds_per_epoch = words_per_task, rounds_per_epoch
        self.table = sym.SymbolTable()
        self.step, self.rows, self.added = 0, 0, 0
        self.parts: list[str] = []
        self.words: DataFrame | None = None

    def start(self, words: DataFrame, n_words: int) -> None:
        cores = self.spark.sparkContext.defaultParallelism
        # Small tables spread over the cores, large ones over partitions of a fixed size.
        self.buckets = max(1, math.ceil(n_words / self.words_per_task), min(cores, math.ceil(n_words / 4_000)))
        self.spark.conf.set("spark.sql.shuffle.partitions", str(self.buckets))
        self.spark.conf.set("spark.sql.adaptive.enabled", "false")
        # Inferring constraints from long rules costs more than it saves.
        self.spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
        # The index is made of the words as the first round leaves them, which changes nearly all.
        self.words = words
        self._replace_pairs(wd.pair_counts(words))

    def _written(self, words: DataFrame) -> tuple[DataFrame, str]:
        self.step += 1
        path = f"{self.folder}/words-{self.step}"
        words.write.parquet(path)
        return self.spark.read.schema("word string, n bigint").parquet(path), path

    def _bucket(self, pair: str) -> Column:
        return F.pmod(F.xxhash64(pair), F.lit(self.buckets)).cast("int")

    def _add(self, words: DataFrame) -> int:
        """Postings of ``word, n`` in a folder of their own; how many."""
        several = words.where("length(word) > 1")
        rows = several.select(F.explode(F.expr(_DISTINCT_PAIRS)).alias("pair"), "word", "n")
        return self._add_rows(rows, several.agg(F.coalesce(F.sum(F.length("word") - 1), F.lit(0)).alias("most")).first()["most"])

    def _add_rows(self, rows: DataFrame, most: int) -> int:
        """Writes postings, ``most`` at most. A frequent pair has as many as there are words with it, so a bucket is dealt to several tasks."""
        self.step += 1
        path = f"{self.folder}/postings-{self.step}"
        shares = max(1, math.ceil(most / (self.buckets * POSTINGS_PER_TASK)))
        task = F.col("bucket") * shares + F.pmod(F.xxhash64("word"), F.lit(shares)).cast("int")
        dealt = rows.withColumn("bucket", self._bucket("pair")).repartitionById(self.buckets * shares, task)
        dealt.sortWithinPartitions("bucket", "pair").write.partitionBy("bucket").parquet(path)
        self.parts.append(path)
        return self._read([path]).count()

    def _read(self, paths: list[str]) -> DataFrame:
        schema = "pair string, word string, n bigint, bucket int"
        tables = [self.spark.read.schema(schema).parquet(path) for path in paths]
        while len(tables) > 1:
            tables = [a.unionByName(b) for a, b in zip(tables[::2], tables[1::2])] + tables[len(tables) // 2 * 2 :]
        return tables[0]

    def _replace_pairs(self, counts: DataFrame) -> None:
        self.step += 1
        before, path = getattr(self, "pairs_path", None), f"{self.folder}/pairs-{self.step}"
        counts.write.parquet(path)
        self.pairs_path, self.pairs = path, self.spark.read.schema("pair string, n bigint").parquet(path)
        if before:
            delete(self.spark, before)

    def ranked(self, candidates: int) -> list[tuple[str, int]]:
        """The best pairs: most frequent, ties to the greater left, then right bytes."""
        hexes, n = self.table.hex_literal(), len(self.table.tokens)
        sides = (F.get(hexes, sym.symbol_index(F.substr("pair", F.lit(i), F.lit(1)), n)) for i in (1, 2))
        top = self.pairs.orderBy(F.desc("n"), *(side.desc() for side in sides)).limit(candidates).collect()
        return [(r["pair"], r["n"]) for r in top]

    def below(self, pairs: list[str]) -> DataFrame:
        """``word, n``: words with any of the pairs, each by the posting of the first of them in it.

        Only the partitions of these pairs are read. A word that has changed since comes
        with its count and with its negative count, which cancel out in every sum.
        """
        if not self.parts:
            return self.words.where(F.rlike("word", F.lit(_any_of(pairs))))
        known = self._known(pairs)
        buckets = [r["bucket"] for r in known.select(self._bucket("pair").alias("bucket")).distinct().collect()]
        rows = self._read(self.parts).where(F.col("bucket").isin(buckets)).join(F.broadcast(known), "pair", "left_semi")
        first = F.regexp_extract("word", _any_of(pairs), 0)
        return rows.where(first == F.col("pair")).select("word", "n")

    def _known(self, pairs: list[str]) -> DataFrame:
        """Pairs of one round, of which there are few."""
        return self.spark.createDataFrame([(p,) for p in pairs], "pair string")

    def runs(self, pairs: list[str], limit: int) -> list[tuple[str, int]] | None:
        """``run, n`` summed over all words, or nothing if there are more than ``limit``."""
        each = self.below(pairs).select(F.explode(runs_of(F.col("word"), pairs)).alias("run"), "n")
        found = each.groupBy("run").agg(F.sum("n").alias("n")).where("n > 0").limit(limit + 1).collect()
        return None if len(found) > limit else [(r["run"], r["n"]) for r in found]

    def merge(self, rules: list[str], first: list[str]) -> None:
        """Applies the rules to the words below their first pairs and takes the differences into the index.

        Early merges change most words; then the index is made anew from its own words.
        """
        if not self.parts or self._read(self.parts).join(F.broadcast(self._known(first)), "pair", "left_semi").count() * 4 > self.rows:
            self._rebuild(rules)
            return
        rows = self.below(first).withColumn("new", sym.apply_rules(F.col("word"), rules)).where("new <> word")
        # Rows of one word that cancel out go here.
        changed = rows.groupBy("word", "new").agg(F.sum("n").alias("n")).where("n <> 0")
        both = F.explode(F.array(F.struct("word", (-F.col("n")).alias("n")), F.struct(F.col("new").alias("word"), "n"))).alias("w")
        words, path = self._written(changed.select(both).select("w.*"))
        self.added += self._add(words)
        union = self.pairs.unionByName(wd.pair_counts(words).where("n <> 0"))
        self._replace_pairs(union.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0"))
        delete(self.spark, path)
        if len(self.parts) > self.rounds_per_epoch or self.added > self.rows:
            self._compact()

    def _rebuild(self, rules: list[str]) -> None:
        old, every = self.parts, self.words
        if old:
            # Each word once: below the pair that it starts with.
            rows = self._read(old).where(F.col("pair") == F.substr("word", F.lit(1), F.lit(2)))
            every = rows.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")
        words, path = self._written(every.select(sym.apply_rules(F.col("word"), rules).alias("word"), "n"))
        self.parts, self.words = [], None
        self.rows, self.added = self._add(words), 0
        self._replace_pairs(wd.pair_counts(words))
        for folder in (*old, path):
            delete(self.spark, folder)

    def _compact(self) -> None:
        old = self.parts
        whole = self._read(old).groupBy("pair", "word").agg(F.sum("n").alias("n")).where("n > 0")
        self.parts = []
        self.rows, self.added = self._add_rows(whole, self.rows + self.added), 0
        for path in old:
            delete(self.spark, path)


def learn_merges(
    counts: DataFrame,
    limit: int,
    candidates: int = CANDIDATES,
    runs: int = RUNS,
    words_per_task: int = WORDS_PER_TASK,
    rounds_per_epoch: int = ROUNDS_PER_EPOCH,
    known: set[bytes] = frozenset(),
) -> list[tuple[bytes, bytes]]:
    """Up to ``limit`` merges, in order, learned from ``token, is_special, n``."""
    spark = counts.sparkSession
    folder = shared_folder(spark, "train")
    index = _Index(spark, folder, words_per_task, rounds_per_epoch)
    merges: list[tuple[bytes, bytes]] = []
    try:
        words = wd.word_table(counts)
        n_words = words.count()
        # Many words have many runs.
        taken = candidates if n_words <= runs else max(1, candidates // 8)
        index.start(words, n_words)
        while len(merges) < limit:
            ranked = index.ranked(taken + 1)
            if not ranked:
                break
            rules, own = [], taken
            while not rules:
                pairs = [pair for pair, _ in ranked[:own]]
                floor = ranked[own][1] if len(ranked) > own else 0
                # A single pair needs no runs: the best pair is always the next merge.
                found = index.runs(pairs, runs) if own > 1 and ranked[0][1] > floor else []
                if found is None:
                    own = taken = max(1, own // 4)
                    continue
                rules = planned(found, index.table, floor, known, limit - len(merges))
                if not rules:
                    rules = [index.table.merge_rule(*(index.table.token_of(c) for c in ranked[0][0]))]
            if found and len(found) * 8 < runs:
                taken = min(candidates, taken * 2)
            merges += [tuple(index.table.token_of(c) for c in rule[:2]) for rule in rules]
            if len(merges) < limit:
                # Every word that changes holds one of the merged pairs already now.
                before = set(pairs)
                index.merge(rules, [rule[:2] for rule in rules if rule[:2] in before])
    finally:
        delete(spark, folder)
    return merges


def train_bpe(
    docs: DataFrame, vocab_size: int, specials: list[str] = (), text: str = "text", **loop_options
) -> TrainedBpe:
    """Vocabulary and merges of a corpus. No words at all gives two empty tables."""
    spark, specials = docs.sparkSession, list(specials)
    folder = shared_folder(spark, "counts")
    try:
        # Pre-tokenizing is the one pass over the corpus; its result is kept, not recomputed.
        wd.pretoken_counts(docs, specials, text).write.parquet(folder)
        return train_from_counts(spark.read.parquet(folder), vocab_size, specials, **loop_options)
    finally:
        delete(spark, folder)


def train_from_counts(counts: DataFrame, vocab_size: int, specials: list[str] = (), **loop_options) -> TrainedBpe:
    spark = counts.sparkSession
    if counts.isEmpty():
        return TrainedBpe(spark.createDataFrame([], vb.VOCAB_SCHEMA), spark.createDataFrame([], vb.MERGES_SCHEMA))
    entries = vb.base_entries(list(specials))
    wanted = max(0, vocab_size - len(entries))
    known = {token for _, token, _ in entries}
    merges = learn_merges(counts, wanted, known=known, **loop_options) if wanted else []
    learned = [(len(entries) + rank, left + right, False) for rank, (left, right) in enumerate(merges)]
    return TrainedBpe(vb.vocab_frame(spark, entries + learned), vb.merges_frame(spark, merges))
