"""A tokenizer held by the driver and the columns that encode and decode with it.

Vocabulary and merges are bounded by the vocabulary size the user trained, not by the
corpus. They are collected once, after a count check, and shipped to the tasks.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import symbols as sym
from tokenloom.functions import text as tx
from tokenloom.operators.positions import count_below

# Merges up to this number are applied by Spark expressions, more by an Arrow function; same ids either way.
EXPRESSION_MERGES = 32
# Vocabulary and merges are held by the driver and each task; a larger table is refused when it is loaded.
MAX_TOKENS = 10_000_000
# Words up to this many bytes are merged side by side, so many at once, longer ones with a queue.
_SHORT_WORD = 48
_SIDE_BY_SIDE = 1 << 16
_WORD_CACHE = 500_000
# Tokens whose ids are put in place at once.
_AT_ONCE = 1 << 18


@dataclass
class Tokenizer:
    vocab: dict[int, bytes]
    merges: list[tuple[bytes, bytes]]
    specials: list[str] = field(default_factory=list)

    def __post_init__(self):
        # Equal bytes under several ids: the greatest id is the one encoding uses.
        self.ids = {token: token_id for token_id, token in sorted(self.vocab.items())}
        missing = [s for s in self.specials if s.encode("utf-8") not in self.ids]
        if missing:
            raise ValueError(f"specials without an id, see extend_vocab: {missing}")

    @classmethod
    def from_tables(
        cls, vocab: DataFrame, merges: DataFrame, specials: list[str] = (), max_tokens: int = MAX_TOKENS
    ) -> "Tokenizer":
        """Specials that the vocabulary lacks are added after its greatest id, in the given order."""
        for name, table in (("vocabulary", vocab), ("list of merges", merges)):
            size = table.count()
            if size > max_tokens:
                raise ValueError(f"a {name} of {size} rows is more than {max_tokens}")
        entries = {r.token_id: bytes.fromhex(r.token_hex) for r in vocab.select("token_id", "token_hex").collect()}
        known, following = set(entries.values()), max(entries, default=-1) + 1
        for special in dict.fromkeys(s.encode("utf-8") for s in specials):
            if special not in known:
                entries[following] = special
                following += 1
        pairs = merges.orderBy("rank").select("left_hex", "right_hex").collect()
        return cls(entries, [(bytes.fromhex(a), bytes.fromhex(b)) for a, b in pairs], list(specials))

    def rank_order_is_exact(self) -> bool:
        """Whether applying the merges one after the other equals lowest-rank-first.

        It does if each part is a byte or made before, and no merge makes a token that an
        earlier or the same merge consumes: then once a merge has been applied everywhere,
        nothing later can give it new work. Trained merges have this property, hand-made
        lists may not.
        """
        consumed, made = set(), {bytes([b]) for b in range(256)}
        if len(set(self.merges)) < len(self.merges) or len(self.merges) + 256 > sym.MAX_SYMBOLS:
            return False
        for left, right in self.merges:
            if left not in made or right not in made:
                return False
            consumed |= {left, right}
            if left + right in consumed:
                return False
            made.add(left + right)
        return True


def ids_of_tokens(tokenizer: Tokenizer, tokens: Column, expression_merges: int = EXPRESSION_MERGES) -> Column:
    """``array<string>`` of tokens to the ``array<int>`` of their ids. Narrow: no shuffle, no join."""
    if len(tokenizer.merges) <= expression_merges and tokenizer.rank_order_is_exact():
        return ids_by_expression(tokenizer, tokens)
    return ids_by_arrow(tokenizer)(tokens)


def encode(tokenizer: Tokenizer, text: Column) -> Column:
    """A text to its token ids; ``''`` gives an empty array."""
    return ids_of_tokens(tokenizer, tx.tokens(text, tokenizer.specials))


def ids_by_expression(tokenizer: Tokenizer, tokens: Column) -> Column:
    """All tokens of a row are merged at once: fenced by a separator and joined to one string.

    A merge is then one ``replace`` per row instead of one per token, and it cannot cross
    a fence. Rows that hold the separator character themselves are merged token by token.
    """
    table = sym.SymbolTable()
    rules = [table.merge_rule(left, right) for left, right in tokenizer.merges]
    fence = sym.SEPARATOR
    fence_bytes = fence.encode("utf-8").decode("latin-1")

    specials = [s.encode("utf-8") for s in tokenizer.specials]
    singles = [sym.symbol(table.add(whole)) for whole in specials]
    ids = _ids_of_symbols(tokenizer, table)

    def merged(items: Column) -> Column:
        fenced = F.concat(F.lit(fence), F.array_join(items, fence + fence), F.lit(fence))
        row = F.replace(sym.base_word(fenced), F.lit(fence_bytes), F.lit(fence))
        for whole, single in zip(specials, singles):
            row = F.replace(row, F.lit(fence + whole.decode("latin-1") + fence), F.lit(fence + single + fence))
        return F.replace(sym.apply_rules(row, rules), F.lit(fence), F.lit(""))

    def one(token: Column) -> Column:
        found = ids(sym.apply_rules(sym.base_word(token), rules))
        for whole in specials:
            found = F.when(token == whole.decode("utf-8"), F.array(F.lit(tokenizer.ids[whole]))).otherwise(found)
        return found

    def encoded(items: Column) -> Column:
        unfenced = F.flatten(F.transform(items, one))
        is_fenced = F.contains(F.array_join(items, ""), F.lit(fence))
        return (
            F.when(F.size(items) == 0, F.array().cast("array<int>"))
            .when(is_fenced, unfenced)
            .otherwise(ids(merged(items)))
        )

    # The lambda binds the tokens, so that they are computed once per row.
    return F.get(F.transform(F.array(tokens), encoded), F.lit(0))


def _ids_of_symbols(tokenizer: Tokenizer, table: sym.SymbolTable):
    """Column function from a symbol string to ids, one array access per symbol."""
    known = [tokenizer.ids.get(token, -1) for token in table.tokens]
    numbers = sym.string_table([str(i) for i in known]).cast("array<int>")

    def token_id(character: Column) -> Column:
        found = F.get(numbers, sym.symbol_index(character, len(table.tokens)))
        if -1 in known:
            found = F.when(found >= 0, found).otherwise(F.raise_error(F.lit("token without an id")).cast("int"))
        return found

    return lambda word: F.transform(sym.characters(word), token_id)


def merge_word(word: bytes, ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """Repeat: merge the adjacent pair of lowest rank, leftmost first, until none is left."""
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    following = list(range(1, len(parts) + 1))
    preceding = list(range(-1, len(parts) - 1))
    end = len(parts)
    queue = [(rank, i, i + 1) for i in range(end - 1) if (rank := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapify(queue)

    def offer(i: int, j: int) -> None:
        rank = ranks.get((parts[i], parts[j]))
        if rank is not None:
            heappush(queue, (rank, i, j))

    while queue:
        rank, i, j = heappop(queue)
        if parts[i] is None or following[i] != j or ranks.get((parts[i], parts[j])) != rank:
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        following[i] = following[j]
        if following[j] < end:
            preceding[following[j]] = i
            offer(i, following[j])
        if preceding[i] >= 0:
            offer(preceding[i], i)
    return [part for part in parts if part is not None]


class MergeTable:
    """The merges as arrays over symbols: numbers of the bytes 0-255 and of every token that a merge names or makes."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        self.tokens = list(dict.fromkeys([*(bytes([b]) for b in range(256)), *(t for l, r in merges for t in (l, r, l + r))]))
        number = {token: i for i, token in enumerate(self.tokens)}
        # A pair listed twice keeps its last rank.
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.no_rank = len(merges)
        rules = sorted((number[l] * len(self.tokens) + number[r], rank, number[l + r]) for (l, r), rank in self.ranks.items())
        self.pairs, self.pair_ranks = (np.array([rule[i] for rule in rules], dtype=np.int64) for i in (0, 1))
        self.made = np.zeros(self.no_rank + 1, dtype=np.int64)
        self.made[self.pair_ranks] = [rule[2] for rule in rules]
        left, right = np.divmod(self.pairs, len(self.tokens))
        self.doubles = np.zeros(self.no_rank + 1, dtype=bool)
        self.doubles[self.pair_ranks] = left == right
        # The lowest rank of the pairs that hold a token: where it is higher than that of its own merge, nothing made by
        # the merge comes before another place of the same pair, so all places of a word are merged at once.
        lowest = np.full(len(self.tokens), self.no_rank, dtype=np.int64)
        np.minimum.at(lowest, left, self.pair_ranks)
        np.minimum.at(lowest, right, self.pair_ranks)
        self.at_once = lowest[self.made] > np.arange(self.no_rank + 1)
        self.ids = ids
        self.symbol_ids = np.array([ids.get(token, 0) for token in self.tokens], dtype=np.int32)
        self.has_id = np.array([token in ids for token in self.tokens])

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(left), self.no_rank, dtype=np.int64)
        pairs = left * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], self.no_rank)

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all, in order."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        short = lengths <= _SHORT_WORD
        sizes = np.zeros(len(words), dtype=np.int64)
        side_by_side = [word for word, is_short in zip(words, short.tolist()) if is_short]
        parts = [self._short_ids(side_by_side[i : i + _SIDE_BY_SIDE]) for i in range(0, len(side_by_side), _SIDE_BY_SIDE)]
        sizes[short] = np.concatenate([np.empty(0, dtype=np.int64), *(n for n, _ in parts)])
        short_pool = np.concatenate([np.empty(0, dtype=np.int32), *(own for _, own in parts)])
        longer = [[self.ids[part] for part in merge_word(words[i], self.ranks)] for i in np.flatnonzero(~short).tolist()]
        sizes[~short] = [len(own) for own in longer]
        pool, is_short = np.empty(int(sizes.sum()), dtype=np.int32), np.repeat(short, sizes)
        pool[is_short], pool[~is_short] = short_pool, [i for own in longer for i in own]
        return sizes, pool

    def _short_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge_word`` for many words side by side: each round merges the pair of lowest rank of each word."""
        n_words = len(words)
        symbols = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        word = np.repeat(np.arange(n_words), [len(w) for w in words])
        done = []
        ranks = np.full(len(symbols), self.no_rank, dtype=np.int64)  # of a symbol and the next one
        inner = np.flatnonzero(word[1:] == word[:-1])
        ranks[inner] = self.rank_of(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(ranks, starts)
            open_words = best < self.no_rank
            if not open_words.all():
                kept = np.repeat(open_words, sizes)
                done.append((word[~kept], symbols[~kept]))
                symbols, word, ranks = symbols[kept], word[kept], ranks[kept]
                best, sizes = best[open_words], sizes[open_words]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == np.repeat(best, sizes))
            rank = ranks[at]
            first = np.append(True, word[at[1:]] != word[at[:-1]])
            taken = first | self.at_once[rank]
            if self.doubles[rank].any():
                # Of places that overlap, every other one from the left.
                new = first | np.append(True, np.diff(at) > 1)
                place = np.arange(len(at))
                taken &= ~self.doubles[rank] | ((place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0)
            at = at[taken]
            symbols[at] = self.made[rank[taken]]
            left = np.ones(len(symbols), dtype=bool)
            left[at + 1] = False
            at -= np.arange(len(at))
            symbols, word, ranks = symbols[left], word[left], ranks[left]
            # Only pairs with a symbol that is new have another rank.
            near = np.concatenate([at, at[at > 0] - 1])
            near = near[near < len(symbols) - 1]
            ranks[at] = self.no_rank
            near = near[word[near] == word[near + 1]]
            ranks[near] = self.rank_of(symbols[near], symbols[near + 1])
        word, symbols = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in zip(*done)) if done else (word, symbols)
        order = np.argsort(word, kind="stable")
        word, symbols = word[order], symbols[order]
        if not self.has_id[symbols].all():
            raise KeyError(self.tokens[int(symbols[~self.has_id[symbols]][0])])
        return np.bincount(word, minlength=n_words), self.symbol_ids[symbols]


def gathered(lists: pa.Array, codes: np.ndarray, sizes: np.ndarray, pool: np.ndarray, at_once: int = _AT_ONCE) -> pa.ListArray:
    """Lists of ids in place of lists of tokens: token i has code ``codes[i]``, whose ids are ``sizes[code]`` many in the pool.

    Beside the ids, only what a part of the tokens needs is held; a list may be longer than a part.
    """
    bounds, places = list_bounds(lists), np.cumsum(sizes) - sizes
    offsets, n_values = np.zeros(len(bounds), dtype=np.int64), 0
    values = np.empty(sum(int(sizes[codes[low : low + at_once]].sum()) for low in range(0, len(codes), at_once)), dtype=np.int32)
    for low in range(0, len(codes), at_once):
        own = codes[low : low + at_once]
        lengths = sizes[own]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(places[own] - ends[:-1], lengths)
        at += np.arange(len(at))
        values[n_values : n_values + len(at)] = pool[at]
        # Lists that end in this part.
        first, last = np.searchsorted(bounds, [low, low + len(own)], side="right")
        offsets[first:last] = n_values + ends[bounds[first:last] - low]
        n_values += len(at)
    mask = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()), mask=mask)


def list_bounds(lists: pa.Array) -> np.ndarray:
    """Where each list begins among the values of all, and the end."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)])


def ids_by_arrow(tokenizer: Tokenizer):
    """Arrow function from lists of tokens to lists of ids.

    Each batch is reduced to its distinct tokens by Arrow; only words the task has not
    met before are merged, side by side, everything else is a vectorized gather.
    """
    table = MergeTable(tokenizer.merges, tokenizer.ids)
    whole = {special: tokenizer.ids[special.encode("utf-8")] for special in tokenizer.specials}

    def only_specials() -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        """The words met, by number; how many ids each has; the ids of all, in order."""
        return dict(zip(whole, range(len(whole)))), np.ones(len(whole), dtype=np.int64), np.array(list(whole.values()), dtype=np.int32)

    @F.arrow_udf("array<int>")
    def token_lists_to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers, sizes, pool = only_specials()
        for lists in batches:
            words = lists.flatten().dictionary_encode()
            distinct = words.dictionary.to_pylist()
            new = [word for word in distinct if word not in numbers]
            if len(numbers) + len(new) > _WORD_CACHE:
                numbers, sizes, pool = only_specials()
                new = [word for word in distinct if word not in numbers]
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new))))
            merged = table.word_ids([word.encode("utf-8") for word in new])
            sizes, pool = np.concatenate([sizes, merged[0]]), np.concatenate([pool, merged[1]])
            codes = np.fromiter(map(numbers.__getitem__, distinct), dtype=np.int64, count=len(distinct))
            indices = words.indices.to_numpy(zero_copy_only=False)
            yield gathered(lists, codes[indices] if len(indices) else codes, sizes, pool)

    return token_lists_to_ids


def encode_documents(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replaces the text of each row by its token ids."""
    return docs.withColumn(ids, encode(tokenizer, F.col(text))).drop(text)


def encode_words(words: DataFrame, tokenizer: Tokenizer, token: str = "token") -> DataFrame:
    """Adds the ids of each distinct word."""
    return words.withColumn("ids", ids_of_tokens(tokenizer, F.array(F.col(token))))


def _lookup(tokenizer: Tokenizer, ids: Column) -> Column:
    """Ids to the hex of their tokens, null for an id that is null or unknown; null for null.

    The table has one entry for each id that exists, in order. Where the ids have no gaps an
    id is its place; else the place is found by halving steps over the ids.
    """
    known = sorted(tokenizer.vocab)
    hexes = sym.string_table([tokenizer.vocab[i].hex().upper() for i in known])

    def place(token_id: Column) -> Column:
        if not known or known[-1] - known[0] + 1 == len(known):
            return token_id - F.lit(known[0]) if known and known[0] else token_id
        numbers = sym.string_table([str(i) for i in known]).cast("array<int>")
        at = count_below(numbers, len(known), token_id)
        return F.when(F.get(numbers, at) == token_id, at)

    return F.transform(ids, lambda i: F.get(hexes, place(i)))


def _known(found: Column) -> Column:
    """An id that is null or unknown is an error."""
    return F.coalesce(found, F.raise_error(F.lit("unknown token id")))


def decode(tokenizer: Tokenizer, ids: Column) -> Column:
    """Ids to text, malformed bytes as U+FFFD; null ids give null.

    The bytes of a token are one array access away, so decoding neither explodes nor joins.
    """
    # What is unknown is no hex, so one look at the bytes of a row tells.
    joined = F.array_join(_lookup(tokenizer, ids), "", "?")
    return F.when(ids.isNotNull(), tx.utf8_replace(_known(F.unhex(joined))))


def decode_each(tokenizer: Tokenizer, ids: Column) -> Column:
    """Each id decoded on its own."""
    return F.transform(_lookup(tokenizer, ids), lambda h: tx.utf8_replace(F.unhex(_known(h))))


def decode_documents(encoded: DataFrame, tokenizer: Tokenizer, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text``; one row per row, also where keys repeat."""
    return encoded.select(key, decode(tokenizer, F.col(ids)).alias("text"))


def token_strings(encoded: DataFrame, tokenizer: Tokenizer, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, pos, token_text``."""
    return encoded.select(key, F.posexplode(decode_each(tokenizer, F.col(ids))).alias("pos", "token_text"))


def token_counts(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """``token_id, n`` over all rows, specials included."""
    return encoded.select(F.explode(ids).alias("token_id")).groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))


def roundtrip_mismatches(docs: DataFrame, tokenizer: Tokenizer, text: str = "text") -> DataFrame:
    """Rows, and rows whose text does not come back from its ids. One narrow pass and one sum."""
    back = decode(tokenizer, encode(tokenizer, F.col(text)))
    return docs.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum((~back.eqNullSafe(F.col(text))).cast("long")), F.lit(0)).alias("n_bad")
    )
