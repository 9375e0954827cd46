"""Passages that repeat across documents, by compact windows.

Words become shingles, and each of a few hash functions makes a Cartesian tree of a
document's shingle hashes. A node of the tree stands for all subsequences between its
bounds that have it as their minimum: one row instead of many subsequences. Rows with equal
minima meet, and in a large group those with equal shingles around it; where enough functions agree on overlapping intervals of two documents, the
passages are compared shingle by shingle.
"""

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import as_bytes, run_starts, stored, whole_groups

SHINGLE = 5
LEAST_WORDS = 50
#: A passage of LEAST_WORDS words has so many shingles.
LEAST = LEAST_WORDS - SHINGLE + 1
SIMILARITY = 0.8
#: Hash functions, and how many must agree on a pair of intervals.
FUNCTIONS = 4
AGREE = 2
SEED = 3
#: Shingles of a stretch beside a minimum, and stretches on each side: a passage holds three in a row of them at least.
STRETCH = 11
STRETCHES = 3
#: Rows of a group that are all linked with each other.
SMALL = 3
#: Words of documents handled at once.
TOGETHER = 1 << 19


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed permutation of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(data: bytes) -> np.ndarray:
    """A hash for each SHINGLE words in a row; words are runs of anything but ASCII white space, A-Z in lower case."""
    words = data.lower().split()
    if len(words) < SHINGLE:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(each) - SHINGLE + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
    return _mixed(total)


def tree_windows(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``place, low, high`` of the tree nodes with ``least`` values or more between their bounds, ends included.

    Zeros part the sequence; one must stand at each end. Of equal values the left one is smaller.
    """
    padded = np.append(values, np.zeros(least, dtype=values.dtype))
    small, at = padded, np.arange(len(padded))
    width = 1
    while width < least:
        step = min(width, least - width)
        left = small[:-step] <= small[step:]
        at = np.where(left, at[:-step], at[step:])
        small = np.where(left, small[:-step], small[step:])
        width += step
    # The least of each window of ``least`` values. A bound of such a node is such a node too.
    nodes = at[np.append(True, at[1:] != at[:-1])]
    nodes = nodes[nodes < len(values)]
    own = padded[nodes].tolist()
    low, high, stack = [0] * len(nodes), [0] * len(nodes), []
    where = nodes.tolist()
    for i, (value, place) in enumerate(zip(own, where)):
        while stack and own[stack[-1]] > value:
            high[stack.pop()] = place - 1
        low[i] = where[stack[-1]] + 1 if stack and value else place
        stack.append(i)
    ends = len(values) - 1
    for i in stack:
        high[i] = ends
    inner = np.array(own, dtype=np.uint64) > 0
    return nodes[inner], np.array(low, dtype=np.int64)[inner], np.array(high, dtype=np.int64)[inner]


def surroundings(flat: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """For each place, 16 bits for each stretch beside it: left and right, the nearest first; 0 if it leaves the document."""
    n, wide = len(flat), STRETCH * STRETCHES + 1
    padded, outside = np.zeros(n + 2 * wide, dtype=np.uint64), np.ones(n + 2 * wide, dtype=np.int64)
    padded[wide : wide + n], outside[wide : wide + n] = flat, gap
    starts = len(padded) - STRETCH + 1
    total = np.zeros(starts, dtype=np.uint64)
    for i in range(STRETCH):
        total = total * np.uint64(0x9E3779B97F4A7C15) + padded[i : i + starts]
    counts = np.concatenate([[0], np.cumsum(outside)])
    bits = np.maximum((_mixed(total) >> np.uint64(48)).astype(np.uint16), np.uint16(1))
    bits[counts[STRETCH:] > counts[:-STRETCH]] = 0
    at = np.arange(wide, wide + n)
    sides = [(at - STRETCH * k, at + 1 + STRETCH * (k - 1)) for k in range(1, STRETCHES + 1)]
    return np.stack([bits[x] for pair in sides for x in pair], axis=1)


# A window row has its surroundings in the places of its partner: two stretches in each number.
def _packed(around: np.ndarray) -> list[np.ndarray]:
    return list(np.ascontiguousarray(around).view(np.int32).T)


def _unpacked(numbers: list[np.ndarray]) -> np.ndarray:
    return np.ascontiguousarray(np.stack(numbers, axis=1).astype(np.int32)).view(np.uint16)


WINDOW_SCHEMA = ("place bigint, function int, a bigint, a_at int, a_low int, a_high int, "
                 "b bigint, b_at int, b_low int, b_high int")
COLUMNS = [c.split()[0] for c in WINDOW_SCHEMA.split(", ")]
_TYPES = [pa.int64(), pa.int32()] + 2 * [pa.int64(), pa.int32(), pa.int32(), pa.int32()]


def _batch(columns: list, fields=tuple(zip(COLUMNS, _TYPES))) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _windows_of(ids: list[int], hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Windows of some documents. Of windows with equal minima and surroundings the first goes on alone, linked to the others here."""
    parts, starts, at = [np.zeros(1, dtype=np.uint64)], [], 1
    for own in hashes:
        starts.append(at)
        parts += [own, np.zeros(1, dtype=np.uint64)]
        at += len(own) + 1
    flat, starts = np.concatenate(parts), np.array(starts)
    gap = np.ones(len(flat), dtype=bool)
    for start, own in zip(starts.tolist(), hashes):
        gap[start : start + len(own)] = False
    numbers = np.array(ids, dtype=np.int64)
    around = surroundings(flat, gap)
    for function in range(FUNCTIONS):
        seed = np.uint64(xxhash.xxh64_intdigest(bytes([function]), SEED))
        values = np.maximum(_mixed(flat ^ seed), np.uint64(1))
        values[gap] = 0
        place, low, high = tree_windows(values, LEAST)
        if not len(place):
            continue
        doc = np.searchsorted(starts, place, side="right") - 1
        key = values[place]
        order = np.lexsort((place, doc, key))
        key, doc, place, low, high = key[order], doc[order], place[order], low[order], high[order]
        # A shingle that recurs in a document has the widest bounds, in one row for each of its surroundings.
        firsts = run_starts([key, doc])
        sizes = np.diff(np.append(firsts, len(key)))
        low, high = np.repeat(np.minimum.reduceat(low, firsts), sizes), np.repeat(np.maximum.reduceat(high, firsts), sizes)
        sides = _packed(around[place])
        order = np.lexsort((place, doc, *sides, key))
        order = order[run_starts([x[order] for x in (key, *sides, doc)])]
        key, doc, place, low, high, *sides = (x[order] for x in (key, doc, place, low, high, *sides))
        base = starts[doc]
        place, low, high = place - base, low - base, high - base
        new = np.zeros(len(key), dtype=bool)
        new[run_starts([key, *sides])] = True
        lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        signed = key.view(np.int64)
        n = int(new.sum())
        yield _batch([signed[new], np.full(n, function), numbers[doc[new]], place[new], low[new], high[new],
                      pa.nulls(n), *(x[new] for x in sides)])
        head, rest = _chained(lead)
        if len(rest):
            # These rows need no partner, so they are spread by their own document.
            yield _link_batch(numbers[doc[rest]], np.full(len(rest), function), [numbers[doc], place, low, high], head, rest)


def _chained(lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, given the first row of each row's group: every other row with the first and with the one before it."""
    rest = np.flatnonzero(lead != np.arange(len(lead)))
    later = rest[rest - 1 != lead[rest]]
    return np.concatenate([lead[rest], later - 1]), np.concatenate([rest, later])


def _link_batch(place: np.ndarray, function: np.ndarray, sides: list[np.ndarray], head: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
    """Link rows between rows of ``sides`` (document, place, low, high); the smaller document comes first."""
    turned = sides[0][head] > sides[0][rest]
    a, b = np.where(turned, rest, head), np.where(turned, head, rest)
    return _batch([place, function, *(x[a] for x in sides), *(x[b] for x in sides)])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window rows, link rows, and for each copy of a text met before in this task one link with function -1."""
    seen: dict[bytes, tuple[int, int]] = {}
    for batch in batches:
        ids, hashes, held = [], [], 0
        copies = []
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if number is None:
                continue
            data = as_bytes(text.as_py())
            digest = xxhash.xxh3_128_digest(data)
            if digest in seen:
                first, n = seen[digest]
                if n and first != number:
                    copies.append((number, first, n))
                continue
            own = shingle_hashes(data)
            if len(own) < LEAST:
                seen[digest] = (number, 0)
                continue
            seen[digest] = (number, len(own))
            ids.append(number)
            hashes.append(own)
            held += len(own)
            if held >= TOGETHER:
                yield from _windows_of(ids, hashes)
                ids, hashes, held = [], [], 0
        if ids:
            yield from _windows_of(ids, hashes)
        if copies:
            numbers, firsts, sizes = (list(x) for x in zip(*copies))
            zeros, ends = [0] * len(copies), [n - 1 for n in sizes]
            yield _batch([numbers, [-1] * len(copies), firsts, zeros, zeros, ends, numbers, zeros, zeros, ends])


def _met(starts: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the same group: all of a small one, else each row with the first ones that share what surrounds it.

    Each row also meets the first one of the group and the one before it. Unrelated documents around a frequent shingle
    differ in a stretch beside it, while those with a common passage share three in a row.
    """
    n = len(around)
    sizes = np.diff(np.append(starts, n))
    group, size = np.repeat(np.arange(len(starts)), sizes), np.repeat(sizes, sizes)
    pairs = [_chained(np.repeat(starts, sizes))]
    large = np.flatnonzero(size > SMALL)
    if len(large):
        # Stretches from left to right; three in a row, two, or one may be what is shared.
        places = [*range(2 * STRETCHES - 2, -1, -2), *range(1, 2 * STRETCHES, 2)]
        group, around = group[large], around[large][:, places].astype(np.int64)
        for width in (3, 2, 1):
            for low in range(2 * STRETCHES - width + 1):
                shared = [around[:, i] for i in range(low, low + width)]
                full = np.flatnonzero(np.all([x != 0 for x in shared], axis=0))
                first = [group[full], *(x[full] for x in shared)]
                # The first by document, so that all functions link the same ones.
                order = np.lexsort((full, *first))
                runs = run_starts([x[order] for x in first])
                rows = large[full[order]]
                pairs.append((np.repeat(rows[runs], np.diff(np.append(runs, len(rows)))), rows))
    head, rest = (np.concatenate(x) for x in zip(*pairs))
    head, rest = np.minimum(head, rest), np.maximum(head, rest)
    once = np.unique(head[head != rest] * n + rest[head != rest])
    return once // n, once % n


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link rows, and links of each group of equal minima."""
    for table in whole_groups(batches, ["place"]):
        done = table.filter(table["b"].is_valid())
        for batch in done.to_batches():
            if batch.num_rows:
                yield batch
        rows = table.filter(table["b"].is_null())
        if not rows.num_rows:
            continue
        place, function, *sides = (rows[c].to_numpy() for c in COLUMNS[:6])
        around = _unpacked([rows[c].to_numpy() for c in COLUMNS[7:]])
        head, rest = _met(run_starts([place, function]), around)
        apart = sides[0][head] != sides[0][rest]
        head, rest = head[apart], rest[apart]
        if len(rest):
            yield _link_batch(place[rest], function[rest], sides, head, rest)


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pair of documents, the pairs of intervals on which AGREE functions or more agree."""
    for table in whole_groups(batches, ["a", "b"]):
        columns = {c: table[c].to_numpy() for c in COLUMNS[1:]}
        starts = run_starts([columns["a"], columns["b"]])
        out = [[] for _ in range(6)]
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
            part = {c: v[start:end] for c, v in columns.items()}
            for inside in _overlapping(part["a_low"], part["a_high"], np.arange(end - start)):
                for rows in _overlapping(part["b_low"], part["b_high"], inside):
                    if len(set(part["function"][rows].tolist())) >= AGREE:
                        found = (part["a"][0], part["a_low"][rows].min(), part["a_high"][rows].max(),
                                 part["b"][0], part["b_low"][rows].min(), part["b_high"][rows].max())
                        for column, value in zip(out, found):
                            column.append(int(value))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "a_low", "a_high", "b", "b_low", "b_high"])


def _overlapping(low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The rows in groups of intervals that overlap, directly or by way of others."""
    rows = rows[np.argsort(low[rows], kind="stable")]
    reach = np.maximum.accumulate(high[rows])
    return np.split(rows, np.flatnonzero(low[rows][1:] > reach[:-1]) + 1)


#: A match gains and a mismatch costs so much that a sum of zero is just SIMILARITY, where the mismatches of both sides count.
_RATIO = Fraction(str(SIMILARITY))
GAIN, COST = _RATIO.denominator - _RATIO.numerator, _RATIO.numerator


def _longest(gains: np.ndarray) -> tuple[int, int]:
    """The longest span whose gains have a sum of zero or more, without losses at its ends."""
    if len(gains) and gains.min() > 0:
        return 0, len(gains)
    sums = np.concatenate([[0], np.cumsum(gains)])
    best = np.maximum.accumulate(sums[::-1])[::-1]  # the greatest sum from here on
    reach = np.searchsorted(-best, -sums, side="right") - 1
    start = int(np.argmax(reach - np.arange(len(sums))))
    good = np.flatnonzero(gains[start : int(reach[start])] > 0)
    return (start + int(good[0]), start + int(good[-1]) + 1) if len(good) else (0, 0)


def _coded(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of both sequences as numbers from 0, so that a set of values is an array of flags."""
    codes = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    return codes[: len(a)], codes[len(a) :]


def _members(codes: np.ndarray, n_codes: int) -> np.ndarray:
    """For each number, whether it occurs."""
    flags = np.zeros(n_codes, dtype=bool)
    flags[codes] = True
    return flags


def _aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal numbers of two sequences, rising in both: numbers that occur once in each, and equal neighbours of these."""
    n_codes = 1 + max(int(a.max(initial=-1)), int(b.max(initial=-1)))
    single = (np.bincount(a, minlength=n_codes) == 1) & (np.bincount(b, minlength=n_codes) == 1)
    place = np.empty(n_codes, dtype=np.int64)
    place[b] = np.arange(len(b))
    one = np.flatnonzero(single[a])
    other = place[a[one]]
    if (np.diff(other) < 0).any():
        chain = _rising(other.tolist())
        one, other = one[chain], other[chain]
    ones, others = np.concatenate([[-1], one, [len(a)]]), np.concatenate([[-1], other, [len(b)]])
    left, right = [one], [other]
    gaps = np.flatnonzero((np.diff(ones) > 1) & (np.diff(others) > 1))
    # Only gaps whose first or last values are equal hold any.
    forth_equal = (gaps > 0) & (a[ones[gaps] + 1] == b[others[gaps] + 1])
    back_equal = (gaps < len(one)) & (a[ones[gaps + 1] - 1] == b[others[gaps + 1] - 1])
    for i in gaps[forth_equal | back_equal].tolist():
        # Equal values beside those that occur once, from both ends of what lies between.
        between_a, between_b = a[ones[i] + 1 : ones[i + 1]], b[others[i] + 1 : others[i + 1]]
        n = min(len(between_a), len(between_b))
        same = between_a[:n] == between_b[:n]
        forth = 0 if i == 0 else n if same.all() else int(np.argmin(same))
        same = (between_a[::-1][: n - forth] == between_b[::-1][: n - forth])
        back = 0 if i == len(one) or not len(same) else len(same) if same.all() else int(np.argmin(same))
        left += [ones[i] + 1 + np.arange(forth), ones[i + 1] - 1 - np.arange(back)]
        right += [others[i] + 1 + np.arange(forth), others[i + 1] - 1 - np.arange(back)]
    return np.sort(np.concatenate(left)), np.sort(np.concatenate(right))


def _rising(values: list[int]) -> list[int]:
    """The places of the longest rising subsequence."""
    tails, ends, before = [], [], []
    for i, value in enumerate(values):
        k = bisect_left(tails, value)
        before.append(ends[k - 1] if k else -1)
        tails[k : k + 1], ends[k : k + 1] = [value], [i]
    chain, i = [], ends[-1] if ends else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def _in_order(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int]:
    """The longest passage of two aligned sequences at SIMILARITY; ends are exclusive."""
    left, right = _aligned(a, b)
    if not len(left):
        return 0, 0, 0, 0
    # Between two matches lie the mismatches of both sides.
    lost = np.diff(left) - 1 + np.diff(right) - 1
    gains = np.empty(2 * len(left) - 1, dtype=np.int64)
    gains[::2], gains[1::2] = GAIN, -COST * lost
    sums = np.concatenate([[0], np.cumsum(gains)])
    starts, ends = sums[0::2], sums[1::2]  # before and after each match
    best = np.maximum.accumulate(ends[::-1])[::-1]
    reach = np.searchsorted(-best, -starts, side="right") - 1
    spans = np.minimum(left[reach] - left, right[reach] - right)
    first = int(np.argmax(np.where(reach >= np.arange(len(left)), spans, -1)))
    last = int(reach[first])
    return int(left[first]), int(left[last]) + 1, int(right[first]), int(right[last]) + 1


def _any_order(a: np.ndarray, b: np.ndarray, matched: np.ndarray, cost: int, n_codes: int, longer_than: int) -> tuple[int, int, int, int]:
    """The longest span of ``a`` in which matches outweigh mismatches at ``cost``, and that of ``b`` in it; none if it is not longer."""
    start, end = _longest(np.where(matched, GAIN, -cost))
    if start == end or max(end - start, LEAST) <= longer_than:
        return 0, 0, 0, 0
    other = _members(a[start:end], n_codes)[b]
    return start, end, *_longest(np.where(other, GAIN, -cost))


def _padded(start: int, end: int, n: int) -> tuple[int, int]:
    """The span with as many neighbours as it takes to LEAST: a mismatch at its end may belong to a passage."""
    right = min(max(0, LEAST - (end - start)), n - end)
    end += right
    return min(start, max(0, end - LEAST)), end


def compared(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """``a_start, a_end, b_start, b_end, similarity`` of the passages that two sequences share; ends are exclusive."""
    if len(a) < LEAST or len(b) < LEAST:
        return []
    a, b = _coded(a, b)
    n_codes = 1 + max(int(a.max()), int(b.max()))
    in_b = _members(b, n_codes)
    found, open_spans = [], [(0, len(a))]
    while open_spans:
        low, high = open_spans.pop()
        if high - low < LEAST:
            continue
        part = a[low:high]
        is_matched = in_b[part]
        matched = np.flatnonzero(is_matched)
        # Where no shingle occurs twice, a passage has so many matches at least.
        if not len(matched) or len(matched) < SIMILARITY * LEAST and np.bincount(part).max() == 1:
            continue
        best = None
        # In the same order, then in any order with mismatches ever dearer, then without any.
        # Twice COST on each side is as much as the similarity allows where both have as many mismatches.
        for cost in (0, 2 * COST, 4 * COST, GAIN * (high - low + 1)):
            length = best[1] - best[0] if best else 0
            span = _any_order(part, b, is_matched, cost, n_codes, length) if cost else _in_order(part, b)
            start, end, other_start, other_end = span
            if start == end or other_start == other_end:
                continue
            start, end = (low + x for x in _padded(start, end, high - low))
            other_start, other_end = _padded(other_start, other_end, len(b))
            if min(end - start, other_end - other_start) < LEAST or end - start <= length:
                continue
            one, other = _members(a[start:end], n_codes), _members(b[other_start:other_end], n_codes)
            similarity = np.count_nonzero(one & other) / np.count_nonzero(one | other)
            if similarity >= SIMILARITY:
                best = start, end, other_start, other_end, similarity
                if start <= low + matched[0] and low + matched[-1] < end:
                    break  # no match is left outside
        if best:
            found.append(best)
            open_spans += [(low, best[0]), (best[1], high)]
    return sorted(found)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of one side of each candidate."""
    last_id, last = None, None
    for batch in batches:
        texts, rows = batch.column(batch.schema.names.index("text")), batch.to_pandas(ignore_metadata=True).drop(columns="text")
        parts = []
        for number, text, low, high in zip(rows["doc"], texts, rows["low"], rows["high"]):
            if number != last_id:
                last_id, last = number, shingle_hashes(as_bytes(text.as_py())).view(np.int64)
            parts.append(last[low : high + 1])
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))
        names = ["a", "b", "a_low", "b_low", "side"]
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in names), lists], [*names, "shingles"])


PASSAGE_SCHEMA = ("doc_id bigint, start_word bigint, end_word bigint, of_doc_id bigint, of_start bigint, of_end bigint, "
                  "similarity double")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["a", "b", "a_low", "b_low"]
    for table in whole_groups(batches, keys):
        starts = run_starts([table[k].to_numpy() for k in keys])
        rows = {k: table[k].to_numpy() for k in [*keys, "side"]}
        lists = table["shingles"].combine_chunks()
        out = [[] for _ in range(7)]
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
            if end - start < 2:
                continue
            one, other = (lists[start + i].values.to_numpy() for i in range(2))
            a, b, a_low, b_low = (int(rows[k][start]) for k in keys)
            for a_start, a_end, b_start, b_end, similarity in compared(one, other):
                more = SHINGLE - 1
                found = (b, b_low + b_start, b_low + b_end + more, a, a_low + a_start, a_low + a_end + more, similarity)
                for column, value in zip(out, found):
                    column.append(value)
        types = [pa.int64()] * 6 + [pa.float64()]
        names = [c.split()[0] for c in PASSAGE_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start_word, end_word, of_doc_id, of_start, of_end, similarity``: passages of LEAST_WORDS words or more.

    Each row links a passage of one document to that of another one with a smaller place in
    the group, so a group of n documents gives some n rows and not all pairs. Documents
    without a repeated passage do not occur. Ends are exclusive. Rows without id and null or
    short texts have none; repeated rows of one id count once.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    windows = rows.mapInArrow(_windows, WINDOW_SCHEMA)
    ordered = windows.repartition("place").sortWithinPartitions("place", "function", "a", "a_at")
    links = ordered.mapInArrow(_links, WINDOW_SCHEMA)
    # Copies of a text within a task have function -1 and are sure; all others need AGREE functions.
    split = stored(links.where("a <> b"), "window-links")
    copies = split.where("function = -1")
    pairs = split.where("function >= 0").repartition("a", "b").sortWithinPartitions("a", "b")
    bounds = "a bigint, a_low bigint, a_high bigint, b bigint, b_low bigint, b_high bigint"
    candidates = stored(pairs.mapInArrow(_intervals, bounds), "window-pairs")
    sides = [candidates.select("a", "b", "a_low", "b_low", F.lit(i).alias("side"), F.col(s).alias("doc"),
                               F.col(f"{s}_low").alias("low"), F.col(f"{s}_high").alias("high")) for i, s in enumerate("ab")]
    asked = sides[0].unionByName(sides[1])
    # An id may stand in several rows: one of its texts, the greatest, is compared.
    texts = rows.where("doc is not null").join(asked.select("doc").distinct(), "doc").groupBy("doc").agg(F.max("text").alias("text"))
    slices = asked.join(texts, "doc").mapInArrow(
        _slices, "a bigint, b bigint, a_low bigint, b_low bigint, side int, shingles array<bigint>")
    at = ["a", "b", "a_low", "b_low"]
    passages = slices.repartition(*at).sortWithinPartitions(*at, "side").mapInArrow(_verified, PASSAGE_SCHEMA)
    words = (F.col("b_high") + SHINGLE).cast("bigint")
    zero = F.lit(0).cast("bigint")
    whole = copies.select(F.col("b").alias("doc_id"), zero.alias("start_word"), words.alias("end_word"),
                          F.col("a").alias("of_doc_id"), zero.alias("of_start"), words.alias("of_end"), F.lit(1.0).alias("similarity"))
    return passages.distinct().unionByName(whole)
