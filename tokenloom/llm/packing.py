"""Packing documents into windows of a fixed number of tokens that all hold the same mix of sources.

Each source is a queue of tokens. Deficit round-robin fills window after window: a source's
credit grows by its share of each window, it sends the whole tokens of its credit, places
that are left go to tokens that fall due next, and what a source is owed (or has sent
ahead) is carried on as its deficit. So every source stays within one token of its target.
The same rule deals the stream to ranges, a range to spans and a span to windows. As
deficits are zero again where a whole ends, each span is packed by a task of its own.
"""

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import PART_BYTES, run_starts, segments, stored, whole_groups
from tokenloom.operators.positions import count_below

#: Tokens of a window, and the id that ends each document.
WINDOW = 2048
END_ID = 1
#: Windows of a span, which one task packs in memory, and spans of a range.
SPAN_WINDOWS = 1024
RANGE_SPANS = 1024
#: So many sources, the largest ones, have a queue of their own; further ones share one more.
QUEUES = 4096
#: A task remembers so many words. Tables with so many numbers may be broadcast.
REMEMBERED = 400_000
BROADCAST_NUMBERS = 1_000_000


def dealt(quotas: list[int] | np.ndarray, rooms: list[int]) -> np.ndarray:
    """Deficit round-robin: how many tokens each source (column) sends to each room (row).

    ``quotas`` and ``rooms`` have the same sum. A source sends the whole tokens of its
    deficit; places left go to the next tokens of sources that are owed a part of one, first
    to the one that falls due first. Earliest due first keeps each deficit between minus one
    and one token after each room; deficits are integers in units of one over the sum, so
    they are zero after the last room.
    """
    total, largest = sum(map(int, rooms)), max(map(int, rooms), default=0)
    kind = np.int64 if total * (largest + 2) < 1 << 62 else object
    quota, deficit = np.array(quotas, dtype=kind), np.zeros(len(quotas), dtype=kind)
    sent = np.zeros((len(rooms), len(quotas)), dtype=np.int64)
    for row, room in enumerate(rooms):
        deficit = deficit + quota * int(room)
        whole = np.maximum(deficit // total, 0)
        deficit = deficit - whole * total
        owed = np.flatnonzero(deficit > 0)
        due = -((deficit[owed] - total) // quota[owed])
        first = owed[np.argsort(due, kind="stable")[: int(room) - int(whole.sum())]]
        whole[first] += 1
        deficit[first] -= total
        sent[row] = whole
    return sent


def parts_of(total: int, size: int) -> list[int]:
    """The total in parts of ``size``, the last one smaller."""
    return [size] * (total // size) + ([total % size] if total % size else [])


def rooms_of(total: int, window: int) -> list[int]:
    """Windows of a span. What is left at the end of the stream goes to sequences of a power of two, which need no padding."""
    rest = total % window
    return [window] * (total // window) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


#: How the word tokenizer cuts normalised text, and the letters and marks within which a text can be cut alike before it is
#: normalised: composed Latin letters that stay one letter in lower case, digits and ASCII marks.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = r"a-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}"
_MARKS = r"!-/:-@\[-`{-~"
_OTHER = rf"[^{_LETTERS}0-9{_MARKS}\t\n\v\f\r ]|<\|"
_UNIT = rf"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[{_MARKS}]+)"
#: The same pattern in the notation of Python.
_UNIT_HERE = re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), _UNIT)


#: So many units are encoded as one text.
_JOINED = 256


class _Words(dict):
    """Numbers of words; a new one waits until its ids are made."""

    def __init__(self, tokenizer, end_id: int):
        super().__init__()
        self.tokenizer, self.waiting, self.is_unit = tokenizer, [], re.compile(_UNIT_HERE).fullmatch
        self[b" "] = 0  # no word; the end of a document
        self.flat = np.array([end_id], np.uint32)
        self.starts, self.lengths = np.zeros(1, np.int64), np.ones(1, np.int64)

    def __missing__(self, word: bytes) -> int:
        self.waiting.append(word)
        number = self[word] = len(self)
        return number

    def settle(self) -> None:
        """Makes the ids of the words that wait. Units are encoded many at once, as each is one word to the tokenizer, too."""
        if not self.waiting:
            return
        texts = [w.decode("utf-8", "replace") for w in self.waiting]
        unit = np.fromiter((self.is_unit(t) is not None for t in texts), bool, len(texts))
        units, others = [t for t, u in zip(texts, unit) if u], [t for t, u in zip(texts, unit) if not u]
        joined = [" ".join(units[i : i + _JOINED]) for i in range(0, len(units), _JOINED)]
        ids, sizes = [self.flat], [np.empty(0, np.int64)]
        for found in self.tokenizer.encode_batch(joined, add_special_tokens=False):
            ids.append(np.array(found.ids, np.uint32))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64)))
        by_unit = np.concatenate(sizes)
        if len(by_unit) != len(units):
            raise ValueError("the tokenizer cuts words in another way than its file says")
        alone = [f.ids for f in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        ids.append(np.fromiter(chain.from_iterable(alone), np.uint32))
        lengths = np.empty(len(texts), np.int64)
        lengths[unit], lengths[~unit] = by_unit, np.fromiter(map(len, alone), np.int64, len(alone))
        starts, first = np.empty(len(texts), np.int64), len(self.flat)
        starts[unit] = first + np.cumsum(by_unit) - by_unit
        starts[~unit] = first + int(by_unit.sum()) + np.cumsum(lengths[~unit]) - lengths[~unit]
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
        self.flat, self.waiting = np.concatenate(ids), []

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and how many each has."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + lengths, lengths)
        return self.flat[at], lengths


class _Encoder:
    """Ids of texts, each with the end id, as little-endian bytes."""

    def __init__(self, tokenizer_file: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(tokenizer_file), end_id
        steps = json.loads(self.tokenizer.to_str())
        cuts = [s.get("pattern", {}).get("Regex") for s in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
        names = [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])]
        #: Whether no token reaches across white space, so that words can be encoded one by one.
        self.by_word = _CUT in cuts and names == ["NFC", "Replace", "Lowercase"]
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        self.words = _Words(self.tokenizer, end_id)

    def encoded(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array([*f.ids, self.end_id], dtype=self.kind).tobytes() for f in found]
        out, held, size = [], [], 0
        for text in texts:
            if len(text) > PART_BYTES:
                out += self._together(held) if held else []
                end = np.array([self.end_id], dtype=self.kind).tobytes()
                out.append(b"".join([*(self._together([part])[0][: -len(end)] for part in segments(text)), end]))
                held, size = [], 0
                continue
            held.append(text)
            size += len(text)
            if size > PART_BYTES:
                out += self._together(held)
                held, size = [], 0
        return out + (self._together(held) if held else [])

    def _together(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts of bounded size, made of the ids of their distinct words.

        ASCII letters become lower case here and plain texts are cut into units, which are
        far fewer, as the tokenizer would do; not where a special token could be meant.
        """
        words = pa.array([t if b"<|" in t else t.lower() for t in texts], pa.binary()).view(pa.string())
        plain = pc.invert(pc.match_substring_regex(words, _OTHER))
        words = pc.if_else(plain, pc.replace_substring_regex(words, _UNIT, r"\1 "), words)
        lists = pc.ascii_split_whitespace(words)
        coded = lists.flatten().dictionary_encode()
        if len(self.words) > REMEMBERED:
            self.words = _Words(self.tokenizer, self.end_id)
        distinct = coded.dictionary.view(pa.binary()).to_pylist()
        # White space at either end leaves empty words.
        numbers = np.fromiter((self.words[w] if w else -1 for w in distinct), np.int64, len(distinct))
        self.words.settle()
        numbers = numbers[coded.indices.to_numpy()] if len(distinct) else np.empty(0, np.int64)
        ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        numbers = np.insert(numbers, ends, 0)
        last = ends + np.arange(len(ends))
        kept = numbers >= 0
        last = np.cumsum(kept)[last] - 1
        ids, lengths = self.words.gather(numbers[kept])
        bounds = [0, *np.cumsum(lengths)[last].tolist()]
        data, width = ids.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
        return [data[width * a : width * b] for a, b in zip(bounds, bounds[1:])]


def id_bytes(tokenizer_file: str, end_id: int) -> int:
    """Bytes that an id takes while rows move."""
    return np.dtype(_Encoder(tokenizer_file, end_id).kind).itemsize


def _with_ids(tokenizer_file: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with the ids of a text, and how many ids of its source the task has seen before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, task = _Encoder(tokenizer_file, end_id), {}, TaskContext.get().partitionId()
        width = np.dtype(encoder.kind).itemsize
        for batch in batches:
            ids = encoder.encoded([b"" if t is None else t for t in batch.column(2).to_pylist()])
            sizes, before = [len(i) // width for i in ids], []
            for source, n in zip(batch.column(1).to_pylist(), sizes):
                before.append(seen.get(source, 0))
                seen[source] = before[-1] + n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array([task] * len(ids), pa.int32()), pa.array(before, pa.int64())],
                ["id", "source", "ids", "n", "task", "before"])

    return run


def _span_starts(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Where each span starts in the queues of its range, for rows ``range_no, total, quotas``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for range_no, total, quotas in zip(*(c.to_pylist() for c in batch.columns)):
                sent = dealt(quotas, parts_of(total, window * SPAN_WINDOWS))
                starts = np.cumsum(sent, axis=0) - sent
                yield pa.RecordBatch.from_arrays(
                    [pa.array([range_no] * len(quotas), pa.int64()), pa.array(range(len(quotas)), pa.int32()),
                     pa.array(list(starts.T), pa.list_(pa.int64()))], ["range_no", "queue", "starts"])

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for table in whole_groups(batches, ["span"]):
        bounds = [*run_starts([table["span"].to_numpy()]).tolist(), table.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            yield table.slice(low, high - low).combine_chunks()


def _packed(window: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of whole spans, for slices sorted by span, queue and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for span in _spans(batches):
            queue, length = span["queue"].to_numpy(), span["length"].to_numpy()
            quotas = np.bincount(queue, weights=length).astype(np.int64)
            sent = dealt(quotas, rooms_of(int(length.sum()), window))
            # Places in the span's own order: queue after queue.
            edges = np.concatenate([[0], np.cumsum(length)])
            queue_start = np.cumsum(quotas) - quotas
            room_start = queue_start[None, :] + np.cumsum(sent, axis=0) - sent
            offset = np.cumsum(sent, axis=1) - sent
            full = sent.T.reshape(-1) > 0
            turns = room_start.T.reshape(-1)[full]  # rising, as queues follow each other
            turn_room = np.tile(np.arange(len(sent)), len(quotas))[full]
            turn_offset = offset.T.reshape(-1)[full]
            cuts = np.union1d(edges, turns)
            low, high = cuts[:-1], cuts[1:]
            row = np.searchsorted(edges, low, "right") - 1
            turn = np.searchsorted(turns, low, "right") - 1
            data = np.frombuffer(b"".join(span["ids"].to_pylist()), f"<u{width}").astype("<u4").tobytes()
            ids = pa.Array.from_buffers(pa.binary(), len(low), [None, pa.py_buffer((4 * cuts).astype(np.int32).tobytes()), pa.py_buffer(data)])
            first = int(span["span"][0].as_py()) * SPAN_WINDOWS
            picked = span.select(["id", "n", "start"]).take(pa.array(row)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [picked["id"].chunk(0), pa.array(picked["start"].to_numpy() + low - edges[row]), pa.array(high - low), ids,
                 picked["n"].chunk(0).cast(pa.int64()), pa.array(first + turn_room[turn]), pa.array(turn_offset[turn] + low - turns[turn])],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return run


def _phases(totals: np.ndarray, weights: np.ndarray, window: int) -> list[np.ndarray]:
    """Token numbers by source for stretches of the stream within which the mix stays the same.

    Sources send by weight until one is used up; the others go on by theirs. Every stretch
    but the last is a whole number of windows.
    """
    left, phases = [int(t) for t in totals], []
    while any(left):
        open_ = [i for i, n in enumerate(left) if n and weights[i] > 0] or [i for i, n in enumerate(left) if n]
        share = np.array([float(weights[i]) or 1.0 for i in open_])
        share /= share.sum()
        size = int(min(left[i] / s for i, s in zip(open_, share)) // window) * window
        if not size or sum(left) - size < window:
            phases.append(np.array(left, dtype=object))
            break
        quotas = np.zeros(len(left), dtype=object)
        for i, s in zip(open_, share):
            quotas[i] = min(left[i], int(size * s))
        for i in sorted(open_, key=lambda i: int(quotas[i]) - left[i]) * (window + 1):
            if int(quotas.sum()) == size:
                break
            quotas[i] += left[i] > quotas[i]
        phases.append(quotas)
        left = [n - int(q) for n, q in zip(left, quotas)]
    return phases


def packed(
    docs: DataFrame, tokenizer_file: str, weights: dict[str, float] | None = None, key: str = "doc_id", text: str = "text",
    source: str = "source", window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """``key, start, length, ids, doc_tokens, sequence_id, offset``: a row for each piece; ids are little-endian, four bytes each.

    ``weights`` are the target proportions by source; without them each source has its own
    share of all tokens, so that every window looks like the whole. Every token lies in one
    piece. A null text has the end id only, null sources are one source, repeated rows are
    documents of their own, and the key may be anything. Long texts are encoded in parts.
    An empty table gives an empty result.
    """
    width = id_bytes(tokenizer_file, end_id)
    rows = docs.select(F.col(key).alias("id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    encoded = rows.mapInArrow(_with_ids(tokenizer_file, end_id), f"id {id_type}, source string, ids binary, n bigint, task int, before bigint")
    encoded = stored(encoded, "pack-ids")
    totals = stored(encoded.groupBy("source", "task").agg(F.sum("n").alias("n")), "pack-sizes")
    by_source = totals.groupBy("source").agg(F.sum("n").alias("n"))
    # QUEUES rows at most reach the driver.
    largest = by_source.orderBy(F.desc("n"), F.asc_nulls_last("source")).limit(QUEUES).collect()
    names = {r["source"]: i for i, r in enumerate(largest)}
    every = int(totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])
    sizes = [int(r["n"]) for r in largest]
    sizes.append(every - sum(sizes))
    if weights is None:
        phases = [np.array(sizes, dtype=object)] if every else []
    else:
        phases = _phases(np.array(sizes, dtype=object), np.array([*(float(weights.get(r["source"], 0)) for r in largest), 0.0]), window)
    span_tokens = window * SPAN_WINDOWS
    ranges = [sent for quotas in phases for sent in dealt(quotas, parts_of(int(quotas.sum()), span_tokens * RANGE_SPANS))]
    starts, at, spans_before, span_no = [], [0] * len(sizes), [], 0
    for sent in ranges:
        starts.append(list(at))
        spans_before.append(span_no)
        at = [a + int(s) for a, s in zip(at, sent)]
        span_no += -(-int(sent.sum()) // span_tokens)
    spark = docs.sparkSession

    def side(rows: list, schema: str, numbers: int) -> DataFrame:
        """A small table that was made here: broadcast if within the bound, else stored, so that its size is known."""
        table = spark.createDataFrame(rows, schema)
        return F.broadcast(table) if numbers <= BROADCAST_NUMBERS else stored(table, "pack-side")

    queues = side([(n, i) for n, i in names.items()], "name string, queue int", len(names))
    placed = totals.join(queues, F.col("source").eqNullSafe(F.col("name")), "left")
    placed = placed.select("source", "task", "n", F.coalesce("queue", F.lit(len(sizes) - 1)).alias("queue"))
    # Sources that share a queue follow each other within a task; one row for each source and task.
    before = Window.partitionBy("queue").orderBy("task", "source").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(F.col("source").alias("name"), F.col("task").alias("of"), "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("queue_start"))
    placed = stored(placed, "pack-queues")
    same = F.col("source").eqNullSafe(F.col("name")) & (F.col("task") == F.col("of"))
    lines = encoded.join(placed, same).select("id", "ids", "n", "queue", (F.col("queue_start") + F.col("before")).alias("at"))
    # Ranges of the stream hold two billion tokens each, so their tables are small beside the corpus.
    range_starts = side([(q, [s[q] for s in starts]) for q in range(len(sizes))], "queue int, starts array<bigint>", len(sizes) * len(starts))
    lines = _cut(lines.join(range_starts, "queue"), len(ranges), "range_no", width)
    shape = "range_no bigint, total bigint, quotas array<bigint>"
    of_ranges = spark.createDataFrame([(i, int(s.sum()), [int(x) for x in s]) for i, s in enumerate(ranges)], shape)
    span_starts = of_ranges.repartition(max(1, len(ranges))).mapInArrow(_span_starts(window), "range_no bigint, queue int, starts array<bigint>")
    lines = _cut(lines.join(stored(span_starts, "pack-spans"), ["range_no", "queue"]), RANGE_SPANS, "span_no", width)
    first_span = side(list(enumerate(spans_before)), "range_no bigint, spans_before bigint", len(spans_before))
    lines = lines.join(first_span, "range_no").select(
        (F.col("spans_before") + F.col("span_no")).alias("span"), "queue", "at", "id", "n", "start", _size(width).alias("length"), "ids")
    spans = lines.repartition("span").sortWithinPartitions("span", "queue", "at", "start")
    pieces = spans.mapInArrow(
        _packed(window, width),
        f"id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
    return pieces.withColumnRenamed("id", key)


def _size(width: int) -> Column:
    return (F.octet_length("ids") / width).cast("bigint")


def _cut(lines: DataFrame, parts: int, into: str, width: int) -> DataFrame:
    """Cuts rows ``at, ids`` of a queue at the ``starts`` of its parts; places then count from the start of their part."""
    if "start" not in lines.columns:
        lines = lines.withColumn("start", F.lit(0).cast("bigint"))
    known = lines.withColumn("bounds", F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0))))
    first, last = (count_below(F.col("bounds"), parts - 1, F.col("at") + add) for add in (F.lit(1), _size(width)))
    each = known.withColumn(into, F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))
    low = F.greatest(F.lit(0).cast("bigint"), F.get("starts", F.col(into).cast("int")) - F.col("at"))
    high = F.least(_size(width), F.coalesce(F.get("starts", (F.col(into) + 1).cast("int")), F.lit(1 << 62)) - F.col("at"))
    each = each.withColumns({"low": low, "high": high}).where("high > low")
    cut: Column = F.substring("ids", (width * F.col("low") + 1).cast("int"), (width * (F.col("high") - F.col("low"))).cast("int"))
    place = F.col("at") + F.col("low") - F.get("starts", F.col(into).cast("int"))
    each = each.withColumns({"ids": cut, "at": place, "start": F.col("start") + F.col("low")})
    return each.drop("starts", "bounds", "low", "high")
