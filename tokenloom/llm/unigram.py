"""SentencePiece encoding and decoding with a unigram model.

The best segmentation of a text into pieces, by the sum of their log scores, comes from a
Viterbi search over a double-array trie. Characters that are no piece become byte pieces.
"""

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
#: Stands for a marker character of the text itself, which so stays apart from a space.
LITERAL = "\udfff"
#: Fixed value: how far the score of an unknown character lies below the least score of a piece.
UNKNOWN_PENALTY = 10.0
#: Chunks longer than this are searched one by one, the others side by side.
LONG = 48
#: Distinct chunks a task remembers, in all their characters.
REMEMBERED = 8_000_000


@dataclass
class DoubleArray:
    """``goto``: from state s by symbol c, t = base[s] + c, if check[t] == s. State 0 is the root."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray

    @classmethod
    def build(cls, words: dict[tuple[int, ...], int]) -> "DoubleArray":
        """Symbols are whole numbers from 1."""
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for word, number in words.items():
            at = 0
            for symbol in word:
                if symbol not in children[at]:
                    children[at][symbol] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][symbol]
            ends[at] = number
        # Nodes with several children find a place in order of their size; the others fill the gaps.
        widest = max((max(c) for c in children if c), default=1)
        used = bytearray(len(children) + 2 * widest + 2)
        used[0] = 1
        place, base, check, piece = {0: 0}, {}, {0: 0}, {}
        several = [(-len(children[0]), 0)] if len(children[0]) > 1 else []
        single = [] if several else [0]
        hint, free = 1, 1
        while several or single:
            node = heapq.heappop(several)[1] if several else single.pop()
            own, at = children[node], place[node]
            if ends[node] >= 0:
                piece[at] = ends[node]
            if not own:
                continue
            symbols = sorted(own)
            if len(symbols) > 1:
                start, tries = max(1, hint - symbols[0]), 0
                while start + symbols[-1] < len(used) and any(used[start + c] for c in symbols):
                    start, tries = start + 1, tries + 1
                if tries > 30:
                    hint = start + symbols[0]
            else:
                while free < len(used) and used[free] or free <= symbols[0]:
                    free += 1
                start = free - symbols[0]
            if start + symbols[-1] >= len(used):
                used += bytes(start + symbols[-1] + len(used))
            base[at] = start
            for symbol in symbols:
                used[start + symbol], check[start + symbol], place[own[symbol]] = 1, at, start + symbol
                if len(children[own[symbol]]) > 1:
                    heapq.heappush(several, (-len(children[own[symbol]]), own[symbol]))
                else:
                    single.append(own[symbol])
        size = max(check) + widest + 1
        arrays = []
        for values, empty in ((base, 0), (check, -1), (piece, -1)):
            array = np.full(size, empty, dtype=np.int32)
            array[list(values)] = list(values.values())
            arrays.append(array)
        return cls(*arrays)


@dataclass
class Unigram:
    """``pieces``: text and log score by id, None where an id is no text; ``byte_ids``: ids of the 256 bytes."""

    pieces: list[tuple[str, float] | None]
    byte_ids: list[int]
    alphabet: dict[str, int] = field(init=False)
    trie: DoubleArray = field(init=False)

    def __post_init__(self):
        texts = [(number, p[0]) for number, p in enumerate(self.pieces) if p is not None and p[0]]
        self.alphabet = {c: i + 1 for i, c in enumerate(sorted(set("".join(t for _, t in texts))))}
        self.trie = DoubleArray.build({tuple(self.alphabet[c] for c in t): number for number, t in texts})
        self.scores = np.array([p[1] if p else 0.0 for p in self.pieces] or [0.0])
        self.unknown = min((p[1] for p in self.pieces if p), default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(t) for _, t in texts), default=1)
        # Where a text may be cut: before a marker, if no piece holds one behind another character.
        # White space that is part of no piece always stands alone.
        self.cuts_at_markers = not any(MARKER in t.lstrip(MARKER) for _, t in texts)
        alone = [c for c in "\n\t\r" if c not in self.alphabet]
        lone = re.escape("".join(alone))
        if not self.cuts_at_markers:
            self.pattern = "(?s).+"
        elif alone:
            self.pattern = f"[{lone}]|{MARKER}+[^{MARKER}{lone}]*|[^{MARKER}{lone}]+"
        else:
            self.pattern = f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+"

    @classmethod
    def load(cls, model_file: str, zipf: bool = True) -> "Unigram":
        """Reads a SentencePiece model file.

        The scores of a BPE vocabulary are no logs but minus the rank of a merge. With ``zipf``
        they become log probabilities by Zipf's law at that rank (pieces without a rank come
        last); without, the scores of the file are taken as they are.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        odd = {i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        bytes_at = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
        raw = {i: model.get_score(i) for i in ids if i not in odd}
        if zipf:
            total = float(np.log((1.0 / np.arange(1, len(raw) + 1)).sum())) if raw else 0.0
            raw = {i: -float(np.log(1 + min(-s, len(raw) - 1))) - total for i, s in raw.items()}
        return cls([(model.id_to_piece(i), raw[i]) if i in raw else None for i in ids],
                   [bytes_at[f"<0x{b:02X}>"] for b in range(256)])

    # Encoding

    def chunks(self, text: str) -> list[str]:
        """The text with its dummy space, cut where no piece can reach across."""
        if not text:
            return []
        marked = MARKER + text.replace(MARKER, LITERAL).replace(" ", MARKER)
        return re.findall(self.pattern, marked)

    def _symbols(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if not hasattr(self, "_of_point"):
            self._of_point = np.zeros(0x110000, dtype=np.int32)
            for c, i in self.alphabet.items():
                self._of_point[ord(c)] = i
        return points, self._of_point[points]

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks in a row, and how many each has, by the best segmentation of each.

        Of equal ones, that with the longer piece further right.
        """
        short = [i for i, c in enumerate(chunks) if len(c) <= LONG]
        flat, sizes = self._side_by_side([chunks[i] for i in short])
        if len(short) == len(chunks):
            return flat, sizes
        parts, lengths = [], np.zeros(len(chunks), dtype=np.int64)
        lengths[short] = sizes
        ends, at = np.cumsum(sizes), 0
        for i, chunk in enumerate(chunks):
            if len(chunk) > LONG:
                parts.append(self._one(chunk))
                lengths[i] = len(parts[-1])
            else:
                parts.append(flat[ends[at] - sizes[at] : ends[at]])
                at += 1
        return np.concatenate(parts), lengths

    def _ids(self, steps: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of paths, and how many each step gives: an unknown character, marked by -1 - its place, becomes its bytes."""
        sizes = np.ones(len(steps), dtype=np.int64)
        lost = np.flatnonzero(steps < 0)
        if not len(lost):
            return steps, sizes
        found, which = np.unique(points[-1 - steps[lost]], return_inverse=True)
        spelled = [(MARKER if chr(c) == LITERAL else chr(c)).encode("utf-8", "surrogatepass") for c in found.tolist()]
        table = np.zeros((len(found), 4), dtype=np.int32)
        for row, data in zip(table, spelled):
            row[: len(data)] = [self.byte_ids[b] for b in data]
        sizes[lost] = np.array([len(data) for data in spelled])[which]
        out, starts = np.repeat(steps, sizes), (np.cumsum(sizes) - sizes)[lost]
        for place in range(4):
            has = sizes[lost] > place
            out[starts[has] + place] = table[which[has], place]
        return out, sizes

    def _one(self, chunk: str) -> np.ndarray:
        points, symbols = self._symbols([chunk])
        symbols = symbols.tolist()
        base, check, piece, scores = self.trie.base, self.trie.check, self.trie.piece, self.scores
        n = len(symbols)
        best, back = [-np.inf] * (n + 1), [(0, 0)] * (n + 1)
        best[0] = 0.0
        for start in range(n):
            state, here, alone = 0, best[start], False
            for end in range(start, n):
                if not symbols[end]:
                    break
                after = int(base[state]) + symbols[end]
                if check[after] != state or not base[state]:
                    break
                state = after
                number = int(piece[state])
                if number >= 0:
                    alone |= end == start
                    if here + scores[number] > best[end + 1]:
                        best[end + 1], back[end + 1] = here + scores[number], (start, number)
            if not alone and here + self.unknown > best[start + 1]:
                best[start + 1], back[start + 1] = here + self.unknown, (start, -1 - start)
        steps, at = [], n
        while at:
            at, number = back[at]
            steps.append(number)
        return self._ids(np.array(steps[::-1], dtype=np.int32), points)[0]

    def _side_by_side(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same search for many chunks at once, one start and one piece length at a time."""
        if not chunks:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        lengths = np.array([len(c) for c in chunks])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        points, symbols = self._symbols([chunks[i] for i in order.tolist()])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        slot = first + np.arange(len(lengths))  # chunk k has lengths[k] + 1 places from slot[k] on
        places = int(lengths.sum()) + len(lengths)
        best, start_of, number_of = np.full(places, -np.inf), np.zeros(places, np.int32), np.zeros(places, np.int32)
        best[slot] = 0.0
        base, check, piece, scores = self.trie.base, self.trie.check, self.trie.piece, self.scores
        for start in range(int(lengths[0])):
            live = np.arange(np.searchsorted(-lengths, -start, side="left"))  # those longer than start
            here, state = best[slot[live] + start], np.zeros(len(live), np.int32)
            alone = np.zeros(len(live), dtype=bool)
            at = np.arange(len(live))
            for end in range(start, min(start + self.longest, int(lengths[0]))):
                fits = lengths[live[at]] > end
                at, state = at[fits], state[fits]
                symbol = symbols[first[live[at]] + end]
                after = base[state] + symbol
                good = (symbol > 0) & (base[state] > 0) & (check[after] == state)
                at, state = at[good], after[good]
                if not len(at):
                    break
                number = piece[state]
                ends = number >= 0
                if end == start:
                    alone[at[ends]] = True
                to, reach = slot[live[at[ends]]] + end + 1, here[at[ends]] + scores[number[ends]]
                better = reach > best[to]
                to = to[better]
                best[to], start_of[to], number_of[to] = reach[better], start, number[ends][better]
            at = np.flatnonzero(~alone)
            to, reach = slot[live[at]] + start + 1, here[at] + self.unknown
            better = reach > best[to]
            to = to[better]
            best[to], start_of[to], number_of[to] = reach[better], start, -1 - first[live[at]][better] - start
        at, steps, whose = lengths.copy(), [], []
        live = np.arange(len(lengths))
        while len(live):
            live = live[at[live] > 0]
            to = slot[live] + at[live]
            steps.append(number_of[to])
            whose.append(live)
            at[live] = start_of[to]
        # Paths were found from their ends; put them in the order of the chunks given.
        steps, whose = np.concatenate(steps)[::-1], order[np.concatenate(whose)[::-1]]
        grouped = np.argsort(whose, kind="stable")
        flat, sizes = self._ids(steps[grouped], points)
        return flat, np.bincount(whose[grouped], weights=sizes, minlength=len(chunks)).astype(np.int64)

    # Decoding

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> list[str]:
        """A text for each run of ids: markers become spaces, byte pieces their bytes, and the dummy space goes."""
        if not hasattr(self, "_spelled"):
            spelled = [p[0].replace(MARKER, " ").encode() if p else b"" for p in self.pieces]
            for b, i in enumerate(self.byte_ids):
                spelled[i] = bytes([b])
            lengths = np.array([len(x) for x in spelled], dtype=np.int64)
            self._spelled = np.frombuffer(b"".join(spelled) or b"\0", dtype=np.uint8), np.cumsum(lengths) - lengths, lengths
        data, starts, lengths = self._spelled
        if len(flat) and (flat.min() < 0 or flat.max() >= len(lengths)):
            raise ValueError("an id is not in the vocabulary")
        sizes = lengths[flat]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        whole = data[ragged(starts[flat], sizes)].tobytes()
        texts = []
        for low, high in zip(stops[ends[:-1]].tolist(), stops[ends[1:]].tolist()):
            text = whole[low:high].decode("utf-8", "replace")
            texts.append(text[1:] if text[:1] == " " else text)
        return texts

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, dtype=np.int64), np.array([0, len(ids)]))[0]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes texts in one task and remembers the chunks it has met, within a bound."""

    def __init__(self, model: Unigram):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.sizes, self.held = np.empty(0, np.int32), np.empty(0, np.int64), 0

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids start and end."""
        if self.held > REMEMBERED:
            self.forget()
        parts, counts = [], []
        for text in texts:
            own = self.model.chunks(text or "")
            parts += own
            counts.append(len(own))
        numbers = list(map(self.number.get, parts))
        new = list(dict.fromkeys(p for p, n in zip(parts, numbers) if n is None))
        if new:
            flat, sizes = self.model.segment(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.flat, self.sizes = np.append(self.flat, flat), np.append(self.sizes, sizes)
            self.held += sum(map(len, new))
            numbers = list(map(self.number.__getitem__, parts))
        chosen = np.array(numbers, dtype=np.int64)
        sizes = self.sizes[chosen]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return self.flat[ragged((np.cumsum(self.sizes) - self.sizes)[chosen], sizes)], ends


#: Characters of texts encoded at once.
TOGETHER = 1 << 20


def encode(docs: DataFrame, model: Unigram, key: str = "doc_id", text: str = "text", check: str | None = None) -> DataFrame:
    """``key, ids`` for each row; a null text has null ids, an empty one none.

    ``check`` names a further column that tells whether the ids decode to the very text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            keys, column = batch.columns
            low = 0
            while low < len(column):
                texts, held = [], 0
                while low + len(texts) < len(column) and held < TOGETHER:
                    texts.append(column[low + len(texts)].as_py())
                    held += len(texts[-1] or "")
                flat, ends = encoder.encode(texts)
                ids = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)), mask=pa.array([t is None for t in texts]))
                out = [keys.slice(low, len(texts)), ids]
                if check:
                    out.append(pa.array([back == (t or "") for t, back in zip(texts, model.decode_all(flat, ends))], pa.bool_()))
                yield pa.RecordBatch.from_arrays(out, [key, "ids", check][: len(out)])
                low += len(texts)

    columns = docs.select(key, F.col(text).cast("string").alias(text))
    given = columns.select(key, F.lit(None).cast("array<int>").alias("ids"), *([F.lit(True).alias(check)] if check else []))
    return columns.mapInArrow(run, given.schema)


def decode(encoded: DataFrame, model: Unigram, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The columns of ``encoded`` and the decoded text; null ids decode to null. A row's ids stay within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            texts = pa.array(model.decode_all(flat, ends), pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, into])

    return encoded.mapInArrow(run, encoded.withColumn(into, F.lit(None).cast("string")).schema)
