"""Pre-tokens by array operations: Arrow functions over whole batches of texts.

They work on the classes of the characters instead of matching the pattern from token to token,
so their time does not depend on how many ranges a class has or how short the tokens are.
"""

import codecs
import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OTHER, _LETTER, _NUMBER, _SPACE, _BLANK = range(5)
#: Bytes of text that are looked at together, so that the arrays of their characters stay in the processor's cache.
_AT_ONCE = 1 << 19
_APOSTROPHE = ord("'")
_AFTER_APOSTROPHE = [tuple(map(ord, s)) for s in ("s", "d", "m", "t", "ll", "ve", "re")]


def class_bounds(letters: str, numbers: str, spaces: str) -> tuple[list[int], list[int]]:
    """Where a class of characters begins, and which one, for all code points in order."""
    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    for kind, characters in ((_LETTER, letters), (_NUMBER, numbers), (_SPACE, spaces), (_BLANK, " ")):
        kinds[np.fromiter(map(ord, characters), dtype=np.int64, count=len(characters))] = kind
    begins = np.flatnonzero(np.diff(kinds, prepend=255))
    return begins.tolist(), kinds[begins].tolist()


def _starts(codes: np.ndarray, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a pre-token of the fixed pattern starts at each character; ``rows`` has where rows start, none is empty.

    Every character is in one pre-token. One starts with each run of letters, numbers, white space or others, but a
    blank before a run of the first, second or last kind starts it instead. White space leaves its last character out
    where more follows. An apostrophe that starts a pre-token takes some letters after it.
    """
    kind = kinds[codes]
    space = kind >= _SPACE
    run = np.minimum(kind, _SPACE)
    new = run[1:] != run[:-1]
    starts = np.empty(len(codes), dtype=bool)
    starts[1:] = new & (space[1:] | (kind[:-1] != _BLANK))
    starts[:-1] |= space[:-1] & new
    # White space at the end of a row stays whole; a row's first character starts a pre-token, whatever lies before it.
    last = rows[1:] - 1
    starts[last[space[last] & space[last - 1]]] = False
    starts[rows] = True

    at = np.flatnonzero(codes == _APOSTROPHE)
    if len(at):
        at = at[starts[at]]
        ends = np.append(rows, len(codes))[np.searchsorted(rows, at, side="right")]
        following = [np.where(at + i < ends, codes[np.minimum(at + i, len(codes) - 1)], 0) for i in (1, 2)]
        length = np.zeros(len(at), dtype=np.int64)
        for letters in _AFTER_APOSTROPHE:
            length[np.logical_and.reduce([f == c for f, c in zip(following, letters)])] = len(letters)
        at, ends, length = (a[length > 0] for a in (at, ends, length))
        starts[at + 1] = False
        rest = (at + length + 1)[at + length + 1 < ends]
        starts[rest] |= kind[rest] == _LETTER
    return starts


def _token_starts(data: memoryview, bounds: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes at which the pre-tokens of rows start, and how many each row has."""
    counts = np.zeros(len(bounds) - 1, dtype=bounds.dtype)
    held = np.flatnonzero(np.diff(bounds))
    if not len(held):
        return bounds[:0], counts
    raw = bytes(data[bounds[0] : bounds[-1]])
    text, rows = raw.decode("utf-8"), bounds[held] - bounds[0]
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    if len(text) == len(raw):
        starts = np.flatnonzero(_starts(codes, rows, kinds))
    else:
        places = np.flatnonzero(np.frombuffer(raw, dtype=np.int8) >= -64)  # all but continuation bytes
        starts = places[_starts(codes, np.searchsorted(places, rows), kinds)]
    counts[held] = np.diff(np.searchsorted(starts, rows), append=len(starts))
    return starts + bounds[0], counts


def _slices(bounds: np.ndarray, size: int):
    """Ranges of rows of about so many bytes each, at least a row."""
    row = 0
    while row < len(bounds) - 1:
        until = max(row + 1, int(np.searchsorted(bounds, int(bounds[row]) + size, side="right")) - 1)
        yield row, until
        row = until


def _java_mark(error: UnicodeDecodeError) -> tuple[str, int]:
    """One mark for malformed bytes, as ``errors="replace"`` has it, but also one for all bytes of a surrogate, as Java has it."""
    data, start, end = error.object, error.start, error.end
    if data[start] == 0xED and 0xA0 <= data[start + 1 : start + 2].ljust(1, b"\0")[0] < 0xC0:
        end = start + 2 + (0x80 <= data[start + 2 : start + 3].ljust(1, b"\0")[0] < 0xC0)
    return "\ufffd", end


def _repaired(texts: pa.Array) -> pa.Array:
    """The texts as a JVM reads them where their bytes are no UTF-8."""
    codecs.register_error("tokenloom-java", _java_mark)
    binary = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return pa.array([None if t is None else t.decode("utf-8", "tokenloom-java") for t in texts.cast(binary).to_pylist()], texts.type)


def _bounds(texts: pa.Array) -> np.ndarray:
    """Where texts begin in their buffer, and where the last one ends."""
    place = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], dtype=place)[texts.offset : texts.offset + len(texts) + 1]


def _cut(texts: pa.Array, kinds: np.ndarray) -> pa.Array:
    if texts.null_count == len(texts):
        return pa.nulls(len(texts), pa.list_(texts.type))
    bounds, values = _bounds(texts), texts.buffers()[2]
    data = memoryview(values if values is not None else b"")
    # Room for a start at each byte: memory is only taken for those that are set.
    starts, ends, n = np.empty(bounds[-1] - bounds[0] + 1, dtype=bounds.dtype), np.zeros(len(bounds), dtype=np.int32), 0
    for low, high in _slices(bounds, _AT_ONCE):
        found, counts = _token_starts(data, bounds[low : high + 1], kinds)
        starts[n : n + len(found)] = found
        ends[low + 1 : high + 1] = n + np.cumsum(counts)
        n += len(found)
    starts[n] = bounds[-1]
    tokens = pa.Array.from_buffers(texts.type, n, [None, pa.py_buffer(starts[: n + 1]), values])
    return pa.ListArray.from_arrays(pa.array(ends), tokens, mask=texts.is_null())


def _lists(texts: pa.Array, kinds: np.ndarray) -> pa.Array:
    try:
        return _cut(texts, kinds)
    except UnicodeDecodeError:
        return _cut(_repaired(texts), kinds)


def pretoken_lists(begins: list[int], of_class: list[int], then: tuple[Callable, T.DataType] | None = None):
    """Arrow function from texts to lists of their pre-tokens, or to what ``then`` makes of the lists, some texts at a time.

    A list holds the bytes of its text, cut at other places: no string is made.
    """

    def kinds() -> np.ndarray:
        return np.repeat(np.array(of_class, dtype=np.uint8), np.diff([*begins, 0x110000]))

    def lists(texts: pa.Array) -> pa.Array:
        return _lists(texts, kinds())

    def lists_then(texts: pa.Array) -> pa.Array:
        slices = list(_slices(_bounds(texts), _AT_ONCE)) if len(texts) else [(0, 0)]
        table = kinds()
        return pa.concat_arrays([then[0](_lists(texts.slice(low, high - low), table)) for low, high in slices])

    return F.arrow_udf(lists_then, then[1]) if then else F.arrow_udf(lists, T.ArrayType(T.StringType()))


def sizes_and_digests(separator: str) -> tuple[Callable, T.DataType]:
    """Function from lists of strings to how many each holds and the MD5 of them joined, and its type."""

    def of_lists(lists: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(lists).cast(pa.int64())
        joined = pc.binary_join(lists, pa.scalar(separator, lists.type.value_type)).cast(pa.large_binary())
        digests = [None if each is None else hashlib.md5(each, usedforsecurity=False).hexdigest() for each in joined.to_pylist()]
        return pa.StructArray.from_arrays([sizes, pa.array(digests, pa.string())], ["size", "digest"])

    return of_lists, T.StructType().add("size", T.LongType()).add("digest", T.StringType())
