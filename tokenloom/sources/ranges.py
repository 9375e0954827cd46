"""Documents of large delimited files, read by byte ranges: a data source whose ids are byte offsets."""

import os
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tokenloom.functions import text as tx

SCHEMA = "doc_id bigint, path string, start bigint, content binary"
#: Bytes of a range, as of Spark's own file splits; of one read; and of the rows of one batch.
RANGE_BYTES = 128 << 20
BLOCK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
#: Small ranges, one after the other, that a task reads on their own: so many bytes, as long as there are a few tasks.
TASK_BYTES = 16 << 20
LEAST_TASKS = 64
#: Bytes of one read in a small range.
LEAST_BLOCK = 1 << 12
#: Files whose bytes are not those of their documents.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")

ReadAt = Callable[[int, int], bytes]


def anchor(read_at: ReadAt, start: int, delimiter: bytes) -> int:
    """A place at or before ``start - len(delimiter)`` that no delimiter lies across.

    Whoever cuts from there finds the delimiters that cutting from the front of the file finds,
    also where delimiters overlap, as in a run of line ends cut at two of them.
    """
    width = len(delimiter)
    at = max(0, start - width)
    while at > 0:
        low = max(0, at - width + 1)
        found = read_at(low, at + width - 1 - low).find(delimiter)
        if found < 0:
            break
        at = low + found
    return at


def documents(
    read_at: ReadAt, start: int, end: int, delimiter: bytes, block: int = BLOCK_BYTES
) -> Iterator[tuple[int, bytes]]:
    """``start, content`` of the documents that begin in ``[start, end)``, whole wherever they end.

    A file is its documents with the delimiter between or after them: nothing follows a last
    delimiter. Holds one document and a block at a time; a range inside a document reads itself only.
    """
    width = len(delimiter)
    base = anchor(read_at, start, delimiter)  # the place of the buffer in the file
    inside = start == 0  # whether a document of this range begins at ``base``
    buffer, searched = bytearray(), 0
    while base < end:
        found = buffer.find(delimiter, searched)
        if found >= 0:
            if inside:
                yield base, bytes(buffer[:found])
            base += found + width
            del buffer[: found + width]
            inside, searched = base >= start, 0
            continue
        # A delimiter may have begun at the end of the buffer.
        searched = max(searched, len(buffer) - width + 1)
        if not inside:
            base += searched
            del buffer[:searched]
            searched = 0
        more = read_at(base + len(buffer), block)
        if not more:
            if inside and buffer:
                yield base, bytes(buffer)
            return
        buffer += more


def _opened(path: str):
    """The file system of a path and the path in it: whatever pyarrow reaches, such as local, HDFS and object stores."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


class ByteRanges(InputPartition):
    """``path, before, start, end`` of ranges that one task reads: ``step`` bytes each, all of one file or whole files."""

    def __init__(self, runs: list[tuple[str, int, int, int]], step: int):
        self.runs, self.step = runs, step


class _File(NamedTuple):
    path: str
    size: int


def _files(path: str) -> list[_File]:
    """The files of a file or folder by path, without those whose names mark them as no data."""
    from pyarrow import fs

    files, where = _opened(path)
    info = files.get_file_info(where)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    below = [info] if info.is_file else files.get_file_info(fs.FileSelector(where, recursive=True))
    names = {f.path: f.path[len(where):].split("/") for f in below}
    found = [_File(f.path, f.size) for f in below if f.is_file and not any(n.startswith(("_", ".")) for n in names[f.path])]
    packed = [f.path for f in found if f.path.endswith(COMPRESSED)]
    if packed:
        raise ValueError(f"compressed files have no byte ranges: {packed[0]}")
    return sorted(found)


class DelimitedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.delimiter = options.get("delimiter", tx.END_OF_TEXT).encode("utf-8")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        if not self.delimiter or self.range_bytes < 1:
            raise ValueError("the delimiter and the ranges need a byte at least")

    def partitions(self) -> list[ByteRanges]:
        """Ranges of each file, put together up to the size of a task: the only thing the driver holds."""
        files = _files(self.path)
        most = min(TASK_BYTES, sum(f.size for f in files) // LEAST_TASKS)
        span = max(1, most // self.range_bytes) * self.range_bytes
        tasks, before, held = [], 0, span
        for path, size in files:
            for low in range(0, size, span):
                run = (path, before, low, min(size, low + span))
                if held + run[3] - low > span:
                    tasks.append([])
                    held = 0
                tasks[-1].append(run)
                held += run[3] - low
            before += size
        return [ByteRanges(runs, self.range_bytes) for runs in tasks or [[]]]

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        names, types = ["doc_id", "path", "start", "content"], [pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def batch(rows: list[tuple[int, str, int, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        rows, held = [], 0
        for path, before, first, last in partition.runs:
            with _opened(self.path)[0].open_input_file(path) as file:
                for low in range(first, last, partition.step):
                    high = min(last, low + partition.step)
                    # A range reads little beyond itself.
                    block = min(BLOCK_BYTES, max(high - low, LEAST_BLOCK))
                    for start, content in documents(lambda at, n: file.read_at(n, at), low, high, self.delimiter, block):
                        rows.append((before + start, path, start, content))
                        held += len(content) + 64
                        if held >= BATCH_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)


class DelimitedSource(DataSource):
    """Format ``delimited_ranges``; options ``path``, ``delimiter`` and ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "delimited_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DelimitedReader:
        return DelimitedReader(self.options)
