"""Text quality by a convolutional network over bytes, trained and run in numpy.

Filters slide over every byte of a text. Their outputs are max-pooled over overlapping
chunks that cover the whole text; mean, maximum and minimum over the chunks give one
probability.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import as_bytes

FILTERS = 24
WIDTH = 5
#: A chunk is two neighbouring blocks of so many bytes; chunks overlap by one block.
BLOCK = 256
#: Bytes filtered at once; a whole number of blocks.
SEGMENT = 256 * BLOCK
#: Bounds of the training sample, for each of the two classes: rows, bytes in all, and bytes of one text.
TRAIN_ROWS = 1_500
TRAIN_BYTES = 2 << 20
TRAIN_TEXT = 1 << 17
EPOCHS = 12
BATCH = 16
STEP = 0.01
SEED = 11


@dataclass
class Network:
    """``filters``: WIDTH x 256 x FILTERS; ``weights`` for mean, maximum, minimum of the chunks."""

    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(as_bytes(text)) @ self.weights + self.offset, -60, 60))))

    def features(self, data: bytes) -> np.ndarray:
        chunks = self.chunks(self.blocks(data))
        return np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])

    def blocks(self, data: bytes) -> np.ndarray:
        """The greatest output of each filter in each block of a text."""
        codes = _padded(data)
        n = len(codes) - WIDTH + 1
        found = []
        for low in range(0, n, SEGMENT):
            size = min(SEGMENT, n - low)
            found.append(np.maximum.reduceat(self.outputs(codes[low : low + size + WIDTH - 1]), np.arange(0, size, BLOCK), axis=0))
        return np.maximum(np.concatenate(found) + self.bias, 0)

    def outputs(self, codes: np.ndarray) -> np.ndarray:
        size = len(codes) - WIDTH + 1
        out = self.filters[0].take(codes[:size], axis=0)
        for i in range(1, WIDTH):
            out += self.filters[i].take(codes[i : i + size], axis=0)
        return out

    @staticmethod
    def chunks(blocks: np.ndarray) -> np.ndarray:
        return np.maximum(blocks[:-1], blocks[1:]) if len(blocks) > 1 else blocks


def _padded(data: bytes) -> np.ndarray:
    """The bytes and zeros behind them, so that a filter starts at every byte, and one at the start of an empty text."""
    return np.frombuffer(data + bytes(WIDTH - bool(data)), dtype=np.uint8)


def _gradients(net: Network, codes: np.ndarray, wanted: int, weight: float, into: list) -> None:
    """Adds the gradients of the weighted log loss of one text."""
    outputs = net.outputs(codes)
    n = len(outputs)
    starts = np.arange(0, n, BLOCK)
    padded = np.full((len(starts) * BLOCK, FILTERS), -np.inf, dtype=np.float32)
    padded[:n] = outputs
    cube = padded.reshape(len(starts), BLOCK, FILTERS)
    at = cube.argmax(axis=1)
    raw = np.take_along_axis(cube, at[:, None, :], axis=1)[:, 0] + net.bias
    blocks = np.maximum(raw, 0)
    at = at + starts[:, None]
    every = np.arange(FILTERS)
    if len(blocks) > 1:
        second = blocks[1:] > blocks[:-1]
        chunks = np.where(second, blocks[1:], blocks[:-1])
        of_block = np.arange(len(chunks))[:, None] + second
    else:
        chunks, of_block = blocks, np.zeros((1, FILTERS), dtype=np.int64)
    most, least = chunks.argmax(axis=0), chunks.argmin(axis=0)
    features = np.concatenate([chunks.mean(axis=0), chunks[most, every], chunks[least, every]])
    error = weight * (1 / (1 + np.exp(-np.clip(features @ net.weights + net.offset, -60, 60))) - wanted)
    into[2] += error * features
    into[3] += error
    w_mean, w_most, w_least = net.weights.reshape(3, FILTERS)
    back = np.tile(error * w_mean / len(chunks), (len(chunks), 1))
    back[most, every] += error * w_most
    back[least, every] += error * w_least
    rows, columns = np.nonzero((back != 0) & (chunks > 0))
    push = back[rows, columns]
    block = of_block[rows, columns]
    place = at[block, columns]
    np.add.at(into[1], columns, push)
    for i in range(WIDTH):
        np.add.at(into[0][i], (codes[place + i], columns), push)


def train(texts: list[bytes], labels: list[int], share: float, epochs: int = EPOCHS) -> Network:
    """A network for balanced classes whose offset is then moved to ``share`` of label 1.

    With no text of one class there is nothing to learn: every score is ``share``.
    """
    chance = np.random.default_rng(SEED)
    net = Network(
        chance.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, dtype=np.float32),
        np.zeros(3 * FILTERS), 0.0)
    share = min(max(share, 1e-4), 1 - 1e-4)
    if len(set(labels)) == 2:
        codes = [_padded(t) for t in texts]
        ratio = {c: len(labels) / 2 / labels.count(c) for c in (0, 1)}
        net.weights = chance.normal(0, 0.1, 3 * FILTERS)
        moments = [[np.zeros_like(x, dtype=np.float64) for x in (net.filters, net.bias, net.weights, np.zeros(1))] for _ in range(2)]
        step = 0
        for epoch in range(epochs):
            order = chance.permutation(len(codes))
            rate = STEP * (1 - epoch / epochs)
            for low in range(0, len(order), BATCH):
                step += 1
                chosen = order[low : low + BATCH]
                sums = [np.zeros(net.filters.shape), np.zeros(FILTERS), np.zeros(3 * FILTERS), np.zeros(1)]
                for one in chosen.tolist():
                    _gradients(net, codes[one], labels[one], ratio[labels[one]], sums)
                updates = []
                for total, first, second in zip(sums, *moments):
                    total /= len(chosen)
                    first += 0.1 * (total - first)
                    second += 0.001 * (total**2 - second)
                    updates.append(rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8))
                net.filters -= updates[0].astype(np.float32)
                net.bias -= updates[1].astype(np.float32)
                net.weights -= updates[2]
                net.offset -= float(updates[3][0])
    net.offset += float(np.log(share / (1 - share)))
    return net


def held_out(key: str = "doc_id") -> Column:
    """The fold that takes no part in training; a null id is not in it."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """Trains on a bounded sample of the labelled rows outside the held-out fold.

    Of each class, the rows whose hash of the id comes first, up to TRAIN_ROWS rows and
    TRAIN_BYTES bytes; texts over TRAIN_TEXT bytes are not trained on (they are scored like
    any other). The share of label 1 is counted over all labelled rows.
    """
    marks = labels.where(~held_out(key) & F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("mark")).distinct()
    counts = {r["mark"]: r["n"] for r in marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    sized = docs.select(key, F.coalesce(F.octet_length(text), F.lit(0)).alias("size")).join(marks, key)
    rows = []
    for mark in (0, 1):
        left = TRAIN_BYTES
        ordered = sized.where((F.col("mark") == mark) & (F.col("size") <= TRAIN_TEXT)).orderBy(F.xxhash64(key), key, "size")
        for row in ordered.limit(TRAIN_ROWS).collect():
            if row["size"] <= left:
                left -= row["size"]
                rows.append((row[key], mark))
    chosen = docs.sparkSession.createDataFrame(rows, docs.select(key, F.lit(0).alias("mark")).schema)
    # At most 2 * TRAIN_ROWS ids and, as chosen, 2 * TRAIN_BYTES of texts.
    taken = docs.select(key, text).where(F.octet_length(text) <= TRAIN_TEXT).join(F.broadcast(chosen.distinct()), key)
    sample = sorted((as_bytes(r[text]), r["mark"]) for r in taken.select(text, "mark").distinct().collect())
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    return train([t for t, _ in sample], [m for _, m in sample], share)


def scores(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for each row. Null texts are empty; the score depends on nothing but the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([net.score(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], [key, "score"])

    columns = docs.select(key, F.col(text).cast("string").alias(text))
    return columns.mapInArrow(run, columns.select(key, F.lit(0.0).alias("score")).schema)


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` for each row of ``docs``."""
    scored = scores(docs, fit(docs, labels, key, text), key, text)
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, all columns."""
    net = fit(docs, labels, key, text)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in batches:
            yield batch.filter(pa.array([net.score(t.as_py()) >= 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
