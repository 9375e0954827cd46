"""Streams of texts: ids per item, and running pre-token counts.

Each item is encoded on its own. Encoding keeps nothing between items, so it is a plain
projection of the stream. Counting keeps one row per distinct token in the state store.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.tokenizer import Tokenizer, encode_documents
from tokenloom.operators.words import pretoken_counts
from tokenloom.session import delete, listed, read_text, write_text


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """A stream of the files of a folder; ``maxFilesPerTrigger`` bounds a micro-batch."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def write_encoded_stream(items: DataFrame, tokenizer: Tokenizer, out: str, checkpoint: str, text: str = "text"):
    """Encode all that has arrived, append it to ``out`` exactly once, return the query."""
    encoded = encode_documents(items, tokenizer, text)
    writer = encoded.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)


#: So many folders of changed totals are put together into one.
COMPACT_EVERY = 16
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COUNTS = "token string, is_special boolean, n bigint"


class CountLog:
    """A versioned log of totals: immutable folders, and manifests that say which of them make a version.

    Version n holds what is known after batch n: a snapshot up to some batch and the totals
    changed by each batch since. Its folders are written first, under names never used
    before; then its manifest appears by one rename. A batch that is repeated, for whatever
    reason, builds on the version before it again and publishes its own anew. Folders go only
    once a later batch has begun, hence after Spark has committed the batch that replaced them.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")

    def _manifests(self) -> list[tuple[int, str]]:
        names = [n for n in listed(self.spark, f"{self.out}/versions") if n.endswith(".json")]
        return sorted((int(n.split("-")[0]), n) for n in names)

    def _folders(self, manifest: str) -> list[str]:
        return json.loads(read_text(self.spark, f"{self.out}/versions/{manifest}"))["folders"]

    def _write(self, totals: DataFrame, kind: str, batch_id: int) -> str:
        name = f"{kind}-{batch_id}-{uuid.uuid4().hex}"
        totals.write.parquet(f"{self.out}/data/{name}")
        return name

    def _table(self, folders: list[str]) -> DataFrame:
        # Totals only grow, so the current one is the greatest.
        rows = self.spark.read.schema(_COUNTS).parquet(*(f"{self.out}/data/{f}" for f in folders))
        return rows.groupBy("token", "is_special").agg(F.max("n").alias("n"))

    def add(self, changed: DataFrame, batch_id: int, compact_every: int) -> None:
        """Publishes the version of a batch from the totals that it changed."""
        older = [m for m in self._manifests() if m[0] < batch_id]
        folders = self._folders(older[-1][1]) if older else []
        folders = [*folders, self._write(changed, "changes", batch_id)]
        if len(folders) > compact_every:
            folders = [self._write(self._table(folders), "snapshot", batch_id)]
        # Batches come in order, so the one before this is committed and what it replaced is not read by a repetition.
        write_text(self.spark, f"{self.out}/versions/{batch_id:020d}-{uuid.uuid4().hex}.json", json.dumps({"batch": batch_id, "folders": folders}))
        self._clean(batch_id)

    def _clean(self, batch_id: int) -> None:
        """Keeps this version and the one before it, of each the last manifest, with their folders."""
        manifests = self._manifests()
        kept = {n: name for n, name in manifests if n == batch_id or n == max((m for m, _ in manifests if m < batch_id), default=batch_id)}
        needed = {f for name in kept.values() for f in self._folders(name)}
        for _, name in manifests:
            if name not in kept.values():
                delete(self.spark, f"{self.out}/versions/{name}")
        for folder in listed(self.spark, f"{self.out}/data"):
            if folder not in needed:
                delete(self.spark, f"{self.out}/data/{folder}")

    def read(self) -> DataFrame:
        """The totals of the last published version."""
        manifests = self._manifests()
        folders = self._folders(manifests[-1][1]) if manifests else []
        return self._table(folders) if folders else self.spark.createDataFrame([], _COUNTS)


def write_count_stream(
    items: DataFrame, out: str, checkpoint: str, specials: list[str] = (), text: str = "text", compact_every: int = COMPACT_EVERY
):
    """Running counts: each micro-batch publishes a version of a ``CountLog`` with the totals it changed.

    A repeated micro-batch changes nothing. The state, one row per distinct token, is kept
    in RocksDB.
    """
    spark = items.sparkSession
    counts = pretoken_counts(items, list(specials), text)

    def save(changed: DataFrame, batch_id: int) -> None:
        CountLog(changed.sparkSession, out).add(changed, batch_id, compact_every)

    writer = counts.writeStream.outputMode("update").foreachBatch(save)
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """``token, is_special, n`` as of the last published micro-batch."""
    return CountLog(spark, out).read()
