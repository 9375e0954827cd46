"""Corpus readers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.sources import ranges


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table of documents in any format Spark reads, unchanged."""
    return spark.read.format(fmt).options(**options).load(path)


#: Inputs of at most so many file splits (of 128 MB by default) may be spread.
SMALL_SPLITS = 8


def spread(docs: DataFrame, key: str, small_splits: int = SMALL_SPLITS) -> DataFrame:
    """Spreads a small input over the cores before CPU-heavy work on its texts; for callers that want it.

    Only an input of ``small_splits`` splits or less, a gigabyte or so, is ever shuffled.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    splits = docs.rdd.getNumPartitions()
    return docs.repartition(2 * cores, key) if splits < 2 * cores and splits <= small_splits else docs


def read_whole_files(spark: SparkSession, path: str, errors: str = "ignore") -> DataFrame:
    """``path, text``: one row per file, read as bytes so that newlines stay as they are."""
    repair = {"ignore": tx.utf8_ignore, "replace": tx.utf8_replace}[errors]
    return spark.read.format("binaryFile").load(path).select("path", repair(F.col("content")).alias("text"))


def read_delimited(
    spark: SparkSession,
    path: str,
    delimiter: str = tx.END_OF_TEXT,
    errors: str = "ignore",
    range_bytes: int = ranges.RANGE_BYTES,
) -> DataFrame:
    """``doc_id, text``: one row per document of files whose documents end with a delimiter.

    ``doc_id`` is the byte offset of the document in all files, one after the other by path: the
    same whatever the ranges, and in the order of the documents. Files are cut into ranges that
    tasks read on their own, each the documents that begin in it. Malformed bytes are dropped, or
    replaced. An empty file has no document; nothing follows a last delimiter. The files must lie
    where pyarrow reaches them; ``read_delimited_text`` reads any store of Spark.
    """
    repair = {"ignore": tx.utf8_ignore, "replace": tx.utf8_replace}[errors]
    spark.dataSource.register(ranges.DelimitedSource)
    options = {"delimiter": delimiter, "range_bytes": str(range_bytes)}
    found = spark.read.format(ranges.DelimitedSource.name()).options(**options).load(path)
    return found.select("doc_id", repair(F.col("content")).alias("text"))


def read_delimited_text(
    spark: SparkSession, path: str, delimiter: str = tx.END_OF_TEXT, errors: str = "ignore"
) -> DataFrame:
    """``doc_id, text`` by Spark's own text source, from any store and from compressed files.

    ``doc_id`` is unique, but the same only for the same files and splits.
    """
    repair = {"ignore": tx.utf8_ignore, "replace": tx.utf8_replace}[errors]
    lines = spark.read.text(path, lineSep=delimiter)
    return lines.select(F.monotonically_increasing_id().alias("doc_id"), repair(F.col("value").cast("binary")).alias("text"))


def corpus_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text, n_bytes``; only the two columns are read."""
    return docs.select(key, text, F.octet_length(text).alias("n_bytes"))
