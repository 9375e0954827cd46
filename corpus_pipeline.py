"""A corpus from raw documents to token ids: filter, deduplicate, mask, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage before.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import mixing, quality, secret_scan, simhash, unigram
from tokenloom.llm.common import stored
from tokenloom.llm.queries import tokenizer_file
from tokenloom.sources.corpus import read_documents


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network rejects go."""
    return quality.accepted(docs, read_documents(spark, f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id."""
    return simhash.near_duplicates_removed(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become a mask; no document goes."""
    return secret_scan.secrets_masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document occurs as often as the mix of the sources takes it."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    encoded = unigram.encode(docs, unigram.Unigram.load(tokenizer_file()))
    return encoded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing to target weights", mix_sources),
    ("sentencepiece encoding", encode_pieces),
]

#: SQL cannot express the stages; a brute-force version checks them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
