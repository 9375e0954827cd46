"""The registered queries of this package (and, in ORACLES, their SQL): one for each operator, over whole tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import (
    compact_windows, divergence, hosts, lineblocks, mixing, packing, phrases, quality, rabitq, secret_scan, simhash, unigram, vafile,
)
from tokenloom.llm.oracles import ORACLES
from tokenloom.sources.corpus import read_documents

K = 5
QUERY_STEP = 50

RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    """The public vocabulary that the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_tokenizer_file() -> str:
    """The public vocabulary that the queries pack with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded_digest(docs: DataFrame, model: unigram.Unigram) -> DataFrame:
    """``doc_id, n_tokens, n_bytes, ids_sha256, round_trip``; null texts have no tokens and a null digest."""
    first, last = min(model.byte_ids), max(model.byte_ids)
    return unigram.encode(docs, model, check="round_trip").select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce(F.size(F.filter("ids", lambda i: i.between(first, last))), F.lit(0)).cast("long").alias("n_bytes"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "round_trip")


def op1_sentencepiece(spark, sf_dir):
    model = unigram.Unigram.load(tokenizer_file())
    return encoded_digest(_table(spark, sf_dir, "documents"), model)


def op2_simhash(spark, sf_dir):
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op3_repeated_passages(spark, sf_dir):
    return compact_windows.repeated_passages(_table(spark, sf_dir, "documents"))


def op4_mixture(spark, sf_dir):
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op5_top_k(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    return vafile.top_k(rows, rows.where(F.col("vec_id") % QUERY_STEP == 0), K)


def op6_secrets(spark, sf_dir):
    found = secret_scan.scanned(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(secret_scan.counted(F.col(secret_scan.BASE), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secret_scan.as_text(F.col(secret_scan.BASE)), 256).alias("base_sha256"), secret_scan.as_text(F.col(secret_scan.ALL)).alias("spans"))


def op7_quality(spark, sf_dir):
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_main_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return lineblocks.extracted(pages).withColumn("n_chars", F.char_length("text").cast("long"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, bad``: a url ends in the id of the document it shows; that is bad if of low quality or toxic."""
    ends = F.regexp_extract(hosts.path_of(F.col("url")), r"/([0-9]{1,18})(?:/|\.html)?$", 1)
    shown = pages.select(hosts.host_of(F.col("url")).alias("host"), F.when(ends != "", ends).cast("bigint").alias("doc_id"))
    marks = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return shown.join(marks, "doc_id").select("host", "bad")


def op9_url_filter(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return hosts.judged(pages, page_outcomes(pages, _table(spark, sf_dir, "labels")), RULES)


def op10_near_vectors(spark, sf_dir):
    return rabitq.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op11_source_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_collocations(spark, sf_dir):
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_packing(spark, sf_dir):
    pieces = packing.packed(_table(spark, sf_dir, "documents"), word_tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    f.__name__: f
    for f in (op1_sentencepiece, op2_simhash, op3_repeated_passages, op4_mixture, op5_top_k, op6_secrets, op7_quality, op8_main_text,
              op9_url_filter, op10_near_vectors, op11_source_divergence, op12_collocations, op13_packing)
}
