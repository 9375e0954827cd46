"""Vocabulary tables: ``token_id, token, token_hex, is_special``."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VOCAB_SCHEMA = "token_id int, token binary, token_hex string, is_special boolean"
MERGES_SCHEMA = "rank int, left_hex string, right_hex string"


def base_entries(specials: list[str]) -> list[tuple[int, bytes, bool]]:
    """Ids 0-255 are the bytes, then the given specials that are not among them."""
    entries = [(b, bytes([b]), False) for b in range(256)]
    known = {token for _, token, _ in entries}
    for special in specials:
        token = special.encode("utf-8")
        if token not in known:
            known.add(token)
            entries.append((len(entries), token, True))
    return entries


def vocab_frame(spark: SparkSession, entries: list[tuple[int, bytes, bool]]) -> DataFrame:
    rows = [(token_id, bytearray(token), token.hex().upper(), special) for token_id, token, special in entries]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def merges_frame(spark: SparkSession, merges: list[tuple[bytes, bytes]]) -> DataFrame:
    rows = [(rank, left.hex().upper(), right.hex().upper()) for rank, (left, right) in enumerate(merges)]
    return spark.createDataFrame(rows, MERGES_SCHEMA)


def base_vocab(spark: SparkSession, specials: list[str]) -> DataFrame:
    return vocab_frame(spark, base_entries(list(specials)))


def extend_vocab(vocab: DataFrame, specials: list[str]) -> DataFrame:
    """Append the specials that are missing, from ``max(token_id) + 1`` on, in given order."""
    spark = vocab.sparkSession
    wanted = [(i, bytearray(s.encode("utf-8"))) for i, s in enumerate(dict.fromkeys(specials))]
    missing = spark.createDataFrame(wanted, "place int, token binary").join(vocab, "token", "left_anti")
    # The specials are a job parameter, so numbering them in one window is bounded.
    added = missing.select((F.row_number().over(Window.orderBy("place")) - 1).alias("nth"), "token")
    last = vocab.agg(F.coalesce(F.max("token_id"), F.lit(-1)).alias("last")).scalar()
    return vocab.unionByName(
        added.select(
            (last + 1 + F.col("nth")).cast("int").alias("token_id"),
            "token",
            F.hex("token").alias("token_hex"),
            F.lit(True).alias("is_special"),
        )
    )


def longest_tokens(vocab: DataFrame, k: int) -> DataFrame:
    """The k tokens with most bytes; ties to the greater bytes, then the greater id."""
    sized = vocab.select("token_id", "token_hex", (F.length("token_hex") / 2).cast("int").alias("n_bytes"))
    return sized.orderBy(F.desc("n_bytes"), F.desc("token_hex"), F.desc("token_id")).limit(k)


def special_leaks(vocab: DataFrame, marker: str = "<|") -> DataFrame:
    """Learned tokens that contain the opening of a special token; should be empty."""
    # Compared at even hex positions so that a match starts on a byte.
    pattern = f"^(?:..)*{marker.encode('utf-8').hex().upper()}"
    return vocab.where(~F.col("is_special") & F.col("token_hex").rlike(pattern))
