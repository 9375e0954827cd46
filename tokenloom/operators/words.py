"""Pre-token counts and adjacent-pair statistics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import symbols as sym
from tokenloom.functions import text as tx


def pretokenize(docs: DataFrame, specials: list[str] = (), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per token: ``key, tok_pos, token, is_special``. Narrow, no shuffle."""
    specials = list(specials)
    rows = docs.select(key, F.posexplode(tx.tokens(F.col(text), specials)).alias("tok_pos", "token"))
    return rows.withColumn("is_special", tx.is_special(F.col("token"), specials))


def byte_sequences(words: DataFrame, token: str = "token") -> DataFrame:
    """Adds ``bytes_hex``, the UTF-8 bytes of the token as spaced hex."""
    return words.withColumn("bytes_hex", tx.spaced_hex(tx.utf8_bytes(F.col(token))))


def pretoken_counts(docs: DataFrame, specials: list[str] = (), text: str = "text") -> DataFrame:
    """``token, is_special, n``. Counted map-side first, so a hot token costs one row per task."""
    specials = list(specials)
    rows = docs.select(F.explode(tx.tokens(F.col(text), specials)).alias("token"))
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("token", tx.is_special(F.col("token"), specials).alias("is_special"), "n")


def corpus_stats(counts: DataFrame) -> DataFrame:
    """Total and distinct words."""
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"), F.count(F.lit(1)).alias("unique_words")
    )


def word_table(counts: DataFrame) -> DataFrame:
    """``word, n``: symbol strings of the plain words that hold at least one pair."""
    words = counts.where(~F.col("is_special")).select(sym.base_word(F.col("token")).alias("word"), "n")
    return words.where(F.length("word") > 1)


# Long words are first cut into pieces that overlap by one symbol, because finding the
# i-th symbol of a string takes i steps.
PAIR_ROWS = """
    SELECT substr(piece, at, 2) AS pair, n FROM (
      SELECT piece, n, explode(sequence(1, length(piece) - 1)) AS at FROM (
        SELECT substr(word, 64 * piece_no + 1, 65) AS piece, n FROM (
          SELECT word, n, explode(sequence(0, (length(word) - 2) div 64)) AS piece_no
          FROM {words} WHERE length(word) > 1)))
"""


def explode_pairs(words: DataFrame) -> DataFrame:
    """``pair, n`` for each adjacent position; ``aaa`` gives ``aa`` twice."""
    return words.sparkSession.sql(PAIR_ROWS, words=words)


def pair_counts(words: DataFrame) -> DataFrame:
    return explode_pairs(words).groupBy("pair").agg(F.sum("n").alias("n"))


def pair_hex(pair: str, hexes: Column) -> list[Column]:
    """Columns ``left_hex, right_hex`` of a two-character pair."""
    return [
        F.get(hexes, sym.symbol_index(F.substr(F.col(pair), F.lit(at), F.lit(1)))).alias(name)
        for at, name in ((1, "left_hex"), (2, "right_hex"))
    ]


def pair_stats(words: DataFrame, table: sym.SymbolTable | None = None) -> DataFrame:
    """``left_hex, right_hex, n``: word frequency summed over every adjacent position."""
    hexes = (table or sym.SymbolTable()).hex_literal()
    return pair_counts(words).select(*pair_hex("pair", hexes), "n")


def top_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The k best pairs: most frequent, ties to the greater left, then right bytes."""
    return pairs.orderBy(F.desc("n"), F.desc("left_hex"), F.desc("right_hex")).limit(k)


def best_pair(pairs: DataFrame) -> DataFrame:
    """One row. A maximum of structs, so each task passes on a single candidate."""
    best = pairs.agg(F.max(F.struct("n", "left_hex", "right_hex")).alias("best"))
    return best.where(F.col("best").isNotNull()).select("best.left_hex", "best.right_hex", "best.n")


def apply_merge(words: DataFrame, left: bytes, right: bytes, table: sym.SymbolTable) -> DataFrame:
    """Merge one pair in every word; the table learns the new token."""
    return words.withColumn("word", sym.apply_rules(F.col("word"), [table.merge_rule(left, right)]))


def words_to_hex(words: DataFrame, table: sym.SymbolTable) -> DataFrame:
    """``token_hex, n`` with each token of the word between blanks."""
    hexes = table.hex_literal()
    spelled = F.transform(
        sym.characters(F.col("word")),
        lambda c: F.concat(F.lit(" "), F.get(hexes, sym.symbol_index(c)), F.lit(" ")),
    )
    return words.select(F.concat_ws("", spelled).alias("word_hex"), "n")
