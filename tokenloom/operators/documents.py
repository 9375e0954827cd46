"""Documents inside delimited text, and chunk boundaries at delimiters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators.positions import starts
from tokenloom.session import stored


def document_split(docs: DataFrame, delimiter: str = tx.END_OF_TEXT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, part_pos, text``: the pieces between delimiters, empty ones included."""
    parts = F.split(F.col(text), _literal_pattern(delimiter), -1)
    return docs.select(key, F.posexplode(parts).alias("part_pos", text))


def _literal_pattern(delimiter: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in delimiter)


def special_split(docs: DataFrame, specials: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece_pos, piece, is_special``: text cut at specials, which are kept."""
    specials = list(specials)
    pieces = docs.select(key, F.posexplode(tx.special_pieces(F.col(text), specials)).alias("piece_pos", "piece"))
    return pieces.withColumn("is_special", tx.is_special(F.col("piece"), specials))


def chunk_boundaries(
    docs: DataFrame, n_chunks: int, delimiter: str = tx.END_OF_TEXT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``boundary``: byte offsets that cut the corpus into at most ``n_chunks`` chunks.

    The corpus is all texts in key order, each followed by the delimiter. Each inner cut
    is a multiple of ``size // n_chunks`` moved to the next delimiter start, or to the
    end. Whether some cut moves to a given delimiter follows from its own offset and the
    one before it, so the guesses are never joined with the documents.
    """
    spark, width = docs.sparkSession, len(delimiter.encode("utf-8"))
    parts = F.split(F.col(text), _literal_pattern(delimiter), -1)
    # Bytes of each part with its delimiter, stored once; the texts themselves go no further.
    sizes = stored(
        docs.select(key, F.transform(parts, lambda p: (F.octet_length(p) + width).cast("long")).alias("part_sizes")), "parts")
    rows = sizes.select(key, F.aggregate("part_sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_bytes"))
    found, size = starts(rows, key, "n_bytes", "row_start")
    step = size // n_chunks
    placed = sizes.join(found, key)

    def visit(state, part_size):
        """Go over one part and its delimiter; keep the delimiter's offset if a cut moves there."""
        start = state["start"]
        found = start + part_size - width
        previous = F.when(start > 0, start - width).otherwise(F.lit(-1))
        if step:
            first_guess = F.greatest(F.lit(1), F.floor(previous / step) + 1)
            wanted = (first_guess <= n_chunks - 1) & (first_guess * step <= found)
        else:
            wanted = (start == 0) & F.lit(n_chunks > 1)
        cuts = F.when(wanted, F.array_append(state["cuts"], found)).otherwise(state["cuts"])
        return F.struct((start + part_size).alias("start"), cuts.alias("cuts"))

    before = F.struct(F.col("row_start").alias("start"), F.array().cast("array<bigint>").alias("cuts"))
    # Linear in the parts of a row; all rows together find at most n_chunks - 1 cuts.
    inner = placed.select(F.explode(F.aggregate("part_sizes", before, visit)["cuts"]).alias("boundary"))
    ends = spark.createDataFrame([(0,), (size,)], "boundary long")
    return inner.unionByName(ends).distinct()
