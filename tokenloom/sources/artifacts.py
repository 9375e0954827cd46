"""Tokenizer tables on storage, and the published text format (vocab JSON + merges)."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import printable
from tokenloom.operators import vocab as vb
from tokenloom.session import delete, exists, read_text, write_text


#: Says what a whole artifact holds; written last.
MANIFEST = "manifest.json"


def _content(table: DataFrame) -> dict[str, str]:
    """Number of rows and a digest of them, the same in any order and any number of files."""
    columns = [F.col(c) for c in sorted(table.columns)]
    sums = [F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)")) for salt in ("a", "b")]
    row = table.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(s, F.lit(0)).cast("string").alias(f"s{i}") for i, s in enumerate(sums))).first()
    return {"rows": str(row["n"]), "digest": f"{row['s0']}:{row['s1']}"}


def save_tokenizer(vocab: DataFrame, merges: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Writes both tables, then a manifest of what they hold.

    An artifact is there once its manifest is; a save that stops before leaves none that can be loaded,
    also where it was to overwrite another. ``mode`` is "errorifexists" or "overwrite".
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"an artifact is written anew or over another, not by {mode}")
    spark = vocab.sparkSession
    if mode == "overwrite":
        delete(spark, f"{folder}/{MANIFEST}")
    found = {}
    for name, table in (("vocab", vocab), ("merges", merges)):
        table.coalesce(1).write.mode(mode).parquet(f"{folder}/{name}")
        found[name] = _content(spark.read.schema(table.schema).parquet(f"{folder}/{name}"))
    write_text(spark, f"{folder}/{MANIFEST}", json.dumps(found))


def _read_checked(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    found = spark.read.parquet(path)
    wanted = spark.createDataFrame([], ddl).schema
    missing = [f for f in wanted if f.name not in found.columns or found.schema[f.name].dataType != f.dataType]
    if missing:
        raise ValueError(f"{path}: columns missing or of another type: {missing}")
    return found


def load_tokenizer(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``vocab, merges`` as saved. The schema is checked, and the rows against the manifest.

    An artifact without a manifest was not written to its end; one with a table of another
    artifact, or with files missing, holds other rows than its manifest says. Both are refused.
    """
    tables = {
        name: _read_checked(spark, f"{folder}/{name}", ddl)
        for name, ddl in (("vocab", vb.VOCAB_SCHEMA), ("merges", vb.MERGES_SCHEMA))
    }
    if not exists(spark, f"{folder}/{MANIFEST}"):
        raise ValueError(f"{folder}: no manifest, so the artifact is not whole")
    manifest = json.loads(read_text(spark, f"{folder}/{MANIFEST}"))
    for name, table in tables.items():
        if manifest.get(name) != _content(table):
            raise ValueError(f"{folder}/{name}: not the rows of the manifest")
    wanted = {"vocab": vb.VOCAB_SCHEMA, "merges": vb.MERGES_SCHEMA}
    vocab, merges = (tables[n].select(*spark.createDataFrame([], ddl).columns) for n, ddl in wanted.items())
    return vocab, merges


def printable_vocab(vocab: DataFrame) -> DataFrame:
    """``token_id, printable``."""
    return vocab.select("token_id", printable.to_printable(F.col("token")).alias("printable"))


def printable_merges(merges: DataFrame) -> DataFrame:
    """``rank, line``: the two tokens with one blank between."""
    left, right = (printable.to_printable(F.unhex(side)) for side in ("left_hex", "right_hex"))
    return merges.select("rank", F.concat_ws(" ", left, right).alias("line"))


def export_text_format(vocab: DataFrame, merges: DataFrame, folder: str) -> None:
    """Writes ``vocab`` (one JSON object) and ``merges`` (lines in rank order) as text.

    Both files are bounded by the vocabulary size, hence single partitions.
    """
    # Equal bytes under several ids share one name; the format keeps the greatest id, as encoding does.
    named = printable_vocab(vocab).groupBy("printable").agg(F.max("token_id").alias("token_id"))
    entries = F.array_sort(F.collect_list(F.struct("token_id", "printable")))
    as_map = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["printable"], e["token_id"])))
    named.agg(F.to_json(as_map).alias("value")).coalesce(1).write.text(f"{folder}/vocab")
    lines = F.array_sort(F.collect_list(F.struct("rank", "line")))
    printable_merges(merges).agg(
        F.array_join(F.transform(lines, lambda e: e["line"]), "\n").alias("value")
    ).coalesce(1).write.text(f"{folder}/merges")


def import_text_format(
    spark: SparkSession, vocab_path: str, merges_path: str, specials: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``vocab, merges`` from the text format; missing specials are appended.

    Lines without exactly one blank (such as a version header) are skipped.
    """
    whole = spark.read.text(vocab_path, wholetext=True)
    entries = whole.select(F.explode(F.from_json("value", "map<string,int>")).alias("printable", "token_id"))
    token = printable.from_printable(F.col("printable"))
    names = [s.encode("utf-8").hex().upper() for s in specials]
    vocab = entries.select("token_id", token.alias("token")).select(
        "token_id",
        "token",
        F.hex("token").alias("token_hex"),
        (F.hex("token").isin(*names) if names else F.lit(False)).alias("is_special"),
    )
    lines = spark.read.text(merges_path, wholetext=True).select(
        F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")
    )
    # Trailing white space is not part of a line.
    lines = lines.withColumn("line", F.regexp_replace("line", r"\s+$", ""))
    parts = F.split("line", " ", -1)
    kept = lines.where((F.col("line") != "") & (F.size(parts) == 2)).select("line_no", parts.alias("parts"))
    ranked = kept.agg(F.array_sort(F.collect_list(F.struct("line_no", "parts"))).alias("all")).select(
        F.posexplode("all").alias("rank", "m")
    )
    sides = [F.hex(printable.from_printable(F.col("m.parts")[i])).alias(n) for i, n in ((0, "left_hex"), (1, "right_hex"))]
    return vb.extend_vocab(vocab, list(specials)), ranked.select("rank", *sides)
