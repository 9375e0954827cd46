"""The registered queries: each runs one operator over whole tables of ``sf_dir``.

Arrays are shown as text or in long form so that results compare in any engine.
"""

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import runs
from tokenloom.functions import symbols as sym
from tokenloom.functions import text as tx
from tokenloom.operators import dictionary as dct
from tokenloom.operators import documents as dc
from tokenloom.operators import tokenizer as tk
from tokenloom.operators import vectors as vec
from tokenloom.operators import vocab as vb
from tokenloom.operators import windows as win
from tokenloom.operators import words as wd
from tokenloom.plans.train import train_bpe
from tokenloom.session import is_folder, shared_folder, stored, with_arrow_batches
from tokenloom.sources import artifacts as art
from tokenloom.sources import blocks as blk
from tokenloom.sources import corpus as src
from tokenloom.streaming import text as st

SPECIALS = [tx.END_OF_TEXT, tx.END_OF_TEXT * 2]
#: Enough for the plan that larger vocabularies get, too.
N_MERGES = 64
#: Merges of the tokenizers that are saved and loaded again.
N_SAVED = 8
#: More than the texts of one column have pairs for.
N_EXHAUSTED = 12
N_CHUNKS = 16
#: Less than many a text has bytes.
SMALL_RANGE = 1 << 16
#: Bytes of an Arrow batch of long texts.
SMALL_BATCH = 8 << 20
CONTEXT = 16
#: Fewer than the texts have words.
HOT_WORDS = 4096
#: Ids of a stored block.
BLOCK = 1024
BATCH = 256
TOP = 20
WIDTH = 64
SAMPLES = 4096
CELLS = 8
POINT_PARTS = 512
VOCAB_SIZE = 256 + len(SPECIALS) + N_MERGES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return src.read_documents(spark, f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.spread(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with special tokens in them: every line end is a delimiter."""
    return _documents(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit(tx.END_OF_TEXT)))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns under one number: conversation by conversation, with room for the longest one."""
    rows = _table(spark, sf_dir, "conversations")
    room = rows.agg((F.coalesce(F.max("turn"), F.lit(0)) + 1).alias("room")).scalar()
    return src.spread(rows.select((F.col("conv_id") * room + F.col("turn")).alias("doc_id"), "text"), "doc_id")


def _role_specials(spark: SparkSession, sf_dir: str) -> list[str]:
    """One special token per role of the conversations, as many as there are: each becomes an entry of the vocabulary."""
    roles = _table(spark, sf_dir, "conversations").select("role").distinct().orderBy("role")
    return [f"<|{r.role}|>" for r in roles.collect()]


# A corpus is trained and encoded once per application and state of its files; the queries below read the tables.


def _state(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """What a table is made of: its files with size and time. Few rows per file, none of the data is read."""
    files = _table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return tuple(sorted(map(str, files.distinct().collect())))


@lru_cache(maxsize=None)
def _artifacts(application_id: str, spark: SparkSession, sf_dir: str, state: tuple) -> str:
    folder = shared_folder(spark, "tokenizer")
    trained = train_bpe(_documents(spark, sf_dir), VOCAB_SIZE, SPECIALS)
    art.save_tokenizer(trained.vocab, trained.merges, folder)
    return folder


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    state = _state(spark, sf_dir, "documents")
    return art.load_tokenizer(spark, _artifacts(spark.sparkContext.applicationId, spark, sf_dir, state))


def _tokenizer(spark: SparkSession, sf_dir: str) -> tk.Tokenizer:
    return tk.Tokenizer.from_tables(*_tables(spark, sf_dir), SPECIALS)


@lru_cache(maxsize=None)
def _encoded_folder(application_id: str, spark: SparkSession, sf_dir: str, name: str, state: tuple) -> str:
    folder = shared_folder(spark, f"encoded-{name}")
    docs = {"documents": _documents, "conversations": _turns}[name](spark, sf_dir)
    tk.encode_documents(docs, _tokenizer(spark, sf_dir)).write.parquet(folder)
    return folder


def _encoded(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    state = _state(spark, sf_dir, name) + _state(spark, sf_dir, "documents")
    return spark.read.parquet(_encoded_folder(spark.sparkContext.applicationId, spark, sf_dir, name, state))


def _as_text(ids: str) -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), " ").alias(ids)


def _rounded(value) -> Column:
    return F.round(value, 6) + F.lit(0.0)


def _long_form(rows: DataFrame, keys: list[str], vector: str) -> DataFrame:
    each = rows.select(*keys, F.posexplode(vector).alias("dim", "value"))
    return each.select(*keys, "dim", _rounded(F.col("value")).alias("value"))


def _vocab_view(vocab: DataFrame) -> DataFrame:
    return vocab.select("token_id", "token_hex", "is_special")


# Sources and sinks


def corpus_scan(spark, sf_dir):
    return src.corpus_scan(_table(spark, sf_dir, "documents"))


def chunk_boundaries(spark, sf_dir):
    return dc.chunk_boundaries(_delimited(spark, sf_dir), N_CHUNKS)


def document_split(spark, sf_dir):
    return dc.document_split(_delimited(spark, sf_dir))


def utf8_ignore(spark, sf_dir):
    """Malformed bytes put before, between and after copies of each text."""
    text = F.hex(F.encode("text", "UTF-8"))
    broken = F.concat(F.lit("FF"), text, F.lit("E282"), text, F.lit("C3"), text, F.lit("F09F99"))
    return _documents(spark, sf_dir).select("doc_id", tx.utf8_ignore(F.unhex(broken)).alias("text"))


def _tokenizer_rows(vocab: DataFrame, merges: DataFrame) -> DataFrame:
    entries = vocab.select(F.lit("vocab").alias("kind"), F.col("token_id").alias("no"), F.col("token_hex").alias("a"),
                           F.lit("").alias("b"))
    return entries.unionByName(merges.select(F.lit("merge").alias("kind"), F.col("rank").alias("no"),
                                             F.col("left_hex").alias("a"), F.col("right_hex").alias("b")))


def _first_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The tokenizer of the first merges: SQL of few merges gives the same tables."""
    vocab, merges = _tables(spark, sf_dir)
    return vocab.where(F.col("token_id") < 256 + len(SPECIALS) + N_SAVED), merges.where(F.col("rank") < N_SAVED)


def artifact_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "copy")
    art.save_tokenizer(*_first_tables(spark, sf_dir), folder)
    return _tokenizer_rows(*art.load_tokenizer(spark, folder))


def gpt2_export(spark, sf_dir):
    vocab, merges = _tables(spark, sf_dir)
    entries = art.printable_vocab(vocab).select(
        F.lit("vocab").alias("kind"), F.col("token_id").alias("no"), F.col("printable").alias("line"))
    return entries.unionByName(
        art.printable_merges(merges).select(F.lit("merge").alias("kind"), F.col("rank").alias("no"), "line"))


def gpt2_import(spark, sf_dir):
    folder = shared_folder(spark, "text-format")
    art.export_text_format(*_first_tables(spark, sf_dir), folder)
    return _tokenizer_rows(*art.import_text_format(spark, f"{folder}/vocab", f"{folder}/merges", SPECIALS))


# Text


def delimited_files(spark, sf_dir):
    """Texts written as one delimited file with malformed bytes in it, read back and counted in pre-tokens."""
    folder = shared_folder(spark, "delimited")
    broken = F.concat(F.lit("FF"), F.hex(F.encode("text", "UTF-8")), F.lit("E282"))
    lines = _documents(spark, sf_dir).select(F.unhex(broken).cast("string").alias("value"))
    lines.write.option("lineSep", tx.END_OF_TEXT).text(folder)
    return wd.pretoken_counts(src.read_delimited(spark, folder)).select("token", "n")


def delimited_ranges(spark, sf_dir):
    """Texts written as delimited files in the order of their ids, read back by ranges of 64 KB: offset and size of each."""
    folder = shared_folder(spark, "ranges")
    lines = _documents(spark, sf_dir).sort("doc_id").select(F.coalesce("text", F.lit("")).alias("value"))
    lines.write.option("lineSep", tx.END_OF_TEXT).text(folder)
    found = src.read_delimited(spark, folder, range_bytes=SMALL_RANGE)
    return found.select("doc_id", F.octet_length("text").alias("n_bytes"), F.md5("text").alias("digest"))


def special_split(spark, sf_dir):
    return dc.special_split(_delimited(spark, sf_dir), SPECIALS)


def pretokenize(spark, sf_dir):
    return wd.pretokenize(_documents(spark, sf_dir)).select("doc_id", "tok_pos", "token")


def pretokenize_runs(spark, sf_dir):
    """Runs of white space, ASCII and not, before each sentence."""
    spaced = F.replace("text", F.lit(". "), F.lit(". \u00a0\n  "))
    docs = _documents(spark, sf_dir).withColumn("text", spaced)
    return wd.pretokenize(docs).select("doc_id", "tok_pos", "token")


def pretokenize_code_points(spark, sf_dir):
    """Each text with a part of all characters put between, after and before letters, digits, blanks and each other.

    A text gets the code points that leave the same remainder as its id; together, texts get all but
    surrogates and the one that marks white space in the SQL.
    """
    spark = with_arrow_batches(spark, SMALL_BATCH)
    codes = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(0x110000 // POINT_PARTS - 1)), lambda i: i * POINT_PARTS + F.col("part").cast("int")),
        lambda c: (c > 0) & ~c.between(0xD800, 0xE000))

    # Decoded at once; the first of them is below 1024, so that no byte order mark is taken for one.
    each = F.decode(F.unhex(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 8, "0")), "")), "UTF-32")
    spread_out = F.regexp_replace(each, "(?s)(?<c>.)", "x${c}7${c} ${c}y ${c}${c}")
    # One row for each remainder, 25 MB in all: made once and sent to the tasks.
    parts = spark.range(POINT_PARTS).withColumnRenamed("id", "part").select("part", spread_out.alias("spread_out"))
    text = F.concat(F.coalesce("text", F.lit("")), F.col("spread_out"))
    docs = _documents(spark, sf_dir).withColumn("part", F.pmod("doc_id", F.lit(POINT_PARTS)).cast("long"))
    docs = docs.join(F.broadcast(parts), "part", "left").select("doc_id", text.alias("text"))
    words = tx.pretokens(F.col("text"), then=runs.sizes_and_digests("\n"))
    found = docs.select("doc_id", words.alias("found"))
    return found.select("doc_id", F.col("found.size").alias("n_tokens"), "found.digest")


def byte_sequences(spark, sf_dir):
    words = wd.pretoken_counts(_documents(spark, sf_dir))
    return wd.byte_sequences(words).select("token", "bytes_hex")


def special_encode(spark, sf_dir):
    docs = tk.encode_documents(_delimited(spark, sf_dir), _tokenizer(spark, sf_dir))
    return docs.select("doc_id", _as_text("ids"))


def vocab_leak_check(spark, sf_dir):
    return vb.special_leaks(_tables(spark, sf_dir)[0]).agg(F.count(F.lit(1)).alias("n_leaks"))


# Counts and pairs


def pretoken_counts(spark, sf_dir):
    return wd.pretoken_counts(_documents(spark, sf_dir)).select("token", "n")


def corpus_stats(spark, sf_dir):
    return wd.corpus_stats(wd.pretoken_counts(_documents(spark, sf_dir)))


def _words(spark, sf_dir) -> DataFrame:
    return wd.word_table(wd.pretoken_counts(_documents(spark, sf_dir)))


def pair_stats(spark, sf_dir):
    return wd.pair_stats(_words(spark, sf_dir))


def best_pair(spark, sf_dir):
    return wd.best_pair(pair_stats(spark, sf_dir))


def top_pairs(spark, sf_dir):
    return wd.top_pairs(pair_stats(spark, sf_dir), TOP)


def apply_merge(spark, sf_dir):
    words, table = stored(_words(spark, sf_dir), "words"), sym.SymbolTable()
    best = wd.best_pair(wd.pair_stats(words)).first()
    merged = wd.apply_merge(words, bytes.fromhex(best.left_hex), bytes.fromhex(best.right_hex), table)
    return wd.words_to_hex(merged, table)


# Training and vocabulary


def train(spark, sf_dir):
    return train_bpe(_documents(spark, sf_dir), VOCAB_SIZE, SPECIALS).merges


def train_exhausted(spark, sf_dir):
    """A corpus whose pairs run out long before the vocabulary is full, and empty texts: training stops early."""
    docs = _table(spark, sf_dir, "documents").select(F.col("lang").alias("text"))
    return train_bpe(docs.unionByName(docs.select(F.lit("").alias("text"))), 256 + N_EXHAUSTED, []).merges


def trained_vocab(spark, sf_dir):
    return _vocab_view(_tables(spark, sf_dir)[0])


def base_vocab(spark, sf_dir):
    return _vocab_view(vb.base_vocab(spark, _role_specials(spark, sf_dir)))


def extend_vocab(spark, sf_dir):
    vocab = _tables(spark, sf_dir)[0]
    return _vocab_view(vb.extend_vocab(vocab, SPECIALS + _role_specials(spark, sf_dir)))


def longest_tokens(spark, sf_dir):
    return vb.longest_tokens(_tables(spark, sf_dir)[0], TOP)


# Encode and decode


def encode_words(spark, sf_dir):
    words = wd.pretoken_counts(_documents(spark, sf_dir)).select("token")
    return tk.encode_words(words, _tokenizer(spark, sf_dir)).select("token", _as_text("ids"))


def encode_documents(spark, sf_dir):
    encoded = tk.encode_documents(_documents(spark, sf_dir), _tokenizer(spark, sf_dir))
    return encoded.select("doc_id", _as_text("ids"))


def encode_documents_arrow(spark, sf_dir):
    """The way large vocabularies are encoded, on the same input."""
    docs, tokenizer = _documents(spark, sf_dir), _tokenizer(spark, sf_dir)
    lists = tx.tokens(F.col("text"), tokenizer.specials)
    return docs.select("doc_id", tk.ids_by_arrow(tokenizer)(lists).alias("ids")).select("doc_id", _as_text("ids"))


def encode_kept_words(spark, sf_dir):
    """Through a kept table of words; all but the most frequent ones come from the table."""
    words = dct.WordDictionary(spark, shared_folder(spark, "words"), _tokenizer(spark, sf_dir))
    return words.encode(_documents(spark, sf_dir), hot_words=HOT_WORDS).select("doc_id", _as_text("ids"))


def decode_documents(spark, sf_dir):
    return tk.decode_documents(_encoded(spark, sf_dir, "documents"), _tokenizer(spark, sf_dir))


def token_strings(spark, sf_dir):
    return tk.token_strings(_encoded(spark, sf_dir, "conversations"), _tokenizer(spark, sf_dir))


def roundtrip_mismatches(spark, sf_dir):
    return tk.roundtrip_mismatches(_delimited(spark, sf_dir), _tokenizer(spark, sf_dir))


def token_counts(spark, sf_dir):
    return tk.token_counts(_encoded(spark, sf_dir, "documents"))


# Stream and windows


def token_stream(spark, sf_dir):
    return win.token_stream(_encoded(spark, sf_dir, "documents"))


def lm_windows(spark, sf_dir):
    windows = win.lm_windows(_encoded(spark, sf_dir, "conversations"), CONTEXT)
    return windows.select("start", _as_text("x"), _as_text("y"))


def lm_batch(spark, sf_dir):
    """What a random batch must satisfy, counted; starts may leave the mean of a uniform draw by five sigma in no cell."""
    encoded = _encoded(spark, sf_dir, "documents")
    total = encoded.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("total"))
    last = total.scalar() - CONTEXT
    batch = win.lm_batch(encoded, SAMPLES, CONTEXT, seed=7)
    moved = F.slice("y", 1, CONTEXT - 1) == F.slice("x", 2, CONTEXT - 1)
    sized = (F.size("x") == CONTEXT) & (F.size("y") == CONTEXT)
    inside = (F.col("start") >= 0) & (F.col("start") < last)
    mean, sigma = SAMPLES / CELLS, (SAMPLES / CELLS * (1 - 1 / CELLS)) ** 0.5
    in_cell = [F.sum((F.floor(F.col("start") * CELLS / last) == i).cast("long")) for i in range(CELLS)]
    uneven = [(F.abs(n - F.lit(mean)) > 5 * sigma).cast("long") for n in in_cell]
    return batch.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum((~(moved & sized)).cast("long")).alias("bad_windows"),
        F.sum((~inside).cast("long")).alias("bad_starts"),
        sum(uneven[1:], uneven[0]).alias("bad_cells"),
        F.max(total.scalar()).alias("n_ids"),
    )


def lm_batch_fixed(spark, sf_dir):
    encoded = _encoded(spark, sf_dir, "documents")
    total = encoded.agg(F.sum(F.size("ids"))).first()[0]
    starts = spark.range(BATCH).select(
        F.col("id").alias("sample_id"), ((F.col("id") * 7919) % (total - CONTEXT)).alias("start"))
    batch = win.windows_at(encoded, starts, CONTEXT)
    return batch.select("sample_id", "start", _as_text("x"), _as_text("y"))


@lru_cache(maxsize=None)
def _blocks_folder(application_id: str, encoded: str) -> str:
    spark = SparkSession.getActiveSession()
    folder = shared_folder(spark, "blocks")
    blk.write_blocks(spark.read.parquet(encoded), folder, BLOCK)
    return folder


def _block_store(spark: SparkSession, sf_dir: str, name: str) -> blk.BlockStore:
    state = _state(spark, sf_dir, name) + _state(spark, sf_dir, "documents")
    application_id = spark.sparkContext.applicationId
    return blk.BlockStore(spark, _blocks_folder(application_id, _encoded_folder(application_id, spark, sf_dir, name, state)))


def stored_batch(spark, sf_dir):
    """Windows at given starts from blocks that were written once."""
    store = _block_store(spark, sf_dir, "documents")
    starts = spark.range(BATCH).select(
        F.col("id").alias("sample_id"), ((F.col("id") * 7919) % (store.n_ids - CONTEXT)).alias("start"))
    return store.windows_at(starts, CONTEXT).select("sample_id", "start", _as_text("x"), _as_text("y"))


def stored_windows(spark, sf_dir):
    """All windows of the blocks of the conversations."""
    return _block_store(spark, sf_dir, "conversations").windows(CONTEXT).select("start", _as_text("x"), _as_text("y"))


# Vectors


def embedding_lookup(spark, sf_dir):
    items = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    encoded = tk.encode_documents(items, _tokenizer(spark, sf_dir))
    found = vec.embedding_lookup(encoded, _table(spark, sf_dir, "embeddings"), WIDTH)
    each = found.select("doc_id", "pos", "token_id", F.posexplode("vector").alias("dim", "value"))
    return each.withColumn("value", _rounded(F.col("value").cast("double")))


def vector_project(spark, sf_dir):
    """Projection onto the mean vector of each label."""
    rows = _table(spark, sf_dir, "embeddings")
    means = rows.select("label", F.posexplode("embedding").alias("dim", "x")).groupBy("label", "dim").agg(
        F.avg(F.col("x").cast("double")).alias("mean"))
    weights = means.groupBy(F.col("label").alias("row_no")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda m: m["mean"]).alias("weights"))
    return _long_form(vec.vector_project(rows, weights, WIDTH), ["vec_id"], "projected")


def rms_normalize(spark, sf_dir):
    return _long_form(vec.rms_normalize(_table(spark, sf_dir, "embeddings")), ["vec_id"], "normalized")


def group_softmax(spark, sf_dir):
    """Scores are the sums of all components."""
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", total.alias("score"))
    weighted = vec.group_softmax(rows, "label", "score")
    return weighted.select("vec_id", "label", _rounded(F.col("p")).alias("p"))


def attention_pool(spark, sf_dir):
    """Each vector sees the others of its label, not itself."""
    rows = _table(spark, sf_dir, "embeddings")
    queries = rows.select(F.col("label").alias("batch"), F.col("vec_id").alias("q_id"), F.col("embedding").alias("q"))
    keys = rows.select(F.col("label").alias("batch"), F.col("vec_id").alias("k_id"), F.col("embedding").alias("k"),
                       F.col("embedding").alias("v"))
    pooled = vec.attention_pool(queries, keys, WIDTH, mask=lambda q, k: q != k)
    return _long_form(pooled, ["batch", "q_id"], "pooled")


def causal_pool(spark, sf_dir):
    pooled = vec.causal_pool(_table(spark, sf_dir, "embeddings"), WIDTH, "label", "vec_id")
    return _long_form(pooled, ["batch", "q_id"], "pooled")


def cross_entropy(spark, sf_dir):
    """All components as logits, as they are and a thousand times larger."""
    rows = _table(spark, sf_dir, "embeddings")
    logits = F.col("embedding").cast("array<double>")
    losses = [
        vec.cross_entropy(rows, F.transform(logits, lambda x: x * scale), F.col("label")).select(
            F.lit(scale).alias("scale"), _rounded(F.col("loss")).alias("loss"), "n_rows")
        for scale in (1, 1000)
    ]
    return losses[0].unionByName(losses[1])


def clip_l2_norm(spark, sf_dir):
    return _long_form(vec.clip_l2_norm(_table(spark, sf_dir, "embeddings"), 1.0), ["vec_id"], "clipped")


# Streams


def _document_stream(spark, sf_dir) -> DataFrame:
    schema = _table(spark, sf_dir, "documents").schema
    # A table is one file or a folder of files.
    path = f"{sf_dir}/documents.parquet"
    if is_folder(spark, path):
        return st.read_stream(spark, path, schema).select("doc_id", "text")
    return st.read_stream(spark, sf_dir, schema, pathGlobFilter="documents.parquet").select("doc_id", "text")


def encode_stream(spark, sf_dir):
    out = shared_folder(spark, "stream-encode")
    query = st.write_encoded_stream(
        _document_stream(spark, sf_dir), _tokenizer(spark, sf_dir), f"{out}/data", f"{out}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{out}/data").select("doc_id", _as_text("ids"))


def stream_pretoken_counts(spark, sf_dir):
    out = shared_folder(spark, "stream-counts")
    query = st.write_count_stream(_document_stream(spark, sf_dir), f"{out}/data", f"{out}/checkpoint")
    query.awaitTermination()
    return st.read_counts(spark, f"{out}/data").select("token", "n")


QUERIES = {
    f.__name__: f
    for f in (
        corpus_scan, chunk_boundaries, document_split, utf8_ignore, artifact_roundtrip, gpt2_import, gpt2_export,
        delimited_files, delimited_ranges, special_split, pretokenize, pretokenize_runs, pretokenize_code_points, byte_sequences, special_encode, vocab_leak_check,
        pretoken_counts, corpus_stats, pair_stats, best_pair, top_pairs, apply_merge,
        train_exhausted, trained_vocab, base_vocab, extend_vocab, longest_tokens,
        encode_words, encode_documents, encode_documents_arrow, encode_kept_words, decode_documents, token_strings, roundtrip_mismatches,
        token_counts, token_stream, lm_windows, lm_batch, lm_batch_fixed, stored_batch, stored_windows,
        embedding_lookup, vector_project, rms_normalize, group_softmax, attention_pool, causal_pool, cross_entropy,
        clip_l2_norm, encode_stream, stream_pretoken_counts,
    )
} | {"train_bpe": train}
