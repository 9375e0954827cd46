import hashlib
import random
import time

import pyarrow as pa
import pytest
from brute import split_specials, tokens
from pyspark.sql import functions as F

from tokenloom.functions import runs
from tokenloom.functions import text as tx
from tokenloom.operators import documents as dc
from tokenloom.operators import words as wd
from tokenloom.session import with_arrow_batches

EOT = tx.END_OF_TEXT
SPECIALS = [EOT, EOT * 2]
TEXTS = [
    "", "s", "🙃", "Hello, how are you?", "Héllò hôw are ü? 🙃", EOT + "\n\n", EOT + "\n\ntesting!",
    f"Héllò hôw {EOT}{EOT} are ü? 🙃{EOT}", f"Hello, how {EOT}{EOT} are you?{EOT}", f"{EOT * 3} a{EOT}",
    "I'll we've don't they're it's I'd I'm 'tis '", "a  b\n\n c \t\n", "x \u3000y\u2028 \u2003 z\u0085\u00a0", "12 345abc!? ...",
    "\u0001a\u0001", "�", "line\r\nnext sep", "<|endoftext", "日本語のテキスト 123", "   ", "\n",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def by_doc(rows, position, value):
    out = {}
    for row in sorted(rows, key=lambda r: (r.doc_id, r[position])):
        out.setdefault(row.doc_id, []).append(row[value])
    return out


def test_pretokens_and_specials_match_plain_python(spark):
    docs = frame(spark, TEXTS)
    for specials in ([], [EOT], SPECIALS):
        found = by_doc(wd.pretokenize(docs, specials).collect(), "tok_pos", "token")
        assert [found.get(i, []) for i in range(len(TEXTS))] == [tokens(t, specials) for t in TEXTS]
        pieces = by_doc(dc.special_split(docs, specials).collect(), "piece_pos", "piece")
        assert [pieces.get(i, []) for i in range(len(TEXTS))] == [split_specials(t, specials) for t in TEXTS]


def test_long_text_is_split_whole(spark):
    long = ("word " * 40_000 + EOT) * 3
    found = wd.pretokenize(frame(spark, [long]), [EOT]).groupBy("is_special").count().collect()
    assert {r.is_special: r["count"] for r in found} == {True: 3, False: 3 * 40_001}


def test_utf8_repair_matches_python(spark):
    rng = random.Random(5)
    good = ["é", "\ufffd", "\ue000", "\ue001", "\ue002", "a", "🙃", "\u0000"]
    blobs = [bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x99, 0x83, 0xEE, 0x80, 0x81, 0xEF, 0xBF, 0xBD, 0xFF,
                               0xED, 0xA0]) for _ in range(rng.randrange(0, 12))) for _ in range(2000)]
    blobs += [b"".join(rng.choice([rng.choice(good).encode(), bytes([rng.randrange(128, 256)])]) for _ in range(8)) for _ in range(1000)]
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(blobs)], "i long, b binary")
    got = rows.select("i", tx.utf8_ignore(F.col("b")).alias("x"), tx.utf8_replace(F.col("b")).alias("y")).collect()
    for row in got:
        assert row.x == blobs[row.i].decode("utf-8", errors="ignore")
        assert row.y == blobs[row.i].decode("utf-8", errors="replace")


def test_counts_do_not_depend_on_partitions(spark):
    docs = frame(spark, TEXTS * 5)
    one, many = (sorted(map(tuple, wd.pretoken_counts(docs.repartition(n), SPECIALS).collect())) for n in (1, 7))
    assert one == many
    stats = wd.corpus_stats(wd.pretoken_counts(docs, SPECIALS)).first()
    flat = [t for text in TEXTS for t in tokens(text, SPECIALS)]
    assert (stats.total_words, stats.unique_words) == (5 * len(flat), len(set(flat)))


def test_byte_sequences(spark):
    words = spark.createDataFrame([("hé",)], "token string")
    assert wd.byte_sequences(words).first().bytes_hex == " 68  C3  A9 "


def test_document_split_keeps_empty_parts(spark):
    rows = dc.document_split(frame(spark, [f"a{EOT}{EOT}b", "c", ""])).collect()
    assert by_doc(rows, "part_pos", "text") == {0: ["a", "", "b"], 1: ["c"], 2: [""]}


def test_every_character_is_split_as_by_the_regex_module(spark):
    """All planes: alone, doubled, and beside letters, digits, blanks and marks."""
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"x{chr(c)}7{chr(c)} {chr(c)}y {chr(c)}{chr(c)}!{chr(c)}\n" for c in codes[i : i + 4096]) for i in range(0, len(codes), 4096)]
    found = by_doc(wd.pretokenize(frame(spark, texts).repartition(8), []).collect(), "tok_pos", "token")
    assert [found[i] for i in range(len(texts))] == [tokens(t) for t in texts]


def test_young_letters_do_not_slow_a_text_down(spark):
    """A few letters younger than Java's tables: the time of a text without any, but for a small factor."""
    young = tx._younger(r"\p{L}") + tx._younger(r"\p{N}")
    if not young:
        pytest.skip("Java's tables are as new as those of the regex module")
    found = spark.range(1).select(F.size(F.regexp_extract_all(F.lit(young + "aé1 ￿"), F.lit(tx._nested("".join(sorted(young)))), F.lit(0)))).first()
    assert found[0] == len(young)
    sign = "".join(map(chr, range(0x2190, 0x2400)))
    texts = [(sign + " ") * 150 + "a", (sign + " ") * 150 + young[-1]]
    assert tokens(texts[1][-1000:], []) == [r for r in spark.createDataFrame([(texts[1][-1000:],)], "t string").select(tx.pretokens(F.col("t"))).first()[0]]
    took = []
    for text in texts:
        rows = spark.createDataFrame([(text,)] * 16, "t string").repartition(4).cache()
        rows.count()
        each = []
        for _ in range(4):
            start = time.perf_counter()
            rows.select(F.size(tx.pretokens(F.col("t"))).alias("n")).agg(F.sum("n")).collect()
            each.append(time.perf_counter() - start)
        took.append(min(each))
    assert took[1] < 4 * took[0] + 0.2


@pytest.mark.parametrize("at_once", [1, 7, 50, 1 << 19])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_pretokens_cut_by_arrays_equal_plain_python(monkeypatch, at_once, kind):
    monkeypatch.setattr(runs, "_AT_ONCE", at_once)
    rng = random.Random(3)
    parts = [*" '\n\tab sdmtlverSLé1٣!?\u3000\u00a0🙃\U00020000\U000323b0\x1c\x85\u200b\x00", "'ll", "'ve", "'re", "'s", " '"]
    cut = runs.pretoken_lists(*tx._class_bounds()).func
    for longest in (2, 4, 12):
        texts = [*TEXTS, *("".join(rng.choices(parts, k=rng.randrange(longest))) if rng.random() < 0.9 else None for _ in range(3000))]
        expected = [None if t is None else tokens(t) for t in texts]
        assert cut(pa.array(texts, kind)).to_pylist() == expected
        assert cut(pa.array(texts, kind).slice(5, 100)).to_pylist() == expected[5:105]
        joined = runs.pretoken_lists(*tx._class_bounds(), runs.sizes_and_digests("\n")).func(pa.array(texts, kind)).to_pylist()
        assert [(j["size"], j["digest"]) for j in joined] == [
            (None, None) if e is None else (len(e), hashlib.md5("\n".join(e).encode()).hexdigest()) for e in expected]
    for few in ([], [None], [""], ["", None]):
        assert cut(pa.array(few, kind)).to_pylist() == [None if t is None else [] for t in few]


def test_pretokens_of_malformed_bytes_equal_those_of_the_jvm(spark):
    rng = random.Random(1)
    some = bytes.fromhex("41202773C3C2C0A9E0E282ACF09F99838F90F4F5F7F8EE80BFEFFFEDA09F")
    blobs = [bytes(rng.choices(some, k=rng.randrange(10))) for _ in range(5000)] + [None, b"", "é 'll".encode()]
    rows = spark.createDataFrame([(b and bytearray(b),) for b in blobs], "b binary").select(F.col("b").cast("string").alias("t"))
    assert rows.select(tx.pretokens(F.col("t")).alias("x"), tx.matched(F.col("t")).alias("y")).where("NOT x <=> y").count() == 0


def test_sizes_and_digests_equal_built_in_functions(spark):
    lists = [[], ["a"], ["", ""], ["é", "\n", "b c"], ["🙃"] * 1000, ["x"] * 300_000, None]
    rows = spark.createDataFrame([(x,) for x in lists], "words array<string>").coalesce(1)
    found = rows.select(F.arrow_udf(*runs.sizes_and_digests("\n"))(F.col("words")).alias("f"), F.size("words").alias("n"), F.md5(F.array_join("words", "\n")).alias("d"))
    assert found.where("NOT (f.size <=> n AND f.digest <=> d)").count() == 0


def test_smaller_batches_leave_the_session_as_it_is(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = dict(spark.conf.getAll)
    own = with_arrow_batches(spark, 1 << 20)
    assert dict(spark.conf.getAll) == before and dict(own.conf.getAll) == before | {key: str(1 << 20)}
    most = F.arrow_udf(lambda texts: pa.array([texts.nbytes] * len(texts), pa.int64()), "long")
    sizes = own.range(0, 400, 1, 1).select(F.concat(F.col("id").cast("string"), F.lit("x" * 50_000)).alias("t")).select(most("t").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] < 2 << 20


def test_texts_of_all_characters_take_less_time_than_the_plain_pattern(spark):
    """Characters of all planes, young letters among them; Java's own matching, without these letters, is the measure."""
    codes = [c for c in range(1, 0x110000, 512) if not 0xD800 <= c <= 0xE000]
    text = "".join(f"x{chr(c)}7{chr(c)} {chr(c)}y {chr(c)}{chr(c)}" for c in codes)
    rows = spark.range(512).select(F.concat(F.col("id").cast("string"), F.lit(text)).alias("t")).repartition(4).cache()
    assert rows.count() == 512
    took = []
    for lists in (tx.pretokens(F.col("t")), F.regexp_extract_all("t", F.lit("(?U)" + tx.PRETOKEN_PATTERN), F.lit(0))):
        each = []
        for _ in range(3):
            start = time.perf_counter()
            rows.select(F.size(lists).alias("n")).agg(F.sum("n")).collect()
            each.append(time.perf_counter() - start)
        took.append(min(each))
    rows.unpersist()
    assert took[0] < took[1]
