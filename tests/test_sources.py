import random

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import printable
from tokenloom.operators import documents as dc
from tokenloom.operators import vocab as vb
from tokenloom.session import shared_folder
from tokenloom.sources import artifacts as art
from tokenloom.sources import corpus as src
from tokenloom.sources import ranges

EOT = "<|endoftext|>"
MERGES = [(b" ", b"t"), (b"h", b"e"), (b"\x00", b"\n"), (b"\xc3", b"\xa9")]


def tables(spark):
    entries = vb.base_entries([EOT])
    entries += [(len(entries) + i, a + b, False) for i, (a, b) in enumerate(MERGES)]
    return vb.vocab_frame(spark, entries), vb.merges_frame(spark, MERGES)


def rows(frame):
    return sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in frame.collect())


def test_tables_survive_saving(spark):
    vocab, merges = tables(spark)
    folder = shared_folder(spark, "test")
    art.save_tokenizer(vocab, merges, folder)
    again = art.load_tokenizer(spark, folder)
    assert rows(again[0]) == rows(vocab) and rows(again[1]) == rows(merges)
    spark.range(3).write.parquet(f"{folder}/bad/vocab")
    with pytest.raises(ValueError):
        art.load_tokenizer(spark, f"{folder}/bad")


def test_artifacts_that_are_not_whole_are_refused(spark):
    vocab, merges = tables(spark)
    others = vb.merges_frame(spark, MERGES[::-1])
    folder = shared_folder(spark, "test")
    art.save_tokenizer(vocab, merges, folder)
    files = lambda: art.load_tokenizer(spark, folder)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        art.save_tokenizer(vocab, others, folder)
    assert rows(files()[1]) == rows(merges)
    # One table replaced by one of as many rows, in other files, or short of a row.
    others.write.mode("overwrite").parquet(f"{folder}/merges")
    with pytest.raises(ValueError, match="merges"):
        files()
    merges.repartition(3).write.mode("overwrite").parquet(f"{folder}/merges")
    assert rows(files()[1]) == rows(merges)
    vocab.where("token_id <> 7").write.mode("overwrite").parquet(f"{folder}/vocab")
    with pytest.raises(ValueError, match="vocab"):
        files()
    # Saving again over it makes it whole; a save that stops between its tables leaves nothing to load.
    art.save_tokenizer(vocab, others, folder, "overwrite")
    assert rows(files()[1]) == rows(others)
    failing = merges.withColumn("rank", F.expr("raise_error('stopped')").cast("int"))
    with pytest.raises(Exception, match="stopped"):
        art.save_tokenizer(vocab, failing, folder, "overwrite")
    with pytest.raises(Exception):
        files()
    merges.write.mode("overwrite").parquet(f"{folder}/merges")
    with pytest.raises(ValueError, match="manifest"):
        files()
    with pytest.raises(ValueError):
        art.save_tokenizer(vocab, merges, folder, "append")


def test_an_artifact_without_merges(spark):
    vocab, merges = tables(spark)
    folder = shared_folder(spark, "test")
    art.save_tokenizer(vocab, merges.limit(0), folder)
    assert rows(art.load_tokenizer(spark, folder)[0]) == rows(vocab)


def test_printable_alphabet_covers_all_bytes(spark):
    data = spark.createDataFrame([(bytearray(range(256)),)], "b binary")
    shown = data.select(printable.to_printable(F.col("b")).alias("s"), "b")
    row = shown.select("s", printable.from_printable(F.col("s")).alias("back")).first()
    assert bytes(row.back) == bytes(range(256)) and len(set(row.s)) == 256
    assert row.s[32] == "Ġ" and row.s[10] == "Ċ" and row.s[65] == "A" and not any(c.isspace() for c in row.s)
    assert len(printable.HIDDEN_BYTES) == 68


def test_text_format_round_trip(spark, tmp_path):
    vocab, merges = tables(spark)
    folder = shared_folder(spark, "test")
    art.export_text_format(vocab, merges, folder)
    again = art.import_text_format(spark, f"{folder}/vocab", f"{folder}/merges", [EOT])
    assert rows(again[0]) == rows(vocab) and rows(again[1]) == rows(merges)
    # Headers, blank lines and lines with more than one blank are skipped.
    (tmp_path / "merges.txt").write_text("#version: 0.2 x\nĠ t\n\nh e  \na b c\nĀ Ċ\nÃ ©", encoding="utf-8")
    (tmp_path / "vocab.json").write_text('{"a": 5, "Ġt": 2}', encoding="utf-8")
    small, found = art.import_text_format(spark, str(tmp_path / "vocab.json"), str(tmp_path / "merges.txt"), [EOT])
    assert rows(found) == rows(merges)
    assert {r.token_id: bytes(r.token) for r in small.collect()} == {5: b"a", 2: b" t", 6: EOT.encode()}


def test_export_of_equal_bytes(spark):
    vocab = vb.vocab_frame(spark, [*vb.base_entries([]), (256, b"ab", False), (257, b"ab", False)])
    folder = shared_folder(spark, "test")
    art.export_text_format(vocab, vb.merges_frame(spark, [(b"a", b"b")]), folder)
    again = art.import_text_format(spark, f"{folder}/vocab", f"{folder}/merges")[0]
    assert [r.token_id for r in again.where("token_hex = '6162'").collect()] == [257]


def test_readers(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(f"one\r\n{EOT}two é{EOT}".encode())
    assert sorted(r.text for r in src.read_delimited(spark, str(tmp_path / "a.txt")).collect()) == ["one\r\n", "two é"]
    (tmp_path / "c.txt").write_bytes(b"x\xff\xe2\x82" + EOT.encode() + b"\xc3y")
    rows = src.read_delimited(spark, str(tmp_path / "c.txt")).collect()
    assert sorted(r.text for r in rows) == ["x", "y"] and len({r.doc_id for r in rows}) == 2
    assert sorted(r.text for r in src.read_delimited(spark, str(tmp_path / "c.txt"), errors="replace").collect()) == ["x\ufffd\ufffd", "\ufffdy"]
    (tmp_path / "b.txt").write_bytes(b"ok \xff\xc3\r\n end")
    bad = str(tmp_path / "b.txt")
    assert src.read_whole_files(spark, bad).first().text == "ok \r\n end"
    assert src.read_whole_files(spark, bad, "replace").first().text == b"ok \xff\xc3\r\n end".decode(errors="replace")
    docs = spark.createDataFrame([(1, "é")], "doc_id long, text string")
    assert tuple(src.corpus_scan(docs).first()) == (1, "é", 2)


def cut_from_the_front(data, delimiter):
    found, at = [], 0
    while at < len(data):
        end = data.find(delimiter, at)
        found.append((at, data[at : end if end >= 0 else len(data)]))
        at = end + len(delimiter) if end >= 0 else len(data)
    return found


def test_ranges_equal_cutting_from_the_front():
    """Every cut into ranges, blocks shorter than a delimiter, delimiters that overlap themselves."""
    chance = random.Random(5)
    for delimiter in (b"ab", b"aa", b"aba", b"abaab", b"b", b"aaaa"):
        for _ in range(60):
            data = bytes(chance.choice(b"ab" if chance.random() < 0.9 else b"cd") for _ in range(chance.randrange(40)))
            read_at = lambda at, n: data[at : at + n]
            cuts = sorted({0, len(data), *(chance.randrange(len(data) + 1) for _ in range(chance.randrange(8)))})
            for ends in (cuts, [0, len(data)], list(range(len(data) + 1))):
                parts = [d for low, high in zip(ends, ends[1:]) for d in ranges.documents(read_at, low, high, delimiter, chance.randrange(1, 9))]
                assert parts == cut_from_the_front(data, delimiter), (data, delimiter, ends)


def test_a_range_inside_a_document_reads_little():
    data = b"x" * 100_000 + b"<>" + b"y"
    read = []
    assert not list(ranges.documents(lambda at, n: read.append(n) or data[at : at + n], 40_000, 50_000, b"<>", 1000))
    assert sum(read) <= 10_000 + 2 * 1000 + 10  # the range, a block on each side, and what the anchor needs


def test_ranges_of_files(spark, tmp_path):
    chance = random.Random(7)
    texts = ["".join(chance.choices("aé<|\n 漢", k=chance.choice([0, 3, 50, 4000]))) for _ in range(400)]
    for name, part in (("a.txt", texts[:150]), ("b.txt", []), ("sub/c.txt", texts[150:])):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes("".join(t + EOT for t in part).encode())
    for name in ("_SUCCESS", ".a.txt.crc"):
        (tmp_path / "in" / name).write_bytes(b"no data")
    folder = str(tmp_path / "in")
    size = sum(len((t + EOT).encode()) for t in texts)
    expected, at = [], 0
    for t in texts:
        expected.append((at, t))
        at += len((t + EOT).encode())
    for n in (1, 7, 64):
        found = src.read_delimited(spark, folder, range_bytes=-(-size // n))
        assert found.rdd.getNumPartitions() >= n
        assert sorted(map(tuple, found.collect())) == expected
    # The cuts of chunks are ends of documents.
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cuts = {r.boundary for r in dc.chunk_boundaries(docs, 16).collect()} - {0, size}
    assert len(cuts) > 5 and {c + len(EOT) for c in cuts} <= {d for d, _ in expected} | {size}
    # The text source of Spark gives the same documents.
    assert sorted(r.text for r in src.read_delimited_text(spark, folder + "/*.txt").collect()) == sorted(texts[:150])
    # Whatever form the path has; nothing for empty files; an error for what has no ranges.
    assert src.read_delimited(spark, f"file:{folder}/a.txt").count() == 150
    assert src.read_delimited(spark, folder + "/b.txt").count() == 0
    (tmp_path / "in" / "d.txt.gz").write_bytes(b"")
    for path in (folder, folder + "/none"):
        with pytest.raises(Exception):
            src.read_delimited(spark, path).count()


def test_small_ranges_share_tasks(spark, tmp_path):
    """Ranges of 100 bytes in files of all sizes: each read on its own, but not each in a task of its own."""
    chance = random.Random(11)
    sizes, expected, at = [0, 5, 60, 1, 300, 40], [], 0
    (tmp_path / "in").mkdir()
    for i, n in enumerate(sizes):
        texts = ["x" * chance.choice([0, 3, 90, 800]) + str(chance.random()) for _ in range(n)]
        (tmp_path / "in" / f"{i}.txt").write_text(EOT.join(texts))
        for j, t in enumerate(texts):
            expected.append((at, t))
            at += len(t) + (len(EOT) if j + 1 < n else 0)
    found = src.read_delimited(spark, str(tmp_path / "in"), range_bytes=100)
    assert sorted(map(tuple, found.collect())) == expected
    assert at // 100 > 1000 and 32 <= found.rdd.getNumPartitions() <= 100
