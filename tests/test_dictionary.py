import random

import pyarrow as pa
import pytest
from brute import encode, train
from test_text import EOT, SPECIALS, TEXTS, frame
from test_tokenizer import CORPUS, ids_by, make

from tokenloom.operators import dictionary as dct
from tokenloom.operators import tokenizer as tk
from tokenloom.operators import words as wd
from tokenloom.session import listed, shared_folder


def random_merges(seed, n):
    """Pairs of bytes and of what earlier or later pairs make, in any order."""
    rng = random.Random(seed)
    tokens = [bytes([c]) for c in b"athe nsi"]
    merges = []
    for _ in range(n):
        pair = (rng.choice(tokens), rng.choice(tokens))
        tokens.append(pair[0] + pair[1])
        if pair not in merges:
            merges.append(pair)
    rng.shuffle(merges)
    return merges


MERGES = {
    "trained": train(CORPUS, 60),
    "hand-made": [(b"ab", b"c"), (b"a", b"b"), (b"c", b"ab"), (b"t", b"h")],
    "random": random_merges(4, 40),
    "none": [],
}


@pytest.mark.parametrize("hot_words", [0, 3, dct.HOT_WORDS])
@pytest.mark.parametrize("merges", MERGES.values(), ids=MERGES.keys())
def test_ids_equal_plain_python_and_words_are_merged_once(spark, merges, hot_words):
    tokenizer, folder = make(merges), shared_folder(spark, "test")
    words = dct.WordDictionary(spark, folder, tokenizer)
    texts = TEXTS + CORPUS + ["abcab cabcab ababc", "the" + EOT * 3 + "the", "a" * 3000]
    docs = frame(spark, texts).repartition(3)
    expected = {i: encode(t, tokenizer.ids, tokenizer.merges, SPECIALS) for i, t in enumerate(texts)}
    assert ids_by(words.encode(docs, hot_words=hot_words)) == expected
    counts = wd.pretoken_counts(docs, SPECIALS)
    assert words.table().count() == counts.count() == words.table().select("token").distinct().count()
    # Another run, of another object: nothing is left to merge.
    again = dct.WordDictionary(spark, folder, make(merges))
    assert again.extend(counts) == 0 and len(again._parts()) == 1
    assert ids_by(again.encode(docs, hot_words=hot_words)) == expected


def test_only_new_words_are_merged_and_parts_are_put_together(spark, monkeypatch):
    monkeypatch.setattr(dct, "COMPACT_PARTS", 2)
    words = dct.WordDictionary(spark, shared_folder(spark, "test"), make(MERGES["trained"]))
    for step, (new, total) in enumerate([(2, 2), (2, 4), (1, 5), (0, 5), (1, 6)]):
        tokens = [["the", "cat"], ["cat", "then", "that", "that"], ["the", "x", None], ["x", "the"], ["y"]][step]
        assert words.extend(spark.createDataFrame([(t,) for t in tokens], "token string")) == new
        assert words.table().count() == total
    assert len(words._parts()) == 2


def test_rows_repeat_and_columns_clash(spark):
    tokenizer = make(MERGES["trained"])
    rows = [(1, None, 9, "r", [1]), (1, "the cat", 8, "r", None), (1, "the cat", 8, "r", None), (2, "", 7, None, [2]), (None, "zzz", 6, "s", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, cold string, other array<int>")
    words = dct.WordDictionary(spark, shared_folder(spark, "test"), tokenizer)
    got = words.encode(docs, hot_words=1)
    assert got.columns == ["doc_id", "row", "cold", "other", "ids"]
    expected = tk.encode_documents(docs, tokenizer).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert words.encode(docs.limit(0)).count() == 0


def test_versions_keep_tokenizers_and_unfinished_parts_apart(spark):
    folder = shared_folder(spark, "test")
    one, two = (dct.WordDictionary(spark, folder, make(MERGES[name])) for name in ("trained", "none"))
    tokens = spark.createDataFrame([("then",)], "token string")
    assert one.extend(tokens) == two.extend(tokens) == 1
    assert one.table().first().ids != two.table().first().ids
    one._write(spark.createDataFrame([("torn", [1])], dct._SCHEMA))
    assert one.table().count() == 1 and len(listed(spark, f"{one.folder}/parts")) == 2


def test_holes_of_many_rows_are_filled_side_by_side(monkeypatch):
    rng = random.Random(5)
    rows = []
    for _ in range(200):
        own = {place: [rng.randrange(-3, 99) for _ in range(rng.randint(1, 4))] for place in range(rng.randint(0, 5))}
        ids = [dct.HOLE if own and rng.random() < 0.4 else rng.randrange(99) for _ in range(rng.randint(0, 30))]
        places = [rng.choice([*own]) for i in ids if i == dct.HOLE]
        rows.append((ids, places, rng.sample([{"place": p, "ids": i} for p, i in own.items()], len(own))))
    expected = []
    for ids, places, words in rows:
        lists, at = {w["place"]: w["ids"] for w in words}, iter(places)
        expected.append([i for x in ids for i in (lists[next(at)] if x == dct.HOLE else [x])])
    types = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.struct([("place", pa.int32()), ("ids", pa.list_(pa.int32()))]))]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    for at_once in (1, 50, 1 << 18):
        monkeypatch.setattr(dct, "AT_ONCE", at_once)
        assert dct._filled(*columns).to_pylist() == expected
        assert dct._filled(*(c.slice(7, 90) for c in columns)).to_pylist() == expected[7:97]
        assert dct._filled(*(c.slice(0, 0) for c in columns)).to_pylist() == []
    hole = [pa.array(c, t) for c, t in zip(([[1, dct.HOLE, dct.HOLE]], [[0, 1]], [[{"place": 1, "ids": [5]}]]), types)]
    with pytest.raises(ValueError, match="without its ids"):
        dct._filled(*hole)


def test_a_row_names_each_of_its_cold_words_once(spark):
    docs = frame(spark, ["zz yy zz zz the", "the the", "", "yy"])
    lists = tk.tx.tokens(tk.F.col("text"), SPECIALS)
    found = docs.coalesce(1).select("doc_id", dct._known_ids([" the", "the"], [[1, 2], [3]])(lists).alias("found")).select("doc_id", "found.*")
    rows = {r.doc_id: r for r in found.collect()}
    hole = dct.HOLE
    assert [list(rows[i].ids) for i in range(4)] == [[hole, hole, hole, hole, 1, 2], [3, 1, 2], [], [hole]]
    assert [[rows[i].cold[p] for p in rows[i].places] for i in range(4)] == [["zz", " yy", " zz", " zz"], [], [], ["yy"]]
    assert [len(set(rows[i].cold)) for i in range(4)] == [len(rows[i].cold) for i in range(4)] == [3, 0, 0, 1]
