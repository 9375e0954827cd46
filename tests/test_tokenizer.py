import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from brute import encode, encode_word, train
from pyspark.sql import functions as F
from test_text import EOT, SPECIALS, TEXTS, frame

from tokenloom.operators import tokenizer as tk
from tokenloom.operators import vocab as vb

CORPUS = ["the cat and the hat then this that these those " * 3, "Héllò hôw are ü? 🙃 äöü über straße", "aaaa aaa aa banana"]


def make(merges, specials=SPECIALS):
    entries = vb.base_entries(specials)
    entries += [(len(entries) + i, a + b, False) for i, (a, b) in enumerate(merges)]
    return tk.Tokenizer({i: token for i, token, _ in entries}, merges, list(specials))


def ids_by(df, key="doc_id"):
    return {r[key]: r.ids for r in df.collect()}


@pytest.mark.parametrize("n_merges", [0, 20, 90])
def test_encode_matches_plain_python_and_decodes_back(spark, n_merges):
    tokenizer = make(train(CORPUS, n_merges))
    texts = TEXTS + CORPUS + ["fence \U0010ffff inside the text" + EOT, "the" + EOT * 5 + "the"]
    docs = frame(spark, texts).repartition(3)
    expected = {i: encode(t, tokenizer.ids, tokenizer.merges, SPECIALS) for i, t in enumerate(texts)}
    lists = tk.tx.tokens(F.col("text"), SPECIALS)
    assert ids_by(tk.encode_documents(docs, tokenizer)) == expected
    assert ids_by(docs.select("doc_id", tk.ids_by_expression(tokenizer, lists).alias("ids"))) == expected
    assert ids_by(docs.select("doc_id", tk.ids_by_arrow(tokenizer)(lists).alias("ids"))) == expected
    assert tuple(tk.roundtrip_mismatches(docs, tokenizer).first()) == (len(texts), 0)
    encoded = tk.encode_documents(docs, tokenizer)
    assert {r.doc_id: r.text for r in tk.decode_documents(encoded, tokenizer).collect()} == dict(enumerate(texts))


def test_hand_made_merges_take_the_exact_loop(spark):
    # The second merge rebuilds what the first one consumes.
    merges = [(b"ab", b"c"), (b"a", b"b"), (b"c", b"ab")]
    tokenizer = make(merges)
    assert not tokenizer.rank_order_is_exact()
    texts = ["abcab", "cabcab", "ababc", "xabc"]
    got = ids_by(tk.encode_documents(frame(spark, texts), tokenizer))
    assert got == {i: encode(t, tokenizer.ids, merges, SPECIALS) for i, t in enumerate(texts)}
    assert make(train(CORPUS, 60)).rank_order_is_exact()


def test_merge_word_on_long_words():
    rng = random.Random(1)
    merges = train(CORPUS, 60) + [(b"aa", b"a"), (b"a", b"a")]
    ranks = {pair: rank for rank, pair in enumerate(merges)}
    for n in (1, 2, 30, 48, 49, 200):
        for _ in range(30):
            word = bytes(rng.choice(b"athe n") for _ in range(n))
            assert tk.merge_word(word, ranks) == encode_word(word, merges)


def test_null_and_empty_texts(spark):
    docs = spark.createDataFrame([(0, None), (1, ""), (2, "a")], "doc_id long, text string")
    for n in (0, 90):
        assert ids_by(tk.encode_documents(docs, make(train(CORPUS, n)))) == {0: None, 1: [], 2: [97]}


def test_special_tokens_stay_whole(spark):
    tokenizer = make([])
    encoded = tk.encode_documents(frame(spark, [f"Hello, how {EOT}{EOT} are you?{EOT}"]), tokenizer)
    strings = [r.token_text for r in tk.token_strings(encoded, tokenizer).orderBy("pos").collect()]
    assert strings.count(EOT) == 1 and strings.count(EOT * 2) == 1
    counts = {r.token_id: r.n for r in tk.token_counts(encoded).collect()}
    assert counts[256] == counts[257] == 1


def test_decode_repairs_and_rejects(spark):
    tokenizer = make([])
    ids = spark.createDataFrame([(0, [0xC3, 0xA9]), (1, [0xC3]), (2, [0xE2, 0x82, 65]), (3, [])], "doc_id long, ids array<int>")
    decoded = {r.doc_id: r.text for r in tk.decode_documents(ids, tokenizer).collect()}
    assert decoded == {0: "é", 1: "�", 2: "�A", 3: ""}
    bad = spark.createDataFrame([(0, [999])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="unknown token id"):
        tk.decode_documents(bad, tokenizer).collect()
    sparse = tk.Tokenizer({0: b"a", 7: b"b"}, [])
    with pytest.raises(Exception, match="unknown token id"):
        tk.decode_documents(spark.createDataFrame([(0, [3])], "doc_id long, ids array<int>"), sparse).collect()


def test_equal_bytes_use_the_greatest_id(spark):
    tokenizer = tk.Tokenizer({**{i: bytes([i]) for i in range(256)}, 300: b"a"}, [])
    assert ids_by(tk.encode_documents(frame(spark, ["ab"]), tokenizer)) == {0: [300, 98]}


@pytest.mark.parametrize("expression_merges", [0, 1000])
def test_a_part_that_no_merge_makes(spark, expression_merges):
    merges = [(b"xy", b"z")] + train(CORPUS, 5)
    tokenizer = make(merges)
    assert not tokenizer.rank_order_is_exact()
    lists = tk.tx.tokens(F.col("text"), SPECIALS)
    got = frame(spark, ["xyz the"]).select(tk.ids_of_tokens(tokenizer, lists, expression_merges).alias("ids")).first().ids
    assert got == encode("xyz the", tokenizer.ids, merges, SPECIALS)


@pytest.mark.parametrize("gap", [1, 7, 40_000_000])
def test_decoding_with_and_without_gaps_between_ids(spark, gap):
    tokenizer = tk.Tokenizer({i * gap: bytes([i]) for i in range(50)}, [])
    rows = spark.createDataFrame([(7, [0, 2 * gap, 49 * gap]), (7, [3 * gap]), (8, None), (9, [])], "doc_id long, ids array<int>")
    got = sorted((tuple(r) for r in tk.decode_documents(rows, tokenizer).collect()), key=str)
    assert got == sorted([(7, "\x00\x021"), (7, "\x03"), (8, None), (9, "")], key=str)
    texts = [(r.doc_id, r.pos, r.token_text) for r in tk.token_strings(rows, tokenizer).collect()]
    assert sorted(texts) == [(7, 0, "\x00"), (7, 0, "\x03"), (7, 1, "\x02"), (7, 2, "1")]
    for bad in ([gap * 50], [None], [-1]):
        with pytest.raises(Exception, match="unknown token id"):
            tk.decode_documents(spark.createDataFrame([(1, bad)], "doc_id long, ids array<int>"), tokenizer).collect()


def test_lost_texts_count_as_mismatches(spark):
    tokenizer = make(train(CORPUS, 5))
    docs = spark.createDataFrame([(1, None), (2, "a")], "doc_id long, text string")
    assert tuple(tk.roundtrip_mismatches(docs, tokenizer).first()) == (2, 0)


def test_missing_specials_are_added(spark):
    vocab, merges = vb.base_vocab(spark, []), vb.merges_frame(spark, [])
    tokenizer = tk.Tokenizer.from_tables(vocab, merges, [EOT, "<|b|>", EOT])
    assert (tokenizer.ids[EOT.encode()], tokenizer.ids[b"<|b|>"]) == (256, 257)
    with pytest.raises(ValueError, match="more than 10"):
        tk.Tokenizer.from_tables(vocab, merges, max_tokens=10)


@pytest.mark.parametrize("at_once", [1, 3, 7, 1000])
def test_ids_are_put_in_place_in_parts_of_any_size(at_once):
    rng = random.Random(at_once)
    lists = [None if rng.random() < 0.1 else [rng.randrange(4) for _ in range(rng.choice([0, 1, 5, 30]))] for _ in range(40)]
    arrow = pa.array(lists, pa.list_(pa.int32())).slice(3)
    sizes, pool = np.array([0, 1, 2, 5]), np.array([10, 20, 21, 50, 51, 52, 53, 54], dtype=np.int32)
    ids = [[], [10], [20, 21], [50, 51, 52, 53, 54]]
    found = tk.gathered(arrow, arrow.flatten().to_numpy(), sizes, pool, at_once)
    assert found.to_pylist() == [None if codes is None else [i for c in codes for i in ids[c]] for codes in lists[3:]]
    none = pa.array([], pa.list_(pa.int32()))
    assert tk.gathered(none, none.flatten().to_numpy(), sizes, pool, at_once).to_pylist() == []


def test_memory_of_ids_put_in_place_is_bounded():
    """Beside the ids themselves, four bytes each, only what a part needs is held: also in one long row."""
    n = 4_000_000
    codes = np.zeros(n, dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(codes))
    tracemalloc.start()
    found = tk.gathered(lists, codes, np.array([1]), np.array([7], dtype=np.int32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found.values) == n and peak < 4 * n + (40 << 20)


def test_words_are_merged_side_by_side(monkeypatch):
    rng = random.Random(2)
    parts = [b"a", b"b", b"aa", b"ab", b"ba", b"aaa", b"bb", b"abab"]
    for n in range(60):
        merges = train(CORPUS, 40) if n == 0 else [(rng.choice(parts), rng.choice(parts)) for _ in range(n % 15)]
        tokens = dict.fromkeys([*(bytes([b]) for b in range(256)), *(t for l, r in merges for t in (l, r, l + r))])
        ids = {token: i for i, token in enumerate(tokens)}
        lengths = (0, 1, 2, 3, 7, 20, 48, 49, 90)
        words = [bytes(rng.choice(b"athe n" if n == 0 else b"aab") for _ in range(rng.choice(lengths))) for _ in range(100)]
        longer, table = [], tk.MergeTable(merges, ids)
        ranks = {pair: rank for rank, pair in enumerate(merges)}
        plain = tk.merge_word
        monkeypatch.setattr(tk, "_SIDE_BY_SIDE", 30)
        monkeypatch.setattr(tk, "merge_word", lambda word, ranks: longer.append(word) or plain(word, ranks))
        sizes, pool = table.word_ids(words)
        monkeypatch.undo()
        # Only words beyond the bound are merged one by one.
        assert longer == [w for w in words if len(w) > tk._SHORT_WORD]
        expected = [[ids[part] for part in plain(w, ranks)] for w in words]
        assert sizes.tolist() == [len(e) for e in expected] and pool.tolist() == [i for e in expected for i in e]
        assert expected == [[ids[part] for part in encode_word(w, list(dict.fromkeys(reversed(merges)))[::-1])] for w in words]
    with pytest.raises(KeyError):
        tk.MergeTable([(b"a", b"b")], {b"a": 1, b"b": 2}).word_ids([b"xab"])
