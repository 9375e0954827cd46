"""Passages with edits inside, and passages around frequent phrases, against what was planted."""

import random

import numpy as np
import pytest

from tokenloom.llm import compact_windows


def _hashes(words):
    return compact_windows.shingle_hashes(" ".join(words).encode())


@pytest.mark.parametrize("size", [50, 51, 60, 77, 89, 100, 112, 120])
def test_edits_inside_a_passage(size):
    words = [f"w{i}" for i in range(size)]
    one = _hashes([f"before{i}" for i in range(30)] + words + [f"after{i}" for i in range(30)])
    kinds = [["x"], ["x", "y", "z"], []]
    edits = [(i, j) for i in range(2, size - 2) for j in ([i] if size < 90 else range(i, size - 2, 7))]
    seen = 0
    for i, j in edits:
        for new in kinds:
            changed = words[:i] + new + words[i + 1 : j] + (["v"] if j > i else []) + words[max(i, j) + 1 :]
            sets = set(_hashes(words).tolist()), set(_hashes(changed).tolist())
            if min(map(len, sets)) < compact_windows.LEAST or len(sets[0] & sets[1]) < 0.8 * len(sets[0] | sets[1]):
                continue
            seen += 1
            found = compact_windows.compared(one, _hashes([f"other{k}" for k in range(40)] + changed + [f"more{k}" for k in range(9)]))
            # A changed word near an end may be left outside, or a neighbour be taken in its place.
            assert len(found) == 1 and found[0][4] >= 0.8, (i, j, new)
            a_start, a_end, b_start, b_end, _ = found[0]
            assert a_start >= 24 and a_end <= 36 + len(sets[0]) and b_start >= 34 and b_end <= 46 + len(sets[1])
            assert a_end - a_start >= len(sets[0]) - 10
    assert seen >= size - 10


def test_blocks_in_another_order():
    blocks = [[f"{k}{i}" for i in range(40)] for k in "pq"]
    found = compact_windows.compared(_hashes(blocks[0] + blocks[1]), _hashes(blocks[1] + blocks[0]))
    assert [f[:4] for f in found] == [(0, 76, 0, 76)]


def test_passages_with_edits_of_a_table(spark):
    """Rows beyond exact passages are right as well: their texts have the similarity."""
    from test_llm_queries import LARGER, _documents, _rows, _words

    texts = {r.doc_id: _words(r.text) for r in _documents(spark, LARGER)}
    edited = 0
    for r in _rows(spark, "op3_repeated_passages", LARGER):
        words = texts[r.doc_id][r.start_word : r.end_word], texts[r.of_doc_id][r.of_start : r.of_end]
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words)
        assert min(map(len, words)) >= 50 and len(a & b) >= 0.8 * len(a | b)
        edited += a != b
    assert edited > 20


def test_frequent_phrases_inside_passages(spark):
    """Passages of 60 words in two documents each; every passage holds the same phrase."""
    chance = np.random.default_rng(11)
    for length in (10, 25, 40):
        phrase, rows = [f"phrase{i}" for i in range(length)], []
        for pair in range(150):
            own, cut = [f"p{pair}x{i}" for i in range(60 - length)], int(chance.integers(5, 56 - length))
            passage = own[:cut] + phrase + own[cut:]
            for doc in (pair, 1000 + int(chance.permutation(150)[0]) * 1000 + pair):
                around = [[f"d{doc}s{side}x{i}" for i in range(int(chance.integers(40, 90)))] for side in "ab"]
                rows.append((doc, " ".join(around[0] + passage + around[1])))
        rows = [rows[i] for i in chance.permutation(len(rows))]
        table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        found = {(r.of_doc_id, r.doc_id) for r in compact_windows.repeated_passages(table).collect()}
        met = sum((pair, other) in found for pair in range(150) for other in [d for d, _ in rows if d >= 1000 and d % 1000 == pair])
        print(length, met)
        assert met >= 0.95 * 150


def test_comparison_searches_no_sets(monkeypatch):
    """Sequences are sorted once; what two spans share is read from flags, and equals what sets give."""
    def refused(*args, **kwargs):
        raise AssertionError("a search for each span")

    monkeypatch.setattr(np, "isin", refused)
    monkeypatch.setattr(np, "intersect1d", refused)
    rng, n_found, least = random.Random(8), 0, compact_windows.LEAST
    for _ in range(300):
        space = rng.choice([30, 200, 10**6])
        shared = [rng.randrange(-space, space) for _ in range(rng.randint(0, 200))]
        a, b = ([rng.randrange(-space, space) for _ in range(rng.randint(0, 60))] + shared for _ in "ab")
        for _ in range(rng.choice([0, 2, 9]) if b else 0):
            b[rng.randrange(len(b))] = rng.randrange(-space, space)
        found = compact_windows.compared(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
        for a_start, a_end, b_start, b_end, similarity in found:
            one, other = set(a[a_start:a_end]), set(b[b_start:b_end])
            assert similarity == len(one & other) / len(one | other) >= compact_windows.SIMILARITY
            assert min(a_end - a_start, b_end - b_start) >= least
        if len(shared) >= least and a[-len(shared) :] == b[-len(shared) :]:
            assert any(a_end - a_start >= len(shared) for a_start, a_end, *_ in found)
        n_found += len(found)
    assert n_found > 100
