"""Source divergence, collocations and packing against plain versions, and their edge cases."""

import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F
from test_edges import LONG, ROWS

from tokenloom.llm import divergence, packing, phrases, queries

SF_DIR = "/root/testdata/sf0.001"
#: Further columns whose names the operators use themselves.
CLASHING = "doc_id bigint, text string, lang string, source string, n bigint, term string, g string, span string, starts string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, CLASHING)


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.limit(0)


# Source divergence


def plain_cells(rows):
    cells = Counter()
    for row in rows:
        cells.update((i, j) for i in row for j in row if i <= j)
    return cells


@settings(max_examples=60, deadline=None)
@given(some.lists(some.sets(some.integers(0, 60), max_size=9), max_size=80))
def test_products_count_rows_with_both_columns(rows):
    flat = [c for row in rows for c in sorted(row)]
    starts = np.cumsum([0, *map(len, rows)])
    found = divergence.joint_cells(np.array(flat, np.int64), starts)
    assert {(i, j): n for i, j, n in zip(*(f.tolist() for f in found))} == plain_cells(rows)


def test_products_in_tiles(monkeypatch):
    rng = np.random.default_rng(5)
    rows = [set(rng.choice(90, 12, replace=False).tolist()) for _ in range(50)]
    expected = plain_cells(rows)
    monkeypatch.setattr(divergence, "COLUMNS", 7)
    flat = [c for row in rows for c in sorted(row)]
    found = divergence.joint_cells(np.array(flat, np.int64), np.cumsum([0, *map(len, rows)]))
    assert {(i, j): n for i, j, n in zip(*(f.tolist() for f in found))} == expected


def plain_audit(rows):
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = (text or "").encode().lower().decode()
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in documents[lang].items() if n >= 10)
        sources = sorted(s for own, s in groups if own == lang)

        def prices(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        own = {s: prices(counts[lang, s]) for s in sources}
        whole = prices(sum((counts[lang, s] for s in sources), Counter()))
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            values = [(o, sum(gap(own[s][t], own[o][t]) for t in kept)) for o in sources if o != s]
            for rank, (item, value) in enumerate(sorted(values, key=lambda v: (-v[1], v[0].encode())), 1):
                out.add((lang, s, "pair", item, value, rank))
            values = [(t, gap(own[s][t], whole[t])) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for rank, (item, value) in enumerate(sorted(values, key=lambda v: (-v[1], v[0].encode()))[:10], 1):
                out.add((lang, s, "term", item, value, rank))
    return out


def test_divergence_equals_plain_version(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows += [(None, "Ünder_the-Über x", "en", "none"), (1, None, "xx", "a"), (1, "", "xx", "b"), (1, "one", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    assert set(map(tuple, divergence.audit(docs).collect())) == plain_audit(rows)


def test_divergence_of_large_counts(spark):
    """Prices of counts whose product with the scale passes 64 bits."""
    rows = spark.createDataFrame([(10**12, 3 * 10**13, 10**6)], "count bigint, total bigint, kept bigint")
    found = rows.select(divergence.price("count", "total", "kept").alias("p")).first()["p"]
    assert found == 1 + 10**9 * (10**12 + 2) // (3 * 10**13 + 2 * 10**6)


def test_divergence_edges(docs, no_docs):
    assert set(map(tuple, divergence.audit(docs).collect())) == plain_audit([r[:4] for r in ROWS])
    assert divergence.audit(no_docs).count() == 0
    many = docs.where("doc_id = 3").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(6))))
    rows = [r[:4] for r in ROWS if r[0] == 3 for _ in range(6)]
    assert set(map(tuple, divergence.audit(many).collect())) == plain_audit(rows)


# Collocations


def plain_collocations(rows, least=10, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lowered = (text or "").encode().lower().decode()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        kept, around = [], defaultdict(list)
        for q, n in candidates.items():
            for inner in {q[:2], q[1:]} if len(q) == 3 else ():
                around[inner].append(n)
        for p, a in candidates.items():
            score, k = min(((10**6 * a * a) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(100 * n >= 50 * a for n in around[p]):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize("budget", [phrases.BUDGET, 300, 40])
def test_collocations_equal_plain_version(spark, budget):
    """Small budgets extend frequent words to two and three words and make many groups."""
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows += [("a b c a b c " * 30, None), ("A b\tc, a\x0bb c! " * 30, None), ("x " * 50 + "\x00 \x1f \x00 \x1f " * 20, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert set(map(tuple, phrases.collocations(docs, budget=budget).collect())) == plain_collocations(rows)


def test_suffixes_of_long_texts_and_full_tasks(spark, monkeypatch):
    """Texts cut into parts, and tasks that pass their counts on, count the same."""
    import tokenloom.llm.common as common

    monkeypatch.setattr(common.segments, "__defaults__", (b" ", 64))
    monkeypatch.setattr(phrases, "HELD_SUFFIXES", 50)
    monkeypatch.setattr(phrases, "HELD_WORDS", 20)
    texts = ["the cat sat. the cat ran, the dog sat " * 20, "a" * 300 + " b c " * 30, "w x y z " * 25 + "."]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").coalesce(1)
    assert set(map(tuple, phrases.collocations(docs, least=3).collect())) == plain_collocations([(t, "en") for t in texts], 3)


def test_collocation_edges(docs, no_docs):
    assert set(map(tuple, phrases.collocations(docs, least=2).collect())) == plain_collocations([(r[1], r[2]) for r in ROWS], 2)
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(docs, least=2, top=3).groupBy("lang").count().where("count > 3").count() == 0


# Packing


@settings(max_examples=150, deadline=None)
@given(some.lists(some.integers(0, 400), min_size=1, max_size=9), some.integers(1, 60))
def test_round_robin_keeps_deficits_below_one(quotas, room):
    total = sum(quotas)
    rooms = packing.parts_of(total, room)
    sent = packing.dealt(quotas, rooms)
    assert sent.sum(axis=1).tolist() == rooms and sent.sum(axis=0).tolist() == (quotas if total else [0] * len(quotas))
    done = 0
    for size, sums in zip(rooms, np.cumsum(sent, axis=0).tolist()):
        done += size
        assert all(abs(n - Fraction(q * done, total)) < 1 for n, q in zip(sums, quotas))
    assert (sent >= 0).all()


def test_round_robin_of_huge_streams():
    quotas = [7 * 10**14 + 11, 10**13, 1, 0]
    rooms = packing.parts_of(sum(quotas), 10**14)
    sent = packing.dealt(quotas, rooms)
    assert sent.sum(axis=0).tolist() == quotas and sent.sum(axis=1).tolist() == rooms


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.word_tokenizer_file())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def checked_pieces(pieces, rows, window=packing.WINDOW):
    """Each id lies in one piece, sequences are full or powers of two and gapless. Returns tokens by sequence and source."""
    ids = dict(zip((r[0] for r in rows), plain_ids([r[1] for r in rows])))
    source = {r[0]: r[2] for r in rows}
    by_doc, by_sequence, mix = defaultdict(list), defaultdict(list), defaultdict(Counter)
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.length > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == zlib.crc32(bytes(p.ids))
        by_doc[p.doc_id].append((p.start, p.length))
        by_sequence[p.sequence_id].append((p.offset, p.length))
        mix[p.sequence_id][source[p.doc_id]] += p.length
    for doc, parts in by_doc.items():
        assert [a for a, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
        assert sum(n for _, n in parts) == len(ids[doc])
    assert by_doc.keys() == ids.keys()
    for parts in by_sequence.values():
        size = sum(n for _, n in parts)
        assert [a for a, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
        assert size == window or size < window and size & (size - 1) == 0
    return mix, {s: sum(len(ids[d]) for d in ids if source[d] == s) for s in set(source.values())}


def test_packing_equals_plain_version(spark, monkeypatch):
    """Several ranges and spans; each window, and all windows up to it, hold each source's share to the token."""
    monkeypatch.setattr(packing, "SPAN_WINDOWS", 4)
    monkeypatch.setattr(packing, "RANGE_SPANS", 3)
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows += [(-1, None, None), (-2, "", "tiny"), (-3, "<|endoftext|> it's Ünder　the  ́x Ω", "tiny"), (-4, LONG, "src1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    pieces = packing.packed(docs, queries.word_tokenizer_file()).collect()
    mix, totals = checked_pieces(pieces, rows)
    total, done, seen = sum(totals.values()), 0, Counter()
    for no in sorted(mix):
        done += sum(mix[no].values())
        seen.update(mix[no])
        # One token of deficit at each level: range, span, window.
        assert all(abs(seen[s] - Fraction(n * done, total)) < 3 for s, n in totals.items())
    assert sorted(mix) == list(range(len(mix)))


def test_packing_to_given_proportions(spark):
    rows = [(i, "some words of a document " * 40, "abc"[i % 3]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    pieces = packing.packed(docs, queries.word_tokenizer_file(), {"a": 6, "b": 3, "c": 1}, window=256).collect()
    mix, totals = checked_pieces(pieces, rows, 256)
    first = [mix[i] for i in range(20)]
    assert all(abs(m["a"] - 153.6) <= 2 and abs(m["b"] - 76.8) <= 2 and abs(m["c"] - 25.6) <= 2 for m in first)


def test_packing_edges(spark, docs, no_docs):
    assert packing.packed(no_docs, queries.word_tokenizer_file()).count() == 0
    found = packing.packed(docs, queries.word_tokenizer_file()).collect()
    lengths = [len(i) for i in plain_ids([r[1] for r in ROWS])]
    assert sum(p.length for p in found) == sum(lengths)
    own = Counter()
    for p in found:
        own[p.doc_id] += p.length
    expected = Counter()
    for row, n in zip(ROWS, lengths):
        expected[row[0]] += n
    assert own == expected


def test_further_sources_share_a_queue(spark, monkeypatch):
    monkeypatch.setattr(packing, "QUEUES", 3)
    rows = [(i, "some words of a document " * (1 + i % 50), f"s{i % 11}" if i % 4 else None) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    checked_pieces(packing.packed(docs, queries.word_tokenizer_file()).collect(), rows)


def test_long_texts_are_encoded_in_parts(spark):
    rows = [(1, LONG * 20, "a"), (2, "short", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert len(rows[0][1]) > 1 << 22
    checked_pieces(packing.packed(docs, queries.word_tokenizer_file()).collect(), rows)


def test_subtrees_of_a_group_in_many_batches():
    """Batches with other strings, or the same ones in another order, give the counts of the whole group."""
    from tokenloom.llm import phrases as module

    names = ["group_no", "lang", "pair", "third", "n"]
    rows = [(0, "en", f"a {i % 3}", "bc"[i % 2], 1) for i in range(24)] + [(1, "de", "x y", "", 5)]

    def batches(size):
        kinds = [module.pa.int32(), module.pa.string(), module.pa.string(), module.pa.string(), module.pa.int64()]
        for low in range(0, len(rows), size):
            columns = zip(*rows[low : low + size])
            yield module.pa.RecordBatch.from_arrays([module.pa.array(c, k) for c, k in zip(columns, kinds)], names)

    expected = {("en", f"a {i}", 8) for i in range(3)} | {("en", f"a {i} {t}", 4) for i in range(3) for t in "bc"} | {("de", "x y", 5)}
    for size in (1, 5, 100):
        found = [tuple(r.values()) for b in module._subtrees(2)(batches(size)) for r in b.to_pylist()]
        assert len(found) == len(expected) and set(found) == expected
