"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for each operator."""

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import compact_windows, hosts, lineblocks, mixing, quality, queries, rabitq, secret_scan, simhash, unigram, vafile

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, fingerprint string, spans string, score string"
ROWS = [
    (1, None, None, None, None, "a", "b", "c", "d"),
    (2, "", "en", "s1", 0, None, None, None, None),
    (3, LONG, "en", "s1", len(LONG), None, None, None, None),
    (3, LONG, "en", "s1", len(LONG), None, None, None, None),
    (4, "one two", "en", "s2", 7, None, None, None, None),
    (5, "One\ttwo ", "en", "s2", 8, None, None, None, None),
    (None, "a text without an id", "en", "s2", 20, None, None, None, None),
    (6, "\u00e9\U0001f643 \u2581 \x00 end", "fr", "s3", 9, None, None, None, None),
]
LABELS = [(1, 0, 0), (3, 1, 0), (4, 1, 1), (5, None, None), (None, 1, 0), (2, 0, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def model():
    return unigram.Unigram.load(queries.tokenizer_file())


def test_pieces(docs, no_docs, model):
    rows = queries.encoded_digest(docs, model).collect()
    assert len(rows) == len(ROWS) and all(r.round_trip for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[1] == 0 == {r.doc_id: r.n_tokens for r in rows}[2]
    assert queries.encoded_digest(no_docs, model).count() == 0


def test_fingerprints(docs, no_docs):
    found = simhash.simhash_components(docs).collect()
    assert len(found) == len(ROWS)
    by = {r.doc_id: r for r in found}
    assert by[1].fingerprint == by[2].fingerprint == "0" * 16 and by[2].component_id == 1
    assert by[4].component_id == by[5].component_id == 4 and by[None].component_id is None
    assert simhash.simhash_components(no_docs).count() == 0
    kept = simhash.near_duplicates_removed(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 6]


def test_passages(spark, docs, no_docs):
    assert compact_windows.repeated_passages(docs).count() == 0  # rows of one id are no repeat
    twice = docs.unionByName(docs.where("doc_id = 3").limit(1).withColumn("doc_id", F.lit(99).cast("bigint")))
    assert {r.doc_id for r in compact_windows.repeated_passages(twice).collect()} == {99}
    assert compact_windows.repeated_passages(no_docs).count() == 0


def test_mix(docs, no_docs):
    rows = mixing.mixture(docs).collect()
    assert len(rows) == len(ROWS) and mixing.mixture(no_docs).count() == 0
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(no_docs).count() == 0
    assert mixing.mixed(docs).count() == sum(r.taken // r["size"] for r in rows if r["size"])


def test_secrets(spark, docs, no_docs):
    secret = spark.createDataFrame([(7, "é token: abcdefgh12345 end", *[None] * 7)], DOCS)
    both = docs.unionByName(secret)
    masked = secret_scan.secrets_masked(both)
    assert masked.columns == docs.columns and masked.count() == len(ROWS) + 1
    row = masked.where("doc_id = 7").first()
    assert row.text == "é <secret> end" and masked.where("doc_id = 1").first().text is None
    assert secret_scan.scanned(no_docs).count() == 0


def test_quality(docs, no_docs, labels):
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[1] == by[2]
    assert quality.quality_scores(no_docs, labels).count() == 0
    assert quality.quality_scores(docs, labels.limit(0)).where("abs(score - 0.5) < 1e-9").count() == len(ROWS)
    assert quality.accepted(docs, labels).columns == docs.columns


VECTORS = "vec_id bigint, embedding array<float>, label int, n_links string, width string"
POINTS = [
    (1, [1.0, 0.0, 0.0], 1, "x", "y"), (2, [2.0, 0.0, 0.0], 1, None, None), (3, [1.0, 0.01, 0.0], 1, None, None),
    (3, [1.0, 0.01, 0.0], 1, None, None), (4, [0.0, 0.0, 0.0], 1, None, None), (5, None, 1, None, None),
    (6, [1.0, None, 0.0], 1, None, None), (7, [float("nan"), 0.0, 0.0], 1, None, None), (8, [float("inf"), 0.0, 0.0], 1, None, None),
    (9, [1.0, 0.0, 0.0], None, None, None), (10, [1.0, 0.0, 0.0], 2, None, None), (11, [1.0, 0.0], 1, None, None), (12, [], 1, None, None),
    (50, [1.0, 0.5, 0.0], 2, None, None), (100, [3e30, 0.0, 0.0], 2, None, None),
]


def test_near_vectors(spark):
    rows = spark.createDataFrame(POINTS, VECTORS)
    found = rabitq.near_duplicate_vectors(rows).collect()
    assert len(found) == len(POINTS)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[3] == (3, 1, False)
    assert all(by[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 11, 12, 50))
    assert by[10][0] == 1  # a huge vector of the same direction
    assert rabitq.near_duplicate_vectors(rows.limit(0)).count() == 0


def test_top_k(spark):
    rows = spark.createDataFrame(POINTS, VECTORS).where("vec_id < 100")
    found = vafile.top_k(rows, rows.where("vec_id % 50 = 0"), 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(2, 131072), (3, 65792), (3, 65792), (1, 65536), (9, 65536)]
    assert vafile.top_k(rows.limit(0), rows.limit(0), 5).count() == 0


def test_pages(spark):
    rows = spark.createDataFrame([(1, None, "u", "t"), (2, "", None, None), (3, "<p>a &amp; b<p>c", None, None)],
                                 "page_id bigint, html string, url string, text string")
    found = {r.page_id: r.text for r in lineblocks.extracted(rows).collect()}
    assert found == {1: "", 2: "", 3: "a & b\nc"}
    assert lineblocks.extracted(rows.limit(0)).count() == 0


def test_hosts(spark):
    pages = spark.createDataFrame([(1, None, "h"), (1, None, "h"), (2, "no scheme", None), (3, "http://WWW.Example.com/en/x?y", None),
                                   (4, "s://a.net/es/1#z", None), (5, "s://com", None)], "page_id bigint, url string, host string")
    outcomes = spark.createDataFrame([(None, 1), ("b.org", None)], "host string, bad int")
    found = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in hosts.judged(pages, outcomes, queries.RULES).collect()]
    assert sorted(found, key=str) == sorted([
        (1, "", "", None, "allow"), (1, "", "", None, "allow"), (2, "", "", None, "allow"),
        (3, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (4, "a.net", "/es/1", "net/es/", "block"),
        (5, "com", "", None, "allow")], key=str)
    assert hosts.judged(pages.limit(0), outcomes.limit(0), queries.RULES).count() == 0


def test_what_lies_beside_a_base_span_is_judged(spark):
    texts = ["see 0123456789abcdef0123456789abcdef-Zx8Kq2Lm9Vt4Rw7Yp3Nb6Hc1 end",
             "see Zx8Kq2Lm9Vt4Rw7Yp3Nb6Hc1_0123456789abcdef0123456789abcdef_Qw7Pz3Xc9Vb2Nm5Lk8Jh4Gf6 end",
             "see 0123456789abcdef0123456789abcdef-Zx8Kq2Lm9 end"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    from test_llm_queries import LARGER

    corpus = spark.read.parquet(f"{LARGER}/documents.parquet").selectExpr("doc_id + 100 AS doc_id", "text")
    both = docs.unionByName(corpus)
    found = secret_scan.scanned(both).where("doc_id < 100").withColumn("s", secret_scan.as_text(F.col(secret_scan.ALL)))
    spans = {r.doc_id: r.s for r in found.select("doc_id", "s").collect()}
    assert spans == {0: "hex:4:36,markov:36:61", 1: "markov:4:29,hex:29:61,markov:61:86", 2: "hex:4:36"}
    masked = {r.doc_id: r.text for r in secret_scan.secrets_masked(both).where("doc_id < 100").collect()}
    assert "Zx8Kq2Lm9Vt4" not in masked[0] + masked[1]
