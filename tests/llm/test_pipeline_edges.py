"""The near-duplicate stage with repeated ids, and the pipeline on nulls, repeated rows, further columns and empty tables."""

import pytest

import corpus_pipeline
from tokenloom.llm import simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, root string"


def _text(word):
    return " ".join(f"{word}{i}" for i in range(80))


def test_different_texts_under_one_id_stay(spark):
    rows = [(1, _text("a")), (1, _text("b")), (2, _text("c")), (5, _text("A")), (6, _text("B")), (7, _text("d")), (7, _text("d")),
            (8, None), (9, ""), (None, _text("a")), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "r") for i, t in rows], SCHEMA)
    kept = simhash.near_duplicates_removed(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    expected = [(1, _text("a")), (1, _text("b")), (2, _text("c")), (7, _text("d")), (8, None), (None, _text("a")), (None, None)]
    assert found == sorted(expected, key=str)
    assert simhash.near_duplicates_removed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_rows(spark, tmp_path, empty):
    rows = [(i, f"{_text(chr(97 + i % 20))} {_text(str(i))}", "en", f"s{i % 3}", 0, None) for i in range(40)]
    rows += [rows[0], (3, _text("other"), None, None, None, "x"), (41, None, None, None, None, None), (42, "", "en", "s1", 0, "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    for name, table in (("documents", docs), ("labels", labels)):
        (table.limit(0) if empty else table).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids"]
    rows = found.collect()
    assert not empty or not rows
    assert all(r.n_tokens == len(r.ids or []) and (r.doc_id is None or 0 <= r.doc_id <= 42) for r in rows)
