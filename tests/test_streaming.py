import glob
import os

import pytest
from brute import train
from pyspark.sql import functions as F
from test_text import SPECIALS, TEXTS, frame
from test_tokenizer import CORPUS, make

from tokenloom.operators import tokenizer as tk
from tokenloom.operators import words as wd
from tokenloom.session import shared_folder
from tokenloom.streaming import text as st


def arrived(spark, folder, low, high):
    docs = frame(spark, TEXTS * 3).where(F.col("doc_id").between(low, high - 1))
    docs.repartition(2).write.mode("append").parquet(f"{folder}/in")


def test_streams_equal_batch_over_several_runs(spark):
    folder = shared_folder(spark, "test")
    tokenizer = make(train(CORPUS, 50))
    n = 3 * len(TEXTS)
    for low, high in ((0, 10), (10, n)):
        arrived(spark, folder, low, high)
        items = st.read_stream(spark, f"{folder}/in", "doc_id long, text string", maxFilesPerTrigger=1)
        st.write_encoded_stream(items, tokenizer, f"{folder}/ids", f"{folder}/check-ids").awaitTermination()
        st.write_count_stream(items, f"{folder}/counts", f"{folder}/check-counts", SPECIALS, compact_every=2).awaitTermination()
    docs = frame(spark, TEXTS * 3)
    ids = {r.doc_id: r.ids for r in spark.read.parquet(f"{folder}/ids").collect()}
    assert ids == {r.doc_id: r.ids for r in tk.encode_documents(docs, tokenizer).collect()} and len(ids) == n
    counts = sorted(map(tuple, st.read_counts(spark, f"{folder}/counts").collect()))
    assert counts == sorted(map(tuple, wd.pretoken_counts(docs, SPECIALS).collect()))


class Stopped(Exception):
    """Stands for the end of the driver."""


def counted(spark, folder, compact_every=2):
    items = st.read_stream(spark, f"{folder}/in", "doc_id long, text string", maxFilesPerTrigger=1)
    st.write_count_stream(items, f"{folder}/counts", f"{folder}/check", SPECIALS, compact_every=compact_every).awaitTermination()


def totals(spark, folder):
    return {(r.token, r.is_special): r.n for r in st.read_counts(spark, f"{folder}/counts").collect()}


def expected_totals(spark, folder):
    return {(r.token, r.is_special): r.n for r in wd.pretoken_counts(spark.read.parquet(f"{folder}/in"), SPECIALS).collect()}


def without_last_commit(folder):
    """As after a crash of the driver between the end of a batch and its commit."""
    last = max(glob.glob(f"{folder}/check/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    for crc in glob.glob(f"{folder}/check/commits/.*crc"):
        os.remove(crc)


def local_folder(spark):
    return shared_folder(spark, "test").removeprefix("file://")


@pytest.mark.parametrize("batches", [1, 2, 3, 4])
def test_a_repeated_batch_changes_nothing(spark, batches):
    """At a compacting batch, before it and after it."""
    folder = local_folder(spark)
    for low in range(batches):
        spark.createDataFrame([(low, f"alpha beta{low} gamma" * (low + 1))], "doc_id long, text string").write.mode("append").parquet(f"{folder}/in")
        counted(spark, folder)
    before = totals(spark, folder)
    assert before == expected_totals(spark, folder)
    for _ in range(2):
        without_last_commit(folder)
        counted(spark, folder)
        assert totals(spark, folder) == before


STEPS = ["_write 1", "_write 2", "write_text 1", "_clean 1", "delete 1", "delete 2", "delete 3"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_batch_that_stops_at_any_step_is_repeated_whole(spark, monkeypatch, step, after):
    """Totals are those of the batch before or of this one while it is down, and right once it has run again."""
    folder = local_folder(spark)
    changes = [spark.createDataFrame([("alpha", False, n + 1), (f" beta{n}", False, 1)], "token string, is_special boolean, n long") for n in range(5)]
    log = st.CountLog(spark, f"{folder}/counts")
    name, at = step.split()
    owner = st.CountLog if name.startswith("_") else st
    original, calls = getattr(owner, name), []

    def stopping(*arguments):
        calls.append(1)
        here = len(calls) == int(at)
        if here and not after:
            raise Stopped
        result = original(*arguments)
        if here:
            raise Stopped
        return result

    expected = lambda n: {("alpha", False): n + 1, **{(f" beta{i}", False): 1 for i in range(n + 1)}}
    for n in range(len(changes)):
        with monkeypatch.context() as patch:
            calls.clear()
            patch.setattr(owner, name, stopping)
            try:
                log.add(changes[n], n, 2)
            except Stopped:
                assert totals(spark, folder) in ([expected(n - 1)] if n else [{}]) + [expected(n)]
        log.add(changes[n], n, 2)
        assert totals(spark, folder) == expected(n)
    assert len(os.listdir(f"{folder}/counts/data")) <= 5
