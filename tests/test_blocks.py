import pytest
from test_windows import sample

from tokenloom.operators import windows as win
from tokenloom.session import delete, shared_folder
from tokenloom.sources import blocks as blk


def store_of(spark, rows, block, partitions=3):
    folder = shared_folder(spark, "test")
    table = spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(partitions)
    return blk.write_blocks(table, folder, block), folder


def as_rows(table):
    return sorted(map(tuple, table.collect()))


@pytest.mark.parametrize("block", [1, 7, 64, 100_000])
def test_windows_and_batches_of_blocks_equal_those_of_the_stream(spark, block):
    rows, total = sample(5, 60, 9)
    rows += [(2 * 10**12, None), (3 * 10**12, [])]
    store, _ = store_of(spark, rows, block)
    assert store.n_ids == total
    held = [(r.block_no, r.run) for r in store.table.orderBy("block_no").collect()]
    assert held == [(n, list(range(total))[n * block : (n + 1) * block]) for n in range(-(-total // block))]
    encoded = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    for m in (1, 5, 20):
        assert as_rows(store.windows(m)) == as_rows(win.lm_windows(encoded, m))
        expected = as_rows(win.lm_batch(encoded, 40, m, seed=3))
        assert as_rows(store.batch(40, m, seed=3)) == as_rows(store.batch(40, m, seed=3, named_blocks=2)) == expected


def test_starts_without_a_window_give_no_row(spark):
    store, _ = store_of(spark, [(1, list(range(10)))], 4)
    starts = spark.createDataFrame([(0, -1), (1, 0), (2, 6), (3, 7), (4, None), (5, 6)], "sample_id long, start long")
    assert as_rows(store.windows_at(starts, 3)) == [
        (1, 0, [0, 1, 2], [1, 2, 3]), (2, 6, [6, 7, 8], [7, 8, 9]), (5, 6, [6, 7, 8], [7, 8, 9])]
    with pytest.raises(ValueError, match="no window"):
        store.batch(3, 10, seed=1)


def test_an_empty_stream(spark):
    store, _ = store_of(spark, [(1, []), (2, None)], 4)
    assert store.n_ids == 0 and store.windows(2).count() == 0


def test_a_store_that_is_not_whole_is_refused(spark):
    rows = [(1, list(range(100)))]
    _, folder = store_of(spark, rows, 4)
    spark.createDataFrame([(25, [1])], "block_no long, run array<int>").write.mode("append").parquet(f"{folder}/blocks")
    with pytest.raises(ValueError, match="do not hold"):
        blk.BlockStore(spark, folder)
    _, folder = store_of(spark, rows, 4)
    delete(spark, f"{folder}/manifest.json")
    with pytest.raises(ValueError, match="not whole"):
        blk.BlockStore(spark, folder)
    with pytest.raises(Exception, match="occurs twice"):
        store_of(spark, rows * 2, 4)


def rows_read(table):
    """Rows that left the scans of a collected table."""
    def scans(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            yield node.metrics().apply("numOutputRows").value()
        children = node.children()
        for i in range(children.size()):
            yield from scans(children.apply(i))

    table.collect()
    return sum(scans(table._jdf.queryExecution().executedPlan()))


def test_a_batch_reads_rows_in_proportion(spark):
    """Forty blocks of a hundred thousand, far apart: the pages that hold them, not the span from first to last."""
    encoded = spark.range(200).selectExpr("id AS doc_id", "transform(sequence(1, 8000), x -> cast(x AS int)) AS ids")
    folder = shared_folder(spark, "test")
    store = blk.write_blocks(encoded, folder, 16)
    wanted = list(range(0, 100_000, 2_500))
    few = store.blocks(wanted)
    assert sorted(r.block_no for r in few.collect()) == wanted
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(block_no" in plan
    assert rows_read(store.table) == 100_000
    assert rows_read(few) <= 1_000
