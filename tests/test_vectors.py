import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import arrays as ar
from tokenloom.operators import vectors as vec

RNG = np.random.default_rng(4)


def softmax(x):
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def frame(spark, matrix, groups=None):
    rows = [(i, [float(v) for v in row], int(groups[i]) if groups is not None else 0) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)


def column(df, name, key="vec_id"):
    return np.array([r[name] for r in df.orderBy(key).collect()])


def test_softmax_in_arrays_and_over_groups(spark):
    x = RNG.normal(size=(3, 5))
    for shift in (0.0, 100.0, 1000.0):
        rows = frame(spark, x + shift).withColumn("p", ar.softmax(F.col("embedding")))
        np.testing.assert_allclose(column(rows, "p"), softmax(x), atol=1e-9)
    long = frame(spark, x).select("vec_id", F.posexplode("embedding").alias("dim", "score"))
    for limit in (vec.BROADCAST_VALUES, 0):
        p = vec.group_softmax(long, "vec_id", "score", broadcast_values=limit).orderBy("vec_id", "dim").collect()
        np.testing.assert_allclose(np.array([r.p for r in p]).reshape(3, 5), softmax(x), atol=1e-9)


def test_cross_entropy(spark):
    x, targets = RNG.normal(size=(8, 5)), RNG.integers(0, 5, 8)
    for scale in (1, 1000):
        loss = -np.log(np.maximum(softmax(scale * x)[np.arange(8), targets], 0) + 0.0) if scale == 1 else None
        rows = frame(spark, scale * x, targets)
        got = vec.cross_entropy(rows, F.col("embedding"), F.col("label")).first()
        top = (scale * x).max(axis=1)
        exact = np.log(np.exp(scale * x - top[:, None]).sum(axis=1)) + top - (scale * x)[np.arange(8), targets]
        assert got.n_rows == 8 and abs(got.loss - exact.mean()) < 1e-9
        if loss is not None:
            assert abs(got.loss - loss.mean()) < 1e-9
    with pytest.raises(Exception, match="target outside"):
        vec.cross_entropy(frame(spark, x, np.full(8, 9)), F.col("embedding"), F.col("label")).collect()


def test_clip_l2_norm_skips_missing_vectors(spark):
    x = RNG.normal(size=(6, 25))
    rows = [(i, [float(v) for v in row] if i < 5 else None) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    norm = np.sqrt((x[:5] ** 2).sum())
    for max_norm in (1e-2, 1e6):
        got = vec.clip_l2_norm(df, max_norm).orderBy("vec_id").collect()
        np.testing.assert_allclose(np.array([r.clipped for r in got[:5]]), x[:5] * min(1, max_norm / (norm + 1e-6)), atol=1e-9)
        assert got[5].clipped is None


def test_rms_normalize(spark):
    x, gain = RNG.normal(size=(4, 6)), RNG.normal(size=6)
    expected = x / np.sqrt((x**2).mean(axis=1, keepdims=True) + 1e-5)
    np.testing.assert_allclose(column(vec.rms_normalize(frame(spark, x)), "normalized"), expected, atol=1e-9)
    got = vec.rms_normalize(frame(spark, x), gain=list(gain))
    np.testing.assert_allclose(column(got, "normalized"), expected * gain, atol=1e-9)


def test_project_in_one_and_in_many_blocks(spark):
    x, w = RNG.normal(size=(20, 6)), RNG.normal(size=(7, 6))
    weights = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(w)], "row_no int, weights array<double>")
    for block_values in (vec.BROADCAST_VALUES, 12):
        got = vec.vector_project(frame(spark, x), weights, 6, block_values=block_values)
        np.testing.assert_allclose(column(got, "projected"), x @ w.T, atol=1e-9)


def test_embedding_lookup_by_broadcast_and_by_shuffle(spark):
    x = RNG.normal(size=(10, 4))
    sequences = spark.createDataFrame([(0, [1, 1, 1, 9]), (1, [0]), (2, [])], "doc_id long, ids array<int>")
    for limit in (vec.BROADCAST_VALUES, 0):
        got = vec.embedding_lookup(sequences, frame(spark, x), 4, broadcast_values=limit).orderBy("doc_id", "pos").collect()
        assert [(r.doc_id, r.pos, r.token_id) for r in got] == [(0, 0, 1), (0, 1, 1), (0, 2, 1), (0, 3, 9), (1, 0, 0)]
        np.testing.assert_allclose(np.array([r.vector for r in got]), x[[1, 1, 1, 9, 0]], atol=1e-9)
    with pytest.raises(Exception, match="id without a vector"):
        bad = spark.createDataFrame([(0, [77])], "doc_id long, ids array<int>")
        vec.embedding_lookup(bad, frame(spark, x), 4).collect()


@pytest.mark.parametrize("block", [4, 2048])
def test_attention_over_many_blocks(spark, block):
    n, width = 40, 5
    # One batch holds most of the rows.
    batch = np.where(np.arange(n) < 30, 0, np.arange(n) % 3)
    q, k, v = (RNG.normal(size=(n, width)) for _ in range(3))
    rows = [(int(batch[i]), i, *([float(a) for a in m[i]] for m in (q, k, v))) for i in range(n)]
    df = spark.createDataFrame(rows, "batch int, id long, q array<double>, k array<double>, v array<double>")
    queries, keys = df.selectExpr("batch", "id AS q_id", "q"), df.selectExpr("batch", "id AS k_id", "k", "v")
    masks = {
        "all": (None, lambda a, b: True),
        "causal": (lambda a, b: b <= a, lambda a, b: b <= a),
        "few": (lambda a, b: (a % 2 == 0) & (b != a), lambda a, b: a % 2 == 0 and b != a),
    }
    for mask, allowed in masks.values():
        got = {r.q_id: np.array(r.pooled) for r in vec.attention_pool(queries, keys, width, mask, block).collect()}
        for i in range(n):
            seen = [j for j in range(n) if batch[j] == batch[i] and allowed(i, j)]
            if not seen:
                assert i not in got
                continue
            expected = softmax(q[i] @ k[seen].T / np.sqrt(width)) @ v[seen]
            np.testing.assert_allclose(got[i], expected, atol=1e-9)


def test_causal_pool_first_row_sees_itself(spark):
    x = RNG.normal(size=(5, 3))
    got = {r.q_id: r.pooled for r in vec.causal_pool(frame(spark, x), 3, "label", "vec_id").collect()}
    np.testing.assert_allclose(got[0], x[0], atol=1e-9)


@pytest.mark.parametrize("block", [3, 2048])
def test_causal_pool_over_many_blocks(spark, block, monkeypatch):
    monkeypatch.setattr(vec, "MERGED", 2)
    x, groups = RNG.normal(size=(30, 3)), np.array([0] * 25 + [1] * 5)
    got = {r.q_id: r.pooled for r in vec.causal_pool(frame(spark, x, groups), 3, "label", "vec_id", block=block).collect()}
    for i in range(30):
        seen = [j for j in range(i + 1) if groups[j] == groups[i]]
        np.testing.assert_allclose(got[i], softmax(x[i] @ x[seen].T / np.sqrt(3)) @ x[seen], atol=1e-9)


def test_causal_plan_makes_half_of_the_cells(spark):
    x = RNG.normal(size=(64, 2))
    cells = []
    original = vec._pooled
    try:
        vec._pooled = lambda met, *rest: cells.append(met) or original(met, *rest)
        vec.causal_pool(frame(spark, x), 2, "label", "vec_id", block=8).collect()
    finally:
        vec._pooled = original
    n = cells[0].applyInArrow(lambda key, a, b: vec.pa.table({"n": [1] if a.num_rows and b.num_rows else []}, vec.pa.schema([("n", vec.pa.int64())])), "n long").count()
    blocks = round((2 * n) ** 0.5)
    assert n <= blocks * (blocks + 1) / 2 and blocks >= 7


def test_attention_with_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (0, 2, None), (0, 3, [float("nan"), 1.0]), (None, 4, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "batch int, id long, x array<double>")
    queries, keys = df.selectExpr("batch", "id AS q_id", "x AS q"), df.selectExpr("batch", "id AS k_id", "x AS k", "x AS v")
    got = {r.q_id: r.pooled for r in vec.attention_pool(queries, keys, 2).collect()}
    assert got.keys() == {1, 3, 4} and np.isnan(got[3]).all() and np.isnan(got[1]).all() and got[4] == [1.0, 1.0]
    with pytest.raises(Exception, match="occurs twice"):
        vec.attention_pool(queries.unionByName(queries), keys, 2).collect()


def test_groups_of_null_and_vectors_of_another_width(spark):
    rows = spark.createDataFrame([(1, None, 1.0), (2, None, 1.0), (3, 5, 2.0)], "id int, g int, s double")
    for limit in (vec.BROADCAST_VALUES, 0):
        assert {r.id: r.p for r in vec.group_softmax(rows, "g", "s", broadcast_values=limit).collect()} == {1: 0.5, 2: 0.5, 3: 1.0}
    weights = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, 1.0])], "row_no int, weights array<double>")
    odd = spark.createDataFrame([(1, [1.0, 1.0]), (2, None)], "vec_id long, embedding array<double>")
    for block_values in (vec.BROADCAST_VALUES, 2):
        got = {r.vec_id: r.projected for r in vec.vector_project(odd, weights, 2, block_values=block_values).collect()}
        assert got == {1: [3.0, 1.0], 2: None}
        wide = spark.createDataFrame([(1, [1.0] * 3), (2, [1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="instead of 2"):
            vec.vector_project(wide, weights, 2, block_values=block_values).collect()
