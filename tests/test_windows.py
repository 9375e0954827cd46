import random
from collections import Counter

import pytest
from brute import boundaries

from tokenloom.operators import documents as dc
from tokenloom.operators import windows as win
from tokenloom.operators.positions import starts

EOT = "<|endoftext|>"


def sample(seed, n, most):
    rng = random.Random(seed)
    keys = sorted(rng.sample(range(10**12), n))
    rows, at = [], 0
    for key in keys:
        size = rng.randrange(0, most)
        rows.append((key, list(range(at, at + size))))
        at += size
    return rows, at


@pytest.fixture(scope="module")
def encoded(spark):
    rows, total = sample(2, 60, 9)
    shuffled = rows[:]
    random.Random(0).shuffle(shuffled)
    return spark.createDataFrame(shuffled, "doc_id long, ids array<int>").repartition(5), total


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_starts(spark, buckets):
    # Half of the keys lie close together, the others far apart.
    rows = [(i if i < 100 else i * 10**9, i % 7) for i in range(200)]
    frame = spark.createDataFrame(rows, "k long, v long").repartition(4)
    placed, total = starts(frame, "k", "v", "before", buckets)
    at, expected = 0, {}
    for key, value in rows:
        expected[key] = at
        at += value
    assert total == at and {r.k: r.before for r in placed.collect()} == expected


def test_starts_need_unique_keys(spark):
    twice = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "k long, v long")
    with pytest.raises(Exception, match="k occurs twice: 1"):
        starts(twice, "k", "v", "before")[0].collect()
    with pytest.raises(ValueError, match="1 rows without a k"):
        starts(spark.createDataFrame([(None, 2)], "k long, v long"), "k", "v", "before")


def test_token_stream(encoded):
    frame, total = encoded
    rows = win.token_stream(frame).orderBy("gpos").collect()
    assert [r.gpos for r in rows] == [r.token_id for r in rows] == list(range(total))


@pytest.mark.parametrize("m,block", [(1, 1), (7, 3), (7, 16), (5, 8192)])
def test_all_windows(encoded, m, block):
    frame, total = encoded
    rows = win.lm_windows(frame, m, block).orderBy("start").collect()
    assert [r.start for r in rows] == list(range(total - m))
    for r in rows:
        assert r.x == list(range(r.start, r.start + m)) and r.y == [v + 1 for v in r.x]


def test_windows_longer_than_the_stream(encoded):
    frame, total = encoded
    assert win.lm_windows(frame, total).count() == 0
    assert win.lm_windows(frame, total - 1).count() == 1
    with pytest.raises(ValueError):
        win.lm_batch(frame, 4, total, seed=1)


def test_random_batch_is_uniform_and_repeatable(spark):
    stream = spark.createDataFrame([(0, list(range(100)))], "doc_id long, ids array<int>")
    n = 32_000
    rows = win.lm_batch(stream, n, 7, seed=3, block=10).select("sample_id", "start", "x", "y").collect()
    assert len(rows) == n and all(r.x == list(range(r.start, r.start + 7)) and r.y == [v + 1 for v in r.x] for r in rows)
    seen = Counter(r.start for r in rows)
    assert min(seen) == 0 and max(seen) == 92
    mean, sigma = n / 93, (n / 93 * (1 - 1 / 93)) ** 0.5
    assert all(abs(count - mean) < 5 * sigma for count in seen.values())
    again = {r.sample_id: r.start for r in win.lm_batch(stream.repartition(3), 50, 7, seed=3).collect()}
    assert all(again[r.sample_id] == r.start for r in rows if r.sample_id < 50)


def test_batches_too_large_to_broadcast(encoded, spark):
    frame, total = encoded
    starts = spark.createDataFrame([(i, i * 3 % (total - 4)) for i in range(40)], "sample_id long, start long")
    small = sorted(map(tuple, win.windows_at(frame, starts, 4, 8).select("sample_id", "start").collect()))
    assert sorted(map(tuple, win.windows_at(frame, starts, 4, 8, broadcast_starts=1).select("sample_id", "start").collect())) == small
    assert len(small) == 40


@pytest.mark.parametrize("n", [1, 2, 5, 40, 5000])
def test_chunk_boundaries(spark, n):
    rng = random.Random(n)
    texts = ["".join(rng.choice("aé🙃 ") for _ in range(rng.randrange(0, 40))) for _ in range(30)]
    texts[3] = f"a{EOT}b{EOT}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(r.boundary for r in dc.chunk_boundaries(docs, n).collect()) == boundaries(texts, n, EOT)
