"""Recall of the bands against all pairs, and estimates against exact cosines."""

import numpy as np

from tokenloom.llm import rabitq


def _pairs_near(threshold, n, width, chance):
    """Unit vectors and partners with a cosine just above the threshold."""
    a = chance.standard_normal((n, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = chance.standard_normal((n, width))
    away -= (away * a).sum(axis=1, keepdims=True) * a
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = threshold + 1e-4
    return a, cosine * a + np.sqrt(1 - cosine**2) * away


def test_pairs_at_the_threshold_meet_in_a_band():
    a, b = _pairs_near(rabitq.THRESHOLD, 4000, 64, np.random.default_rng(5))
    turns = rabitq.rotations(64, {})
    meet = (rabitq._bands(a, turns) == rabitq._bands(b, turns)).any(axis=1)
    assert meet.mean() > 0.99


def test_estimates_are_unbiased_and_bounded():
    a, b = _pairs_near(0.9, 2000, 64, np.random.default_rng(6))
    turn = rabitq.rotation(64, 0)
    rotated = np.concatenate([a @ turn, b @ turn])
    estimate, bound = rabitq._estimates(rotated, slice(0, 2000), slice(2000, 4000))
    error = np.diag(estimate) - (a * b).sum(axis=1)
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= bound).mean() > 0.999


def test_links_equal_all_pairs(spark):
    chance = np.random.default_rng(7)
    centers = chance.standard_normal((40, 64))
    rows = np.concatenate([centers[i % 40][None] + 0.03 * chance.standard_normal((1, 64)) * (i // 40) for i in range(400)]).astype(np.float32)
    labels = [i % 2 for i in range(400)]
    table = spark.createDataFrame([(i, [float(x) for x in v], l) for i, (v, l) in enumerate(zip(rows, labels))],
                                  "vec_id bigint, embedding array<float>, label int")
    unit = rows.astype(np.float64) / np.linalg.norm(rows.astype(np.float64), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)) & ~np.eye(400, dtype=bool)
    found = {r.vec_id: r.n_links for r in rabitq.near_duplicate_vectors(table).collect()}
    total = sum(found.values())
    assert near.sum() > 500 and 0.99 * near.sum() <= total <= near.sum()
    assert all(found[i] <= near[i].sum() for i in range(400))


def test_narrow_vectors_meet_as_wide_ones_do():
    for width in (1, 2, 8, 16, 24, 32, 48, 64, 128):
        chance = np.random.default_rng(width)
        a, b = _pairs_near(rabitq.THRESHOLD, 4000, width, chance) if width > 1 else 2 * (np.ones((4, 1)),)
        turns = rabitq.rotations(width, {})
        codes = rabitq._bands(a, turns), rabitq._bands(b, turns)
        assert codes[0].shape[1] >= rabitq.BANDS and (codes[0] == codes[1]).any(axis=1).mean() > 0.99, width
    assert len(rabitq.rotations(64, {})) == rabitq.ROTATIONS
