"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest

from rows import clashing, collected
from shopledger.llm.hard_negatives import Mining, MultiIndex, first_negatives, hard_negatives, windows_of

SMALL_SHARDS = Mining(shard_rows=40, centroids=4, sample=32, visit=8)


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def _plain(rows):
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        usable[i] = min(usable.get(i, (label, whole)), (label, whole))
    usable = {i: ((label + 1) % 10 if i % 7 == 0 else label, v) for i, (label, v) in usable.items()}
    out = []
    for a, (label, v) in usable.items():
        if a % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, own) for i, (own, w) in usable.items() if i != a and len(w) == len(v)
        )
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            p = -p
            fit = [(-s, i) for s, i, own in scored if own != label and 30 * p <= 100 * -s <= 90 * p]
            out += [(a, positive, n, i, p, s) for n, (s, i) in enumerate(fit[:10], 1)]
    return sorted(out)


def _found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dimension", [1, 5, 16])
def test_negatives_equal_all_pairs(spark, dimension):
    rnd = np.random.default_rng(dimension)
    middles = rnd.standard_normal((6, dimension))
    rows = [
        (i, (middles[i % 6] + 0.4 * rnd.standard_normal(dimension)).tolist(), int(rnd.integers(3))) for i in range(500)
    ]
    same = rows[0][1]
    rows += [(1000 + i, same, i % 3) for i in range(300)]
    bad = [None, [float("nan")] * dimension, [None] * dimension, [float("inf")] * dimension]
    rows += [(2000 + 100 * i, v, 1) for i, v in enumerate(bad)]
    rows += [(None, same, 1), (3000, same, None), (100, same, 2), (100, same, 2), (200, rows[200][1], 9)]
    rows += [(4000 + i, [0.5] * (dimension + 1), i % 2) for i in range(30)]
    rows += [(5000 + i, [], i % 2) for i in range(30)]
    table = _table(spark, rows)
    expected = _plain(rows)
    assert expected
    assert _found(hard_negatives(table, SMALL_SHARDS)) == expected
    assert _found(hard_negatives(table)) == expected
    assert _found(hard_negatives(clashing(table), SMALL_SHARDS)) == expected


def test_few_and_no_rows(spark):
    assert _found(hard_negatives(_table(spark, []))) == []
    assert _found(hard_negatives(_table(spark, [(0, [1.0], 1)]))) == []
    rows = [(0, [1.0], 3), (1, [1.0], 4), (2, [0.5], 4), (300, [1e30], 1), (301, [1e30], 2)]
    # the label of 0 becomes 4; 300 and 301 are alone with their labels
    assert _found(hard_negatives(_table(spark, rows[:3]))) == []
    assert collected(hard_negatives(_table(spark, rows))) == []
    rows = [(0, [1.0], 3), (1, [1.0], 4), (2, [0.5], 5), (3, [0.5], 6)]
    found = _found(hard_negatives(_table(spark, rows)))
    assert found == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 3, 65536, 32768)]


def test_cells_come_by_falling_bound_and_hold_what_they_say():
    rnd = np.random.default_rng(3)
    vectors = np.floor(256 * rnd.standard_normal((700, 12))).astype(np.int64)
    index = MultiIndex(np.arange(700), np.zeros(700, np.int64), vectors, SMALL_SHARDS)
    anchor = vectors[17]
    seen, before = [], np.inf
    for most, least, start, end in index.cells(anchor):
        assert most <= before
        before = most
        scores = index.scores(anchor, start, end)
        assert scores.max() <= most and scores.min() >= least
        seen += range(start, end)
    assert sorted(seen) == list(range(700))
    assert sorted(index.ids.tolist()) == list(range(700))


def test_a_search_stops_before_it_has_seen_all_cells():
    rnd = np.random.default_rng(5)
    middles = 8 * rnd.standard_normal((16, 8))
    vectors = np.floor(64 * (middles[rnd.integers(16, size=4000)] + 0.1 * rnd.standard_normal((4000, 8)))).astype(np.int64)
    labels = rnd.integers(4, size=4000)
    options = Mining(visit=64)
    index = MultiIndex(np.arange(4000), labels, vectors, options)
    scored = []
    inner = index.scores
    index.scores = lambda a, s, e: scored.append(e - s) or inner(a, s, e)
    anchor = vectors[0]
    best = int(np.sort(vectors[labels == labels[0]] @ anchor)[-2])
    found = first_negatives(index, labels[0], anchor, windows_of([best], options), options)
    assert len(found[0][0]) == 10 and sum(scored) < 2000


def test_windows_are_those_of_the_inequality():
    rnd = random.Random(1)
    for p in [0, 1, -1, 7, -10, *(rnd.randrange(-5000, 5000) for _ in range(50))]:
        low, high = windows_of([p], Mining())[0]
        inside = [n for n in range(-5000, 5000) if 30 * p <= 100 * n <= 90 * p]
        assert inside == list(range(low, high + 1))
