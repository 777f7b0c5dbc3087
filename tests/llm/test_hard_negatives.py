"""Mined hard negatives against brute force over all pairs."""

import math
import random
from collections import Counter

import pytest

from touchline.llm.hard_negatives import CODEWORDS, Shard, learn_codebooks, mine_hard_negatives, usable_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, kind int, shard int, windows string, score double"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    kept = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept[i] = (label, [math.floor(256 * x) for x in vector])
    out = []
    for a, (label, q) in kept.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, own) for i, (own, v) in kept.items() if i != a)
        for s, p, own in [x for x in scored if x[2] == label][:positives]:
            inside = [(i, -t) for t, i, other in scored if other != label and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(a, p, k + 1, i, -s, t) for k, (i, t) in enumerate(inside)]
    return out


def vectors(n, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rng.randrange(5)
        v = [float(round(x + rng.gauss(0, 0.15), 3)) for x in centres[c]]
        rows.append((i, v, c if rng.random() < 0.8 else rng.randrange(5)))
    import numpy as np

    return [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.fixture(scope="module")
def awkward():
    rows = vectors(600)
    rows += [(700 + k, rows[3][1], k % 5) for k in range(60)]  # copies of one vector under all labels
    rows += [(800, None, 1), (850, [0.5, None], 1), (900, [math.nan] * 8, 1), (950, [math.inf] + [0.0] * 7, 1), (1000, rows[0][1], None)]
    rows += [(None, rows[0][1], 2), (1050, [], 2), (1100, [0.25, 0.5], 3), (1101, [0.25], 3), (1150, [0.0] * 8, 4), (-50, rows[9][1], 9)]
    return rows + [rows[50], rows[51], rows[0]]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "x", 2, 3, "w", 0.5) for i, v, c in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("shards", [1, 5])
def test_equal_to_all_pairs(spark, awkward, shards):
    rows = usable_vectors(frame(spark, awkward)).cache()
    got = mine_hard_negatives(rows, rows.filter("id % 50 = 0"), shards=shards)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(awkward)
    assert len(want) > 100
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_coarse_books_change_nothing(spark, awkward):
    rows = usable_vectors(frame(spark, awkward))
    got = mine_hard_negatives(rows, rows.filter("id % 50 = 0"), positives=2, negatives=4, low=20, high=99, codewords=2, sample=7, shards=3)
    assert Counter(map(tuple, got.collect())) == Counter(brute(awkward, 2, 4, 20, 99))


def test_large_components_stay_exact(spark):
    rows = [(50 * i, [float(1 << 40), float(i), float(i * i)], i % 2) for i in range(12)]
    usable = usable_vectors(frame(spark, rows))
    with pytest.raises(Exception):  # 2^96 does not fit a long
        mine_hard_negatives(usable, usable, shards=1).collect()
    rows = [(50 * i, [float(1 << 20), float(i), float(i * i)], i % 2) for i in range(12)]
    usable = usable_vectors(frame(spark, rows))
    assert Counter(map(tuple, mine_hard_negatives(usable, usable, shards=2).collect())) == Counter(brute(rows))


def test_heap_visits_every_cell_by_falling_bound(spark):
    import numpy as np

    rows = vectors(300)
    usable = usable_vectors(frame(spark, rows))
    books = learn_codebooks(usable, CODEWORDS)
    matrix = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64)
    shard = Shard(np.arange(300), np.array([c for _, _, c in rows]), matrix, books)
    for anchor in matrix[:5]:
        seen = list(shard.cells(anchor))
        assert [b for b, _, _ in seen] == sorted((b for b, _, _ in seen), reverse=True)
        assert sorted(k for _, a, b in seen for k in range(a, b)) == list(range(300))
        for bound, a, b in seen:
            assert shard.scores(np.arange(a, b), anchor).max() <= bound + 1e-6


def test_nothing_to_mine(spark):
    rows = usable_vectors(frame(spark, []))
    assert mine_hard_negatives(rows, rows).count() == 0
    rows = usable_vectors(frame(spark, [(50, [1.0], 1), (51, [1.0], 1), (100, [0.0], 2)]))
    assert mine_hard_negatives(rows, rows).count() == 0
