"""Centroid clustering against brute force, on awkward vectors."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm.centroids import Geometry, cluster_report, shallot_clusters, shallot_scan
from tests.compare import assert_same, connect

SCHEMA = "vec_id long, embedding array<float>, id long, x int, cluster string, distance double"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, 1, 2, "c", 0.5) for r in rows], SCHEMA).repartition(partitions)


def awkward_vectors(size=4):
    draw = np.random.default_rng(7)
    rows = [(i, draw.normal(0, 0.3, size).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, [0.25 * (i % 3), 0.5, -0.25, 0.0]) for i in range(60)]  # many equal ones, and ties
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, [0.1] * size), (400, None), (401, []), (402, [0.1] * (size + 1))]
    rows += [(403, [0.1, None, 0.1, 0.1]), (404, [float("nan")] * size), (405, [float("inf"), 0.0, 0.0, 0.0]), (406, [-7.3, 7.3, 900.5, -0.001])]
    return rows


def brute(rows, k, rounds, size=4):
    kept = [(key, [math.floor(256 * float(np.float32(c))) for c in v]) for key, v in rows if v and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    seeds = sorted((hashlib.sha256(f"2:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None)[:k]
    places = [v for _, v in seeds]
    squares = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda: [min((squares(v, c), i) for i, c in enumerate(places)) for _, v in kept]
    for _ in range(rounds):
        best = nearest()
        for i in range(len(places)):
            mine = [v for (_, v), (_, j) in zip(kept, best) if i == j]
            if mine:
                places[i] = [sum(c) // len(mine) for c in zip(*mine)]
    best = nearest()
    own = Counter()
    for d, i in best:
        own[i] += d
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return Counter((key, i, d, own[i], sum(own.values()), name(places[i])) for (key, _), (d, i) in zip(kept, best))


@pytest.mark.parametrize(("k", "rounds"), [(12, 5), (1, 2), (300, 3), (2, 0)])
def test_clusters(spark, k, rounds):
    rows = awkward_vectors()
    found = cluster_report(*shallot_clusters(frame(spark, rows), k, rounds, size=4)).collect()
    assert Counter(tuple(r) for r in found) == brute(rows, k, rounds)


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        assert cluster_report(*shallot_clusters(frame(spark, rows, 1), 3, 2, size=4)).collect() == []


def test_components_that_do_not_fit_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        shallot_clusters(frame(spark, [(1, [1e9, 0.0, 0.0, 0.0])], 1), 1, 1, size=4)


def test_the_scan_finds_both_nearest_and_skips_most():
    draw = np.random.default_rng(1)
    centroids = draw.integers(-3000, 3000, (40, 8))
    vectors = centroids[draw.integers(0, 40, 500)] + draw.integers(-50, 50, (500, 8))
    space = Geometry(centroids)
    one, two = draw.integers(0, 20, 500), draw.integers(20, 40, 500)
    near, d_near, far, d_far = shallot_scan(vectors, one, two, space)
    exact = ((vectors[:, None] - centroids) ** 2).sum(2)
    order = np.argsort(exact, axis=1, kind="stable")
    assert (near == order[:, 0]).all() and (far == order[:, 1]).all()
    rows = np.arange(500)
    assert (d_near == exact[rows, near]).all() and (d_far == exact[rows, far]).all()


def test_query_matches_its_oracle(spark, small):
    from tallyhouse.llm.queries import ORACLES, QUERIES

    assert_same(QUERIES["op12_centroid_clusters"](spark, small), connect(small), ORACLES["op12_centroid_clusters"])
