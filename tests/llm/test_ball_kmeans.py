import hashlib
import math
import random

import numpy as np
import pytest

from tests.compare import assert_same, database
from tidemark.llm import ball_kmeans as B
from tidemark.llm import queries

SMALL = B.Settings(clusters=5, rounds=6, dimensions=3, block=7)


def brute(rows, s):
    """Lloyd's rounds in Python's whole numbers, all distances."""
    kept = [(i, [math.floor(s.scale * x) for x in v]) for i, v in rows if v is not None and len(v) == s.dimensions and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"{s.seed}:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[: s.clusters]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((distance(v, c), n) for n, c in enumerate(centres))
    for _ in range(s.rounds):
        groups = [[] for _ in centres]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centres, strict=True)]
    told = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = [sum(d for _, c, d in told if c == n) for n in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for i, c, d in told), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def clumps(rng, n, dims):
    return [(i, [float(rng.randint(0, 3)) * 8 + rng.gauss(0, 0.3) for _ in range(dims)]) for i in range(n)]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert_same(queries.op12_ball_kmeans(spark, folder), database(folder), queries.ORACLE_SQL["op12_ball_kmeans"])


@pytest.mark.parametrize("seed", range(3))
def test_assignment_from_any_earlier_one_is_the_nearest(seed):
    rng = np.random.default_rng(seed)
    points, centres = rng.integers(-6, 6, (400, 2)), rng.integers(-6, 6, (9, 2))
    every = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    for before in (np.zeros(400, np.int64), rng.integers(0, 9, 400), every.argmin(axis=1)):
        cluster, gap, _ = B.assign(points, before, centres)
        assert (cluster == every.argmin(axis=1)).all() and (gap == every.min(axis=1)).all()


def test_balls_far_apart_are_not_compared():
    rng = np.random.default_rng(1)
    centres = np.arange(10)[:, None] * np.array([[1000, 0]])
    truth = rng.integers(0, 10, 5000)
    points = centres[truth] + rng.integers(-50, 50, (5000, 2))
    cluster, _, compared = B.assign(points, truth, centres)
    assert (cluster == truth).all() and compared == 5000  # of 50,000


def test_equals_brute_force_with_ties_and_repeats(spark):
    rng = random.Random(4)
    rows = clumps(rng, 120, 3) + [(500 + i, [1.0, 2.0, 3.0]) for i in range(40)] + [(7, [0.5, 0.5, 0.5])] * 3
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    given = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert found(B.cluster(table, settings=SMALL)) == brute(given, SMALL)
    model = B.fit(table, settings=SMALL)
    assert model.compared[-1] < len(rows) * SMALL.clusters  # cores and rings spare comparisons


def test_odd_vectors(spark):
    odd = [None, [], [1.0, 2.0], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1e30, 0.0, 0.0], [0.0, -0.0, 0.0], [-5.5, 1e-9, 3.0]]
    rows = [(i, v) for i, v in enumerate(odd)] + [(None, [2.0, 2.0, 2.0])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, points int")
    assert found(B.cluster(table, settings=SMALL)) == brute([r for r in rows if r[0] != 6], SMALL)


def test_far_vectors_are_exact(spark):
    far = SMALL.largest / SMALL.scale * 0.999
    rows = [(i, [far * (-1) ** i, -far, far * (-1) ** (i // 2)]) for i in range(50)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute(rows, SMALL)
    assert [(r[0], r[1], r[2], r[5]) for r in found(B.cluster(table, settings=SMALL))] == [(r[0], r[1], r[2], r[5]) for r in expected]


def test_few_or_no_vectors(spark):
    two = [(3, [1.0, 2.0, 3.0]), (4, [4.0, 5.0, 6.0])]
    assert found(B.cluster(spark.createDataFrame(two, "vec_id long, embedding array<float>"), settings=SMALL)) == brute(two, SMALL)
    nothing = B.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>"), settings=SMALL)
    assert nothing.collect() == [] and nothing.columns[0] == "vec_id"
