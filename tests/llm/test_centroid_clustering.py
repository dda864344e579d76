import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from oreflow.llm.centroid_clustering import Bisectors, cluster_vectors, to_integers, with_digests

SCHEMA = "vec_id long, embedding array<double>, label int"


def exact(vector):
    return [math.floor(Fraction(x) * 256) for x in vector]


def brute(rows, size, k, rounds, seed):
    kept = [(i, exact(v)) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for c, members in groups.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, nearest(v), far(v, centroids[nearest(v)])) for i, v in kept]
    out = []
    fits = lambda x: x if x < 2**63 else None
    for i, c, d in found:
        inside = sum(x for _, o, x in found if o == c)
        alone = all(x < 2**63 for _, o, x in found if o == c)
        whole = sum(x for *_, x in found) if all(x < 2**63 for *_, x in found) else 2**63
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        out.append((i, c, fits(d), fits(inside) if alone else None, fits(whole), digest))
    return sorted(out, key=str)


def shown(spark, rows, **limits):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in with_digests(cluster_vectors(df, **limits)).collect()), key=str)


def sample(size, n=80, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=size).round(2)]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # a hot vector
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[3][1]), (None, None), (2000, None), (2001, []), (2002, [0.0] * (size + 1))]
    rows += [(2003, [None] + [0.0] * (size - 1)), (2004, [float("nan")] * size), (2005, [float("inf")] * size), (2006, [0.0] * size)]
    return rows


@pytest.mark.parametrize("limits", [(4, 7, 5), (3, 200, 2), (2, 1, 1), (5, 6, 0)])
def test_matches_brute_force(spark, limits):
    size, k, rounds = limits
    rows = sample(size)
    assert shown(spark, rows, size=size, k=k, rounds=rounds, seed=2) == brute(rows, size, k, rounds, 2)


def test_ties_favour_the_smaller_number():
    centroids = np.array([[4, 0], [0, 0], [2, 2], [0, 0]])
    found, far = Bisectors.of(centroids).nearest(np.array([[2, 0], [0, 0], [2, 1], [0, 1]]))
    assert found.tolist() == [0, 1, 2, 1] and far.tolist() == [4, 0, 1, 1]


def test_large_components(spark):
    rows = sample(3, 20) + [(70, [1e30, -1e30, 0.0]), (71, [1e300, 1.0, 2.0]), (72, [2.0**40, 0.5, -1e-300]), (73, [2.0**40 + 1, 0.25, 0.0])]
    assert shown(spark, rows, size=3, k=6, rounds=3, seed=2) == brute(rows, 3, 6, 3, 2)
    assert to_integers(np.array([[-0.001, 1e300, 0.999]])).tolist() == [exact([-0.001, 1e300, 0.999])]


def test_no_starts_and_no_rows(spark):
    assert shown(spark, []) == []
    got = shown(spark, [(None, [0.5, 1.0])], size=2)
    assert got == [(None, None, None, None, None, None)]


def test_float_vectors_and_other_columns(spark):
    rows = [(i, [0.1 * i, -0.3]) for i in range(9)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id int, embedding array<float>, cluster string, distance int")
    plain = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted((tuple(r) for r in with_digests(cluster_vectors(df, size=2, k=3)).collect()), key=str)
    assert got == brute(plain, 2, 3, 5, 2)
