"""Drift-tightened clustering against Lloyd's rounds in plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from saleslake.llm.drift_clusters import centroid_clusters, pack, quantised, shrinkage, unpack


def brute(rows, k, rounds, seed, dim):
    vecs = [(i, [math.floor(256 * x) if abs(x) < 2.0 ** 60 else int(x) * 256 for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    ordered = sorted(vecs, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), pack(np.array(r[1], object))))
    centres = [list(v) for _, v in ordered[:k]]

    def assign():
        out = []
        for _, v in vecs:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        at = assign()
        for c in range(len(centres)):
            mine = [v for (_, v), (o, _) in zip(vecs, at) if o == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    fit = lambda v: v if v < 1 << 63 else None
    own = [sum(d for o, d in at if o == c) for c in range(len(centres))]
    # a distance that a long can't hold has no inertia either
    broken = [any(o == c and d >= 1 << 63 for o, d in at) for c in range(len(centres))]
    return sorted(((i, o, fit(d), None if broken[o] else fit(own[o]), None if any(broken) else fit(sum(own)),
                    hashlib.sha256(",".join(map(str, centres[o])).encode()).hexdigest())
                   for (i, _), (o, d) in zip(vecs, at)), key=str)


def got(spark, rows, k, rounds, seed, dim):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    return sorted(map(tuple, centroid_clusters(df, k, rounds, seed, dim).collect()), key=str)


def test_rounds_are_exact(spark):
    rng = random.Random(5)
    middles = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(7)]
    rows = [(i, [m + rng.gauss(0, 0.3) for m in rng.choice(middles)]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]                 # a third are copies of one vector
    assert got(spark, rows, 9, 5, 2, 6) == brute(rows, 9, 5, 2, 6)


def test_odd_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for i in range(60)]         # many ties
    rows += [(2, rows[2][1]), (2, [0.5, 0.5, 0.5]), (None, [1.0, 2.0, 3.0]), (70, None), (71, [1.0]), (72, [1.0, None, 2.0]),
             (73, [math.nan, 0.0, 0.0]), (74, [0.0, math.inf, 0.0]), (75, [3e38, -3e38, 1.0]), (76, [3e38, -3e38, 2.0]),
             (77, [5e9, 1.0, 1.0]), (78, [9000.0, -9000.0, 0.0])]
    assert got(spark, rows, 8, 4, 2, 3) == brute(rows, 8, 4, 2, 3)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.25, -0.5]), (2, [3.0, 4.0])]
    assert got(spark, rows, 5, 2, 2, 2) == brute(rows, 5, 2, 2, 2)
    assert got(spark, [(1, None)], 5, 2, 2, 2) == []
    assert got(spark, [], 5, 2, 2, 2) == []


def test_no_member_of_the_sphere_loses_more_than_the_bound():
    rng = np.random.default_rng(1)
    tight = 0
    for _ in range(300):
        d = int(rng.integers(1, 6))
        old = rng.integers(-900, 900, (4, d))
        new = old + rng.integers(-200, 200, (4, d))
        radius = float(rng.uniform(1, 600))
        x = rng.normal(size=(400, d))
        x = old[0] + radius * x / np.linalg.norm(x, axis=1, keepdims=True) * rng.uniform(0, 1, (400, 1)) ** (1 / d)
        lost = (np.linalg.norm(x[:, None] - old, axis=2) - np.linalg.norm(x[:, None] - new, axis=2))[:, 1:].max()
        drift, loss = shrinkage(old.tolist(), new.tolist(), {0: radius})
        assert lost <= loss[0] + 1e-9
        assert loss[0] <= drift[1:].max() * (1 + 1e-6)
        tight += loss[0] < 0.9 * drift[1:].max()
    assert tight > 50


@pytest.mark.parametrize("v", [[0.0, -0.001, 100.0], [4096.5, -1e5, 0.0], [1e300, -2.0, 0.5]])
def test_components_keep_their_values(v):
    whole = quantised(np.array([v]))[0]
    assert [int(x) for x in unpack(pack(whole))] == [math.floor(256 * x) if abs(x) < 1e12 else int(x) * 256 for x in v]
