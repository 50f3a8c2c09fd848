"""Centroid clustering against plain loops."""

import hashlib
import random

import numpy as np
import pytest

from marketlens.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def brute_force(rows, k, dimensions, rounds):
    """``vec_id, cluster, distance`` and the centroids, by trying all."""
    kept = [
        (i, tuple(int(np.floor(64 * float(np.float32(x)))) for x in v))
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    middle = [list(v) for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            middle[j] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    return sorted(((i, *nearest(v)[::-1]) for i, v in kept), key=repr), middle


@pytest.mark.parametrize(("k", "n"), [(1, 20), (4, 3), (5, 200), (16, 400)])
def test_clusters_match_brute_force(spark, k, n):
    rng = random.Random(n)
    # Few distinct values, so that distances tie.
    rows = [(rng.randrange(n), [rng.choice([-0.5, -0.02, 0.0, 0.25, 1.0]) for _ in range(4)]) for _ in range(n)]
    rows += [rows[0], rows[0], (None, [0.25] * 4), (None, [0.25] * 4)]
    rows += [(1, None), (2, []), (3, [0.1] * 5), (4, [0.1, None, 0.1, 0.1]), (5, [float("nan")] * 4), (6, [float("-inf")] * 4)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3)
    found = centroids.clustered(df, k=k, dimensions=4)
    want, middle = brute_force(rows, k, 4, 3)
    assert sorted(map(tuple, found.rows.collect()), key=repr) == want
    assert found.centroids.tolist() == middle


def test_search_measures_fewer_centroids_than_there_are():
    rng = np.random.default_rng(1)
    middle = rng.integers(-1000, 1000, (32, 3)) * 50
    vectors = middle[rng.integers(0, 32, 500)] + rng.integers(-40, 40, (500, 3))
    search = centroids.Search(middle)
    measured, plain = [], centroids.squared

    def counted(a, b):
        measured.append(len(a))
        return plain(a, b)

    centroids.squared = counted
    try:
        cluster, distance = search.nearest(vectors)
    finally:
        centroids.squared = plain
    every = plain(vectors[:, None], middle[None])
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert sum(measured) < 500 * 32 / 2


def test_rows_of_the_query_have_sums_and_digests(spark):
    rows = [(i, [i / 7, -i / 3], "clash") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = centroids.cluster_rows(df, k=3, dimensions=2).collect()
    want, middle = brute_force([r[:2] for r in rows], 3, 2, 3)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == want
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in want)
        text = ",".join(map(str, middle[r["cluster"]]))
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_huge_components(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert centroids.cluster_rows(empty).count() == 0
    huge = spark.createDataFrame([(1, [3e38, -3e38], "a"), (2, [0.0, 0.0], "b")], SCHEMA)
    got = {r["vec_id"]: r for r in centroids.cluster_rows(huge, k=1, dimensions=2).collect()}
    assert got[1]["distance"] == got[2]["distance"] == 2 * (centroids.LIMIT // 2) ** 2
