import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.llm import exact, fuse


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_filter_has_no_false_negative(keys):
    keys = np.array(sorted(keys), np.uint64)
    assert fuse.maybe_in(fuse.build(keys), keys).all()


def test_filter_has_few_false_positives_and_is_small():
    rng = np.random.default_rng(3)
    data = fuse.build(rng.integers(0, 2**63, 30_000).astype(np.uint64))
    others = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    assert fuse.maybe_in(data, others).mean() < 0.01
    assert len(data) < 30_000 * 1.3


def expected(rows):
    text = [(i, t or "") for i, t in rows]
    size = Counter(t for _, t in text)
    keep = {t: max((i for i, u in text if u == t and i is not None), default=None) for t in size}
    seen, out = set(), []
    for i, t in text:
        stays = i == keep[t] and (i, t) not in seen
        seen.add((i, t))
        out.append((i, keep[t], size[t], stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_match_brute_force(docs, odd_rows):
    rows = odd_rows + [(100 + i, f"copy {i % 3}") for i in range(20)]
    for old in (F.lit(False), F.lit(True), F.col("doc_id") % 2 == 0):
        got = exact.exact_groups(docs(*rows), old).collect()
        assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_empty_table_and_clashing_columns(docs):
    assert exact.exact_groups(docs(), F.lit(False)).count() == 0
    extra = docs((1, "a"), (2, "a")).withColumn("digest", F.lit(0)).withColumn("n", F.lit(9))
    assert {tuple(r)[:4] for r in exact.exact_groups(extra, F.lit(False)).collect()} == {(1, 2, 2, False), (2, 2, 2, True)}


def test_a_large_batch_is_cut_into_slices(spark, docs, monkeypatch):
    monkeypatch.setattr(exact, "BUCKET_KEYS", 16)
    rows = [(i, f"text {i % 300}") for i in range(400)]
    for old in (F.lit(False), F.col("doc_id") < 3, F.col("doc_id") % 2 == 0):
        assert sorted(map(tuple, exact.exact_groups(docs(*rows), old).collect()), key=repr) == expected(rows)
    # With a snapshot of three, every one of them is found by the slice that holds it.
    snapshot = exact.take_snapshot(exact.digest_rows(docs(*rows[:3])))
    batch = exact._grouped(exact.digest_rows(docs(*rows)))
    assert snapshot.buckets == 1
    found = {r["digest"] for r in exact.screen(batch, snapshot).collect()}
    assert {r["digest"] for r in snapshot.digests.collect()} <= found
    assert len(found) < 20
