import re
from collections import defaultdict

from marketlens.llm import mixing


def plain_targets(sizes):
    weights = {s: [5, 2, 1][i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, stopped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in sizes if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return share | {s: 3.0 * sizes[s] for s in stopped}
        stopped |= over


def check(rows):
    by_source = defaultdict(lambda: [0, 0, None])
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        entry = by_source[r["source"]]
        entry[0] += r["size"]
        entry[1] += r["taken"]
        entry[2] = r["target"]
        assert r["source_size"] is not None
    want = plain_targets({s: e[0] for s, e in by_source.items()})
    for source, (size, taken, target) in by_source.items():
        assert abs(target - want[source]) < 1e-6 * max(1, size)
        block = max(1, min(mixing.BLOCK, target // mixing.LEAST_BLOCKS))
        assert abs(taken - target) <= 1.5 * block + 0.002 * target, (source, size, taken, target)


def rows_of(df):
    sizes = mixing.sized(df)
    return mixing.with_mix(sizes, sizes).select("source", "size", "source_size", "target", "taken").collect()


def test_targets_and_taken_words(docs, corpus):
    check(rows_of(corpus))
    words = "w " * 900
    check(rows_of(docs((1, words, "a"), (2, words * 8, "b"), (3, "w " * 300, None), (4, None, "c"), (5, words, "a"), (5, words, "a"))))


def test_highest_quotients(spark):
    votes = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.4, "e": 7.0}
    for seats in (0, 1, 2, 7, 10, 100, 1001):
        quotients = sorted(((v / (2 * k - 1), n) for n, v in votes.items() for k in range(1, seats + 1)), key=lambda x: (-x[0], x[1]))
        want = {n: sum(1 for _, m in quotients[:seats] if m == n) for n in votes}
        df = spark.createDataFrame([(n, v, seats) for n, v in votes.items()], "name string, v double, seats long")
        got = {r["name"]: r["quota"] for r in mixing.apportioned(df, [], "name", "v", "seats").collect()}
        assert got == want


def test_reruns_agree_and_texts_hold_the_taken_words(corpus):
    first = {tuple(r) for r in mixing.mixed_rows(corpus).collect()}
    assert first == {tuple(r) for r in mixing.mixed_rows(corpus.repartition(5)).collect()}
    taken = {r[0]: r[4] for r in first}
    texts = mixing.mixed_texts(corpus).collect()
    found = defaultdict(int)
    for r in texts:
        found[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert {k: v for k, v in taken.items() if v} == dict(found)


def test_odd_rows_and_empty_table(docs, odd_rows):
    got = mixing.mixed_rows(docs(*odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert mixing.mixed_rows(docs()).count() == 0
    assert {r["taken"] for r in mixing.mixed_rows(docs((1, None), (2, " "))).collect()} == {0}
    assert mixing.mixed_texts(docs(*odd_rows)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_small_sources_come_near_their_targets(docs):
    """Every size from one word on, beside one source that holds most."""
    rows = [(i, "w " * n, f"s{i:03}") for i, n in enumerate([1, 2, 3, 5, 8, 10, 17, 31, 32, 33, 40, 64, 65, 100, 333])]
    rows += [(100 + i, "w " * 3_000, "zz") for i in range(10)]
    found = rows_of(docs(*rows))
    check(found)
    for r in found:
        if r["source"] != "zz":
            assert r["taken"] == 3 * r["size"] == r["target"], tuple(r)
    # Targets far under a block: many sources that share few words.
    few = [(i, "w " * (200 if i == 0 else 1), f"s{i:03}") for i in range(60)]
    check(rows_of(docs(*few)))


def test_rows_without_id_are_spread_by_text(docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rows = [(None, " ".join(f"w{i}" for i in range(n)), "a") for n in range(1, 80)] + [(1, "w " * 300, "b")]
    check(rows_of(docs(*rows)))


def test_columns_of_any_name_are_kept(docs):
    from pyspark.sql import functions as F

    names = ["size", "target", "blocks", "shard", "quota", "start", "end", "pieces", "repeat", "of", "rest", "taken", "n_blocks", "block"]
    base = docs((1, "a b c", "x"), (2, "d e", None))
    extra = base.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    got = mixing.mixed_texts(extra)
    assert got.columns == extra.columns
    for r in got.collect():
        assert all(r[n] == f"{n}{r['doc_id']}" for n in names)
    plain = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in mixing.mixed_texts(base).collect())
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()) == plain
