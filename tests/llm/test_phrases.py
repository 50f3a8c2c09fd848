"""Collocations against counting every gram."""

import random
import re
from collections import Counter, defaultdict

import pytest

from marketlens.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, phrase long, n string, words string"


def brute_force(rows, least, top, longest=4):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i : i + m]] = max(around[p[i : i + m]], a)
        ranked = []
        for p, a in candidates.items():
            if 100 * around[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            result.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(result)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "n", "w") for i, (lang, t) in enumerate(rows)], SCHEMA)


def random_rows(seed, n=150):
    rng = random.Random(seed)
    fixed = ["the old stone bridge over the river", "once upon a time there was a very small house", "a a a a a a", "x y x y x y x y", "p q r p q r p q r p"]
    words = ["the", "The", "river", "stone", "été", "日本", "a", "of", "#1", "\U0001f600"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(8)):
            part = rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9)))
            text += part + rng.choice([". ", ", ", " ", "\t", "\n", "\r", "!  ", "\xa0", " "])
        rows.append((rng.choice(["en", "en", "fr", None, ""]), text))
    return rows


@pytest.mark.parametrize(("seed", "least", "top", "slots"), [(1, 3, 2000, 1 << 24), (2, 5, 7, 1 << 24), (3, 2, 50, 64), (4, 30, 2000, 32)])
def test_collocations_match_brute_force(spark, seed, least, top, slots):
    """With few slots nearly every pair seems frequent, and the result is the same."""
    rows = random_rows(seed) + [("en", None), ("en", ""), ("fr", " . ,\t"), ("en", "A" * 50_000)]
    got = phrases.collocations(frame(spark, rows).repartition(3), least, top, slots=slots)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, least, top)


def test_small_tasks_give_the_same_counts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "STEP", 5)
    monkeypatch.setattr(phrases, "HELD", 40)
    rows = random_rows(6, 40)
    got = phrases.collocations(frame(spark, rows).repartition(2), 3, 100)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 3, 100)


def compacted(spark, edges):
    """Paths of edges given as (phrase, count); a node occurs as often as the larger of its sides."""
    out, into = Counter(), Counter()
    for p, n in edges:
        out[p.rsplit(" ", 1)[0]] += n
        into[p.split(" ", 1)[1]] += n
    nodes = [("en", v, max(out[v], into[v])) for v in out.keys() | into.keys()]
    rows = spark.createDataFrame([("en", p, n) for p, n in edges], "lang string, phrase string, f long")
    found = phrases.paths(rows, spark.createDataFrame(nodes, "lang string, phrase string, f long"))
    return sorted((r["path"], r["n"]) for r in found.collect())


def test_unary_paths_are_compacted(spark, monkeypatch):
    line = [f"w{i:02}" for i in range(30)]
    edges = [(" ".join(line[i : i + 4]), 7) for i in range(27)]
    assert compacted(spark, edges) == [(" ".join(line), 7)]
    # A fork in the middle ends the path there.
    forked = edges + [("w10 w11 w12 else", 2)]
    middle = [e if e[0] != "w10 w11 w12 w13" else (e[0], 5) for e in forked]
    assert len(compacted(spark, middle)) == 4
    # A ring has no first edge; one word over and over leads to itself.
    ring = [("a b c a", 3), ("b c a b", 3), ("c a b c", 3), ("z z z z", 4)]
    assert compacted(spark, ring + edges) == sorted([*ring, (" ".join(line), 7)])
    monkeypatch.setattr(phrases, "PART", 10)
    parts = [p for p, _ in compacted(spark, edges)]
    assert [len(p.split()) for p in parts] == [13, 13, 10]


def test_empty_tables(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(None, None), ("en", "")])).count() == 0
