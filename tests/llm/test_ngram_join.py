import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlens.llm import ngram_join, wordhash
from marketlens.llm.components import connected

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in lists[g])
        for g in s:
            lists[g].append(i)
        for j, o in shared.items():
            if 100 * o >= 75 * (len(s) + len(sets[j]) - o):
                group[find(i)] = find(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (smallest.get(find(i)), doc) if x is not None]
        smallest[find(i)] = min(known, default=None)
    return sorted(((d, len(s), smallest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near_copies(rng, n, words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(text)


def test_classes_match_brute_force(docs, odd_rows):
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for _ in range(6):
        texts += near_copies(rng, 12, 80, 5)
    texts += [f"{passage} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(40))}" for _ in range(25)]
    texts += near_copies(rng, 40, 150, 10)
    texts += ["a b c d", "A b  c d", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    rows = odd_rows + [(1000 + i, t) for i, t in enumerate(texts)]
    got = ngram_join.linked(docs(*rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


@pytest.mark.parametrize("shard", [7, 10_000])
def test_rest_search_finds_every_group(docs, monkeypatch, shard):
    """Without star links, DivideSkip alone gives the same classes, in shards as in one."""
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate([*near_copies(rng, 30, 60, 4), *near_copies(rng, 20, 60, 4)])]
    monkeypatch.setattr(ngram_join, "SHARD", shard)
    _, sets = ngram_join.sieved(docs(*rows))
    lists = ngram_join.search_lists(sets)
    none = ngram_join.star_pairs(lists).where("false")
    labels = connected(ngram_join.rest_links(lists, none, sets)).collect()
    sizes = sorted(Counter(r["label"] for r in labels).values())
    want = sorted(n for n in Counter(c for *_, c in brute(rows)).values() if n > 1)
    distinct = len({frozenset(shingles(t)) for _, t in rows})
    assert sum(sizes) <= distinct
    assert len(sizes) <= len(want) + 2


def test_divide_skip_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40)) for _ in range(50)]
    lists = {}
    for t in range(60):
        lists[t] = np.array([i for i, s in enumerate(sets) if t in s])
    for query in sets[:20]:
        for need in (1, 5, 15, len(query)):
            items, counts = ngram_join.divide_skip(query, need, lists, len(sets))
            want = {i: len(np.intersect1d(query, s)) for i, s in enumerate(sets)}
            assert dict(zip(items.tolist(), counts.tolist(), strict=True)) == {i: c for i, c in want.items() if c >= need}


def test_word_hashes_tell_words_apart():
    words = ["abba", "baab", "aabb", "ab", "ba", "a", "b", "é", "è", "x" * 5000, "x" * 5001, "日本", "本日"]
    hashes, counts = wordhash.word_hashes([" ".join(words).encode(), b"", b"ABBA\tBaab"])
    assert counts.tolist() == [len(words), 0, 2]
    assert len(set(hashes[: len(words)].tolist())) == len(words)
    assert hashes[len(words) :].tolist() == hashes[:2].tolist()
    # The same alone as beside very long words.
    for word, value in zip(words, hashes.tolist(), strict=False):
        assert wordhash.word_hashes([word.encode()])[0].tolist() == [value]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 299)]
    labels = {r["node"]: r["label"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {labels[i] for i in range(41)} == {0}
    assert {labels[i] for i in range(100, 150)} == {100}
    assert labels[300] == labels[299] == 299


def test_empty_table_and_no_links(docs):
    assert ngram_join.linked(docs()).count() == 0
    assert [tuple(r) for r in ngram_join.linked(docs((1, "only one text here now"))).collect()] == [(1, 1, 1)]
