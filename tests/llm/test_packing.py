"""Packing: every id once, whole windows, and proportions that hold all along."""

import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from marketlens.llm import packing

pytestmark = pytest.mark.skipif(not Path(packing.VOCABULARY).exists(), reason="vocabulary files not here")


def whole_ids(rows):
    """Ids of whole texts by the tokenizer alone, in order."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t, *_ in rows]


def check(rows, pieces, window):
    """Pieces make up every document once, and lie without gaps in their sequences."""
    want = Counter((r[0], tuple(ids)) for r, ids in zip(rows, whole_ids(rows), strict=True))
    got, begun = Counter(), {}
    # Rows with one id: follow each document by what comes next.
    for p in sorted(pieces, key=lambda p: (p["doc_id"] is None, p["doc_id"] or 0, p["start"], p["sequence_id"])):
        assert p["length"] == len(p["ids"]) > 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        begun.setdefault(p["doc_id"], []).append(p)
    for doc_id, parts in begun.items():
        if sum(d == doc_id for d, *_ in want.elements()) == 1:
            assert [p["start"] for p in parts] == np.cumsum([0, *(p["length"] for p in parts[:-1])]).tolist()
            got[doc_id, tuple(i for p in parts for i in p["ids"])] += 1
            assert {p["doc_tokens"] for p in parts} == {sum(p["length"] for p in parts)}
        else:  # repeated ids: all their ids together
            many = [ids for (d, ids) in want.elements() if d == doc_id]
            assert Counter(i for p in parts for i in p["ids"]) == Counter(i for ids in many for i in ids)
            got.update({k: v for k, v in want.items() if k[0] == doc_id})
    assert got == want
    place = 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * window + p["offset"] == place
        place += p["length"]
        assert p["offset"] + p["length"] <= window
    return place


def test_encoder_gives_the_ids_of_whole_texts(corpus, odd_rows):
    rows = [(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()]
    rows += [r for r in odd_rows if r[1] is not None]
    rows += [(0, "é ́x Σας İ a b <|endoftext|>a 1234 don't'S \x1c\x85 ﬁ")]
    rng = random.Random(8)
    pools = [range(1, 128), range(1, 0x180), range(1, 0x3000), [*b"'sStTrRvVeElLmMdD  "], [0x130, 0x301, 0x3A3, 0x212A, 0x41, 0x20]]
    rows += [(0, "".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(60)))) for _ in range(2000)]
    rows += [(0, "".join(chr(rng.choice(pool)) for _ in range(40))) for pool in pools for _ in range(1000)]
    got = packing.Encoder(packing.VOCABULARY).encode([t or "" for _, t in rows])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == whole_ids(rows)


@pytest.mark.parametrize(("shard", "quantum"), [(1 << 21, 64), (700, 16), (64, 1)])
def test_odd_rows_are_packed_once(docs, odd_rows, shard, quantum):
    rows = [r for r in odd_rows if len(r[1] or "") < 60_000] + [(30 + i, "one two " * i, "s" + str(i % 3)) for i in range(40)]
    rows += [(90, "lonely words", None)]
    found = packing.packed(docs(*rows).repartition(3), window=128, quantum=quantum, shard_tokens=shard, with_ids=True)
    pieces = found.collect()
    check(rows, pieces, 128)
    sequences = {r["sequence_id"]: r for r in packing.sequences(found, 128, pad=7).collect()}
    last = max(sequences)
    assert all(len(r["ids"]) == 128 for i, r in sequences.items() if i < last)
    n = sequences[last]["length"]
    assert len(sequences[last]["ids"]) == (n if n & (n - 1) == 0 else 128)


@pytest.mark.parametrize("shard", [1 << 21, 4096, 1000])
def test_proportions_hold_in_every_prefix(docs, shard):
    """One source holds most; others are small, one has a single document."""
    rng = random.Random(2)
    text = lambda: " ".join(rng.choice(["river", "stone", "the", "hill"]) for _ in range(rng.randrange(1, 300)))
    rows = [(i, text(), rng.choice(["big"] * 6 + ["mid"] * 3 + ["low"])) for i in range(400)]
    rows += [(1000, "just this one", "single")]
    pieces = packing.packed(docs(*rows), window=512, quantum=32, shard_tokens=shard, with_ids=True).collect()
    total = check(rows, pieces, 512)
    size = Counter()
    for p in pieces:
        size[p["source"]] += p["length"]
    seen = Counter()
    for window in range(total // 512):
        for p in (p for p in pieces if p["sequence_id"] == window):
            seen[p["source"]] += p["length"]
        for source, n in size.items():
            assert abs(seen[source] - n * (window + 1) * 512 / total) <= 3 * 32, (window, source)


def test_cuts_cover_a_source_once():
    rng = random.Random(3)
    for _ in range(300):
        total, shards, quantum = rng.randrange(1, 3000), rng.randrange(1, 40), rng.choice([1, 7, 64])
        phase = rng.randrange(packing.PHASES)
        cuts = packing.shard_cuts(0, total, total, phase, shards, quantum)
        assert cuts[0][1] == 0 and cuts[-1][2] == total
        assert all(a[2] == b[1] and a[0] < b[0] for a, b in zip(cuts, cuts[1:], strict=False))
        assert all(c[1] % quantum == 0 and 0 <= c[0] < shards for c in cuts)
        # A document in the middle is cut at the same places.
        low = rng.randrange(total)
        inner = packing.shard_cuts(low, total - low, total, phase, shards, quantum)
        assert [c[2] for c in inner] == [c[2] for c in cuts if c[2] > low]


def test_empty_table_and_clashing_names(spark, docs):
    assert packing.packed(docs()).count() == 0
    clash = "doc_id long, text string, source string, ids string, shard int, place int, n int, total int, begin int"
    df = spark.createDataFrame([(1, "a b", "s", "x", 1, 2, 3, 4, 5)] * 2, clash)
    assert sorted(r["length"] for r in packing.packed(df).collect()) == [3, 3]
