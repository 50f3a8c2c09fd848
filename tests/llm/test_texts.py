"""Quality, licenses, fingerprints, pieces, secrets and language models on small texts."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log, log10
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import attention, fingerprints, licenses, lm_score, pieces, quality, secret_spans

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

needs_tokenizers = pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="vocabulary files not here")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- Quality ---------------------------------------------------------------------------------


def test_quality_tells_held_out_texts_apart(spark, docs):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["the", "river", "stone", "walked", "over"]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["BUY!!", "$$$", "CLICK|", "###"]) for _ in range(80))
    rows = [(i, good() if i % 2 else bad()) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs(*rows), labels)
    scored = quality.with_quality(docs(*rows, (900, None), (901, ""), (None, good())), model)
    found = {r["doc_id"]: r["score"] for r in scored.select("doc_id", "score").collect()}
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert out and all((found[i] >= 0.7) == bool(i % 2) for i in out)
    assert found[900] == found[901] and 0 <= found[900] <= 1
    empty = quality.fit_quality(docs(), labels)
    assert quality.with_quality(docs((1, "x")), empty).first()["score"] == pytest.approx(0.5)
    assert quality.with_quality(docs(), model).count() == 0


# --- Licenses --------------------------------------------------------------------------------


def test_license_places_match_brute_force(docs, odd_rows):
    texts = [
        "CC BY cc-by! cc by-nc", "Licensed under CC BY-NC 4.0.", "(c) All rights reserved. All  RIGHTS\nreserved",
        "under the GNU General Public License, version 3", "general public", "cc", "by cc by",
        "Permission is hereby granted, free of any charge, to any person obtaining a copy",
        "licensed under the apache license version 2 0 " * 3,
    ]
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(texts)]
    got = sorted((tuple(r)[:6] for r in licenses.license_rows(docs(*rows)).collect()), key=repr)
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        hits = [
            (p, label)
            for phrase, label in licenses.BASE.items()
            for p in range(len(words))
            if words[p : p + len(phrase.split())] == phrase.split()
        ]
        first, last = (min(hits)[0], max(hits)[0]) if hits else (None, None)
        want.append((i, len(words), len(hits), first, last, ",".join(sorted({x for _, x in hits}))))
    assert got == sorted(want, key=repr)
    rows = by_id(licenses.license_rows(docs(*rows)))
    assert rows[107]["labels"] == "mit" and 0.6 <= rows[107]["score"] <= 1
    assert rows[108]["labels"] == "apache" and rows[101]["labels"] == "cc-by,cc-by-nc"
    assert licenses.license_rows(docs()).count() == 0


def test_license_labels_need_telling_words_and_distinct_places(docs):
    texts = {
        "Released under the MIT License.": "mit",
        "under the terms of the GNU General Public License": "gpl",
        "under the terms of the GNU Lesser General Public License": "gpl,lgpl",
        "licensed under CC BY 4.0": "cc-by",
        "licensed under CC BY-SA 4.0": "cc-by",
        "licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "under the MIT campus": "",
        "the license, the license, the license, in compliance with compliance with": "",
        "the above copyright notice and this permission notice shall be included in all copies": "mit",
        "Redistributions of source code must retain the above copyright notice, this list of conditions": "bsd",
    }
    got = by_id(licenses.license_rows(docs(*enumerate(texts))))
    assert {t: got[i]["labels"] for i, t in enumerate(texts)} == texts


def test_license_spans_are_verified_in_order(docs):
    body = next(t for t, (label, _) in licenses.BODIES.items() if label == "isc")
    words = body.split()
    rng = random.Random(3)
    changed = [w for w in words if rng.random() > 0.04]
    backwards = " ".join(" ".join(words[i : i + 3]) for i in range(len(words) - 3, -1, -3))
    scattered = " filler words here ".join(" ".join(words[i : i + 3]) for i in range(0, len(words), 3))
    texts = {1: body.upper(), 2: "before " * 50 + " ".join(changed) + " after", 3: backwards, 4: scattered, 5: " ".join(words[: len(words) // 3])}
    got = by_id(licenses.license_rows(docs(*texts.items())))
    assert {i: got[i]["labels"] for i in texts} == {1: "isc", 2: "isc", 3: "", 4: "", 5: ""}
    assert got[1]["score"] == 1.0 and 0.6 <= got[2]["score"] < 1
    # All bodies find themselves.
    bodies = list(licenses.BODIES.items())
    found = by_id(licenses.license_rows(docs(*[(i, t) for i, (t, _) in enumerate(bodies)])))
    assert all(label in found[i]["labels"].split(",") and found[i]["score"] == 1 for i, (_, (label, _)) in enumerate(bodies))


def test_license_work_grows_with_the_text(docs):
    import time

    def seconds(n):
        df = docs((1, "the software is provided " * (n // 4)))
        start = time.perf_counter()
        assert licenses.license_rows(df).first()["n_words"] == n
        return time.perf_counter() - start

    seconds(4_000)
    assert seconds(320_000) < 12 * seconds(80_000)


# --- Fingerprints ----------------------------------------------------------------------------


def test_fingerprints_estimate_weighted_jaccard(docs, corpus, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 30)
    rows = by_id(fingerprints.with_likeness(fingerprints.fingerprints(corpus)))
    texts = {r["doc_id"]: r["text"] or "" for r in corpus.collect()}
    ids = sorted(texts, reverse=True)
    split = lambda t: Counter(w for w in re.split(r"[\x20\x09-\x0D]+", t) if w)
    errors = []
    for k, i in enumerate(ids):
        text, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert rows[i]["n_chars"] == len(text)
        assert rows[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b = split(text), split(changed)
        errors.append(rows[i]["near_edited"] - sum((a & b).values()) / max(1, sum((a | b).values())))
    assert len(rows) == len(texts)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09


def test_term_of_both_texts_draws_once(spark):
    rows = [(0, 1, " a b  b c", "b x x b b", "7 9"), (0, 2, "", "", "- 0")]
    texts = spark.createDataFrame(rows, "bucket int, ord int, text string, changed string, facts string")
    got = fingerprints.weighted_terms(texts).collect()
    log2, log3 = pytest.approx(log(2)), pytest.approx(log(3))
    weights = [(r["log_own"], r["log_edited"]) for r in got if r["fact"] is None and r["ord"] == 1]
    assert sorted(weights, key=str) == sorted([(0.0, None), (log2, log3), (0.0, None), (None, log2)], key=str)
    facts = {(r["ord"], r["term"]): r["fact"] for r in got if r["log_own"] is None and r["log_edited"] is None}
    assert facts == {(1, 0): 7, (1, 1): 9, (2, 0): None, (2, 1): 0}


def test_fingerprints_of_long_and_unlike_texts(docs):
    make = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    # By descending id: unlike its next, half of it shared, and twice as often.
    shared = make("s", 6_000)
    texts = {
        6: make("a", 20_000),
        5: make("b", 20_000),
        4: shared + " " + make("c", 6_000),
        3: shared,
        2: shared + " " + shared,
        1: "",
    }
    got = by_id(fingerprints.with_likeness(fingerprints.fingerprints(docs(*texts.items()), 256), 256))
    for i, want in ((6, 0.0), (5, 0.0), (4, 0.5), (3, 0.5), (2, 0.0), (1, 0.0)):
        assert got[i]["near_next"] == pytest.approx(want, abs=0.11 if want else 0.02), i


def test_rows_without_id_are_spread_and_keep_their_order(docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 4)
    rows = [(None, f"text {i} of none") for i in range(40)] + [(i, f"text {i}") for i in range(5)]
    prints = fingerprints.fingerprints(docs(*rows))
    buckets = {r["bucket"] for r in prints.where("doc_id IS NULL").select("bucket").distinct().collect()}
    assert min(buckets) >= -16 and max(buckets) == -1 and len(buckets) > 4
    got = fingerprints.with_likeness(prints).collect()
    ordered = docs(*rows).orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text").desc()).collect()
    texts = [r["text"] for r in ordered]
    want = Counter()
    for text, following in zip(texts, [*texts[1:], texts[0]], strict=True):
        half = len(text) // 2
        want[hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()] += 1
    assert Counter(r["edited_sha256"] for r in got) == want


def test_fingerprints_of_odd_rows(docs, odd_rows):
    got = fingerprints.with_likeness(fingerprints.fingerprints(docs(*odd_rows))).collect()
    assert len(got) == len(odd_rows)
    same = {}
    texts = {i: t or "" for i, t in odd_rows}
    for r in got:
        assert same.setdefault(texts[r["doc_id"]].split().__repr__(), r["fingerprint"]) == r["fingerprint"]
    one = fingerprints.with_likeness(fingerprints.fingerprints(docs((1, "a b")))).first()
    assert one["near_next"] == 1.0
    assert fingerprints.with_likeness(fingerprints.fingerprints(docs())).count() == 0


# --- Pieces ----------------------------------------------------------------------------------


def best_by_brute_force(word, vocabulary):
    scores = dict(zip(vocabulary.pieces, zip(vocabulary.scores, vocabulary.ids, strict=True), strict=True))
    best = [(0.0, [])]
    for end in range(1, len(word) + 1):
        ways = [
            (best[s][0] + scores[word[s:end]][0], [*best[s][1], scores[word[s:end]][1]])
            for s in range(max(0, end - 16), end)
            if word[s:end] in scores
        ]
        if not ways:
            raw = [vocabulary.byte_ids[b] for b in word[end - 1].encode()]
            ways = [(best[end - 1][0] + pieces.BYTES_SCORE, best[end - 1][1] + raw)]
        best.append(max(ways, key=lambda w: w[0]))
    return best[-1][1]


@needs_tokenizers
def test_pieces_are_the_best_and_decode_exactly(docs, odd_rows, corpus):
    vocabulary = pieces.load_vocabulary()
    encoder = pieces.Encoder(vocabulary)
    words = {w for r in corpus.limit(40).collect() for w in pieces.marked_words(r["text"])} | {"", "  a", "日本", "a▁b"}
    encoder.learn(words)
    for word in words:
        assert np.frombuffer(encoder.known[word], np.int32).tolist() == best_by_brute_force(" " + word, vocabulary)
    rows = pieces.encoded_rows(docs(*odd_rows)).collect()
    assert len(rows) == len(odd_rows) and all(r["round_trip"] for r in rows)
    assert {r["n_ids"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert pieces.encoded_rows(docs()).count() == 0


# --- Secrets ---------------------------------------------------------------------------------


def secret(rng, n=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def test_secret_spans(docs, odd_rows):
    rng = random.Random(2)
    filler = lambda: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(40))
    rows = [(200 + i, f'{filler()} token = "{secret(rng)}" {filler()}' if i % 3 else filler()) for i in range(90)]
    field = secret_spans.fit_field(docs(*rows))
    texts = [
        'Password: hunter2hunter2 and PASSWD="short" api_key=abcdefgh1',
        f"AKIA{'A' * 12} AKIA{'B' * 11} x{'0' * 31} {'f' * 32}",
        f"{filler()} here is {secret(rng)} alone",
        "\u017fecret = abcdefghij to\u212aen = abcdefghij",
    ]
    rows = odd_rows + [(500 + i, t) for i, t in enumerate(texts)]
    got = by_id(secret_spans.with_secrets(docs(*rows), field))
    one = got[500]
    assert (one["n_assign"], one["n_access"], one["n_hex"]) == (2, 0, 0)
    assert one["base_sha256"] == hashlib.sha256(b"assign:0:24,assign:44:61").hexdigest()
    assert (got[501]["n_access"], got[501]["n_hex"]) == (1, 1)
    assert got[502]["spans"].startswith("hex:")
    assert got[503]["n_assign"] == 0
    assert len(got) == len({i for i, _ in rows})
    assert secret_spans.with_secrets(docs(), field).count() == 0


def test_field_decodes_as_brute_force():
    rng = np.random.default_rng(3)
    field = secret_spans.Field(rng.normal(size=(6, 3)).astype(np.float32), rng.normal(size=(3, 3)))
    features = rng.integers(0, 6, (7, 2))
    tags = secret_spans.decode(field, features, np.array([1, 1, 1, 1, 2, 2, 3]))
    scores = field.weights[features].sum(1)
    for low, high in ((0, 4), (4, 6), (6, 7)):
        n = high - low
        worth = {}
        for code in range(3**n):
            path = [code // 3**j % 3 for j in range(n)]
            if path[0] != secret_spans.INSIDE:
                total = sum(scores[low + j, path[j]] for j in range(n))
                worth[tuple(path)] = total + sum(field.moves[a, b] for a, b in zip(path, path[1:], strict=False))
        assert tuple(tags[low:high].tolist()) == max(worth, key=worth.get)


def test_field_finds_secrets_that_no_pattern_gives():
    rng = random.Random(4)
    texts = [f'value {i} token = "{secret(rng)}" and more words here\nplain line {i}' for i in range(60)]
    field = secret_spans.train(texts)
    value = secret(rng, 31)
    text = f'the key we use\nvalue 3 auth = "{value}" and more words here'
    assert not secret_spans.base_matches(text)
    (spans,) = secret_spans.field_spans([text], [text.encode()], field)
    assert [text[a:b] for a, b in spans] == [value]


def test_spans_that_reach_past_a_pattern_stay():
    text = "password: Abcd1234!xK9$z end"
    whole = (text.index("Abcd"), text.index(" end"))
    tagged = {"spans": [whole, (10, 18)]}
    original = secret_spans.field_spans
    secret_spans.field_spans = lambda texts, data, field: [tagged["spans"]]
    try:
        ((*_, spans),) = secret_spans.spans_of([text], None)
    finally:
        secret_spans.field_spans = original
    assert spans == f"assign:0:18,crf:{whole[0]}:{whole[1]}"


def test_secret_across_the_cut_of_a_long_line_is_one_span():
    # Tags depend on the shape alone: upper case begins or goes on, all else is outside.
    weights = np.zeros((secret_spans.N_FEATURES, 3), np.float32)
    text = "ab " * (secret_spans.SEQUENCE - 1) + "XY ZQ" + " ab" * 300
    tokens = secret_spans.tokenized([text.encode()])
    upper, lower = tokens.features[secret_spans.SEQUENCE, 0], tokens.features[0, 0]
    weights[lower, secret_spans.OUTSIDE] = 9
    weights[upper, [secret_spans.BEGIN, secret_spans.INSIDE]] = 9
    moves = np.zeros((3, 3))
    moves[secret_spans.BEGIN, secret_spans.INSIDE] = 3
    moves[secret_spans.OUTSIDE, secret_spans.INSIDE] = secret_spans.NEVER
    (spans,) = secret_spans.field_spans([text], [text.encode()], secret_spans.Field(weights, moves))
    assert [text[a:b] for a, b in spans] == ["XY ZQ"]


def test_field_finds_secrets_that_no_pattern_gives(corpus):
    """Held-out texts and words before the secrets; base patterns cover none of what is counted."""
    texts = [r["text"] for r in corpus.orderBy("doc_id").collect() if r["text"] and len(r["text"]) < 20_000]
    hits = [t for t in texts[::2] if secret_spans.base_matches(t)]
    field = secret_spans.train_planted(hits, texts[::2])
    intros = ("webhook", "license code is", "connection string", "door code", "passcode was")
    made, planted = secret_spans.planted(texts[1::2], np.random.default_rng(9), intros)
    right = wrong = missed = 0
    for text, want, row in zip(made, planted, secret_spans.spans_of(made, field), strict=True):
        covered = [(s, e) for s, _, e, _, _ in secret_spans.base_matches(text)]
        want = {(a, b) for a, b in want if not any(s < b and a < e for s, e in covered)}
        found = [tuple(map(int, x.split(":")[1:])) for x in row[-1].split(",") if x.startswith("crf")]
        found = {(a, b) for a, b in found if not any(s < b and a < e for s, e in covered)}
        right, wrong, missed = right + len(found & want), wrong + len(found - want), missed + len(want - found)
    assert right > 200
    assert right / (right + wrong) > 0.97
    assert right / (right + missed) > 0.4
    # Texts as they are: next to nothing beside the patterns.
    plain = secret_spans.spans_of(texts[1::2], field)
    assert sum(r[-1].count("crf") for r in plain) <= len(plain) / 50


def test_long_lines_are_decoded_whole():
    rng = np.random.default_rng(2)
    field = secret_spans.Field(rng.normal(size=(secret_spans.N_FEATURES, 3)).astype(np.float32), rng.normal(size=(3, 3)))
    field.moves[secret_spans.OUTSIDE, secret_spans.INSIDE] = secret_spans.NEVER
    n = 700
    features = rng.integers(0, secret_spans.N_FEATURES, (n, 5))
    tags = secret_spans.decode(field, features, np.zeros(n, int))
    scores = field.weights[features].sum(1)
    best, came = scores[0] + [0, 0, secret_spans.NEVER], []
    for t in range(1, n):
        ways = best[:, None] + field.moves
        came.append(ways.argmax(0))
        best = ways.max(0) + scores[t]
    path = [int(best.argmax())]
    for back in reversed(came):
        path.append(int(back[path[-1]]))
    assert tags.tolist() == path[::-1]


def test_result_columns_replace_those_of_the_input(docs):
    extra = docs((1, "password: Abcd1234xyz")).withColumn("spans", F.lit("old")).withColumn("other", F.lit(1))
    got = secret_spans.with_secrets(extra, secret_spans.train([]))
    assert got.columns.count("spans") == 1 and "other" in got.columns
    assert got.first()["spans"].startswith("assign:0:21")


# --- Language models -------------------------------------------------------------------------


@needs_tokenizers
def test_base_scores_match_brute_force(docs, odd_rows):
    rows = odd_rows + [(20 + i, f"one two word{i % 4} {'three' * (i % 3)}") for i in range(40)]
    words = [[*WORD.findall((t or "").translate(LOWER)), None] for _, t in rows]
    out = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows]
    count = Counter(w for ws, o in zip(words, out, strict=True) if not o for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(
        ((i, o, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(log10((count[w] + 1) / (n + v + 1)) for w in ws), 5))
         for (i, _), ws, o in zip(rows, words, out, strict=True)), key=repr)
    got = lm_score.scored_rows(docs(*rows)).collect()
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 5)) for r in got), key=repr) == want
    assert all(r["score"] < 0 for r in got)
    assert lm_score.scored_rows(docs()).count() == 0


@needs_tokenizers
@pytest.mark.parametrize("head", [lm_score.HEAD, 20])
def test_scores_match_the_formula(docs, monkeypatch, head):
    """Ids from all of the vocabulary, many first ids, and pairs in and out of the head."""
    monkeypatch.setattr(attention, "STEPS", 5)
    monkeypatch.setattr(lm_score, "HEAD", head)
    ranks = Path(lm_score.VOCABULARY).read_bytes()
    encoding = lm_score.tokenizer(ranks)
    size, edge = encoding.n_vocab + 1, encoding.n_vocab
    rng = random.Random(4)
    some = [encoding.decode([rng.choice([rng.randrange(256, 50_000), rng.randrange(43_000, 50_000)])]) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(some) for _ in range(rng.randrange(40)))) for i in range(120)] + [(500, None), (501, "")]
    ids = {i: encoding.encode_ordinary(t or "") for i, t in rows}
    train = [i for i in ids if zlib.crc32(str(i).encode()) % 7 != 2]
    counts, pairs, after = np.zeros(size), Counter(), Counter()
    for i in train:
        counts += np.bincount([*ids[i], edge], minlength=size)
        pairs.update(zip([edge, *ids[i]], [*ids[i], edge], strict=True))
    assert max(a for a, _ in pairs) > 42_730 and len({ids[i][0] for i in train if ids[i]}) > 20
    df = docs(*rows)
    model = lm_score.train_model(df.select("doc_id", "text"), counts, ranks)
    for (a, b), n in pairs.items():
        after[a, model.of_class[b]] += n
    got = by_id(lm_score.scored_rows(df))
    for i, own in ids.items():
        want = attention.log10_scores(model, [np.array(own, np.int64)], shares=False)[0]
        for a, b in zip([edge, *own], [*own, edge], strict=True):
            kind = model.of_class[b]
            if kind >= attention.SINGLE:
                c = pairs[a, b] + lm_score.PRIOR * 10.0 ** float(model.share[b])
                want += log10(c / (after[a, kind] + lm_score.PRIOR))
        assert got[i]["score"] == pytest.approx(want, rel=1e-4, abs=1e-3), i


def test_every_id_is_scored_once():
    for lengths in ([1], [16], [17, 5], [28, 29, 100, 1]):
        first, size, context = attention.windows(np.array(lengths))
        seen = np.zeros(sum(lengths), int)
        for f, s, c in zip(first, size, context, strict=True):
            seen[f + c : f + s] += 1
        assert (seen == 1).all()


def test_attention_learns_and_sums_to_one(monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 150)
    rng = np.random.default_rng(5)
    make = lambda: np.concatenate([[a, (a + 1) % 40] for a in rng.integers(0, 40, 60)])
    texts = [make() for _ in range(60)]
    counts = np.bincount(np.concatenate(texts), minlength=51).astype(float)
    counts[50] = len(texts)
    model = attention.train(texts, counts, edge=50)
    held = [make() for _ in range(20)]
    plain = sum(np.log10((counts[np.append(t, 50)] + 1) / (counts + 1).sum()).sum() for t in held)
    assert attention.log10_scores(model, held).sum() > 0.9 * plain
    start = held[0][:5]
    total = sum(10 ** (attention.log10_scores(model, [np.append(start, i)])[0]) for i in range(50))
    ends = attention.log10_scores(model, [start])[0]
    assert np.isfinite(total) and total + 10**ends <= 1.0


@needs_tokenizers
def test_texts_are_split_into_ids_once(docs):
    ranks = Path(lm_score.VOCABULARY).read_bytes()
    encoding = lm_score.tokenizer(ranks)
    df = docs((1, "one river, one stone"), (3, None), (4, "é\tZ"))
    rows = lm_score.with_ids(df, ranks)
    assert lm_score.with_ids(rows, ranks) is rows
    for r in rows.collect():
        text = r["text"] or ""
        assert np.frombuffer(r[lm_score.IDS], np.uint16).tolist() == encoding.encode_ordinary(text)
        assert r[lm_score.SIZE] == len(text.encode())
    # Later steps go by the ids beside the text.
    other = rows.withColumn(lm_score.IDS, F.lit(np.array([7, 7, 9], np.uint16).tobytes()))
    counts = {r["key"]: r["n"] for r in lm_score.corpus_counts(other, ranks).where("kind = 1").collect()}
    n = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in (1, 3, 4))
    assert counts == {7: 2 * n, 9: n}


@needs_tokenizers
def test_ids_are_those_of_the_whole_pattern():
    ranks = Path(lm_score.VOCABULARY).read_bytes()
    encoding, encode = lm_score.tokenizer(ranks), lm_score.id_bytes(ranks)
    bits = [*" \n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u3000\u200b", "  ", "'s", "'", "don't", "a", "Word", "12", "é", "中文", "!?", "\u0301"]
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=rng.randrange(14)))
        assert encode(text) == np.array(encoding.encode_ordinary(text), np.uint16).tobytes(), text


def test_common_keys_fill_the_head(monkeypatch):
    """Not only keys that make up a HEAD-th of the corpus are looked up, but as many as have room."""
    monkeypatch.setattr(lm_score, "HEAD", 10)
    sizes = [(1, 50), (2, 6), (3, 1), (9, 3)]
    assert lm_score.least_common(sizes, 50 + 12 + 3 + 27) == 2
    assert lm_score.least_common([(1, 4)], 4) == 1
    assert lm_score.least_common([(1, 11)], 11) == 2
    assert lm_score.least_common([(1, 8), (2, 3)], 14) == 2
    # A range that is too large as a whole: a HEAD-th of all is common in any case.
    assert lm_score.least_common([(16, 11)], 16 * 10 + 17) == 18
    assert lm_score.least_common([], 0) == 2


@needs_tokenizers
def test_words_with_room_in_the_head_are_not_shuffled(spark, docs, monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 2)
    sent = []
    inner = lm_score._head
    monkeypatch.setattr(lm_score, "_head", lambda counts, least: sent.append(inner(counts, least)) or sent[-1])
    rows = [(i, f"only{i} word{i} " + "same " * 5) for i in range(30)]
    train = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows)
    got = by_id(lm_score.scored_rows(docs(*rows)))
    words, _ = sent
    assert sorted(words[1].tolist()) == [1.0] * (2 * train) + [5.0 * train]
    assert [got[i]["n_known"] for i, _ in rows] == [8 if zlib.crc32(str(i).encode()) % 7 != 2 else 6 for i, _ in rows]


@needs_tokenizers
def test_id_is_predicted_from_the_one_before(docs):
    # "b" and "d" are as frequent as each other; only what stands before tells them apart.
    rows = [(i, " ".join(["mountain river stone valley"] * 20) + " end" * (i % 3)) for i in range(60)]
    rows += [(1_000 + i, " ".join(["mountain river"] * 10)) for i in range(20)]
    rows += [(2_000 + i, " ".join(["mountain valley"] * 10)) for i in range(20)]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train = [r for r in rows if r[0] < 1_000]
    held = [r for r in rows if r[0] >= 1_000 and out(r[0])]
    spread = [(5_000 + i, " ".join(f"w{i * 40 + j}" for j in range(40))) for i in range(60)]
    got = by_id(lm_score.scored_rows(docs(*train, *spread, *held)))
    good = [got[i]["score"] for i, t in held if "river" in t]
    bad = [got[i]["score"] for i, t in held if "valley" in t]
    assert good and bad and min(good) > max(bad) + 5


@needs_tokenizers
def test_pair_counts_and_shares_sum_to_one(docs):
    ranks = Path(lm_score.VOCABULARY).read_bytes()
    encoding = lm_score.tokenizer(ranks)
    size = encoding.n_vocab + 1
    texts = ["red apple green pear", "red pear", "", None, "green apple " * 9]
    rows = [(i, t) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = lm_score.corpus_counts(docs(*rows), ranks).cache()
    want = Counter()
    for _, t in rows:
        ids = [size - 1, *encoding.encode_ordinary(t or ""), size - 1]
        want.update(a * size + b for a, b in zip(ids, ids[1:], strict=False))
    found = {r["key"]: r["n"] for r in counts.where(f"kind = {lm_score.PAIR_COUNT}").collect()}
    assert found == dict(want)
    ids = np.bincount([k % size for k in want.elements()], minlength=size).astype(float)
    of_class, share = attention.classes_of(ids)
    after = lm_score.after_counts(counts, of_class)
    before = next(iter(want)) // size
    c = np.array([want[before * size + i] for i in range(size)])
    p = (c + lm_score.PRIOR * 10.0**share) / (after[before, of_class] + lm_score.PRIOR)
    assert np.bincount(of_class, p, attention.CLASSES) == pytest.approx(1, abs=1e-4)


def test_short_texts_train_the_weights(monkeypatch):
    monkeypatch.setattr(attention, "STEPS", 200)
    texts = [np.array([k, k + 20, k]) for k in range(20)] * 10
    counts = np.bincount(np.concatenate(texts), minlength=51).astype(float)
    counts[50] = len(texts)
    model = attention.train(texts, counts, edge=50)
    monkeypatch.setattr(attention, "STEPS", 0)
    blank = attention.train(texts, counts, edge=50)
    assert attention.log10_scores(model, texts).sum() > 0.9 * attention.log10_scores(blank, texts).sum()


@needs_tokenizers
def test_weights_learn_from_every_training_text(docs, monkeypatch):
    """Also from texts that gave nothing to the starting weights; held-out ones teach nothing."""
    monkeypatch.setattr(attention, "STEPS", 3)
    monkeypatch.setattr(lm_score, "TRAIN_ROWS", 2)
    ranks = Path(lm_score.VOCABULARY).read_bytes()
    encoding = lm_score.tokenizer(ranks)
    rows = [(i, f"word{i} {chr(97 + i % 26)}{chr(97 + i // 26)} " * 30) for i in range(60)]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    ids = {i: encoding.encode_ordinary(t) for i, t in rows}
    met = {encoding.n_vocab, *(k for i in ids if not out(i) for k in ids[i])}
    counts = np.bincount([k for i in ids if not out(i) for k in ids[i]], minlength=encoding.n_vocab + 1).astype(float)
    counts[-1] = sum(not out(i) for i in ids)
    df = docs(*rows).select("doc_id", "text")
    blank = attention.train([], counts, edge=encoding.n_vocab)
    model = lm_score.train_model(df, counts, ranks)
    assert set(np.flatnonzero((model.embed != blank.embed).any(1))) == met
    held = [np.array(ids[i]) for i in ids if out(i)]
    start = lm_score.start_model(df, counts, ranks)
    assert attention.log10_scores(model, held).sum() > attention.log10_scores(start, held).sum()


# --- Names that clash ------------------------------------------------------------------------


@needs_tokenizers
def test_other_columns_of_any_name_do_no_harm(spark, docs):
    """Each operator with columns named as those it makes on the way, and a repeated row."""
    names = ["ids", "row", "n", "term", "word", "pair", "bucket", "ord", "words", "place", "kind", "key", "value", "template"]
    base = docs((1, "under the mit license here"), (2, None), (2, None), (3, "one two"))
    extra = base.withColumns({c: F.lit("x") for c in names})
    assert pieces.encoded_rows(extra).count() == 4
    assert licenses.license_rows(extra).count() == 4
    assert lm_score.scored_rows(extra).count() == 4
    assert fingerprints.with_likeness(fingerprints.fingerprints(extra)).count() == 4
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    scored = quality.with_quality(extra.withColumn("score", F.lit("old")), quality.fit_quality(extra, labels))
    assert scored.columns.count("score") == 1 and all(0 <= r["score"] <= 1 for r in scored.collect())
    assert [r["n"] for r in scored.collect()] == ["x"] * 4
