"""Find secrets: fixed patterns, and a linear-chain conditional random field over tokens.

Tokens are runs of bytes between white space and delimiters; each delimiter is a token. The field
tags the tokens of a line as begin, inside or outside of a secret. What a token scores for a tag
comes from its shape, its word, the words and shapes around it, and features of the whole text.
Whole lines are decoded by Viterbi, many of similar length at once in numpy; only while the field
learns is a line of over ``SEQUENCE`` tokens cut, with features that look across the cut.

The field is trained here by maximum likelihood on at most ``TRAIN_HITS`` texts with a match of the
patterns and ``TRAIN_OTHERS`` texts at large, chosen by a hash of the id, none over ``TRAIN_CHARS``
characters. Its labels are the secrets that the patterns find, and secrets of forms that no pattern
gives, which are planted into copies of the texts at large: random strings after words such as
``INTROS``, or alone. The same words before ordinary ones are planted too, and are no secrets. Words are
dropped at random while it learns, so it knows secrets by their shape as well. A span that reaches
further than a pattern's match stands beside it; one that a match covers is left out. Scanning has no
bound: whole texts, all rows.

Null and empty texts have no spans. Other columns are kept; those with the names of the result are
replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import chosen_texts, whole_text

TRAIN_HITS, TRAIN_OTHERS, TRAIN_CHARS = 200, 300, 20_000
STEPS, RATE, DROP = 40, 0.5, 0.4
SEQUENCE = 128
PLANTS = 16
RUN_BYTES = 4_000_000
WORD_BITS = 12
SHAPES = 8 * 32
KINDS = ("assign", "access", "hex", "crf")
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
NEVER = -1e9

# The three patterns of the base search.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
# The field's spans have a digit: without one, a secret is not told from a word for certain.
_DIGIT = re.compile("[0-9]")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
# The same three, for Spark to choose training texts.
_LIKELY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"

# Words that the planted secrets follow, and the characters that these are made of.
INTROS = (
    "password is", "the password was", "my pwd", "passphrase", "bearer", "authorization bearer", "credential",
    "login with", "private key", "signing key is", "auth", "session", "pin code", "client key", "use key", "",
)
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    _LETTERS + _LETTERS.upper() + "0123456789",
    _LETTERS + _LETTERS.upper() + "0123456789!#$%&*+-_@^~",
    _LETTERS + "0123456789",
    "0123456789ABCDEF",
    _LETTERS.upper() + "0123456789",
    _LETTERS + _LETTERS.upper() + "0123456789+/",
)

_DELIMITERS = b"\"'`,;:=()[]{}<>|"


def base_matches(text: str, data: bytes | None = None) -> list[tuple[int, str, int, int, int]]:
    """``start, kind, end, value start, value end`` in code points, by start and kind as listed."""
    low = (text.encode("utf-8", "replace") if data is None else data).lower()
    found = []
    if any(k in low for k in _KEYWORDS):
        found += [
            (m.start(), 0, m.end(), m.start(2), m.end(2))
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= LEAST["assign"]
        ]
    if b"akia" in low:
        found += [
            (m.start(), 1, m.end(), m.start(), m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST["access"]
        ]
    if _has_hex_run(low):
        found += [
            (m.start(), 2, m.end(), m.start(), m.end())
            for m in HEX.finditer(text)
            if m.end() - m.start() >= LEAST["hex"]
        ]
    return [(s, KINDS[k], e, vs, ve) for s, k, e, vs, ve in sorted(found)]


_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True


def _has_hex_run(data: bytes) -> bool:
    """Every 16th byte of a run of 32 is looked at, so only few places need a closer look."""
    b = np.frombuffer(data, np.uint8)
    hit = np.flatnonzero(_IS_HEX[b[::16]])
    if len(hit) < 2 or not (np.diff(hit) == 1).any():
        return False
    ends = np.flatnonzero(~_IS_HEX[b])
    gaps = np.diff(np.concatenate([[-1], ends, [len(b)]]))
    return bool((gaps > LEAST["hex"]).any())


# Token classes of bytes: 0 white space, 1 delimiter, 2 line feed, 3 part of a word.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[32, *range(9, 14)]] = 0
_CLASS[list(_DELIMITERS)] = 1
_CLASS[10] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Character sets counted per token, as bits.
_SETS = np.zeros((5, 256), bool)
_SETS[0, 65:91] = True  # upper case
_SETS[1, 97:123] = True  # lower case
_SETS[2, 48:58] = True  # digits
_SETS[3, list(b"+/_.=-")] = True
_SETS[4] = _IS_HEX
_MIX = np.random.default_rng(7).integers(1, 2**63, 256).astype(np.uint64) | np.uint64(1)


@dataclass
class Tokens:
    """Tokens of many texts: byte ranges, the text, sequence and whole line of each, and its feature numbers."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    line: np.ndarray
    whole: np.ndarray
    features: np.ndarray


# Tables of features, one after the other: shapes (own, before, after), words (own, one and two
# before, one after), and the text's features. The last number is "none".
_WORDS = 1 << WORD_BITS
_AT = np.cumsum([0, SHAPES + 1, SHAPES + 1, SHAPES + 1, _WORDS + 1, _WORDS + 1, _WORDS + 1, _WORDS + 1, 16])
N_FEATURES = int(_AT[-1])
WORD_COLUMNS = slice(3, 7)


def tokenized(texts: list[bytes]) -> Tokens:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    kind = _CLASS[data]
    part = kind == 3
    token = part | (kind == 1)
    joins = np.zeros(len(data), bool)
    joins[1:] = part[1:] & part[:-1]
    start = np.flatnonzero(token & ~joins)
    last = np.ones(len(data), bool)
    last[:-1] = ~(part[:-1] & part[1:])
    end = np.flatnonzero(token & last) + 1
    text = np.searchsorted(np.cumsum(sizes), start, side="right")
    line = np.cumsum(kind == 2)[start]
    n = len(start)
    if not n:
        return Tokens(start, end, text, line, line, np.zeros((0, 8), np.int64))

    counts = []
    for chars in _SETS:
        total = np.concatenate([[0], np.cumsum(chars[data], dtype=np.int32)])
        counts.append(total[end] - total[start])
    upper, lower, digit, sign, hexa = counts
    length = (end - start).astype(np.int32)
    size = np.searchsorted([2, 4, 8, 12, 16, 24, 32], length, side="right")
    shape = (
        size * 32
        + (upper > 0) * 1
        + (lower > 0) * 2
        + (digit * 8 >= length) * 4
        + (sign > 0) * 8
        + (hexa == length) * 16
    )
    # A hash of the word in lower case: byte codes times a power that depends on the place in it.
    codes = _MIX[_LOWER[data]]
    place = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data)))) if start[0] == 0 else None
    if place is None:
        origin = np.zeros(len(data), np.int64)
        origin[start] = start
        place = np.arange(len(data)) - np.maximum.accumulate(origin)
    weights = (np.uint64(2) * place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    total = np.concatenate([[np.uint64(0)], np.cumsum(codes * weights, dtype=np.uint64)])
    word = ((total[end] - total[start]) >> np.uint64(64 - WORD_BITS)).astype(np.int64)

    first = np.ones(n, bool)
    first[1:] = line[1:] != line[:-1]

    def shifted(values: np.ndarray, by: int, none: int) -> np.ndarray:
        """The value ``by`` tokens before (or after, if negative) in the same line."""
        out = np.full(n, none, np.int64)
        if by > 0 and n > by:
            out[by:] = np.where(line[by:] == line[:-by], values[:-by], none)
        elif by < 0 and n > -by:
            out[:by] = np.where(line[:by] == line[-by:], values[-by:], none)
        return out

    chars = np.bincount(text, length, len(texts))
    digits = np.bincount(text, digit, len(texts)) / np.maximum(chars, 1)
    marks = np.bincount(text, length == 1, len(texts)) / np.maximum(np.bincount(text, minlength=len(texts)), 1)
    file = np.searchsorted([0.005, 0.02, 0.1], digits) * 4 + np.searchsorted([0.02, 0.1, 0.3], marks)
    features = np.stack(
        [
            shape,
            shifted(shape, 1, SHAPES),
            shifted(shape, -1, SHAPES),
            word,
            shifted(word, 1, _WORDS),
            shifted(word, 2, _WORDS),
            shifted(word, -1, _WORDS),
            file[text],
        ],
        axis=1,
    )
    begins = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    cut = first | ((np.arange(n) - begins) % SEQUENCE == 0)
    return Tokens(start, end, text, np.cumsum(cut), line, features + _AT[:-1])


@dataclass(frozen=True)
class Field:
    """Scores per feature and tag, and from tag to tag (row: from)."""

    weights: np.ndarray
    moves: np.ndarray


def _lines(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of each line with tokens."""
    first = np.flatnonzero(np.diff(line, prepend=-1))
    return first, np.diff(np.append(first, len(line)))


def _groups(length: np.ndarray) -> Iterator[np.ndarray]:
    """Lines of similar length together, so that few steps are spent on padding."""
    size = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
    for s in np.unique(size):
        yield np.flatnonzero(size == s)


def decode(field: Field, features: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The best tags of all lines, by Viterbi. A line cannot begin inside of a secret."""
    scores = np.zeros((len(features), 3), np.float32)
    for column in range(features.shape[1]):
        scores += field.weights[features[:, column]]
    tags = np.zeros(len(features), np.int8)
    first, length = _lines(line)
    opening = np.array([0, 0, NEVER], np.float32)
    moves = field.moves.astype(np.float32)
    for group in _groups(length):
        begin, size = first[group], length[group]
        steps = int(size.max())
        best = scores[begin] + opening
        came = np.zeros((steps, len(group), 3), np.int8)
        for t in range(1, steps):
            on = t < size
            ways = best[:, :, None] + moves
            came[t] = ways.argmax(1)
            best = np.where(on[:, None], ways.max(1) + scores[np.minimum(begin + t, len(scores) - 1)], best)
        tag = best.argmax(1)
        for t in range(steps - 1, -1, -1):
            on = t < size
            tags[(begin + t)[on]] = tag[on]
            if t:
                tag = np.where(on, came[t][np.arange(len(group)), tag], tag)
    return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def _marginals(scores: np.ndarray, moves: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each token's tag, and expected counts of moves, by forward and backward sums."""
    out, pairs = np.zeros_like(scores), np.zeros((3, 3))
    first, length = _lines(line)
    opening = np.array([0, 0, NEVER])
    for group in _groups(length):
        begin, size = first[group], length[group]
        steps = int(size.max())
        at = np.minimum(begin + np.arange(steps)[:, None], len(scores) - 1)
        on = np.arange(steps)[:, None] < size
        ahead = np.empty((steps, len(group), 3))
        ahead[0] = scores[begin] + opening
        for t in range(1, steps):
            ahead[t] = np.where(on[t][:, None], _log_sum(ahead[t - 1][:, :, None] + moves, 1) + scores[at[t]], ahead[t - 1])
        total = _log_sum(ahead[-1], 1)
        back = np.zeros((len(group), 3))
        for t in range(steps - 1, -1, -1):
            live = on[t]
            p = np.exp(ahead[t] + back - total[:, None])
            out[at[t][live]] = p[live]
            if t:
                into = scores[at[t]] + back
                joint = np.exp(ahead[t - 1][:, :, None] + moves + into[:, None, :] - total[:, None, None])
                pairs += joint[live].sum(0)
                back = np.where(live[:, None], _log_sum(moves + into[:, None, :], 2), back)
    return out, pairs


def made_secret(rng: np.random.Generator) -> str:
    """A random string of 12 to 48 characters, with at least one digit."""
    letters = ALPHABETS[rng.integers(len(ALPHABETS))]
    made = [letters[i] for i in rng.integers(0, len(letters), rng.integers(12, 49))]
    made[rng.integers(len(made))] = str(rng.integers(10))
    return "".join(made)


def planted(texts: list[str], rng: np.random.Generator, intros: tuple[str, ...] = INTROS) -> tuple[list[str], list[list[tuple[int, int]]]]:
    """Copies of the texts with phrases put between their words, and where the secrets among them stand."""
    out, spans = [], []
    for text in texts:
        places = [m.end() for m in re.finditer(r"[^\s] ", text)] or [0]
        cuts = sorted(rng.choice(places, min(PLANTS, len(places)), replace=False).tolist())
        made, found, last = [], [], 0
        for cut in cuts:
            made.append(text[last:cut])
            intro = intros[rng.integers(len(intros))]
            if rng.random() < 0.3:  # ordinary words after the same intro
                made.append(f"{intro} ")
            else:
                made.append(f"{intro} ".lstrip())
                begin = sum(map(len, made))
                made.append(made_secret(rng))
                found.append((begin, begin + len(made[-1])))
                made.append(" ")
            last = cut
        out.append("".join([*made, text[last:]]))
        spans.append(found)
    return out, spans


def train(texts: list[str], seed: int = 0, spans: list[list[tuple[int, int]]] | None = None) -> Field:
    """Fit by maximum likelihood with AdaGrad; labels are the values that the patterns find, and ``spans``."""
    moves = np.zeros((3, 3))
    moves[OUTSIDE, INSIDE] = NEVER
    weights = np.zeros((N_FEATURES, 3))
    weights[:, OUTSIDE] = 0.2
    if not texts:
        return Field(weights.astype(np.float32), moves)
    data = [t.encode("utf-8", "replace") for t in texts]
    tokens = tokenized(data)
    gold = np.zeros(len(tokens.start), np.int64)
    offsets = np.cumsum([0, *(len(d) + 1 for d in data)])
    for i, text in enumerate(texts):
        known = [(a, b) for *_, a, b in base_matches(text)] + (spans[i] if spans else [])
        for a, b in known:
            low = offsets[i] + len(text[:a].encode("utf-8", "replace"))
            high = offsets[i] + len(text[:b].encode("utf-8", "replace"))
            inside = np.flatnonzero((tokens.start < high) & (tokens.end > low))
            gold[inside] = INSIDE
            gold[inside[:1]] = BEGIN
    first = np.diff(tokens.line, prepend=-1) != 0
    fixed = (gold == INSIDE) & (first | np.append(True, gold[:-1] == OUTSIDE))
    gold[fixed] = BEGIN
    if not len(gold):
        return Field(weights.astype(np.float32), moves)

    same = ~first[1:]
    seen_moves = np.zeros((3, 3))
    np.add.at(seen_moves, (gold[:-1][same], gold[1:][same]), 1)
    goal = np.eye(3)[gold]
    rng = np.random.default_rng(seed)
    grown, grown_moves = np.full_like(weights, 1e-2), np.full_like(moves, 1e-2)
    allowed = moves > NEVER
    for _ in range(STEPS):
        features = tokens.features.copy()
        draw = rng.random(len(features))
        # "None" of each table: of words for some tokens, of all that stands around for others.
        features[draw < DROP, WORD_COLUMNS] = _AT[4:8] - 1
        features[draw < DROP / 2, 1:3] = _AT[2:4] - 1
        scores = weights[features].sum(1)
        chance, pairs = _marginals(scores, moves, tokens.line)
        error = goal - chance
        step = np.stack(
            [np.bincount(features.ravel(), np.repeat(error[:, k], features.shape[1]), N_FEATURES) for k in range(3)], 1
        ) - 0.02 * weights
        grown += step**2
        weights += RATE * step / np.sqrt(grown)
        step = np.where(allowed, seen_moves - pairs, 0)
        grown_moves += step**2
        moves = moves + RATE * step / np.sqrt(grown_moves)
    return Field(weights.astype(np.float32), moves)


def fit_field(docs: DataFrame) -> Field:
    """Train on a bounded choice of texts; see the module for the bounds."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    texts = texts.where(F.char_length("text").between(1, TRAIN_CHARS))
    hits = chosen_texts(texts.where(F.col("text").rlike(_LIKELY)), TRAIN_HITS, "hits")
    return train_planted(hits, chosen_texts(texts, TRAIN_OTHERS, "others"))


def train_planted(hits: list[str], others: list[str], seed: int = 0) -> Field:
    """Train on texts as they are, and on copies of a third of the texts at large with secrets planted."""
    made, spans = planted(others[::3], np.random.default_rng(seed))
    plain = [*hits, *others]
    return train([*plain, *made], seed, [[] for _ in plain] + spans)


def field_spans(texts: list[str], data: list[bytes], field: Field) -> list[list[tuple[int, int]]]:
    """Per text the tagged spans in code points."""
    tokens = tokenized(data)
    tags = decode(field, tokens.features, tokens.whole)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    offsets = np.cumsum([0, *(len(d) + 1 for d in data)])
    same = np.append(False, tokens.whole[1:] == tokens.whole[:-1])[: len(tags)]
    for i in np.flatnonzero(tags == BEGIN):
        j = i
        while j + 1 < len(tags) and tags[j + 1] == INSIDE and same[j + 1]:
            j += 1
        which = int(tokens.text[i])
        low, high = int(tokens.start[i] - offsets[which]), int(tokens.end[j] - offsets[which])
        start = len(data[which][:low].decode("utf-8", "replace"))
        out[which].append((start, start + len(data[which][low:high].decode("utf-8", "replace"))))
    return out


def spans_of(texts: list[str], field: Field) -> list[tuple]:
    """``n_assign, n_access, n_hex, base spans, all spans`` of each text."""
    data = [t.encode("utf-8", "replace") for t in texts]
    rows = []
    for text, raw, tagged in zip(texts, data, field_spans(texts, data, field), strict=True):
        base = base_matches(text, raw)
        extra = [
            (s, e)
            for s, e in tagged
            if _DIGIT.search(text, s, e) and not any(bs <= s and e <= be for bs, _, be, _, _ in base)
        ]
        spans = [(s, KINDS.index(k), e) for s, k, e, _, _ in base]
        text_of = lambda found: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
        kinds = [k for _, k, _, _, _ in base]
        rows.append(
            (
                *(kinds.count(k) for k in KINDS[:3]),
                hashlib.sha256(text_of(spans).encode()).hexdigest(),
                text_of([*spans, *((s, 3, e) for s, e in extra)]),
            )
        )
    return rows


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def with_secrets(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with the columns of ``SCHEMA``."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows, run, size = [], [], 0
            for text in texts:
                run.append(text)
                size += len(text)
                if size >= RUN_BYTES:
                    rows += spans_of(run, field)
                    run, size = [], 0
            if run:
                rows += spans_of(run, field)
            yield pd.DataFrame(rows, columns=names)

    scanned.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    found = F.pandas_udf(scanned, SCHEMA)(whole_text())
    kept = [c for c in docs.columns if c not in names]
    return docs.withColumn("__found", found).select(*kept, *[F.col(f"__found.{n}") for n in names])
