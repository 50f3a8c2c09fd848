"""Score texts with language models learned from the corpus itself.

Base model: every word and the end of a text has the probability ``(c + 1) / (N + V + 1)``, from the
counts of all training documents. Attention model: subword ids of a public tokenizer. An id's class
is predicted from the ids before it by attention (``attention.py``). The id within its class is
predicted from the id before it:

    (c(before, id) + PRIOR * share) / (c(before, class) + PRIOR)

with the counts of id pairs, and of classes after an id, in all training documents, and the id's
share of its class. So what is known of a context grows with the corpus. The attention weights are
fitted to every id and end of all training documents: each task goes through its own texts once, and
the tasks' weights are averaged, an id's row by how often each task met the id. All tasks begin with the
same weights; only these starting values come from few texts, a stretch of at most ``TRAIN_CHARS`` characters
of each of ``TRAIN_ROWS`` texts chosen by a hash of the id. As with any such descent, another layout of the
table gives slightly other weights.

Texts are split into subword ids once; all later steps read the ids stored beside the text.

Words are counted by 64-bit hash, id pairs by number. The most frequent words, at most ``HEAD``, are looked up in the
task, and pairs alike; all others of a document go by a shuffle to their counts. Those that make up at least one
``HEAD``-th of the corpus always fit, further ones as far as a count of the counts shows room. So no frequent word or pair is a large group, and nothing
is sent to all tasks that grows with the corpus: counts of classes after an id are as many as the
vocabulary has ids, times the classes.

Null and empty texts are their end alone. Every row is a document of its own, whatever its id; other
columns are ignored. Without training documents all counts are zero. An empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from marketlens.llm import attention, wordhash
from marketlens.llm.common import chosen_texts, id_crc, stored, whole_text

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
HEAD = 1_000_000
TRAIN_ROWS, TRAIN_CHARS = 1_000, 3_000
COUNT_WORDS = 4_000_000
# What an id's plain share of its class weighs against the pairs counted, in pairs.
PRIOR = 4.0
# Columns of a text's subword ids and of its size in bytes.
IDS, SIZE = "subword_ids", "text_bytes"
WORD_COUNT, ID_COUNT, DOC_COUNT, PAIR_COUNT = 0, 1, 2, 3
# What a row of a document says, in place of a count of a word.
LENGTH, KNOWN, LOGS, SCORE, DOC_ID = -1, -2, -3, -4, -5

# Fixed value: how the byte-level tokenizers cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same without looking ahead, which takes longer: right where only the last of several blanks stands before a word.
_PLAIN_PATTERN = PATTERN.replace(r"\s+(?!\S)|", "")
_BLANK = "\\x09-\\x0D \\x85\\xA0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANKS, _LAST_BLANK = re.compile(f"[{_BLANK}]{{2}}"), re.compile(f"(?<=[{_BLANK}])(?=[{_BLANK}][^{_BLANK}])")


def held_out() -> Column:
    return F.pmod(id_crc(), F.lit(7)) == 2


def tokenizer(ranks: bytes, pattern: str = PATTERN):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def id_bytes(ranks: bytes) -> Callable[[str], bytes]:
    """A function that gives a text's subword ids as numbers in bytes, as ``tokenizer`` splits it.

    Of several blanks before a word, PATTERN takes all but the last as one piece. The text is cut there first.
    """
    encoding = tokenizer(ranks, _PLAIN_PATTERN)
    code = np.dtype(id_type(encoding.n_vocab)).char

    def encode(text: str) -> bytes:
        parts = _LAST_BLANK.split(text) if _BLANKS.search(text) else [text]
        return b"".join(array(code, encoding.encode_ordinary(part)).tobytes() for part in parts)

    return encode


def with_ids(docs: DataFrame, ranks: bytes) -> DataFrame:
    """``docs`` (``text`` and others) with each text's subword ids, as numbers in bytes, and its size in bytes.

    Documents that have both already are given back.
    """
    if {IDS, SIZE} <= set(docs.columns):
        return docs

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_bytes(ranks)
        for batch in batches:
            ids = [encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary())], names=[*batch.schema.names, IDS]
            )

    rows = docs.select(*[F.col(c) for c in docs.columns if c != "text"], whole_text().alias("text"))
    rows = rows.withColumn(SIZE, F.octet_length("text"))
    return rows.mapInArrow(encoded, StructType([*rows.schema.fields, StructField(IDS, BinaryType())]))


def id_type(n_vocab: int) -> type:
    return np.uint16 if n_vocab <= 1 << 16 else np.uint32


def _ids(batch: pa.RecordBatch, n_vocab: int) -> list[np.ndarray]:
    return [np.frombuffer(x, id_type(n_vocab)).astype(np.int64) for x in batch.column(IDS).to_pylist()]


def _raw(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def corpus_counts(docs: DataFrame, ranks: bytes) -> DataFrame:
    """``kind, key, n``: words by hash, subword ids and their pairs, and documents, over the training documents."""

    n_vocab = tokenizer(ranks).n_vocab

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.zeros(n_vocab + 1, np.int64)
        held: dict[int, list[np.ndarray]] = {WORD_COUNT: [], PAIR_COUNT: []}
        size = dict.fromkeys(held, 0)
        n_docs = 0

        def taken(kind: int) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held[kind]), return_counts=True)
            held[kind], size[kind] = [], 0
            return _counts(kind, keys.view(np.int64), n)

        for batch in batches:
            raw, encoded = _raw(batch), _ids(batch, n_vocab)
            n_docs += len(raw)
            for low, high in wordhash.runs_of(raw):
                hashes, _ = wordhash.word_hashes(raw[low:high])
                before, goal = pairs_of(encoded[low:high], n_vocab)
                ids[:-1] += np.bincount(goal, minlength=len(ids))[:-1]
                for kind, keys in ((WORD_COUNT, hashes), (PAIR_COUNT, before * len(ids) + goal)):
                    held[kind].append(keys)
                    size[kind] += len(keys)
                    if size[kind] >= COUNT_WORDS:
                        yield taken(kind)
        for kind in held:
            if size[kind]:
                yield taken(kind)
        some = np.flatnonzero(ids)
        yield _counts(ID_COUNT, some, ids[some])
        yield _counts(DOC_COUNT, np.zeros(1, np.int64), np.array([n_docs]))

    rows = with_ids(docs, ranks).where(~held_out()).select("text", IDS)
    return (
        rows.mapInArrow(counted, "kind int, key long, n long")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"))
    )


def pairs_of(encoded: list[np.ndarray], edge: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id of the texts, and each end, with the one before it; an edge stands before the first."""
    ends = np.array([edge])
    chain = np.concatenate([ends, *(x for ids in encoded for x in (ids, ends))])
    return chain[:-1], chain[1:]


def after_counts(counts: DataFrame, of_class: np.ndarray) -> np.ndarray:
    """By id and class: how often one of the class follows the id."""
    size = len(of_class)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            where, which = np.unique(key // size * attention.CLASSES + of_class[key % size], return_inverse=True)
            yield _counts(PAIR_COUNT, where, np.bincount(which, n, len(where)))

    pairs = counts.where(F.col("kind") == PAIR_COUNT).select("key", "n")
    found = pairs.mapInArrow(summed, "kind int, key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    after = np.zeros(size * attention.CLASSES, np.float32)
    after[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return after.reshape(size, attention.CLASSES)


def least_common(sizes: list[tuple[int, int]], total: int) -> int:
    """From which count on keys are common, so that at most ``HEAD`` are; ``total`` is the sum of all counts.

    ``sizes``: the least count of each range of counts, and how many keys are in it.
    """
    least, taken = max(2, -(-total // HEAD)), 0
    for n, keys in sorted(sizes, reverse=True):
        taken += keys
        if taken > HEAD:
            break
        least = min(least, n)
    return least


def _head(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys counted at least ``least`` times, in order, and their counts: at most ``HEAD``."""
    common = counts.where(F.col("n") >= least).select("key", "n").toArrow()
    keys = common.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], common.column("n").to_numpy()[order].astype(float)


def _looked_up(keys: np.ndarray, head: np.ndarray, head_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the keys (signed) the head has, and the counts of these."""
    if not len(head):
        return np.zeros(len(keys), bool), np.zeros(0)
    place = np.minimum(np.searchsorted(head, keys.view(np.uint64)), len(head) - 1)
    common = head[place] == keys.view(np.uint64)
    return common, head_counts[place[common]]


def _counts(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n.astype(np.int64))],
        names=["kind", "key", "n"],
    )


def train_model(docs: DataFrame, id_counts: np.ndarray, ranks: bytes) -> attention.Model:
    """Fit the attention weights to all training documents."""
    return whole_pass(docs, start_model(docs, id_counts, ranks), ranks)


def start_model(docs: DataFrame, id_counts: np.ndarray, ranks: bytes) -> attention.Model:
    """The weights with which every task begins; see the module."""
    length = F.char_length("text")
    start = F.pmod(F.xxhash64("doc_id", F.lit("at")), F.greatest(F.lit(1), length - TRAIN_CHARS + 1)) + 1
    ends = F.concat((start == 1).cast("int"), (start + TRAIN_CHARS > length).cast("int"))
    stretch = F.substring("text", start.cast("int"), F.lit(TRAIN_CHARS))
    texts = docs.where(~held_out()).select("doc_id", whole_text().alias("text"))
    # The first two characters say whether the stretch begins and ends its text.
    marked = chosen_texts(texts.select("doc_id", F.concat(ends, stretch).alias("text")), TRAIN_ROWS, "lm")
    encoding = tokenizer(ranks)
    encoded = [np.array(encoding.encode_ordinary(t[2:]), np.int64) for t in marked]
    return attention.train(
        encoded, id_counts, edge=encoding.n_vocab, ends=[(t[0] == "1", t[1] == "1") for t in marked]
    )


def whole_pass(docs: DataFrame, start: attention.Model, ranks: bytes) -> attention.Model:
    """The averaged weights of tasks that each fit ``start`` to all their training documents.

    What meets in one place is a row of weights per id of the vocabulary, whatever the corpus.
    """
    names = [f"w{j}" for j in range(attention.WIDTH)]

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = attention.WholePass(start)
        for batch in batches:
            encoded = _ids(batch, start.edge)
            for low, high in wordhash.runs_of_sizes(batch.column(SIZE).to_pylist()):
                local.take(encoded[low:high])
        rows = attention.rows_of(local.weights)
        n = np.concatenate([local.visits, np.full(len(rows) - len(local.visits), local.n)])
        some = np.flatnonzero(n)
        columns = (rows[some] * n[some, None].astype(np.float64)).T
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, n[some], *columns)], names=["key", "n", *names])

    rows = with_ids(docs, ranks).where(~held_out()).select(SIZE, IDS)
    sums = (
        rows.mapInArrow(fitted, "key long, n long, " + ", ".join(f"{w} double" for w in names))
        .groupBy("key")
        .agg(F.sum("n").alias("n"), *[F.sum(w).alias(w) for w in names])
        .toArrow()
    )
    rows = attention.rows_of(attention.weights_of(start)).astype(np.float64)
    found = np.stack([sums.column(w).to_numpy() for w in names], axis=1)
    rows[sums.column("key").to_numpy()] = found / sums.column("n").to_numpy()[:, None]
    return attention.with_rows(start, rows)


def _scored(batches: Iterator[pa.RecordBatch], model, words, pairs, after) -> Iterator[pa.RecordBatch]:
    """Rows ``word, row, n, value``: rare words and pairs of a document with their number, and its facts.

    ``value`` is zero for a word, and for a pair what is added to its count. ``words`` and ``pairs``
    are the heads of both.
    """
    prior = PRIOR * 10.0 ** model.share.astype(np.float64)
    for batch in batches:
        raw, ids_of = _raw(batch), _ids(batch, model.edge)
        row = batch.column("row").to_numpy()
        ids = batch.column("doc_id")
        yield _facts(ids, row, DOC_ID, np.zeros(len(row)))
        for low, high in wordhash.runs_of(raw):
            own, n_texts = row[low:high], high - low
            hashes, counts = wordhash.word_hashes(raw[low:high])
            which = np.repeat(np.arange(n_texts), counts)
            # In order of the hash, so look-ups walk the table and equal words stand together.
            order = np.argsort(hashes, kind="stable")
            hashes, which = hashes[order].view(np.int64), which[order]
            common, c = _looked_up(hashes, *words)
            logs = np.bincount(which[common], np.log10(c + 1), n_texts)
            known = np.bincount(which[common], minlength=n_texts)
            rare, owner = hashes[~common], which[~common]
            if len(rare):
                turn = np.lexsort((owner, rare))
                rare, owner = rare[turn], owner[turn]
                new = (np.diff(rare, prepend=rare[0]) != 0) | (np.diff(owner, prepend=-1) != 0)
                start = np.flatnonzero(new)
                times = np.diff(np.append(start, len(rare)))
                yield _facts(rare[start], own[owner[start]], times, np.zeros(len(start)))
            encoded = ids_of[low:high]
            score = attention.log10_scores(model, encoded, shares=False)
            before, goal = pairs_of(encoded, model.edge)
            which = np.repeat(np.arange(n_texts), [len(e) + 1 for e in encoded])
            # A class of one id leaves nothing to predict. An edge leads to the next text's first id.
            kinds = model.of_class[goal]
            open_ = kinds >= attention.SINGLE
            before, goal, kinds, which = before[open_], goal[open_], kinds[open_], which[open_]
            score -= np.bincount(which, np.log10(after[before, kinds] + PRIOR), n_texts)
            # Both numbers are below 2**32, so they fill 64 bits: without a sign.
            both = (before * len(prior) + goal).astype(np.uint64) << np.uint64(32) | which.astype(np.uint64)
            both, times = np.unique(both, return_counts=True)
            pair, owner = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
            added = prior[pair % len(prior)]
            common, c = _looked_up(pair, *pairs)
            score += np.bincount(owner[common], times[common] * np.log10(c + added[common]), n_texts)
            yield _facts(pair[~common], own[owner[~common]], times[~common], added[~common])
            key = own * 0x9E3779B1
            for kind, value in ((LENGTH, counts + 1), (KNOWN, known), (LOGS, logs), (SCORE, score)):
                yield _facts(key, own, kind, value)


def _facts(word, row: np.ndarray, n, value: np.ndarray) -> pa.RecordBatch:
    n = np.full(len(row), n) if np.isscalar(n) else n
    return pa.RecordBatch.from_arrays(
        [
            word if isinstance(word, pa.Array) else pa.array(word, pa.int64()),
            pa.array(row, pa.int64()),
            pa.array(n, pa.int32()),
            pa.array(np.asarray(value, np.float64)),
        ],
        names=["word", "row", "n", "value"],
    )


def scored_rows(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document."""
    with open(path, "rb") as file:
        ranks = file.read()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    texts = stored(with_ids(texts, ranks), "ids", compression="zstd")
    counts = stored(corpus_counts(texts, ranks), "counts")
    # Counts by ranges of an eighth of a power of two: at most some hundred of each kind.
    ranges = counts.where(F.col("kind") != ID_COUNT).groupBy("kind", F.floor(8 * F.log2("n")).alias("range"))
    ranges = ranges.agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.min("n").alias("least")).collect()
    totals, sizes = {}, {WORD_COUNT: [], PAIR_COUNT: [], DOC_COUNT: []}
    for r in ranges:
        n, keys = totals.get(r["kind"], (0, 0))
        totals[r["kind"]] = n + r["n"], keys + r["keys"]
        sizes[r["kind"]].append((r["least"], r["keys"]))
    n_docs = totals.get(DOC_COUNT, (0, 0))[0]
    n_words, n_distinct = totals.get(WORD_COUNT, (0, 0))
    train_tokens, distinct = n_words + n_docs, n_distinct + (n_docs > 0)

    id_counts = np.zeros(tokenizer(ranks).n_vocab + 1)
    for r in counts.where(F.col("kind") == ID_COUNT).collect():  # as many as the vocabulary has
        id_counts[r["key"]] = r["n"]
    id_counts[-1] = n_docs
    model = train_model(texts, id_counts, ranks)

    after = after_counts(counts, model.of_class)
    kinds = {kind: least_common(sizes[kind], totals.get(kind, (0, 0))[0]) for kind in (WORD_COUNT, PAIR_COUNT)}
    words, pairs = (_head(counts.where(F.col("kind") == kind), least) for kind, least in kinds.items())
    least = F.when(F.col("kind") == PAIR_COUNT, kinds[PAIR_COUNT]).otherwise(kinds[WORD_COUNT])
    rest = counts.where(F.col("kind").isin(*kinds)).where(F.col("n") < least)
    rest = rest.select(F.col("key").alias("word"), (F.col("kind") == PAIR_COUNT).alias("pair"), F.col("n").alias("c"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scored(batches, model, words, pairs, after)

    rows = (
        texts.select("doc_id", "text", "row", IDS)
        .mapInArrow(scored, "word long, row long, n int, value double")
        .withColumn("pair", F.col("value") > 0)
        .join(rest, ["word", "pair"], "left")
    )
    c = F.coalesce("c", F.lit(0))
    times = F.when((F.col("n") > 0) & (F.col("value") == 0), F.col("n"))
    pair_times = F.when((F.col("n") > 0) & (F.col("value") > 0), F.col("n"))
    fact = lambda kind: F.max(F.when(F.col("n") == kind, F.col("value")))
    per_doc = rows.groupBy("row").agg(
        F.max(F.when(F.col("n") == DOC_ID, F.col("word"))).alias("doc_id"),
        fact(LENGTH).cast("long").alias("n_tokens"),
        (fact(KNOWN) + F.coalesce(F.sum(F.when(c > 0, times)), F.lit(0)) + int(n_docs > 0)).cast("long").alias("n_known"),
        (fact(LOGS) + F.coalesce(F.sum(times * F.log10(c + 1.0)), F.lit(0.0))).alias("logs"),
        (fact(SCORE) + F.coalesce(F.sum(pair_times * F.log10(c + F.col("value"))), F.lit(0.0))).alias("score"),
    )
    end = float(np.log10(n_docs + 1))
    each = float(np.log10(train_tokens + distinct + 1))
    return per_doc.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + end - F.col("n_tokens") * each).alias("base_score"),
        "score",
    )
