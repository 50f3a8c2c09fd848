"""Pack documents into sequences of tokens whose sources keep their proportions.

Every source is a queue of documents, in the order in which the token table was written. Deficit
round-robin over the queues fills the windows, which are the sequences: a window credits each
source with its share of the window; sources with a credit of at least ``QUANTUM`` tokens send what
they have in whole quanta; what room is left goes to the largest credits. What a source got too
little or too much is carried to the next window. A source's target is its share of all tokens: the
only proportions that can hold from the first window to the last if all documents are packed.

The windows are dealt to shards, since no task can go through all of them. A source's quanta are
spread evenly over the line from 0 to 1, beginning at a hash of its name, and a shard is a stretch
of this line. So a shard gets every source in proportion, and what each source was sent before it
follows from the place on the line alone: credits are carried from shard to shard by arithmetic.
A shard goes on in the window that the one before leaves open. Only the last window of all is short.

A source of any size is spread over all shards, and a shard holds about ``SHARD`` tokens, with at
most one quantum more or less of each source. Documents are cut where a window, a quantum at a
shard's end, or a source's turn ends. Ids are made once and written.

A null text counts as empty: it has the end id alone. A null source is a source of its own. Every
row is a document of its own, whatever its id. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import stored, whole_text

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
END, WIDTH = 1, 2048
QUANTUM, SHARD = 64, 1 << 21
# Texts are encoded in runs of so many bytes, and so many parts are remembered.
RUN_BYTES, MEMORY = 4_000_000, 800_000
# A source's first quantum lies at a multiple of one in so many parts of a quantum.
PHASES = 1 << 20

# How the vocabulary's tokenizer cuts a text in lower case, for characters up to U+017F, of
# which no two compose. Its own words for the begin and end of a text stand for ids of their own.
_LETTER, _NUMBER, _BLANK = "a-zA-ZªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾", "\\x09-\\x0D \\x85\\xA0"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")
_OTHER = re.compile("[^\\x00-\u012f\u0131-\u017f]")
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


class Encoder:
    """Encodes texts part by part, and remembers the parts.

    Texts of Latin letters are cut as the tokenizer cuts them, others at white space only, across
    which the vocabulary has no piece, and the tokenizer does the rest.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = id_kind(len(vocabulary))
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def learn_parts(self, new: list[str]) -> None:
        """Many parts as one text; a part's last id is one that ends a word."""
        for low in range(0, len(new), 1_000):
            some = new[low : low + 1_000]
            (found,) = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, self.kind)
            ends = (np.flatnonzero(self.is_last[ids]) + 1) * ids.itemsize
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not mark where words end")
            data, begin = ids.tobytes(), 0
            for part, end in zip(some, ends.tolist(), strict=True):
                self.parts[part] = data[begin:end]
                begin = end

    def learn_words(self, new: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        for word, encoding in zip(new, found, strict=True):
            self.words[word] = np.array(encoding.ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end, as bytes."""
        rows = []
        for text in texts:
            plain = text.isascii() or not _OTHER.search(text)
            if plain and not any(s in text for s in _SPECIAL):
                rows.append((self.parts, _PARTS.findall(text.lower())))
            else:
                rows.append((self.words, _WORDS.findall(text)))
        for known, learn in ((self.parts, self.learn_parts), (self.words, self.learn_words)):
            if len(known) > MEMORY:
                known.clear()
            new = set().union(*(row for k, row in rows if k is known)) - known.keys()
            learn(sorted(new))
        end = np.array([END], self.kind).tobytes()
        return [b"".join(map(known.__getitem__, row)) + end for known, row in rows]


def id_kind(vocabulary: int) -> str:
    """The type that holds every id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def token_rows(docs: DataFrame, path: str = VOCABULARY, source: str = "source") -> DataFrame:
    """``doc_id, source, task, at, n, ids`` per document: its ids, and how many of its source the task had before it."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _encoder(path), TaskContext.get().partitionId()
        width = np.dtype(encoder.kind).itemsize
        before: dict[str, int] = defaultdict(int)
        for batch in batches:
            run = np.cumsum(pc.binary_length(batch.column("text")).to_numpy()) // RUN_BYTES
            starts = np.flatnonzero(np.diff(run, prepend=-1)).tolist()
            for low, high in zip(starts, [*starts[1:], len(run)], strict=True):
                part = batch.slice(low, high - low)
                ids = encoder.encode(part.column("text").to_pylist())
                sizes = [len(i) // width for i in ids]
                at = []
                for name, n in zip(part.column("source").to_pylist(), sizes, strict=True):
                    at.append(before[name])
                    before[name] += n
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), pa.array([task] * len(at), pa.int64())]
                    + [pa.array(at, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "source", "task", "at", "n", "ids"],
                )

    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", named.alias("source"), whole_text().alias("text")).mapInArrow(
        encoded, f"doc_id {kind}, source string, task long, at long, n long, ids binary"
    )


def queue_starts(tokens: DataFrame) -> DataFrame:
    """``source, task, base, total``: a source's tokens before a task, and all of them."""
    of = Window.partitionBy("source")
    before = of.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return (
        tokens.groupBy("source", "task")
        .agg(F.sum("n").alias("n"))
        .select(
            "source",
            "task",
            F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"),
            F.sum("n").over(of).alias("total"),
        )
    )


def phase_of(source: str) -> int:
    return zlib.crc32(source.encode()) % PHASES


def shard_cuts(first: int, n: int, total: int, phase: int, shards: int, quantum: int) -> list[tuple[int, int, int]]:
    """``shard, begin, end`` of the pieces of a source's tokens ``first`` to ``first + n``.

    Quantum b of B lies at ``(b + phase / PHASES) / B`` on the line, in whole numbers throughout.
    """
    line = -(-total // quantum) * PHASES

    def shard_of(token: int) -> int:
        return (token // quantum * PHASES + phase) * shards // line

    cuts, begin, end = [], first, first + n
    last = shard_of(end - 1)
    while begin < end:
        shard = shard_of(begin)
        until = end
        if shard < last:  # the first quantum of a later shard
            until = -((phase * shards - (shard + 1) * line) // (shards * PHASES)) * quantum
        cuts.append((shard, begin, min(until, end)))
        begin = min(until, end)
    return cuts


def shard_pieces(rows: DataFrame, shards: int, quantum: int, width: int, with_ids: bool) -> DataFrame:
    """The documents cut at the shards' ends: a piece's shard, its place in its source, and its ids if wanted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, at, n, total = (batch.column(c).to_pylist() for c in ("base", "at", "n", "total"))
            names = batch.column("source").to_pylist()
            phases = {name: phase_of(name) for name in set(names)}
            found, row, ids = [], [], []
            blobs = batch.column("ids").to_pylist() if with_ids else None
            for i, name in enumerate(names):
                first = base[i] + at[i]
                for shard, begin, end in shard_cuts(first, n[i], total[i], phases[name], shards, quantum):
                    found.append((shard, begin, begin - first, end - begin))
                    row.append(i)
                    if blobs:
                        ids.append(blobs[i][(begin - first) * width : (end - first) * width])
            columns = np.array(found, np.int64).reshape(-1, 4).T
            row = pa.array(row, pa.int64())
            arrays = [*map(pa.array, columns), *(batch.column(c).take(row) for c in ("source", "total"))]
            out = ["shard", "place", "start", "length", "source", "total"]
            if with_ids:
                arrays += [batch.column("doc_id").take(row), batch.column("n").take(row), pa.array(ids, pa.binary())]
                out += ["doc_id", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=out)

    schema = "shard long, place long, start long, length long, source string, total long"
    if with_ids:
        schema += f", doc_id {rows.schema['doc_id'].dataType.simpleString()}, doc_tokens long, ids binary"
    needed = ["source", "base", "at", "n", "total", *(["doc_id", "ids"] if with_ids else [])]
    return rows.select(*needed).mapInArrow(cut, schema)


def shard_starts(pieces: DataFrame) -> DataFrame:
    """``shard, begin``: how many tokens all shards before it hold; a sum over groups of shards first."""
    block = F.floor(F.col("shard") / 4096)
    sizes = pieces.groupBy("shard").agg(F.sum("length").alias("n")).withColumn("block", block)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.sum("n").over(before).alias("base"))
    within = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    begin = F.coalesce("base", zero) + F.coalesce(F.sum("n").over(within), zero)
    return sizes.join(blocks, "block").select("shard", begin.cast("long").alias("begin"))


def turns(queues: np.ndarray, credit: np.ndarray, share: np.ndarray, begin: int, window: int, quantum: int) -> Iterator[tuple[int, np.ndarray]]:
    """Deficit round-robin: per window, where it begins and how many tokens each source sends.

    ``credit`` is what each source has at ``begin``; it goes on from window to window.
    """
    left, credit = queues.copy(), credit.astype(float)
    while left.any():
        room = window - begin % window
        credit += room * share
        sent = np.minimum(left, np.maximum(credit, 0).astype(np.int64) // quantum * quantum)
        if sent.sum() > room:
            order = np.argsort(-credit, kind="stable")
            until = np.minimum(np.cumsum(sent[order]), room)
            sent[order] = np.diff(until, prepend=0)
        free = min(room, int(left.sum())) - int(sent.sum())
        while free:
            # The credit not yet used; a source without tokens is none to choose.
            most = int(np.argmax(np.where(left > sent, credit - sent, -np.inf)))
            more = min(free, quantum, int(left[most] - sent[most]))
            sent[most] += more
            free -= more
        left -= sent
        credit -= sent
        yield begin, sent
        begin += int(sent.sum())


def turns_of(queues: np.ndarray, credit: np.ndarray, share: np.ndarray, begin: int, window: int, quantum: int) -> tuple[np.ndarray, np.ndarray]:
    """By window and source: how many tokens are sent, and where in the sequences they begin.

    The source that goes first changes from window to window.
    """
    begins, sent = zip(*turns(queues, credit, share, begin, window, quantum), strict=True)
    sent, k = np.array(sent), len(queues)
    order = (np.arange(k) + np.arange(len(sent))[:, None]) % k
    turned = np.take_along_axis(sent, order, axis=1)
    place = np.empty_like(sent)
    np.put_along_axis(place, order, np.cumsum(turned, axis=1) - turned, axis=1)
    return sent, place + np.array(begins)[:, None]


def pieces_of(length: np.ndarray, first: np.ndarray, sent: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, begin in the row, length and place of every piece: what one window takes of one row.

    Rows stand in the order of their queues, of which ``first`` are the first rows.
    """
    found = []
    for s, (a, b) in enumerate(zip(first, [*first[1:], len(length)], strict=True)):
        rows, takes = (np.concatenate([[0], np.cumsum(x)]) for x in (length[a:b], sent[:, s]))
        begin = np.union1d(rows, takes)
        size, begin = np.diff(begin), begin[:-1]
        # Of takes that begin at the same token all but the last are empty.
        row = np.searchsorted(rows, begin, side="right") - 1
        turn = np.searchsorted(takes, begin, side="right") - 1
        found.append((a + row, begin - rows[row], size, place[turn, s] + begin - takes[turn]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def packed(
    docs: DataFrame,
    path: str = VOCABULARY,
    source: str = "source",
    window: int = WIDTH,
    quantum: int = QUANTUM,
    shard_tokens: int = SHARD,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source``.

    ``with_ids`` adds the piece's ids as an array.
    """
    kind = Encoder(path).kind
    width = np.dtype(kind).itemsize
    tokens = stored(token_rows(docs, path, source), "tokens")
    starts = stored(queue_starts(tokens), "queues")
    all_tokens = starts.select("source", "total").distinct().agg(F.sum("total")).first()[0] or 0
    shards = max(1, round(all_tokens / shard_tokens))
    # The written list of queues is small beside the tokens; Catalyst sends it around if it is small enough.
    rows = tokens.join(starts, ["source", "task"])
    begins = stored(shard_starts(shard_pieces(rows, shards, quantum, width, False)), "shards")
    pieces = shard_pieces(rows, shards, quantum, width, True).join(begins, "shard")

    def packed_shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["source", "place"], ignore_index=True)
        length = part["length"].to_numpy()
        _, first = np.unique(part["source"].to_numpy(), return_index=True)
        queues = np.add.reduceat(length, first)
        share = part["total"].to_numpy()[first] / all_tokens
        begin = int(part["begin"].iloc[0])
        credit = share * begin - part["place"].to_numpy()[first]
        row, low, size, position = pieces_of(length, first, *turns_of(queues, credit, share, begin, window, quantum))
        before = np.cumsum(length) - length
        ids = memoryview(np.frombuffer(b"".join(part["ids"]), kind).astype("<u4")).cast("B")
        start = ((before[row] + low) * 4).tolist()
        cut = [ids[a : a + n] for a, n in zip(start, (size * 4).tolist(), strict=True)]
        names = part["source"].str.slice(1).where(part["source"] != "", None)
        out = pd.DataFrame(
            {
                "doc_id": part["doc_id"].take(row).reset_index(drop=True),
                "start": part["start"].to_numpy()[row] + low,
                "length": size,
                "ids_crc32": list(map(zlib.crc32, cut)),
                "doc_tokens": part["doc_tokens"].to_numpy()[row],
                "sequence_id": position // window,
                "offset": position % window,
                "source": names.take(row).reset_index(drop=True),
            }
        )
        if with_ids:
            out["ids"] = [np.frombuffer(c, "<u4") for c in cut]
        return out

    schema = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}" + (", ids array<long>" if with_ids else "")
    return pieces.groupBy("shard").applyInPandas(packed_shard, schema)


def sequences(pieces: DataFrame, window: int = WIDTH, pad: int = 0) -> DataFrame:
    """``sequence_id, length, ids`` from pieces with ids, padded to the window except at a power of two."""
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
    length = F.size("ids")
    short = F.array_repeat(F.lit(pad).cast("long"), F.lit(window) - length)
    padded = F.when(F.bit_count(length) == 1, F.col("ids")).otherwise(F.concat("ids", short))
    return pieces.groupBy("sequence_id").agg(ids.alias("ids")).select("sequence_id", length.cast("long").alias("length"), padded.alias("ids"))
