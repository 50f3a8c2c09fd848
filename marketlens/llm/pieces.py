"""SentencePiece encoding and decoding by Viterbi over shared prefixes.

A text is marked (a space before it stands for the word mark) and cut into marked words: spaces and
what follows up to the next space. No piece of the vocabulary crosses such a cut, so the best
segmentation of a text is the best one of each of its words. The distinct words of a batch are
sorted, which is the depth-first order of their trie; forward scores, back pointers and the pieces
still open at each depth stay on a stack, so a common prefix is scored once.

The best segmentation has the highest sum of piece scores; of equal ones, the one whose last piece
is longest, and so on backwards. Characters without a piece become their UTF-8 bytes. A word mark in
the text itself is such a character, so decoding gives back every text exactly.

Null texts count as empty; empty texts have no ids. Repeated rows are all returned, other columns are
ignored, and an empty table gives an empty result. Very long words cost time in proportion. Tokens
are read from a vocabulary file whose path is a parameter; nothing is trained.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import whole_text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Far under any score: a byte-encoded character is used only where no piece fits.
BYTES_SCORE = -1e12
# Texts are handled in runs of so many characters, and so many words are remembered.
RUN_CHARS = 1_000_000
MEMORY = 200_000

_WORDS = re.compile(r" ( *[^ ]*)")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with a space for the mark, their ids and scores, and the ids of the 256 bytes."""

    pieces: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows, of_byte = [], {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_byte[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            rows.append((piece.replace(MARK, " "), i, model.get_score(i)))
    pieces, ids, scores = zip(*rows, strict=True)
    return Vocabulary(pieces, ids, scores, tuple(of_byte[b] for b in range(256)))


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without the first of its spaces."""
    if not text:
        return []
    parts = text.split(" ")
    return _WORDS.findall(" " + text) if "" in parts else parts


class Encoder:
    """Encodes marked words; remembers a bounded number of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # A node: its children, and score and id of the piece that ends there (or None).
        self.root: list = [{}, None, -1]
        for piece, i, score in zip(vocabulary.pieces, vocabulary.ids, vocabulary.scores, strict=True):
            node = self.root
            for c in piece:
                node = node[0].setdefault(c, [{}, None, -1])
            node[1:] = score, i
        self.known: dict[str, bytes] = {}

    def learn(self, words: Iterable[str]) -> None:
        """Encode these words in one depth-first pass over their trie."""
        root, byte_ids = self.root, self.vocabulary.byte_ids
        score, start, piece, open_at = [0.0], [0], [-1], [[]]
        before = ""
        for bare in sorted(words):
            word = " " + bare
            depth = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                depth += 1
            del score[depth + 1 :], start[depth + 1 :], piece[depth + 1 :], open_at[depth + 1 :]
            for at in range(depth, len(word)):
                c = word[at]
                going, best, first, number = [], None, at, -1
                for begin, node in [*open_at[at], (at, root)]:
                    child = node[0].get(c)
                    if child is None:
                        continue
                    going.append((begin, child))
                    worth = child[1]
                    if worth is not None:
                        worth += score[begin]
                        if best is None or worth > best:
                            best, first, number = worth, begin, child[2]
                score.append(score[at] + BYTES_SCORE if best is None else best)
                start.append(first)
                piece.append(number)
                open_at.append(going)
            ids: list[int] = []
            at = len(word)
            while at:
                if piece[at] < 0:
                    ids.extend(byte_ids[b] for b in reversed(word[at - 1].encode()))
                else:
                    ids.append(piece[at])
                at = start[at]
            self.known[bare] = np.array(ids[::-1], np.int32).tobytes()
            before = word

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        rows = [marked_words(t) for t in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        self.learn(set().union(*rows) - self.known.keys())
        found = self.known.__getitem__
        return [np.frombuffer(b"".join(map(found, row)), np.int32) for row in rows]


def _runs(texts: Iterable[str]) -> Iterator[list[str]]:
    run, chars = [], 0
    for text in texts:
        run.append(text)
        chars += len(text)
        if chars >= RUN_CHARS:
            yield run
            run, chars = [], 0
    if run:
        yield run


def encode(text: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a text column without nulls."""

    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary)
        for texts in batches:
            yield pd.Series([ids for run in _runs(texts) for ids in encoder.encode(run)], dtype=object)

    encoded.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(encoded, "array<int>")(text)


def piece_bytes(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes of each id; none for ids that stand for no text."""
    table = [b""] * (max(*vocabulary.ids, *vocabulary.byte_ids) + 1)
    for piece, i in zip(vocabulary.pieces, vocabulary.ids, strict=True):
        table[i] = piece.encode()
    for b, i in enumerate(vocabulary.byte_ids):
        table[i] = bytes([b])
    return table


def text_of(ids: np.ndarray, table: list[bytes]) -> str:
    return b"".join(map(table.__getitem__, ids.tolist()))[1:].decode()


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of an id column."""

    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = piece_bytes(vocabulary)
        for rows in batches:
            yield pd.Series([text_of(row, table) for row in rows], dtype=object)

    decoded.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(decoded, "string")(ids)


def encoded_rows(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id, ids, n_ids, round_trip`` (whether decoding gives the text back) per document.

    Ids leave the task run by run, so a task holds the words and ids of one run at a time.
    """
    vocabulary = load_vocabulary(path)
    names = ["doc_id", "ids", "n_ids", "round_trip"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = Encoder(vocabulary), piece_bytes(vocabulary)
        for batch in batches:
            column = batch.column("text")
            sizes = pc.binary_length(column).to_numpy()
            run = np.cumsum(sizes) // RUN_CHARS
            starts = np.flatnonzero(np.diff(run, prepend=-1))
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(sizes)], strict=True):
                texts = column.slice(low, high - low).to_pylist()
                ids = encoder.encode(texts)
                same = [text_of(i, table) == t for i, t in zip(ids, texts, strict=True)]
                counts = np.array([len(i) for i in ids], np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                rows = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))
                doc_ids = batch.column("doc_id").slice(low, high - low)
                yield pa.RecordBatch.from_arrays([doc_ids, rows, pa.array(counts), pa.array(same)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, n_ids long, round_trip boolean"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(encoded, schema)
