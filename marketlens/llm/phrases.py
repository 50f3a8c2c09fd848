"""Mine collocations from a weighted de Bruijn graph of the corpus.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words.
The longest grams, of ``LONGEST`` words, are the edges of the graph; an edge leads from the node of
its first words to the node of its last words, and weighs as often as it occurs. Every place of a
piece begins one gram: an edge, or near the piece's end what is left, a shorter gram. So counts of
shorter phrases need no counting of their own. A phrase occurs as often as the edges that leave its
node weigh together, plus the ends of pieces that stand there; shorter ones follow from these alike.

A pair of neighbours that occurs too seldom stands in no candidate, so pieces are cut there as well.
Pairs are counted first, and a bitmap of fixed size tells the frequent ones, up to a false hit, which
costs work and changes nothing. A larger corpus may want a larger bitmap; a full one only saves
nothing. Frequent edges are then compacted: where all that enters a node comes by one edge and
leaves by one edge, both are one path. Inner nodes of a path are as frequent as the path, so they
are covered by it, and only its two ends are compared with what it covers.

Tasks add up their grams before the shuffle, and all sums combine on the map side, so a frequent
word, phrase or language is no group of a task. Grams are compared by all their bytes.

Null texts count as empty, a null language as ``und``; ids are not used, repeated rows count each.
Other columns are ignored. Empty texts and tables give no phrases. A text is held whole in a task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import stored, whole_text

LONGEST, LEAST, TOP = 4, 30, 2000
SCALE, COVER = 2_000_000, 80
# Bits of the bitmap of pairs: 2 MB.
SLOTS = 1 << 24
# Distinct grams that a task holds before it hands them on, and grams added up at a time.
HELD, STEP = 250_000, 20_000
# Edges of a path that are one group; longer paths are given in parts.
PART = 1000

_CUT = re.compile(rb"[.,;:!?\n-\r]")
_join = b" ".join

Grams = Callable[[list[bytes], int], list[bytes]]


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of each piece. Bytes lower only A-Z, and split at white space of one byte only."""
    for piece in _CUT.split(text.lower()):
        words = piece.split()
        if words:
            yield words


def pairs_of(words: list[bytes], seed: int) -> list[bytes]:
    return list(map(_join, zip(words, words[1:], strict=False)))


def edges_of(frequent: bytes, longest: int) -> Grams:
    """One gram from every place of a piece, as long as its pairs are frequent."""
    mask = len(frequent) - 1

    def grams(words: list[bytes], seed: int) -> list[bytes]:
        found, run = [words[-1]], 0
        for i in range(len(words) - 2, -1, -1):
            pair = words[i] + b" " + words[i + 1]
            if frequent[zlib.crc32(pair, seed) & mask]:
                run = min(run + 1, longest - 1)
                found.append(pair if run == 1 else _join(words[i : i + run + 1]))
            else:
                run = 0
                found.append(words[i])
        return found

    return grams


def counted(docs: DataFrame, make: Callable[[], Grams]) -> DataFrame:
    """``lang, gram, n`` of the grams of ``lang, text``."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = make()
        held: dict[str, Counter] = defaultdict(Counter)

        def taken() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                gram = pa.array(found.keys(), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * len(found)), gram, pa.array(found.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                seed, some = zlib.crc32(lang.encode()), []
                for words in pieces_of(text):
                    some += grams(words, seed)
                    if len(some) >= STEP:
                        held[lang].update(some)
                        some = []
                        if sum(map(len, held.values())) >= HELD:
                            yield from taken()
                if some:
                    held[lang].update(some)
                if sum(map(len, held.values())) >= HELD:
                    yield from taken()
        yield from taken()

    return docs.mapInArrow(counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def frequent_pairs(docs: DataFrame, least: int, slots: int = SLOTS) -> bytes:
    """A byte per slot that says whether a frequent pair falls there; a row per 32 slots comes to the driver."""
    slot = F.crc32(F.concat("lang", "gram").cast("binary")).bitwiseAND(slots - 1)
    pairs = counted(docs, lambda: pairs_of).where(F.col("n") >= least).select(slot.alias("slot"))
    words = (
        pairs.groupBy(F.shiftright("slot", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(max(1, slots // 32), "<u4")
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype("<u4")
    return np.packbits(np.unpackbits(bits.view(np.uint8), bitorder="little")).tobytes()


def graph(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, slots: int = SLOTS) -> DataFrame:
    """``lang, gram, words, n``: the edges, and the shorter grams that end a piece."""
    packed = frequent_pairs(docs, least, slots)

    def make() -> Grams:
        return edges_of(np.unpackbits(np.frombuffer(packed, np.uint8))[:slots].tobytes(), longest)

    return counted(docs, make).withColumn("words", n_words("gram"))


def n_words(phrase: str) -> Column:
    return F.char_length(phrase) - F.char_length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def first_words(phrase: str, n: int | Column) -> Column:
    return F.substring_index(phrase, " ", n) if isinstance(n, int) else F.call_function("substring_index", F.col(phrase), F.lit(" "), n)


def last_words(phrase: str, n: int | Column) -> Column:
    return first_words(phrase, -n)


def flows(edges: DataFrame, longest: int = LONGEST) -> list[DataFrame]:
    """``lang, phrase, f`` of the phrases of 1, 2, ... words, the shorter from the longer."""

    def of(words: int) -> DataFrame:
        return edges.where(F.col("words") == words).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("f"))

    levels = [of(longest)]
    for words in range(longest - 1, 0, -1):
        out = levels[0].select("lang", first_words("phrase", words).alias("phrase"), "f")
        levels.insert(0, out.unionByName(of(words)).groupBy("lang", "phrase").agg(F.sum("f").alias("f")))
    return levels


def paths(edges: DataFrame, nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, path, n``: the edges ``lang, phrase, f``, those of a unary path joined to one phrase.

    A node is unary if an edge that enters it and one that leaves it both weigh as much as it
    occurs. Each edge learns its path's first edge by doubling: it asks the edge it points at where
    that one points. Rounds are as many as the logarithm of the longest path, and each is written.
    Edges of a ring have no first one; they stay single.
    """
    size = longest - 1
    at = nodes.select(F.col("lang").alias("l"), F.col("phrase").alias("node"), F.col("f").alias("flow"))

    def full(end: Column, name: str) -> DataFrame:
        same = (F.col("lang") == F.col("l")) & (F.col("end") == F.col("node")) & (F.col("f") == F.col("flow"))
        return edges.withColumn("end", end).join(at, same).select("lang", "node", F.col("phrase").alias(name))

    links = full(last_words("phrase", size), "before").join(full(first_words("phrase", size), "phrase"), ["lang", "node"])
    # In a phrase of one word over and over, an edge would lead to itself.
    links = links.where("before <> phrase").select("lang", "phrase", "before")
    state = stored(
        edges.join(links, ["lang", "phrase"], "left").select(
            "lang", "phrase", "f", F.coalesce("before", "phrase").alias("up"), F.col("before").isNotNull().cast("long").alias("steps")
        ),
        "paths",
    )
    unsettled = -1
    while True:
        there = state.select("lang", F.col("phrase").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("more"))
        after = stored(
            state.join(there, ["lang", "up"]).select(
                "lang", "phrase", "f", F.col("up2").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved")
            ),
            "paths",
        )
        left = after.where("moved").count()
        state = after
        # While a path is unsettled, some edge settles in every round; what is left then are rings.
        if left in (0, unsettled):
            break
        unsettled = left
    ring = F.col("moved")
    first = F.when(ring, F.col("phrase")).otherwise(F.col("up"))
    place = F.when(ring, F.lit(0).cast("long")).otherwise(F.col("steps"))
    parts = (
        state.withColumns({"up": first, "steps": place})
        .groupBy("lang", "up", F.floor(F.col("steps") / PART).alias("part"))
        .agg(F.first("f").alias("n"), F.array_sort(F.collect_list(F.struct("steps", "phrase"))).alias("edges"))
    )
    grams = F.transform("edges", lambda e: e["phrase"])
    ends = F.transform(F.slice(grams, F.lit(2), F.size("edges")), lambda p: F.substring_index(p, " ", -1))
    return parts.select("lang", F.array_join(F.concat(F.slice(grams, 1, 1), ends), " ").alias("path"), "n")


def unfolded(found: DataFrame, size: int, inner: bool = False) -> DataFrame:
    """``lang, phrase, f``: the phrases of ``size`` words in paths; with ``inner``, without both ends."""
    words, edge = F.split("path", " "), 1 if inner else 0
    last = F.size("words") - size - edge
    places = F.when(last >= edge, F.sequence(F.lit(edge), last))
    return (
        found.withColumn("words", words)
        .withColumn("at", F.explode(places))
        .select("lang", F.array_join(F.slice("words", F.col("at") + 1, F.lit(size)), " ").alias("phrase"), F.col("n").alias("f"))
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, slots: int = SLOTS) -> DataFrame:
    """Per language the best phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))
    edges = stored(graph(texts, least, longest, slots), "edges")
    totals = edges.groupBy("lang").agg(F.sum("n").alias("n"))
    *shorter, whole = [level.where(F.col("f") >= least) for level in flows(edges, longest)]
    counts = stored(reduce(DataFrame.unionByName, [*shorter, whole]).withColumn("words", n_words("phrase")), "counts")

    def of(words: int) -> DataFrame:
        return counts.where(F.col("words") == words).select("lang", "phrase", "f")

    found = stored(paths(of(longest), of(longest - 1), longest), "compacted")
    # What covers a phrase: any longer candidate around it, and so one that is a word longer.
    covers = [
        found.select("lang", first_words("path", longest - 1).alias("phrase"), F.col("n").alias("f")),
        found.select("lang", last_words("path", longest - 1).alias("phrase"), F.col("n").alias("f")),
        unfolded(found, longest - 1, inner=True),
    ]
    for words in range(longest - 1, 2, -1):
        covers += [of(words).select("lang", end("phrase", words - 1).alias("phrase"), "f") for end in (first_words, last_words)]
    cover = reduce(DataFrame.unionByName, covers).groupBy("lang", "phrase").agg(F.max("f").alias("around"))

    whole = unfolded(found, longest)
    several = [of(words) for words in range(2, longest)]
    candidates = reduce(DataFrame.unionByName, [*several, whole]).join(cover, ["lang", "phrase"], "left")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    covered = F.coalesce(wide("around") * 100 >= wide("f") * COVER, F.lit(False))
    cut = F.explode(F.sequence(F.lit(1), n_words("phrase") - 1))
    cuts = (
        candidates.where(~covered)
        .select("lang", "phrase", F.col("f").alias("a"), cut.alias("k"))
        .withColumn("left", first_words("phrase", F.col("k")))
        .withColumn("right", last_words("phrase", n_words("phrase") - F.col("k")))
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
