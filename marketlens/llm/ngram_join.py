"""Jaccard join of documents on word shingles: which documents reach each other by links.

Two documents link if their sets of distinct word shingles have at least ``LIKENESS`` in common of
all they have together. Texts with the same set are one item from the start. The search for the
others is a T-occurrence search: a partner must occur in at least T of the item's inverted lists,
T being ``LIKENESS`` times its set size.

1. Sieve. Every text posts its first ``n - T + l`` shingles in hash order, ``l`` a share of n. Two
   linked texts find at least the smaller of their two ``l`` in common there, and a partner has T
   shingles or more; a text that finds less shared has no partner. A list that a task already knows
   to be shared sends one row, whatever its length.
2. Lists of what is left: items are kept whose shingles with at least two items reach T. Shingles
   are ordered by list length, and an item looks for partners in the first ``n - T + 1`` only: the
   longest lists, of passages that many texts share, are not searched.
3. Star links. In each list every item is compared with two of the list's items, the same for all.
   That joins the bulk of large groups of near copies by a number of pairs in proportion.
4. DivideSkip for the rest: lists with items that are not yet joined form cells. Items outside of a
   cell's largest group search the cell's inverted lists: short lists are merged and counted, long
   lists are only probed, by binary search, for what the short ones found. A large cell is cut into
   shards of ``SHARD`` items. One link per group found is enough.

Links and sizes are exact: every link is verified on whole sets (64-bit hashes of shingles). Null and
empty texts have empty sets and stay alone. Null ids are larger than others; rows that repeat an id
are linked by their own texts. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm import wordhash
from marketlens.llm.common import stored, whole_text
from marketlens.llm.components import connected

WORDS = 5
LIKENESS = (75, 100)
EXTRA = 0.08
SHARD = 512
# Up to so many ids go to every task; more are joined by a shuffle.
SENT_IDS = 2_000_000


def least_overlap(n: int) -> int:
    """T: what a set of n must share with any partner."""
    return -(-LIKENESS[0] * n // LIKENESS[1])


def _extra(n: int) -> int:
    return max(1, int(EXTRA * n))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``token, key, credit``. Credit 0: the set ``key`` has the token among its first. -1: the token
    is shared. Over 0: so many of the set's tokens are shared, as seen here. -2 - n: the document
    with id ``token`` has this set, of n shingles."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        texts = _texts(batch)
        for low, high in wordhash.runs_of(texts):
            sets = wordhash.shingle_sets(texts[low:high], WORDS)
            keys = [wordhash.set_key(s) if len(s) else 0 for s in sets]
            meta = (ids[low:high], keys, [-2 - len(s) for s in sets])
            yield _rows(*meta)
            own: dict[int, np.ndarray] = {}
            for key, s in zip(keys, sets, strict=True):
                if len(s) and key not in own:
                    own[key] = s[: len(s) - least_overlap(len(s)) + _extra(len(s))]
            if not own:
                continue
            key = np.repeat(np.array(list(own), np.int64), [len(s) for s in own.values()])
            token = np.concatenate(list(own.values())).view(np.int64)
            order = np.argsort(token, kind="stable")
            key, token = key[order], token[order]
            new = np.diff(token, prepend=token[0] - 1) != 0
            which = np.cumsum(new) - 1
            shared = np.bincount(which)[which] > 1
            known, credits = np.unique(key[shared], return_counts=True)
            flagged = token[shared & new]
            yield _rows(token[~shared], key[~shared], np.zeros(int((~shared).sum()), np.int32))
            yield _rows(flagged, np.zeros(len(flagged), np.int64), np.full(len(flagged), -1, np.int32))
            yield _rows(known, known, credits)


_POSTING = pa.schema([("token", pa.int64()), ("key", pa.int64()), ("credit", pa.int32())])
_CREDIT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("credit", pa.int32())])


def _rows(*columns: Iterable, schema: pa.Schema = _POSTING) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _credits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token: documents with their sets, and shared tokens counted per set.

    The rows of one token are handled together; only those of the last are held over.
    """
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def counted(token: np.ndarray, key: np.ndarray, credit: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((key, token))
        token, key, credit = token[order], key[order], credit[order]
        new = np.diff(token, prepend=token[0] - 1) != 0
        which = np.cumsum(new) - 1
        repeat = ~new & (np.diff(key, prepend=key[0]) == 0) & (credit == 0)
        shared = np.bincount(which[~repeat])[which] > 1
        keys, counts = np.unique(key[shared & ~repeat & (credit == 0)], return_counts=True)
        none = [None] * len(keys)
        return _rows(keys, none, none, counts, schema=_CREDIT)

    for batch in batches:
        credit = batch.column("credit").to_numpy()
        key = batch.column("key").to_numpy()
        docs = credit <= -2
        if docs.any():
            ids = batch.column("token").filter(pa.array(docs))
            yield _rows(key[docs], ids, -2 - credit[docs], np.zeros(int(docs.sum()), np.int32), schema=_CREDIT)
        given = credit > 0
        if given.any():
            none = [None] * int(given.sum())
            yield _rows(key[given], none, none, credit[given], schema=_CREDIT)
        open_ = ~docs & ~given
        if not open_.any():
            continue
        token = batch.column("token").fill_null(0).to_numpy()[open_]
        part = [np.concatenate(x) for x in zip(held, (token, key[open_], credit[open_]), strict=True)]
        last = part[0] == part[0][-1]
        held = tuple(x[last] for x in part)
        if not last.all():
            yield counted(*(x[~last] for x in part))
    if len(held[0]):
        yield counted(*held)


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])
    for batch in batches:
        texts = _texts(batch)
        for low, high in wordhash.runs_of(texts):
            sets = [s for s in wordhash.shingle_sets(texts[low:high], WORDS) if len(s)]
            keys = [wordhash.set_key(s) for s in sets]
            tokens = [np.sort(s.view(np.int64)) for s in sets]
            yield _rows(keys, [len(s) for s in sets], tokens, schema=schema)


def _links(overlap: str, n: str, m: str) -> str:
    return f"{LIKENESS[1]} * {overlap} >= {LIKENESS[0]} * ({n} + {m} - {overlap})"


def sieved(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents as ``doc_id, key, n``, and the whole sets that may have a partner."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = (
        texts.mapInArrow(_postings, "token long, key long, credit int")
        .repartition("token")
        .sortWithinPartitions("token")
        .mapInArrow(_credits, "key long, doc_id long, n int, credit int")
    )
    rows = stored(rows, "postings")
    members = rows.where("n IS NOT NULL").select("doc_id", "key", "n")
    smallest = F.ceil(F.col("n") * LIKENESS[0] / LIKENESS[1])
    need = F.greatest(F.lit(1), F.floor(smallest * EXTRA))
    ids = (
        rows.where("credit > 0")
        .groupBy("key")
        .agg(F.sum("credit").alias("credit"))
        .join(members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("id"), F.max("n").alias("n")), "key")
        .where(F.col("credit") >= need)
        .select("key", "id")
    )
    ids = stored(ids, "candidates")
    wanted = ids.select("id").distinct()
    if ids.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)
    sets = (
        texts.join(wanted, F.expr("doc_id <=> id"), "left_semi")
        .mapInArrow(_whole_sets, "key long, n int, tokens array<long>")
        .join(ids.select("key"), "key", "left_semi")
        .groupBy("key")
        .agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    )
    return members, stored(sets, "sets")


def search_lists(sets: DataFrame) -> DataFrame:
    """``token, key``: the lists in which an item has to look for partners."""
    entries = sets.select("key", "n", F.explode("tokens").alias("token"))
    lengths = entries.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
    shared = (
        entries.join(lengths, "token")
        .groupBy("key", "n")
        .agg(F.array_sort(F.collect_list(F.struct("length", "token"))).alias("shared"))
    )
    least = F.ceil(F.col("n") * LIKENESS[0] / LIKENESS[1])
    first = F.slice("shared", F.lit(1), (F.size("shared") - least + 1).cast("int"))
    return (
        shared.where(F.size("shared") >= least)
        .select("key", F.explode(first).alias("entry"))
        .select("entry.token", "key")
    )


def star_pairs(lists: DataFrame) -> DataFrame:
    """In each list, every item with two that a hash picks: ``a, b``."""
    centres = lists.groupBy("token").agg(
        *[F.min_by("key", F.xxhash64("key", F.lit(r))).alias(f"c{r}") for r in (1, 2)]
    )
    return (
        lists.join(centres, "token")
        .select("key", F.explode(F.array("c1", "c2")).alias("centre"))
        .where("key <> centre")
        .select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b"))
        .distinct()
    )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link, by the intersection of their whole sets."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n"), F.col("tokens").alias("s"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("t"))
    sizes = pairs.join(left, "a").join(right, "b").select(
        "a", "b", "n", "m", F.size(F.array_intersect("s", "t")).alias("o")
    )
    return sizes.where(_links("o", "n", "m")).select("a", "b")


def divide_skip(tokens: np.ndarray, need: int, lists: dict, n_items: int) -> tuple[np.ndarray, np.ndarray]:
    """Items that occur in at least ``need`` of the tokens' lists, and in how many.

    The ``skipped`` longest lists are set aside: an item must occur in ``need - skipped`` of the short
    ones, whose sorted runs are merged; the long ones are then probed for these items alone.
    """
    found = sorted((lists[t] for t in tokens.tolist() if t in lists), key=len)
    nothing = np.zeros(0, np.int64)
    if len(found) < need:
        return nothing, nothing
    skipped = min(need - 1, int(need / (0.01 * np.log2(max(n_items, 2)) + 1)))
    short, long_ = (found[:-skipped], found[-skipped:]) if skipped else (found, [])
    merged = np.sort(np.concatenate(short), kind="stable") if short else nothing
    items, counts = np.unique(merged, return_counts=True)
    enough = counts >= need - skipped
    items, counts = items[enough], counts[enough]
    for i, run in enumerate(long_):
        if not len(items):
            break
        place = np.minimum(np.searchsorted(run, items), len(run) - 1)
        counts = counts + (run[place] == items)
        still = counts >= need - (len(long_) - 1 - i)
        items, counts = items[still], counts[still]
    return items, counts


def _search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Links between the queries and the indexed items of one shard, one per group found."""
    index = part[~part["is_query"]].reset_index(drop=True)
    queries = part[part["is_query"]]
    out = []
    if len(index) and len(queries):
        tokens = np.concatenate(index["tokens"].to_list())
        items = np.repeat(np.arange(len(index)), index["n"])
        order = np.lexsort((items, tokens))
        tokens, items = tokens[order], items[order]
        first = np.flatnonzero(np.diff(tokens, prepend=tokens[0] - 1) != 0)
        lists = dict(zip(tokens[first].tolist(), np.split(items, first[1:]), strict=True))
        sizes, groups, keys = (index[c].to_numpy() for c in ("n", "comp", "key"))
        for q in queries.itertuples():
            hits, overlap = divide_skip(q.tokens, least_overlap(q.n), lists, len(index))
            good = LIKENESS[1] * overlap >= LIKENESS[0] * (q.n + sizes[hits] - overlap)
            good &= groups[hits] != q.comp
            hits = hits[good]
            _, one = np.unique(groups[hits], return_index=True)
            out += [(q.key, int(keys[h])) for h in hits[one]]
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def rest_links(lists: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between items that ``links`` do not join yet."""
    groups = connected(links).select(F.col("node").alias("key"), F.col("label").alias("comp"))
    marked = lists.join(groups, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    marked = stored(marked, "lists")
    mixed = marked.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    left = marked.join(mixed.select("token", "low"), "token")
    # Items of a list, by their groups: one cell holds whole groups that lists connect.
    cells = connected(left.where("comp <> low").select(F.col("comp").alias("a"), F.col("low").alias("b")).distinct(), "cell")
    items = left.select("key", "comp").distinct().join(cells, F.col("comp") == F.col("node")).select("key", "comp", "cell")
    items = stored(items, "cells")
    sizes = items.groupBy("cell", "comp").agg(F.count("*").alias("size"))
    plan = sizes.groupBy("cell").agg(
        F.max(F.struct("size", "comp"))["comp"].alias("main"),
        F.ceil(F.sum("size") / SHARD).cast("int").alias("shards"),
    )
    shard = F.pmod(F.xxhash64("key"), F.col("shards")).cast("int")
    placed = stored(items.join(plan, "cell").withColumn("shard", shard), "placed")
    # A query goes to the shards that hold a list in which it has to look: two linked items share one.
    holds = marked.join(placed.select("key", "cell", "shard"), "key").select("token", "cell", "shard").distinct()
    asked = (
        marked.select("token", "key")
        .join(placed.where("comp <> main").select("key", F.col("cell").alias("c")), "key")
        .join(holds, "token")
        .where("c = cell")
        .select("key", "cell", "shard")
        .distinct()
    )
    asked = stored(asked, "asked")
    # Queries of a shard are cut as well, and its index goes to each part: both sides are bounded.
    parts = asked.groupBy("cell", "shard").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.col("parts")).cast("int")
    asking = asked.join(parts, ["cell", "shard"]).select("key", "cell", "shard", part.alias("part"), F.lit(True).alias("is_query"))
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    indexed = placed.join(parts, ["cell", "shard"]).select("key", "cell", "shard", each.alias("part"), F.lit(False).alias("is_query"))
    facts = sets.join(placed.select("key", "comp"), "key")
    rows = indexed.unionByName(asking).join(facts, "key")
    return rows.groupBy("cell", "shard", "part").applyInPandas(_search, "a long, b long")


def linked(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (smallest id reachable by links) per document."""
    members, sets = sieved(docs)
    lists = stored(search_lists(sets), "lists")
    stars = stored(verified(star_pairs(lists), sets), "stars")
    more = rest_links(lists, stars, sets)
    labels = connected(stars.unionByName(more)).select(F.col("node").alias("key"), "label")
    ids = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first_id"))
    named = ids.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = stored(named.join(smallest, "label").select("key", "component_id"), "classes")
    return members.join(classes, "key", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
