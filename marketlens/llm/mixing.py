"""Mix sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source's words, in a seeded order of its documents, are cut into blocks of the same number of
words, up to one: ``BLOCK``, or less where the target is small, so that it is about eight blocks at
least. The mix has as many blocks as the targets fill. Sources get blocks by highest quotients
``wanted / (2 k - 1)``, where wanted is the target in blocks; a source's blocks go to its shards in the
same way, so each shard has an integer quota. A shard takes all its blocks ``quota div blocks`` times
and the rest once more from blocks that a seeded permutation of the block numbers puts first.

A shard is a hash range of one source's documents, about ``SHARD_WORDS`` words, told by id and text: a
source of any size is spread over as many tasks as that makes, and rows without id by their texts.
Rows that repeat both id and text share a shard. Windows without a shard run over one row per source
(or per shard of one source) only.

Null texts have no words. A null source is a source, last in order. Equal rows are separate rows of
the mix. An empty table gives an empty result. Without words all targets are zero. Other columns,
whatever their names, are kept by ``mixed_texts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import WORD, stored, whole_text

BLOCK = 32
LEAST_BLOCKS = 8
SHARD_WORDS = 1 << 20
REPEATS = 3
WEIGHTS = (5, 2, 1)
# A prime above any number of blocks in a shard, so multiplying permutes the block numbers.
STRIDE = 2_147_483_647


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Per source: ``source_size`` and the ``target`` number of words.

    Sources in order take the weights in turn and share the sum of all sizes; a target stops at
    ``REPEATS`` times its source's size and the excess goes to the others by weight. Sources with
    the lowest limit per weight stop first, so one pass in that order finds which do.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_per_weight", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    # The level is what one weight gets; the first source whose limit is not below it ends the stops.
    level = (F.col("total") - F.coalesce(F.col("stopped"), F.lit(0.0))) / F.col("open_weight")
    return (
        sources.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * float(REPEATS))
        .withColumn("limit_per_weight", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
        .withColumn("stopped", F.sum("limit").over(before))
        .withColumn("open_weight", F.sum("weight").over(onward))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("limit_per_weight"), F.struct("limit_per_weight", "level"))).over(everything)["level"])
        .withColumn("target", F.least("limit", F.col("level") * F.col("weight")))
        .select("source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))
    )


def apportioned(df: DataFrame, group: Sequence[str], name: str, weight: str, seats: str) -> DataFrame:
    """``df`` with ``quota``: the group's ``seats`` dealt to its rows by highest quotients.

    With n rows and N seats, a row's share is certain up to N - n seats in proportion and cannot
    pass N + n seats in proportion; only the quotients between compete, about three per row.
    """
    whole = Window.partitionBy(*group)
    share = F.try_divide(F.col(weight), F.col("__all"))
    rounded = lambda n: F.floor(share * n + 0.5).cast("long")
    ranked = Window.partitionBy(*group).orderBy(F.col("__quotient").desc(), F.col(name).asc_nulls_last())
    rows = (
        df.withColumn("__all", F.sum(weight).over(whole))
        .withColumn("__rows", F.count(F.lit(1)).over(whole))
        .withColumn("__low", F.coalesce(rounded(F.greatest(F.col(seats) - F.col("__rows"), F.lit(0))), F.lit(0)))
        .withColumn("__high", F.coalesce(rounded(F.col(seats) + F.col("__rows")), F.lit(0)))
        .withColumn("__certain", F.sum("__low").over(whole))
    )
    seat = F.when(F.col("__high") > F.col("__low"), F.sequence(F.col("__low") + 1, F.col("__high")))
    contest = (
        rows.withColumn("__seat", F.explode_outer(seat))
        .withColumn("__quotient", F.col(weight) / (2 * F.col("__seat") - 1))
        .withColumn("__rank", F.row_number().over(ranked))
        .withColumn("__won", F.col("__quotient").isNotNull() & (F.col("__rank") <= F.col(seats) - F.col("__certain")))
    )
    return contest.groupBy(*df.columns, "__low").agg(
        F.sum(F.col("__won").cast("long")).alias("__more")
    ).select(*df.columns, (F.col("__low") + F.col("__more")).alias("quota"))


def with_mix(docs: DataFrame, sizes: DataFrame, seed: int = 0, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """``docs`` (with ``doc_id``, ``source``, ``of``, ``size``) plus what the mix takes of each row.

    Adds ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``blocks``: for each
    stretch of the row within one block its first word, its length and how often it is taken.
    ``sizes`` has the same rows with those four columns alone; ``of`` tells a row's text.
    """
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS))
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.col("target") / LEAST_BLOCKS)))
    targets = source_targets(sizes, weights).withColumns({"block": block.cast("long"), "shards": shards})
    targets = stored(targets, "targets")

    def placed(rows: DataFrame) -> DataFrame:
        plan = targets.select(F.col("source").alias("__source"), "source_size", "target", "block", "shards")
        shard = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "of"), F.col("shards"))
        return rows.join(plan, F.expr("source <=> __source")).withColumn("shard", shard).drop("__source")

    # Summed per shard of the smallest plan first, so a hot source is many partial sums.
    by_shard = (
        placed(sizes)
        .groupBy("source", "shard", "block")
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("n_blocks", F.ceil(F.col("shard_size") / F.col("block")))
    )
    by_shard = stored(by_shard, "shards")
    blocks_of = by_shard.groupBy(F.col("source").alias("__source")).agg(F.sum("n_blocks").alias("all_blocks"))
    wanted = F.try_divide(F.col("target") * F.col("all_blocks"), F.col("source_size"))
    sources = (
        targets.join(blocks_of, F.expr("source <=> __source"))
        .select("source", F.coalesce(wanted, F.lit(0.0)).alias("wanted"))
        .withColumn("seats", F.round(F.sum("wanted").over(Window.partitionBy())).cast("long"))
    )
    sources = apportioned(sources, [], "source", "wanted", "seats")
    sources = sources.select(F.col("source").alias("__source"), F.col("quota").alias("source_quota"))
    weighed = by_shard.join(sources, F.expr("source <=> __source")).drop("__source")
    weighed = weighed.withColumn("__weight", F.col("n_blocks").cast("double"))
    quotas = apportioned(weighed, ["source"], "shard", "__weight", "source_quota").select(
        F.col("source").alias("__source"),
        F.col("shard").alias("__shard"),
        "shard_size",
        F.greatest("n_blocks", F.lit(1)).alias("n_blocks"),
        F.least(F.col("quota"), F.col("n_blocks") * REPEATS).alias("quota"),
    )
    quotas = stored(quotas, "quotas")

    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "of"), "doc_id", "of", "size")
    offset = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.col("n_blocks"))
    rows = (
        placed(docs)
        .join(quotas, F.expr("source <=> __source AND shard = __shard"))
        .withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("end") - F.col("size"))
        .withColumn("offset", offset)
    )
    # Block b has the shard's words from b * shard_size div n_blocks on.
    blocks = F.expr(f"""
        transform(
            if(size > 0, sequence(((start + 1) * n_blocks - 1) div shard_size, (end * n_blocks - 1) div shard_size), array()),
            b -> named_struct(
                'first', greatest(b * shard_size div n_blocks - start, 0),
                'length', least((b + 1) * shard_size div n_blocks, end) - greatest(b * shard_size div n_blocks, start),
                'times', quota div n_blocks
                    + if(pmod(b * {STRIDE} + offset, n_blocks) < quota % n_blocks, 1, 0)))
    """)
    taken = F.expr("aggregate(blocks, 0L, (sum, b) -> sum + b.length * b.times)")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("taken", taken)
        .select(*docs.columns, "source_size", "target", "taken", "blocks")
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.xxhash64(whole_text()).alias("of"), words_in(whole_text()).alias("size"))


def mixed_rows(docs: DataFrame, seed: int = 0, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per document."""
    sizes = stored(sized(docs), "sizes")
    return with_mix(sizes, sizes, seed, weights).select("doc_id", "size", "source_size", "target", "taken")


def mixed_texts(docs: DataFrame, seed: int = 0, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """The mix itself, with the columns of ``docs``: rows cut to the words taken, repeats as rows.

    A row whose words are all taken once comes out unchanged; the r-th repeat holds the stretches
    taken at least r times. Rows of which nothing is taken are left out.
    """
    sizes = stored(sized(docs), "sizes")
    other = [c for c in docs.columns if c not in ("doc_id", "source", "text", "n_chars")]
    rest = F.struct(F.lit(0).alias("none"), *other).alias("rest")
    rows = docs.select("doc_id", "source", rest, whole_text().alias("text"), F.xxhash64(whole_text()).alias("of"))
    mixed = with_mix(rows.withColumn("size", words_in(F.col("text"))), sizes, seed, weights).where("taken > 0")
    # A word with the white space after it; the first takes what stands before it as well.
    pieces = F.regexp_extract_all("text", F.lit(rf"(?:^[\x20\x09-\x0D]*)?{WORD}[\x20\x09-\x0D]*"), 0)
    text = F.expr("""
        if(forall(blocks, b -> b.times >= repeat), text, array_join(transform(
            filter(blocks, b -> b.times >= repeat),
            b -> array_join(slice(pieces, int(b.first + 1), int(b.length)), '')), ''))
    """)
    most = F.expr("array_max(transform(blocks, b -> b.times))")
    made = (
        mixed.withColumn("pieces", pieces)
        .withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), most)))
        .withColumn("text", text)
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
    return made.select(*[F.col("rest")[c].alias(c) if c in other else F.col(c) for c in docs.columns])
