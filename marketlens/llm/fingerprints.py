"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its terms are words, by a hash of 64 bits, weighted by how often they occur.
For sample k and term i there are fixed variates r, c ~ Gamma(2, 1) and b ~ U(0, 1). A term of weight
w has

    t = floor(ln w / r + b),   ln a = ln c - r (t - b) - r

and the sample of a text is its smallest ln a. Two texts have equal samples with the probability of
their generalised Jaccard similarity: sum of smaller weights over sum of larger weights. The
smallest value itself serves as the sample, since term and t alone decide it.

The variates of a term and a sample come from one hash of both, for any number of terms: four parts
of 12 bits are uniform variates, the logarithm of two of them gives r and that of the others c, and 16
bits are b. A term of a text and of its edited text draws once for both. Documents are spread over ranges
of ids; all steps after that exchange stay within the range, so each text moves once. Fingerprint: ``SAMPLES`` times eight hexadecimal
digits.

Null texts count as empty. Two empty texts are alike (1), an empty and another are not (0). Null ids
come last, equal ids in the order of a hash of their text; null ids are spread by that hash. A single
document is its own neighbour. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import SPACE, whole_text

SAMPLES = 64
WIDTH = 4
RANGE_ROWS = 1_000
MOST_RANGES = 65_536
OWN, EDITED, FACTS = 0, 1, 2


def words_of(text: Column) -> Column:
    return F.split(text, SPACE + "+")


def with_draws(rows: DataFrame) -> DataFrame:
    """``rows`` once for each part of ``WIDTH`` samples, with the variates ``r{j}``, ``log_c{j}`` and ``b{j}``.

    A few samples per row keep the generated code of the sums small enough to be compiled. The variates
    are columns of their own, so a row draws them once for all its weights.
    """
    sample = F.col("part") * WIDTH
    hashed = rows.select("*", *[F.xxhash64("term", sample + j).alias(f"h{j}") for j in range(WIDTH)])
    return hashed.select(*rows.columns, *[v for j in range(WIDTH) for v in variates(j)])


def variates(j: int) -> list[Column]:
    # A product of two uniform variates; minus its logarithm is Gamma(2, 1).
    part = lambda low: F.shiftrightunsigned(F.col(f"h{j}"), low).bitwiseAND(F.lit(4095)) + 0.5
    r, c = (-F.log(part(low) * part(low - 12) / float(1 << 24)) for low in (52, 28))
    b = (F.col(f"h{j}").bitwiseAND(F.lit(65535)) + 0.5) / 65536.0
    return [r.alias(f"r{j}"), F.log(c).alias(f"log_c{j}"), b.alias(f"b{j}")]


def log_a(j: int, log_w: Column) -> Column:
    r, b = F.col(f"r{j}"), F.col(f"b{j}")
    return F.col(f"log_c{j}") - r * (F.floor(log_w / r + b) - b + 1)


def with_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` (with ``tie``) with the number of its id range in ``bucket``, and their count.

    The limits are quantiles of the ids, about ``RANGE_ROWS`` rows apart, searched in two steps. Null
    ids have ranges below 0, of their ties.
    """
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    deep = max(1, nulls // RANGE_ROWS).bit_length() - 1
    # The sign bit flipped, the highest bits of a tie number its range in order.
    tie = F.shiftrightunsigned(F.col("tie").bitwiseXOR(F.lit(-1 << 63)), 64 - deep) if deep else F.lit(0)
    of_null = (tie - (1 << deep)).cast("int")
    ranges = min(MOST_RANGES, n // RANGE_ROWS + 1)
    side = math.isqrt(ranges - 1) + 1 if ranges > 1 else 1
    cuts = []
    if ranges > 1:
        steps = [i / ranges for i in range(1, ranges)]
        cuts = [int(x) for x in docs.select("doc_id").dropna().approxQuantile("doc_id", steps, 0.25 / ranges)]
    if not cuts:
        return docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), of_null).otherwise(0)), 1
    rows = [cuts[i : i + side] for i in range(0, len(cuts), side)]
    tops = "array(" + ",".join(f"{r[0]}L" for r in rows) + ")"
    table = "array(" + ",".join("array(" + ",".join(f"{x}L" for x in r) + ")" for r in rows) + ")"
    block = f"size(filter({tops}, x -> x <= doc_id))"
    place = f"if({block} = 0, 0, ({block} - 1) * {side} + size(filter({table}[{block} - 1], x -> x <= doc_id)))"
    found = F.when(F.col("doc_id").isNull(), of_null).otherwise(F.expr(place))
    return docs.withColumn("bucket", found), ranges


def with_next_text(docs: DataFrame) -> tuple[DataFrame, int]:
    """``bucket, ord, doc_id, text, next_text``: the neighbour by descending id, the last's is the first."""
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    rows, ranges = with_ranges(rows)
    # The first row of each range is needed at the end of the range above it; one row per range.
    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    above = Window.orderBy("bucket")
    around = above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goes_to = F.coalesce(F.lead("bucket").over(above), F.min("bucket").over(around))
    heads = heads.select(
        F.col("head.doc_id").alias("head_id"), F.col("head.tie").alias("head_tie"), goes_to.alias("goes_to")
    )
    copies = (
        rows.join(F.broadcast(heads), F.expr("doc_id <=> head_id AND tie = head_tie"))
        .withColumn("bucket", F.col("goes_to"))
        .withColumn("copy", F.lit(1))
        .select("bucket", "copy", "doc_id", "tie", "text")
    )
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), ranges // 2)
    order = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    both = rows.withColumn("copy", F.lit(0)).select(*copies.columns).unionByName(copies)
    paired = (
        both.repartition(parts, "bucket")
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("ord", F.row_number().over(order))
        .where("copy = 0")
    )
    return paired.select("bucket", "ord", "doc_id", "text", "next_text"), parts


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points (rounded down) replaced by the first as many of the other."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def _sha_longs(text: Column) -> list[Column]:
    digest = F.sha2(text, 256)
    return [
        F.conv(F.substring(digest, 1 + 16 * j, 16), 16, -10).cast("long") for j in range(4)
    ]


def _sha_text(parts: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(p), 16, "0") for p in parts]))


def weighted_terms(texts: DataFrame) -> DataFrame:
    """``bucket, ord, term, log_own, log_edited, fact`` of ``bucket, ord, text, changed, facts``.

    A term of both texts is one row with two weights, null where it does not occur. A document's
    facts, numbers joined by spaces, are read as a third text: fact i is the row of term i.
    """
    bodies = [(OWN, "text"), (EDITED, "changed"), (FACTS, "facts")]
    entry = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(name).alias("body")) for kind, name in bodies]))
    words = (
        texts.select("bucket", "ord", entry.alias("e"))
        .select("bucket", "ord", "e.kind", F.posexplode(words_of(F.col("e.body"))).alias("at", "word"))
        .where("word != ''")
    )
    is_fact = F.col("kind") == FACTS
    weight = lambda kind: F.log(F.count_if(F.col("kind") == kind).cast("double"))
    counted = words.select(
        "bucket",
        "ord",
        "kind",
        is_fact.alias("is_fact"),
        F.when(is_fact, F.col("at").cast("long")).otherwise(F.xxhash64("word")).alias("term"),
        F.when(is_fact, F.expr("try_cast(word AS bigint)")).alias("fact"),
    )
    return (
        counted.groupBy("bucket", "ord", "is_fact", "term")
        .agg(weight(OWN).alias("log_own"), weight(EDITED).alias("log_edited"), F.max("fact").alias("fact"))
        .drop("is_fact")
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    paired, _ = with_next_text(docs)
    texts = paired.withColumn("changed", edited(F.col("text"), F.col("next_text")))
    facts = [F.col("doc_id").cast("long"), F.char_length("text").cast("long"), *_sha_longs(F.col("changed"))]
    # A null id is a word that is no number.
    numbers = F.concat_ws(" ", *[F.coalesce(x.cast("string"), F.lit("-")) for x in facts])
    parts = F.explode(F.array(*[F.lit(p) for p in range(samples // WIDTH)]))
    drawn = with_draws(weighted_terms(texts.withColumn("facts", numbers)).withColumn("part", parts))

    # The facts of a document ride on the terms 0 to 5; fact i is read off part i.
    per_part = (
        drawn.groupBy("bucket", "ord", "part")
        .agg(
            *[F.min(log_a(j, F.col(f"log_{k}"))).alias(f"{k}{j}") for k in ("own", "edited") for j in range(WIDTH)],
            F.max(F.when(F.col("term") == F.col("part"), F.col("fact"))).alias("fact"),
        )
    )

    def joined(k: str) -> Column:
        low = [F.xxhash64(f"{k}{j}").bitwiseAND(F.lit(0xFFFFFFFF)) for j in range(WIDTH)]
        digits = F.lower(F.concat(*[F.lpad(F.hex(x), 8, "0") for x in low]))
        found = F.when(F.col(f"{k}0").isNotNull(), F.struct("part", digits.alias("digits")))
        return F.array_join(F.transform(F.array_sort(F.collect_list(found)), lambda p: p["digits"]), "")

    per_doc = per_part.groupBy("bucket", "ord").agg(
        joined("own").alias("own"),
        joined("edited").alias("other"),
        *[F.max(F.when(F.col("part") == i, F.col("fact"))).alias(f"f{i}") for i in range(len(facts))],
    )
    blank = F.lit("0" * 8 * samples)
    return per_doc.select(
        "bucket",
        "ord",
        F.col("f0").alias("doc_id"),
        F.col("f1").alias("n_chars"),
        _sha_text([F.col(f"f{i}") for i in range(2, 6)]).alias("edited_sha256"),
        F.when(F.col("own") == "", blank).otherwise(F.col("own")).alias("fingerprint"),
        F.when(F.col("other") == "", blank).otherwise(F.col("other")).alias("edited_fingerprint"),
    )


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints, given as bytes."""
    same = f"aggregate(sequence(0, {samples - 1}), 0, (n, k) -> n + int(substr({a}, 4 * k + 1, 4) = substr({b}, 4 * k + 1, 4)))"
    return F.expr(same) / float(samples)


def with_likeness(prints: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Adds ``near_edited`` and ``near_next``; neighbours are found by their range and place in it."""
    ends = prints.groupBy("bucket").agg(F.max("ord").alias("last"))
    below = Window.orderBy(F.col("bucket").desc())
    around = below.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.withColumn("lower", F.coalesce(F.lead("bucket").over(below), F.max("bucket").over(around)))
    at_end = F.col("ord") == F.col("last")
    rows = (
        prints.join(F.broadcast(ends), "bucket")
        .withColumn("next_bucket", F.when(at_end, F.col("lower")).otherwise(F.col("bucket")))
        .withColumn("next_ord", F.when(at_end, F.lit(1)).otherwise(F.col("ord") + 1))
    )
    following = prints.select(
        F.col("bucket").alias("next_bucket"), F.col("ord").alias("next_ord"), F.col("fingerprint").alias("next_print")
    )
    return (
        rows.join(following, ["next_bucket", "next_ord"])
        .withColumn("__own", F.unhex("fingerprint"))
        .withColumn("__edited", F.unhex("edited_fingerprint"))
        .withColumn("__next", F.unhex("next_print"))
        .withColumn("near_edited", likeness("__own", "__edited", samples))
        .withColumn("near_next", likeness("__own", "__next", samples))
        .select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
        )
    )
