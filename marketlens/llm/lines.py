"""Remove boilerplate lines: lines that stand on many distinct sites.

Each line's hash gets a HyperLogLog sketch of the sites it was seen on; sketches are partial on the
map side and merge in the aggregation, so a line of any frequency is one row per task. Lines whose
estimate is near the threshold are counted exactly. Of a boilerplate line the first occurrence, by
smallest id and then place, stays; all others are cut.

A line is what stands between line feeds; it is compared without the white space around it. Lines
under ``MIN_WORDS`` words are never boilerplate. Null texts count as empty, a null site is a site of
its own, a null id sorts first. Rows that repeat an id and a text are handled alike. A text may become empty;
its row stays. Other columns are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import WORD, stored, whole_text

SITES = 8
MIN_WORDS = 3
LOG_SLOTS = 12
# Three standard errors of a sketch with 2**LOG_SLOTS slots, and one site for rounding.
MARGIN = 3 * 1.04 / 2 ** (LOG_SLOTS / 2)


def line_key(line: Column) -> tuple[Column, Column]:
    """Two hashes of 64 bits: one alone may be the same for different lines of a very large corpus."""
    bare = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.xxhash64(bare).alias("key"), F.xxhash64(F.lit("again"), bare).alias("check")


def text_key() -> Column:
    return F.xxhash64(whole_text())


def site_lines(docs: DataFrame, site: str = "source", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, of, site, place, key, check`` of every line that can be boilerplate; ``of`` tells the text."""
    named = F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit(""))
    return (
        docs.select("doc_id", text_key().alias("of"), named.alias("site"), F.posexplode(F.split(whole_text(), "\n")).alias("place", "line"))
        .where(F.regexp_count("line", F.lit(WORD)) >= min_words)
        .select("doc_id", "of", "site", "place", *line_key(F.col("line")))
    )


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """``key, check, first_id, first_place`` of the lines seen on at least ``sites`` sites."""
    same = ["key", "check"]
    spread = (
        lines.groupBy(*same)
        .agg(
            F.hll_sketch_agg("site", LOG_SLOTS).alias("sketch"),
            F.count("*").alias("n"),
            F.min(F.struct("doc_id", "place")).alias("first"),
        )
        .where(F.col("n") >= sites)
        .select(*same, F.hll_sketch_estimate("sketch").alias("estimate"), "first")
    )
    low, high = sites * (1 - MARGIN) - 1, sites * (1 + MARGIN) + 1
    spread = stored(spread.where(F.col("estimate") >= low), "spread")
    near = spread.where(F.col("estimate") <= high)
    exact = (
        lines.join(near.select(*same), same, "left_semi")
        .select(*same, "site")
        .distinct()
        .groupBy(*same)
        .agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= sites)
        .select(*same)
    )
    found = spread.where(F.col("estimate") > high).unionByName(near.join(exact, same, "left_semi"))
    return found.select(*same, F.col("first.doc_id").alias("first_id"), F.col("first.place").alias("first_place"))


def without_places(lines: Column, places: Column) -> Column:
    """The lines but for those at ``places``, which are in order: the stretches between them, in a row.

    Each stretch is copied once, so the work grows with the lines, however many are cut.
    """
    bounds = F.arrays_zip(F.concat(F.array(F.lit(-1)), places).alias("low"), F.concat(places, F.array(F.size(lines))).alias("high"))

    def kept(whole: Column) -> Column:
        return F.flatten(F.transform(bounds, lambda b: F.slice(whole, b["low"] + 2, b["high"] - b["low"] - 1)))

    # As a variable the lines are split once, not once for every stretch.
    return F.element_at(F.transform(F.array(lines), kept), 1)


def without_boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with cut texts, plus ``n_lines`` (before) and ``n_removed``; columns of these names are replaced."""
    lines = stored(site_lines(docs, site, min_words), "lines")
    found = stored(boilerplate(lines, sites), "boilerplate")
    # Rows of the same id and text lose the same lines. Others share nothing, whatever their ids.
    cuts = (
        lines.join(found, ["key", "check"])
        .where(~(F.expr("doc_id <=> first_id") & (F.col("place") == F.col("first_place"))))
        .groupBy(F.col("doc_id").alias("__id"), F.col("of").alias("__of"))
        .agg(F.array_sort(F.collect_set("place")).alias("__places"))
    )
    same = F.expr("doc_id <=> __id") & (text_key() == F.col("__of"))
    split = F.split(whole_text(), "\n")
    removed = F.coalesce(F.size("__places"), F.lit(0))
    cut = F.when(F.col("__places").isNull(), whole_text()).otherwise(F.array_join(without_places(split, F.col("__places")), "\n"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return docs.join(cuts, same, "left").select(
        *[cut.alias("text") if c == "text" else F.col(c) for c in kept],
        F.size(split).cast("long").alias("n_lines"),
        F.when(F.col("__places").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"),
    )
