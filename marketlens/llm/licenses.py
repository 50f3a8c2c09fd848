"""Find license texts by diagonal voting.

The rolling grams of ``K`` words of a document are hashed and joined to those of the license
templates (a fixed list, so it is sent to all tasks). Grams whose first word begins no template gram
are left out before; they could not be joined. A hit at word p of the document and q of the template
votes for the diagonal p - q. Votes are gathered per document, template and diagonal; diagonals of a
template that lie within ``SLACK`` of the one before merge, so a few inserted or missing words do not
split a license, as long as they stay within ``drift`` of the first: a place far off is a span of its
own. A span is then verified: of its hits, in the order of the document, only those count that go
forward in the template; they must cover ``COVER`` of its grams, and hold a gram with all of its
telling words, which tell the license from others of like wording. Each hit compares the words
themselves, so a hash collision is no vote.

Base phrases need every gram on one diagonal: their words stand consecutively there. Templates are
short notices, sentences, and whole bodies of licenses. Work grows in proportion with a text.

Null and empty texts have no words and no labels. Every row is a document of its own, whatever its
id; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import whole_text

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3
SLACK = 3
COVER = 0.6
# How far the diagonals of one span may lie apart, and in a long template, a part of its grams.
DRIFT, DRIFT_PART = 12, 0.25

# Phrases and labels of the base search.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Opening words, short notices and sentences of the bodies of well-known licenses, with
# the label and the telling words of each.
TEMPLATES = {
    "licensed under the apache license version 2 0": ("apache", "apache license"),
    "you may not use this file except in compliance with the license": ("apache", "compliance"),
    "licensed under cc by nc 4 0": ("cc-by-nc", "by nc"),
    "licensed under a creative commons attribution 4 0 international license": ("cc-by", "attribution 4"),
    "this work is licensed under the gnu general public license version 3": ("gpl", "gnu general"),
    "you can redistribute it and or modify it under the terms of the gnu general public license": ("gpl", "gnu general"),
    "under the terms of the gnu lesser general public license": ("lgpl", "lesser"),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", "hereby granted"),
    "redistribution and use in source and binary forms with or without modification are permitted": ("bsd", "redistribution"),
    "this source code form is subject to the terms of the mozilla public license": ("mpl", "mozilla"),
    "copyright all rights reserved no part may be reproduced without permission": ("reserved", "reserved"),
    "under the mit license": ("mit", "mit license"),
    "spdx license identifier mit": ("mit", "identifier mit"),
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": ("mit", "permission notice"),
    "under the apache license": ("apache", "apache license"),
    "spdx license identifier apache 2 0": ("apache", "identifier apache"),
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": ("apache", "as is basis"),
    "under the bsd license": ("bsd", "bsd license"),
    "under the bsd 2 clause license": ("bsd", "bsd 2 clause"),
    "under the bsd 3 clause license": ("bsd", "bsd 3 clause"),
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": ("bsd", "must retain"),
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer": ("bsd", "must reproduce"),
    "under the gnu lesser general public license": ("lgpl", "lesser"),
    "under the mozilla public license": ("mpl", "mozilla public"),
    "licensed under a creative commons attribution noncommercial 4 0 international license": ("cc-by-nc", "attribution noncommercial"),
}

# Whole bodies and notices of licenses, by label and telling words.
BODIES = {
    """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
    documentation files the software to deal in the software without restriction including without limitation the
    rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
    persons to whom the software is furnished to do so subject to the following conditions the above copyright notice
    and this permission notice shall be included in all copies or substantial portions of the software the software is
    provided as is without warranty of any kind express or implied including but not limited to the warranties of
    merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright
    holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise
    arising from out of or in connection with the software or the use or other dealings in the software""": ("mit", "hereby granted"),
    """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
    provided that the above copyright notice and this permission notice appear in all copies the software is provided as
    is and the author disclaims all warranties with regard to this software including all implied warranties of
    merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential
    damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract
    negligence or other tortious action arising out of or in connection with the use or performance of this
    software""": ("isc", "author disclaims"),
    """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
    license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable
    law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties
    or conditions of any kind either express or implied see the license for the specific language governing permissions
    and limitations under the license""": ("apache", "apache license"),
    """this program is free software you can redistribute it and or modify it under the terms of the gnu general public
    license as published by the free software foundation either version 3 of the license or at your option any later
    version this program is distributed in the hope that it will be useful but without any warranty without even the
    implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more
    details""": ("gpl", "gnu general"),
    """redistribution and use in source and binary forms with or without modification are permitted provided that the
    following conditions are met redistributions of source code must retain the above copyright notice this list of
    conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this
    list of conditions and the following disclaimer in the documentation and or other materials provided with the
    distribution this software is provided by the copyright holders and contributors as is and any express or implied
    warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose
    are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental
    special exemplary or consequential damages including but not limited to procurement of substitute goods or services
    loss of use data or profits or business interruption however caused and on any theory of liability whether in contract
    strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if
    advised of the possibility of such damage""": ("bsd", "must retain"),
    """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
    compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial
    or non commercial and by any means""": ("unlicense", "unencumbered software"),
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def license_words(text: Column) -> Column:
    """The words of the text with A-Z in lower case, as an array."""
    parts = F.split(F.translate(text, _UPPER, _UPPER.lower()), NOT_WORD)
    head = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    return F.slice(parts, head + 1, F.greatest(F.size(parts) - head - tail, F.lit(0)))


def patterns() -> list[tuple[str, list[str], list[str] | None]]:
    """Label, words and telling words of every base phrase (no telling words) and template."""
    base = [(label, phrase.split(), None) for phrase, label in BASE.items()]
    return base + [(label, text.split(), telling.split()) for text, (label, telling) in (TEMPLATES | BODIES).items()]


def grams_of(words: list[str]) -> list[list[str]]:
    """The rolling grams of ``K`` words; a shorter phrase is one gram."""
    return [words[i : i + K] for i in range(max(1, len(words) - K + 1))]


def template_grams(spark: SparkSession) -> DataFrame:
    """``hash, template, q`` and words ``a, b, c`` of each gram, and a row that every document hits."""
    rows = [(-1, -1, None, None, None)]
    for number, (_, words, _) in enumerate(patterns()):
        rows += [(number, q, *gram, *[None] * (3 - len(gram))) for q, gram in enumerate(grams_of(words))]
    grams = spark.createDataFrame(rows, "template int, q int, a string, b string, c string")
    return grams.withColumn("hash", F.when(F.col("template") < 0, F.lit(0).cast("long")).otherwise(F.xxhash64("a", "b", "c")))


def template_facts(spark: SparkSession) -> DataFrame:
    rows = []
    for number, (label, words, telling) in enumerate(patterns()):
        grams = grams_of(words)
        places = [q for q, g in enumerate(grams) if telling and any(g[i : i + len(telling)] == telling for i in range(K))]
        if telling and not places:
            raise ValueError(f"no gram holds the telling words {telling}")
        rows.append((number, label, len(grams), telling is None, places))
    return spark.createDataFrame(rows, "template int, label string, grams int, is_base boolean, telling array<int>")


def diagonal_votes(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n_words, template, diagonal, places``; one row with template -1 per document.

    ``places``: the template's places that were hit on the diagonal, at most as many as it has.
    """
    spark = docs.sparkSession
    firsts = sorted({g[0] for _, words, _ in patterns() for g in grams_of(words)})
    pairs = sorted({tuple(words) for _, words, _ in patterns() if len(words) == 2})
    words = F.col("words")
    begins = F.array_compact(F.transform(words, lambda w, p: F.when(w.isin(firsts), p)))
    # Only the words of a gram travel with it, not those of its document.
    gram = lambda p: F.struct(
        p.alias("place"), F.get(words, p).alias("a"), F.get(words, p + 1).alias("b"), F.get(words, p + 2).alias("c")
    )
    none = F.lit(None).cast("string")
    every = F.struct(F.lit(-1).alias("place"), none.alias("a"), none.alias("b"), none.alias("c"))
    split = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", license_words(whole_text()).alias("words"))
    grams = split.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"), F.inline(F.concat(F.array(every), F.transform(begins, gram)))
    )
    short = F.lit(False)
    for one, two in pairs:
        short = short | ((F.col("a") == one) & (F.col("b") == two))
    # A phrase of two words is met by its own hash, whatever follows.
    whole = F.when(F.col("c").isNotNull(), F.xxhash64("a", "b", "c"))
    two = F.when(short, F.xxhash64("a", "b", none))
    keys = F.when(F.col("place") < 0, F.array(F.lit(0).cast("long"))).otherwise(F.array_compact(F.array(whole, two)))
    templates = F.broadcast(template_grams(spark)).select("hash", "template", "q", *[F.col(c).alias(f"t_{c}") for c in "abc"])
    same = (F.col("a") == F.col("t_a")) & (F.col("b") == F.col("t_b")) & (F.col("t_c").isNull() | (F.col("c") == F.col("t_c")))
    hits = (
        grams.select("*", F.explode(keys).alias("hash"))
        .join(templates, "hash")
        .where(F.when(F.col("template") < 0, F.col("place") < 0).otherwise(same))
    )
    diagonal = F.when(F.col("template") < 0, F.lit(0)).otherwise(F.col("place") - F.col("q"))
    return hits.groupBy("row", "doc_id", "n_words", "template", diagonal.alias("diagonal")).agg(
        F.collect_set("q").alias("places")
    )


def license_spans(votes: DataFrame) -> DataFrame:
    """Verified spans: ``row, doc_id, n_words, template, label, is_base, start, cover``.

    A document without any has one row, of template -1.
    """
    facts = F.broadcast(template_facts(votes.sparkSession)).withColumnRenamed("template", "t")
    rows = votes.join(facts, votes["template"] == F.col("t"), "left").drop("t")
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    # A base phrase merges nothing; other diagonals join the one before if it is near.
    far = F.coalesce(F.col("is_base") | (F.col("diagonal") - F.lag("diagonal").over(near) > SLACK), F.lit(True))
    drift = F.greatest(F.lit(DRIFT), F.floor(F.col("grams") * DRIFT_PART))
    first = F.min("diagonal").over(Window.partitionBy("row", "template", "chain"))
    merged = (
        rows.withColumn("chain", F.sum(far.cast("int")).over(near))
        .withColumn("part", F.floor((F.col("diagonal") - first) / drift))
        .groupBy("row", "doc_id", "n_words", "template", "label", "is_base", "grams", "telling", "chain", "part")
        .agg(F.collect_list(F.struct("diagonal", "places")).alias("votes"))
    )
    hit = lambda v: F.transform(v["places"], lambda q: F.struct((v["diagonal"] + q).alias("p"), q.alias("q")))
    hits = F.array_sort(F.flatten(F.transform("votes", hit)))
    # In the order of the document, what goes forward in the template.
    forward = F.aggregate(
        hits,
        F.array().cast("array<int>"),
        lambda kept, h: F.when(h["q"] > F.coalesce(F.array_max(kept), F.lit(-1)), F.concat(kept, F.array(h["q"]))).otherwise(kept),
    )
    spans = (
        merged.withColumn("hits", hits)
        .withColumn("kept", forward)
        .withColumn("start", F.col("hits")[0]["p"])
        .withColumn("cover", F.size("kept") / F.col("grams"))
    )
    told = F.col("is_base") | F.arrays_overlap("kept", "telling")
    least = F.when(F.col("is_base"), F.lit(1.0)).otherwise(F.lit(COVER))
    sound = (F.col("template") == -1) | ((F.col("cover") >= least) & told)
    return spans.where(sound).select("row", "doc_id", "n_words", "template", "label", "is_base", "start", "cover")


def license_rows(docs: DataFrame) -> DataFrame:
    """Per document: words, base places and labels, all labels, and the best cover as score."""
    spans = license_spans(diagonal_votes(docs))
    base = F.col("is_base")
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    return (
        spans.groupBy("row", "doc_id", "n_words")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.col("label")).alias("labels"),
            F.coalesce(F.max(F.when(F.col("template") >= 0, F.col("cover"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
