"""The corpus operators as registered queries over the driver tables, with their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (
    centroids,
    exact,
    fingerprints,
    licenses,
    lines,
    lm_score,
    mixing,
    ngram_join,
    packing,
    phrases,
    pieces,
    quality,
    secret_spans,
)
from marketlens.llm.common import ship, stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function

    return add


@query(
    "op9_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the ids, by their hash, are the snapshot; the others come as the new batch."""
    old = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return exact.exact_groups(table(spark, folder, "documents"), old)


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    scored = quality.with_quality(docs, model)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


_LINES_SQL = r"""
    WITH split AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents
    ), line AS (
        SELECT doc_id, source, i, lines[i] AS line,
               regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare,
               len(regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+')) AS words
        FROM split, generate_series(1, len(lines)) AS place(i)
    ), boilerplate AS (
        SELECT bare, min(doc_id) AS first_id
        FROM line WHERE words >= 3
        GROUP BY bare
        HAVING count(DISTINCT source) + count(DISTINCT CASE WHEN source IS NULL THEN 1 END) >= 8
    ), judged AS (
        SELECT l.doc_id, l.i, l.line,
               b.bare IS NOT NULL AND (l.doc_id <> b.first_id OR l.i <> first_place) AS cut
        FROM (
            SELECT *, min(i) OVER (PARTITION BY doc_id, bare) AS first_place FROM line
        ) AS l
        LEFT JOIN boilerplate AS b ON l.bare = b.bare AND l.words >= 3
    )
    SELECT doc_id,
           coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT cut), '') AS text,
           count(*) AS n_lines,
           count(*) FILTER (WHERE cut) AS n_removed
    FROM judged GROUP BY doc_id
"""


@query("op1_line_dedup", _LINES_SQL)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Sites are the sources of the documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return lines.without_boilerplate(docs).drop("source")


@query("op5_source_mix")
def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_rows(table(spark, folder, "documents"))


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_rows(table(spark, folder, "documents"))


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    prints = stored(fingerprints.fingerprints(table(spark, folder, "documents")), "prints")
    return fingerprints.with_likeness(prints)


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded_rows(table(spark, folder, "documents"))


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secret_spans.with_secrets(docs, secret_spans.fit_field(docs)).drop("text")


_LINKED_SQL = r"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), shingle AS (
        SELECT DISTINCT row, array_to_string(w[i : i + 4], ' ') AS s
        FROM worded, generate_series(1, greatest(1, len(w) - 4)) AS place(i)
        WHERE len(w) > 0
    ), size AS (
        SELECT row, count(*) AS n FROM shingle GROUP BY row
    ), shared AS (
        SELECT a.row AS a, b.row AS b, count(*) AS o
        FROM shingle AS a JOIN shingle AS b ON a.s = b.s AND a.row <> b.row
        GROUP BY a.row, b.row
    ), link AS (
        SELECT a, b FROM shared JOIN size AS x ON x.row = a JOIN size AS y ON y.row = b
        WHERE 100 * o >= 75 * (x.n + y.n - o)
    ), reached AS (
        SELECT row AS a, row AS b FROM worded
        UNION
        SELECT reached.a, link.b FROM reached JOIN link ON reached.b = link.a
    ), component AS (
        SELECT a AS row, min(doc_id) AS component_id FROM reached JOIN worded ON worded.row = b GROUP BY a
    )
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM worded JOIN component USING (row) LEFT JOIN size USING (row)
"""


@query("op3_ngram_jaccard", _LINKED_SQL)
def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked(table(spark, folder, "documents"))


@query("op2_lm_score")
def op2_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.scored_rows(table(spark, folder, "documents"))


def _nearest_sql(step: int) -> str:
    """``assigned{step}``: the nearest centroid of every vector among ``centroid{step}``."""
    return f"""
    assigned{step} AS (
        SELECT vec_id, row, v, unnest(best, recursive := true) FROM (
            SELECT x.vec_id, x.row, any_value(x.v) AS v,
                   min({{'distance': list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT,
                        'cluster': c.cluster}}) AS best
            FROM vec AS x, centroid{step} AS c
            GROUP BY x.vec_id, x.row
        )
    )"""


def _moved_sql(step: int) -> str:
    """``centroid{step + 1}``: floors of the means, or the centroid where it has no vector."""
    return f"""
    part{step} AS (
        SELECT cluster, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n
        FROM assigned{step}, generate_series(1, 64) AS place(i) GROUP BY cluster, i
    ), mean{step} AS (
        SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v
        FROM part{step} GROUP BY cluster
    ), centroid{step + 1} AS (
        SELECT c.cluster, coalesce(m.v, c.v) AS v
        FROM centroid{step} AS c LEFT JOIN mean{step} AS m USING (cluster)
    )"""


_CLUSTER_SQL = (
    r"""
    WITH vec AS (
        SELECT vec_id, row_number() OVER () AS row, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
        FROM embeddings
        WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64
    ), centroid0 AS (
        SELECT (row_number() OVER (ORDER BY hash, v) - 1)::INTEGER AS cluster, v
        FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS hash, v FROM vec)
        ORDER BY hash, v LIMIT 16
    ),"""
    + ",".join(_nearest_sql(i) + "," + _moved_sql(i) for i in range(3))
    + ","
    + _nearest_sql(3)
    + """
    SELECT a.vec_id, a.cluster, a.distance,
           (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
           (sum(a.distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM assigned3 AS a JOIN centroid3 AS c USING (cluster)
    """
)


@query("op11_centroid_clustering", _CLUSTER_SQL)
def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_rows(table(spark, folder, "embeddings"))


@query("op13_packing")
def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


_PHRASE_SQL = r"""
    WITH piece AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), worded AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
    ), gram AS (
        SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
        FROM worded, generate_series(1, 4) AS size(m), generate_series(1, len(w) - m + 1) AS place(i)
        GROUP BY lang, m, phrase
    ), candidate AS (
        SELECT *, string_split(phrase, ' ') AS w FROM gram WHERE m >= 2 AND f >= 30
    ), part AS (
        SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(f) AS around
        FROM candidate, generate_series(2, m - 1) AS shorter(size), generate_series(1, m - size + 1) AS place(i)
        GROUP BY 1, 2
    ), cut AS (
        SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
               ((2000000::HUGEINT * c.f) // (l.f + r.f))::BIGINT AS score
        FROM (SELECT * FROM candidate, generate_series(1, m - 1) AS cuts(k)) AS c
        JOIN gram AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
        JOIN gram AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 :], ' ')
        LEFT JOIN part AS p ON p.lang = c.lang AND p.phrase = c.phrase
        WHERE p.around IS NULL OR 100::HUGEINT * p.around < 80::HUGEINT * c.f
    ), best AS (
        SELECT lang, phrase, a, l, r, score FROM cut
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), total AS (
        SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM best JOIN total USING (lang)
    QUALIFY rank <= 2000
"""


@query("op12_phrase_collocations", _PHRASE_SQL)
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))
