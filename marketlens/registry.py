"""Named queries over the driver tables, each with its SQL counterpart.

``events`` serves as the price table in two ways: ``ticks`` takes the user as the asset (many
assets with few rows each), ``type_ticks`` the event type (five assets that hold a fifth of all
rows each).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks, sources, streaming
from .functions import columns_to_line, line_to_struct
from .operators.quality import (
    clean,
    drop_duplicate_keys,
    duplicate_count,
    keep_first,
    null_counts,
    quality_report,
)
from .operators.pairs import correlation, pair_on_time
from .operators.selection import page, ranked_pages, sample_rows
from .operators.windows import sliced_windows
from .plans import analytics, batch, incremental, ingest
from .plans.features import asset_metrics, clean_prices, price_features, segment_rows
from .schema import ASSET, CHANGE_1, CHANGE_7, PREV_1, PREV_7, PRICE, SNAPSHOT_COLUMNS, SYMBOL, TIME
from .session import apply_settings, scratch_path
from .streaming.relay import write_sample

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The two event types that stand for stable symbols.
STABLE_TYPES = ("error", "signup")


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def with_settings(spark: SparkSession, folder: str) -> DataFrame:
            return run(apply_settings(spark), folder)

        QUERIES[name] = with_settings
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _to_ticks(events: DataFrame, asset: str) -> DataFrame:
    volume = F.get_json_object("props", "$.k").try_cast("double")
    return events.select(
        F.col(asset).cast("string").alias("cryptocurrency"),
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("date"),
        F.col("value").alias("price_usd"),
        (F.col("value") * volume).alias("market_cap"),
        volume.alias("volume_24h"),
        (F.col("value") - 50).alias("price_change_percent_24h"),
        F.lit(0.0).alias("price_change_percent_7d"),
        F.col("event_id").cast("double").alias("total_supply"),
        volume.alias("circulating_supply"),
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return _to_ticks(_table(spark, folder, "events"), "user_id")


def type_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return _to_ticks(_table(spark, folder, "events"), "event_type")


def _features(rows: DataFrame, **options) -> DataFrame:
    return price_features(rows, STABLE_TYPES, **options)


_BUILT: dict[tuple[str, str, str], batch.Tables] = {}


def _built(spark: SparkSession, folder: str, asset: str) -> batch.Tables:
    """The tables of the batch job over these ticks: written by the first query that asks for them.

    They belong to the session. Users are many assets, event types five.
    """
    key = (spark.conf.get("spark.app.id"), folder, asset)
    if key not in _BUILT or not sources.is_committed(spark, _BUILT[key].segments):
        path = scratch_path(spark, f"built-{asset}")
        _BUILT[key] = batch.run_batch(
            _to_ticks(_table(spark, folder, "events"), asset),
            path,
            STABLE_TYPES,
            grain="day",
            by_asset=asset == "event_type",
        )
    return _BUILT[key]


def _stored_features(
    spark: SparkSession, folder: str, asset: str = "user_id", assets: list[str] | None = None
) -> DataFrame:
    return batch.read_features(spark, _built(spark, folder, asset).features, assets)


# Added on both sides before rounding. Prices are whole cents, so a mean over 32 or 64 rows often
# ends in exactly half of the last digit kept; there the order of summing would decide.
_NUDGE = 1e-9


def _shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and timestamps without zone, as the SQL side gives them."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.dataType.typeName() == "double":
            column = F.round(column + _NUDGE, digits)
        elif field.dataType.typeName() == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _ticks_sql(asset: str) -> str:
    return f"""
ticks AS (
  SELECT CAST({asset} AS VARCHAR) AS cryptocurrency, event_type AS symbol, ts AS date,
         value AS price_usd, value * k AS market_cap, k AS volume_24h,
         value - 50 AS price_change_percent_24h, CAST(0 AS DOUBLE) AS price_change_percent_7d,
         CAST(event_id AS DOUBLE) AS total_supply, k AS circulating_supply
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
),
cleaned AS (
  SELECT * EXCLUDE (rn), CAST(floor(epoch(date)) AS BIGINT) AS sec
  FROM (SELECT *, row_number() OVER (
          PARTITION BY cryptocurrency, symbol, date ORDER BY price_usd, market_cap, volume_24h,
          price_change_percent_24h, total_supply, circulating_supply) AS rn FROM ticks)
  WHERE rn = 1 AND volume_24h IS NOT NULL AND price_usd > 0 AND market_cap >= 0
),
lagged AS (
  SELECT * REPLACE (
      CAST(0 AS DOUBLE) AS price_change_percent_24h, CAST(0 AS DOUBLE) AS price_change_percent_7d),
    lag(price_usd, 1) OVER w AS prev_price_24h,
    lag(price_usd, 7) OVER w AS prev_price_7d,
    CASE WHEN symbol IN ('error', 'signup') THEN 'stablecoin' ELSE 'volatile' END AS segment,
    avg(price_usd) OVER (PARTITION BY cryptocurrency ORDER BY sec
      RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS avg_price_7d,
    avg(price_usd) OVER (PARTITION BY cryptocurrency ORDER BY sec
      RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW) AS avg_price_30d
  FROM cleaned
  WINDOW w AS (PARTITION BY cryptocurrency ORDER BY date, symbol)
),
features AS (
  SELECT * EXCLUDE (sec) REPLACE (
    CASE WHEN prev_price_24h IS NULL THEN 0
         ELSE (price_usd - prev_price_24h) / prev_price_24h * 100 END AS price_change_percent_24h,
    CASE WHEN prev_price_7d IS NULL THEN 0
         ELSE (price_usd - prev_price_7d) / prev_price_7d * 100 END AS price_change_percent_7d)
  FROM lagged
)"""


_BY_USER = "WITH " + _ticks_sql("user_id")
_BY_TYPE = "WITH " + _ticks_sql("event_type")
_SEGMENT_MEANS = """avg(price_usd) AS avg_price, avg(market_cap) AS avg_market_cap,
    avg(volume_24h) AS avg_volume_24h"""

# --- Sources ---------------------------------------------------------------------------------


@_query(
    "scan_projection",
    "SELECT user_id AS asset, ts AS at, value AS price FROM events",
)
def _(spark, folder):
    events = _table(spark, folder, "events")
    return events.select(
        F.col("user_id").alias("asset"), F.col("ts").alias("at"), F.col("value").alias("price")
    )


@_query(
    "sql_filtered_scan",
    """SELECT event_id, user_id, value FROM events
       WHERE event_type IN ('purchase', 'view') AND value BETWEEN 20 AND 60""",
)
def _(spark, folder):
    return sources.select_from(
        spark,
        """SELECT event_id, user_id, value FROM {events}
           WHERE event_type IN ('purchase', 'view') AND value BETWEEN 20 AND 60""",
        events=_table(spark, folder, "events"),
    )


@_query("parquet_success_gate", "SELECT * FROM events")
def _(spark, folder):
    path = scratch_path(spark, "plain")
    sinks.write_plain(_table(spark, folder, "events"), path)
    return sources.read_if_committed(spark, path)


_TICK_ROWS = """SELECT cryptocurrency, symbol, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date,
    price_usd, market_cap, volume_24h, price_change_percent_24h, price_change_percent_7d,
    total_supply, circulating_supply FROM ticks"""


def _text_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return ticks(spark, folder).withColumn(
        TIME, F.date_format(TIME, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


@_query("csv_snapshot_roundtrip", _BY_USER + _TICK_ROWS)
def _(spark, folder):
    rows = _text_ticks(spark, folder)
    stable = F.col("symbol").isin(*STABLE_TYPES)
    daily, combined = scratch_path(spark, "daily"), scratch_path(spark, "combined")
    sinks.write_daily(rows.filter(stable), daily, F.col(TIME).cast("timestamp"))
    sinks.write_combined(rows.filter(~stable), combined)
    good, _rejected = ingest.ingest_snapshots(spark, [daily, combined])
    return good


@_query("catalog_roundtrip", "SELECT * FROM customer")
def _(spark, folder):
    path, name = scratch_path(spark, "table"), f"marketlens_{uuid.uuid4().hex}"
    sinks.write_plain(_table(spark, folder, "customer"), path)
    sinks.register_table(spark, name, path)
    return sources.read_table(spark, name)


@_query("partitioned_write_by_key", "SELECT * FROM events")
def _(spark, folder):
    path, events = scratch_path(spark, "by-key"), _table(spark, folder, "events")
    sinks.write_partitioned(events, path, "event_type")
    return sources.read_if_committed(spark, path).select(*events.columns)


@_query(
    "partitioned_write_by_segment",
    _BY_USER
    + """SELECT segment, day AS date, round(avg_price + 1e-9, 6) AS avg_price,
           round(avg_market_cap + 1e-9, 6) AS avg_market_cap,
           round(avg_volume_24h + 1e-9, 6) AS avg_volume_24h
         FROM (SELECT segment, date_trunc('day', date)::TIMESTAMP AS day, """
    + _SEGMENT_MEANS
    + " FROM features GROUP BY 1, 2)",
)
def _(spark, folder):
    path = scratch_path(spark, "by-segment")
    segments = analytics.segment_aggregates(segment_rows(ticks(spark, folder), STABLE_TYPES), "day")
    sinks.write_partitioned(segments, path, "segment")
    return _shown(sources.read_if_committed(spark, path).select(*segments.columns))


# --- Quality ---------------------------------------------------------------------------------


@_query("clean_ticks", "SELECT * FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal > 0")
def _(spark, folder):
    return clean(
        _table(spark, folder, "customer"), ["c_custkey"], ["c_acctbal"], F.col("c_acctbal") > 0
    )


@_query("clean_prices", _BY_USER + "SELECT * EXCLUDE (sec) FROM cleaned")
def _(spark, folder):
    rows = clean_prices(ticks(spark, folder))
    return rows.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


# Copies that are worse than the row they repeat: which of them is kept decides what is left. The
# kept copy is the one that sorts first, nulls last, so the order of the three steps shows.
_DIRTY_SQL = """WITH dirty AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey - 1000000, NULL, l_extendedprice FROM lineitem
      WHERE l_partkey % 5 = 0
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey - 2000000, l_quantity, -l_extendedprice FROM lineitem
      WHERE l_partkey % 7 = 0
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey + 1000000, NULL, -l_extendedprice FROM lineitem
      WHERE l_partkey % 3 = 0
  ), first AS (
    SELECT * FROM dirty QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_quantity, l_extendedprice) = 1)
  """


def _dirty_lines(spark: SparkSession, folder: str) -> DataFrame:
    key, part = ["l_orderkey", "l_linenumber"], F.col("l_partkey")
    lines = _table(spark, folder, "lineitem").select(*key, "l_partkey", "l_quantity", "l_extendedprice")
    none, price = F.lit(None).cast(lines.schema["l_quantity"].dataType), F.col("l_extendedprice")
    quantity = F.col("l_quantity")
    copies = [
        (part % 5 == 0, part - 1_000_000, none, price),
        (part % 7 == 0, part - 2_000_000, quantity, -price),
        (part % 3 == 0, part + 1_000_000, none, -price),
    ]
    fields = lambda p, q, e: F.struct(p.alias("l_partkey"), q.alias("l_quantity"), e.alias("l_extendedprice"))
    made = [F.when(on, fields(p, q, e)) for on, p, q, e in copies]
    rows = F.array_compact(F.array(fields(part, quantity, price), *made))
    return lines.select(*key, F.inline(rows))


@_query(
    "clean_dirty_lines",
    _DIRTY_SQL + "SELECT * FROM first WHERE l_quantity IS NOT NULL AND l_extendedprice > 0",
)
def _(spark, folder):
    """Rows whose better copies are lost with the first, as the order of cleaning wants it."""
    valid = F.col("l_extendedprice") > 0
    return clean(
        _dirty_lines(spark, folder), ["l_orderkey", "l_linenumber"], ["l_quantity"], valid
    )


@_query(
    "dirty_report",
    _DIRTY_SQL
    + """SELECT count(*) AS row_count,
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows,
           count(*) - count(l_quantity) AS null_l_quantity FROM dirty""",
)
def _(spark, folder):
    return quality_report(
        _dirty_lines(spark, folder), ["l_orderkey", "l_linenumber"], ["l_quantity"]
    )


@_query("dedup_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(spark, folder):
    lines = _table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return drop_duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"] + [
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@_query(
    "dedup_keep_first",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE_ORDER)}) AS rn
        FROM lineitem) WHERE rn = 1""",
)
def _(spark, folder):
    lines = _table(spark, folder, "lineitem")
    return keep_first(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@_query(
    "duplicate_report",
    """SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows
       FROM lineitem""",
)
def _(spark, folder):
    return duplicate_count(_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query(
    "null_report",
    """SELECT count(*) AS row_count, count(*) - count(text) AS null_text,
         count(*) - count(quality) AS null_quality, count(*) - count(toxic) AS null_toxic,
         count(*) > count(quality) AS any_null
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(spark, folder):
    labelled = _table(spark, folder, "documents").join(
        _table(spark, folder, "labels"), "doc_id", "left"
    )
    return null_counts(labelled, ["text", "quality", "toxic"])


@_query(
    "quality_report",
    """SELECT count(*) AS row_count,
         count(*) - count(DISTINCT (user_id, event_type)) AS duplicate_rows,
         count(*) - count(ts) AS null_ts, count(*) - count(value) AS null_value FROM events""",
)
def _(spark, folder):
    events = _table(spark, folder, "events")
    return quality_report(events, ["user_id", "event_type"], ["ts", "value"])


# --- Windows and features --------------------------------------------------------------------


def _feature_columns_sql(*columns: str, source: str = _BY_USER) -> str:
    return f"{source} SELECT cryptocurrency, date, {', '.join(columns)} FROM features"


@_query(
    "lag_change_1",
    _feature_columns_sql(
        "prev_price_24h", "round(price_change_percent_24h + 1e-9, 6) AS price_change_percent_24h"
    ),
)
def _(spark, folder):
    return _shown(_features(ticks(spark, folder)).select(ASSET, TIME, PREV_1, CHANGE_1))


@_query(
    "lag_change_7",
    _feature_columns_sql(
        "prev_price_7d", "round(price_change_percent_7d + 1e-9, 6) AS price_change_percent_7d"
    ),
)
def _(spark, folder):
    return _shown(_features(ticks(spark, folder)).select(ASSET, TIME, PREV_7, CHANGE_7))


_LAGS_SQL = """SELECT event_id, lag(value, 1) OVER w AS back_1, lag(value, 7) OVER w AS back_7
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"""
_BACK = {"back_1": 1, "back_7": 7}


@_query("lags_by_type", _LAGS_SQL)
def _(spark, folder):
    events = _table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    lagged = sliced_windows(
        events, "event_type", "ts", ["ts", "event_id"], "value", _BACK, {}
    )
    return lagged.select("event_id", *_BACK)


@_query("lags_by_type_sliced", _LAGS_SQL)
def _(spark, folder):
    """As ``lags_by_type``, with days of over 50 rows cut."""
    events = _table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    lagged = sliced_windows(
        events, "event_type", "ts", ["ts", "event_id"], "value", _BACK, {}, slice_rows=50
    )
    return lagged.select("event_id", *_BACK)


for _days in (7, 30):

    @_query(
        f"trailing_avg_{_days}d",
        _feature_columns_sql(f"round(avg_price_{_days}d + 1e-9, 6) AS avg_price_{_days}d"),
    )
    def _(spark, folder, days=_days):
        name = f"avg_price_{days}d"
        rows = clean_prices(ticks(spark, folder))
        means = sliced_windows(rows, ASSET, TIME, [TIME, SYMBOL], PRICE, {}, {name: days})
        return _shown(means.select(ASSET, TIME, name))

    @_query(
        f"trailing_avg_{_days}d_sliced",
        _feature_columns_sql(
            f"round(avg_price_{_days}d + 1e-9, 6) AS avg_price_{_days}d", source=_BY_TYPE
        ),
    )
    def _(spark, folder, days=_days):
        rows = clean_prices(type_ticks(spark, folder))
        name = f"avg_price_{days}d"
        means = sliced_windows(rows, ASSET, TIME, [TIME], PRICE, {}, {name: days})
        return _shown(means.select(ASSET, TIME, name))


_FEATURE_TABLE = """SELECT * REPLACE (
    round(market_cap + 1e-9, 6) AS market_cap,
    round(price_change_percent_24h + 1e-9, 6) AS price_change_percent_24h,
    round(price_change_percent_7d + 1e-9, 6) AS price_change_percent_7d,
    round(avg_price_7d + 1e-9, 6) AS avg_price_7d,
    round(avg_price_30d + 1e-9, 6) AS avg_price_30d)
  FROM features"""


@_query("feature_table", _BY_USER + _FEATURE_TABLE)
def _(spark, folder):
    return _shown(_features(ticks(spark, folder)))


@_query("feature_table_hot_assets", _BY_USER + _FEATURE_TABLE)
def _(spark, folder):
    """As ``feature_table``, with days of over two rows cut."""
    return _shown(_features(ticks(spark, folder), slice_rows=2))


@_query("feature_table_by_type", _BY_TYPE + _FEATURE_TABLE)
def _(spark, folder):
    return _shown(_features(type_ticks(spark, folder)))


@_query("feature_table_by_type_sliced", _BY_TYPE + _FEATURE_TABLE)
def _(spark, folder):
    """As ``feature_table_by_type``, with days of over 50 rows cut."""
    return _shown(_features(type_ticks(spark, folder), slice_rows=50))


@_query(
    "asset_metrics",
    _BY_TYPE
    + """SELECT cryptocurrency, date, price_usd,
           round(price_change_percent_24h + 1e-9, 6) AS price_change_percent_24h,
           round(avg_price_7d + 1e-9, 6) AS avg_price_7d,
           round(avg_price_30d + 1e-9, 6) AS avg_price_30d
         FROM features WHERE cryptocurrency IN ('purchase', 'view')""",
)
def _(spark, folder):
    wanted = ["purchase", "view"]
    return _shown(asset_metrics(_stored_features(spark, folder, "event_type"), wanted))


# --- The batch job ---------------------------------------------------------------------------


@_query("feature_table_by_asset_roundtrip", _BY_TYPE + _FEATURE_TABLE)
def _(spark, folder):
    """The whole batch job, and its feature table read back from a folder per asset."""
    tables = batch.run_batch(type_ticks(spark, folder), scratch_path(spark, "batch"), STABLE_TYPES)
    return _shown(batch.read_features(spark, tables.features))


@_query(
    "feature_table_of_assets",
    _BY_TYPE + _FEATURE_TABLE + " WHERE cryptocurrency IN ('purchase', 'view')",
)
def _(spark, folder):
    """Two of the five folders are read."""
    return _shown(_stored_features(spark, folder, "event_type", ["purchase", "view"]))


@_query(
    "batch_row_counts",
    _BY_TYPE
    + """SELECT (SELECT count(*) FROM cleaned) AS clean_rows,
           (SELECT count(*) FROM features) AS feature_rows,
           (SELECT count(DISTINCT (segment, date_trunc('day', date))) FROM features) AS segment_rows""",
)
def _(spark, folder):
    """Clean rows as counted while they were written, and the rows of both tables."""
    tables = batch.run_batch(
        type_ticks(spark, folder), scratch_path(spark, "batch"), STABLE_TYPES, grain="day"
    )
    of_features, of_segments = F.lit(True).alias("of_features"), F.lit(False).alias("of_features")
    features = batch.read_features(spark, tables.features).select(of_features)
    segments = batch.read_segments(spark, tables.segments).select(of_segments)
    return features.unionAll(segments).agg(
        F.lit(tables.rows).cast("long").alias("clean_rows"),
        F.count_if("of_features").alias("feature_rows"),
        F.count_if(~F.col("of_features")).alias("segment_rows"),
    )


@_query(
    "segment_table_roundtrip",
    _BY_TYPE
    + """SELECT segment, day AS date, round(avg_price + 1e-9, 6) AS avg_price,
           round(avg_market_cap + 1e-9, 6) AS avg_market_cap,
           round(avg_volume_24h + 1e-9, 6) AS avg_volume_24h
         FROM (SELECT segment, date_trunc('day', date)::TIMESTAMP AS day, """
    + _SEGMENT_MEANS
    + " FROM features GROUP BY 1, 2)",
)
def _(spark, folder):
    return _shown(batch.read_segments(spark, _built(spark, folder, "event_type").segments))


@_query(
    "segment_quality_report",
    _BY_TYPE
    + """, segments AS (SELECT segment, date_trunc('day', date) AS day, avg(price_usd) AS avg_price,
             avg(market_cap) AS avg_market_cap FROM features GROUP BY 1, 2)
         SELECT count(*) AS row_count, count(*) - count(DISTINCT (segment, day)) AS duplicate_rows,
           count(*) - count(avg_price) AS null_avg_price,
           count(*) - count(avg_market_cap) AS null_avg_market_cap FROM segments""",
)
def _(spark, folder):
    """The checks of the segment table."""
    segments = batch.read_segments(spark, _built(spark, folder, "event_type").segments)
    return quality_report(segments, ["segment", TIME], ["avg_price", "avg_market_cap"])


# The first load ends before the first of these days; each further load before the next.
_LOADS = ("2024-01-15", "2024-01-27", "2024-01-28", "9999-12-31")


@_query("feature_table_grown_by_day", _BY_TYPE + _FEATURE_TABLE)
def _(spark, folder):
    """The feature table grown in four loads, the third of them given twice."""
    path, rows, begin = scratch_path(spark, "grown"), type_ticks(spark, folder), "0001-01-01"
    for end in _LOADS:
        part = rows.filter((F.col(TIME) >= F.lit(begin)) & (F.col(TIME) < F.lit(end)))
        for _ in range(2 if end == _LOADS[2] else 1):
            incremental.grow(part, path, STABLE_TYPES)
        begin = end
    return _shown(incremental.read_grown(spark, path).drop(incremental.DAY))


# --- Analytics -------------------------------------------------------------------------------

_SEGMENTS = """SELECT segment, date, round(avg_price + 1e-9, 6) AS avg_price,
    round(avg_market_cap + 1e-9, 6) AS avg_market_cap,
    round(avg_volume_24h + 1e-9, 6) AS avg_volume_24h
  FROM (SELECT segment, {time} AS date, {means} FROM features GROUP BY 1, 2)"""
_DAY = "date_trunc('day', date)::TIMESTAMP"


@_query("segment_aggregates_exact", _BY_USER + _SEGMENTS.format(time="date", means=_SEGMENT_MEANS))
def _(spark, folder):
    return _shown(analytics.segment_aggregates(segment_rows(ticks(spark, folder), STABLE_TYPES)))


@_query("segment_aggregates_daily", _BY_USER + _SEGMENTS.format(time=_DAY, means=_SEGMENT_MEANS))
def _(spark, folder):
    return _shown(analytics.segment_aggregates(segment_rows(ticks(spark, folder), STABLE_TYPES), "day"))


@_query(
    "segment_volatility",
    _BY_USER
    + """SELECT segment,
           round(avg(abs(price_change_percent_24h)) + 1e-9, 4) AS avg_abs_price_change_percent
         FROM features GROUP BY segment""",
)
def _(spark, folder):
    return _shown(analytics.segment_volatility(_stored_features(spark, folder)), 4)


@_query(
    "asset_volatility",
    _BY_USER
    + """SELECT cryptocurrency, round(avg(abs(price_change_percent_24h)) + 1e-9, 4) AS avg_volatility
         FROM features GROUP BY cryptocurrency""",
)
def _(spark, folder):
    return _shown(analytics.asset_volatility(_stored_features(spark, folder)), 4)


@_query(
    "asset_volatility_sql",
    _BY_TYPE
    + """SELECT cryptocurrency, round(avg(abs(price_change_percent_24h)) + 1e-9, 4) AS avg_volatility
         FROM features WHERE date BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY cryptocurrency""",
)
def _(spark, folder):
    """The same question as a SQL text over the feature table."""
    return _shown(
        sources.select_from(
            spark,
            """SELECT cryptocurrency, AVG(ABS(price_change_percent_24h)) AS avg_volatility
               FROM {features} WHERE date BETWEEN '2024-01-05' AND '2024-01-20'
               GROUP BY cryptocurrency ORDER BY avg_volatility DESC""",
            features=_stored_features(spark, folder, "event_type"),
        ),
        4,
    )


@_query(
    "asset_volatility_rounded",
    _BY_TYPE
    + """SELECT cryptocurrency, round(avg(abs(price_change_percent_24h)), 2) AS avg_daily_volatility
         FROM features WHERE cryptocurrency IN ('purchase', 'view')
           AND date BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY cryptocurrency""",
)
def _(spark, folder):
    return analytics.asset_volatility(
        _stored_features(spark, folder, "event_type"),
        ["purchase", "view"],
        "2024-01-05",
        "2024-01-20",
        digits=2,
    )


for _signed, _name in ((True, "signed"), (False, "abs")):
    _change = CHANGE_1 if _signed else f"abs({CHANGE_1})"

    @_query(
        f"volume_change_corr_{_name}",
        _BY_USER
        + f"""SELECT round(corr(volume_24h, {_change}) + 1e-9, 6) AS correlation
              FROM features WHERE segment = 'volatile'""",
    )
    def _(spark, folder, signed=_signed):
        features = _stored_features(spark, folder)
        return _shown(analytics.volume_change_correlation(features, signed=signed))


_VOLUME_SPLIT = """
  avg(volume_24h) FILTER (WHERE abs(price_change_percent_24h) >= 3) AS avg_volume_anomalies,
  avg(volume_24h) FILTER (WHERE abs(price_change_percent_24h) < 3) AS avg_volume_normal
  FROM features WHERE segment = 'volatile'"""


@_query(
    "anomaly_volume_split",
    _BY_USER
    + f"""SELECT round(avg_volume_anomalies + 1e-9, 6) AS avg_volume_anomalies,
            round(avg_volume_normal + 1e-9, 6) AS avg_volume_normal FROM (SELECT {_VOLUME_SPLIT})""",
)
def _(spark, folder):
    return _shown(analytics.anomaly_volume_split(_stored_features(spark, folder)))


@_query(
    "anomaly_uplift",
    _BY_USER
    + f"""SELECT round(
            (avg_volume_anomalies - avg_volume_normal) / avg_volume_normal * 100 + 1e-9, 6)
            AS uplift_percent FROM (SELECT {_VOLUME_SPLIT})""",
)
def _(spark, folder):
    return _shown(analytics.anomaly_volume_uplift(_stored_features(spark, folder)))


def _daily_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Mean price per event type and day: no two events share a timestamp."""
    rows = clean_prices(type_ticks(spark, folder))
    return rows.groupBy(ASSET, F.date_trunc("day", TIME).alias(TIME)).agg(
        F.avg(PRICE).alias(PRICE)
    )


_PAIR = (
    _BY_TYPE
    + f""", daily AS (SELECT cryptocurrency, {_DAY} AS day, avg(price_usd) AS price
          FROM cleaned GROUP BY 1, 2),
      pairs AS (SELECT a.day AS date, a.price AS purchase_price, b.price AS view_price
          FROM daily a JOIN daily b ON a.day = b.day
          WHERE a.cryptocurrency = 'purchase' AND b.cryptocurrency = 'view')"""
)


@_query(
    "price_pair",
    _PAIR
    + """SELECT date, round(purchase_price + 1e-9, 6) AS purchase_price,
           round(view_price + 1e-9, 6) AS view_price FROM pairs""",
)
def _(spark, folder):
    names = ("purchase_price", "view_price")
    return _shown(
        analytics.price_pair(_daily_prices(spark, folder), "purchase", "view", names)
    )


@_query(
    "price_pair_corr",
    _PAIR + "SELECT round(corr(purchase_price, view_price) + 1e-9, 6) AS correlation FROM pairs",
)
def _(spark, folder):
    return _shown(
        analytics.price_pair_correlation(_daily_prices(spark, folder), "purchase", "view")
    )


@_query(
    "top_asset_anomalies",
    _BY_USER
    + _FEATURE_TABLE
    + """ WHERE abs(price_change_percent_24h) >= 3 AND cryptocurrency IN (
           SELECT cryptocurrency FROM features GROUP BY 1
           ORDER BY round(avg(market_cap), 9) DESC, cryptocurrency LIMIT 5)""",
)
def _(spark, folder):
    return _shown(analytics.top_asset_anomalies(_stored_features(spark, folder)))


@_query(
    "leader_anomalies",
    _BY_USER
    + """, leaders AS (SELECT cryptocurrency FROM cleaned GROUP BY 1
           ORDER BY round(avg(market_cap), 9) DESC, cryptocurrency LIMIT 5) """
    + _FEATURE_TABLE
    + """ WHERE abs(price_change_percent_24h) >= 3
          AND cryptocurrency IN (SELECT cryptocurrency FROM leaders)""",
)
def _(spark, folder):
    """As ``top_asset_anomalies``, from raw rows: only the leaders' rows reach the windows."""
    return _shown(
        analytics.leader_anomalies(ticks(spark, folder), stable_symbols=STABLE_TYPES)
    )


@_query(
    "price_pair_exact_times",
    """SELECT a.o_orderdate AS at, a.o_totalprice AS urgent_price, b.o_totalprice AS low_price
       FROM orders AS a JOIN orders AS b ON a.o_orderdate = b.o_orderdate
         AND a.o_orderpriority = '1-URGENT' AND b.o_orderpriority = '5-LOW'""",
)
def _(spark, folder):
    """Priorities as assets: many rows of a side share one time, so every combination counts."""
    orders = _table(spark, folder, "orders").withColumnRenamed("o_orderdate", "at")
    names = ("urgent_price", "low_price")
    return pair_on_time(orders, "o_orderpriority", "at", "o_totalprice", "1-URGENT", "5-LOW", names)


@_query(
    "price_series",
    _BY_TYPE
    + """SELECT cryptocurrency, date, price_usd,
           round(price_change_percent_24h + 1e-9, 6) AS price_change_percent_24h
         FROM features WHERE cryptocurrency IN ('purchase', 'view')
           AND date BETWEEN '2024-01-05' AND '2024-01-20'""",
)
def _(spark, folder):
    features = _stored_features(spark, folder, "event_type")
    return _shown(
        analytics.price_series(features, ["purchase", "view"], "2024-01-05", "2024-01-20")
    )


@_query(
    "segment_series",
    _BY_USER
    + f"""SELECT segment, day AS date, round(cap + 1e-9, 6) AS avg_market_cap
          FROM (SELECT segment, {_DAY} AS day, avg(market_cap) AS cap FROM features GROUP BY 1, 2)
          WHERE NOT (segment = 'volatile' AND day = DATE '2024-01-30')""",
)
def _(spark, folder):
    segments = analytics.segment_aggregates(segment_rows(ticks(spark, folder), STABLE_TYPES), "day")
    return _shown(
        analytics.segment_series(segments, "avg_market_cap", [("volatile", "2024-01-30")])
    )


@_query("segment_names", _BY_USER + "SELECT DISTINCT segment FROM features")
def _(spark, folder):
    return analytics.segment_names(segment_rows(ticks(spark, folder), STABLE_TYPES))


@_query(
    "weekly_trend",
    _BY_USER
    + """SELECT cryptocurrency, round(avg(price_change_percent_7d) + 1e-9, 4) AS avg_weekly_change_percent
         FROM features GROUP BY cryptocurrency""",
)
def _(spark, folder):
    return _shown(analytics.weekly_trend(_stored_features(spark, folder)), 4)


@_query(
    "cap_stability",
    _BY_USER
    + f""", daily AS (SELECT segment, {_DAY} AS day, avg(market_cap) AS cap FROM features
            GROUP BY 1, 2),
          means AS (SELECT segment, avg(cap) AS mean_cap FROM daily GROUP BY segment),
          spread AS (SELECT segment, mean_cap, (cap - mean_cap) / mean_cap * 100 AS away
            FROM daily JOIN means USING (segment))
          SELECT segment, round(any_value(mean_cap) + 1e-9, 6) AS mean_cap,
            round(max(away) + 1e-9, 6) AS max_rise_percent,
            round(min(away) + 1e-9, 6) AS max_fall_percent,
            round(max(abs(away)) + 1e-9, 6) AS max_spread_percent
          FROM spread GROUP BY segment""",
)
def _(spark, folder):
    return _shown(analytics.segment_cap_stability(segment_rows(ticks(spark, folder), STABLE_TYPES)))


@_query(
    "order_price_corr",
    """SELECT round(corr(l_quantity, l_extendedprice) + 1e-9, 6) AS correlation FROM lineitem""",
)
def _(spark, folder):
    return _shown(
        correlation(_table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    )


# --- Selection -------------------------------------------------------------------------------


@_query("sample_rows", "SELECT * FROM events ORDER BY md5('7:' || event_id), event_id LIMIT 100")
def _(spark, folder):
    return sample_rows(_table(spark, folder, "events"), 100, "event_id", seed=7)


@_query(
    "spool_sample",
    """SELECT event_id || ',' || user_id || ',' || event_type AS value FROM events
       ORDER BY md5('8:' || event_id), event_id LIMIT 100""",
)
def _(spark, folder):
    """One batch of the sample spooler, read back."""
    path = scratch_path(spark, "samples")
    rows = _table(spark, folder, "events").select("event_id", "user_id", "event_type")
    write_sample(rows, path, 100, 1, "event_id", seed=7)
    return spark.read.text(f"{path}/batch=1")


@_query(
    "sample_membership",
    """SELECT least(100, count(*)) AS sampled, least(100, count(DISTINCT event_id)) AS different
       FROM events""",
)
def _(spark, folder):
    """Sampled rows that are whole rows of the table, and how many of them differ."""
    events = _table(spark, folder, "events")
    found = events.join(sample_rows(events, 100, "event_id", seed=7), events.columns, "left_semi")
    return found.agg(
        F.count(F.lit(1)).alias("sampled"), F.countDistinct("event_id").alias("different")
    )


@_query(
    "ranked_page",
    """SELECT p_partkey, p_name, p_retailprice FROM part
       ORDER BY p_retailprice DESC, p_partkey LIMIT 50 OFFSET 50""",
)
def _(spark, folder):
    parts = _table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    return page(parts, [F.desc("p_retailprice"), "p_partkey"], 2, 50)


@_query(
    "ranked_page_deep",
    """SELECT o_orderkey, o_totalprice, rank FROM (SELECT o_orderkey, o_totalprice,
           row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
       WHERE rank BETWEEN 4951 AND 5000""",
)
def _(spark, folder):
    """Page 100: read from the ranges it touches."""
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.col("o_orderkey").asc()]
    pages = ranked_pages(orders, order, scratch_path(spark, "pages"), ranges=16)
    return pages.page(100, 50)


# --- Ingest ----------------------------------------------------------------------------------


# A tenth of the lines each has a price that is no number, a time that is none, too few fields.
_LINES_SQL = """WITH lines AS (
    SELECT event_id % 10 AS kind, value AS price,
      CASE WHEN event_id % 10 = 5 THEN user_id || ',' || event_type
      ELSE user_id || ',' || event_type || ','
        || CASE WHEN event_id % 10 = 4 THEN '2024-13-45' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END
        || ',' || CASE WHEN event_id % 10 = 3 THEN 'n/a' ELSE CAST(value AS VARCHAR) END
        || ',1.0,2.0,0.0,0.0,3.0,4.0' END AS line FROM events)
  SELECT CASE WHEN kind IN (3, 4, 5) THEN line END AS line,
    CASE WHEN kind IN (3, 5) THEN 'malformed line' WHEN kind = 4 THEN 'bad time' END AS reason,
    CASE WHEN kind NOT IN (3, 4, 5) THEN price END AS price_usd
  FROM lines"""


def _mixed_lines(spark: SparkSession, folder: str) -> str:
    """Good and bad lines as CSV files, some beginning with a header."""
    kind = F.col("event_id") % 10
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    user = F.col("user_id").cast("string")
    whole = F.concat_ws(
        ",",
        user,
        "event_type",
        F.when(kind == 4, "2024-13-45").otherwise(at),
        F.when(kind == 3, "n/a").otherwise(F.col("value").cast("string")),
        F.lit("1.0,2.0,0.0,0.0,3.0,4.0"),
    )
    line = F.when(kind == 5, F.concat_ws(",", user, "event_type")).otherwise(whole)
    path = scratch_path(spark, "lines")
    lines = _table(spark, folder, "events").select(line.alias("value"))
    lines.write.text(path)
    header = spark.createDataFrame([(",".join(SNAPSHOT_COLUMNS),), ("  ",)], "value string")
    header.write.mode("append").text(path)
    return path


def _all_lines(good: DataFrame, rejected: DataFrame) -> DataFrame:
    return rejected.select("line", "reason").unionByName(
        good.select("price_usd"), allowMissingColumns=True
    )


@_query("csv_rejects", _LINES_SQL)
def _(spark, folder):
    """Accepted rows and rejected lines of one pass: together all lines."""
    landed = scratch_path(spark, "landed")
    return _all_lines(*ingest.land_lines(spark, _mixed_lines(spark, folder), landed))


# --- Ingest of payloads ----------------------------------------------------------------------


def _market_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One market list per event: supply given, missing (view) or null (click) by event type."""
    supply = (
        F.when(F.col("event_type") == "view", F.lit(""))
        .when(F.col("event_type") == "click", F.lit(',"total_supply":null'))
        .otherwise(F.concat(F.lit(',"total_supply":'), F.col("value").cast("string")))
    )
    text = F.concat(
        F.format_string('[{"id":"e%d","name":"Asset %d"', "event_id", "event_id"),
        F.format_string(',"symbol":"%s"', "event_type"),
        supply,
        F.lit("}]"),
    )
    return _table(spark, folder, "events").select(text.alias("payload"))


@_query(
    "market_payloads",
    """SELECT 'e' || event_id AS id, 'Asset ' || event_id AS name, upper(event_type) AS symbol,
         CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN NULL ELSE value END AS total_supply,
         CAST(0 AS DOUBLE) AS circulating_supply
       FROM events""",
)
def _(spark, folder):
    return ingest.market_rows(_market_payloads(spark, folder))


@_query(
    "payload_flatten",
    """SELECT 'Asset ' || user_id AS cryptocurrency, 'U' || user_id AS symbol,
         strftime(ts, '%Y-%m-%d 00:00:00') AS date, value AS price_usd,
         CAST(0 AS DOUBLE) AS market_cap,
         CASE event_type WHEN 'view' THEN 0
           ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS volume_24h,
         CAST(0 AS DOUBLE) AS price_change_percent_24h,
         CAST(0 AS DOUBLE) AS price_change_percent_7d,
         CAST(user_id AS DOUBLE) AS total_supply, CAST(0 AS DOUBLE) AS circulating_supply
       FROM events WHERE event_type <> 'error'""",
)
def _(spark, folder):
    events = _table(spark, folder, "events")
    markets = (
        events.select("user_id")
        .distinct()
        .select(
            F.format_string(
                '[{"id":"%d","name":"Asset %d","symbol":"u%d","total_supply":%d}]',
                *["user_id"] * 4,
            ).alias("payload")
        )
    )
    volume = F.when(F.col("event_type") == "view", F.lit("")).otherwise(
        F.format_string(',"total_volume":{"usd":%s}', F.get_json_object("props", "$.k"))
    )
    payload = F.when(F.col("event_type") == "error", F.lit("service unavailable")).otherwise(
        F.concat(
            F.lit('{"market_data":{"current_price":{"usd":'),
            F.col("value").cast("string"),
            F.lit("}"),
            volume,
            F.lit("}}"),
        )
    )
    histories = events.select(
        F.col("user_id").cast("string").alias("id"),
        F.to_date("ts").alias("day"),
        payload.alias("payload"),
    )
    return ingest.ingest_payloads(markets, histories)


_SPINE = """WITH days AS (
    SELECT CAST(unnest(
      generate_series(DATE '{end}' - 29, DATE '{end}', INTERVAL 1 DAY)) AS DATE) AS day)
  SELECT c_custkey AS asset, day FROM customer CROSS JOIN days """
# The window of the first date reaches two weeks past the last order; the second date is amid them.
_LATE, _AMID = "2001-08-16", "1998-08-02"


@_query(
    "backfill_plan",
    _SPINE.format(end=_LATE)
    + "WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)",
)
def _(spark, folder):
    return _order_backfill(spark, folder, _table(spark, folder, "orders"), "day", _LATE)


@_query(
    "backfill_plan_by_asset",
    _SPINE.format(end=_AMID)
    + """WHERE NOT EXISTS (SELECT 1 FROM orders
           WHERE o_custkey = c_custkey AND CAST(o_orderdate AS DATE) = day)""",
)
def _(spark, folder):
    return _order_backfill(spark, folder, _table(spark, folder, "orders"), "asset", _AMID)


def _order_backfill(
    spark: SparkSession, folder: str, orders: DataFrame, grain: str, end: str
) -> DataFrame:
    universe = _table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"))
    loaded = orders.select(
        F.col("o_custkey").alias("asset"), F.to_date("o_orderdate").alias("day")
    )
    return ingest.backfill_plan(universe, loaded, end, 30, grain)


@_query("csv_line_roundtrip", _BY_USER + _TICK_ROWS)
def _(spark, folder):
    lines = _text_ticks(spark, folder).select(
        columns_to_line(*SNAPSHOT_COLUMNS).cast("binary").alias("value")
    )
    return lines.select(line_to_struct(F.col("value")).alias("data")).select(
        *[f"data.{c}" for c in SNAPSHOT_COLUMNS]
    )


# --- Streams ---------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.readStream.schema(_table(spark, folder, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )


@_query(
    "stream_anomalies",
    _BY_USER + "SELECT * FROM ticks WHERE abs(price_change_percent_24h) >= 3",
)
def _(spark, folder):
    rows = _to_ticks(_event_stream(spark, folder), "user_id").withColumn(
        TIME, F.date_format(TIME, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    lines = rows.select(columns_to_line(*SNAPSHOT_COLUMNS).cast("binary").alias("value"))
    found = streaming.run_available(
        streaming.stream_anomalies(lines),
        scratch_path(spark, "anomalies"),
        scratch_path(spark, "anomalies-state"),
    )
    return found.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


@_query(
    "stream_relay",
    _BY_USER + _TICK_ROWS,
)
def _(spark, folder):
    spool, relayed = scratch_path(spark, "spool"), scratch_path(spark, "relayed")
    sinks.append_lines(_text_ticks(spark, folder), spool)
    streaming.relay_to_lines(
        streaming.spool_lines(spark, spool, files_per_batch=4),
        relayed,
        scratch_path(spark, "relay-state"),
        once=True,
    ).awaitTermination()
    return ingest.ingest_snapshots(spark, relayed)[0]


@_query("stream_rejects", _LINES_SQL)
def _(spark, folder):
    """As ``csv_rejects``, from a stream over the files."""
    landed, state = scratch_path(spark, "landed"), scratch_path(spark, "landed-state")
    lines = streaming.spool_lines(spark, _mixed_lines(spark, folder), "*", files_per_batch=3)
    checked = sources.checked_lines(lines)
    sinks.stream_checked(checked, landed, state, available_only=True).awaitTermination()
    return _all_lines(sinks.read_accepted(spark, landed), sinks.read_rejected(spark, landed))


def _write_parts(parts: list[DataFrame], path: str, files: int = 4) -> None:
    """Write parts one after the other, each as so many files: a stream takes them in this order."""
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)


# Events come a week at a time. A quarter of them is sent again with the next week. Some come late
# for the first time: from a week's last day with the next week, which is within the two days that
# the stream waits, and from its first two days a week later still, too late unless time stood still.
_WEEKS_SQL = """WITH sent AS (
    SELECT *, day // 7 + CASE WHEN event_id % 5 <> 1 THEN 0 WHEN day % 7 = 6 THEN 1
        WHEN day % 7 IN (0, 1) THEN 2 ELSE 0 END AS batch
    FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day FROM events)
  ), seen AS (
    SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - INTERVAL 2 DAY AS late FROM sent GROUP BY batch
  )
  SELECT event_id, user_id, ts, event_type, value, props FROM sent JOIN seen USING (batch)
  WHERE late IS NULL OR date_trunc('millisecond', ts) > date_trunc('millisecond', late)"""


@_query("stream_without_repeats", _WEEKS_SQL)
def _(spark, folder):
    """Repeats dropped by keyed state, over a restart; what comes too late is dropped as well."""
    events = _table(spark, folder, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    week = F.floor(day / 7)
    late = F.when(day % 7 == 6, 1).when(day % 7 < 2, 2).otherwise(0)
    batch = week + F.when(F.col("event_id") % 5 == 1, late).otherwise(0)
    again = (F.col("event_id") % 4 == 0) & (batch == week)

    def sent(number: int) -> DataFrame:
        first = events.filter(batch == number)
        return first.unionByName(events.filter(again & (week == number - 1)))

    spool = scratch_path(spark, "weeks")
    out, state = scratch_path(spark, "distinct"), scratch_path(spark, "distinct-state")
    # A batch a week. The stream ends after two weeks, and goes on with its state when more came.
    for weeks in (range(2), range(2, 7)):
        _write_parts([sent(number) for number in weeks], spool)
        rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(spool)
        timed = rows.withColumn("ts", F.col("ts").cast("timestamp"))
        once = streaming.without_repeats(timed, ["event_id"], "2 days", "ts")
        found = streaming.run_available(once, out, state)
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_SPOOL_SEED, _SPOOL_BATCHES = 7, 3


def _spool_sql() -> str:
    """The folders that hold enough rows, from the batch's own on, and of these the first by hash."""
    starts = [zlib.crc32(f"{_SPOOL_SEED}:{b}".encode()) % 16 for b in range(_SPOOL_BATCHES)]
    one = """SELECT {b} AS batch, event_id || ',' || user_id || ',' || event_type AS value FROM (
        SELECT e.* FROM dealt AS e JOIN (
          SELECT draw FROM (SELECT draw, sum(n) OVER (ORDER BY (turn - {start} + 16) % 16
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM folders)
          WHERE before IS NULL OR before < 100) USING (draw)
        ORDER BY md5('{seed}:' || event_id), event_id LIMIT 100)"""
    parts = [one.format(b=b, start=s, seed=_SPOOL_SEED + b) for b, s in enumerate(starts)]
    return f"""WITH dealt AS (
        SELECT *, substr(md5('{_SPOOL_SEED}:' || event_id), 1, 1) AS draw FROM events),
      folders AS (SELECT draw, count(*) AS n, instr('0123456789abcdef', draw) - 1 AS turn
        FROM dealt GROUP BY draw)
      """ + " UNION ALL ".join(parts)


@_query("spool_batches", _spool_sql())
def _(spark, folder):
    """The sample spooler under its trigger: three batches, each from a sixteenth of the table."""
    rows = _table(spark, folder, "events").select("event_id", "user_id", "event_type")
    draws = streaming.deal(rows, scratch_path(spark, "dealt"), "event_id", _SPOOL_SEED, digits=1)
    due, path = scratch_path(spark, "ticks"), scratch_path(spark, "samples")
    _write_parts([rows.filter(F.col("event_id") % 3 == i) for i in range(_SPOOL_BATCHES)], due)
    ticks = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(due)
    state = scratch_path(spark, "samples-state")
    streaming.spool_draws(
        ticks, draws, path, state, "event_id", 100, every=None, seed=_SPOOL_SEED
    ).awaitTermination()
    return spark.read.schema("value string, batch int").text(path)


@_query(
    "stream_progress",
    """SELECT 'good' AS stream, event_id % 3 AS batch, count(*) AS n_rows, false AS failed
         FROM events GROUP BY 2
       UNION ALL
       SELECT 'bad', 0, count(*), true FROM events WHERE event_id % 3 = 0""",
)
def _(spark, folder):
    """Rows per batch of two streams at once. One fails in its second batch, the other goes on."""
    events = _table(spark, folder, "events").select("event_id")
    path = scratch_path(spark, "progress")
    _write_parts([events.filter(F.col("event_id") % 3 == i) for i in range(3)], path)

    def started(name: str, rows: DataFrame):
        out, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
        return streaming.write_parquet(rows, out, state, available_only=True)

    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(path)
    bad = F.when(F.col("event_id") % 3 == 1, F.raise_error(F.lit("bad event")).cast("long"))
    queries = {
        "good": started("good", rows),
        "bad": started("bad", rows.withColumn("event_id", F.coalesce(bad, "event_id"))),
    }
    seen = streaming.run_together(queries, drain=True, timeout=600)
    found = [(name, batch, n, name in seen.errors) for (name, batch), n in seen.rows.items()]
    return spark.createDataFrame(found, "stream string, batch long, n_rows long, failed boolean")
