"""Column names, types and fixed values of the price panel."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten columns of a price snapshot, in file order.
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("cryptocurrency", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("volume_24h", T.DoubleType()),
        T.StructField("price_change_percent_24h", T.DoubleType()),
        T.StructField("price_change_percent_7d", T.DoubleType()),
        T.StructField("total_supply", T.DoubleType()),
        T.StructField("circulating_supply", T.DoubleType()),
    ]
)
SNAPSHOT_COLUMNS = SNAPSHOT_SCHEMA.names

ASSET, SYMBOL, TIME = "cryptocurrency", "symbol", "date"
PRICE, CAP, VOLUME = "price_usd", "market_cap", "volume_24h"
CHANGE_1, CHANGE_7 = "price_change_percent_24h", "price_change_percent_7d"
PREV_1, PREV_7 = "prev_price_24h", "prev_price_7d"
SEGMENT, AVG_7, AVG_30 = "segment", "avg_price_7d", "avg_price_30d"

SNAPSHOT_KEY = [ASSET, SYMBOL, TIME]

# Holds the raw line of a row that did not fit the schema.
CORRUPT = "_corrupt_record"

# Why a line was rejected; null for an accepted one.
REASON = "reason"
MALFORMED, BAD_TIME = "malformed line", "bad time"

# Upper-case symbols of the stable segment, and the two segment labels.
STABLE_SYMBOLS = ("USDT", "USDC", "DAI", "USDS", "BSC-USD", "USDE")
STABLE, VOLATILE = "stablecoin", "volatile"

# Fixed value: a change of at least this many percent, up or down, is an anomaly.
ANOMALY_PERCENT = 3.0

# Row offsets of the two change columns and day lengths of the two trailing means.
LAG_ROWS = {PREV_1: 1, PREV_7: 7}
TRAILING_DAYS = {AVG_7: 7, AVG_30: 30}

DAY_SECONDS = 86_400

# The feature table as the batch job writes it: time as an instant, and five columns more.
FEATURE_SCHEMA = T.StructType(
    [T.StructField(f.name, T.TimestampType()) if f.name == TIME else f for f in SNAPSHOT_SCHEMA]
    + [T.StructField(PREV_1, T.DoubleType()), T.StructField(PREV_7, T.DoubleType())]
    + [T.StructField(SEGMENT, T.StringType())]
    + [T.StructField(AVG_7, T.DoubleType()), T.StructField(AVG_30, T.DoubleType())]
)
FEATURE_COLUMNS = FEATURE_SCHEMA.names
