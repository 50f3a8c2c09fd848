"""Raw files and payloads to price rows, and the list of what is still to load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_start_text, field, field_or
from ..operators.quality import drop_duplicate_keys
from ..schema import ASSET, REASON, SNAPSHOT_COLUMNS, TIME
from ..sinks.checked import read_accepted, read_rejected, write_checked
from ..sources.files import checked_lines, read_lines


def ingest_snapshots(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Price rows of all CSV files under a path; and rejected lines with their file and reason.

    Each of the two reads the files when it is used. ``land_lines`` makes both in one pass.
    """
    checked = checked_lines(read_lines(spark, path))
    good = checked.filter(F.col(REASON).isNull()).select(*SNAPSHOT_COLUMNS)
    rejected = checked.filter(F.col(REASON).isNotNull()).select("line", REASON, "origin")
    return good, rejected


def land_lines(spark: SparkSession, path: str | list[str], folder: str) -> tuple[DataFrame, DataFrame]:
    """As ``ingest_snapshots``, from one pass over the files that writes both."""
    write_checked(checked_lines(read_lines(spark, path)), folder)
    return read_accepted(spark, folder), read_rejected(spark, folder)


def market_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Market lists (JSON arrays of assets) to one row per asset.

    A missing supply becomes 0.0, an explicit null stays null. Assets without id, name or symbol,
    and texts that are no JSON array, give no row.
    """
    asset = F.col("_asset")
    return (
        raw.select(
            F.explode(
                F.try_variant_get(F.try_parse_json(payload), "$", "array<variant>")
            ).alias("_asset")
        )
        .select(
            field(asset, "$.id", "string").alias("id"),
            field(asset, "$.name", "string").alias("name"),
            F.upper(field(asset, "$.symbol", "string")).alias("symbol"),
            field_or(asset, "$.total_supply", "double", 0.0).alias("total_supply"),
            field_or(asset, "$.circulating_supply", "double", 0.0).alias("circulating_supply"),
        )
        .na.drop(subset=["id", "name", "symbol"])
    )


def history_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """History payloads (one JSON object per asset and day) to price, cap and volume.

    ``raw`` has ``id``, ``day`` and the payload. Missing figures become 0.0; a text that is no
    JSON object gives no row.
    """
    parsed = raw.withColumn("_payload", F.try_parse_json(payload)).filter(
        F.schema_of_variant("_payload").startswith("OBJECT")
    )
    usd = {
        "price_usd": "$.market_data.current_price.usd",
        "market_cap": "$.market_data.market_cap.usd",
        "volume_24h": "$.market_data.total_volume.usd",
    }
    return parsed.select(
        "id",
        "day",
        *[field_or(F.col("_payload"), path, "double", 0.0).alias(c) for c, path in usd.items()],
    )


def ingest_payloads(markets: DataFrame, histories: DataFrame) -> DataFrame:
    """Market lists and history payloads to snapshot rows; change columns are 0.0."""
    return (
        history_rows(histories)
        .join(drop_duplicate_keys(market_rows(markets), ["id"]), "id")
        .select(
            F.col("name").alias(ASSET),
            "symbol",
            day_start_text(F.col("day")).alias(TIME),
            "price_usd",
            "market_cap",
            "volume_24h",
            F.lit(0.0).alias("price_change_percent_24h"),
            F.lit(0.0).alias("price_change_percent_7d"),
            "total_supply",
            "circulating_supply",
        )
    )


def backfill_plan(
    universe: DataFrame,
    loaded: DataFrame,
    today: str,
    days: int = 30,
    grain: str = "day",
) -> DataFrame:
    """(asset, day) pairs of the last ``days`` days, today included, that are still to load.

    ``universe`` has ``asset``; ``loaded`` has ``asset`` and ``day``. ``grain="day"`` skips a day
    once anything of it is loaded, ``"asset"`` finds assets missing inside a loaded day. The days
    are unfolded from a constant list on each asset, so nothing is joined to build the pairs.
    """
    if grain not in ("day", "asset"):
        raise ValueError("grain is 'day' or 'asset'")
    last = F.lit(today).cast("date")
    first = F.date_sub(last, days - 1)
    wanted = universe.select("asset").withColumn(
        "day", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    )
    recent = loaded.filter(F.col("day").between(first, last))
    if grain == "day":
        # At most ``days`` distinct values are left.
        return wanted.join(F.broadcast(recent.select("day").distinct()), "day", "left_anti").select(
            "asset", "day"
        )
    return wanted.join(recent.select("asset", "day").distinct(), ["asset", "day"], "left_anti")
