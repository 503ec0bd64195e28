"""Hourly price blocks: JSON text with ``{"series": [[epoch_ms, price], …]}``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.decode import decode_epoch_millis

# Decimals, so that rounding is exact; 24 digits also hold an epoch in ms.
BLOCK_SCHEMA = "series array<array<decimal(24,6)>>"


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks from JSON files, one document per file or per line."""
    return spark.read.schema(BLOCK_SCHEMA).json(path)


def parse_blocks(blocks: DataFrame, text: str) -> DataFrame:
    """Blocks from a text column, keeping the other columns."""
    rest = [c for c in blocks.columns if c != text]
    parsed = F.from_json(F.col(text), BLOCK_SCHEMA)["series"]
    return blocks.select(*rest, parsed.alias("series"))


def select_blocks(index: DataFrame, start: str, first: dt.datetime, last: dt.datetime) -> DataFrame:
    """Blocks that begin within a closed range.

    Stored partitioned by ``start``, this prunes partitions before any block is read.
    """
    return index.where(F.col(start).between(F.lit(first), F.lit(last)))


def price_series(
    blocks: DataFrame, first: Column, last: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per known price in a closed time range."""
    point = F.col("point")
    at = decode_epoch_millis(F.get(point, F.lit(0)))
    price = F.get(point, F.lit(1))
    # The outer form: the plain one filters by size first, parsing each block twice.
    points = blocks.select(*keep, F.explode_outer("series").alias("point"))
    return points.where(price.isNotNull() & at.between(first, last)).select(
        *keep,
        at.alias("price_timestamp"),
        F.round(price, 2).cast("decimal(10,2)").alias("price_eur_per_mwh"),
        F.round(price / 1000, 6).cast("decimal(10,6)").alias("price_eur_per_kwh"),
    )


def price_summary(prices: DataFrame) -> DataFrame:
    mwh = F.col("price_eur_per_mwh")
    return prices.agg(
        F.count("*").alias("price_count"),
        F.min("price_timestamp").alias("first_price_at"),
        F.max("price_timestamp").alias("last_price_at"),
        F.round(F.avg(mwh), 2).cast("decimal(11,2)").alias("avg_price_eur_per_mwh"),
        F.round(F.avg("price_eur_per_kwh"), 4).cast("decimal(11,4)").alias("avg_price_eur_per_kwh"),
        F.min(mwh).alias("min_price_eur_per_mwh"),
        F.max(mwh).alias("max_price_eur_per_mwh"),
    )


def complete_days_only(
    prices: DataFrame, at: str = "price_timestamp", series: Sequence[str] = (), hours: int = 24
) -> DataFrame:
    """Keep the days that have every hour.

    A day's hours are the bits of one number, which one aggregation puts together
    before and after its shuffle; the list of complete days then filters the rows.
    """
    day = F.col(at).cast("date")
    seen = F.bit_count(F.bit_or(F.expr(f"shiftleft(1, hour({at}))")))
    complete = (
        prices.groupBy(*series, day.alias("__day"))
        .agg(seen.alias("__hours"))
        .where(F.col("__hours") == hours)
        .select(*series, "__day")
    )
    return prices.withColumn("__day", day).join(complete, [*series, "__day"], "left_semi").drop("__day")
