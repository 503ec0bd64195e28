"""Registration of queries and of the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strandline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def without_zone(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time, which is what plain SQL timestamps are."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_zone(build(configure(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
