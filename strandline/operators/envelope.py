"""From raw change events to typed changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import decode

# The operation codes of a change event.
SNAPSHOT, CREATE, UPDATE, DELETE = "r", "c", "u", "d"
INSERTS = (SNAPSHOT, CREATE)
WRITES = (SNAPSHOT, CREATE, UPDATE)


@dataclass(frozen=True)
class Decimal:
    precision: int
    scale: int


@dataclass(frozen=True)
class Entity:
    """What a change event says about one kind of row.

    ``fields`` maps a column to its type: a Spark type name read as it is, or
    ``epoch_days``, ``zoned_timestamp`` or :class:`Decimal` for encoded ones.
    """

    key: str
    fields: Mapping[str, str | Decimal]

    @property
    def columns(self) -> list[str]:
        return list(self.fields)

    def only(self, columns: Sequence[str]) -> Entity:
        """The entity with its key and the given fields."""
        if unknown := set(columns) - set(self.fields):
            raise ValueError(f"no such fields: {sorted(unknown)}")
        wanted = {self.key, *columns}
        return Entity(self.key, {name: kind for name, kind in self.fields.items() if name in wanted})


METER_READINGS = Entity(
    key="reading_id",
    fields={
        "reading_id": "bigint",
        "facility_id": "bigint",
        "reading_timestamp": "zoned_timestamp",
        "reported_kwh": Decimal(12, 3),
        "corrected": "boolean",
        "correction_reason": "string",
    },
)

INVESTMENTS = Entity(
    key="investment_id",
    fields={
        "investment_id": "bigint",
        "facility_id": "bigint",
        "investment_date": "epoch_days",
        "amount_eur": Decimal(14, 2),
        "category": "string",
        "status": "string",
    },
)

FACILITIES = Entity(
    key="facility_id",
    fields={
        "facility_id": "bigint",
        "name": "string",
        "sector": "string",
        "region": "string",
        "annual_consumption_mwh": Decimal(12, 3),
        "subsidy_eligible": "boolean",
    },
)

# Where an event lies in the log, and when we first saw it.
LINEAGE = {"partition": "bronze_partition", "offset": "bronze_offset", "ingested_at": "ingested_at"}
LOG_ORDER = ("cdc_timestamp", "bronze_partition", "bronze_offset")


def _json_schema(entity: Entity) -> str:
    """The parts of an event that are read, as text; with and without a wrapper.

    Some connectors send the body as ``{"schema": …, "payload": body}``. Text
    takes any JSON value, so an unexpected type is left to the cast, which
    gives NULL for that one field.
    """
    after = ", ".join(f"`{name}`: string" for name in entity.fields)
    parts = {
        "op": "string",
        "ts_ms": "string",
        "after": f"struct<{after}>",
        "before": f"struct<`{entity.key}`: string>",
    }
    body = ", ".join(f"{name}: {kind}" for name, kind in parts.items())
    return f"payload struct<{body}>, " + ", ".join(f"{n} {kind}" for n, kind in parts.items())


def extract_changes(log: DataFrame, entity: Entity) -> DataFrame:
    """Pull an entity's fields out of the JSON text, still in their encodings.

    A delete carries its key in the before-image only. Text that is not JSON,
    and tombstones, leave NULLs. ``inline`` keeps later filters above the
    parser: pushed below it, they would parse every event a second time.
    """
    events = log.select(
        *[F.col(c).alias(name) for c, name in LINEAGE.items() if c in log.columns],
        F.inline(F.array(F.from_json("value", _json_schema(entity)))),
    )

    def read(path: str) -> Column:
        return F.coalesce(F.col(f"payload.{path}"), F.col(path))

    fields = []
    for name, kind in entity.fields.items():
        text = read(f"after.{name}")
        if name == entity.key:
            text = F.coalesce(text, read(f"before.{name}"))
        plain = text.try_cast(kind) if kind in ("bigint", "boolean") else text
        fields.append(plain.alias(name))
    return events.select(
        read("op").alias("operation"),
        read("ts_ms").try_cast("bigint").alias("cdc_timestamp_ms"),
        *fields,
        *lineage_names(log),
    )


def lineage_names(log: DataFrame) -> list[str]:
    return [name for c, name in LINEAGE.items() if c in log.columns]


def keep_operations(changes: DataFrame, operations: tuple[str, ...] = WRITES) -> DataFrame:
    """Keep the given operations; a tombstone has none and always goes."""
    return changes.where(F.col("operation").isin(*operations))


def decode_fields(changes: DataFrame, entity: Entity) -> DataFrame:
    """Turn encoded fields into typed ones."""
    typed = []
    for name, kind in entity.fields.items():
        column = F.col(name)
        if isinstance(kind, Decimal):
            column = decode.decode_decimal(column, kind.precision, kind.scale)
        elif kind == "epoch_days":
            column = decode.decode_epoch_days(column)
        elif kind == "zoned_timestamp":
            column = decode.decode_zoned_timestamp(column)
        typed.append(column.alias(name))
    rest = [c for c in changes.columns if c not in {*entity.fields, "operation", "cdc_timestamp_ms"}]
    return changes.select(
        *typed,
        "operation",
        decode.decode_epoch_millis(F.col("cdc_timestamp_ms")).alias("cdc_timestamp"),
        *rest,
    )


def read_changes(
    log: DataFrame,
    entity: Entity,
    operations: tuple[str, ...] = WRITES,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Extract, filter and decode: the whole step from log to typed changes.

    Of the entity's fields only ``columns`` and the key are parsed, where given: the
    planner doesn't see into the parser, and would have it read all of them.
    """
    if columns is not None:
        entity = entity.only(columns)
    return decode_fields(keep_operations(extract_changes(log, entity), operations), entity)


def operation_breakdown(changes: DataFrame) -> DataFrame:
    return changes.groupBy("operation").agg(F.count("*").alias("events"))


def split_counts(changes: DataFrame) -> DataFrame:
    """How many events insert and how many update, in one pass."""
    return changes.agg(
        F.count_if(F.col("operation").isin(*INSERTS)).alias("inserts"),
        F.count_if(F.col("operation") == UPDATE).alias("updates"),
    )


def latest_per_key(changes: DataFrame, key: str, order_by: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """The newest change of each key; combines before the shuffle, so no key is too large."""
    rest = [c for c in changes.columns if c != key]
    order = F.struct(*[F.col(c) for c in order_by])
    newest = changes.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("newest"))
    return newest.select(key, *[F.col("newest")[c].alias(c) for c in rest])
