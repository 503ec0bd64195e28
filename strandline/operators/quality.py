"""Declarative data-quality rules, counted in as few passes as they allow."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: DataFrame
    parent_column: str


class QualityError(RuntimeError):
    """At least one rule has failures."""


def check(table: DataFrame, table_name: str, rules: Sequence) -> DataFrame:
    """One row per rule: table_name, rule, column_name, failures.

    All row-wise rules of a table share one scan and one row of counts. Unique
    counts the values that occur more than once, and a foreign key the rows
    whose value has no parent; both group before they compare, so a value that
    fills the table is one row by then.
    """
    parts = []
    row_wise = [r for r in rules if isinstance(r, (NotNull, AcceptedValues))]
    if row_wise:
        counts, labels = [], []
        for number, rule in enumerate(row_wise):
            if isinstance(rule, NotNull):
                failing, label = F.col(rule.column).isNull(), "not_null"
            else:
                failing, label = ~F.col(rule.column).isin(*rule.values), "accepted_values"
            counts.append(F.count_if(failing).alias(f"failures_{number}"))
            labels.append(
                F.struct(
                    F.lit(label).alias("rule"),
                    F.lit(rule.column).alias("column_name"),
                    F.col(f"failures_{number}").alias("failures"),
                )
            )
        parts.append(table.agg(*counts).select(F.inline(F.array(*labels))))
    for rule in rules:
        if isinstance(rule, Unique):
            repeated = (
                table.where(F.col(rule.column).isNotNull())
                .groupBy(rule.column)
                .count()
                .where("count > 1")
            )
            parts.append(_one_row("unique", rule.column, repeated, F.count("*")))
        elif isinstance(rule, ForeignKey):
            used = table.where(F.col(rule.column).isNotNull()).groupBy(rule.column).count()
            parent = rule.parent.select(F.col(rule.parent_column).alias(rule.column))
            orphans = used.join(parent, rule.column, "left_anti")
            total = F.coalesce(F.sum("count"), F.lit(0))
            parts.append(_one_row("foreign_key", rule.column, orphans, total))
        elif not isinstance(rule, (NotNull, AcceptedValues)):
            raise TypeError(f"not a rule: {rule!r}")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(F.lit(table_name).alias("table_name"), "rule", "column_name", "failures")


def _one_row(rule: str, column: str, failing: DataFrame, failures) -> DataFrame:
    return failing.agg(failures.cast("bigint").alias("failures")).select(
        F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), "failures"
    )


def check_all(*results: DataFrame) -> DataFrame:
    combined = results[0]
    for result in results[1:]:
        combined = combined.unionByName(result)
    return combined


def gate(results: DataFrame) -> DataFrame:
    """Raise if any rule has failures, else pass the results on.

    ``results`` has one row per declared rule, so collecting it is safe.
    """
    rows = results.collect()
    failed = [r for r in rows if r["failures"]]
    if failed:
        raise QualityError(
            "; ".join(
                f"{r['table_name']}.{r['column_name']} {r['rule']}: {r['failures']}" for r in failed
            )
        )
    return results.sparkSession.createDataFrame(rows, results.schema)
