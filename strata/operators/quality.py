"""Data-quality checks and their runner.

A check is a query whose rows are failures. Each one also says what it looked at: a
check over nothing is vacuous, and vacuous is not passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnRule:
    """A row-level rule: ``failing`` marks the bad rows."""

    name: str
    failing: Column


def not_null(column: str) -> ColumnRule:
    return ColumnRule(f"not_null_{column}", F.col(column).isNull())


def at_least(column: str, minimum) -> ColumnRule:
    """Inclusive lower bound; NULL passes, as the comparison is not true."""
    return ColumnRule(f"between_{column}", F.col(column) < F.lit(minimum))


def rule_tally(table: str, rows: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """All row-level rules of one table, tallied in one pass over it."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("population"),
        *[F.count_if(r.failing).alias(f"f{i}") for i, r in enumerate(rules)],
    )
    per_rule = F.array(
        *[
            F.struct(F.lit(f"{table}.{r.name}").alias("check_name"), F.col(f"f{i}").alias("failures"))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select("population", F.inline(per_rule)).select("check_name", "population", "failures")


def duplicates(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once. A NULL in a single key is no value."""
    keyed = rows.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else rows
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_keys(models: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per key, across several tables: (model, key as text, rows)."""
    found = [
        duplicates(rows, [key]).select(F.lit(model).alias("model"), F.col(key).cast("string").alias("k"), "n")
        for model, rows, key in models
    ]
    return reduce(DataFrame.unionByName, found)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference has no parent; a NULL reference passes."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def wrongly_picked(
    entity: str, silver: DataFrame, bronze: DataFrame, key: str, recency: Sequence[str]
) -> DataFrame:
    """Current rows that are not the most recent of their key.

    The whole recency is compared, not its first part only (an addition: a stale file on
    the right date is just as wrong).
    """
    best = bronze.groupBy(key).agg(F.max(F.struct(*recency)).alias("available"))
    picked = silver.select(key, F.struct(*recency).alias("picked"))
    return (
        picked.join(best, key)
        .filter(F.col("picked") != F.col("available"))
        .select(F.lit(entity).alias("entity"), F.col(key).cast("string").alias("k"), "picked", "available")
    )


def headcount_gap(employees: DataFrame, gold: DataFrame) -> DataFrame:
    """Expected against counted people: a row when they differ, or when gold is empty or NULL.

    The two totals are tagged and summed in one aggregate; SUM over nothing stays NULL,
    and NULL fails.
    """
    zero = F.lit(None).cast("bigint")
    one = F.lit(1).cast("bigint")
    expected = employees.filter("is_employed").select(one.alias("e"), zero.alias("a"), zero.alias("g"))
    actual = gold.select(zero.alias("e"), F.col("headcount_people").cast("bigint").alias("a"), one.alias("g"))
    totals = expected.unionByName(actual).agg(
        F.count("e").alias("expected"), F.sum("a").alias("actual"), F.count("g").alias("rows_in_gold")
    )
    return totals.filter(
        F.col("actual").isNull() | (F.col("rows_in_gold") == 0) | (F.col("expected") != F.col("actual"))
    )


# Names that leave open which of several definitions is meant.
AMBIGUOUS_NAMES = ("headcount", "people", "staff", "employees", "count", "fte")
# Columns that count as measures, and the least a description must say.
MEASURE_PATTERNS = ("headcount%", "salary%", "%count")
MIN_DESCRIPTION = 10


def offenders(columns: DataFrame, failing: Column, label: str = "verdict") -> DataFrame:
    """'yes' when no column fails, else the comma-joined ``table.column`` list."""
    bad = columns.filter(failing).select(F.concat_ws(".", "table_name", "column_name").alias("name"))
    listed = bad.agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))
    return listed.select(F.when(F.col("names") == "", "yes").otherwise(F.col("names")).alias(label))


def ambiguous_names(columns: DataFrame) -> DataFrame:
    return offenders(columns, F.lower("column_name").isin(*AMBIGUOUS_NAMES))


def undocumented_measures(columns: DataFrame) -> DataFrame:
    measure = reduce(lambda a, b: a | b, [F.col("column_name").like(p) for p in MEASURE_PATTERNS])
    short = F.col("comment").isNull() | (F.length(F.trim("comment")) < MIN_DESCRIPTION)
    return offenders(columns, measure & short)


def tally(name: str, failures: DataFrame, population: DataFrame) -> DataFrame:
    """One result row: how much was looked at, how much failed."""
    bad = failures.select(F.lit(0).alias("p"), F.lit(1).alias("f"))
    seen = population.select(F.lit(1).alias("p"), F.lit(0).alias("f"))
    both = bad.unionByName(seen).agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("population"), F.coalesce(F.sum("f"), F.lit(0)).alias("failures")
    )
    return both.select(F.lit(name).alias("check_name"), "population", "failures")


def key_tally(name: str, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and duplicate keys of a table, from one pass over it. A NULL in a single key is no value."""
    per_key = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    twice = F.col("n") > 1
    if len(columns) == 1:
        twice = twice & F.col(columns[0]).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("population"), F.count_if(twice).alias("failures")
    ).select(F.lit(name).alias("check_name"), "population", "failures")


def results(tallies: Sequence[DataFrame]) -> DataFrame:
    """Every check with its verdict: failed, vacuous (nothing to look at) or passed."""
    status = (
        F.when(F.col("failures") > 0, "failed").when(F.col("population") == 0, "vacuous").otherwise("passed")
    )
    return reduce(DataFrame.unionByName, tallies).withColumn("status", status)


class ChecksFailed(Exception):
    """At least one check failed, was vacuous or did not run."""


def require(outcome: DataFrame, expected: int) -> list:
    """Raise unless exactly ``expected`` checks ran and all passed; returns their rows."""
    rows = outcome.collect()  # one row per check
    bad = [f"{r.check_name}: {r.status} ({r.failures} of {r.population})" for r in rows if r.status != "passed"]
    if len(rows) != expected:
        bad.append(f"{len(rows)} checks ran, {expected} expected")
    if bad:
        raise ChecksFailed("; ".join(bad))
    return rows
