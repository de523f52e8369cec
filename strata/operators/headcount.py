"""Gold: people and cost per department. The only layer that joins.

Gold can be kept up to date from the buckets of silver that changed: per department, what their rows added up to
before is taken away and what they add up to now is put in. The sums behind the answers are exact and stored with
them, out of sight.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.upsert import Keyed, Snapshot
from strata.sources.target import Target

# Fixed value: the employment type that counts as full time.
FULL_TIME = "full_time"


def staff_by_department(employees: DataFrame) -> DataFrame:
    """Aggregates of the currently employed, per department."""
    return (
        employees.filter("is_employed")
        .groupBy("dept_id")
        .agg(
            F.count(F.lit(1)).alias("headcount_people"),
            F.sum(F.when(F.col("is_people_manager"), 1).otherwise(0)).alias("managers"),
            F.sum(F.when(F.col("employment_type") == FULL_TIME, 1).otherwise(0)).alias("full_time"),
            F.round(F.sum("salary_annual"), 2).alias("total_salary"),
            F.round(F.avg("salary_annual"), 2).alias("avg_salary"),
        )
    )


def headcount_by_department(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Every department, with zeros where nobody works; the average stays NULL there.

    The join comes after the aggregation: it sees one row per department on either side,
    whatever the share of one department in the staff.
    """
    staff = staff_by_department(employees)
    zero = F.lit(0)
    return departments.join(staff, "dept_id", "left").select(
        "dept_id",
        "dept_code",
        "dept_name",
        "cost_centre",
        F.col("is_active").alias("department_active"),
        F.coalesce("headcount_people", zero).alias("headcount_people"),
        F.coalesce("managers", zero).alias("managers"),
        F.coalesce("full_time", zero).alias("full_time"),
        F.coalesce("total_salary", zero).alias("total_salary"),
        "avg_salary",
    )


# What is added up per department, exactly; the last three are not shown in gold.
SUMS = ("headcount_people", "managers", "full_time", "_salary_sum", "_salary_n")
HIDDEN = ("_salary_sum", "_salary_n", "_listed")
_TYPES = {"_salary_sum": "decimal(38,2)"}


def staff_sums(employees: DataFrame) -> DataFrame:
    """(dept_id, SUMS) of the currently employed."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    sums = employees.filter("is_employed").groupBy("dept_id").agg(
        F.count(F.lit(1)).alias("headcount_people"),
        one(F.col("is_people_manager")).alias("managers"),
        one(F.col("employment_type") == FULL_TIME).alias("full_time"),
        F.coalesce(F.sum("salary_annual"), F.lit(0)).alias("_salary_sum"),
        F.count("salary_annual").alias("_salary_n"),
    )
    return sums.select("dept_id", *[F.col(c).cast(_TYPES.get(c, "bigint")).alias(c) for c in SUMS])


def changed_sums(sums: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The sums after some employees' rows were replaced: ``before`` is taken away, ``after`` put in."""
    sign = lambda f, n: f.select("dept_id", *[(F.col(c) * n).cast(_TYPES.get(c, "bigint")).alias(c) for c in SUMS])
    every = sums.unionByName(sign(staff_sums(before), -1)).unionByName(staff_sums(after))
    added = every.groupBy("dept_id").agg(*[F.sum(c).cast(_TYPES.get(c, "bigint")).alias(c) for c in SUMS])
    return added.where("headcount_people <> 0")


def headcount_from_sums(sums: DataFrame, departments: DataFrame) -> DataFrame:
    """Gold with the sums behind it; departments nobody lists are kept for their sums."""
    listed = departments.withColumn("_listed", F.lit(True))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast(_TYPES.get(c, "bigint")))
    mean = F.round((F.col("_salary_sum").cast("decimal(22,2)") / F.col("_salary_n")).cast("decimal(16,6)"), 2)
    return listed.join(sums, "dept_id", "full").select(
        "dept_id",
        "dept_code",
        "dept_name",
        "cost_centre",
        F.col("is_active").alias("department_active"),
        *[zero(c).alias(c) for c in ("headcount_people", "managers", "full_time")],
        zero("_salary_sum").cast("decimal(23,2)").alias("total_salary"),
        F.when(F.col("_salary_n") > 0, mean).cast("decimal(13,2)").alias("avg_salary"),
        *[zero(c).alias(c) for c in ("_salary_sum", "_salary_n")],
        F.coalesce("_listed", F.lit(False)).alias("_listed"),
    )


def build_headcount(
    target: Target,
    table: str,
    people: Keyed,
    departments: DataFrame,
    secured: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    seen_as: str = "",
    comments: dict[str, str] | None = None,
) -> list[int]:
    """Write gold from silver's snapshot; returns the buckets of silver that were read.

    ``secured`` makes of employees' rows what the builder may see, and ``seen_as`` names that: where it, or
    silver's generation, is another than last time, all of silver is read.
    """
    now, notes = people.snapshot(), target.properties("gold", table)
    before = Snapshot.read(notes["people"]) if notes.get("seen_as") == seen_as and "people" in notes else None
    if before is not None and (before.generation, before.buckets) == (now.generation, now.buckets):
        read = sorted(b for b in now.versions if before.versions.get(b) != now.versions[b])
        stored = target.table("gold", target.stored(table, int(notes["generation"]))).select("dept_id", *SUMS)
        old, new = secured(people.of(before, read)), secured(people.of(now, read))
        sums = changed_sums(stored.where("headcount_people <> 0"), old, new)
    else:
        read = sorted(now.versions)
        sums = staff_sums(secured(people.of(now)))
    target.sweep("gold", table, target.generation("gold", table))
    generation = target.next_generation("gold", table)
    rows = headcount_from_sums(sums, departments)
    rows.write.mode("overwrite").saveAsTable(target.name("gold", target.stored(table, generation)))
    target.publish(
        "gold", table, generation, {"people": now.note(), "seen_as": seen_as},
        where="_listed", leave_out=HIDDEN, comments=comments,
    )
    return read
