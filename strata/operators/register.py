"""The stewardship register: per table its owner, tags, protection, readers and a verdict.

It is computed from metadata tables each time and stores nothing, so it cannot drift.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.policy import READING

# The verdicts, in the order they are tried.
UNCLASSIFIED = "REVIEW: unclassified"
UNPROTECTED = "REVIEW: unprotected restricted columns, reader without an approved exception"
UNMASKED_PII = "REVIEW: unmasked PII, reader without an approved exception"
OWNER_ONLY = "ok — owner only"
PROTECTED = "ok — restricted columns protected"
APPROVED = "ok — approved exception"
OK = "ok"

TABLE = ["table_schema", "table_name"]
COLUMN = [*TABLE, "column_name"]


@dataclass(frozen=True)
class Metadata:
    """What the register reads. Keys are (table_schema, table_name[, column_name])."""

    tables: DataFrame  # + table_owner
    table_tags: DataFrame  # + tag_name, tag_value
    column_tags: DataFrame  # + column_name, tag_name, tag_value
    column_masks: DataFrame  # + column_name, mask_name
    row_filters: DataFrame  # + filter_name
    privileges: DataFrame  # + grantee, privilege_type
    tag_policies: DataFrame  # pii_class, scope
    exceptions: DataFrame  # principal, scope


def tag_pivot(table_tags: DataFrame) -> DataFrame:
    """One row per table with the three tags the register shows."""
    wanted = ("domain", "layer", "contains_pii")
    values = [F.max(F.when(F.col("tag_name") == tag, F.col("tag_value"))).alias(tag) for tag in wanted]
    return table_tags.groupBy(*TABLE).agg(*values)


def column_facts(meta: Metadata) -> DataFrame:
    """Per table: classified, restricted, protected and masked columns.

    Tags and masks of a column are stacked and folded into one row together, which needs no
    join and counts every column once; only the folded rows meet the tag policies.
    """
    none = F.lit(None).cast("string")
    facts = meta.column_tags.select(*COLUMN, "tag_name", "tag_value", F.lit(0).alias("mask")).unionByName(
        meta.column_masks.select(*COLUMN, none.alias("tag_name"), none.alias("tag_value"), F.lit(1).alias("mask"))
    )
    is_class = F.col("tag_name") == "pii_class"
    is_restricted = (F.col("tag_name") == "data_sensitivity") & (F.lower("tag_value") == "restricted")
    per_column = facts.groupBy(*COLUMN).agg(
        F.max(is_class).alias("classified"),
        F.max(F.when(is_class, F.col("tag_value"))).alias("pii_class"),
        F.coalesce(F.max(is_restricted), F.lit(False)).alias("restricted"),
        F.sum("mask").alias("masks"),
    )
    policies = (
        meta.tag_policies.select("pii_class", F.col("scope").alias("table_schema"))
        .distinct()
        .withColumn("by_tag", F.lit(True))
    )
    known = per_column.join(policies, ["pii_class", "table_schema"], "left")
    safe = (F.col("masks") > 0) | F.col("by_tag").isNotNull()
    return known.groupBy(*TABLE).agg(
        F.count_if("classified").alias("classified_columns"),
        F.count_if("restricted").alias("restricted_columns"),
        F.count_if(F.col("restricted") & safe).alias("protected_columns"),
        F.sum("masks").alias("masked_columns"),
    )


def reader_counts(privileges: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Per table: who was granted reading, and who of them without an approved exception.

    Grantees are made distinct per table first. That spreads a table with very many
    grants over all tasks and leaves plain counts for the table level.
    """
    reading = F.col("privilege_type").isin(*READING) & F.col("grantee").isNotNull()
    readers = privileges.filter(reading).select(*TABLE, "grantee").distinct()
    approved = (
        exceptions.select(F.col("principal").alias("grantee"), F.col("scope").alias("table_schema"))
        .distinct()
        .withColumn("approved", F.lit(True))
    )
    return (
        readers.join(approved, ["grantee", "table_schema"], "left")
        .groupBy(*TABLE)
        .agg(
            F.count("grantee").alias("granted_readers"),
            F.count_if(F.col("approved").isNull()).alias("unapproved_readers"),
        )
    )


def _verdict():
    restricted, protected = F.col("restricted_columns"), F.col("protected_columns")
    unapproved = F.col("unapproved_readers") > 0
    holds_pii = F.lower(F.coalesce("contains_pii", F.lit("false"))) == "true"
    # Untagged comes first and on its own: compared to 'true', a NULL tag says nothing.
    return (
        F.when(F.col("contains_pii").isNull() & (restricted == 0), UNCLASSIFIED)
        .when((restricted > 0) & (protected < restricted) & unapproved, UNPROTECTED)
        .when(holds_pii & (F.col("masked_columns") == 0) & unapproved, UNMASKED_PII)
        .when(F.col("granted_readers") == 0, OWNER_ONLY)
        .when((restricted > 0) & (protected >= restricted), PROTECTED)
        .when(~unapproved, APPROVED)
        .otherwise(OK)
    )


def stewardship_register(meta: Metadata) -> DataFrame:
    """One row per table. Every input is reduced to one row per table before it is joined."""
    filters = meta.row_filters.select(*TABLE, F.col("filter_name").alias("row_filter"))
    joined = meta.tables.select(*TABLE, "table_owner")
    for part in (
        tag_pivot(meta.table_tags),
        column_facts(meta),
        filters,
        reader_counts(meta.privileges, meta.exceptions),
    ):
        joined = joined.join(part, TABLE, "left")
    counts = [
        "classified_columns",
        "restricted_columns",
        "protected_columns",
        "masked_columns",
        "granted_readers",
        "unapproved_readers",
    ]
    filled = joined.fillna(0, counts)
    return filled.select(
        *TABLE,
        "table_owner",
        "domain",
        "layer",
        "contains_pii",
        *counts[:4],
        "row_filter",
        *counts[4:],
        _verdict().alias("review_flag"),
    )


def findings(register: DataFrame) -> DataFrame:
    return register.filter(F.col("review_flag").like("REVIEW%"))


def unapproved_on(register: DataFrame, schema: str) -> DataFrame:
    """Tables of a schema that hold PII and can be read without an approved exception."""
    return register.filter(
        (F.col("table_schema") == schema) & (F.col("contains_pii") == "true") & (F.col("unapproved_readers") > 0)
    )
