"""Who may read what: grants, column masks, row filters and tag-driven masks.

``Governance.read`` is the way from a table to a caller. It refuses without a grant,
drops rows the caller may not see and rewrites masked columns, before anything else is
computed. These are rules for results, not a security boundary: whoever can read the
files sees everything.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.masks import Mask

# The groups, and which of them a control does not apply to.
STEWARDS, PLATFORM, ANALYSTS, BUSINESS = "hr_stewards", "hr_platform", "hr_analysts", "biz_users"
UNMASKED = frozenset({STEWARDS, PLATFORM})
UNFILTERED = frozenset({STEWARDS, PLATFORM, ANALYSTS})
# Privileges that let a grantee read.
READING = ("SELECT", "ALL_PRIVILEGES")


class AccessDenied(Exception):
    """No grant. Not the same as a grant whose row filter leaves nothing."""


class MaskTypeMismatch(Exception):
    """A mask bound to a column of another type would fail only for exempt callers."""


class AsOfRefused(Exception):
    """A protected table cannot be read as of an earlier time."""


@dataclass(frozen=True)
class Principal:
    name: str
    groups: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Grant:
    grantee: str
    privilege: str
    schema: str


@dataclass(frozen=True)
class RowFilter:
    """Rows whose ``column`` the access map grants to the caller; exempt groups see all."""

    name: str
    column: str
    map_column: str
    exempt: frozenset[str] = UNFILTERED


@dataclass(frozen=True)
class TagMask:
    """A mask for every column of a schema that carries a tag value."""

    policy: str
    schema: str
    tag_name: str
    tag_value: str
    mask: Mask


@dataclass(frozen=True)
class ColumnTag:
    schema: str
    table: str
    column: str
    tag_name: str
    tag_value: str


@dataclass(frozen=True)
class Governance:
    """Policies over named tables (``schema.table``). Metadata here, rows in DataFrames."""

    tables: dict[str, Callable[[], DataFrame]]
    access_map: Callable[[], DataFrame] | None = None
    grants: tuple[Grant, ...] = ()
    masks: dict[tuple[str, str], Mask] = field(default_factory=dict)
    row_filters: dict[str, RowFilter] = field(default_factory=dict)
    tag_masks: tuple[TagMask, ...] = ()
    column_tags: tuple[ColumnTag, ...] = ()
    append_only: frozenset[str] = frozenset()
    # How an append-only table that is stored in batches is read as of a moment.
    history: dict[str, Callable[[datetime], DataFrame]] = field(default_factory=dict)

    def may_read(self, table: str, principal: Principal) -> bool:
        schema = table.split(".")[0]
        return any(
            g.grantee == principal.name and g.schema == schema and g.privilege in READING
            for g in self.grants
        )

    def demand(self, table: str, principal: Principal) -> None:
        if not self.may_read(table, principal):
            raise AccessDenied(f"{principal.name} has no SELECT on {table}")

    def read(self, table: str, principal: Principal) -> DataFrame:
        self.demand(table, principal)
        return self.secured(table, principal)

    def secured(self, table: str, principal: Principal) -> DataFrame:
        """The table as the caller may see it, without asking for a grant on it.

        For views, which need a grant on the view but apply its sources' controls.
        """
        rows = self.tables[table]()
        bound = self.row_filters.get(table)
        if bound:
            rows = self.visible(rows, bound, principal)
        return self.masked(rows, table, principal)

    def visible(self, rows: DataFrame, bound: RowFilter, principal: Principal) -> DataFrame:
        if bound.exempt & principal.groups:
            return rows
        mine = self.access_map().filter(F.col("principal") == principal.name)
        keys = mine.select(F.col(bound.map_column).alias(bound.column)).distinct()
        return rows.join(keys, bound.column, "left_semi")

    def masked(self, rows: DataFrame, table: str, principal: Principal) -> DataFrame:
        schema, name = table.split(".")
        binding = {c: m for (t, c), m in self.masks.items() if t == table}
        for tag in self.column_tags:
            if (tag.schema, tag.table) != (schema, name):
                continue
            for rule in self.tag_masks:
                wanted = (rule.schema, rule.tag_name, rule.tag_value)
                if wanted == (tag.schema, tag.tag_name, tag.tag_value):
                    binding.setdefault(tag.column, rule.mask)
        for column, mask in binding.items():
            actual = rows.schema[column].dataType
            if actual != mask.input_type:
                raise MaskTypeMismatch(f"{mask.name} takes {mask.input_type}, {table}.{column} is {actual}")
        return rows.select(
            *[
                binding[c].expr(F.col(c), rows.schema[c].dataType).alias(c)
                if c in binding and not binding[c].exempt & principal.groups
                else F.col(c)
                for c in rows.columns
            ]
        )

    def protection(self, table: str) -> str | None:
        """Which controls are bound to a table, as the as-of refusal names them."""
        schema, name = table.split(".")
        has_filter = table in self.row_filters
        has_mask = any(t == table for t, _ in self.masks) or any(
            (t.schema, t.table, r.tag_name, r.tag_value) == (schema, name, t.tag_name, t.tag_value)
            for t in self.column_tags
            for r in self.tag_masks
            if r.schema == schema
        )
        if has_mask and has_filter:
            return "mask + row filter"
        return "column mask" if has_mask else "row filter" if has_filter else None

    def as_of(self, table: str, principal: Principal, moment, at: str = "_processed_timestamp") -> DataFrame:
        """An append-only table as it stood at ``moment``.

        A table that is rewritten no longer holds the rows of then, so it refuses as well.
        """
        self.demand(table, principal)
        reason = self.protection(table) or (None if table in self.append_only else "not append-only")
        if reason:
            raise AsOfRefused(reason)
        if table in self.history:
            return self.history[table](moment)
        return self.tables[table]().filter(F.col(at) <= F.lit(moment))

    def effect(self, table: str, principal: Principal) -> Hashable:
        """What the policies make of a table for a caller: equal values, equal rows."""
        bound = self.row_filters.get(table)
        filtered = bound and not bound.exempt & principal.groups
        exempt = frozenset(m.name for m in self.every_mask() if m.exempt & principal.groups)
        return self.may_read(table, principal), principal.name if filtered else None, exempt

    def every_mask(self) -> list[Mask]:
        return [*self.masks.values(), *(t.mask for t in self.tag_masks)]

    def with_tables(self, **tables: Callable[[], DataFrame]) -> Governance:
        return replace(self, tables={**self.tables, **tables})

    def metadata(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The policies as tables, in the shape the register reads."""
        return {
            "column_tags": spark.createDataFrame(
                [(t.schema, t.table, t.column, t.tag_name, t.tag_value) for t in self.column_tags],
                "table_schema string, table_name string, column_name string, tag_name string, tag_value string",
            ),
            "column_masks": spark.createDataFrame(
                [(*t.split("."), c, m.name) for (t, c), m in self.masks.items()],
                "table_schema string, table_name string, column_name string, mask_name string",
            ),
            "row_filters": spark.createDataFrame(
                [(*t.split("."), f.name, f.column) for t, f in self.row_filters.items()],
                "table_schema string, table_name string, filter_name string, target_columns string",
            ),
            "tag_policies": spark.createDataFrame(
                [(r.tag_value, r.schema, r.policy, r.mask.name) for r in self.tag_masks],
                "pii_class string, scope string, policy_name string, mask_function string",
            ),
            "table_privileges": spark.createDataFrame(
                [(*t.split("."), g.grantee, g.privilege) for g in self.grants for t in self.tables
                 if t.split(".")[0] == g.schema],
                "table_schema string, table_name string, grantee string, privilege_type string",
            ),
        }


def effective_grants(
    role_grants: DataFrame, members: DataFrame, users: DataFrame, services: DataFrame
) -> DataFrame:
    """Role grants expanded to principals: (role, grantee, privilege, schema_name).

    A member id stands for a user or for a service identity, two namespaces. Members that
    resolve to neither get nothing. Members are resolved before the roles are expanded.
    """
    return role_grants.join(_resolved(members, users, services), "role").select(
        "role", "grantee", "privilege", "schema_name"
    )


def _resolved(members: DataFrame, users: DataFrame, services: DataFrame) -> DataFrame:
    return (
        members.distinct()
        .join(users.select(F.col("id").alias("member"), F.col("name").alias("_user")), "member", "left")
        .join(services.select(F.col("id").alias("member"), F.col("name").alias("_service")), "member", "left")
        .select("role", F.coalesce("_user", "_service").alias("grantee"))
        .filter(F.col("grantee").isNotNull())
    )


def unreached_roles(
    role_grants: DataFrame, members: DataFrame, users: DataFrame, services: DataFrame
) -> DataFrame:
    """(role, grants, reason) of roles whose grants reach nobody: a finding, not an empty answer."""
    reached = _resolved(members, users, services).select("role").distinct()
    named = members.select("role").distinct().withColumn("named", F.lit(True))
    granted = role_grants.distinct().groupBy("role").agg(F.count(F.lit(1)).alias("grants"))
    left = granted.join(reached, "role", "left_anti").join(named, "role", "left")
    reason = F.when(F.col("named"), "no member is a live principal").otherwise("no members")
    return left.select("role", "grants", reason.alias("reason"))


# Fixed value: the built-in group every principal belongs to.
EVERYONE = "account users"


def stale_grantees(grants: DataFrame, live: DataFrame) -> DataFrame:
    """Grantees that no longer exist as principals."""
    grantees = grants.select("grantee").filter(F.col("grantee") != EVERYONE).distinct()
    return grantees.join(live.select(F.col("name").alias("grantee")), "grantee", "left_anti")


# The governed tags and the only values they may take.
VOCABULARY = {
    "pii_class": (
        "name",
        "email",
        "internal_id",
        "compensation",
        "compensation_aggregate",
        "special_category",
        "quasi_identifier",
    ),
    "data_sensitivity": ("public", "internal", "confidential", "restricted"),
    "contains_pii": ("true", "false"),
}


def ungoverned_values(used: DataFrame, vocabulary: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Values of governed tags outside their closed list, with how often each is used.

    The vocabulary is a constant of a few dozen values, so the test is an expression.
    """
    bad = F.lit(False)
    for tag, allowed in (vocabulary or VOCABULARY).items():
        bad = bad | ((F.col("tag_name") == tag) & ~F.col("tag_value").isin(*allowed))
    return used.filter(bad).groupBy("tag_name", "tag_value").agg(F.count(F.lit(1)).alias("uses"))


def same_ids(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Ids on one side only, compared as text: empty when both sides see exactly the same."""
    a = left.select(F.col(column).cast("string").alias("id")).distinct().withColumn("l", F.lit(True))
    b = right.select(F.col(column).cast("string").alias("id")).distinct().withColumn("r", F.lit(True))
    side = F.when(F.col("r").isNull(), "left only").when(F.col("l").isNull(), "right only")
    return a.join(b, "id", "full_outer").select("id", side.alias("side")).filter(F.col("side").isNotNull())


def id_list(rows: DataFrame, column: str) -> DataFrame:
    """The distinct ids in the order of their text, one row each."""
    return rows.select(F.col(column).cast("string").alias("id")).distinct().where("id IS NOT NULL").orderBy("id")


# What asking may come to.
ROWS, DENIED, ERROR = "ROWS", "DENIED", "ERROR"


def compare_principals(
    principals: Sequence[Principal],
    ask: Callable[[Principal], DataFrame],
    effect: Callable[[Principal], Hashable] | None = None,
) -> DataFrame:
    """One question as several callers: (principal, outcome, answer columns) for every caller asked.

    A refusal and a query that cannot be analysed are rows of their own with NULL answers, never an
    empty answer; any other failure is raised. Callers with an equal ``effect`` are given one
    plan, which is computed once.
    """
    answers: dict[Hashable, tuple[DataFrame, list[str]]] = {}
    refused: list[tuple[str, str]] = []
    for principal in principals:
        key = effect(principal) if effect else principal.name
        if key in answers:
            answers[key][1].append(principal.name)
            continue
        try:
            answer = ask(principal)
            answer.schema  # analysis errors surface here
        except AccessDenied:
            refused.append((principal.name, DENIED))
        except AnalysisException:
            refused.append((principal.name, ERROR))
        else:
            answers[key] = (answer, [principal.name])
    frames = [
        answer.select(F.explode(F.array(*map(F.lit, names))).alias("principal"), F.lit(ROWS).alias("outcome"), "*")
        for answer, names in answers.values()
    ]
    if refused:
        spark = SparkSession.active()
        frames.append(spark.createDataFrame(refused, "principal string, outcome string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
