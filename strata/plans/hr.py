"""The HR domain end to end: feeds, build, policies, metric view and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.masks import Mask, keep_domain, redacted, to_null
from strata.functions.text import base_name, decoded
from strata.operators import contracts, quality
from strata.operators.current import RECENCY, current_rows
from strata.operators.headcount import build_headcount
from strata.operators.ingest import REPLACE, as_of_batches, bronze, ingest, ledger, log_build, progress
from strata.operators.metrics import Lookup, MetricView
from strata.operators.policy import (
    ANALYSTS,
    BUSINESS,
    PLATFORM,
    STEWARDS,
    UNMASKED,
    ColumnTag,
    Governance,
    Grant,
    Principal,
    RowFilter,
    TagMask,
)
from strata.operators.register import Metadata, stewardship_register
from strata.operators.upsert import Keyed, Snapshot, bucket_count
from strata.sources.feeds import Feed
from strata.sources.landing import (
    file_md5,
    header_lines,
    landing_files,
    spread,
)
from strata.sources.target import Target

# The delivered columns of the three feeds, in file order.
EMPLOYEE = Feed(
    name="employee",
    table="bronze_hr_employee",
    key="employee_id",
    columns=(
        ("employee_id", "bigint"),
        ("employee_number", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("job_grade", "string"),
        ("is_people_manager", "boolean"),
        ("job_title", "string"),
        ("salary_annual", "decimal(12,2)"),
        ("hire_date", "date"),
        ("employment_type", "string"),
        ("is_employed", "boolean"),
        ("dept_id", "bigint"),
        ("manager_id", "bigint"),
        ("location_code", "string"),
        ("home_city", "string"),
        ("home_state", "string"),
        ("home_postcode", "string"),
        ("date_of_birth", "date"),
        ("gender", "string"),
        ("snapshot_date", "date"),
    ),
)
DEPARTMENT = Feed(
    name="department",
    table="bronze_hr_department",
    key="dept_id",
    columns=(
        ("dept_id", "bigint"),
        ("dept_code", "string"),
        ("dept_name", "string"),
        ("parent_dept_id", "bigint"),
        ("is_active", "boolean"),
        ("cost_centre", "string"),
        ("location_code", "string"),
        ("snapshot_date", "date"),
    ),
)
CHANGES = Feed(
    name="employee_changes",
    table="bronze_hr_employee_changes",
    key="employee_id",
    columns=(
        ("employee_id", "bigint"),
        ("event_date", "date"),
        ("attribute_name", "string"),
        ("old_value", "string"),
        ("new_value", "string"),
        ("received_date", "date"),
    ),
)
FEEDS = (EMPLOYEE, DEPARTMENT, CHANGES)

# Tables built at the same time.
THREADS = 4

# The tables of the upper layers, and what silver keeps of the provenance.
SILVER_EMPLOYEE, SILVER_DEPARTMENT = "silver_hr_employee", "silver_hr_department"
GOLD_HEADCOUNT, WORKFORCE = "gold_hr_headcount_by_department", "mv_hr_workforce"
SILVER_PROVENANCE = ("_file_path", "_file_name", "_file_last_modified", "_processed_timestamp")
# Fixed value: the column nothing downstream needs, dropped for its disclosure cost.
NOT_IN_SILVER = ("date_of_birth",)

# Descriptions that reach the metastore with the table.
GOLD_COMMENTS = {
    "dept_id": "Key of the table: every department has exactly one row.",
    "dept_code": "Short code of the department, from its newest master record.",
    "dept_name": "Readable name of the department, from its newest master record.",
    "cost_centre": "Where the department's cost is booked.",
    "department_active": "False for a closed department; closed ones stay listed.",
    "headcount_people": "Heads at work now; contract type makes no difference.",
    "managers": "Of those heads, how many lead others.",
    "full_time": "Of those heads, how many hold a full-time contract.",
    "total_salary": "Restricted. Yearly gross pay of all heads added up, not scaled by contract.",
    "avg_salary": "Restricted. Yearly gross pay per head; empty for a department without staff.",
}


def silver_columns(rows: DataFrame, feed: Feed) -> DataFrame:
    """What silver keeps of bronze: the feed's columns, and the provenance that makes the choice auditable."""
    keep = [c for c in feed.column_names if c not in NOT_IN_SILVER]
    return rows.select(*keep, *SILVER_PROVENANCE)


def silver(rows: DataFrame, feed: Feed) -> DataFrame:
    """The current row per key."""
    return current_rows(silver_columns(rows, feed), feed.key, RECENCY)


def silver_table(target: Target, table: str, feed: Feed) -> Keyed:
    return Keyed(target, "silver", table, (feed.key,), RECENCY)


def build(
    target: Target,
    landing: str,
    governance: Governance | None = None,
    pipeline: Principal | None = None,
    *,
    full_refresh: bool = False,
    sidecar_glob: str = "*.ctrl",
) -> None:
    """Landing to gold. Gold reads silver as ``pipeline``, who has to be exempt from the masks.

    Silver is merged with the batches that are new to it, bucket by bucket, and gold with the buckets that
    changed, which gives the same rows as building all again; a first build and a full refresh do the latter.
    """
    target.setup()

    def load(feed: Feed) -> None:
        ingest(target, feed, landing, full_refresh=full_refresh)

    def reduce_to_current(table: str, feed: Feed) -> None:
        done = progress(target, feed, table)
        keyed, whole = silver_table(target, table, feed), silver_columns(bronze(target, feed), feed)
        shown = keyed.snapshot()
        notes = {} if done.last is None else {"merged": str(done.last)}
        if done.merged is None or shown is None or target.table("silver", table).columns != whole.columns:
            keyed.start(whole, notes, bucket_count(whole.count()))
        elif done.merged == done.last:
            return
        else:
            # Versions that neither silver nor gold shows have had their readers since the build before.
            noted = target.properties("gold", GOLD_HEADCOUNT).get("people") if table == SILVER_EMPLOYEE else None
            keyed.forget([shown, *([Snapshot.read(noted)] if noted else [])])
            keyed.merge(silver_columns(bronze(target, feed, after_batch=done.merged), feed), notes)
        log_build(target, table, REPLACE, done.last)

    # Tables of one layer do not depend on each other: their jobs are submitted together.
    with ThreadPoolExecutor(max_workers=THREADS) as pool:
        list(pool.map(load, [f for feed in FEEDS for f in (feed, feed.sidecar(sidecar_glob))]))
        list(pool.map(reduce_to_current, (SILVER_EMPLOYEE, SILVER_DEPARTMENT), (EMPLOYEE, DEPARTMENT)))
    policies = governance or hr_governance(target)
    caller = pipeline or PIPELINE
    people, name = silver_table(target, SILVER_EMPLOYEE, EMPLOYEE), f"silver.{SILVER_EMPLOYEE}"
    allowed, only, exempt = policies.effect(name, caller)
    build_headcount(
        target,
        GOLD_HEADCOUNT,
        people,
        policies.secured(f"silver.{SILVER_DEPARTMENT}", caller),
        secured=lambda rows: policies.with_tables(**{name: lambda: rows}).secured(name, caller),
        seen_as=f"{only} {sorted(exempt)}",
        comments=GOLD_COMMENTS,
    )
    target.describe("gold", GOLD_HEADCOUNT, "People and cost per department, currently employed staff only.")
    log_build(target, GOLD_HEADCOUNT, REPLACE)


# --- policies ---------------------------------------------------------------------------

STEWARD = Principal("steward", frozenset({STEWARDS}))
PIPELINE = Principal("pipeline", frozenset({PLATFORM}))
ANALYST = Principal("hr-analyst", frozenset({ANALYSTS}))
BIZ = Principal("biz-analyst", frozenset({BUSINESS}))
ROSTER = (STEWARD, PIPELINE, ANALYST, BIZ)

MASK_SALARY = Mask("mask_salary", T.DecimalType(12, 2), to_null, UNMASKED)
MASK_EMAIL = Mask("mask_email", T.StringType(), keep_domain, UNMASKED)
MASK_SALARY_TOTAL = Mask("mask_salary_total", T.DecimalType(23, 2), to_null, UNMASKED)
MASK_SALARY_AVG = Mask("mask_salary_avg", T.DecimalType(13, 2), to_null, UNMASKED)
MASK_REDACT = Mask("mask_redact_string", T.StringType(), redacted, UNMASKED)
FILTER_DEPT = RowFilter("filter_dept", "dept_id", "dept_id")
BY_TAG = TagMask("mask_special_category_by_tag", "silver", "pii_class", "special_category", MASK_REDACT)

# Which role reads which schema. No role reads bronze.
ROLE_GRANTS = {
    STEWARDS: ("silver", "gold", "governance"),
    ANALYSTS: ("silver", "gold"),
    BUSINESS: ("gold",),
}
# Fixed values: (column, pii_class, data_sensitivity) per classified table.
CLASSIFIED = {
    ("silver", SILVER_EMPLOYEE): (
        ("first_name", "name", "confidential"),
        ("last_name", "name", "confidential"),
        ("email", "email", "confidential"),
        ("employee_number", "internal_id", "internal"),
        ("salary_annual", "compensation", "restricted"),
        ("gender", "special_category", "restricted"),
        ("home_city", "quasi_identifier", "internal"),
        ("home_state", "quasi_identifier", "internal"),
        ("home_postcode", "quasi_identifier", "internal"),
    ),
    ("gold", GOLD_HEADCOUNT): (
        ("total_salary", "compensation_aggregate", "restricted"),
        ("avg_salary", "compensation_aggregate", "restricted"),
    ),
}
# contains_pii per table; every table also carries its domain and layer.
CONTAINS_PII = {
    ("silver", SILVER_EMPLOYEE): "true",
    ("silver", SILVER_DEPARTMENT): "false",
    ("gold", GOLD_HEADCOUNT): "false",
    ("gold", WORKFORCE): "false",
    ("bronze", "bronze_hr_employee"): "true",
    ("bronze", "bronze_hr_employee_changes"): "true",
    ("bronze", "bronze_hr_department"): "false",
    ("bronze", "bronze_hr_employee_ctrl"): "false",
    ("bronze", "bronze_hr_employee_changes_ctrl"): "false",
    ("bronze", "bronze_hr_department_ctrl"): "false",
}
# Tables that only their grants protect.
GRANTS_ONLY = (("bronze", "bronze_hr_employee"), ("bronze", "bronze_hr_employee_changes"))


def role_grants(principals: tuple[Principal, ...]) -> tuple[Grant, ...]:
    """Roles expanded to their members, plus the two direct grants that reach bronze."""
    grants = [
        Grant(p.name, "SELECT", schema) for p in principals for role in p.groups for schema in ROLE_GRANTS.get(role, ())
    ]
    for schema in ("bronze", "silver", "gold"):
        grants.append(Grant(PIPELINE.name, "ALL_PRIVILEGES", schema))
        grants.append(Grant(STEWARD.name, "SELECT", schema))
        grants.append(Grant(STEWARD.name, "MODIFY", schema))
    return tuple(dict.fromkeys(grants))


ACCESS_SCHEMA = "principal string, dept_id bigint, granted_by string, granted_on date"
EXCEPTION_SCHEMA = "principal string, scope string, reason string, approved_by string, approved_on date"


def load_access_map(target: Target, grants: list[tuple[str, int]], on: date) -> DataFrame:
    """Which principal may see which department, replaced whole."""
    rows = [(who, dept, STEWARD.name, on) for who, dept in grants]
    return target.reload("governance", "dept_access", rows, ACCESS_SCHEMA)


def load_exceptions(target: Target, on: date) -> DataFrame:
    """Approved readers of unmasked data, each with a reason and an approver."""
    rows = [
        (STEWARD.name, "bronze", "Answers for the delivered data and has to inspect it as it came.", STEWARD.name, on),
        (PIPELINE.name, "bronze", "Builds the upper layers, for which it needs true values.", STEWARD.name, on),
    ]
    return target.reload("governance", "unmasked_access", rows, EXCEPTION_SCHEMA)


def load_coverage(target: Target, governance: Governance) -> DataFrame:
    """Which tag values a policy protects in which schema, replaced whole."""
    return target.rebuild("governance", "abac_coverage", governance.metadata(target.spark)["tag_policies"])


def hr_governance(target: Target, principals: tuple[Principal, ...] = ROSTER) -> Governance:
    names = [("silver", SILVER_EMPLOYEE), ("silver", SILVER_DEPARTMENT), ("gold", GOLD_HEADCOUNT)]
    names += [("bronze", t) for f in FEEDS for t in (f.table, f"{f.table}_ctrl")]

    def reader(layer: str, table: str):
        return lambda: target.table(layer, table)

    def access_map() -> DataFrame:
        if target.exists("governance", "dept_access"):
            return target.table("governance", "dept_access")
        return target.spark.createDataFrame([], ACCESS_SCHEMA)

    return Governance(
        tables={f"{layer}.{table}": reader(layer, table) for layer, table in names},
        access_map=access_map,
        grants=role_grants(principals),
        masks={
            (f"silver.{SILVER_EMPLOYEE}", "salary_annual"): MASK_SALARY,
            (f"silver.{SILVER_EMPLOYEE}", "email"): MASK_EMAIL,
            (f"gold.{GOLD_HEADCOUNT}", "total_salary"): MASK_SALARY_TOTAL,
            (f"gold.{GOLD_HEADCOUNT}", "avg_salary"): MASK_SALARY_AVG,
        },
        row_filters={f"gold.{GOLD_HEADCOUNT}": FILTER_DEPT},
        append_only=frozenset(f"{layer}.{table}" for layer, table in names if layer == "bronze"),
        history={f"bronze.{f.table}": partial(as_of_batches, target, f) for f in FEEDS},
        tag_masks=(BY_TAG,),
        column_tags=tuple(
            ColumnTag(schema, table, column, tag, value)
            for (schema, table), columns in CLASSIFIED.items()
            for column, pii, sensitivity in columns
            for tag, value in (("pii_class", pii), ("data_sensitivity", sensitivity))
        ),
    )


def table_tags(contains_pii: Mapping[tuple[str, str], str] = CONTAINS_PII) -> list[tuple[str, str, str, str]]:
    rows = []
    for (schema, table), flag in contains_pii.items():
        rows += [
            (schema, table, "contains_pii", flag),
            (schema, table, "domain", "hr"),
            (schema, table, "layer", schema),
        ]
    rows += [(schema, table, "protection", "grants_only") for schema, table in GRANTS_ONLY]
    return rows


def register(
    target: Target,
    governance: Governance,
    contains_pii: Mapping[tuple[str, str], str] = CONTAINS_PII,
) -> DataFrame:
    """The stewardship register over the HR tables and policies."""
    spark = target.spark
    meta = governance.metadata(spark)
    tables = [(*t.split("."), PIPELINE.name) for t in governance.tables] + [("gold", WORKFORCE, PIPELINE.name)]
    view_readers = [
        ("gold", WORKFORCE, g.grantee, g.privilege) for g in governance.grants if g.schema == "gold"
    ]
    privileges = meta["table_privileges"].unionByName(
        spark.createDataFrame(view_readers, meta["table_privileges"].schema)
    )
    exceptions = (
        target.table("governance", "unmasked_access")
        if target.exists("governance", "unmasked_access")
        else spark.createDataFrame([], EXCEPTION_SCHEMA)
    )
    return stewardship_register(
        Metadata(
            tables=spark.createDataFrame(tables, "table_schema string, table_name string, table_owner string"),
            table_tags=spark.createDataFrame(
                table_tags(contains_pii),
                "table_schema string, table_name string, tag_name string, tag_value string",
            ),
            column_tags=meta["column_tags"],
            column_masks=meta["column_masks"],
            row_filters=meta["row_filters"],
            privileges=privileges,
            tag_policies=meta["tag_policies"],
            exceptions=exceptions,
        )
    )


# --- metric view ------------------------------------------------------------------------

# Dimensions and measures, each measure named for its rule.
MV_WORKFORCE = MetricView(
    name=f"gold.{WORKFORCE}",
    source=f"silver.{SILVER_EMPLOYEE}",
    filter="is_employed",
    row_filter=FILTER_DEPT,
    lookups={"dept": Lookup(f"silver.{SILVER_DEPARTMENT}", "source.dept_id = dept.dept_id")},
    dimensions={
        "Department": "dept.dept_name",
        "Cost centre": "dept.cost_centre",
        "Employment type": "source.employment_type",
        "Job grade": "source.job_grade",
        "Location": "source.location_code",
        "Department is active": "dept.is_active",
        "Is people manager": "source.is_people_manager",
    },
    measures={
        "headcount_people": "count(1)",
        "headcount_fte": "sum(case when source.employment_type = 'full_time' then 1 else 0.5 end)",
        "headcount_fulltime": "count_if(source.employment_type = 'full_time')",
        "salary_total": "sum(source.salary_annual)",
        "salary_avg": "avg(source.salary_annual)",
        "manager_count": "count_if(source.is_people_manager)",
    },
    comments={
        "headcount_people": "Heads at work now: each adds one, whatever the contract.",
        "headcount_fte": "Capacity in full-time posts: a full-time contract adds 1, any other a half.",
        "headcount_fulltime": "Heads on a full-time contract; all other contracts are left out.",
        "manager_count": "Heads that lead others, by the flag in the source.",
        "salary_total": "Restricted. Yearly gross pay added up; empty for callers who may not read pay.",
        "salary_avg": "Restricted. Yearly gross pay per head the caller sees; empty where pay may not be read.",
    },
)


# --- checks -----------------------------------------------------------------------------

# How many results ``checks`` gives; one that goes missing is a failure.
EXPECTED_CHECKS = 46


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class Layers:
    """The built tables a check run looks at."""

    data: dict[str, DataFrame]
    sidecars: dict[str, DataFrame]
    employee: DataFrame
    department: DataFrame
    gold: DataFrame


def layers(target: Target) -> Layers:
    return Layers(
        data={f.table: bronze(target, f) for f in FEEDS},
        sidecars={f"{f.table}_ctrl": bronze(target, f.sidecar()) for f in FEEDS},
        employee=target.table("silver", SILVER_EMPLOYEE),
        department=target.table("silver", SILVER_DEPARTMENT),
        gold=target.table("gold", GOLD_HEADCOUNT),
    )


def column_checks(built: Layers) -> list[DataFrame]:
    """The 34 column and table tests; row-level ones take one pass per table."""
    null, least = quality.not_null, quality.at_least
    employee, department = built.data[EMPLOYEE.table], built.data[DEPARTMENT.table]
    delivered_as = ("employee_id", "snapshot_date", "_file_path", "_file_name", "_file_date")
    answered = ("dept_id", "dept_name", "headcount_people", "managers")
    rules = [
        (EMPLOYEE.table, employee, [*[null(c) for c in delivered_as], least("salary_annual", 0)]),
        (DEPARTMENT.table, department, [null("dept_id"), null("snapshot_date")]),
        (CHANGES.table, built.data[CHANGES.table], [null("employee_id"), null("event_date")]),
        *[(n, rows, [null("file_name"), null("record_count")]) for n, rows in built.sidecars.items()],
        (SILVER_EMPLOYEE, built.employee, [null("employee_id"), null("is_employed")]),
        (SILVER_DEPARTMENT, built.department, [null("dept_id"), null("dept_code")]),
        (GOLD_HEADCOUNT, built.gold, [*[null(c) for c in answered], least("headcount_people", 0)]),
    ]
    tallies = [quality.rule_tally(*r) for r in rules]
    unique = [
        *[(n, rows, ["file_name"]) for n, rows in built.sidecars.items()],
        (SILVER_EMPLOYEE, built.employee, ["employee_id"]),
        (SILVER_DEPARTMENT, built.department, ["dept_id"]),
        (GOLD_HEADCOUNT, built.gold, ["dept_id"]),
        (EMPLOYEE.table, employee, ["employee_id", "_file_path", "_file_last_modified"]),
        (DEPARTMENT.table, department, ["dept_id", "_file_path", "_file_last_modified"]),
    ]
    tallies += [
        quality.tally(f"{name}.unique_{columns[0]}" if len(columns) == 1 else f"{name}.unique_combination",
                      quality.duplicates(rows, columns), rows)
        for name, rows, columns in unique
    ]
    lost = quality.orphans(built.employee, "dept_id", built.department, "dept_id")
    return [*tallies, quality.tally(f"{SILVER_EMPLOYEE}.relationships_dept_id", lost, built.employee)]


def date_findings(built: Layers) -> DataFrame:
    """Statements of the same date that disagree, in every feed and its sidecars.

    The comparisons over the employee and department sidecars are additions.
    """
    differ = contracts.disagreeing
    found = [
        differ(f"{f.name}: _file_date <> snapshot_date", built.data[f.table], "_file_date", "snapshot_date")
        for f in (EMPLOYEE, DEPARTMENT)
    ]
    for feed in FEEDS:
        sidecar = built.sidecars[f"{feed.table}_ctrl"]
        label = f"{feed.name.replace('employee_changes', 'changes')}_ctrl"
        data_name = "replace(_file_name, '.ctrl', '.csv')"
        found += [
            differ(f"{label}: business_date <> _file_date", sidecar, "business_date", "_file_date"),
            differ(f"{label}: file_name does not match its sidecar", sidecar, "file_name", data_name),
        ]
    changes = built.data[CHANGES.table]
    found.append(differ("changes: event_date after received_date", changes, "event_date", "received_date", ">"))
    return _union(found)


def delivered(target: Target, feed: Feed, landing: str, since: datetime | None) -> DataFrame:
    """A feed's files: all below its folder, as ingest reads it, or those the ledger listed from ``since`` on."""
    if since is None:
        folder = f"{landing.rstrip('/')}/{feed.name}"
        return landing_files(target.spark, folder, feed.glob)
    listed = ledger(target, feed).filter(F.col("listed_at") >= F.lit(since))
    named = listed.select("_file_path", decoded(base_name(F.col("_file_path"))).alias("file_name"))
    return spread(named, "_file_path")


def checks(target: Target, landing: str, since: datetime | None = None) -> DataFrame:
    """All checks of a build, one result row each.

    With ``since`` the checks that open files open only those first listed from then on, and they count
    as looked at only what they opened. A file whose bytes changed under an old time is found by a
    run without it.
    """
    built = layers(target)
    spark = target.spark
    sidecars = list(built.sidecars.values())
    all_sidecars = _union(sidecars)
    employee = built.data[EMPLOYEE.table]
    files = landing_files(spark, landing, "*.csv")
    opened = {f.name: delivered(target, f, landing, since) for f in FEEDS}
    actual = _union([file_md5(f) for f in opened.values()])
    headers = _union([contracts.headers(header_lines(opened[f.name]), f) for f in FEEDS])
    tally = quality.tally
    stored = {**built.data, **built.sidecars}
    all_rows = _union([rows.select("_file_name") for rows in stored.values()])
    tallies = column_checks(built)
    tallies += [
        tally("ctrl_files_present", contracts.presence(files, sidecars), files),
        tally("ctrl_md5_matches", contracts.digests(actual, sidecars), _union(list(opened.values()))),
        *[
            tally(f"ctrl_record_counts.{f.name}",
                  contracts.record_counts(f.table, built.sidecars[f"{f.table}_ctrl"], built.data[f.table]),
                  built.sidecars[f"{f.table}_ctrl"])
            for f in FEEDS
        ],
        tally("no_rescued_data", contracts.rescued(stored), all_rows),
        tally("dates_agree", date_findings(built), all_rows),
        tally(
            "one_row_per_key",
            quality.duplicate_keys([
                (SILVER_EMPLOYEE, built.employee, "employee_id"),
                (SILVER_DEPARTMENT, built.department, "dept_id"),
            ]),
            built.employee,
        ),
        tally("right_row_picked.employee",
              quality.wrongly_picked("employee", built.employee, employee, "employee_id", RECENCY), built.employee),
        tally("right_row_picked.department",
              quality.wrongly_picked("department", built.department, built.data[DEPARTMENT.table], "dept_id", RECENCY),
              built.department),
        tally("headcount_reconciles", quality.headcount_gap(built.employee, built.gold), built.employee),
        tally("landing_headers_match", headers, _union(list(opened.values()))),
    ]
    return quality.results(tallies)


def gold_columns(target: Target) -> DataFrame:
    """Names and descriptions of everything gold offers, the metric view included."""
    return target.columns("gold").unionByName(MV_WORKFORCE.describe(target.spark))


def tag_uses(governance: Governance, target: Target) -> DataFrame:
    """Every use of a tag on a column or a table, for the vocabulary check."""
    columns = governance.metadata(target.spark)["column_tags"].select("tag_name", "tag_value")
    tables = target.spark.createDataFrame(table_tags(), "s string, t string, tag_name string, tag_value string")
    return columns.unionByName(tables.select("tag_name", F.col("tag_value")))
