from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.text import stable_id
from strata.operators import metrics, policy, register
from strata.operators.policy import AccessDenied, AsOfRefused, Governance, Grant, MaskTypeMismatch, Principal
from strata.plans import hr
from strata.plans.hr import ANALYST, BIZ, PIPELINE, ROSTER, STEWARD

EMPLOYEE = (
    "employee_id bigint, email string, gender string, salary_annual decimal(12,2), is_people_manager boolean, "
    "employment_type string, is_employed boolean, dept_id bigint, job_grade string, location_code string, "
    "_processed_timestamp timestamp"
)
DEPARTMENT = "dept_id bigint, dept_code string, dept_name string, cost_centre string, is_active boolean"


@pytest.fixture(scope="module")
def world(spark):
    t = [datetime(2025, 1, i) for i in (1, 2)]
    people = spark.createDataFrame(
        [
            (1, "a@x.org", "F", Decimal("100.00"), True, "full_time", True, 1, "L5", "N", t[0]),
            (2, "broken", "M", Decimal("60.00"), False, "part_time", True, 1, "L3", "N", t[0]),
            (3, None, None, Decimal("80.00"), False, "full_time", True, 2, "L3", "S", t[1]),
            (4, "d@y.org@z", "M", Decimal("70.00"), False, None, True, 3, "L3", "S", t[1]),
            (5, "e@x.org", "F", Decimal("90.00"), True, "full_time", False, 3, "L3", "S", t[1]),
            (6, "f@x.org", "F", Decimal("40.00"), False, "full_time", True, 9, "L3", "S", t[1]),
        ],
        EMPLOYEE,
    )
    depts = spark.createDataFrame([(i, f"D{i}", f"Dept {i}", f"CC{i % 2}", i != 3) for i in (1, 2, 3)], DEPARTMENT)
    access = spark.createDataFrame(
        [(BIZ.name, 1, "s", date(2025, 1, 1)), (BIZ.name, 2, "s", date(2025, 1, 1)), ("other", 3, "s", date(2025, 1, 1))],
        hr.ACCESS_SCHEMA,
    )
    from strata.operators.headcount import headcount_by_department

    gold = headcount_by_department(people, depts)
    base = hr.hr_governance(None)
    return Governance(
        tables={
            f"silver.{hr.SILVER_EMPLOYEE}": lambda: people,
            f"silver.{hr.SILVER_DEPARTMENT}": lambda: depts,
            f"gold.{hr.GOLD_HEADCOUNT}": lambda: gold,
            "bronze.bronze_hr_employee": lambda: people,
        },
        access_map=lambda: access,
        grants=base.grants,
        masks=base.masks,
        row_filters=base.row_filters,
        append_only=frozenset({"bronze.bronze_hr_employee"}),
        tag_masks=base.tag_masks,
        column_tags=base.column_tags,
    )


SILVER, GOLD = f"silver.{hr.SILVER_EMPLOYEE}", f"gold.{hr.GOLD_HEADCOUNT}"


def test_masks_by_caller(world):
    seen = {p.name: {r.employee_id: r for r in world.read(SILVER, p).collect()} for p in (STEWARD, PIPELINE, ANALYST)}
    for exempt in ("steward", "pipeline"):
        assert seen[exempt][1].salary_annual == Decimal("100.00")
        assert seen[exempt][2].email == "broken" and seen[exempt][3].gender is None
    analyst = seen["hr-analyst"]
    assert {r.salary_annual for r in analyst.values()} == {None}
    assert [analyst[i].email for i in (1, 2, 3, 4)] == ["***@x.org", "***@redacted", None, "***@y.org"]
    assert {r.gender for r in analyst.values()} == {"REDACTED"}
    assert dict(world.read(SILVER, ANALYST).dtypes) == dict(world.read(SILVER, STEWARD).dtypes)
    gold = world.read(GOLD, ANALYST)
    assert gold.filter("total_salary is not null or avg_salary is not null").count() == 0 and gold.count() == 3


def test_row_filter_shows_exactly_the_mapped_departments(world, spark):
    mine = world.access_map().filter(F.col("principal") == BIZ.name)
    assert policy.same_ids(mine, world.read(GOLD, BIZ), "dept_id").count() == 0
    assert [r.id for r in policy.id_list(world.read(GOLD, BIZ), "dept_id").collect()] == ["1", "2"]
    # Seeing fewer, or more, is not the same.
    assert policy.same_ids(mine, world.read(GOLD, BIZ).limit(1), "dept_id").count() == 1
    sides = {r.side for r in policy.same_ids(mine, world.read(GOLD, STEWARD), "dept_id").collect()}
    assert sides == {"right only"}
    stranger = Principal("nobody", BIZ.groups)
    empty = Governance(**{**world.__dict__, "grants": (*world.grants, Grant("nobody", "SELECT", "gold"))})
    assert empty.read(GOLD, stranger).count() == 0


def test_denied_is_not_empty(world):
    for table, caller in ((SILVER, BIZ), ("bronze.bronze_hr_employee", ANALYST), ("bronze.bronze_hr_employee", BIZ)):
        with pytest.raises(AccessDenied):
            world.read(table, caller)
    assert world.read("bronze.bronze_hr_employee", STEWARD).count() == 6
    assert world.read("bronze.bronze_hr_employee", PIPELINE).count() == 6  # ALL_PRIVILEGES reads

    def ask(caller):
        asked.append(caller.name)
        if caller == PIPELINE:
            return world.read(SILVER, caller).select("no_such_column")
        return world.read(SILVER, caller).agg(F.count(F.lit(1)).alias("n"))

    asked = []
    rows = policy.compare_principals(ROSTER, ask)
    assert {tuple(r) for r in rows.collect()} == {
        ("steward", "ROWS", 6), ("pipeline", "ERROR", None), ("hr-analyst", "ROWS", 6), ("biz-analyst", "DENIED", None),
    }
    assert {tuple(r) for r in policy.compare_principals([BIZ], ask).collect()} == {("biz-analyst", "DENIED")}

    def broken(caller):
        raise ZeroDivisionError

    with pytest.raises(ZeroDivisionError):
        policy.compare_principals(ROSTER, broken)
    asked.clear()
    shared = policy.compare_principals([STEWARD, ANALYST, STEWARD], ask, lambda p: world.effect(SILVER, p))
    assert asked == ["steward", "hr-analyst"]
    assert sorted(r.principal for r in shared.collect()) == ["hr-analyst", "steward", "steward"]


def test_a_mask_of_the_wrong_type_is_refused_for_everyone(world):
    wrong = Governance(**{**world.__dict__, "masks": {(SILVER, "dept_id"): hr.MASK_EMAIL}})
    for caller in (STEWARD, ANALYST):
        with pytest.raises(MaskTypeMismatch):
            wrong.read(SILVER, caller)


def test_pipeline_without_exemption_writes_zero(world):
    from strata.operators.headcount import headcount_by_department

    depts = world.tables[f"silver.{hr.SILVER_DEPARTMENT}"]()
    right = headcount_by_department(world.secured(SILVER, PIPELINE), depts).agg(F.sum("total_salary")).first()[0]
    plain = Principal("pipeline")
    wrong = headcount_by_department(world.secured(SILVER, plain), depts).agg(F.sum("total_salary")).first()[0]
    assert right == Decimal("310.00") and wrong == 0  # silently: nothing raises


def test_metric_view(world):
    view = hr.MV_WORKFORCE
    totals = view.query(world, STEWARD, list(view.measures)).first()
    assert (totals.headcount_people, totals.headcount_fte, totals.headcount_fulltime) == (5, Decimal("4.0"), 3)
    assert (totals.salary_total, totals.salary_avg, totals.manager_count) == (Decimal("350.00"), Decimal("70"), 1)
    assert metrics.measures_distinct(view, world, STEWARD).first().verdict == "yes"
    by_dept = {r["Department"]: r.headcount_people for r in view.query(world, STEWARD, ["headcount_people"], ["Department"]).collect()}
    assert by_dept == {"Dept 1": 2, "Dept 2": 1, "Dept 3": 1, None: 1}  # nobody is lost in the lookup
    two = view.query(world, STEWARD, ["headcount_fulltime"], ["Cost centre", "Employment type"]).collect()
    assert sum(r.headcount_fulltime for r in two) == 3
    masked = view.query(world, ANALYST, ["headcount_people", "salary_total", "salary_avg"]).first()
    assert tuple(masked) == (5, None, None)
    biz = view.headcount(world, BIZ).first()
    assert biz.headcount_people == 3
    with pytest.raises(KeyError):
        view.query(world, STEWARD, ["headcount"])
    top = view.top(world, STEWARD, "headcount_people", ["Department"], 2).collect()
    assert top[0]["Department"] == "Dept 1" and len(top) == 2
    nobody = Principal("x")
    with pytest.raises(AccessDenied):
        view.query(world, nobody, ["headcount_people"])


def test_metric_view_joins_only_what_is_asked(world):
    def joins(by):
        asked = hr.MV_WORKFORCE.query(world, STEWARD, ["headcount_people"], by)
        return asked._jdf.queryExecution().optimizedPlan().toString().count("Join")

    assert joins([]) == 0 and joins(["Employment type"]) == 0 and joins(["Department"]) == 1
    filtered = hr.MV_WORKFORCE.query(world, STEWARD, ["headcount_people"], where="dept.cost_centre = 'CC1'")
    assert filtered.first().headcount_people == 3


def test_the_layer_does_not_widen_access(world):
    view = hr.MV_WORKFORCE

    def verdict(v, caller, rules=world):
        layer = v.query(rules, caller, ["headcount_people"])
        return metrics.layer_equals_table(layer, rules.read(GOLD, caller), "headcount_people").first()

    assert tuple(verdict(view, BIZ)) == (3, 3, "yes")
    from dataclasses import replace

    assert verdict(replace(view, row_filter=None), BIZ).verdict == "no"
    stranger = Principal("nobody", BIZ.groups)
    rules = Governance(**{**world.__dict__, "grants": (*world.grants, Grant("nobody", "SELECT", "gold"))})
    assert tuple(verdict(view, stranger, rules)) == (0, 0, "yes")


def test_as_of(world):
    early = world.as_of("bronze.bronze_hr_employee", STEWARD, datetime(2025, 1, 1, 12))
    assert early.count() == 2
    for table, reason in ((SILVER, "column mask"), (GOLD, r"mask \+ row filter")):
        with pytest.raises(AsOfRefused, match=reason):
            world.as_of(table, STEWARD, datetime(2025, 1, 1))
    rewritten = f"silver.{hr.SILVER_DEPARTMENT}"
    with pytest.raises(AsOfRefused, match="not append-only"):
        world.as_of(rewritten, STEWARD, datetime(2025, 1, 1))
    only_filter = Governance(**{**world.__dict__, "masks": {}})
    with pytest.raises(AsOfRefused, match="^row filter$"):
        only_filter.as_of(GOLD, STEWARD, datetime(2025, 1, 1))
    with pytest.raises(AccessDenied):
        world.as_of("bronze.bronze_hr_employee", ANALYST, datetime(2025, 1, 1))


def test_grants(spark):
    grants = spark.createDataFrame(
        [("a", "SELECT", "gold"), ("a", "SELECT", "silver"), ("b", "SELECT", "gold")],
        "role string, privilege string, schema_name string",
    )
    members = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "s1"), ("b", "404")], "role string, member string")
    users = spark.createDataFrame([("1", "u@x")], "id string, name string")
    services = spark.createDataFrame([("s1", "app")], "id string, name string")
    got = {tuple(r) for r in policy.effective_grants(grants, members, users, services).collect()}
    assert got == {("a", who, "SELECT", s) for who in ("u@x", "app") for s in ("gold", "silver")}
    more = grants.union(spark.createDataFrame([("c", "SELECT", "gold")], grants.schema))
    assert {tuple(r) for r in policy.unreached_roles(more, members, users, services).collect()} == {
        ("b", 1, "no member is a live principal"), ("c", 1, "no members"),
    }
    held = spark.createDataFrame([("u@x",), ("gone",), ("gone",), (policy.EVERYONE,)], "grantee string")
    assert [r[0] for r in policy.stale_grantees(held, users).collect()] == ["gone"]
    used = spark.createDataFrame(
        [("contains_pii", "True"), ("contains_pii", "true"), ("pii_class", "emial"), ("domain", "anything")],
        "tag_name string, tag_value string",
    )
    assert {tuple(r) for r in policy.ungoverned_values(used).collect()} == {
        ("contains_pii", "True", 1), ("pii_class", "emial", 1),
    }


def meta(spark, **over):
    schemas = {
        "tables": "table_schema string, table_name string, table_owner string",
        "table_tags": "table_schema string, table_name string, tag_name string, tag_value string",
        "column_tags": "table_schema string, table_name string, column_name string, tag_name string, tag_value string",
        "column_masks": "table_schema string, table_name string, column_name string, mask_name string",
        "row_filters": "table_schema string, table_name string, filter_name string",
        "privileges": "table_schema string, table_name string, grantee string, privilege_type string",
        "tag_policies": "pii_class string, scope string",
        "exceptions": "principal string, scope string",
    }
    return register.Metadata(**{k: spark.createDataFrame(over.get(k, []), s) for k, s in schemas.items()})


def test_every_verdict_of_the_register(spark):
    names = ["unclassified", "unprotected", "pii", "owner", "protected", "approved", "plain", "halfmask", "capital"]
    s = "bronze"
    rows = {
        "tables": [(s, n, "o") for n in names],
        "table_tags": [(s, n, "contains_pii", "false") for n in ("owner", "protected", "approved", "plain")]
        + [(s, "pii", "contains_pii", "true"), (s, "capital", "contains_pii", "True"), (s, "plain", "domain", "hr")],
        "column_tags": [
            (s, "unprotected", "c", "data_sensitivity", "restricted"),
            (s, "protected", "c", "data_sensitivity", "Restricted"),
            (s, "protected", "c", "pii_class", "special_category"),
            (s, "halfmask", "a", "data_sensitivity", "restricted"),
            (s, "halfmask", "b", "data_sensitivity", "restricted"),
            (s, "plain", "n", "pii_class", "name"),
        ],
        "column_masks": [(s, "halfmask", "a", "m")],
        "row_filters": [(s, "plain", "f")],
        "privileges": [(s, n, "stranger", "SELECT") for n in ("unprotected", "protected", "plain", "halfmask", "plain")]
        + [(s, "pii", "stranger", "ALL_PRIVILEGES"), (s, "capital", "stranger", "ALL_PRIVILEGES")]
        + [(s, "approved", "friend", "SELECT"), (s, "approved", "friend", "ALL_PRIVILEGES"), (s, "owner", "x", "MODIFY")],
        "tag_policies": [("special_category", s)],
        "exceptions": [("friend", s), ("stranger", "silver")],
    }
    got = {r.table_name: r for r in register.stewardship_register(meta(spark, **rows)).collect()}
    assert {n: r.review_flag for n, r in got.items()} == {
        "unclassified": register.UNCLASSIFIED,
        "unprotected": register.UNPROTECTED,
        "pii": register.UNMASKED_PII,
        "capital": register.UNMASKED_PII,
        "owner": register.OWNER_ONLY,
        "protected": register.PROTECTED,
        "approved": register.APPROVED,
        "plain": register.OK,
        "halfmask": register.UNPROTECTED,
    }
    plain, half, approved = got["plain"], got["halfmask"], got["approved"]
    assert (plain.classified_columns, plain.restricted_columns, plain.row_filter, plain.domain) == (1, 0, "f", "hr")
    assert (half.restricted_columns, half.protected_columns, half.masked_columns) == (2, 1, 1)
    assert (approved.granted_readers, approved.unapproved_readers) == (1, 0)
    full = register.stewardship_register(meta(spark, **rows))
    assert register.findings(full).count() == 5
    assert [r.table_name for r in register.unapproved_on(full, s).collect()] == ["pii"]


def test_stable_id(spark):
    import hashlib

    rows = spark.createDataFrame([("a", "b")], "x string, y string").select(stable_id(F.col("x"), F.col("y")))
    assert rows.first()[0] == hashlib.sha256(b"a|b").hexdigest()[:32]
