import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from fixtures import change, department, drop, employee, standard
from pyspark.sql import functions as F

from strata.operators import contracts, policy, quality, register
from strata.operators.ingest import bronze, build_log, ingest, ledger
from strata.plans import hr
from strata.sources.landing import file_md5, header_lines

DAY, LATE = "2025-01-31", "2025-03-31"


def failing(outcome):
    return {r.check_name for r in outcome.collect() if r.status == "failed"}


def test_build_end_to_end(target, landing):
    root = standard(landing)
    hr.build(target, root)
    gold = {r.dept_id: r for r in target.table("gold", hr.GOLD_HEADCOUNT).collect()}
    assert set(gold) == {1, 2, 3}
    one, two, three = gold[1], gold[2], gold[3]
    assert (one.headcount_people, one.managers, one.full_time) == (3, 1, 2)
    assert one.total_salary == Decimal("171000.75") and one.avg_salary == Decimal("57000.25")
    assert (two.headcount_people, two.full_time, two.total_salary) == (2, 1, Decimal("110000.00"))
    assert (three.headcount_people, three.managers, three.full_time) == (0, 0, 0)
    assert three.total_salary == 0 and three.avg_salary is None
    types = dict(target.table("gold", hr.GOLD_HEADCOUNT).dtypes)
    assert types["total_salary"] == "decimal(23,2)" and types["avg_salary"] == "decimal(13,2)"
    assert types["headcount_people"] == "bigint" and types["managers"] == "bigint"

    silver = target.table("silver", hr.SILVER_EMPLOYEE)
    assert len(silver.columns) == 24 and "date_of_birth" not in silver.columns
    assert silver.count() == 6
    quality.require(hr.checks(target, root), hr.EXPECTED_CHECKS)

    # Descriptions reach the catalog and can be read back.
    columns = hr.gold_columns(target)
    assert quality.undocumented_measures(columns).first()[0] == "yes"
    assert quality.ambiguous_names(columns).first()[0] == "yes"
    target.describe_column("gold", hr.GOLD_HEADCOUNT, "headcount_people", "short")
    assert quality.undocumented_measures(hr.gold_columns(target)).first()[0] == f"{hr.GOLD_HEADCOUNT}.headcount_people"

    # The policies over the built tables: register, metric view, access map.
    rules = hr.hr_governance(target)
    hr.load_access_map(target, [(hr.BIZ.name, 1), (hr.BIZ.name, 3)], date(2025, 3, 1))
    before = hr.register(target, rules)
    assert policy.ungoverned_values(hr.tag_uses(rules, target)).count() == 0
    assert {r.table_name for r in register.unapproved_on(before, "bronze").collect()} == {
        "bronze_hr_employee", "bronze_hr_employee_changes",
    }
    hr.load_exceptions(target, date(2025, 3, 1))
    coverage = [tuple(r) for r in hr.load_coverage(target, rules).collect()]
    assert coverage == [("special_category", "silver", "mask_special_category_by_tag", "mask_redact_string")]
    clean = hr.register(target, rules)
    assert register.findings(clean).count() == 0
    flags = {r.table_name: r.review_flag for r in clean.collect()}
    assert flags[hr.SILVER_EMPLOYEE] == register.PROTECTED and flags[hr.GOLD_HEADCOUNT] == register.PROTECTED
    assert flags["bronze_hr_employee"] == register.APPROVED and len(flags) == 10
    untagged = {k: v for k, v in hr.CONTAINS_PII.items() if k[1] != hr.WORKFORCE}
    red = register.findings(hr.register(target, rules, untagged)).collect()
    # The tag is gone, the layer tag goes with it: unclassified is a finding of its own.
    assert [(r.table_name, r.review_flag) for r in red] == [(hr.WORKFORCE, register.UNCLASSIFIED)]
    assert hr.MV_WORKFORCE.headcount(rules, hr.STEWARD).first().headcount_people == 5
    assert hr.MV_WORKFORCE.headcount(rules, hr.BIZ).first().headcount_people == 3
    assert [r.dept_id for r in rules.read(f"gold.{hr.GOLD_HEADCOUNT}", hr.BIZ).orderBy("dept_id").collect()] == [1, 3]

    # A later delivery full of faults: every one of them is found, and nothing else is.
    drop(landing, "employee", LATE, "employee_late", [
        employee(1, LATE, dept_id=77),
        employee(7, LATE, salary_annual="-1.00"),
        employee(8, LATE, is_employed=""),
    ], count=9)
    drop(landing, "department", LATE, "department_late", [department(1, "2025-03-30")], md5="beef")
    names = list(hr.CHANGES.column_names)
    names[3], names[4] = names[4], names[3]
    drop(landing, "employee_changes", LATE, "changes_late", [[1, LATE, "a", "x", "y", "2025-03-01"]], header=names)
    drop(landing, "employee_changes", LATE, "undeclared", [change(1, LATE, LATE)], sidecar=False)
    drop(landing, "employee_changes", LATE, "wide", [[1, LATE, "a", "x", "y", LATE, "extra"]], header=hr.CHANGES.column_names)
    hr.build(target, root)
    assert failing(hr.checks(target, root)) == {
        "bronze_hr_employee.between_salary_annual",
        "silver_hr_employee.not_null_is_employed",
        "silver_hr_employee.relationships_dept_id",
        "ctrl_files_present",
        "ctrl_md5_matches",
        "ctrl_record_counts.employee",
        "ctrl_record_counts.employee_changes",
        "no_rescued_data",
        "dates_agree",
        "headcount_reconciles",
        "landing_headers_match",
    }
    # The checks that open files can be kept to the new ones.
    late = ledger(target, hr.EMPLOYEE).agg(F.max("listed_at")).first()[0] - timedelta(seconds=5)
    opened = hr.delivered(target, hr.EMPLOYEE, None, late).collect()
    assert [r.file_name for r in opened] == ["employee_late.csv"]
    departments = hr.delivered(target, hr.DEPARTMENT, None, late)
    wrong = contracts.digests(file_md5(departments), [bronze(target, hr.DEPARTMENT.sidecar())])
    assert [r.declared_md5 for r in wrong.collect()] == ["beef"]
    operations = [r.operation for r in build_log(target, hr.GOLD_HEADCOUNT).collect()]
    assert operations == ["CREATE OR REPLACE"] * 2
    assert {r.operation for r in build_log(target, hr.EMPLOYEE.table).collect()} == {"WRITE"}
    assert [r.batch for r in build_log(target, hr.SILVER_EMPLOYEE).orderBy("version").collect()] == [0, 1]

    # The merged silver tables are what a reduction of all of bronze gives.
    for table, feed in ((hr.SILVER_EMPLOYEE, hr.EMPLOYEE), (hr.SILVER_DEPARTMENT, hr.DEPARTMENT)):
        merged, whole = target.table("silver", table), hr.silver(bronze(target, feed), feed)
        assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0

    # As it stood after the first build: bronze is append-only and not masked.
    first = build_log(target, hr.EMPLOYEE.table).agg(F.min("logged_at")).first()[0]
    assert rules.as_of("bronze.bronze_hr_employee", hr.STEWARD, first).count() == 12
    assert bronze(target, hr.EMPLOYEE).count() == 15
    with pytest.raises(policy.AsOfRefused):
        rules.as_of(f"silver.{hr.SILVER_EMPLOYEE}", hr.STEWARD, first)


def test_refresh_restarts_silver(target, landing):
    drop(landing, "department", "2025-01-31", "d", [department(1, "2025-01-31"), department(2, "2025-01-31")])
    drop(landing, "employee", "2025-01-31", "e", [employee(1, "2025-01-31")])
    drop(landing, "employee_changes", "2025-01-31", "c", [])
    hr.build(target, str(landing))
    gone = next((landing / "department" / "2025-01-31").glob("*.csv"))
    gone.write_text(gone.read_text().rsplit("\n", 2)[0] + "\n")
    ingest(target, hr.DEPARTMENT, str(landing), full_refresh=True)
    hr.build(target, str(landing))
    assert [r.dept_id for r in target.table("silver", hr.SILVER_DEPARTMENT).collect()] == [1]
    assert target.table("gold", hr.GOLD_HEADCOUNT).count() == 1


def test_failed_rebuild_keeps_the_old_table(target, spark):
    target.rebuild("silver", "kept", spark.range(3))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        target.rebuild("silver", "kept", spark.range(3).select((F.lit(1) / F.col("id")).alias("id")))
    assert target.table("silver", "kept").count() == 3


def test_a_dead_rebuild_is_not_seen_and_swept(target, spark):
    target.rebuild("silver", "kept", spark.range(3))
    # Died between writing the generation and publishing it; another left a folder and no table.
    spark.range(9).write.saveAsTable(target.name("silver", "kept__g1"))
    spark.range(9).write.parquet(f"{target.root}/silver/kept__g2")
    assert target.table("silver", "kept").count() == 3
    assert target.rebuild("silver", "kept", spark.range(4)).count() == 4
    assert target.generations("silver", "kept") == [0, 1]  # the one before may still have readers
    assert target.rebuild("silver", "kept", spark.range(5)).count() == 5
    assert target.generations("silver", "kept") == [1, 3]


def test_long_notes_and_comments_survive(target, spark):
    note = json.dumps([f"it's \\ {i}" for i in range(2_000)])
    target.rebuild("gold", "noted", spark.range(1), {"id": "the key's \\ comment"}, {"long": note, "none": ""})
    assert target.properties("gold", "noted") == {"generation": "0", "long": note, "none": ""}
    assert [c.description for c in spark.catalog.listColumns(target.name("gold", "noted"))] == ["the key's \\ comment"]


def test_failed_refresh_keeps_table_and_ledger(target, landing):
    drop(landing, "department", DAY, "a", [department(1, DAY)])
    ingest(target, hr.DEPARTMENT, str(landing))
    drop(landing, "department", DAY, "bad", [["x", "D", "N", "", "true", "c", "l", DAY]])
    with pytest.raises(Exception):
        ingest(target, hr.DEPARTMENT, str(landing), full_refresh=True)
    assert target.table("bronze", hr.DEPARTMENT.table).count() == 1
    assert ledger(target, hr.DEPARTMENT).count() == 1


def test_checks_see_files_at_any_depth_and_count_what_they_opened(target, landing):
    names = list(hr.DEPARTMENT.column_names)
    names[1], names[2] = names[2], names[1]
    drop(landing, "department", f"{DAY}/part", "deep", [[1, "Name", "D1", "", "true", "c", "l", DAY]], header=names)
    found = hr.delivered(target, hr.DEPARTMENT, str(landing), None)
    assert [r.file_name for r in found.collect()] == ["deep.csv"]
    assert contracts.headers(header_lines(found), hr.DEPARTMENT).count() == 1
    ingest(target, hr.DEPARTMENT, str(landing))
    later = datetime(2100, 1, 1)
    assert hr.delivered(target, hr.DEPARTMENT, str(landing), later).count() == 0
