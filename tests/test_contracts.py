import hashlib
import os
from dataclasses import replace
from datetime import date

from fixtures import change, declare, department, drop, employee

from strata.operators import contracts
from strata.operators.ingest import bronze, ingest
from strata.plans import hr
from strata.plans.hr import CHANGES, DEPARTMENT, EMPLOYEE
from strata.sources.landing import file_md5, header_lines, landing_files

DAY, NEXT = "2025-01-31", "2025-02-28"


def load(target, landing, *feeds):
    for feed in feeds:
        for part in (feed, feed.sidecar()):
            ingest(target, part, str(landing))
    return [(bronze(target, f), bronze(target, f.sidecar())) for f in feeds]


def present(spark, landing):
    return landing_files(spark, str(landing), "*.csv")


def test_presence_in_both_directions(target, landing):
    drop(landing, "department", DAY, "ok", [department(1, DAY)])
    drop(landing, "department", DAY, "undeclared", [department(2, DAY)], sidecar=False)
    declare(landing, "department", DAY, "lost.csv", 0, "x")
    drop(landing, "department", DAY, "zero", [], raw="")
    (_, sidecar), = load(target, landing, DEPARTMENT)
    files = present(target.spark, landing)
    found = {(r.file_name, r.reason) for r in contracts.presence(files, [sidecar]).collect()}
    assert found == {("undeclared.csv", contracts.UNDECLARED), ("lost.csv", contracts.MISSING)}
    by_name = {(r.file_name, r.reason) for r in contracts.presence(files, [sidecar], by_name=True).collect()}
    assert by_name == found


def test_same_name_on_two_dates(target, landing):
    drop(landing, "department", DAY, "d", [department(1, DAY), department(2, DAY)])
    drop(landing, "department", NEXT, "d", [department(1, NEXT)], sidecar=False)
    (rows, sidecar), = load(target, landing, DEPARTMENT)
    files = present(target.spark, landing)
    assert contracts.presence(files, [sidecar], by_name=True).count() == 0
    found = contracts.presence(files, [sidecar]).collect()
    assert [r.directory.rsplit("/", 1)[1] for r in found] == [NEXT]
    counts = contracts.record_counts("d", sidecar, rows).collect()
    assert [(r.reason, r.loaded) for r in counts] == [(contracts.NO_SIDECAR, 1)]
    named = contracts.record_counts("d", sidecar, rows, by_name=True).collect()
    assert [(r.declared, r.loaded) for r in named] == [(2, 3)]


def test_record_counts(target, landing):
    drop(landing, "department", DAY, "fine", [department(1, DAY)])
    drop(landing, "department", DAY, "empty", [], count=0)
    drop(landing, "department", DAY, "truncated", [department(2, DAY)], count=5)
    drop(landing, "department", DAY, "blank", [department(3, DAY)], count="")
    drop(landing, "department", DAY, "nosidecar", [department(4, DAY)], sidecar=False)
    declare(landing, "department", DAY, "lost.csv", 3, "x")
    (rows, sidecar), = load(target, landing, DEPARTMENT)
    found = {r.file_name: (r.declared, r.loaded, r.reason)
             for r in contracts.record_counts("d", sidecar, rows).collect()}
    assert found == {
        "truncated.csv": (5, 1, contracts.COUNT_DIFFERS),
        "blank.csv": (None, 1, contracts.NULL_COUNT),
        "nosidecar.csv": (None, 1, contracts.NO_SIDECAR),
        "lost.csv": (3, None, contracts.COUNT_DIFFERS),
    }


def test_digests(target, landing):
    fine = drop(landing, "department", DAY, "fine", [department(1, DAY)])
    declared = hashlib.md5(fine.read_bytes()).hexdigest()
    declare(landing, "department", DAY, "fine.csv", 1, declared.upper())
    tampered = drop(landing, "department", DAY, "tampered", [department(2, DAY)], mtime=1_700_000_000)
    tampered.write_text(tampered.read_text().replace("D2", "X2"))
    os.utime(tampered, (1_700_000_000, 1_700_000_000))
    drop(landing, "department", DAY, "nomd5", [department(3, DAY)], md5="")
    drop(landing, "department", DAY, "zero", [], raw="")
    declare(landing, "department", DAY, "lost.csv", 1, "x")
    (_, sidecar), = load(target, landing, DEPARTMENT)
    spark = target.spark
    actual = file_md5(present(spark, landing))
    assert {r.file_name for r in contracts.digests(actual, [sidecar]).collect()} == {"tampered.csv", "nomd5.csv"}
    assert {r.file_name for r in actual.collect()} == {"fine.csv", "tampered.csv", "nomd5.csv", "zero.csv"}
    assert {r.actual_md5 for r in actual.filter("file_name = 'fine.csv'").collect()} == {declared}


def test_dates(target, landing):
    drop(landing, "employee", DAY, "e", [employee(1, NEXT), employee(2, DAY), employee(3, "")])
    drop(landing, "department", DAY, "d", [department(1, NEXT)])
    drop(landing, "employee_changes", DAY, "c", [change(1, NEXT, DAY), change(2, DAY, DAY), change(3, "", DAY)])
    declare(landing, "employee_changes", DAY, "c.csv", 3, "x", business_date=NEXT)
    declare(landing, "employee_changes", NEXT, "other.csv", 0, "x", ctrl_name="c2.ctrl")
    declare(landing, "employee", NEXT, "e2.csv", 0, "x", business_date=DAY)
    frames = load(target, landing, EMPLOYEE, DEPARTMENT, CHANGES)
    feeds = (EMPLOYEE, DEPARTMENT, CHANGES)
    built = hr.Layers(
        data={f.table: rows for f, (rows, _) in zip(feeds, frames)},
        sidecars={f"{f.table}_ctrl": ctrl for f, (_, ctrl) in zip(feeds, frames)},
        employee=None, department=None, gold=None,
    )
    found = sorted((r.check_name, r._file_name, r.a, r.b) for r in hr.date_findings(built).collect())
    assert found == [
        ("changes: event_date after received_date", "c.csv", NEXT, DAY),
        ("changes_ctrl: business_date <> _file_date", "c.ctrl", NEXT, DAY),
        ("changes_ctrl: file_name does not match its sidecar", "c2.ctrl", "other.csv", "c2.csv"),
        ("department: _file_date <> snapshot_date", "d.csv", DAY, NEXT),
        ("employee: _file_date <> snapshot_date", "e.csv", DAY, NEXT),
        ("employee_ctrl: business_date <> _file_date", "e2.ctrl", DAY, NEXT),
    ]


def test_swapped_columns_show_in_the_header_only(target, landing):
    names = list(DEPARTMENT.column_names)
    names[1], names[2] = names[2], names[1]
    drop(landing, "department", DAY, "swapped", [[1, "Name", "D1", "", "true", "c", "l", DAY]], header=names)
    drop(landing, "department", DAY, "fine", [department(2, DAY)])
    ingest(target, DEPARTMENT, str(landing))
    assert contracts.rescued({"d": bronze(target, DEPARTMENT)}).count() == 0
    lines = header_lines(landing_files(target.spark, str(landing), "*.csv"))
    assert [r.file_name for r in contracts.headers(lines, DEPARTMENT).collect()] == ["swapped.csv"]


def test_a_file_declared_twice_is_found(target, landing):
    for name, counts in (("same", (1, 1)), ("other", (1, 2)), ("once", (1,))):
        drop(landing, "department", DAY, name, [department(1, DAY)], sidecar=False)
        for i, count in enumerate(counts):
            declare(landing, "department", DAY, f"{name}.csv", count, "x", ctrl_name=f"{name}{i}.ctrl")
    (rows, sidecar), = load(target, landing, DEPARTMENT)
    found = {r.file_name: r.reason for r in contracts.record_counts("d", sidecar, rows).collect()}
    assert found == {"same.csv": contracts.REPEATED, "other.csv": contracts.CONTRADICTED}


def test_a_second_delivery_declares_only_its_own_files(spark, target, tmp_path):
    from pyspark.sql import functions as F

    from strata.plans import star
    from strata.sources.landing import deliver

    orders = star.delivered_orders(spark, "/root/testdata/sf0.001")
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"):
        deliver(orders.where(part), str(tmp_path), star.ORDERS, F.trunc("o_orderdate", "year"), "sales")
    sidecar = star.ORDERS.sidecar("*.ctl")
    for feed in (star.ORDERS, sidecar):
        ingest(target, feed, str(tmp_path))
    rows, declared = bronze(target, star.ORDERS), bronze(target, sidecar)
    assert declared.agg(F.sum("record_count")).first()[0] == rows.count() == orders.count()
    assert contracts.record_counts("orders", declared, rows).count() == 0


def test_quoted_headers_are_the_same_and_endless_ones_are_found(target, landing, monkeypatch):
    from strata.sources import landing as module

    fine = drop(landing, "department", DAY, "quoted", [department(2, DAY)])
    head, rest = fine.read_text().split("\n", 1)
    fine.write_text(",".join(f'"{n}"' for n in head.strip().split(",")) + "\n" + rest)
    drop(landing, "department", DAY, "endless", [], raw="x" * (module.HEADER_BYTES + 10))
    lines = header_lines(landing_files(target.spark, str(landing), "*.csv"))
    assert [r.file_name for r in contracts.headers(lines, DEPARTMENT).collect()] == ["endless.csv"]


def test_path_date(spark):
    from pyspark.sql import functions as F

    from strata.functions.text import KEYED_DATE_DIRECTORY, path_date

    paths = ["/l/f/2025-01-31/a.csv", "/l/f/2025-13-01/a.csv", "/l/f/a.csv", "/l/f/day=2025-02-01/a.csv"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    strict = [r[0] for r in rows.select(path_date(F.col("p"))).collect()]
    keyed = [r[0] for r in rows.select(path_date(F.col("p"), KEYED_DATE_DIRECTORY)).collect()]
    assert strict == [date(2025, 1, 31), None, None, None]
    assert keyed == [date(2025, 1, 31), None, None, date(2025, 2, 1)]
    assert replace(DEPARTMENT, date_pattern=KEYED_DATE_DIRECTORY).sidecar().date_pattern == KEYED_DATE_DIRECTORY
