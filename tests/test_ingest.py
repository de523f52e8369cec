import os
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from fixtures import FEEDS, change, department, drop, employee

from strata.operators import contracts, ingest as ingest_module
from strata.operators.ingest import Loaded, bronze, build_log, ingest, ledger, unloaded
from strata.operators.uniqueness import SeenKeys, check_new_batches
from strata.plans.hr import CHANGES, DEPARTMENT, EMPLOYEE
from strata.sources.landing import landing_files, settled
from strata.sources.target import Target, review_target

DAY = "2025-01-31"
PROVENANCE_TYPES = {
    "_file_path": "string",
    "_file_name": "string",
    "_file_size": "bigint",
    "_file_last_modified": "timestamp",
    "_file_date": "date",
    "_processed_timestamp": "timestamp",
    "_rescued_data": "string",
}


def test_typed_projection_of_every_feed(target, landing):
    drop(landing, "employee", DAY, "e", [employee(7, DAY, manager_id="", salary_annual="123.40")])
    drop(landing, "department", DAY, "d", [department(1, DAY, parent_dept_id=9, is_active="false")])
    drop(landing, "employee_changes", DAY, "c", [change(7, "2025-01-30", DAY)])
    for feed in FEEDS.values():
        for part in (feed, feed.sidecar()):
            assert ingest(target, part, str(landing)) == Loaded(1, 1)
            types = dict(bronze(target, part).dtypes)
            assert list(types.items()) == [*part.columns, *PROVENANCE_TYPES.items()]
            assert bronze(target, part).filter("_rescued_data is not null").count() == 0
    row = bronze(target, EMPLOYEE).first()
    assert (row.employee_id, row.salary_annual, row.manager_id) == (7, Decimal("123.40"), None)
    assert (row.is_people_manager, row.snapshot_date) == (False, date(2025, 1, 31))
    assert (row._file_name, row._file_date) == ("e.csv", date(2025, 1, 31))
    assert row._file_size == os.path.getsize(landing / "employee" / DAY / "e.csv")
    assert bronze(target, DEPARTMENT).first().parent_dept_id == 9
    assert bronze(target, CHANGES).first().event_date == date(2025, 1, 30)
    sidecar = bronze(target, EMPLOYEE.sidecar()).first()
    assert (sidecar.file_name, sidecar.record_count, sidecar._file_name) == ("e.csv", 1, "e.ctrl")


def test_text_that_is_no_value_stops_the_load(target, landing):
    drop(landing, "department", DAY, "d", [department("one", DAY)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest(target, DEPARTMENT, str(landing))


def test_files_load_once_by_path_and_time(target, landing):
    first = drop(landing, "department", DAY, "d", [department(1, DAY)], mtime=1_700_000_000)
    assert ingest(target, DEPARTMENT, str(landing)) == Loaded(1, 1)
    assert ingest(target, DEPARTMENT, str(landing)) == Loaded(0, 0)
    # The same name under another date is another file.
    drop(landing, "department", "2025-02-28", "d", [department(1, "2025-02-28")], mtime=1_700_000_000)
    assert ingest(target, DEPARTMENT, str(landing)).files == 1
    # A new modification time is a new version; the count check then reports the double load.
    os.utime(first, (1_700_000_100, 1_700_000_100))
    assert ingest(target, DEPARTMENT, str(landing)).files == 1
    assert bronze(target, DEPARTMENT).count() == 3
    ingest(target, DEPARTMENT.sidecar(), str(landing))
    found = contracts.record_counts("d", bronze(target, DEPARTMENT.sidecar()), bronze(target, DEPARTMENT))
    assert [(r.declared, r.loaded, r.reason) for r in found.collect()] == [(1, 2, contracts.COUNT_DIFFERS)]


def test_header_only_file_is_remembered(target, landing):
    drop(landing, "employee_changes", DAY, "none", [])
    assert ingest(target, CHANGES, str(landing)) == Loaded(1, 1)
    assert ingest(target, CHANGES, str(landing)) == Loaded(0, 0)
    assert bronze(target, CHANGES).count() == 0


def test_names_with_special_characters(target, landing):
    drop(landing, "department", DAY, "a b+c [1] 50%", [department(1, DAY)])
    assert ingest(target, DEPARTMENT, str(landing)).files == 1
    assert bronze(target, DEPARTMENT).first()._file_name == "a b+c [1] 50%.csv"
    ingest(target, DEPARTMENT.sidecar(), str(landing))
    files = landing_files(target.spark, str(landing), "*.csv")
    assert contracts.presence(files, [bronze(target, DEPARTMENT.sidecar())]).count() == 0


def test_nulls_in_the_ledger_do_not_stop_ingestion(spark):
    schema = "_file_path string, _file_last_modified timestamp"
    when = datetime(2025, 1, 1)
    files = spark.createDataFrame([("a", when), ("b", when)], schema)
    seen = spark.createDataFrame([("a", when), (None, None), ("b", None)], schema)
    assert [r._file_path for r in unloaded(files, seen).collect()] == ["b"]


def test_settled_files_only(target, landing, spark):
    import time

    drop(landing, "department", DAY, "old", [department(1, DAY)], mtime=time.time() - 500)
    drop(landing, "department", DAY, "young", [department(2, DAY)])
    assert ingest(target, DEPARTMENT, str(landing), quiet_seconds=90).files == 1
    assert [r.dept_id for r in bronze(target, DEPARTMENT).collect()] == [1]
    assert ingest(target, DEPARTMENT, str(landing)).files == 1
    from pyspark.sql import functions as F

    files = landing_files(spark, str(landing), "*.csv")
    assert settled(files, F.current_timestamp(), 90).count() == 1


def test_many_batches_and_a_run_that_died(target, landing, monkeypatch):
    for i in range(6):
        drop(landing, "department", DAY, f"d{i}", [department(i, DAY)])

    def die(*_):
        raise RuntimeError("executor gone")

    # Dies after the first batch's rows are written and before they are recorded.
    monkeypatch.setattr(ingest_module, "log_batch", die)
    with pytest.raises(RuntimeError):
        ingest(target, DEPARTMENT, str(landing), files_per_batch=2)
    monkeypatch.undo()
    planned = ledger(target, DEPARTMENT).select("batch").distinct().count()
    assert planned > 1 and ledger(target, DEPARTMENT).count() == 6
    assert ingest(target, DEPARTMENT, str(landing), files_per_batch=2) == Loaded(0, planned)
    assert sorted(r.dept_id for r in bronze(target, DEPARTMENT).collect()) == list(range(6))
    log = build_log(target, DEPARTMENT.table)
    assert sorted(r.version for r in log.collect()) == list(range(planned))


def test_file_replaced_before_its_batch_is_loaded(target, landing, monkeypatch):
    path = drop(landing, "department", DAY, "d", [department(1, DAY)], mtime=1_700_000_000)
    drop(landing, "department", DAY, "other", [department(2, DAY)])

    def die(*_):
        raise RuntimeError("driver gone")

    monkeypatch.setattr(ingest_module, "_load", die)
    with pytest.raises(RuntimeError):
        ingest(target, DEPARTMENT, str(landing))
    monkeypatch.undo()
    # Replaced by an even older copy: the planned version is gone, the new one loads once.
    path.write_text(path.read_text().replace("D1", "X1"))
    os.utime(path, (1_600_000_000, 1_600_000_000))
    assert ingest(target, DEPARTMENT, str(landing)) == Loaded(1, 2)
    assert sorted(r.dept_code for r in bronze(target, DEPARTMENT).collect()) == ["D2", "X1"]


def test_full_refresh_equals_a_first_load(target, landing):
    for i in range(3):
        drop(landing, "department", DAY, f"d{i}", [department(i, DAY)])
    ingest(target, DEPARTMENT, str(landing))
    drop(landing, "department", DAY, "d3", [department(3, DAY)])
    ingest(target, DEPARTMENT, str(landing))
    assert ingest(target, DEPARTMENT, str(landing), full_refresh=True).files == 4
    assert sorted(r.dept_id for r in bronze(target, DEPARTMENT).collect()) == [0, 1, 2, 3]
    assert ingest(target, DEPARTMENT, str(landing)) == Loaded(0, 0)
    operations = [r.operation for r in build_log(target, DEPARTMENT.table).orderBy("version").collect()]
    assert operations == ["WRITE", "WRITE", "CREATE OR REPLACE"]


def test_new_columns_are_appended(target, landing):
    drop(landing, "department", DAY, "d0", [department(0, DAY)])
    ingest(target, DEPARTMENT, str(landing))
    wider = replace(DEPARTMENT, columns=(*DEPARTMENT.columns, ("region", "string")))
    drop(landing, "department", "2025-02-28", "d1", [[1, "D1", "n", "", "true", "c", "l", "2025-02-28", "EU"]],
         header=wider.column_names)
    ingest(target, wider, str(landing))
    rows = {r.dept_id: r.region for r in bronze(target, wider).collect()}
    assert rows == {0: None, 1: "EU"}


def test_drift_is_captured(target, landing):
    good = [1, "D1", "n", "", "true", "c", "l", DAY]
    drop(landing, "department", DAY, "extra", [[*good, "surplus"]])
    drop(landing, "department", DAY, "short", [good[:6]])
    drop(landing, "department", DAY, "fine", [good])
    ingest(target, DEPARTMENT, str(landing))
    found = contracts.rescued({DEPARTMENT.table: bronze(target, DEPARTMENT)})
    assert {r._file_name for r in found.collect()} == {"extra.csv", "short.csv"}


@pytest.mark.parametrize("per_task", [10_000, 1])
def test_listing_sees_every_object_at_any_depth_once(spark, landing, per_task):
    drop(landing, "department", DAY, "zero", [], raw="", sidecar=False)
    full = drop(landing, "department", DAY, "full", [department(1, DAY)], sidecar=False)
    # From any root, with as little as one entry per task and round; hidden objects do not count.
    for place in ("", "department", "department/2025-02-01/a b/1/2/3/4/5/deep", "department/2025-02-01/_temporary"):
        folder = landing / place
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "e+1.csv").touch()
    (landing / "department" / ".hidden.csv").touch()
    (landing / "department" / "other.txt").touch()
    rows = landing_files(spark, str(landing), "*.csv", per_task).collect()
    base = f"file:{landing}"
    assert sorted(r._file_path for r in rows) == sorted([
        f"{base}/department/{DAY}/zero.csv", f"{base}/department/{DAY}/full.csv", f"{base}/e+1.csv",
        f"{base}/department/e+1.csv", f"{base}/department/2025-02-01/a%20b/1/2/3/4/5/deep/e+1.csv",
    ])
    assert {r.file_name for r in rows if r.length} == {"full.csv"}
    # Paths, times and sizes are those Spark reports for what it reads.
    meta = spark.read.text(str(full)).select("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size")
    listed = next(r for r in rows if r.length)
    assert tuple(meta.first()) == (listed._file_path, listed._file_last_modified, listed.length)
    assert landing_files(spark, str(landing / "department"), "*.none", per_task).count() == 0


def test_times_in_whole_seconds_mean_the_same_version(spark):
    schema = "_file_path string, _file_last_modified timestamp"
    seen = spark.createDataFrame([("a", datetime(2025, 1, 1, 1, 1, 1)), ("b", datetime(2025, 1, 1, 1, 1, 1, 5_000))], schema)
    files = spark.createDataFrame([(p, datetime(2025, 1, 1, 1, 1, s, ms)) for p, s, ms in (
        ("a", 1, 7_000), ("a", 2, 0), ("b", 1, 0), ("b", 1, 7_000))], schema)
    left = sorted((r._file_path, r._file_last_modified.second, r._file_last_modified.microsecond) for r in unloaded(files, seen).collect())
    assert left == [("a", 2, 0), ("b", 1, 7_000)]


STEPS = ("create", "put_batch", "append", "publish", "sweep")


def test_a_refresh_that_dies_after_any_step_loses_nothing(spark, landing, tmp_path, monkeypatch):
    drop(landing, "department", DAY, "a", [department(1, DAY)])
    drop(landing, "department", DAY, "b", [department(2, DAY)])

    class Died(Exception):
        pass

    for step in range(40):
        target = Target(spark, str(tmp_path / f"built{step}"), f"die{step}_").setup()
        ingest(target, DEPARTMENT, str(landing))
        left = [step]

        def dying(method):
            def run(*args, **kwargs):
                out = method(*args, **kwargs)
                left[0] -= 1
                if left[0] < 0:
                    raise Died
                return out

            return run

        for name in STEPS:
            monkeypatch.setattr(Target, name, dying(getattr(Target, name)))
        try:
            ingest(target, DEPARTMENT, str(landing), full_refresh=True)
            finished = True
        except Died:
            finished = False
        monkeypatch.undo()
        late = drop(landing, "department", DAY, f"late{step}", [department(100 + step, DAY)])
        ingest(target, DEPARTMENT, str(landing))
        want = sorted(path.stem for path in (landing / "department" / DAY).glob("*.csv"))
        got = sorted(r._file_name.removesuffix(".csv") for r in bronze(target, DEPARTMENT).collect())
        assert got == want, (step, late)
        assert ingest(target, DEPARTMENT, str(landing)) == Loaded(0, 0)
        for layer in ("bronze", "governance"):
            names = [t.name for t in spark.catalog.listTables(f"{target.prefix}{layer}")]
            assert len([n for n in names if "__g" in n]) == (1 if layer == "bronze" else 2)
        if finished:
            break
    assert finished and step > 5


def test_ledger_reads_the_months_it_needs_and_stays_small(target, landing, monkeypatch):
    monkeypatch.setattr(ingest_module.compact, "__defaults__", (3,))
    days = [f"2025-{m:02d}-09" for m in range(1, 4)]
    for run in range(7):
        for day in days[: 1 + run % 3]:
            drop(landing, "department", day, f"d{run}", [department(run, day)])
        drop(landing, "department", "undated", f"d{run}", [department(run, DAY)])
        assert ingest(target, DEPARTMENT, str(landing)).batches == 1
    held = ledger(target, DEPARTMENT)
    assert held.count() == held.select("_file_path").distinct().count() == bronze(target, DEPARTMENT).count()
    assert held.groupBy("file_month").agg({"part": "approx_count_distinct"}).agg({"approx_count_distinct(part)": "max"}).first()[0] <= 4
    assert ingest(target, DEPARTMENT, str(landing)) == Loaded(0, 0)
    store = ingest_module.current(target, DEPARTMENT)
    files = target.spark.createDataFrame([(f"file:/x/{days[0]}/new.csv", date(2025, 1, 1))], "_file_path string, file_month date")
    from pyspark.sql import functions as F

    seen = target.table("governance", store.ledger).where(ingest_module._of_months(files, F.col("file_month")))
    mode = target.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = seen._jdf.queryExecution().explainString(mode)
    assert "file_month" in plan.split("PartitionFilters: [")[1].split("\n")[0]
    assert {r.file_month for r in seen.collect()} == {date(2025, 1, 1)}


def test_bronze_as_of_reads_the_batches_of_then(target, landing):
    moments = []
    for run in range(3):
        drop(landing, "department", DAY, f"d{run}", [department(run, DAY)])
        ingest(target, DEPARTMENT, str(landing))
        moments.append(build_log(target, DEPARTMENT.table).agg({"logged_at": "max"}).first()[0])
    for run, moment in enumerate(moments):
        then = ingest_module.as_of_batches(target, DEPARTMENT, moment)
        assert sorted(r.dept_id for r in then.collect()) == list(range(run + 1))
    assert "_batch_id" in then._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert ingest_module.as_of_batches(target, DEPARTMENT, datetime(2000, 1, 1)).count() == 0
    ingest(target, DEPARTMENT, str(landing), full_refresh=True)
    with pytest.raises(ingest_module.RewrittenSince):
        ingest_module.as_of_batches(target, DEPARTMENT, moments[0])
    assert ingest_module.as_of_batches(target, DEPARTMENT, datetime(2100, 1, 1)).count() == 3


def test_review_copy_is_isolated(target, landing, tmp_path):
    with pytest.raises(ValueError):
        review_target(target, target.prefix, str(tmp_path / "other"))
    with pytest.raises(ValueError):
        review_target(target, "", str(tmp_path / "other"))
    with pytest.raises(ValueError):
        review_target(target, "other_", target.root)
    copy = review_target(target, f"review_{target.prefix}", str(tmp_path / "review")).setup()
    drop(landing, "department", DAY, "d", [department(1, DAY)])
    for where in (target, copy):
        assert ingest(where, DEPARTMENT, str(landing)).files == 1
    drop(landing, "department", DAY, "d2", [department(2, DAY)])
    ingest(copy, DEPARTMENT, str(landing))
    assert (bronze(target, DEPARTMENT).count(), bronze(copy, DEPARTMENT).count()) == (1, 2)


def test_reload_drops_what_departed(target):
    schema = "principal string, dept_id bigint"
    target.reload("governance", "dept_access", [("gone", 1), ("stays", 2)], schema)
    rows = target.reload("governance", "dept_access", [("stays", 2)], schema)
    assert [tuple(r) for r in rows.collect()] == [("stays", 2)]


def test_new_batches_are_checked_against_all_before(target, landing):
    columns = ("dept_id", "snapshot_date")
    drop(landing, "department", DAY, "a", [department(1, DAY), department(2, DAY)])
    ingest(target, DEPARTMENT, str(landing))
    assert check_new_batches(target, DEPARTMENT, columns).count() == 0
    path = drop(landing, "department", DAY, "b", [department(2, DAY), department(3, DAY), department(3, DAY)])
    ingest(target, DEPARTMENT, str(landing))
    found = {(r.dept_id, r.n, r.loaded_before, r.batch) for r in check_new_batches(target, DEPARTMENT, columns).collect()}
    assert found == {(2, 1, True, 1), (3, 2, False, 1)}
    # Nothing new, nothing to look at; a double load is found; the first load is not read for it.
    assert check_new_batches(target, DEPARTMENT, columns).count() == 0
    os.utime(path, (1_700_000_100, 1_700_000_100))
    ingest(target, DEPARTMENT, str(landing))
    again = check_new_batches(target, DEPARTMENT, columns)
    assert {(r.dept_id, r.loaded_before, r.batch) for r in again.collect()} == {(2, True, 2), (3, True, 2)}
    keys = SeenKeys(target, DEPARTMENT.table, columns)
    assert keys.seen().count() == 2 + 2 + 2
    rows = target.table("bronze", DEPARTMENT.table).where("_batch_id = 2")
    keys.remember(rows, 2)
    assert keys.seen().count() == 6 and keys.check(rows, 2).count() == 2
    ingest(target, DEPARTMENT, str(landing), full_refresh=True)
    assert {(r.dept_id, r.n) for r in check_new_batches(target, DEPARTMENT, columns).collect()} == {(2, 2), (3, 2)}
    assert keys.seen().count() == 3


def test_null_keys(target, spark):
    one = SeenKeys(target, "x", ("a",)).setup()
    two = SeenKeys(target, "x", ("a", "b")).setup()
    rows = spark.createDataFrame([(None, "a"), ("a", None), (None, "a"), ("b", "c")], "a string, b string")
    assert one.check(rows, 0).count() == 0
    assert [tuple(r) for r in two.check(rows, 0).collect()] == [(None, "a", 2, False)]
    for keys in (one, two):
        keys.remember(rows, 0)
    assert {r.a for r in one.check(rows, 1).collect()} == {"a", "b"} and two.check(rows, 1).count() == 3
