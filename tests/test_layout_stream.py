import os
import time
from datetime import datetime

import pytest
from fixtures import department, drop

from strata.operators import layout, quality
from strata.operators.ingest import bronze
from strata.plans.hr import DEPARTMENT
from strata.streaming.arrivals import catch_up, watch


def test_layout_keeps_what_it_cannot_measure(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "good"))
    spark.range(0).write.parquet(str(tmp_path / "hollow"))
    profile = layout.layout_profile(
        spark, {"good": str(tmp_path / "good"), "gone": str(tmp_path / "gone"), "hollow": str(tmp_path / "hollow")}
    )
    rows = {r.table_name: r for r in profile.collect()}
    assert rows["good"].files == 3 and rows["good"].rows == 10 and rows["good"].error is None
    assert rows["good"].bytes == sum(f.stat().st_size for f in (tmp_path / "good").glob("*.parquet"))
    assert rows["gone"].error == "PATH_NOT_FOUND" and rows["gone"].files is None
    assert rows["hollow"].error == "no data files"
    total = layout.totals(profile).first()
    assert (total.files, total.rows, total.unmeasured) == (3, 10, 2)
    unmeasured = quality.tally("layout", profile.filter("error is not null"), profile)
    with pytest.raises(quality.ChecksFailed):
        quality.require(quality.results([unmeasured]), 1)
    with pytest.raises(ValueError):
        layout.layout_profile(spark, {})


def test_growth_looks_at_the_latest_build(spark):
    log = spark.createDataFrame(
        [
            ("bronze", 1, "CREATE OR REPLACE"), ("bronze", 2, "WRITE"), ("bronze", 3, "OPTIMIZE"),
            ("gold", 4, "WRITE"), ("gold", 5, "CREATE OR REPLACE"),
            ("kept", 6, "VACUUM END"),
        ],
        "table_name string, version bigint, operation string",
    )
    got = {r.table_name: tuple(r)[1:] for r in layout.growth(log).collect()}
    assert got == {
        "bronze": (3, 1, "WRITE", True),
        "gold": (2, 4, "CREATE OR REPLACE", False),
        "kept": (1, 6, None, False),
    }
    assert layout.operation_mix(log).count() == 6


def test_as_of_is_a_subset(spark):
    rows = spark.createDataFrame([(datetime(2025, 1, i),) for i in (1, 2, 3)], "_processed_timestamp timestamp")
    assert tuple(layout.subset_of_today(rows, datetime(2025, 1, 2)).first()) == (2, 3, True)


def test_arrival_stream(target, landing, tmp_path):
    state = str(tmp_path / "state")
    first = drop(landing, "department", "2025-01-31", "a", [department(1, "2025-01-31")], mtime=1_700_000_000)
    catch_up(target, DEPARTMENT, str(landing), state)
    assert bronze(target, DEPARTMENT).count() == 1
    # Nothing new: a no-op on both sides.
    assert catch_up(target, DEPARTMENT, str(landing), state).files == 0
    drop(landing, "department", "2025-02-28", "b", [department(2, "2025-02-28")])
    catch_up(target, DEPARTMENT, str(landing), state)
    assert bronze(target, DEPARTMENT).count() == 2
    # Rewritten in place: the stream does not see it, the ledger does.
    os.utime(first, (1_700_000_500, 1_700_000_500))
    watch(target, DEPARTMENT, str(landing), state, quiet_seconds=0).awaitTermination()
    assert bronze(target, DEPARTMENT).count() == 2
    assert catch_up(target, DEPARTMENT, str(landing), state).files == 1
    assert sorted(r.dept_id for r in bronze(target, DEPARTMENT).collect()) == [1, 1, 2]


def until(condition, seconds=90):
    for _ in range(seconds * 4):
        if condition():
            return True
        time.sleep(0.25)
    return False


def test_a_file_that_grows_is_loaded_by_the_stream_alone_and_once(target, landing, tmp_path):
    drop(landing, "department", "2025-01-31", "old", [department(1, "2025-01-31")], mtime=1_700_000_000)
    grows = drop(landing, "department", "2025-01-31", "grows", [department(2, "2025-01-31")])
    gone = drop(landing, "department", "2025-01-31", "gone", [department(9, "2025-01-31")])
    lines = grows.read_text()
    loaded = lambda: sorted(r.dept_id for r in bronze(target, DEPARTMENT).collect()) if target.exists("bronze", DEPARTMENT.table) else []
    stream = watch(target, DEPARTMENT, str(landing), str(tmp_path / "state"), quiet_seconds=6, every_seconds=1)
    try:
        started = time.time()
        gone.unlink()
        while time.time() - started < 10:  # longer than the quiet period
            grows.write_text(lines := lines + lines.splitlines()[1].replace("2,", f"{10 + lines.count(chr(10))},", 1) + "\n")
            time.sleep(1)
            assert set(loaded()) <= {1}
        want = [1] + sorted(int(line.split(",")[0]) for line in lines.splitlines()[1:])
        assert until(lambda: len(loaded()) > 1) and loaded() == want
        drop(landing, "department", "2025-02-28", "late", [department(3, "2025-02-28")])
        assert until(lambda: loaded() == sorted([*want, 3]))
    finally:
        stream.stop()
    assert stream.exception() is None
    assert catch_up(target, DEPARTMENT, str(landing), str(tmp_path / "other")).files == 0
    assert loaded() == sorted([*want, 3])
