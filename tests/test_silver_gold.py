import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.current import RECENCY, current_rows
from strata.operators.headcount import build_headcount, headcount_by_department
from strata.operators.upsert import Keyed, Snapshot

SCHEMA = (
    "k bigint, v string, snapshot_date date, _file_last_modified timestamp, "
    "_processed_timestamp timestamp, _file_path string"
)
BUILD = datetime(2025, 3, 1)


def versions(spark, rows):
    return spark.createDataFrame([(k, v, d, m, BUILD, p) for k, v, d, m, p in rows], SCHEMA)


def test_correction_on_the_same_date_wins(spark):
    day = date(2025, 1, 31)
    rows = versions(spark, [
        (1, "stale", day, datetime(2025, 2, 1), "z.csv"),
        (1, "corrected", day, datetime(2025, 2, 2), "a.csv"),
        (2, "lower path", day, datetime(2025, 2, 1), "a.csv"),
        (2, "greater path", day, datetime(2025, 2, 1), "b.csv"),
        (3, "dated", day, datetime(2025, 2, 1), "a.csv"),
        (3, "undated", None, datetime(2025, 2, 9), "b.csv"),
        (None, "no key", day, datetime(2025, 2, 1), "a.csv"),
    ])
    picked = {r.k: r.v for r in current_rows(rows, "k").collect()}
    assert picked == {1: "corrected", 2: "greater path", 3: "dated", None: "no key"}
    assert "_recency" not in current_rows(rows, "k").columns


def test_current_rows_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 60)
        day = rng.choice([None, date(2025, 1, rng.randrange(1, 5))])
        rows.append((key, f"v{i}", day, datetime(2025, 2, rng.randrange(1, 4)), f"p{i}"))
    low = date(1, 1, 1)
    best = {}
    for k, v, d, m, p in rows:
        rank = (d is not None, d or low, m, p)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, v)
    got = {r.k: r.v for r in current_rows(versions(spark, rows).repartition(7), "k").collect()}
    assert got == {k: v for k, (_, v) in best.items()}
    bronze = versions(spark, rows)
    assert quality.wrongly_picked("e", current_rows(bronze, "k"), bronze, "k", RECENCY).count() == 0
    stale = bronze.groupBy("k").agg(F.min(F.struct(*RECENCY)).alias("s")).select("k", "s.*")
    wrong = quality.wrongly_picked("e", stale, bronze, "k", RECENCY)
    assert wrong.count() == sum(1 for k in best if sum(r[0] == k for r in rows) > 1)


def test_plan_prunes_before_the_shuffle(spark):
    # Enough keys and columns for a real plan; the limit must sit below the exchange too.
    plan = current_rows(versions(spark, [(1, "a", date(2025, 1, 1), BUILD, "p")]), "k")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text and "Final" in text


PEOPLE = (
    "employee_id bigint, dept_id bigint, salary_annual decimal(12,2), is_people_manager boolean, "
    "employment_type string, is_employed boolean"
)
DEPTS = "dept_id bigint, dept_code string, dept_name string, cost_centre string, is_active boolean"


@pytest.fixture(scope="module")
def org(spark):
    people = spark.createDataFrame(
        [
            (1, 1, Decimal("100.00"), True, "full_time", True),
            (2, 1, Decimal("50.01"), None, None, True),
            (3, 1, Decimal("9.00"), True, "full_time", False),
            (4, 2, None, False, "part_time", True),
            (5, 2, Decimal("5.00"), False, "part_time", None),
        ],
        PEOPLE,
    )
    depts = spark.createDataFrame([(i, f"D{i}", f"n{i}", "cc", True) for i in (1, 2, 3)], DEPTS)
    return people, depts


def test_headcount_counts_the_employed_only(org):
    gold = {r.dept_id: r for r in headcount_by_department(*org).collect()}
    assert tuple(gold[1])[5:] == (2, 1, 1, Decimal("150.01"), Decimal("75.01"))
    assert tuple(gold[2])[5:] == (1, 0, 0, Decimal("0.00"), None)
    assert tuple(gold[3])[5:] == (0, 0, 0, Decimal("0.00"), None)


def test_reconciliation_goes_red(org, spark):
    people, depts = org
    gold = headcount_by_department(people, depts)
    assert quality.headcount_gap(people, gold).count() == 0
    emptied = quality.headcount_gap(people, gold.limit(0)).collect()
    assert [(r.expected, r.actual, r.rows_in_gold) for r in emptied] == [(3, None, 0)]
    lost = spark.createDataFrame([(9, 99, Decimal("1.00"), False, "full_time", True)], PEOPLE)
    staff = people.unionByName(lost)
    gap = quality.headcount_gap(staff, headcount_by_department(staff, depts)).collect()
    assert [(r.expected, r.actual) for r in gap] == [(4, 3)]
    orphans = quality.orphans(staff, "dept_id", depts, "dept_id").collect()
    assert [r.employee_id for r in orphans] == [9]
    unassigned = staff.withColumn("dept_id", F.lit(None).cast("bigint"))
    assert quality.orphans(unassigned, "dept_id", depts, "dept_id").count() == 0


def test_rules_in_one_pass(org):
    people, _ = org
    rules = [quality.not_null("salary_annual"), quality.not_null("employee_id"), quality.at_least("salary_annual", 9)]
    tally = {r.check_name: (r.population, r.failures) for r in quality.rule_tally("p", people, rules).collect()}
    assert tally == {
        "p.not_null_salary_annual": (5, 1),
        "p.not_null_employee_id": (5, 0),
        "p.between_salary_annual": (5, 1),
    }


def test_duplicates(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b")], "k bigint, p string")
    assert [tuple(r) for r in quality.duplicates(rows, ["k"]).collect()] == [(1, 2)]
    combos = {tuple(r) for r in quality.duplicates(rows, ["k", "p"]).collect()}
    assert combos == {(1, "a", 2), (None, "b", 2)}
    found = quality.duplicate_keys([("x", rows, "k"), ("y", rows.limit(1), "k")])
    assert [tuple(r) for r in found.collect()] == [("x", "1", 2)]


def test_runner_fails_on_nothing_and_on_missing_checks(org):
    people, _ = org
    none = people.limit(0)
    good = quality.tally("good", none, people)
    rows = quality.require(quality.results([good]), 1)
    assert [(r.status, r.population, r.failures) for r in rows] == [("passed", 5, 0)]
    with pytest.raises(quality.ChecksFailed, match="empty: vacuous"):
        quality.require(quality.results([good, quality.tally("empty", none, none)]), 2)
    with pytest.raises(quality.ChecksFailed, match="1 checks ran, 2 expected"):
        quality.require(quality.results([good]), 2)
    with pytest.raises(quality.ChecksFailed, match="bad: failed"):
        quality.require(quality.results([quality.tally("bad", people.limit(2), people)]), 1)


def test_metric_names_and_descriptions(spark):
    rows = [
        ("g", "headcount_people", "one row per employed person"),
        ("g", "Headcount", "too vague a name"),
        ("g", "fte", None),
        ("g", "manager_count", "   short   "),
        ("g", "salary_total", None),
        ("g", "dept_id", None),
    ]
    columns = spark.createDataFrame(rows, "table_name string, column_name string, comment string")
    assert quality.ambiguous_names(columns).first()[0] == "g.Headcount,g.fte"
    assert quality.undocumented_measures(columns).first()[0] == "g.manager_count,g.salary_total"
    clean = columns.limit(1)
    assert quality.ambiguous_names(clean).first()[0] == "yes"
    assert quality.undocumented_measures(clean).first()[0] == "yes"


def keyed_people(target):
    return Keyed(target, "silver", "people", ("employee_id",), ("day", "seq"))


def person(rng, day, seq, key=None):
    key = rng.randrange(1, 400) if key is None else key
    pay = None if rng.random() < 0.1 else Decimal(rng.randrange(0, 9_999_999)) / 100
    return (key, rng.choice([None, 1, 1, 1, 2, 3, 9]), pay, rng.choice([True, False, None]),
            rng.choice(["full_time", "part_time", None]), rng.random() < 0.7, day, seq)


MOVES = f"{PEOPLE}, day int, seq int"


def same(a, b):
    rows = lambda f: sorted((tuple(r) for r in f.collect()), key=repr)
    return rows(a) == rows(b.select(*a.columns))


def test_merges_rewrite_the_buckets_they_touch(target, spark):
    rng = random.Random(5)
    people, every = keyed_people(target), [person(rng, 0, i) for i in range(900)]
    frame = lambda rows: spark.createDataFrame(rows, MOVES)
    people.start(frame(every), {"merged": "0"}, 8)
    first = people.snapshot()
    assert first.versions == dict.fromkeys(range(8), 0)
    assert same(target.table("silver", "people"), current_rows(frame(every), "employee_id", ("day", "seq")))
    # One correction, one bucket; a row older than the one that is there changes nothing.
    for fresh in ([person(rng, 1, 900, key=7)], [person(rng, -1, 901, key=7)], [person(rng, 2, i) for i in range(300)]):
        before = people.snapshot()
        touched = people.merge(frame(fresh), {"merged": str(len(every))})
        every += fresh
        assert same(target.table("silver", "people"), current_rows(frame(every), "employee_id", ("day", "seq")))
        assert target.properties("silver", "people")["merged"] == str(len(every) - len(fresh))
        changed = {b for b, v in people.snapshot().versions.items() if before.versions[b] != v}
        assert changed == set(touched) and (len(fresh) > 1 or len(touched) == 1)
        # Who reads the snapshot before still can.
        assert same(people.of(before), current_rows(frame(every[: -len(fresh)]), "employee_id", ("day", "seq")))
    assert people.merge(frame([]), {}) == []
    assert people.forget([people.snapshot()]) > 8 and people.forget([people.snapshot()]) == 0
    assert Snapshot.read(people.snapshot().note()) == people.snapshot()
    none = Keyed(target, "silver", "nobody", ("employee_id",), ("day", "seq"))
    none.start(frame([]), {}, 4)
    assert target.table("silver", "nobody").count() == 0
    assert none.merge(frame([person(rng, 1, 1)]), {}) != [] and target.table("silver", "nobody").count() == 1


def test_a_dead_merge_is_not_seen(target, spark, monkeypatch):
    rng = random.Random(6)
    people, every = keyed_people(target), [person(rng, 0, i) for i in range(60)]
    people.start(spark.createDataFrame(every, MOVES), {}, 4)
    fresh = [person(rng, 1, i, key=k) for i, k in enumerate((1, 2, 3))]
    monkeypatch.setattr(Keyed, "_publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        people.merge(spark.createDataFrame(fresh, MOVES), {})
    monkeypatch.undo()
    want = lambda rows: current_rows(spark.createDataFrame(rows, MOVES), "employee_id", ("day", "seq"))
    assert same(target.table("silver", "people"), want(every))
    people.merge(spark.createDataFrame(fresh[:2], MOVES), {})
    assert same(target.table("silver", "people"), want(every + fresh[:2]))


def test_gold_from_changed_buckets_equals_gold_from_all(target, spark, monkeypatch):
    rng = random.Random(8)
    depts = spark.createDataFrame([(i, f"D{i}", f"n{i}", "cc", i != 2) for i in (1, 2, 3, 4)], DEPTS)
    people, every = keyed_people(target), [person(rng, 0, i) for i in range(700)]
    people.start(spark.createDataFrame(every, MOVES), {}, 16)
    assert build_headcount(target, "headcount", people, depts) == list(range(16))
    for step in range(4):
        if step == 2:  # a department that had staff before it was listed
            depts = depts.union(spark.createDataFrame([(9, "D9", "n9", "cc", True)], DEPTS))
        keys = (5,) if step == 0 else () if step == 3 else range(1, 400, 90)
        fresh = [person(rng, step + 1, i, key=k) for i, k in enumerate(keys)]
        touched = people.merge(spark.createDataFrame(fresh, MOVES), {})
        assert build_headcount(target, "headcount", people, depts) == touched and len(touched) < 8
        gold = target.table("gold", "headcount")
        assert same(gold, headcount_by_department(target.table("silver", "people"), depts))
        assert gold.columns == headcount_by_department(target.table("silver", "people"), depts).columns
        assert gold.dtypes[-2:] == [("total_salary", "decimal(23,2)"), ("avg_salary", "decimal(13,2)")]
    # Another view of silver, or another generation of it, is read whole.
    assert len(build_headcount(target, "headcount", people, depts, seen_as="someone else")) == 16
    people.start(target.table("silver", "people"), {}, 4)
    assert len(build_headcount(target, "headcount", people, depts, seen_as="someone else")) == 4
    assert same(target.table("gold", "headcount"), headcount_by_department(target.table("silver", "people"), depts))
