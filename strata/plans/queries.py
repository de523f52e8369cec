"""The registered queries: each operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import path_date, stable_id
from strata.operators import contracts, layout, policy, quality, register
from strata.operators.current import current_rows
from strata.operators.headcount import build_headcount
from strata.operators.ingest import as_of_batches, bronze, build_log, ingest, unloaded
from strata.operators.metrics import HEADCOUNTS, layer_equals_table, measures_distinct
from strata.operators.uniqueness import SeenKeys
from strata.operators.upsert import Keyed, bucket_count
from strata.plans import star
from strata.plans.star import ANALYST, BIZ, ORDERS, ROSTER, STEWARD, WORKFORCE, table, user_id
from strata.session import scratch_dir, ship
from strata.sources.landing import deliver, file_md5, landing_files, settled
from strata.sources.target import Target, review_target
from strata.streaming.arrivals import watch

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    def shipped(spark: SparkSession, d: str) -> DataFrame:
        return run(ship(spark), d)

    REGISTRY[run.__name__] = shipped
    return run


# --- landing and bronze -----------------------------------------------------------------


def _landed(spark: SparkSession, d: str, label: str) -> tuple[Target, str]:
    """Orders delivered under the first day of their year, and an empty target."""
    root = scratch_dir(spark, label)
    business_date = F.trunc("o_orderdate", "year")
    deliver(star.delivered_orders(spark, d), f"{root}/landing", ORDERS, business_date, "sales")
    prefix = f"{root.rsplit('/', 1)[1].replace('-', '_')}_"
    return Target(spark, f"{root}/built", prefix).setup(), f"{root}/landing"


def _bronze_orders(target: Target) -> DataFrame:
    return bronze(target, ORDERS).select(*ORDERS.column_names, "_file_date", "_rescued_data")


@query
def ingest_roundtrip(spark, d):
    """Delivered files read back typed, with the business date of their directory."""
    target, landing = _landed(spark, d, "roundtrip")
    ingest(target, ORDERS, landing)
    return _bronze_orders(target)


@query
def ingest_twice(spark, d):
    """A second run over the same files adds nothing."""
    target, landing = _landed(spark, d, "twice")
    for _ in range(2):
        ingest(target, ORDERS, landing)
    return _bronze_orders(target)


@query
def ingest_stream(spark, d):
    """The same rows when file arrival alone triggers the ingest: no batch run follows the stream."""
    target, landing = _landed(spark, d, "stream")
    watch(target, ORDERS, landing, scratch_dir(spark, "stream-state"), quiet_seconds=0).awaitTermination()
    return _bronze_orders(target)


@query
def ingest_refreshed(spark, d):
    """A full refresh loads every file again, beside the table, and takes its place."""
    target, landing = _landed(spark, d, "refreshed")
    ingest(target, ORDERS, landing)
    ingest(target, ORDERS, landing, full_refresh=True)
    return _bronze_orders(target)


@query
def ingest_evolved(spark, d):
    """A feed that gains a column: rows delivered before it read NULL there."""
    root = scratch_dir(spark, "evolved")
    landing, orders = f"{root}/landing", star.delivered_orders(spark, d)
    target = Target(spark, f"{root}/built", f"{root.rsplit('/', 1)[1].replace('-', '_')}_").setup()
    narrow = replace(ORDERS, columns=ORDERS.columns[:-1])
    for feed, odd in ((narrow, 1), (ORDERS, 0)):
        part = orders.where(F.year("o_orderdate") % 2 == odd)
        deliver(part, landing, feed, F.trunc("o_orderdate", "year"), "sales")
        ingest(target, feed, landing)
    return _bronze_orders(target)


@query
def review_copy(spark, d):
    """A review copy loads the same deliveries on its own: what it holds beside the primary, per year."""
    target, landing = _landed(spark, d, "review")
    copy = review_target(target, f"{target.prefix}r_", f"{target.root}-review").setup()
    ingest(target, ORDERS, landing)
    # A second delivery reaches the copy alone.
    late = star.delivered_orders(spark, d).where("o_orderstatus = 'P'")
    deliver(late, landing, ORDERS, F.trunc("o_orderdate", "year"), "sales")
    ingest(copy, ORDERS, landing)
    count = lambda place, name: bronze(place, ORDERS).groupBy("_file_date").agg(F.count(F.lit(1)).alias(name))
    both = count(target, "rows_primary").join(count(copy, "rows_review"), "_file_date", "full")
    return both.withColumnRenamed("_file_date", "business_date")


@query
def control_reloaded(spark, d):
    """An access map replaced whole: nobody who departed survives in it."""
    root = scratch_dir(spark, "reload")
    target = Target(spark, f"{root}/built", f"{root.rsplit('/', 1)[1].replace('-', '_')}_").setup()
    lines, credit = table(spark, d, "lineitem"), table(spark, d, "supplier").where("s_acctbal > 0")
    access = lines.select(F.col("l_suppkey").alias("principal"), F.col("l_partkey").alias("dept_id")).distinct()
    target.rebuild("governance", "dept_access", access)
    stay = target.table("governance", "dept_access").join(credit, F.col("principal") == F.col("s_suppkey"), "left_semi")
    return target.rebuild("governance", "dept_access", stay)


@query
def delivered_dates(spark, d):
    """What a listing of the delivery says per business date, beside the rows loaded from it."""
    target, landing = _landed(spark, d, "dates")
    ingest(target, ORDERS, landing)
    listed = landing_files(spark, landing, ORDERS.glob).select(
        path_date(F.col("_file_path"), ORDERS.date_pattern).alias("business_date"), "length"
    )
    files = listed.groupBy("business_date").agg(F.count_if(F.col("length") > 0).alias("n"))
    rows = bronze(target, ORDERS).groupBy(F.col("_file_date").alias("business_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("_file_path").alias("loaded")
    )
    return files.join(rows, "business_date", "full").select(
        "business_date", "rows", (F.col("n") == F.col("loaded")).alias("every_file_loaded")
    )


@query
def asof_batches(spark, d):
    """Orders as of the first of two batches, beside today: per year, and whether history still holds."""
    root = scratch_dir(spark, "asof")
    orders = star.delivered_orders(spark, d)
    target = Target(spark, f"{root}/built", f"{root.rsplit('/', 1)[1].replace('-', '_')}_").setup()
    moment = None
    for part in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        deliver(orders.where(part), f"{root}/landing", ORDERS, F.trunc("o_orderdate", "year"), "sales")
        ingest(target, ORDERS, f"{root}/landing")
        # The build log's first entry is the oldest state that can be read.
        moment = moment or build_log(target, ORDERS.table).agg(F.max("logged_at")).first()[0]
    name = f"bronze.{ORDERS.table}"
    rules = policy.Governance(
        tables={name: lambda: bronze(target, ORDERS)},
        access_map=lambda: None,
        grants=(policy.Grant(STEWARD.name, "SELECT", "bronze"),),
        append_only=frozenset({name}),
        history={name: lambda at: as_of_batches(target, ORDERS, at)},
    )
    then = rules.as_of(name, STEWARD, moment).select("o_orderkey", F.lit(1).alias("then"))
    now = rules.read(name, STEWARD).select("o_orderkey", "_file_date")
    both = now.join(then, "o_orderkey", "full")
    return both.groupBy(F.col("_file_date").alias("business_date")).agg(
        F.count("then").alias("rows_then"),
        F.count("_file_date").alias("rows_today"),
        F.count_if(F.col("_file_date").isNull()).alias("rows_lost"),
    )


@query
def ctrl_ingest(spark, d):
    """Sidecars ingested as a feed of their own: declared rows per business date."""
    target, landing = _landed(spark, d, "ctrl")
    sidecar = ORDERS.sidecar("*.ctl")
    ingest(target, sidecar, landing)
    return bronze(target, sidecar).groupBy("feed", "business_date").agg(F.sum("record_count").alias("declared"))


@query
def delivery_contract(spark, d):
    """Presence, counts, digests and drift of what was really landed and loaded."""
    target, landing = _landed(spark, d, "contract")
    sidecar = ORDERS.sidecar("*.ctl")
    for feed in (ORDERS, sidecar):
        ingest(target, feed, landing)
    rows, declared = bronze(target, ORDERS), bronze(target, sidecar)
    files = landing_files(spark, landing, ORDERS.glob)
    checks = quality.results(
        [
            quality.tally("presence", contracts.presence(files, [declared]), files),
            quality.tally("record_counts", contracts.record_counts("orders", declared, rows), declared),
            quality.tally("md5", contracts.digests(file_md5(files), [declared]), declared),
            quality.tally("drift", contracts.rescued({"orders": rows}), rows),
        ]
    )
    return checks.select("check_name", "failures", "status")


@query
def watermark_anti(spark, d):
    """Orders not in the ledger by (path, time). Pending entries have no time and match nothing."""
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey").alias("_file_path")
    files = orders.select(key, F.col("o_orderdate").alias("_file_last_modified"))
    time = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    loaded = orders.filter(F.col("o_orderdate") < "1998-01-01").select(key, time.alias("_file_last_modified"))
    rest = unloaded(files, loaded)
    return rest.select("_file_path", F.to_date("_file_last_modified").alias("modified"))


@query
def path_date_of(spark, d):
    """Business dates from paths, NULL where the directory is not a date."""
    lines = table(spark, d, "lineitem")
    month = F.lpad((F.col("l_linenumber") * 3).cast("string"), 2, "0")
    day = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    year = F.year("l_shipdate").cast("string")
    folder = F.when(F.col("l_returnflag") == "N", "undated").otherwise(F.concat_ws("-", year, month, day))
    path = F.concat(F.lit("/landing/feed/"), folder, F.lit("/file.csv"))
    return lines.groupBy(path_date(path).alias("file_date")).agg(F.count(F.lit(1)).alias("n"))


@query
def settled_files(spark, d):
    """Files unchanged for 90 seconds before noon on 15 January."""
    files = table(spark, d, "events").select(
        F.col("event_id").alias("file_id"), F.col("ts").cast("timestamp").alias("_file_last_modified")
    )
    return settled(files, F.lit("2024-01-15 12:00:00").cast("timestamp"), 90).select("file_id")


@query
def delivery_faults(spark, d):
    """What a faulty delivery is blamed for, per business year: every fourth year has a fault of its own.

    Files without a sidecar, files without a sidecar whose rows have a field too many, digests of other bytes, and
    counts one too high; each check has to name its years and no others.
    """
    root = scratch_dir(spark, "faults")
    landing, orders = f"{root}/landing", star.delivered_orders(spark, d)
    kind = F.year("o_orderdate") % 4
    deliver(orders.where(~kind.isin(1, 3)), landing, ORDERS, F.trunc("o_orderdate", "year"), "sales")
    for case, wide in ((1, []), (3, [F.lit("more").alias("surplus")])):
        late = orders.where(kind == case).select("*", *wide, F.trunc("o_orderdate", "year").alias("delivered"))
        late.write.partitionBy("delivered").option("header", True).csv(f"{landing}/orders/late-{case}")
    target = Target(spark, f"{root}/built", f"{root.rsplit('/', 1)[1].replace('-', '_')}_").setup()
    sidecar = ORDERS.sidecar("*.ctl")
    for feed in (ORDERS, sidecar):
        ingest(target, feed, landing)
    rows, said = bronze(target, ORDERS), F.year("business_date") % 4
    declared = bronze(target, sidecar).withColumns(
        {
            "md5": F.when(said == 2, F.reverse("md5")).otherwise(F.col("md5")),
            "record_count": F.when(said == 0, F.col("record_count") + 1).otherwise(F.col("record_count")),
        }
    )
    files = landing_files(spark, landing, ORDERS.glob)
    dated = rows.select("_file_name", F.year("_file_date").alias("business_year")).distinct()
    wide = contracts.rescued({"orders": rows}).join(dated, "_file_name").select("business_year")
    year = F.regexp_extract("directory", r"delivered=(\d{4})", 1).cast("int").alias("business_year")
    counted = contracts.record_counts("orders", declared, rows)
    found = {
        "presence": contracts.presence(files, [declared]).select(year, "reason"),
        "record_counts": counted.select(year, "reason"),
        "md5": contracts.digests(file_md5(files), [declared]).select(year, F.lit("other bytes").alias("reason")),
        "drift": wide.withColumn("reason", F.lit("rescued")),
    }
    parts = [rows.withColumn("check_name", F.lit(name)) for name, rows in found.items()]
    return reduce(DataFrame.unionByName, parts).select("check_name", "business_year", "reason").distinct()


# --- contracts --------------------------------------------------------------------------


@query
def ctrl_presence(spark, d):
    return contracts.presence(star.shipped_files(spark, d), [star.open_sidecars(spark, d)])


@query
def ctrl_reconcile(spark, d):
    return contracts.record_counts("orders", star.order_sidecars(spark, d), star.order_lines(spark, d))


@query
def ctrl_md5(spark, d):
    return contracts.digests(star.document_files(spark, d), [star.document_sidecars(spark, d)])


@query
def dates_disagree(spark, d):
    """Statements of one value that differ: the length of a text, in characters and in bytes."""
    documents = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("_file_name"), "n_chars", F.octet_length("text").alias("n_bytes")
    )
    return contracts.disagreeing("documents: n_chars <> n_bytes", documents, "n_chars", "n_bytes")


# Rows of the larger side that one task of a sorted join takes, whatever the size of the tables.
JOINED_AT_ONCE = 250_000


def _matched(larger: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """An inner join on a key in tasks of a fixed size.

    The sizes of the files say little about the rows in them, so neither is a side sent whole to every task
    nor are partitions put together by their compressed bytes.
    """
    cores = larger.sparkSession.sparkContext.defaultParallelism
    n = max(cores, -(-larger.count() // JOINED_AT_ONCE))
    dealt = other.repartition(n, other_key).hint("merge")
    return larger.repartition(n, key).join(dealt, F.col(key) == F.col(other_key))


@query
def event_order(spark, d):
    """Order and ship dates of every line, tallied by whether the event precedes its receipt."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    both = _matched(lines, "l_orderkey", orders, "o_orderkey").select(
        F.col("l_orderkey").cast("string").alias("_file_name"),
        F.to_date("o_orderdate").alias("event_date"),
        F.to_date("l_shipdate").alias("received_date"),
    )
    late = contracts.disagreeing("event_date after received_date", both, "event_date", "received_date", ">")
    return quality.results([quality.tally("event_order", late, both)])


# --- silver and gold --------------------------------------------------------------------


@query
def silver_current(spark, d):
    """The current state of every order, from all the lines that restate it."""
    return star.employees(spark, d)


@query
def silver_current_dim(spark, d):
    """The latest event of every user."""
    events = table(spark, d, "events")
    return current_rows(events, "user_id", ("ts", "event_id")).select("user_id", "event_id", "event_type", "value")


@query
def gold_headcount(spark, d):
    """People and cost per department, zeros kept."""
    return star.gold(spark, d)


@query
def gold_rebuilt(spark, d):
    """Gold written over an older build of itself and read back, through staging and swap."""
    root = scratch_dir(spark, "gold")
    target = Target(spark, f"{root}/built", f"{root.rsplit('/', 1)[1].replace('-', '_')}_").setup()
    target.rebuild("gold", "headcount", star.gold(spark, d).filter("department_active"))
    return target.rebuild("gold", "headcount", star.gold(spark, d))


def _merged_people(spark: SparkSession, d: str, label: str) -> tuple[Target, Keyed, Iterator[None]]:
    """Employees restated in three deliveries, the last one with corrections of old dates; a step per delivery."""
    root = scratch_dir(spark, label)
    target = Target(spark, f"{root}/built", f"{root.rsplit('/', 1)[1].replace('-', '_')}_").setup()
    people = Keyed(target, "silver", "employee", ("employee_id",), star.RECENCY)
    rows, day = star.snapshots(spark, d), F.dayofmonth("snapshot_date")
    part = F.when(day <= 14, 0).when(day <= 30, 1).otherwise(2)

    def steps() -> Iterator[None]:
        first = rows.where(part == 0)
        people.start(first, {"merged": "0"}, bucket_count(first.count()))
        yield
        for i in (1, 2):
            people.merge(rows.where(part == i), {"merged": str(i)})
            yield

    return target, people, steps()


@query
def silver_merged(spark, d):
    """The current state of every order, merged delivery by delivery into the buckets it touches."""
    target, _, steps = _merged_people(spark, d, "merged")
    for _ in steps:
        pass
    return target.table("silver", "employee")


@query
def gold_merged(spark, d):
    """People and cost per department, kept up to date from the changed buckets of silver."""
    target, people, steps = _merged_people(spark, d, "gold-merged")
    for _ in steps:
        build_headcount(target, "headcount", people, star.departments(spark, d))
    return target.table("gold", "headcount")


# --- quality ----------------------------------------------------------------------------


@query
def unique_incremental(spark, d):
    """Keys that a second load of the returned lines brings again, found without reading the first load's rows."""
    root = scratch_dir(spark, "unique")
    target = Target(spark, f"{root}/built", f"{root.rsplit('/', 1)[1].replace('-', '_')}_").setup()
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    keys = SeenKeys(target, "lines", ("l_orderkey", "l_linenumber")).setup()
    keys.remember(lines, 0)
    return keys.check(lines.where("l_returnflag = 'R'"), 1)


@query
def vacuous_checks(spark, d):
    """Checks over parts of the documents, by language: what there is nothing of is vacuous, not passed."""
    documents = table(spark, d, "documents")
    rules = [quality.not_null("text"), quality.at_least("n_chars", 20)]
    parts = [quality.rule_tally(lang, documents.where(F.col("lang") == lang), rules) for lang in ("en", "de", "xx")]
    return quality.results(parts)


@query
def ambiguous_columns(spark, d):
    """Column names that leave open what they count: parts as columns, named by the words of their names."""
    parts = table(spark, d, "part")
    names = parts.select(
        F.concat(F.lit("t"), F.col("p_size").cast("string")).alias("table_name"),
        F.when(F.col("p_size") % 10 == 0, "Headcount").when(F.col("p_size") % 7 == 0, "fte").otherwise("headcount_fte").alias("column_name"),
    )
    return quality.ambiguous_names(names)


@query
def undocumented_columns(spark, d):
    """Measures without a description worth the name: brands as columns, described by their shortest part name."""
    parts = table(spark, d, "part").groupBy("p_brand").agg(F.min("p_type").alias("comment"), F.min("p_size").alias("size"))
    named = F.when(F.col("size") % 2 == 1, "salary").otherwise("size")
    columns = parts.select(
        F.lit("parts").alias("table_name"),
        F.concat(named, F.lit("_"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("")))).alias("column_name"),
        F.when(F.col("size") % 3 != 0, F.col("comment")).alias("comment"),
    )
    return quality.undocumented_measures(columns)


@query
def silver_uniqueness(spark, d):
    """One row per key holds in silver, over a population that is not empty."""
    return quality.results(
        [
            quality.key_tally("employee", star.employees(spark, d), ["employee_id"]),
            quality.key_tally("department", star.departments(spark, d), ["dept_id"]),
        ]
    )


@query
def duplicate_keys(spark, d):
    """Keys that occur more than once in the restated tables."""
    return quality.duplicate_keys(
        [
            ("lineitem", table(spark, d, "lineitem"), "l_orderkey"),
            ("events", table(spark, d, "events"), "user_id"),
            ("documents", table(spark, d, "documents"), "doc_id"),
        ]
    )


@query
def unique_combo(spark, d):
    return quality.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def not_null(spark, d):
    """Gold columns that must have values, and one that is NULL where nobody works."""
    rules = [quality.not_null(c) for c in ("dept_id", "dept_name", "headcount_people", "avg_salary")]
    return quality.results([quality.rule_tally("gold", star.gold(spark, d), rules)])


@query
def range_check(spark, d):
    """Several rules of one table in one pass."""
    customer, lines = table(spark, d, "customer"), table(spark, d, "lineitem")
    return quality.results(
        [
            quality.rule_tally("customer", customer, [quality.at_least("c_acctbal", 0)]),
            quality.rule_tally(
                "lineitem",
                lines,
                [quality.at_least("l_quantity", 10), quality.at_least("l_discount", 0), quality.not_null("l_tax")],
            ),
        ]
    )


@query
def fk_check(spark, d):
    """Orders no line refers to."""
    orders = table(spark, d, "orders").select("o_orderkey")
    return quality.orphans(orders, "o_orderkey", table(spark, d, "lineitem"), "l_orderkey")


@query
def silver_picked(spark, d):
    """Keys whose first snapshot was kept instead of the last: what a wrong pick looks like."""
    rows = star.snapshots(spark, d)
    first = rows.groupBy("employee_id").agg(F.min("snapshot_date").alias("snapshot_date"))
    found = quality.wrongly_picked("employee", first, rows, "employee_id", ["snapshot_date"])
    return found.select(
        "entity",
        "k",
        F.col("picked.snapshot_date").alias("picked"),
        F.col("available.snapshot_date").alias("available"),
    )


@query
def gold_reconciles(spark, d):
    """A gold table that lost its inactive departments does not reconcile."""
    damaged = star.gold(spark, d).filter("department_active")
    return quality.headcount_gap(star.employees(spark, d), damaged)


# --- metric view ------------------------------------------------------------------------


@query
def metric_totals(spark, d):
    return WORKFORCE.query(star.governance(spark, d), STEWARD, list(WORKFORCE.measures))


@query
def metric_by_dim(spark, d):
    asked = WORKFORCE.query(
        star.governance(spark, d), STEWARD, [*HEADCOUNTS, "salary_total"], ["cost_centre", "department_is_active"]
    )
    return asked.orderBy(F.desc("headcount_people"))


@query
def metric_by_type(spark, d):
    return WORKFORCE.query(star.governance(spark, d), STEWARD, ["headcount_people"], ["employment_type"])


@query
def metric_questions(spark, d):
    """All measures for the whole, per cost centre and state, per contract, and per department: one scan."""
    return WORKFORCE.questions(
        star.governance(spark, d),
        STEWARD,
        list(WORKFORCE.measures),
        [[], ["cost_centre", "department_is_active"], ["employment_type"], ["department"]],
    )


@query
def metric_distinct(spark, d):
    return measures_distinct(WORKFORCE, star.governance(spark, d), STEWARD)


@query
def metric_masked(spark, d):
    """The same totals as an analyst: every person, no salary."""
    return WORKFORCE.query(
        star.governance(spark, d), ANALYST, ["headcount_people", "salary_total", "salary_avg", "manager_count"]
    )


@query
def top_managers(spark, d):
    """The five cost centres with the most people managers."""
    return WORKFORCE.top(star.governance(spark, d), STEWARD, "manager_count", ["cost_centre"], 5)


# --- policies ---------------------------------------------------------------------------


@query
def mask_salary(spark, d):
    """Rows and readable salaries per caller: a mask hides values, not rows."""
    rules = star.governance(spark, d)

    def ask(caller):
        rows = rules.read("silver.people", caller)
        return rows.agg(F.count(F.lit(1)).alias("people"), F.count("salary_annual").alias("readable"))

    return policy.compare_principals(ROSTER, ask, lambda caller: rules.effect("silver.people", caller))


@query
def mask_email(spark, d):
    return star.governance(spark, d).read("silver.people", ANALYST).select("employee_id", "email")


@query
def tag_mask(spark, d):
    """A column without a mask of its own, redacted because of its tag."""
    rules = star.governance(spark, d)

    def ask(caller):
        return rules.read("silver.people", caller).groupBy("gender").agg(F.count(F.lit(1)).alias("people"))

    return policy.compare_principals([STEWARD, ANALYST, BIZ], ask)


@query
def row_filter_biz(spark, d):
    """Gold as a business user: own departments only, and no salaries."""
    return star.governance(spark, d).read("gold.headcount", BIZ)


@query
def visible_ids(spark, d):
    """Ids the business user is mapped to against ids it sees: the same, not merely fewer."""
    rules = star.governance(spark, d)
    mapped = rules.access_map().filter(F.col("principal") == BIZ.name)
    seen = rules.read("gold.headcount", BIZ)
    return quality.results(
        [
            quality.tally("biz", policy.same_ids(mapped, seen, "dept_id"), seen),
            quality.tally("steward", policy.same_ids(mapped, rules.read("gold.headcount", STEWARD), "dept_id"), seen),
        ]
    )


@query
def id_list(spark, d):
    """The departments a business user sees, as one ordered text."""
    seen = star.governance(spark, d).read("gold.headcount", BIZ)
    return policy.id_list(seen, "dept_id")


@query
def layer_equals_gold(spark, d):
    """The metric view shows a business user neither more nor less than the gold table."""
    rules = star.governance(spark, d)
    layer = WORKFORCE.query(rules, BIZ, ["headcount_people"])
    return layer_equals_table(layer, rules.read("gold.headcount", BIZ), "headcount_people")


@query
def prove_principals(spark, d):
    """One question as five callers, one of whom has no grant; equal callers share one plan."""
    rules = star.governance(spark, d)

    def ask(caller):
        return rules.read("gold.headcount", caller).agg(
            F.count(F.lit(1)).alias("departments"),
            F.sum("headcount_people").alias("people"),
            F.sum("total_salary").alias("payroll"),
            F.max("avg_salary").alias("highest_avg"),
        )

    callers = [*ROSTER, policy.Principal("outsider")]
    return policy.compare_principals(callers, ask, lambda caller: rules.effect("gold.headcount", caller))


@query
def open_findings(spark, d):
    """What the register leaves for review, by verdict."""
    rows = register.findings(register.stewardship_register(star.metadata(spark, d)))
    return rows.groupBy("review_flag").agg(F.count(F.lit(1)).alias("tables"))


@query
def stewardship(spark, d):
    return register.stewardship_register(star.metadata(spark, d))


@query
def register_findings(spark, d):
    """Verdicts of the register, counted."""
    rows = register.stewardship_register(star.metadata(spark, d))
    return rows.groupBy("table_schema", "review_flag").agg(F.count(F.lit(1)).alias("tables"))


@query
def unapproved_bronze_readers(spark, d):
    return register.unapproved_on(register.stewardship_register(star.metadata(spark, d)), "bronze").select(
        "table_name", "unapproved_readers"
    )


@query
def effective_grants(spark, d):
    return policy.effective_grants(
        star.role_grants(spark, d), star.members(spark, d), star.users(spark, d), star.services(spark, d)
    )


@query
def roles_without_members(spark, d):
    """Roles with grants that reach nobody: here all orders' priorities, filled by well-off customers only."""
    rich = table(spark, d, "customer").where("c_acctbal > 9000").select(user_id("c_custkey").alias("member"))
    people = star.members(spark, d).join(rich, "member", "left_semi")
    grants = star.role_grants(spark, d).unionByName(
        table(spark, d, "part").select(F.col("p_brand").alias("role"), F.lit("SELECT").alias("privilege"), F.lit("gold").alias("schema_name"))
    )
    return policy.unreached_roles(grants, people, star.users(spark, d), star.services(spark, d))


@query
def stale_grants(spark, d):
    grants = star.members(spark, d).select(F.col("member").alias("grantee"))
    live = star.users(spark, d).unionByName(star.services(spark, d)).select(F.col("id").alias("name"))
    return policy.stale_grantees(grants, live)


@query
def tag_vocabulary(spark, d):
    """Values of governed tags outside their closed lists."""
    used = (
        table(spark, d, "documents")
        .select(F.lit("lang").alias("tag_name"), F.col("lang").alias("tag_value"))
        .unionByName(
            table(spark, d, "events").select(F.lit("event").alias("tag_name"), F.col("event_type").alias("tag_value"))
        )
    )
    return policy.ungoverned_values(used, {"lang": ("en", "de", "fr"), "event": ("view", "click", "purchase")})


# --- layout and history -----------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@query
def layout_profile(spark, d):
    """Rows per table and whether its files were measured, from the rows' own file metadata."""
    tables = {t: table(spark, d, t) for t in TABLES}
    measured = (F.col("files") > 0) & (F.col("bytes") > 0) & F.col("error").isNull()
    return layout.layout_profile(spark, tables).select("table_name", "rows", measured.alias("measured"))


@query
def layout_totals(spark, d):
    """Rows of all tables together; one that is not there is counted apart, not as an empty one."""
    tables = {t: table(spark, d, t) for t in TABLES} | {"gone": f"{d.rstrip('/')}/gone.parquet"}
    return layout.totals(layout.layout_profile(spark, tables)).select("rows", "unmeasured")


@query
def op_mix(spark, d):
    return layout.operation_mix(star.commit_log(spark, d))


@query
def growth(spark, d):
    """Per log: versions, the oldest, and whether the latest build appended."""
    return layout.growth(star.commit_log(spark, d), maintenance=("error", "signup"), append="purchase")


@query
def asof_subset(spark, d):
    moment = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return layout.subset_of_today(star.commit_log(spark, d), moment)


@query
def stable_ids(spark, d):
    """The same content gets the same id, run after run."""
    documents = table(spark, d, "documents")
    return documents.select("doc_id", stable_id("source", "lang", "text").alias("id"))
