"""The HR roles played by the star-schema test tables.

Nothing here is an operator: these functions say which table stands for which input, so
that the operators run over whole tables. ``lineitem`` restates an order (employee) at
each ship date; ``part`` is the department it belongs to; suppliers own departments;
``orders`` and ``lineitem`` stand for contracts and grants, ``events`` for a commit log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.masks import Mask, email_like, redacted
from strata.functions.text import KEYED_DATE_DIRECTORY
from strata.operators.current import current_rows
from strata.operators.headcount import headcount_by_department
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
from strata.operators.register import Metadata
from strata.plans.hr import MASK_SALARY, MASK_SALARY_AVG, MASK_SALARY_TOTAL, MV_WORKFORCE
from strata.sources.feeds import Feed


def _tag(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("tag_name"), value.alias("tag_value"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- workforce --------------------------------------------------------------------------

# Most significant first; the rest makes the order total, so equal rows are the same row.
RECENCY = (
    "snapshot_date",
    "line_number",
    "dept_id",
    "owner_id",
    "salary_annual",
    "is_people_manager",
    "employment_type",
    "is_employed",
)


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "full_time").when(flag == "R", "part_time").otherwise("contract")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("employee_id"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("dept_id"),
        F.col("l_suppkey").alias("owner_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("salary_annual"),
        (F.col("l_quantity") >= 40).alias("is_people_manager"),
        kind.alias("employment_type"),
        (F.col("l_linestatus") == "O").alias("is_employed"),
    )


def employees(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(snapshots(spark, d), "employee_id", RECENCY)


def departments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("dept_id"),
        F.col("p_type").alias("dept_code"),
        F.col("p_name").alias("dept_name"),
        F.col("p_brand").alias("cost_centre"),
        (F.col("p_size") > 10).alias("is_active"),
    )


def gold(spark: SparkSession, d: str) -> DataFrame:
    return headcount_by_department(employees(spark, d), departments(spark, d))


def access_map(spark: SparkSession, d: str) -> DataFrame:
    """A supplier may see the parts it supplies."""
    lines = table(spark, d, "lineitem")
    return lines.select(
        F.col("l_suppkey").cast("string").alias("principal"), F.col("l_partkey").alias("dept_id")
    )


# --- people (masks) ---------------------------------------------------------------------


def people(spark: SparkSession, d: str) -> DataFrame:
    """Customers as employees: the name is shaped like an address with '#' for '@'."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("email"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("salary_annual"),
        F.col("c_mktsegment").alias("gender"),
    )


STEWARD = Principal("steward", frozenset({STEWARDS}))
PIPELINE = Principal("pipeline", frozenset({PLATFORM}))
ANALYST = Principal("hr-analyst", frozenset({ANALYSTS}))
BIZ = Principal("1", frozenset({BUSINESS}))  # supplier 1
ROSTER = (STEWARD, PIPELINE, ANALYST, BIZ)


def _name_mask(value: Column, _: T.DataType) -> Column:
    return email_like(value, "#")


MASK_NAME = Mask("mask_email", T.StringType(), _name_mask, UNMASKED)
REDACT = Mask("mask_redact_string", T.StringType(), redacted, UNMASKED)
OWN_DEPARTMENTS = RowFilter("filter_dept", "dept_id", "dept_id")


def governance(spark: SparkSession, d: str) -> Governance:
    readers = {"silver": (STEWARD, PIPELINE, ANALYST), "gold": ROSTER}
    return Governance(
        tables={
            "silver.people": lambda: people(spark, d),
            "silver.employee": lambda: employees(spark, d),
            "silver.department": lambda: departments(spark, d),
            "gold.headcount": lambda: gold(spark, d),
        },
        access_map=lambda: access_map(spark, d),
        grants=tuple(Grant(p.name, "SELECT", schema) for schema, group in readers.items() for p in group),
        masks={
            ("silver.people", "salary_annual"): MASK_SALARY,
            ("silver.people", "email"): MASK_NAME,
            ("silver.employee", "salary_annual"): MASK_SALARY,
            ("gold.headcount", "total_salary"): MASK_SALARY_TOTAL,
            ("gold.headcount", "avg_salary"): MASK_SALARY_AVG,
        },
        row_filters={"gold.headcount": OWN_DEPARTMENTS},
        tag_masks=(TagMask("by_tag", "silver", "pii_class", "special_category", REDACT),),
        column_tags=(ColumnTag("silver", "people", "gender", "pii_class", "special_category"),),
    )


WORKFORCE = MetricView(
    name="gold.workforce",
    source="silver.employee",
    filter="is_employed",
    row_filter=OWN_DEPARTMENTS,
    lookups={"dept": Lookup("silver.department", "source.dept_id = dept.dept_id")},
    dimensions={
        "department": "dept.dept_name",
        "cost_centre": "dept.cost_centre",
        "department_is_active": "dept.is_active",
        "employment_type": "source.employment_type",
        "is_people_manager": "source.is_people_manager",
    },
    measures=MV_WORKFORCE.measures,
    comments=MV_WORKFORCE.comments,
)


# --- delivery contracts -----------------------------------------------------------------

ORDERS = Feed(
    name="orders",
    table="bronze_orders",
    key="o_orderkey",
    date_pattern=KEYED_DATE_DIRECTORY,
    columns=(
        ("o_orderkey", "bigint"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "decimal(12,2)"),
        ("o_orderdate", "date"),
        ("o_orderpriority", "string"),
    ),
)


def delivered_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a producer writes them: dates as dates, money with two decimals."""
    return table(spark, d, "orders").select(
        *[F.col(n).cast(t).alias(n) for n, t in ORDERS.columns]
    )


def _order_file(key: str) -> list[Column]:
    name = F.concat(F.col(key).cast("string"), F.lit(".csv"))
    return [F.concat(F.lit("/landing/orders/"), name).alias("_file_path"), name.alias("file_name")]


def order_sidecars(spark: SparkSession, d: str) -> DataFrame:
    """Orders that are not pending declare their lines; some declare no number."""
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    declared = F.when(~unspecified, F.floor(F.col("o_totalprice") / 100000))
    sent = table(spark, d, "orders").filter(F.col("o_orderstatus") != "P")
    return sent.select(*_order_file("o_orderkey"), declared.alias("record_count"))


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    path, name = _order_file("l_orderkey")
    return table(spark, d, "lineitem").select(path, name.alias("_file_name"))


def shipped_files(spark: SparkSession, d: str) -> DataFrame:
    """Files on disk: orders with an open line."""
    open_lines = table(spark, d, "lineitem").filter(F.col("l_linestatus") == "O")
    return open_lines.select(*_order_file("l_orderkey"))


def open_sidecars(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").filter(F.col("o_orderstatus") == "O").select(*_order_file("o_orderkey"))


def document_files(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("doc_id").cast("string")
    return table(spark, d, "documents").select(
        F.concat(F.lit("/landing/documents/"), name).alias("_file_path"),
        name.alias("file_name"),
        F.md5("text").alias("actual_md5"),
    )


def document_sidecars(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents declare a digest: the right one in capitals, or one of other bytes."""
    labels = table(spark, d, "labels").select("doc_id", "quality")
    name = F.col("doc_id").cast("string")
    declared = F.when(F.col("quality") == 1, F.upper(F.md5("text"))).when(
        F.col("quality") == 0, F.md5(F.replace("text", F.lit(" "), F.lit("")))
    )
    return table(spark, d, "documents").join(labels, "doc_id", "left").select(
        F.concat(F.lit("/landing/documents/"), name).alias("_file_path"),
        name.alias("file_name"),
        declared.alias("md5"),
    )


# --- policy metadata --------------------------------------------------------------------


def metadata(spark: SparkSession, d: str) -> Metadata:
    """Parts as tables, their order lines as columns and grants, customers as exceptions."""
    size = F.col("p_size")
    layer = F.when(size <= 17, "bronze").when(size <= 34, "silver").otherwise("gold")
    part_name = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))
    parts = table(spark, d, "part").select(
        "p_partkey",
        layer.alias("table_schema"),
        part_name.alias("table_name"),
        "p_brand",
        "p_type",
        "p_name",
        "p_size",
    )
    key = ["table_schema", "table_name"]
    word = F.substring_index("p_name", " ", 1)
    pii = F.when(word == "red", "true").when(word == "blue", "True").when(word == "small", "false")
    tags = parts.select(
        *key,
        F.inline(
            F.array(
                _tag("domain", F.col("p_type")),
                _tag("layer", F.col("table_schema")),
                _tag("contains_pii", pii),
            )
        ),
    )
    lines = table(spark, d, "lineitem").join(
        parts.select("p_partkey", *key), F.col("l_partkey") == F.col("p_partkey")
    )
    column = F.concat(F.lit("c"), F.col("l_linenumber").cast("string"))
    per_column = lines.groupBy(*key, column.alias("column_name")).agg(
        F.max("l_quantity").alias("q"),
        F.max("l_discount").alias("discount"),
        F.concat(F.max("l_returnflag"), F.max("l_linenumber").cast("string")).alias("pii_class"),
    )
    column_tags = per_column.select(
        *key,
        "column_name",
        F.inline(
            F.array(
                _tag("pii_class", F.when(F.col("q") >= 45, F.col("pii_class"))),
                _tag("data_sensitivity", F.when(F.col("q") >= 50, "Restricted").otherwise("internal")),
            )
        ),
    ).filter(F.col("tag_value").isNotNull())
    masks = per_column.filter((F.col("q") >= 49) & (F.col("discount") > 0.05)).select(
        *key, "column_name", F.lit("mask").alias("mask_name")
    )
    filters = parts.filter(F.col("p_size") == 50).select(
        *key, F.concat(F.lit("filter_"), F.col("p_brand")).alias("filter_name")
    )
    returned = F.col("l_returnflag") == "R"
    privilege = (
        F.when((F.col("l_quantity") >= 48) & returned, "ALL_PRIVILEGES")
        .when(F.col("l_quantity") >= 48, "SELECT")
        .otherwise("MODIFY")
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    privileges = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *key, F.col("o_custkey").cast("string").alias("grantee"), privilege.alias("privilege_type")
    )
    number = F.col("n_nationkey").cast("string")
    region = F.col("n_regionkey")
    policies = table(spark, d, "nation").select(
        F.concat(F.lit("R"), number).alias("pii_class"),
        F.when(region == 0, "bronze").when(region == 2, "gold").otherwise("silver").alias("scope"),
    )
    segment = F.col("c_mktsegment")
    scope = F.when(segment == "BUILDING", "bronze").when(segment == "MACHINERY", "silver").otherwise("gold")
    exceptions = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("principal"), scope.alias("scope")
    )
    return Metadata(
        tables=parts.select(*key, F.col("p_brand").alias("table_owner")),
        table_tags=tags,
        column_tags=column_tags,
        column_masks=masks,
        row_filters=filters,
        privileges=privileges,
        tag_policies=policies,
        exceptions=exceptions,
    )


def user_id(column: str) -> Column:
    return F.concat(F.lit("C"), F.col(column).cast("string"))


def users(spark: SparkSession, d: str) -> DataFrame:
    """Live human principals: customers in credit."""
    return table(spark, d, "customer").filter(F.col("c_acctbal") > 0).select(
        user_id("c_custkey").alias("id"), F.col("c_name").alias("name")
    )


def services(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name")
    )


def role_grants(spark: SparkSession, d: str) -> DataFrame:
    status = F.col("o_orderstatus")
    schema = F.when(status == "O", "gold").when(status == "F", "silver").otherwise("governance")
    return table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("role"), F.lit("SELECT").alias("privilege"), schema.alias("schema_name")
    ).distinct()


def members(spark: SparkSession, d: str) -> DataFrame:
    humans = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("role"), user_id("o_custkey").alias("member")
    )
    rich = F.when(F.col("s_acctbal") > 5000, "1-URGENT").otherwise("5-LOW")
    machines = table(spark, d, "supplier").select(
        rich.alias("role"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("member")
    )
    return humans.unionByName(machines)


def commit_log(spark: SparkSession, d: str) -> DataFrame:
    """A user's events as a table's commits, versioned by event id."""
    return table(spark, d, "events").select(
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
        F.col("event_id").alias("version"),
        F.col("event_type").alias("operation"),
        F.col("ts").alias("_processed_timestamp"),
    )
