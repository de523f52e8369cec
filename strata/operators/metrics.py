"""Metric views: named measures over a governed source, aggregated when asked.

A view names its source, its lookup joins, its dimensions and its measures as SQL
expressions over the aliases ``source`` and the join names. Asking for measures builds
one plan: secure the sources for the caller, filter, join, aggregate. Masks and row
filters come before the aggregation, so a masked measure is NULL and not a wrong number.

A count, sum or average is kept as states that can be merged (an average as its sum and its count). States are taken
per join key before a lookup is joined, and merged afterwards; several groupings are answered from one scan.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.policy import Governance, Principal, RowFilter

# The three definitions of headcount, none of them called just that.
HEADCOUNTS = ("headcount_people", "headcount_fte", "headcount_fulltime")


# Names the dimensions of a row where several groupings are asked at once.
GROUPING = "grouping"


def _states(name: str, measure: str) -> dict[str, str]:
    """The expressions whose sums over parts give a measure; none where parts do not give it."""
    call = re.fullmatch(r"(count|sum|count_if|avg)\((.*)\)", measure)
    depth = 0
    for c in call[2] if call else "":
        depth += (c == "(") - (c == ")")
        if depth < 0:  # the last bracket closes another call
            return {}
    if not call or call[2].lstrip().lower().startswith("distinct"):
        return {}
    if call[1] == "avg":
        return {f"_{name}_sum": f"sum({call[2]})", f"_{name}_n": f"count({call[2]})"}
    return {name: measure}


def _bits(by: Sequence[str], grouping: Sequence[str]) -> int:
    """How a grouping set is numbered: a bit for each dimension it leaves out, the last one lowest."""
    return sum(1 << i for i, d in enumerate(reversed(by)) if d not in grouping)


@dataclass(frozen=True)
class Lookup:
    """A many-to-one join that adds attributes. Left, so that no source row is lost."""

    table: str
    on: str


@dataclass(frozen=True)
class MetricView:
    name: str
    source: str
    filter: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    lookups: Mapping[str, Lookup] = field(default_factory=dict)
    row_filter: RowFilter | None = None
    comments: Mapping[str, str] = field(default_factory=dict)

    def _needed(self, expressions: Sequence[str]) -> list[str]:
        """Lookups the expressions mention, directly or through another lookup's condition.

        A many-to-one left join neither adds nor drops source rows, so one that nobody
        asks about is left out of the plan.
        """
        needed, text = [], " ".join(expressions)
        for name in reversed(list(self.lookups)):
            if re.search(rf"\b{name}\.", text):
                needed.insert(0, name)
                text += " " + self.lookups[name].on
        return needed

    def rows(
        self, governance: Governance, principal: Principal, expressions: Sequence[str]
    ) -> DataFrame:
        """Source rows as the caller may see them, filtered, with the lookups the expressions need."""
        governance.demand(self.name, principal)
        rows = governance.secured(self.source, principal)
        if self.row_filter:
            rows = governance.visible(rows, self.row_filter, principal)
        rows = rows.alias("source")
        for name in self._needed([self.filter, *expressions]):
            lookup = self.lookups[name]
            side = governance.secured(lookup.table, principal).alias(name)
            rows = rows.join(side, F.expr(lookup.on), "left")
        return rows.filter(self.filter)

    def query(
        self,
        governance: Governance,
        principal: Principal,
        measures: Sequence[str],
        by: Sequence[str] = (),
        where: str | None = None,
    ) -> DataFrame:
        """Measures for the whole population, or per dimension value."""
        unknown = [m for m in measures if m not in self.measures] + [d for d in by if d not in self.dimensions]
        if unknown:
            raise KeyError(f"{self.name} has no {', '.join(unknown)}")
        groups, aggregates = [self.dimensions[d] for d in by], [self.measures[m] for m in measures]
        if by and self._splits(groups, aggregates, where):
            return self._merged(governance, principal, measures, by, [by], where).drop(GROUPING)
        rows = self.rows(governance, principal, [*groups, *aggregates, where or ""])
        if where:
            rows = rows.filter(where)
        return rows.groupBy(*[F.expr(e).alias(d) for d, e in zip(by, groups)]).agg(
            *[F.expr(e).alias(m) for m, e in zip(measures, aggregates)]
        )

    def questions(
        self,
        governance: Governance,
        principal: Principal,
        measures: Sequence[str],
        groupings: Sequence[Sequence[str]],
        where: str | None = None,
    ) -> DataFrame:
        """The measures by each grouping, all from one scan of the source; an empty grouping asks for the whole.

        ``grouping`` names the dimensions of a row, the others are NULL.
        """
        by = list(dict.fromkeys(d for g in groupings for d in g))
        unknown = [m for m in measures if m not in self.measures] + [d for d in by if d not in self.dimensions]
        if unknown:
            raise KeyError(f"{self.name} has no {', '.join(unknown)}")
        whole = [m for m in measures if not _states(m, self.measures[m])]
        if whole or self._needed([self.filter, *(self.measures[m] for m in measures), where or ""]):
            raise ValueError(f"{', '.join(whole) or self.name} cannot be merged from parts of the source")
        return self._merged(governance, principal, measures, by, groupings, where)

    def _splits(self, groups: Sequence[str], aggregates: Sequence[str], where: str | None) -> bool:
        """Whether the measures can be taken from source columns before the lookups are joined."""
        mergeable = all(_states("m", a) for a in aggregates)
        source_only = not self._needed([self.filter, *aggregates, where or ""])
        return mergeable and source_only and bool(self._needed(groups))

    def _merged(
        self,
        governance: Governance,
        principal: Principal,
        measures: Sequence[str],
        by: Sequence[str],
        groupings: Sequence[Sequence[str]],
        where: str | None,
    ) -> DataFrame:
        """States per join key and source dimension, then the lookups, then the states of each grouping merged.

        The join sees one row per key and dimension value instead of one per source row, so that a key
        with most of the rows is no large partition of it.
        """
        groups = {d: self.dimensions[d] for d in by}
        needed = self._needed(list(groups.values()))
        source = self.rows(governance, principal, [*(self.measures[m] for m in measures), where or ""])
        if where:
            source = source.filter(where)
        keys = sorted(set(re.findall(r"\bsource\.(\w+)", " ".join(self.lookups[n].on for n in needed))))
        own = {d: e for d, e in groups.items() if not self._needed([e])}
        states = {m: _states(m, self.measures[m]) for m in measures}
        partial = source.groupBy(
            *[F.expr(f"source.{k}").alias(k) for k in keys], *[F.expr(e).alias(f"_by_{d}") for d, e in own.items()]
        ).agg(*[F.expr(e).alias(c) for held in states.values() for c, e in held.items()])
        types = dict(zip(measures, source.agg(*[F.expr(self.measures[m]).alias(m) for m in measures]).schema))
        joined = partial.alias("source")
        for name in needed:
            lookup = self.lookups[name]
            joined = joined.join(governance.secured(lookup.table, principal).alias(name), F.expr(lookup.on), "left")
        flat = joined.select(
            *[(F.col(f"source.`_by_{d}`") if d in own else F.expr(e)).alias(d) for d, e in groups.items()],
            *[F.col(f"source.`{c}`").alias(c) for held in states.values() for c in held],
        )
        merged = []
        for m, held in states.items():
            total = [F.sum(F.col(f"`{c}`")) for c in held]
            value = total[0] if len(total) == 1 else F.when(total[1] > 0, total[0] / total[1])
            if len(total) == 1 and types[m].dataType == T.LongType():
                value = F.coalesce(value, F.lit(0)) if self.measures[m].startswith("count") else value
            merged.append(value.cast(types[m].dataType).alias(m))
        named = {_bits(by, g): ", ".join(g) for g in groupings}
        if len(groupings) == 1 and list(groupings[0]) == list(by):
            asked = flat.groupBy(*[F.col(f"`{d}`") for d in by]).agg(*merged)
            return asked.withColumn(GROUPING, F.lit(named[0]))
        asked = flat.groupingSets([[F.col(f"`{d}`") for d in g] for g in groupings], *[F.col(f"`{d}`") for d in by])
        label = F.coalesce(*[F.when(F.col("_set") == bits, text) for bits, text in named.items()])
        asked = asked.agg(*merged, F.grouping_id().alias("_set"))
        return asked.withColumn(GROUPING, label).select(GROUPING, *[F.col(f"`{c}`") for c in (*by, *measures)])

    def headcount(
        self, governance: Governance, principal: Principal, by: Sequence[str] = ()
    ) -> DataFrame:
        """An unqualified headcount: all three definitions, each under its name."""
        return self.query(governance, principal, HEADCOUNTS, by)

    def top(
        self, governance: Governance, principal: Principal, measure: str, by: Sequence[str], k: int
    ) -> DataFrame:
        """The k dimension values with the greatest measure; ties go by dimension value."""
        asked = self.query(governance, principal, [measure], by)
        return asked.orderBy(F.desc(measure), *[F.asc(d) for d in by]).limit(k)

    def describe(self, spark) -> DataFrame:
        """(table_name, column_name, comment) of the measures, as the documentation checks read it."""
        table = self.name.split(".")[1]
        rows = [(table, m, self.comments.get(m)) for m in self.measures]
        return spark.createDataFrame(rows, "table_name string, column_name string, comment string")


def measures_distinct(view: MetricView, governance: Governance, principal: Principal) -> DataFrame:
    """The three headcounts and whether they are mutually different."""
    people, fte, fulltime = (F.col(h) for h in HEADCOUNTS)
    distinct = (people != fte) & (fte != fulltime) & (people != fulltime)
    return view.headcount(governance, principal).withColumn(
        "verdict", F.when(distinct, "yes").otherwise("no")
    )


def layer_equals_table(layer: DataFrame, table: DataFrame, measure: str) -> DataFrame:
    """Total through the view against total in the table, NULL counted as 0.

    A caller who sees no row gets 0 from one and NULL from the other, and that is equal.
    """
    tagged = layer.select(F.col(measure).alias("v"), F.lit("view").alias("s")).unionByName(
        table.select(F.col(measure).alias("v"), F.lit("table").alias("s"))
    )
    totals = tagged.agg(
        F.coalesce(F.sum(F.when(F.col("s") == "view", F.col("v"))), F.lit(0)).alias("layer_total"),
        F.coalesce(F.sum(F.when(F.col("s") == "table", F.col("v"))), F.lit(0)).alias("table_total"),
    )
    equal = F.col("layer_total") == F.col("table_total")
    return totals.withColumn("verdict", F.when(equal, "yes").otherwise("no"))
