"""Where built tables live: one namespace per layer, optionally under a review prefix."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layers, in build order.
LAYERS = ("bronze", "silver", "gold", "governance")
BATCH = "_batch_id"
# Marks the properties that builders note on a published view.
_MARK = "strata."
# Catalogs limit the length of a property; longer notes are kept in parts.
_PART = 3_000


@dataclass(frozen=True)
class Target:
    """Tables are addressed ``<prefix><layer>.<table>`` and stored under ``root``."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def setup(self) -> Target:
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/{layer}'"
            )
        return self

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    # A table is published by one view over a stored table of some generation, ``<table>__g<n>``. Whatever
    # belongs to a generation takes effect with that view, in a single catalog operation; until then the earlier
    # generation stands, and a run that dies leaves at most a stored table nobody sees.

    def stored(self, table: str, generation: int) -> str:
        return f"{table}__g{generation}"

    def properties(self, layer: str, table: str) -> dict[str, str]:
        """What was published with a table: its generation, and what its builder noted."""
        if not self.exists(layer, table):
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").collect()
        parts: dict[str, dict[int, str]] = {}
        for r in rows:
            if r.key.startswith(_MARK):
                note, part = r.key[len(_MARK) :].rsplit(".", 1)
                parts.setdefault(note, {})[int(part)] = r.value
        return {note: "".join(text for _, text in sorted(held.items())) for note, held in parts.items()}

    def generation(self, layer: str, table: str) -> int | None:
        found = self.properties(layer, table).get("generation")
        return None if found is None else int(found)

    def generations(self, layer: str, table: str) -> list[int]:
        """All generations there is a stored table of, published or not."""
        names = (t.name for t in self.spark.catalog.listTables(f"{self.prefix}{layer}"))
        found = (re.fullmatch(rf"{re.escape(table.lower())}__g(\d+)", n) for n in names)
        return sorted(int(m[1]) for m in found if m)

    def next_generation(self, layer: str, table: str) -> int:
        """A number no stored table has, nor a folder that a dead run left without one."""
        hadoop = self.spark._jsc.hadoopConfiguration()
        number = max([-1, *self.generations(layer, table)]) + 1
        while True:
            folder = f"{self.root}/{layer}/{self.stored(table, number).lower()}"
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            if not path.getFileSystem(hadoop).exists(path):
                return number
            number += 1

    def sweep(self, layer: str, table: str, keep: int | None) -> None:
        """Drop every stored generation but one: what died, and what a later one replaced."""
        for generation in self.generations(layer, table):
            if generation != keep:
                self.spark.sql(f"DROP TABLE {self.name(layer, self.stored(table, generation))}")

    def publish(
        self,
        layer: str,
        table: str,
        generation: int,
        notes: dict[str, str] | None = None,
        *,
        where: str = "true",
        leave_out: Sequence[str] = (),
        comments: dict[str, str | None] | None = None,
    ) -> DataFrame:
        """Make a stored generation what ``table`` means, by replacing one view."""
        source = self.name(layer, self.stored(table, generation))
        fields = [f for f in self.spark.table(source).schema if f.name not in leave_out]
        texts = {f.name: f.metadata.get("comment") for f in fields} | (comments or {})
        quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        columns = ", ".join(
            f"`{f.name}`" + (f" COMMENT {quoted(texts[f.name])}" if texts.get(f.name) else "") for f in fields
        )
        noted = {"generation": str(generation)} | (notes or {})
        properties = ", ".join(
            f"{quoted(f'{_MARK}{k}.{i}')} = {quoted(v[i * _PART : (i + 1) * _PART])}"
            for k, v in noted.items()
            for i in range(max(1, -(-len(v) // _PART)))
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, table)} ({columns}) TBLPROPERTIES ({properties}) "
            f"AS SELECT {', '.join(f'`{f.name}`' for f in fields)} FROM {source} WHERE {where}"
        )
        return self.table(layer, table)

    def rebuild(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        comments: dict[str, str] | None = None,
        notes: dict[str, str] | None = None,
    ) -> DataFrame:
        """Rewrite a table whole. Column comments travel with it into the metastore.

        The rows go to a generation of their own, which is published when it is complete: a build that fails
        leaves the old table as it was, and the rows may be computed from that table. The generation
        before stays until the next rebuild, so that its readers may finish.
        """
        self.sweep(layer, table, self.generation(layer, table))
        generation = self.next_generation(layer, table)
        rows.write.mode("overwrite").saveAsTable(self.name(layer, self.stored(table, generation)))
        return self.publish(layer, table, generation, notes, comments=comments)

    def create(self, layer: str, table: str, schema: T.StructType, partitions: dict[str, str]) -> None:
        """An empty stored table."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = "".join(f", `{n}` {t}" for n, t in partitions.items())
        by = f" PARTITIONED BY ({', '.join(f'`{n}`' for n in partitions)})" if partitions else ""
        self.spark.sql(f"CREATE TABLE {self.name(layer, table)} ({columns}{keys}) USING parquet{by}")

    def evolve(self, layer: str, table: str, schema: T.StructType) -> list[str]:
        """Add columns the stored table lacks; rows already there read NULL."""
        present = set(self.table(layer, table).columns)
        missing = [f for f in schema if f.name not in present]
        if missing:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD COLUMNS ({columns})")
        return [f.name for f in missing]

    def put_batch(self, layer: str, table: str, batch: int, rows: DataFrame) -> None:
        """Write one batch. Writing the same batch again replaces it, so a retry adds nothing."""
        self.evolve(layer, table, rows.schema)
        order = [c for c in self.table(layer, table).columns if c != BATCH]
        have = set(rows.columns)
        aligned = [F.col(c) if c in have else F.lit(None).alias(c) for c in order]
        # A named partition is replaced alone, whatever the session's overwrite mode is.
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name(layer, table)} PARTITION ({BATCH} = {int(batch)}) "
            "SELECT * FROM {rows}",
            rows=rows.select(*aligned),
        )

    def append(self, layer: str, table: str, rows: DataFrame) -> None:
        """Add rows, which bring their partition columns, to a stored table."""
        order = self.table(layer, table).columns
        rows.select(*order).write.mode("append").insertInto(self.name(layer, table))

    def reload(self, layer: str, table: str, rows: list[tuple], schema: str) -> DataFrame:
        """Replace a control table whole, so that nothing departed survives in it."""
        return self.rebuild(layer, table, self.spark.createDataFrame(rows, schema))

    def describe(self, layer: str, table: str, comment: str) -> None:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER VIEW {self.name(layer, table)} SET TBLPROPERTIES ('comment' = '{quoted}')")

    def describe_column(self, layer: str, table: str, column: str, comment: str) -> None:
        """Describe one column of a rebuilt table."""
        notes = self.properties(layer, table)
        texts = {c.name: c.description for c in self.spark.catalog.listColumns(self.name(layer, table))}
        self.publish(layer, table, int(notes["generation"]), notes, comments={**texts, column: comment})

    def columns(self, layer: str) -> DataFrame:
        """(table_name, column_name, comment) of every table in a layer, from the catalog."""
        database = f"{self.prefix}{layer}"
        rows = [
            (t.name, c.name, c.description)
            for t in self.spark.catalog.listTables(database)
            if not re.search(r"__g\d+$", t.name)
            for c in self.spark.catalog.listColumns(f"{database}.{t.name}")
        ]
        return self.spark.createDataFrame(
            rows, "table_name string, column_name string, comment string"
        )


def review_target(primary: Target, prefix: str, root: str) -> Target:
    """An isolated copy for review: same landing files, its own tables."""
    if not prefix or prefix == primary.prefix or root.rstrip("/") == primary.root.rstrip("/"):
        raise ValueError("a review copy needs its own prefix and root, not the primary's")
    return Target(primary.spark, root, prefix)
