"""Feeds: a directory of delivered files, its declared columns and its key."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import DATE_DIRECTORY

RESCUED = "_rescued_data"

# The provenance columns every bronze row carries, in order.
PROVENANCE = (
    "_file_path",
    "_file_name",
    "_file_size",
    "_file_last_modified",
    "_file_date",
    "_processed_timestamp",
)

# The columns of a control sidecar, one row per data file it declares.
SIDECAR_COLUMNS = (
    ("file_name", "string"),
    ("record_count", "bigint"),
    ("md5", "string"),
    ("business_date", "date"),
    ("feed", "string"),
    ("domain", "string"),
)


@dataclass(frozen=True)
class Feed:
    name: str
    table: str
    columns: tuple[tuple[str, str], ...]
    key: str
    glob: str = "*.csv"
    date_pattern: str = DATE_DIRECTORY

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def raw_schema(self) -> T.StructType:
        """What the reader is told: every declared column as text, plus the drift column."""
        names = [*self.column_names, RESCUED]
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    def typed(self) -> list[Column]:
        """Plain casts: text that is not a value of its type stops the load."""
        return [F.col(n).cast(t).alias(n) for n, t in self.columns]

    def project(self, raw: DataFrame) -> DataFrame:
        return raw.select(*self.typed(), *PROVENANCE, RESCUED)

    def sidecar(self, glob: str = "*.ctrl") -> Feed:
        return replace(
            self,
            table=f"{self.table}_ctrl",
            columns=SIDECAR_COLUMNS,
            key="file_name",
            glob=glob,
        )
