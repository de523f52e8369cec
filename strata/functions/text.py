"""Column expressions over paths, names and content. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a delivery's business date stands in its path.
DATE_DIRECTORY = r"/(\d{4}-\d{2}-\d{2})/"
# The same, also accepting the key=value directories that Spark's own writer makes.
KEYED_DATE_DIRECTORY = r"/(?:[^/=]+=)?(\d{4}-\d{2}-\d{2})/"


def path_date(path: Column, pattern: str = DATE_DIRECTORY) -> Column:
    """Business date from the delivery directory; NULL when there is none or it is no date."""
    return F.regexp_extract(path, pattern, 1).try_cast("date")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def decoded(path: Column) -> Column:
    """Undo the percent-encoding Spark applies to file metadata ('+' is a literal there)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def stable_id(*parts: Column) -> Column:
    """First 32 hex digits of SHA-256 over the '|'-joined parts: same content, same id."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32)
