"""Column masks. A mask rewrites a value for callers outside the exempt groups.

``expr`` builds the masked column; the exemption is decided once per read, on the
driver, so an exempt caller's plan carries no mask expression at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Mask:
    name: str
    input_type: T.DataType
    expr: Callable[[Column, T.DataType], Column]
    exempt: frozenset[str]


def to_null(_: Column, dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def keep_domain(value: Column, _: T.DataType) -> Column:
    """``***@domain``; a value with no '@' keeps the shape and loses the content."""
    return email_like(value, "@")


def email_like(value: Column, separator: str) -> Column:
    # try_element_at: under ANSI both [i] and element_at raise past the end, so one
    # malformed address would fail every restricted read of the table.
    tail = F.try_element_at(F.split(value, separator), F.lit(2))
    shown = F.concat(F.lit(f"***{separator}"), F.coalesce(tail, F.lit("redacted")))
    return F.when(value.isNotNull(), shown)


def redacted(_: Column, __: T.DataType) -> Column:
    """NULL becomes 'REDACTED' as well: absence is also information."""
    return F.lit("REDACTED")
