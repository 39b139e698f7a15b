"""Column functions on timestamps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom import vocab
from leadloom.functions.text import ColumnOrName, _col

_SHIFT = 10_000_000  # days; makes every difference of two valid timestamps positive


def moment(value: datetime | str | Column) -> Column:
    """A timestamp without time zone from a literal or column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def floor_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end``, rounded down: ten hours early is day -1."""
    # Subtracting zone-free timestamps keeps daylight saving out. Division cuts toward zero, so
    # it is done on the positive side.
    gap = _col(end).cast("timestamp_ntz") - _col(start).cast("timestamp_ntz")
    return F.call_function("div", gap + F.expr(f"INTERVAL '{_SHIFT}' DAY"), F.expr("INTERVAL '1' DAY")) - F.lit(_SHIFT)


def parse_moment(c: ColumnOrName) -> Column:
    """Lenient parse: values that are no timestamp become null."""
    return _col(c).try_cast("timestamp_ntz")


def day_bin(
    days: Column,
    edges: Sequence[int] = vocab.DATE_BIN_EDGES,
    labels: Sequence[str] = vocab.DATE_BIN_LABELS,
) -> Column:
    """Label of the left-closed interval a number of days falls in; null below the first edge."""
    label = F.when(days.isNull() | (days < edges[0]), F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], labels):
        label = label.when(days < upper, F.lit(name))
    return label.otherwise(F.lit(labels[-1]))
