"""Ordered target statistics: numbers in place of categories with any number of values.

A category value stands for the share of positive rows that have it. For a row that is trained on, only
the rows before it in a seeded order count, so its own label never enters its feature; rows without a
label get the figures of all labelled rows. Shares are drawn towards the overall share by ``weight`` rows.

The figures of earlier rows are a running total within each (column, value). It is taken in two steps,
over prefixes of the order's hash and inside each prefix, so a value that holds most of the rows spreads
over many tasks, and no vocabulary ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.operators.encoding import category_counts
from leadloom.operators.frames import quoted
from leadloom.operators.ranking import shuffle_key
from leadloom.session import materialise

#: Rows of the overall share that every value starts with.
WEIGHT = 1.0
#: Leading hex digits of the order's hash: a value's rows are dealt out to 16 ** _PREFIX parts.
_PREFIX = 2


def wide_columns(df: DataFrame, cols: Sequence[str], limit: int) -> list[str]:
    """Which columns have more than ``limit`` values; one row a column reaches the driver."""
    if not cols:
        return []
    counts = category_counts(df, cols).groupBy("column").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    found = {r["column"] for r in counts.collect()}
    return [c for c in cols if c in found]


def _cells(df: DataFrame, id_col: str, cols: Sequence[str], label: str) -> DataFrame:
    """(id, label, column, value): a row for each row and column; null is a value of its own."""
    pairs = [F.struct(F.lit(i).alias("column"), F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")).alias("value")) for i, c in enumerate(cols)]
    wide = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label)).cast("bigint").alias("label"), F.explode(F.array(*pairs)).alias("p"))
    return wide.select("id", "label", "p.column", "p.value")


def value_statistics(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(column, value, positives, n) over all labelled rows; ``column`` is the place in ``cols``."""
    cells = _cells(df.withColumn("__id", F.lit(0)), "__id", cols, label).filter(F.col("label").isNotNull())
    return cells.groupBy("column", "value").agg(F.sum("label").alias("positives"), F.count("*").alias("n"))


def _share(positives: Column, n: Column, overall: float, weight: float) -> Column:
    return (F.coalesce(positives, F.lit(0)) + F.lit(weight * overall)) / (F.coalesce(n, F.lit(0)) + F.lit(weight))


def target_statistics(
    df: DataFrame, id_col: str, cols: Sequence[str], label: str, weight: float = WEIGHT, seed: int = 42, suffix: str = "_target"
) -> DataFrame:
    """``id_col`` and one column ``<column><suffix>`` for each of ``cols``, for every row of ``df``.

    Rows with a label (0 or 1) get the ordered share, rows with a null label the share over all labelled rows; a
    value that no labelled row has gets the overall share. Ids must be unique; an empty table gives no rows.
    """
    overall = df.agg(F.avg(F.col(quoted(label)).cast("double"))).first()[0] or 0.0
    cells = _cells(df, id_col, cols, label)
    known = cells.filter(F.col("label").isNotNull()).withColumn("h", shuffle_key("id", seed)).withColumn("part", F.substring("h", 1, _PREFIX))
    known = materialise(known)
    parts = known.groupBy("column", "value", "part").agg(F.sum("label").alias("s"), F.count("*").alias("n"))
    before = Window.partitionBy("column", "value").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select("column", "value", "part", F.sum("s").over(before).alias("s0"), F.sum("n").over(before).alias("n0"))
    inside = Window.partitionBy("column", "value", "part").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    own = known.withColumns({"s1": F.sum("label").over(inside), "n1": F.count("*").over(inside)})
    sums = own.join(shifts, ["column", "value", "part"]).withColumns(
        {"s": F.coalesce("s0", F.lit(0)) + F.coalesce("s1", F.lit(0)), "n": F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0))}
    )
    trained = sums.select("id", "column", _share(F.col("s"), F.col("n"), overall, weight).alias("x"))
    totals = parts.groupBy("column", "value").agg(F.sum("s").alias("positives"), F.sum("n").alias("n"))
    others = cells.filter(F.col("label").isNull()).join(totals, ["column", "value"], "left")
    scored = others.select("id", "column", _share(F.col("positives"), F.col("n"), overall, weight).alias("x"))
    wide = trained.unionByName(scored).groupBy("id").pivot("column", list(range(len(cols)))).agg(F.max("x"))
    return wide.select(F.col("id").alias(id_col), *[F.col(str(i)).alias(c + suffix) for i, c in enumerate(cols)])


def with_target_statistics(df: DataFrame, id_col: str, cols: Sequence[str], label: str, weight: float = WEIGHT, seed: int = 42, suffix: str = "_target") -> DataFrame:
    """``df`` with the columns of ``target_statistics``."""
    return df.join(target_statistics(df, id_col, cols, label, weight, seed, suffix), id_col, "left") if cols else df
