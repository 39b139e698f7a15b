"""Helpers shared by the operators: table access, spread scans, stored steps, distributed running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.session import materialise

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column | str) -> Column:
    """Runs of characters other than ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def unused(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it; names are compared without regard to case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of equally named columns."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def running_total(df: DataFrame, value: str, order: list, within: list[str], name: str) -> DataFrame:
    """``name``: the sum of ``value`` over all rows of the group that come before a row.

    The rows are dealt out by ranges of (group, order), so a group of any size spreads over many
    tasks. The ranges' sums are added up first (one row for each range and group), then the rows of
    each range. Integer values make the result independent of the ranges. ``df`` is stored once.
    """
    keys = [F.col(c).asc_nulls_last() for c in within] + order
    tie = F.monotonically_increasing_id()  # equal rows spread too; which of them comes first is immaterial
    dealt = df.withColumn("_tie", tie).repartitionByRange(*keys, F.col("_tie"))
    dealt = materialise(dealt.withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range", *within).agg(F.sum(value).alias("_sum"))
    sums = sums.select("_range", *within, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range", *within).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    inner = dealt.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    both = inner.join(sums, same(inner, sums, ["_range", *within]))
    return both.select(*[inner[c] for c in df.columns], (F.col("_before") + F.col("_inner")).alias(name))
