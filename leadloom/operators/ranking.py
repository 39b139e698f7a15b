"""Folds, hold-out, seeded samples and action lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.operators.frames import above, quoted, select_existing
from leadloom.functions import text as X
from leadloom.session import materialise

_PREFIX = 4  # hexadecimal digits of the hash that make a bucket: 65,536 buckets per class


def shuffle_key(id_col: str, seed: int):
    """Text whose order is a fixed pseudo-random order of the rows."""
    return F.md5(F.concat_ws("|", F.col(quoted(id_col)).cast("string"), F.lit(str(seed))))


def _ranked(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    """Add ``__rank`` (from 0) and ``__size``: place in the shuffled order of its class, class size.

    A class may hold nearly all rows, so it is never one window. Rows are numbered inside
    (class, hash prefix) buckets and shifted by the size of the earlier buckets. The rank is
    exactly the one a single sort of the class would give.
    """
    keyed = df.withColumn("__h", shuffle_key(id_col, seed)).withColumn("__b", F.substring("__h", 1, _PREFIX))
    sizes = keyed.groupBy(F.col(quoted(label)).alias("__y"), F.col("__b").alias("__bb")).agg(F.count("*").alias("__n"))
    whole = Window.partitionBy("__y")
    earlier = whole.orderBy("__bb").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "__y",
        "__bb",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift"),
        F.sum("__n").over(whole).alias("__size"),
    )
    place = F.row_number().over(Window.partitionBy(quoted(label), "__b").orderBy("__h", quoted(id_col)))
    same = F.col(quoted(label)).eqNullSafe(F.col("__y")) & (F.col("__b") == F.col("__bb"))
    return keyed.join(shifts, same).withColumn("__rank", F.col("__shift") + place - 1).drop("__h", "__b", "__y", "__bb", "__shift")


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Assign every row to one of ``k`` folds; each class is spread evenly (sizes differ by at most 1)."""
    ranked = _ranked(df, id_col, label, seed)
    return ranked.withColumn(out, F.pmod("__rank", F.lit(k)).cast("int")).drop("__rank", "__size")


def holdout(df: DataFrame, id_col: str, label: str, fraction: float = 0.2, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Mark ``fraction`` of each class as test rows."""
    ranked = _ranked(df, id_col, label, seed)
    return ranked.withColumn(out, F.col("__rank") < F.lit(float(fraction)) * F.col("__size")).drop("__rank", "__size")


def seeded_sample(df: DataFrame, id_col: str, n: int = 100, seed: int = 42) -> DataFrame:
    """The same ``n`` rows on every run, whatever the partitioning (a top-n, not a full sort)."""
    h = shuffle_key(id_col, seed)
    return df.orderBy(h, quoted(id_col)).limit(n)


def with_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Number the rows from 1 in the given order.

    The rows are sorted in ranges of the order, each range in its own task, and stored with their place
    in it. A place is then shifted by the sizes of the earlier ranges.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialise(dealt.withColumn("__at", F.monotonically_increasing_id()))
    placed = stored.select(
        *df.columns, F.shiftrightunsigned("__at", 33).alias("__range"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)).alias("__place")
    )
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__n"))
    shifts = sizes.select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift"))
    numbered = placed.join(shifts, "__range").withColumn(out, F.col("__shift") + F.col("__place") + 1)
    return numbered.drop("__range", "__place", "__shift")


def action_list(
    df: DataFrame,
    score: str,
    id_col: str,
    keep: Sequence[str] = (),
    threshold: float = 0.5,
    stage: str | None = None,
    stage_text: str = "SQL",
) -> DataFrame:
    """Rows with a score of at least ``threshold``, best first, optionally of one stage only.

    The column ``rank`` keeps their order in tables that do not.
    """
    rows = above(df, score, threshold)
    if stage and stage in df.columns:
        rows = rows.filter(X.contains_ci(F.col(quoted(stage)), stage_text))
    wanted = list(dict.fromkeys([id_col, *keep, score]))
    listed = select_existing(rows, wanted)
    return with_rank(listed, [F.desc(quoted(score)), F.asc(quoted(id_col))]).orderBy("rank")


def top_importance(df: DataFrame, n: int = 20, feature: str = "feature", value: str = "importance") -> DataFrame:
    return df.orderBy(F.desc(value), F.asc(feature)).limit(n)
