"""Category encoders: a fit gives a small plain vocabulary, a transform adds columns.

Every fit scans its table once for all columns and returns at most a stated number of values
per column, so what reaches the driver never grows with the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom import vocab
from leadloom.functions import text as X
from leadloom.operators.frames import columns_of, quoted
from leadloom.session import materialise


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) for all listed columns in one pass; nulls are not counted."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in cols]
    cells = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.value")
    return cells.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))


def _first_values(df: DataFrame, cols: Sequence[str], limit: int, by_count: bool) -> dict[str, list[str]]:
    present = [c for c in cols if c in df.columns]
    if not present:
        return {}
    order = [F.desc("n"), F.asc("value")] if by_count else [F.asc("value")]
    rank = F.row_number().over(Window.partitionBy("column").orderBy(*order))
    rows = category_counts(df, present).withColumn("r", rank).filter(F.col("r") <= limit).collect()
    found = {c: [] for c in present}
    for row in sorted(rows, key=lambda r: (r["column"], r["r"])):
        found[row["column"]].append(row["value"])
    return found


def fit_top_values(df: DataFrame, cols: Sequence[str], n: int = 5) -> dict[str, list[str]]:
    """The ``n`` most frequent values per column; equal counts in value order."""
    return _first_values(df, cols, n, by_count=True)


def top_or_other(
    df: DataFrame, col: str, n: int = 5, values: Sequence[str] | None = None, other: str = "Other"
) -> DataFrame:
    """Keep the most frequent values, name all others (and null) ``other``."""
    if col not in df.columns:
        return df
    kept = list(values) if values is not None else fit_top_values(df, [col], n)[col]
    c = F.col(quoted(col)).cast("string")
    return df.withColumn(col, F.when(c.isin(kept), c).otherwise(F.lit(other)))


def fit_onehot(df: DataFrame, cols: Sequence[str], max_categories: int = 1000) -> dict[str, list[str]]:
    """Sorted distinct values per column; a column with too many to be columns is an error."""
    found = _first_values(df, cols, max_categories + 1, by_count=False)
    wide = [c for c, values in found.items() if len(values) > max_categories]
    if wide:
        raise ValueError(f"more than {max_categories} categories in {wide}; bucket them with top_or_other first")
    return found


def onehot(df: DataFrame, vocabulary: Mapping[str, Sequence[str]], prefix: Mapping[str, str] | None = None) -> DataFrame:
    """0/1 columns named ``<column>_<value>``; values unseen at fit time and null give all zeros."""
    out = {}
    for col, values in vocabulary.items():
        if col in df.columns:
            stem = (prefix or {}).get(col, col)
            text = F.col(quoted(col)).cast("string")
            out.update({f"{stem}_{v}": X.flag(text, v) for v in values})
    return df.withColumns(out) if out else df


def sorted_codes(df: DataFrame, col: str, value: str = "value", code: str = "code", slices: int = 256) -> DataFrame:
    """(value, code): the rank of each distinct value in code-point order, from 0.

    For columns with very many values. A fixed-size hash sample of the values gives the cut
    points of ``slices`` ranges; values are ranked inside their range and shifted by the size
    of the lower ranges, so no single task sorts them all.
    """
    text = F.col(quoted(col)).cast("string").alias(value)
    words = materialise(df.select(text).filter(F.col(value).isNotNull()).distinct())
    sample = sorted(r[0] for r in words.orderBy(F.xxhash64(value), value).limit(16 * slices).collect())
    cuts = sorted(set(sample[len(sample) * i // slices] for i in range(1, slices))) if sample else []
    place = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col(value))) if cuts else F.lit(0)
    ranged = words.withColumn("__r", place)
    earlier = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # over ``slices`` rows
    sizes = ranged.groupBy("__r").agg(F.count("*").alias("__n"))
    shift = sizes.select("__r", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift"))
    rank = F.row_number().over(Window.partitionBy("__r").orderBy(value))
    return ranged.join(shift, "__r").select(value, (F.col("__shift") + rank - 1).cast("bigint").alias(code))


def fit_labels(df: DataFrame, cols: Sequence[str], unknown: str = "Unknown", literal_limit: int = 256) -> dict:
    """Sorted vocabulary per text column, or a (value, code) frame where it is long.

    Columns that are numeric already need no codes and are skipped. Null counts as ``unknown``.
    """
    numeric = set(columns_of(df, "numeric"))
    todo = [c for c in cols if c in df.columns and c not in numeric]
    filled = df.select(*[F.coalesce(F.col(quoted(c)).cast("string"), F.lit(unknown)).alias(c) for c in todo])
    found = _first_values(filled, todo, literal_limit + 1, by_count=False)
    return {
        c: values if len(values) <= literal_limit else sorted_codes(filled, c) for c, values in found.items()
    }


def label_encode(df: DataFrame, labels: Mapping, unknown: str = "Unknown", suffix: str = "_encoded") -> DataFrame:
    """Add ``<column>_encoded``; a value that was absent at fit time gets null."""
    for col, known in labels.items():
        text = F.coalesce(F.col(quoted(col)).cast("string"), F.lit(unknown))
        if isinstance(known, DataFrame):
            codes = known.select(F.col("value").alias("__v"), F.col("code").alias(col + suffix))
            df = df.join(codes, text == F.col("__v"), "left").drop("__v")
        else:
            place = F.array_position(F.lit(list(known)), text)
            df = df.withColumn(col + suffix, F.when(place > 0, (place - 1).cast("bigint")))
    return df


def contact_flags(df: DataFrame) -> DataFrame:
    """Ordinal and 0/1 columns with fixed vocabularies: segment, engagement and age bands."""
    out = {}
    if "SegmentClass" in df.columns:
        out.update({f"SegmentClass_{i}": X.flag("SegmentClass", i) for i in range(5)})
    if "EngagementLabel" in df.columns:
        level = X.value_map("EngagementLabel", vocab.ENGAGEMENT_ORDINAL, keep=False)
        out["engagement_label"] = F.coalesce(level, F.lit(-1))
    if "AgeRange" in df.columns:
        out.update({name: X.flag(F.col("AgeRange").cast("string"), v) for name, v in vocab.AGE_BANDS.items()})
    return df.withColumns(out) if out else df


def lead_target(df: DataFrame, stage: str = "LeadStageNewCEO", out: str = "Target") -> DataFrame:
    return df.withColumn(out, X.contains_flag(stage, "SAL"))


def conversion_target(df: DataFrame, stage: str = "LeadStageNewCEO", out: str = "Target") -> DataFrame:
    """1 for clients, 0 for accepted leads, null for every other stage."""
    if stage not in df.columns:
        raise ValueError(f"column {stage} missing")
    return df.withColumn(out, X.value_map(stage, vocab.CONVERSION_TARGET, keep=False).cast("int"))


def topup_target(df: DataFrame, col: str = "they_topped_up", out: str = "target_flag") -> DataFrame:
    positive = F.coalesce(F.col(quoted(col)).cast("double"), F.lit(0.0)) > 0
    return df.withColumn(out, positive.cast("int"))
