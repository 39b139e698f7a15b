"""Projection, filter, cleaning and join operators (frame in, frame out).

A column that is absent makes an operator a no-op for that column unless ``strict`` is set.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom import vocab
from leadloom.functions import dates as D
from leadloom.functions import text as X

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (T.NumericType,)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_KINDS = {
    "integer": _INTEGERS,
    "numeric": _NUMBERS,
    "text": (T.StringType,),
    "time": _TIMES,
    "bool": (T.BooleanType,),
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _present(df: DataFrame, cols: Sequence[str], strict: bool = False) -> list[str]:
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise ValueError(f"columns missing: {missing}; columns found: {df.columns}")
    return [c for c in cols if c in df.columns]


# --- projection ----------------------------------------------------------------------


def select_existing(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    return df.select(*[quoted(c) for c in _present(df, cols, strict)])


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``integer``, ``numeric``, ``text``, ``time`` or ``bool`` columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _KINDS[kind])]


def feature_columns(df: DataFrame, exclude: Sequence[str], target: str, kind: str = "numeric") -> list[str]:
    """Columns of one kind that are neither excluded nor the target.

    Excluded names match in their raw and in their cleaned spelling, so that a list written
    with blanks also covers a table saved with underscores.
    """
    barred = {_clean_name(c).lower() for c in (*exclude, target)}
    return [c for c in columns_of(df, kind) if _clean_name(c).lower() not in barred]


def normalise_id(df: DataFrame, aliases: Sequence[str], to: str) -> DataFrame:
    """Give the entity key its standard name."""
    if to in df.columns:
        return df
    for alias in aliases:
        if alias in df.columns:
            return df.withColumnRenamed(alias, to)
    raise ValueError(f"no column {to} or any of {list(aliases)}; columns found: {df.columns}")


def rename_key(df: DataFrame, frm: str, to: str) -> DataFrame:
    return df.withColumnRenamed(frm, to)


def drop_duplicate_columns(df: DataFrame, case_insensitive: bool = True) -> DataFrame:
    """Keep the first of columns that share a name."""
    seen, keep = set(), []
    for position, name in enumerate(df.columns):
        folded = name.lower() if case_insensitive else name
        if folded not in seen:
            seen.add(folded)
            keep.append((f"c{position}", name))
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(tmp).alias(name) for tmp, name in keep])


def sanitize_column_names(df: DataFrame) -> DataFrame:
    """Word characters only, single underscores, none at the edges; later duplicates dropped."""
    names = [re.sub(r"_+", "_", re.sub(r"[^\w]", "_", c)).strip("_") for c in df.columns]
    return drop_duplicate_columns(df.toDF(*names), case_insensitive=False)


def _clean_name(name: str, amp: str | None = None) -> str:
    name = name.replace(" ", "_").replace("-", "_")
    return name.replace("&", amp) if amp else name


def clean_output_names(df: DataFrame, amp: str | None = "and") -> DataFrame:
    """Table-safe names: blanks and hyphens become underscores, ``&`` becomes ``amp``."""
    return df.toDF(*[_clean_name(c, amp) for c in df.columns])


def clean_output_values(df: DataFrame) -> DataFrame:
    """Timestamps lose their zone; null text and the text ``nan`` become empty."""
    out = {}
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, T.TimestampType):
            out[f.name] = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.StringType):
            out[f.name] = F.when(c == "nan", F.lit("")).otherwise(F.coalesce(c, F.lit("")))
    return df.withColumns(out)


def stamp_run(df: DataFrame, as_of: datetime) -> DataFrame:
    """Add the run time and the run id derived from it."""
    at = D.moment(as_of)
    return df.withColumns({"created_at": at, "pipeline_run_id": F.date_format(at, "yyyyMMdd_HHmmss")})


# --- filters -------------------------------------------------------------------------


def not_equal_keep_null(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose value differs; unlike ``!=`` rows with null stay."""
    return df.filter(~F.col(quoted(col)).eqNullSafe(F.lit(value)))


def lead_filter(
    df: DataFrame,
    contact_types: Sequence[str],
    stages: Sequence[str] = ("SQL 1", "SQL 2", "SAL 1", "SAL 2"),
    stage: str = "LeadStageNewCEO",
    known: str = "IsThisLeadAlreadyFoundInAnInternalDatabase",
    contact_type: str = "ContactType",
) -> DataFrame:
    """Qualified leads that are not yet known internally."""
    return df.filter(
        F.col(stage).isin(list(stages))
        & (F.col(known) == "Not Found")
        & F.col(contact_type).isin(list(contact_types))
    )


def conversion_filter(
    df: DataFrame,
    contact_types: Sequence[str],
    client_type: str,
    excluded_ids: Sequence[int] = (),
    extra_ids: Sequence[int] = (),
    committed_stage: str = "Committed Capital",
    stages: Sequence[str] = ("SAL 1", "SAL 2"),
    key: str = "HubSpotId",
    onboarding: str = "OnboardingId",
    contact_type: str = "ContactType",
) -> DataFrame:
    """Committed clients, or accepted leads of the given contact types.

    The contact-type test belongs to the second arm only.
    """
    client = F.col("ClientType") == client_type
    if extra_ids:
        client = client | F.col(key).isin(list(extra_ids))
    committed = F.col(onboarding).isNotNull() & (F.col("LeadStageNew") == committed_stage) & client
    if excluded_ids:
        committed = committed & ~F.col(onboarding).isin(list(excluded_ids))
    accepted = F.col("LeadStageNewCEO").isin(list(stages)) & F.col(contact_type).isin(list(contact_types))
    return df.filter(committed | accepted)


def above(df: DataFrame, col: str, threshold: float = 0.5) -> DataFrame:
    return df.filter(F.col(quoted(col)) >= F.lit(float(threshold)))


# --- cleaning ------------------------------------------------------------------------


def fill_defaults(df: DataFrame, defaults: Mapping[str, object], strict: bool = False) -> DataFrame:
    """Replace nulls by a constant, cast to the type of the column."""
    present = _present(df, list(defaults), strict)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.coalesce(F.col(quoted(c)), F.lit(defaults[c]).cast(types[c])) for c in present}
    )


def fill_by_type(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls become 0 in numeric, empty in text and False in boolean columns."""
    neutral = ((T.NumericType, 0), (T.StringType, ""), (T.BooleanType, False))
    chosen = set(df.columns if cols is None else cols)
    out = {}
    for f in df.schema.fields:
        value = next((v for kind, v in neutral if isinstance(f.dataType, kind)), None)
        if f.name in chosen and value is not None:
            out[f.name] = F.coalesce(F.col(quoted(f.name)), F.lit(value).cast(f.dataType))
    return df.withColumns(out) if out else df


def as_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(quoted(c)).cast("string") for c in _present(df, cols)})


def days_since(
    df: DataFrame,
    cols: Sequence[str],
    as_of: datetime | str | Column,
    missing: int = vocab.MISSING_DAYS,
) -> DataFrame:
    """Replace each date column by ``<column>_days``, the whole days before ``as_of``."""
    present = _present(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in present:
        raw = F.col(quoted(c))
        at = D.parse_moment(raw) if isinstance(types[c], T.StringType) else raw
        out[f"{c}_days"] = F.coalesce(D.floor_days(at, D.moment(as_of)), F.lit(missing).cast("bigint"))
    return df.withColumns(out).drop(*present) if out else df


def date_bins(
    df: DataFrame,
    col: str,
    as_of: datetime | str | Column,
    out: str | None = None,
    edges: Sequence[int] = vocab.DATE_BIN_EDGES,
    labels: Sequence[str] = vocab.DATE_BIN_LABELS,
) -> DataFrame:
    """Label each date by its distance from the earliest date of the column.

    The last interval ends at ``as_of``; later dates get null. An edge beyond ``as_of`` leaves
    its interval empty. The earliest date is a one-row subquery over one column.
    """
    if col not in df.columns:
        return df
    start = df.agg(F.min(quoted(col)).cast("timestamp_ntz")).scalar()
    value = F.col(quoted(col)).cast("timestamp_ntz")
    days = F.when(value < D.moment(as_of), D.floor_days(start, value))
    aged = df.withColumn("__days", days)
    return aged.withColumn(out or f"{col}_Bins", D.day_bin(F.col("__days"), edges, labels)).drop("__days")


def flag_columns(df: DataFrame, col: str, flags: Mapping[str, object]) -> DataFrame:
    """One 0/1 column per (output name, value)."""
    if col not in df.columns:
        return df
    return df.withColumns({name: X.flag(F.col(quoted(col)), value) for name, value in flags.items()})


# --- joins ---------------------------------------------------------------------------


def left_attach(
    df: DataFrame,
    right: DataFrame,
    key: str,
    fill: Mapping[str, object] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Left join on ``key`` with typed defaults; ``prefix`` marks names both sides have."""
    for c in right.columns:
        if c != key and c in df.columns:
            if not prefix:
                raise ValueError(f"both sides have the column {c}; pass a prefix")
            right = right.withColumnRenamed(c, prefix + c)
    joined = df.join(right, key, "left")
    return fill_defaults(joined, fill) if fill else joined


_BROADCAST_IDS = 2_000_000  # ids: some 60 MB as a hash table
_HOT_SHARE = 0.001


def few_ids(ids: DataFrame, limit: int = _BROADCAST_IDS) -> bool:
    """Whether an id list is small enough to send to every task; reads no more than the limit."""
    return ids.limit(limit + 1).count() <= limit


def hot_keys(df: DataFrame, key: str, share: float = _HOT_SHARE) -> list:
    """All keys with more than ``share`` of the rows (and possibly some others), 1/share at most.

    One pass over the key column, without a shuffle.
    """
    found = df.select(quoted(key)).filter(F.col(quoted(key)).isNotNull()).freqItems([key], share).first()
    return [k for k in found[0] if k is not None]


def keep_known(df: DataFrame, ids: DataFrame, key: str, broadcast_limit: int = _BROADCAST_IDS) -> DataFrame:
    """Rows whose key is among ``ids``.

    A short id list goes to every task and nothing is shuffled. Otherwise rows are shuffled by
    key, except those of hot keys, which are so few keys that a plain filter decides them.
    """
    ids, columns = ids.select(quoted(key)), [F.col(quoted(c)) for c in df.columns]
    if few_ids(ids, broadcast_limit):
        return df.join(F.broadcast(ids), key, "left_semi").select(columns)
    c, hot, known = _split_hot(df, ids, key)
    rest = df.filter(~c.isin(hot)).join(ids, key, "left_semi").select(columns)
    return rest.unionByName(df.filter(c.isin(known)))


def drop_known(df: DataFrame, ids: DataFrame, key: str, broadcast_limit: int = _BROADCAST_IDS) -> DataFrame:
    """Rows whose key is not among ``ids``; rows without a key stay."""
    ids, columns = ids.select(quoted(key)), [F.col(quoted(c)) for c in df.columns]
    if few_ids(ids, broadcast_limit):
        return df.join(F.broadcast(ids), key, "left_anti").select(columns)
    c, hot, known = _split_hot(df, ids, key)
    unknown = [k for k in hot if k not in set(known)]
    rest = df.filter(c.isNull() | ~c.isin(hot)).join(ids, key, "left_anti").select(columns)
    return rest.unionByName(df.filter(c.isin(unknown)))


def _split_hot(df: DataFrame, ids: DataFrame, key: str) -> tuple[Column, list, list]:
    c = F.col(quoted(key))
    hot = hot_keys(df, key)
    known = [r[0] for r in ids.filter(c.isin(hot)).distinct().collect()]
    return c, hot, known


# --- missing data --------------------------------------------------------------------


def missing_ratio(
    df: DataFrame, groups: Mapping[str, Sequence[str]] = vocab.MISSING_GROUPS, out: str = "missing_ratio"
) -> DataFrame:
    """Share of one-hot groups that are all zero; a group without any column is not missing."""
    marks = []
    for members in groups.values():
        present = _present(df, members)
        if present:
            total = reduce(
                lambda a, b: a + b, [F.coalesce(F.col(quoted(c)).cast("int"), F.lit(0)) for c in present]
            )
            marks.append((total == 0).cast("int"))
    total = reduce(lambda a, b: a + b, marks, F.lit(0))
    return df.withColumn(out, total / F.lit(float(len(groups))))


def drop_high_missing(
    df: DataFrame, groups: Mapping[str, Sequence[str]] = vocab.MISSING_GROUPS, threshold: float = 0.8
) -> DataFrame:
    """Drop rows with too many missing groups. The test is on the row itself: no join."""
    marked = missing_ratio(df, groups, out="__missing")
    return marked.filter(F.col("__missing") < F.lit(float(threshold))).drop("__missing")


# --- summaries -----------------------------------------------------------------------


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.groupBy(quoted(col)).agg(F.count("*").alias(out))


def summary(df: DataFrame, col: str) -> DataFrame:
    """Row count, non-null count, mean, minimum and maximum of a column."""
    c = F.col(quoted(col)).cast("double")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count(c).alias("n_values"),
        F.avg(c).alias("mean"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def distinct_count(df: DataFrame, col: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(F.col(quoted(col))).alias("n_distinct"))
