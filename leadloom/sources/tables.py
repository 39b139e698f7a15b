"""Table sources and sinks: files and JDBC, typed and cleaned."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom import vocab
from leadloom.functions import dates as D
from leadloom.operators.frames import clean_output_names, clean_output_values, columns_of, drop_duplicate_columns, quoted
from leadloom.session import materialise

_FILES = ("parquet", "orc", "csv", "json")


def jdbc_options(source: Mapping[str, str], table: str | None, query: str | None, partition: Mapping | None) -> dict[str, str]:
    """Reader options; ``partition`` (column, lower, upper, parts) splits the read into ranges."""
    options = {k: str(v) for k, v in source.items() if k != "format"}
    options.setdefault("fetchsize", "10000")
    if query and partition:
        # A bare query cannot be split, a derived table can.
        options["dbtable"] = f"({query}) AS src"
    elif query:
        options["query"] = query
    else:
        options["dbtable"] = table
    if partition:
        options["partitionColumn"] = str(partition["column"])
        options["lowerBound"] = str(partition["lower"])
        options["upperBound"] = str(partition["upper"])
        options["numPartitions"] = str(partition["parts"])
    return options


def jdbc_write_options(target: Mapping[str, str], table: str, mode: str, batch: int, column_types: str | None) -> dict[str, str]:
    """Writer options; column types apply where the table is made anew."""
    options = {k: str(v) for k, v in target.items() if k != "format"}
    options.update(dbtable=table, batchsize=str(batch))
    if column_types and mode == "overwrite":
        options["createTableColumnTypes"] = column_types
    return options


def read_table(
    spark: SparkSession,
    source: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    partition: Mapping | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read a table or run a query.

    ``source`` holds ``format`` and its options: ``jdbc`` with ``url``; a file format with
    ``path`` (``table`` is then a folder or file below it); or ``catalog`` for named tables.
    """
    kind = source.get("format", "parquet")
    if kind == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(source, table, query, partition)).load()
    if query:
        return spark.sql(query)
    if kind == "catalog":
        return spark.table(table)
    if kind not in _FILES:
        raise ValueError(f"unknown source format {kind}")
    options = {k: str(v) for k, v in source.items() if k not in ("format", "path")}
    reader = spark.read.format(kind).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{source['path'].rstrip('/')}/{table}" if table else source["path"])


def write_table(
    df: DataFrame,
    target: Mapping[str, str],
    table: str,
    mode: str = "overwrite",
    batch: int = 1000,
    clean: bool = True,
    amp: str | None = "and",
    column_types: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Write a result table; an empty one replaces the previous run like any other, a failed write leaves it.

    ``clean`` makes names and values table-safe first. A JDBC table gets the column types of the
    frame's width profile, or those of ``column_types`` (see ``ddl_string``). ``partition_by`` (run id, date)
    lets later reads of file and catalog tables skip the other partitions.
    """
    if clean:
        df = clean_output_values(drop_duplicate_columns(clean_output_names(df, amp)))
    kind = target.get("format", "parquet")
    if kind == "jdbc" and mode == "overwrite" and column_types is None:
        df = materialise(df)  # profiled and written
        column_types = ddl_string(width_profile(df))
    options = {k: str(v) for k, v in target.items() if k not in ("format", "path")}
    if kind == "jdbc":
        df.write.format(kind).mode(mode).options(**jdbc_write_options(target, table, mode, batch, column_types)).save()
    elif kind == "catalog" and mode == "overwrite":
        replace_catalog_table(df, table, partition_by)
    elif kind == "catalog":
        df.write.mode(mode).partitionBy(*partition_by).saveAsTable(table)
    elif mode == "overwrite":
        replace_files(df, kind, f"{target['path'].rstrip('/')}/{table}", options, partition_by)
    else:
        df.write.format(kind).mode(mode).partitionBy(*partition_by).options(**options).save(f"{target['path'].rstrip('/')}/{table}")


class IncompleteWrite(RuntimeError):
    """The staged copy does not hold the rows that were written."""


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count("*").alias("n")), seen


def _verify(found: int, seen: Observation, name: str) -> None:
    if found != seen.get["n"]:
        raise IncompleteWrite(f"{name}: {found} rows in the staged copy, {seen.get['n']} written")


def replace_files(df: DataFrame, kind: str, path: str, options: Mapping[str, str], partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``: write beside it, count the rows, then swap the folders.

    Until the swap the old table stays as it is, so a failed run leaves it, and ``df`` may read from it. An
    empty result replaces it like any other. The swap is two renames; if the second fails the old table is put back.
    """
    spark = df.sparkSession
    Path = spark._jvm.org.apache.hadoop.fs.Path
    mark = uuid.uuid4().hex[:12]
    here, staged, before = Path(path), Path(f"{path}__staged_{mark}"), Path(f"{path}__before_{mark}")
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    rows, seen = _counted(df)
    try:
        rows.write.format(kind).partitionBy(*partition_by).options(**options).save(staged.toString())
        _verify(spark.read.format(kind).options(**options).schema(df.schema).load(staged.toString()).count(), seen, path)
        existed = fs.exists(here)
        if existed and not fs.rename(here, before):
            raise OSError(f"cannot set {path} aside")
        if not fs.rename(staged, here):
            if existed:
                fs.rename(before, here)
            raise OSError(f"cannot move the staged copy to {path}")
    finally:
        fs.delete(staged, True)
    if existed:
        fs.delete(before, True)


def _delete_folder_of(spark: SparkSession, table: str) -> None:
    """What a failed write of a managed table leaves in the warehouse."""
    state = spark._jsparkSession.sessionState()
    folder = spark._jvm.org.apache.hadoop.fs.Path(state.catalog().defaultTablePath(state.sqlParser().parseTableIdentifier(table)))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_catalog_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """``replace_files`` for a table of the catalog: a staged table is counted and takes over the name."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:12]
    staged, before = f"{table}__staged_{mark}", f"{table}__before_{mark}"
    rows, seen = _counted(df)
    try:
        rows.write.partitionBy(*partition_by).saveAsTable(staged)
        _verify(spark.table(staged).count(), seen, table)
        existed = spark.catalog.tableExists(table)
        if existed:
            spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
        try:
            spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        except Exception:
            if existed:
                spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
            raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        _delete_folder_of(spark, staged)
    if existed:
        spark.sql(f"DROP TABLE IF EXISTS {before}")


def widen_large_ints(df: DataFrame, limit: int = 10**14) -> DataFrame:
    """Turn integer columns with a value beyond +-``limit`` into text. One aggregate checks all."""
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)]
    if not longs:
        return df
    bounds = df.agg(
        *[F.min(quoted(c)).alias(f"lo{i}") for i, c in enumerate(longs)],
        *[F.max(quoted(c)).alias(f"hi{i}") for i, c in enumerate(longs)],
    ).first()
    wide = [
        c for i, c in enumerate(longs)
        if bounds[f"lo{i}"] is not None and (bounds[f"hi{i}"] > limit or bounds[f"lo{i}"] < -limit)
    ]
    return df.withColumns({c: F.col(quoted(c)).cast("string") for c in wide}) if wide else df


def width_profile(df: DataFrame, long_text: Sequence[str] = vocab.LEAD_LONG_TEXT, check_ints: bool = True) -> DataFrame:
    """(column, max_len, sql_type) for every column, from one aggregate over the table."""
    texts = set(columns_of(df, "text"))
    ints = set(columns_of(df, "integer"))
    aggs, lines = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(quoted(f.name))
        aggs += [
            (F.max(F.length(c)) if f.name in texts else F.lit(None).cast("int")).alias(f"w{i}"),
            (F.min(c).cast("bigint") if f.name in ints else F.lit(None).cast("bigint")).alias(f"lo{i}"),
            (F.max(c).cast("bigint") if f.name in ints else F.lit(None).cast("bigint")).alias(f"hi{i}"),
        ]
        lines.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.col(f"w{i}").cast("bigint").alias("max_len"),
                _sql_type(f, i, long_text, check_ints).alias("sql_type"),
            )
        )
    return df.agg(F.count("*").alias("__n"), *aggs).select(F.explode(F.array(*lines)).alias("c")).select("c.*")


def _sql_type(f: T.StructField, i: int, long_text: Sequence[str], check_ints: bool) -> Column:
    kind = f.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("DATETIME")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        too_big = (F.col(f"hi{i}") > F.lit(2147483647)) | (F.col(f"lo{i}") < F.lit(-2147483648))
        return F.when(too_big, F.lit("BIGINT")).otherwise(F.lit("INTEGER")) if check_ints else F.lit("INTEGER")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.lit("FLOAT")
    if isinstance(kind, T.BooleanType):
        return F.lit("BOOLEAN")
    if not isinstance(kind, T.StringType):
        return F.lit("NVARCHAR(500)")
    if any(word in f.name.lower() for word in long_text):
        return F.lit("NVARCHAR(MAX)")
    w = F.col(f"w{i}")
    roomy = F.least(F.greatest(F.floor(w * F.lit(1.5)), F.lit(50)), F.lit(500))
    return (
        F.when(w.isNull() | (w == 0), F.lit("NVARCHAR(255)"))
        .when(w > 4000, F.lit("NVARCHAR(MAX)"))
        .when(w > 500, F.lit("NVARCHAR(4000)"))
        .otherwise(F.concat(F.lit("NVARCHAR("), roomy.cast("string"), F.lit(")")))
    )


def ddl_string(profile: DataFrame) -> str:
    """``createTableColumnTypes`` value: the text columns of a profile (one row per column)."""
    rows = profile.filter(F.col("sql_type").startswith("NVARCHAR")).collect()
    types = {"NVARCHAR(MAX)": "CLOB"}
    return ", ".join(
        f"{quoted(r['column'])} {types.get(r['sql_type'], r['sql_type'].replace('NVARCHAR', 'VARCHAR'))}" for r in rows
    )


def run_metadata(spark: SparkSession, as_of: datetime, **fields) -> DataFrame:
    """One row describing a training run; dictionaries are stored as text."""
    columns = {"model_id": F.date_format(D.moment(as_of), "yyyyMMdd_HHmmss"), "training_date": D.moment(as_of)}
    for name, value in fields.items():
        cell = F.lit(str(value) if isinstance(value, Mapping) else value)
        columns[name] = cell.cast("bigint") if isinstance(value, int) and not isinstance(value, bool) else cell
    return spark.range(1).select(*[c.alias(name) for name, c in columns.items()])
