import os
from datetime import datetime

import pytest

from leadloom import vocab
from leadloom.session import shared_dir
from leadloom.sources import tables as T


@pytest.mark.parametrize(
    "length, want",
    [(0, "NVARCHAR(255)"), (33, "NVARCHAR(50)"), (34, "NVARCHAR(51)"), (333, "NVARCHAR(499)"), (334, "NVARCHAR(500)"),
     (500, "NVARCHAR(500)"), (501, "NVARCHAR(4000)"), (4001, "NVARCHAR(MAX)")],
)
def test_text_widths(spark, length, want):
    df = spark.createDataFrame([("x" * length,), (None,)], "v string")
    assert T.width_profile(df).first()["sql_type"] == want


def test_profile_of_other_types(spark):
    df = spark.createDataFrame([(1, 2**31, 1.0, True, "a", datetime(2024, 1, 1))], "i int, l bigint, d double, b boolean, MailData string, t timestamp_ntz")
    got = {r["column"]: r["sql_type"] for r in T.width_profile(df, vocab.TOPUP_LONG_TEXT).collect()}
    assert got == {"i": "INTEGER", "l": "BIGINT", "d": "FLOAT", "b": "BOOLEAN", "MailData": "NVARCHAR(MAX)", "t": "DATETIME"}
    unchecked = {r["column"]: r["sql_type"] for r in T.width_profile(df, check_ints=False).collect()}
    assert unchecked["l"] == "INTEGER"
    assert T.ddl_string(T.width_profile(df, vocab.TOPUP_LONG_TEXT)) == "`MailData` CLOB"
    assert T.width_profile(df.limit(0)).filter("column = 'l'").first()["sql_type"] == "INTEGER"


def test_large_ints_become_text(spark):
    df = spark.createDataFrame([(10**14, 10**14 + 1, -(10**14) - 1, None)], "a bigint, b bigint, c bigint, d bigint")
    assert dict(T.widen_large_ints(df).dtypes) == {"a": "bigint", "b": "string", "c": "string", "d": "bigint"}


def test_overwrite_append_and_empty(spark, tmp_path):
    target = {"format": "parquet", "path": str(tmp_path)}
    df = spark.createDataFrame([(1, None)], "id int, `a b` string")
    T.write_table(df, target, "t")
    T.write_table(df, target, "t", mode="append")
    back = T.read_table(spark, target, "t")
    assert back.columns == ["id", "a_b"] and back.count() == 2 and back.first()["a_b"] == ""
    T.write_table(df.limit(0), target, "t")
    assert T.read_table(spark, target, "t").count() == 0


def test_partitioned_table_is_pruned(spark, tmp_path):
    target = {"format": "parquet", "path": str(tmp_path)}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, pipeline_run_id string")
    T.write_table(df, target, "t", partition_by=["pipeline_run_id"])
    one = T.read_table(spark, target, "t").filter("pipeline_run_id = 'b'")
    assert [r["id"] for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull(pipeline_run_id" in one._jdf.queryExecution().executedPlan().toString()


def test_other_file_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "id int, s string")
    for kind in ("orc", "json", "csv"):
        target = {"format": kind, "path": str(tmp_path / kind)} | ({"header": "true"} if kind == "csv" else {})
        T.write_table(df, target, "t")
        assert tuple(T.read_table(spark, target, "t", schema="id int, s string").first()) == (1, "x")
    with pytest.raises(ValueError):
        T.read_table(spark, {"format": "other", "path": "x"}, "t")


def test_jdbc_options():
    source = {"format": "jdbc", "url": "jdbc:x", "user": "u"}
    plain = T.jdbc_options(source, "dbo.t", None, None)
    assert plain == {"url": "jdbc:x", "user": "u", "fetchsize": "10000", "dbtable": "dbo.t"}
    assert T.jdbc_options(source, None, "SELECT 1", None)["query"] == "SELECT 1"
    split = T.jdbc_options(source, None, "SELECT * FROM t", {"column": "id", "lower": 0, "upper": 9, "parts": 3})
    assert split["dbtable"] == "(SELECT * FROM t) AS src" and split["numPartitions"] == "3" and "query" not in split


def test_run_metadata(spark):
    got = T.run_metadata(spark, datetime(2024, 1, 2, 3, 4, 5), n=3, auc=None, params={"a": 1}).first()
    assert got["model_id"] == "20240102_030405" and got["n"] == 3 and got["auc"] is None and got["params"] == "{'a': 1}"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_jdbc_table_gets_profiled_types_where_it_is_made_anew(spark):
    target = {"format": "jdbc", "url": "jdbc:x", "user": "u"}
    types = T.ddl_string(T.width_profile(spark.createDataFrame([("x" * 40, 1)], "v string, n int")))
    made = T.jdbc_write_options(target, "t", "overwrite", 500, types)
    assert made == {"url": "jdbc:x", "user": "u", "dbtable": "t", "batchsize": "500", "createTableColumnTypes": "`v` VARCHAR(60)"}
    assert "createTableColumnTypes" not in T.jdbc_write_options(target, "t", "append", 500, types)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    target = {"format": "parquet", "path": str(tmp_path)}
    df = spark.range(200).selectExpr("id", "cast(id as string) AS s")
    T.write_table(df, target, "t")
    broken = df.selectExpr("id", "if(id = 150, raise_error('planted'), s) AS s")
    with pytest.raises(Exception, match="planted"):
        T.write_table(broken, target, "t")
    assert T.read_table(spark, target, "t").count() == 200
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]  # no staged copy stays


def test_a_table_may_be_replaced_from_itself(spark, tmp_path):
    target = {"format": "parquet", "path": str(tmp_path)}
    T.write_table(spark.range(10).selectExpr("id"), target, "t")
    T.write_table(T.read_table(spark, target, "t").filter("id < 4"), target, "t")
    assert T.read_table(spark, target, "t").count() == 4


def test_an_incomplete_copy_is_not_swapped_in(spark, tmp_path, monkeypatch):
    target = {"format": "parquet", "path": str(tmp_path)}
    T.write_table(spark.range(10).selectExpr("id"), target, "t")
    real = T._verify
    monkeypatch.setattr(T, "_verify", lambda found, seen, name: real(found - 1, seen, name))
    with pytest.raises(T.IncompleteWrite):
        T.write_table(spark.range(3).selectExpr("id"), target, "t")
    monkeypatch.undo()
    assert T.read_table(spark, target, "t").count() == 10


def test_catalog_tables_are_replaced_alike(spark):
    target, name = {"format": "catalog"}, "staged_orders"
    folder = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    before = os.listdir(folder) if os.path.isdir(folder) else []
    try:
        T.write_table(spark.range(5).selectExpr("id"), target, name)
        T.write_table(spark.range(5).selectExpr("id"), target, name, mode="append")
        assert spark.table(name).count() == 10
        with pytest.raises(Exception, match="planted"):
            T.write_table(spark.range(5).selectExpr("if(id = 3, raise_error('planted'), id) AS id"), target, name)
        assert spark.table(name).count() == 10
        T.write_table(spark.range(0).selectExpr("id"), target, name)
        assert spark.table(name).count() == 0
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
        assert [f for f in os.listdir(folder) if f.startswith(name) and f not in before] in ([], [name])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
