import os

import pytest
from pyspark.sql import functions as F

from leadloom import session as S


def test_spread_moves_small_inputs_only(spark, monkeypatch):
    df = spark.range(0, 100, 1, 1)
    assert S.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(S, "_SCAN_PARTITION", 1)
    assert S.spread(df).rdd.getNumPartitions() == 1


def test_training_table_has_few_partitions_when_small(spark, monkeypatch):
    df = spark.range(0, 10_000, 1, 8)
    assert S.training_table(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(S, "_FIT_PARTITION", 64)
    stored = S.training_table(df)
    assert stored.rdd.getNumPartitions() > 1 and stored.count() == 10_000


def test_fits_at_once_leaves_cores_to_large_tables(spark):
    assert S.fits_at_once(spark.range(0, 10, 1, 1)) == spark.sparkContext.defaultParallelism
    assert S.fits_at_once(spark.range(0, 10, 1, 500)) == 2


def test_stored_table_keeps_feature_metadata(spark):
    from leadloom.operators.modelling import fit_features

    df = spark.createDataFrame([("a", "p", 1.0), ("b", "q", 2.0), ("c", "q", 2.0)], "x string, y string, n double")
    wide = fit_features(df, ["n"], ["x", "y"]).apply(df)
    assert S.materialise(wide).schema["features"].metadata == wide.schema["features"].metadata


def test_run_folder_is_removed_and_may_be_nested(spark):
    kept = S.materialise(spark.range(3))
    with S.run_folder(spark) as outer:
        first = S.materialise(spark.range(5))
        with S.run_folder(spark) as inner:
            S.materialise(spark.range(7))
            assert inner.startswith(outer) and os.path.isdir(inner.removeprefix("file:"))
        assert first.count() == 5 and S.steps_dir(spark) == outer and not os.path.exists(inner.removeprefix("file:"))
    assert not os.path.exists(outer.removeprefix("file:")) and kept.count() == 3
    with pytest.raises(KeyError), S.run_folder(spark) as failed:
        S.materialise(spark.range(2))
        raise KeyError
    assert not os.path.exists(failed.removeprefix("file:"))
    assert S.steps_dir(spark) == f"{S.shared_dir(spark).rstrip('/')}/leadloom"


def test_only_a_local_session_falls_back_to_a_folder_of_its_own(tmp_path, monkeypatch):
    class Conf(dict):
        def set(self, name, value):
            if name.startswith("spark."):
                raise AssertionError("a running session cannot set it")
            self[name] = value

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(), type("Context", (), {"master": master})

    monkeypatch.setattr(S.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    local = Session("local[2]")
    assert S.shared_dir(local) == str(tmp_path) == S.shared_dir(local)
    with pytest.raises(ValueError):
        S.shared_dir(Session("spark://host:7077"))


def test_training_rows_that_pack_well_are_not_left_to_one_core(spark):
    flags = spark.range(0, 180_000, 1, 4).select((F.col("id") % 2).alias("label"))
    table = S.training_table(flags)
    assert table.rdd.getNumPartitions() == 4 and table.count() == 180_000
    assert S.training_table(flags.limit(50_000)).rdd.getNumPartitions() == 1


def test_small_batches_bound_what_python_gets_at_once(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    try:
        for given, want in (("10000", 500), ("0", 500), ("200", 200)):
            spark.conf.set(key, given)
            S.small_batches(spark, 500)
            assert spark.range(0, 1200, 1, 1).mapInArrow(sizes, "n bigint").agg(F.max("n"), F.sum("n")).first() == (want, 1200)
    finally:
        spark.conf.set(key, before)
