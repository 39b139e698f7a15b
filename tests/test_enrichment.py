"""Guarded calls: results, errors, repetitions and time limits."""

import time

import pytest
from pyspark.sql import functions as F

from leadloom.operators import enrichment as E


def test_attempts_and_errors():
    calls = []

    def flaky(row):
        calls.append(row["x"])
        if len(calls) < 3:
            raise ConnectionError("busy")
        return f"answer {row['x']}"

    assert E.guarded(flaky, {"x": 5}, retries=2) == ("answer 5", None, 3)
    assert E.guarded(lambda row: 1 / 0, {}, retries=1) == ("", "ZeroDivisionError: division by zero", 2)
    assert E.guarded(lambda row: None, {}, retries=0) == ("", "ValueError: empty answer", 1)
    assert E.guarded(lambda row: "x" * 3, {}, retries=0)[0] == "xxx"
    long = E.guarded(lambda row: (_ for _ in ()).throw(RuntimeError("y" * 9000)), {}, retries=0)
    assert len(long[1]) == 500


def test_a_late_call_is_left_behind():
    start = time.time()
    text, error, attempts = E.guarded(lambda row: time.sleep(30), {}, retries=1, timeout=0.2)
    assert (text, attempts) == ("", 2) and error.startswith("TimeoutError") and time.time() - start < 5


def test_planted_failures_are_counted_while_the_run_goes_on(spark):
    rows = [(i, None if i % 5 == 0 else f"t{i}", "clash") for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, `a b` string, error string").repartition(3)

    def call(row):
        if row["id"] % 7 == 0:
            raise KeyError(row["id"])
        if row["id"] == 11:
            time.sleep(20)
        return f"{row['a b']}"

    found, counts = E.enrich(df, call, ["id", "a b"], out="say", retries=1, timeout=1.0)
    got = {r["id"]: r for r in found.collect()}
    bad = {i for i in range(60) if i % 7 == 0} | {11}
    assert set(got) == set(range(60)) and found.columns == ["id", "a b", "error", "say", "say_error", "say_attempts"]
    assert all((got[i]["say"], got[i]["say_attempts"]) == ("", 2) for i in bad)
    assert all(got[i]["say"] == str(rows[i][1]) and got[i]["say_error"] is None for i in set(got) - bad)
    assert got[11]["say_error"].startswith("TimeoutError")
    assert counts == {"rows": 60, "failed": len(bad), "attempts": 60 + len(bad)}
    empty, none = E.enrich(df.limit(0), call, ["id", "a b"])
    assert empty.count() == 0 and none["failed"] == 0


@pytest.mark.parametrize("at_once", [1, 16])
def test_values_reach_the_call_with_their_types(spark, at_once):
    df = spark.range(20).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"), (F.col("id") / 4).alias("q"), F.array("id").alias("unused"))
    rows = E.enriched(df, lambda row: repr((row["n"] is None, row["q"])), ["n", "q"], at_once=at_once).collect()
    assert all(r["pitch"] == repr((r["id"] % 2 == 1, r["id"] / 4)) for r in rows)
