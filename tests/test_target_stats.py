"""Ordered target statistics against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from leadloom.operators import modelling as M
from leadloom.operators import target_stats as T
from leadloom.session import materialise


def plain(rows, column, weight=1.0, seed=42):
    """id -> share; rows are (id, values, label)."""
    known = sorted((r for r in rows if r[2] is not None), key=lambda r: (hashlib.md5(f"{r[0]}|{seed}".encode()).hexdigest(), r[0]))
    overall = sum(r[2] for r in known) / len(known) if known else 0.0
    seen, out = {}, {}
    for i, values, label in known:
        s, n = seen.get(values[column] or "", (0, 0))
        out[i] = (s + weight * overall) / (n + weight)
        seen[values[column] or ""] = (s + label, n + 1)
    for i, values, label in rows:
        if label is None:
            s, n = seen.get(values[column] or "", (0, 0))
            out[i] = (s + weight * overall) / (n + weight)
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_equal_to_plain_python(spark, parts):
    drawn = random.Random(6)
    rows = [(i, (drawn.choice(["hot", "hot", "hot", "b", None, ""]), f"v{drawn.randrange(400)}"), drawn.choice([0, 1, 1, None])) for i in range(900)]
    df = spark.createDataFrame([(i, a, b, y, "extra") for i, (a, b), y in rows], "k bigint, a string, `b c` string, y int, h string").repartition(parts)
    got = {r["k"]: (r["a_target"], r["b c_target"]) for r in T.target_statistics(df, "k", ["a", "b c"], "y").collect()}
    first, second = plain(rows, 0), plain(rows, 1)
    assert got == {i: (pytest.approx(first[i]), pytest.approx(second[i])) for i, _, _ in rows}
    assert T.wide_columns(df, ["a", "b c"], 100) == ["b c"]
    assert T.target_statistics(df.limit(0), "k", ["a"], "y").count() == 0
    unlabelled = T.target_statistics(df.withColumn("y", F.lit(None).cast("int")), "k", ["a"], "y")
    assert unlabelled.select("a_target").distinct().collect() == [(0.0,)]


def test_a_nearly_unique_column_trains(spark):
    """100,000 values that are bins of no tree: the fit fails clearly without statistics and works with them."""
    df = spark.range(100_000).select("id", F.concat(F.lit("name"), F.col("id")).alias("name"), F.pmod("id", F.lit(7)).cast("string").alias("day"))
    df = materialise(df.withColumn("label", (F.col("day") == "3").cast("int")))
    with pytest.raises(ValueError, match="name"):
        M.fit_features(df, [], ["name", "day"])
    wide = T.wide_columns(df, ["name", "day"], 1000)
    assert wide == ["name"]
    made = T.with_target_statistics(df, "id", ["name", "day"], "label")
    plan = M.fit_features(made, ["name_target", "day_target"])
    fitted = M.propensity_pipeline(maxIter=2, maxDepth=2).fit(plan.apply(made))
    scored = M.score(plan.apply(made), fitted)
    assert scored.filter(F.col("y_pred") != F.col("label")).count() < 2_000  # what two trees of 32 bins leave
