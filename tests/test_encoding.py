import random

import pytest
from pyspark.sql import functions as F

from leadloom import vocab
from leadloom.operators import encoding as C


def test_onehot_unseen_and_null(spark):
    fitted = C.fit_onehot(spark.createDataFrame([("a",), ("b",), (None,)], "x string"), ["x", "absent"])
    assert fitted == {"x": ["a", "b"]}
    got = C.onehot(spark.createDataFrame([("a",), ("new",), (None,)], "x string"), fitted)
    assert sorted(tuple(r)[1:] for r in got.collect()) == [(0, 0), (0, 0), (1, 0)]


def test_onehot_refuses_too_many_columns(spark):
    with pytest.raises(ValueError):
        C.fit_onehot(spark.range(20).select(F.col("id").cast("string").alias("x")), ["x"], max_categories=10)


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "zzyyxxwwvvuua"], "x string")
    assert C.fit_top_values(df, ["x"], 5) == {"x": ["u", "v", "w", "x", "y"]}
    got = {r["x"] for r in C.top_or_other(df.union(spark.createDataFrame([(None,)], "x string")), "x", 5).collect()}
    assert got == {"u", "v", "w", "x", "y", "Other"}


@pytest.mark.parametrize("limit", [1000, 3])
def test_label_codes_are_sorted_ranks(spark, limit):
    rng = random.Random(1)
    values = ["".join(rng.choice("aAbé1") for _ in range(3)) for _ in range(200)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r["i"]: r["x_encoded"] for r in C.label_encode(df, C.fit_labels(df, ["x"], literal_limit=limit)).collect()}
    order = sorted({v or "Unknown" for v in values})
    assert got == {i: order.index(v or "Unknown") for i, v in enumerate(values)}


def test_label_encode_skips_numbers_and_unseen_values(spark):
    df = spark.createDataFrame([(1, "a")], "n int, x string")
    labels = C.fit_labels(df, ["n", "x", "absent"])
    assert list(labels) == ["x"]
    assert C.label_encode(spark.createDataFrame([(1, "q")], "n int, x string"), labels).first()["x_encoded"] is None


def test_contact_flags(spark):
    df = spark.createDataFrame([(3, "High", "21 - 30"), (None, None, "0")], "SegmentClass int, EngagementLabel string, AgeRange string")
    first, second = [r.asDict() for r in C.contact_flags(df).collect()]
    assert first["SegmentClass_3"] == 1 and first["engagement_label"] == 2 and first["age_range_21_30"] == 1
    assert second["engagement_label"] == -1 and sum(second[c] for c in vocab.AGE_BANDS) == 0


def test_targets(spark):
    df = spark.createDataFrame([("SAL 1", None), ("Client", 2.0), (None, 0.0), ("sal x", -1.0)], "LeadStageNewCEO string, they_topped_up double")
    got = C.topup_target(C.conversion_target(C.lead_target(df, out="lead")))
    assert [(r["lead"], r["Target"], r["target_flag"]) for r in got.collect()] == [(1, 0, 0), (0, 1, 1), (0, None, 0), (1, None, 0)]
    with pytest.raises(ValueError):
        C.conversion_target(df.drop("LeadStageNewCEO"))
