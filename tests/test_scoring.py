import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from leadloom.operators import evaluation as V
from leadloom.operators import ranking as K


def test_folds_are_balanced_and_do_not_depend_on_partitioning(spark):
    df = spark.range(503).selectExpr("id", "cast(id % 10 = 0 AS int) AS y")
    seen = []
    for n in (1, 4, 17):
        got = K.stratified_folds(df.repartition(n), "id", "y").collect()
        seen.append({r["id"]: r["fold"] for r in got})
        for y in (0, 1):
            sizes = [sum(r["y"] == y and r["fold"] == f for r in got) for f in range(5)]
            assert max(sizes) - min(sizes) <= 1
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 503


def test_folds_with_a_tiny_class_and_null_labels(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None)], "id int, y int")
    got = K.stratified_folds(df, "id", "y").collect()
    assert len(got) == 4 and {r["fold"] for r in got if r["y"] == 0} == {0, 1}


def test_holdout_share(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 4 = 0 AS int) AS y")
    got = K.holdout(df, "id", "y").groupBy("y").agg(F.count_if("is_test").alias("n")).collect()
    assert {r["y"]: r["n"] for r in got} == {0: 150, 1: 50}


def test_sample_is_the_same_whatever_the_partitioning(spark):
    df = spark.range(1000)
    a = {r["id"] for r in K.seeded_sample(df.repartition(3), "id", 100).collect()}
    b = {r["id"] for r in K.seeded_sample(df.repartition(11), "id", 100).collect()}
    assert a == b and len(a) == 100
    assert K.seeded_sample(df.limit(7), "id", 100).count() == 7


def test_rank_numbers_all_rows_in_order(spark):
    df = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(40)) / 10.0).alias("p")).repartition(7)
    got = sorted(K.with_rank(df, [F.desc("p"), F.asc("id")]).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, 3001))
    assert [(r["p"], r["id"]) for r in got] == sorted(((r["p"], r["id"]) for r in got), key=lambda x: (-x[0], x[1]))
    assert K.with_rank(df.filter("id < 0"), [F.desc("p")]).count() == 0


def test_action_list_threshold_order_and_stage(spark):
    df = spark.createDataFrame(
        [(1, 0.5, "SQL 1"), (2, 0.9, "sql 2"), (3, 0.4999, "SQL 1"), (4, 0.9, None), (5, 0.9, "SQL 1"), (6, 0.8, "SAL 1")],
        "id int, p double, s string",
    )
    assert [r["id"] for r in K.action_list(df, "p", "id", stage="s").collect()] == [2, 5, 1]
    assert [r["id"] for r in K.action_list(df, "p", "id").collect()] == [2, 4, 5, 6, 1]
    assert K.action_list(df.filter("p > 1"), "p", "id").count() == 0


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5001, 0.9, -3.0, 7e9])), min_size=1, max_size=60))
def test_auc_agrees_with_all_pairs(spark, pairs):
    df = spark.createDataFrame(pairs, "y int, s double")
    got = V.roc_auc(df, "y", "s").first()["auc"]
    want = brute_auc(pairs)
    assert got == want if want is None else abs(got - want) < 1e-12


def test_auc_special_cases_and_groups(spark):
    rng = random.Random(2)
    rows = [(g, rng.randrange(2), round(rng.random(), 2) if g else 0.3) for g in (0, 1, 2) for _ in range(400)]
    df = spark.createDataFrame(rows, "g int, y int, s double")
    got = {r["g"]: r["auc"] for r in V.roc_auc(df, "y", "s", by=["g"], slices=16).collect()}
    assert got[0] == 0.5
    for g in (1, 2):
        assert abs(got[g] - brute_auc([(y, s) for h, y, s in rows if h == g])) < 1e-12
    one = df.filter("g = 1").select(F.col("y").cast("double").alias("y"), "s")
    judge = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    assert abs(judge.evaluate(one) - got[1]) < 1e-9
    perfect = spark.createDataFrame([(0, 0.1), (1, 0.9)], "y int, s double")
    assert V.roc_auc(perfect, "y", "s").first()["auc"] == 1.0
    assert V.roc_auc(perfect.withColumn("r", -F.col("s")), "y", "r").first()["auc"] == 0.0


def test_report_with_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "y int, p int")
    got = {r["label"]: r for r in V.classification_report(df, "y", "p").collect()}
    assert got["1"]["precision"] == 0.0 and got["1"]["recall"] == 0.0 and got["1"]["support"] == 1
    assert got["accuracy"]["f1"] == 0.75
    assert abs(got["0"]["precision"] - 2 / 3) < 1e-12
    assert abs(got["macro avg"]["recall"] - 2 / 3) < 1e-12 and abs(got["weighted avg"]["recall"] - 0.75) < 1e-12


def test_binary_metrics_and_weights(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (0, 1)], "y int, p int")
    got = V.binary_metrics(df, "y", "p").first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"]) == (0.5, 0.5, 0.5, 0.5)
    assert V.class_weights(df.filter("y = 0"), "y").first()["pos_weight"] == 2.0
    none = V.binary_metrics(df.filter("y > 1"), "y", "p").first()
    assert (none["accuracy"], none["f1"]) == (0.0, 0.0)
