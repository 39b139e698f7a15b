"""Classifier evaluation as DataFrame jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.operators.frames import quoted


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows of both classes and the weight that would balance the positive one."""
    y = F.col(quoted(label))
    counted = df.agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))
    return counted.withColumn("pos_weight", F.col("n0") / F.greatest(F.col("n1"), F.lit(1)).cast("double"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(
        F.col(quoted(label)).cast("int").alias("y_true"), F.col(quoted(pred)).cast("int").alias("y_pred")
    ).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted means.

    The input is read once, into the confusion counts; a zero denominator scores 0.
    """
    cell = F.array(
        F.struct(
            F.col("y_true").alias("cls"),
            F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0)).alias("tp"),
            F.col("n").alias("actual"),
            F.lit(0).cast("bigint").alias("predicted"),
        ),
        F.struct(
            F.col("y_pred").alias("cls"),
            F.lit(0).cast("bigint").alias("tp"),
            F.lit(0).cast("bigint").alias("actual"),
            F.col("n").alias("predicted"),
        ),
    )
    per_class = (
        confusion(df, label, pred)
        .select(F.explode(cell).alias("c"))
        .groupBy("c.cls")
        .agg(F.sum("c.tp").alias("tp"), F.sum("c.actual").alias("support"), F.sum("c.predicted").alias("predicted"))
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    scored = per_class.select(
        "cls",
        "tp",
        "support",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
    ).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    metrics = ("precision", "recall", "f1")
    both = scored.rollup("cls").agg(
        F.grouping("cls").alias("is_total"),
        F.sum("support").alias("support"),
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(m) for m in metrics],
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"w_{m}") for m in metrics],
    )

    def line(name, values):
        return F.struct(name.alias("label"), *[v.alias(m) for m, v in zip(metrics, values)], F.col("support"))

    total = F.array(
        line(F.lit("accuracy"), [F.col("accuracy")] * 3),
        line(F.lit("macro avg"), [F.col(m) for m in metrics]),
        line(F.lit("weighted avg"), [F.col(f"w_{m}") for m in metrics]),
    )
    single = F.array(line(F.col("cls").cast("string"), [F.col(m) for m in metrics]))
    return both.select(F.explode(F.when(F.col("is_total") == 1, total).otherwise(single)).alias("r")).select("r.*")


def binary_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: accuracy, precision, recall and F1 of the positive class."""
    y, p = F.col(quoted(label)) == 1, F.col(quoted(pred)) == 1
    counts = df.agg(
        F.count("*").alias("n"),
        F.count_if(y & p).alias("tp"),
        F.count_if(p).alias("pp"),
        F.count_if(y).alias("ap"),
        F.count_if(y == p).alias("hit"),
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    base = counts.select(
        F.col("n").alias("n_rows"),
        ratio("hit", "n").alias("accuracy"),
        ratio("tp", "pp").alias("precision"),
        ratio("tp", "ap").alias("recall"),
        (2 * F.col("tp")).alias("__a"),
        (F.col("pp") + F.col("ap")).alias("__b"),
    )
    return base.withColumn("f1", ratio("__a", "__b")).drop("__a", "__b")


def _slices(df: DataFrame) -> int:
    """Score ranges for a session: a few per shuffle partition, 64 at least."""
    return min(max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 8192)


def roc_auc(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve (ties count one half), overall or per group.

    Rows collapse to distinct scores first. The running count of negatives is then taken in
    ``slices`` score ranges in parallel and completed by the totals of the lower ranges, so no
    task sorts more than its range. The result is null when a class is absent.
    """
    s = F.col(quoted(score)).cast("double")
    flat = df.select(*by, s.alias("__s"), F.col(quoted(label)).cast("int").alias("__y")).filter(
        F.col("__s").isNotNull() & ~F.isnan("__s") & F.col("__y").isNotNull()
    )
    slices = slices or _slices(df)
    steps = [i / slices for i in range(1, slices)]
    cuts = sorted(set(flat.approxQuantile("__s", steps, 1 / (4 * slices)))) or [0.0]
    grouped = flat.groupBy(*by, "__s").agg(
        F.count_if(F.col("__y") == 1).alias("__p"), F.count_if(F.col("__y") != 1).alias("__n")
    )
    splits = [float("-inf"), *cuts, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="__s", outputCol="__r").transform(grouped)
    here = Window.partitionBy(*by, "__r").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("__n").over(here), F.lit(0))
    wins = F.col("__p") * (below + F.col("__n") / 2.0)
    per_range = ranged.withColumn("__w", wins).groupBy(*by, "__r").agg(
        F.sum("__w").alias("__w"), F.sum("__p").alias("__p"), F.sum("__n").alias("__n")
    )
    # One row per range from here on.
    lower = Window.partitionBy(*by).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    total = per_range.withColumn("__w", F.col("__w") + F.col("__p") * F.coalesce(F.sum("__n").over(lower), F.lit(0)))
    out = total.groupBy(*by).agg(
        F.sum("__w").alias("__w"), F.sum("__p").alias("n_pos"), F.sum("__n").alias("n_neg")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return out.select(*by, "n_pos", "n_neg", F.try_divide("__w", pairs).alias("auc"))


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """Mean, minimum and maximum of the scores and how many reach one half."""
    s = F.col(quoted(score)).cast("double")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.avg(s).alias("mean_score"),
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
        F.count_if(s >= F.lit(0.5)).alias("n_high"),
    )
