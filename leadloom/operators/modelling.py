"""Propensity models on ``pyspark.ml``: features, search, out-of-fold scores, importances."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.boosting import Boosting, best_trees
from leadloom.operators.encoding import fit_top_values
from leadloom.operators.frames import quoted
from leadloom.operators.search import BATCH, STARTUP, Trial, best_of, optimise
from leadloom.session import fits_at_once

# --- fixed values: search ranges (low, high, scale) -----------------------------------
SEARCH_SPACE = {
    "maxIter": (100, 1000, "int"),
    "stepSize": (0.01, 0.3, "log"),
    "maxDepth": (4, 10, "int"),
    "minInstancesPerNode": (1, 10, "int"),
    "maxBins": (32, 255, "int"),
    "minInfoGain": (1e-9, 1e-2, "log"),
    "subsamplingRate": (0.5, 1.0, "linear"),
    "pos_weight": (1.0, 10.0, "linear"),
}
# --- fixed values: the unsearched parameter set of the existing-client model ----------
TOPUP_PARAMS = {
    "maxIter": 5000,
    "stepSize": 0.001,
    "maxDepth": 16,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "pos_weight": 0.95,
}


# --- fixed values: trees without a lower held-out loss before a fit ends ---------------
PATIENCE = 100
SEARCH_PATIENCE = 50

#: Values of a category that may become bins of a tree.
MAX_CATEGORIES = 5000


@dataclass(frozen=True)
class FeaturePlan:
    """Which columns make up the feature vector, and the values each category may take."""

    numeric: tuple[str, ...]
    categories: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categories]

    @property
    def bins(self) -> int:
        """Bins a tree needs to give every value of every category its own, at least Spark's default."""
        return max(32, *(len(v) + 1 for v in self.categories.values())) if self.categories else 32

    def apply(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Add the feature vector: numbers with null as 0, then indexed categories.

        Values outside the vocabulary share one index, so the cardinality a model sees is fixed.
        """
        numbers = {f"__n{i}": F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for i, c in enumerate(self.numeric)}
        texts = {
            f"__t{i}": F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for i, c in enumerate(self.categories)
        }
        wide = df.withColumns({**numbers, **texts})
        codes = [f"__i{i}" for i in range(len(texts))]
        for text, code, values in zip(texts, codes, self.categories.values()):
            indexer = StringIndexerModel.from_labels(list(values), text, outputCol=code, handleInvalid="keep")
            wide = indexer.transform(wide)
        assembler = VectorAssembler(inputCols=[*numbers, *codes], outputCol=out)
        return assembler.transform(wide).drop(*numbers, *texts, *codes)


def fit_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), max_values: int | None = None) -> FeaturePlan:
    """Learn the values of every categorical column in one pass: all, or the ``max_values`` most frequent.

    Every value is a bin of every tree, so a column of more than ``MAX_CATEGORIES`` values is an error unless
    ``max_values`` is given: turn it into a number first (``target_stats.target_statistics``).
    """
    filled = df.select(*[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")).alias(c) for c in categorical])
    top = fit_top_values(filled, list(categorical), max_values or MAX_CATEGORIES + 1) if categorical else {}
    wide = [] if max_values else [c for c, v in top.items() if len(v) > MAX_CATEGORIES]
    if wide:
        raise ValueError(f"more than {MAX_CATEGORIES} values in {wide}; use target statistics")
    return FeaturePlan(tuple(numeric), {c: tuple(sorted(v)) for c, v in top.items()})


def weight_statement(pos_weight: float) -> str:
    return f"SELECT *, CASE WHEN label = 1 THEN {float(pos_weight)}D ELSE 1D END AS weight FROM __THIS__"


def propensity_pipeline(
    pos_weight: float = 1.0, eval_col: str | None = None, seed: int = 42, patience: int = PATIENCE, **params
) -> Pipeline | PatientFit:
    """Class weighting and boosted trees on the columns ``features`` and ``label``.

    With ``eval_col`` (boolean) training stops early on those rows (see ``PatientFit``).
    """
    if eval_col:
        return PatientFit(pos_weight, eval_col, seed, patience, params)
    deep = params.get("maxDepth", 5) > 10  # only there does caching node ids pay for its jobs
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", seed=seed, cacheNodeIds=deep, **params
    )
    return Pipeline(stages=[SQLTransformer(statement=weight_statement(pos_weight)), trees])


@dataclass(frozen=True)
class PatientFit:
    """Boosted trees up to the one with the lowest loss on the rows of ``eval_col``.

    Growing ends ``patience`` trees after the best one, or at ``maxIter``; each tree is grown once (see
    ``Boosting``). Without rows to hold out all ``maxIter`` trees stay.
    """

    pos_weight: float
    eval_col: str
    seed: int
    patience: int
    params: Mapping

    def fit(self, df: DataFrame) -> PipelineModel:
        most = self.params.get("maxIter", 20)
        if most <= self.patience:  # patience can't run out: one fit of Spark's own, and its first trees
            held = df.filter(F.col(self.eval_col))
            model = propensity_pipeline(self.pos_weight, seed=self.seed, **self.params).fit(df.filter(~F.coalesce(F.col(self.eval_col), F.lit(False))))
            return model if held.isEmpty() else first_trees(model, best_trees(held_out_losses(model, held), self.patience)[0])
        weigh = SQLTransformer(statement=weight_statement(self.pos_weight))
        grown = Boosting.begin(weigh.transform(df), self.params, F.col(self.eval_col), self.seed)
        kept = grown.grow_until(most, self.patience)
        return PipelineModel([weigh, grown.model(kept)])


def held_out_losses(model: PipelineModel, held: DataFrame) -> list[float]:
    """Loss on the given rows after each tree; one job."""
    return held_out_losses_of(trees_of(model), model.stages[0].transform(held))


def held_out_losses_of(trees: GBTClassificationModel, weighed: DataFrame) -> list[float]:
    return trees.evaluateEachIteration(weighed)


def first_trees(model: PipelineModel, n: int) -> PipelineModel:
    """The model of the first ``n`` trees."""
    trees = trees_of(model)
    gateway = SparkSession.active().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    every, shares = trees._java_obj.trees(), trees.treeWeights
    some, weights = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n), gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        some[i], weights[i] = every[i], shares[i]
    cut = GBTClassificationModel(ml.classification.GBTClassificationModel(trees.uid, some, weights))
    return PipelineModel([*model.stages[:-1], trees._copyValues(cut)])


def eval_slice(df: DataFrame, id_col: str, fraction: float = 0.1, seed: int = 42, out: str = "is_eval") -> DataFrame:
    """Mark a hash-drawn share of rows for early stopping."""
    share = F.pmod(F.xxhash64(quoted(id_col), F.lit(seed)), F.lit(1_000_000)) < F.lit(int(fraction * 1_000_000))
    return df.withColumn(out, share)


@dataclass(frozen=True)
class SearchResult:
    best_params: dict
    best_score: float
    trials: DataFrame


def search(
    df: DataFrame,
    space: Mapping[str, tuple] = SEARCH_SPACE,
    trials: int = 50,
    fold: str = "fold",
    k: int = 5,
    seed: int = 42,
    parallelism: int | None = None,
    eval_col: str | None = None,
    fixed: Mapping | None = None,
    patience: int = SEARCH_PATIENCE,
    batch: int = BATCH,
    halving: bool = True,
    startup: int = STARTUP,
) -> SearchResult:
    """Adaptive search by mean area under the ROC curve over the given folds (see ``operators.search``).

    Pass a stored table (``training_table``): every fit reads it. ``fixed`` holds parameters that all
    trials share. A fold is a rung: the fits of a batch on one fold share a pool, and trials that fall
    behind end before the next. Nothing is fitted beyond them.
    """
    spark = df.sparkSession
    judge = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0)
    pool = ThreadPool(parallelism or fits_at_once(df))

    @inheritable_thread_target(spark)
    def auc(job: tuple[dict, int]) -> float:
        params, f = job
        model = propensity_pipeline(eval_col=eval_col, seed=seed, patience=patience, **{**(fixed or {}), **params}).fit(df.filter(F.col(fold) != f))
        return judge.evaluate(model.transform(df.filter(F.col(fold) == f)))

    try:
        done = optimise(lambda jobs: pool.map(auc, jobs, chunksize=1), space, trials, k, seed, batch, halving, startup)
    finally:
        pool.close()
    best = best_of(done)
    return SearchResult(best.params, best.value, trials_table(spark, done))


def trials_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    """One row per trial: number, mean and spread over the folds it reached, their number, parameters and state."""
    names = list(trials[0].params)
    rows = [(t.number, t.value, float(np.std(t.scores)), len(t.scores), *[float(t.params[n]) for n in names], t.state) for t in trials]
    columns = ", ".join(f"params_{n} double" for n in names)
    return spark.createDataFrame(rows, f"number int, value double, std double, folds int, {columns}, state string")


def score(df: DataFrame, model: PipelineModel, probability: str = "probability", pred: str = "y_pred") -> DataFrame:
    """Add the probability of class 1 and the hard label at one half."""
    scored = model.transform(df.withColumn("label", F.lit(0)) if "label" not in df.columns else df)
    p = vector_to_array("probability")[1]
    out = scored.withColumns({"__p": p, "__y": F.col("prediction").cast("int")}).drop(
        "rawPrediction", "probability", "prediction", "weight"
    )
    return out.withColumnsRenamed({"__p": probability, "__y": pred})


def oof_scores(
    df: DataFrame,
    make: Callable[[], Pipeline | PatientFit],
    fold: str = "fold",
    k: int = 5,
    parallelism: int | None = None,
    probability: str = "oof_probability",
    pred: str = "oof_prediction",
) -> tuple[DataFrame, list[PipelineModel]]:
    """Score every row by the one model that was not trained on its fold.

    The fits run side by side from a thread pool. ``df`` is read once per fold, so pass a
    stored table.
    """
    pool = ThreadPool(min(parallelism or fits_at_once(df), k))
    spark = df.sparkSession

    @inheritable_thread_target(spark)
    def fit(f: int) -> PipelineModel:
        return make().fit(df.filter(F.col(fold) != f))

    try:
        models = pool.map(fit, range(k))
    finally:
        pool.close()
    parts = [score(df.filter(F.col(fold) == f), m, probability, pred) for f, m in enumerate(models)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole, models


def trees_of(model) -> GBTClassificationModel:
    """The boosted trees inside a pipeline model (or the model itself)."""
    if isinstance(model, PipelineModel):
        return next(s for s in reversed(model.stages) if isinstance(s, GBTClassificationModel))
    return model


def _importances(model, names: Sequence[str]) -> list[float]:
    """Importance by feature; a model cut short ends at the last feature it uses."""
    values = trees_of(model).featureImportances.toArray().tolist()
    return values + [0.0] * (len(names) - len(values))


def importance_table(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    values = _importances(model, names)
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def fold_importance(spark: SparkSession, models: Sequence, names: Sequence[str]) -> DataFrame:
    """Importance per feature, averaged over the fold models."""
    rows = [
        (n, float(v), f + 1) for f, m in enumerate(models) for n, v in zip(names, _importances(m, names))
    ]
    per_fold = spark.createDataFrame(rows, "feature string, importance double, fold int")
    return per_fold.groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
