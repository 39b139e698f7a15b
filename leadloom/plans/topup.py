"""Top-up scoring: which existing clients will commit more capital."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom import vocab
from leadloom.operators import encoding as C
from leadloom.operators import evaluation as V
from leadloom.operators import explain as P
from leadloom.operators import frames as R
from leadloom.operators import modelling as M
from leadloom.operators import notes as N
from leadloom.operators import outliers as O
from leadloom.operators import ranking as K
from leadloom.operators.clustering import segment_entities
from leadloom.operators.enrichment import enrich
from leadloom.session import training_table

SCORE = "TOPUP_PROBABILITY_THIS_MONTH"
ID_ALIASES = ("Client_ID", "Client ID")


def topup_features(clients: DataFrame, as_of: datetime, segments: int = 4, restarts: int = 10, seed: int = 42) -> DataFrame:
    """The training table: the listed client columns, k-means segments and the run stamp."""
    table = R.select_existing(clients, vocab.TOPUP_SOURCE_COLUMNS)
    numeric = R.feature_columns(table, [*vocab.CLUSTER_NON_FEATURES, *ID_ALIASES], "SegmentClass")
    return R.stamp_run(segment_entities(table, numeric, segments, seed, restarts), as_of)


@dataclass(frozen=True)
class TopupResult:
    predictions: DataFrame
    action_list: DataFrame
    importance: DataFrame
    evaluation: DataFrame
    train_auc: DataFrame
    enrichment: DataFrame
    model: object


def topup_scores(
    features: DataFrame,
    metadata: DataFrame,
    instruction: str,
    key: str = "HubSpotId",
    params: Mapping = M.TOPUP_PARAMS,
    threshold: float = 0.5,
    contamination: float = 0.05,
    trees: int = 100,
    seed: int = 42,
    model_path: str = "",
    metadata_columns: Sequence[str] = vocab.TOPUP_METADATA,
    early_stop: bool = True,
    pitch: Callable[[dict], str | None] | None = None,
    pitch_options: Mapping | None = None,
) -> TopupResult:
    """Fit on inliers, score every client, explain and phrase the action list.

    The action list carries the full explanation of each row and the request body for a text service. With
    ``pitch``, a function of a dict with ``key`` and ``pitch_request``, each explained row also gets its answer, or an empty
    text and the error (see ``operators.enrichment``); the run goes on either way.
    """
    spark = features.sparkSession
    data = C.topup_target(R.normalise_id(features, ID_ALIASES, key))
    barred = [key, *vocab.TOPUP_NON_FEATURES, *vocab.TOPUP_TARGET_DERIVED]
    numeric = R.feature_columns(data, barred, "target_flag")
    data = C.label_encode(data, C.fit_labels(data, vocab.TOPUP_CATEGORIES))
    encoded = [f"{c}_encoded" for c in vocab.TOPUP_CATEGORIES if f"{c}_encoded" in data.columns]
    names = [*numeric, *encoded]
    data = O.outlier_flags(data, key, names, contamination, trees, seed=seed)
    plan = M.fit_features(data, names)
    table = M.eval_slice(plan.apply(data).withColumn("label", F.col("target_flag")), key, seed=seed)
    table = training_table(table)

    train = table.filter(F.col("is_outlier") == 0)
    model = M.propensity_pipeline(eval_col="is_eval" if early_stop else None, seed=seed, **params).fit(train)
    scored = M.score(table, model, SCORE, "y_pred")
    inliers = scored.filter(F.col("is_outlier") == 0)
    facts = normalise_metadata(metadata, key, metadata_columns)
    predictions = R.left_attach(scored.select(key, SCORE), facts, key)

    actions = K.action_list(predictions, SCORE, key, facts.columns, threshold)
    # Contributions are computed for the listed rows only, where their features already are.
    explained = P.explain_json(
        P.contributions(R.above(scored, SCORE, threshold), model, len(plan.names)),
        plan.names,
        {f"{c}_encoded": c for c in vocab.TOPUP_CATEGORIES},
    ).select(key, "explain")
    # Spark takes a computed text for 20 bytes a row; explanations are far longer and must not be broadcast by that figure.
    actions = R.left_attach(actions, explained.hint("merge"), key, fill={"explain": ""})
    summary = F.col("`Client Summary`") if "Client Summary" in actions.columns else F.lit("")
    actions = N.prompt_payload(
        actions,
        instruction,
        {
            "Client Summary": summary,
            "AI Model Probability to Top-up": N.two_decimals(F.col(SCORE)),
            "Shap explanation": F.col("explain"),
        },
        out="pitch_request",
    )
    actions = actions.withColumn(
        "pitch_request", F.when(F.col("explain") == "", F.lit("")).otherwise(F.col("pitch_request"))
    )
    blanks = ["explain", "pitch_request"]
    if pitch is not None:
        asked = lambda row: pitch(row) if row["pitch_request"] else None
        actions, _ = enrich(actions, asked, [key, "pitch_request"], **{"out": "pitch", **(pitch_options or {})})
        blanks.append("pitch")
    actions = actions.orderBy("rank")
    if model_path:
        M.save_model(model, model_path)
    return TopupResult(
        predictions=predictions,
        action_list=actions,
        importance=M.importance_table(spark, model, plan.names),
        evaluation=V.classification_report(inliers, "label", "y_pred"),
        train_auc=V.roc_auc(inliers, "label", SCORE),
        enrichment=P.enrichment_errors(actions, blanks),
        model=model,
    )


def normalise_metadata(metadata: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return R.select_existing(R.normalise_id(metadata, ID_ALIASES, key), [key, *columns])
