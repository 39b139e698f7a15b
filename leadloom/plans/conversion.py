"""Conversion scoring: which accepted prospects will become clients."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom import vocab
from leadloom.functions import dates as D
from leadloom.functions import text as X
from leadloom.operators import encoding as C
from leadloom.operators import engagement as E
from leadloom.operators import evaluation as V
from leadloom.operators import explain as P
from leadloom.operators import frames as R
from leadloom.operators import modelling as M
from leadloom.operators import ranking as K
from leadloom.operators import target_stats as T
from leadloom.plans.contacts import clean_contacts, known_events, note_order, with_segments
from leadloom.session import materialise, training_table
from leadloom.sources.tables import run_metadata, widen_large_ints


@dataclass(frozen=True)
class ConversionConfig:
    """Names and values that belong to one installation."""

    contact_types: Sequence[str]
    client_type: str
    site: str
    site_label: str
    excluded_ids: Sequence[int] = ()
    extra_ids: Sequence[int] = ()
    nationality: str = "saudi arabia"
    key: str = "HubSpotId"
    event_key: str = "AssociatedContactId"
    embedding: str | None = "NoteEmbedding"
    seed: int = 42
    min_df: int = 5
    min_notes: int = 0  # notes are clustered if there are more; the established rule asks for more than 10
    lemmas: DataFrame | None = None  # (form, lemma)

    @property
    def note_options(self) -> dict:
        return {"min_df": self.min_df, "min_notes": self.min_notes, "lemmas": self.lemmas}


def _branch(events: DataFrame, spec: E.EngagementSpec, segment: str, as_of, cfg: ConversionConfig) -> DataFrame:
    """Engagement facts and segment notes of one event table, both grouped by contact."""
    events = with_segments(events, spec, segment, cfg.embedding, cfg.seed, **cfg.note_options)
    facts = E.engagement_features(events, cfg.key, spec, as_of, segment=segment)
    notes = E.segment_notes(
        events, cfg.key, segment, spec.note, note_order(spec.note), stem=spec.label_stem, descriptions=spec.descriptions
    )
    return R.left_attach(facts, notes, cfg.key)


def conversion_features(
    contacts: DataFrame, meetings: DataFrame, calls: DataFrame, as_of: datetime | str, cfg: ConversionConfig
) -> DataFrame:
    """The training table: one row per committed client or accepted prospect of one nationality."""
    base = R.conversion_filter(
        contacts, cfg.contact_types, cfg.client_type, cfg.excluded_ids, cfg.extra_ids, key=cfg.key
    )
    base = R.drop_existing(widen_large_ints(base), vocab.PREPARATION_DROPS)
    base = clean_contacts(base, cfg.site, cfg.site_label).filter(F.col("Nationality") == cfg.nationality)
    # Stored once: a fit, two semi joins and the final join read the cleaned contacts.
    base = C.top_or_other(materialise(base), "FirstPageSeen", 5)
    base = R.not_equal_keep_null(base, "LeadStageNewCEO", "Lead")
    base = base.withColumn("LeadStageNew", X.value_map("LeadStageNew", vocab.STAGE_ORDINAL, keep=False))

    embedding = [cfg.embedding] if cfg.embedding else []

    def branch(events: DataFrame, spec: E.EngagementSpec, segment: str, settle: bool) -> DataFrame:
        mine = known_events(events, base, cfg.key, cfg.event_key, spec, [segment, *embedding])
        return _branch(E.settle_dates(mine) if settle else mine, spec, segment, as_of, cfg)

    met = branch(meetings, E.MEETINGS, "NoteSegment", settle=True)
    called = branch(calls, E.CALLS, "CallNoteSegment", settle=False)
    wide = R.left_attach(R.left_attach(base, met, cfg.key), called, cfg.key)
    # Dates first: a missing date means "never", not day zero.
    wide = R.days_since(wide, vocab.DAYS_SINCE_COLUMNS, as_of)
    wide = C.conversion_target(wide)
    wide = R.fill_by_type(wide, [c for c in wide.columns if c not in ("Target", cfg.key)])
    return R.drop_duplicate_columns(wide)


@dataclass(frozen=True)
class ConversionResult:
    predictions: DataFrame
    action_list: DataFrame
    importance: DataFrame
    shap_importance: DataFrame
    evaluation: DataFrame
    confusion: DataFrame
    fold_auc: DataFrame
    metadata: DataFrame
    trials: DataFrame
    model: object


def conversion_scores(
    features: DataFrame,
    as_of: datetime,
    key: str = "HubSpotId",
    space: Mapping = M.SEARCH_SPACE,
    trials: int = 50,
    threshold: float = 0.5,
    seed: int = 42,
    parallelism: int | None = None,
    model_path: str = "",
    action_score: str = "oof_probability",
    open_only: bool = False,
    max_values: int | None = None,
    explain_rows: int | None = None,
    max_categories: int = 1000,
) -> ConversionResult:
    """Search, out-of-fold scores and evaluation, production model, importances, action list.

    Rows without a target are not trained on but do get a production score. The action list
    uses the out-of-fold score unless ``action_score`` says ``probability``; ``open_only``
    leaves out rows that are clients already. Categories enter with all their values, or with the
    ``max_values`` most frequent; those with more than ``max_categories`` values (or a third of the labelled rows) enter as ordered target statistics
    (of the labelled rows, over all folds). ``explain_rows`` limits the contribution summary to a seeded sample.
    """
    spark = features.sparkSession
    barred = [key, *vocab.CONVERSION_NON_FEATURES]
    numeric = R.feature_columns(features, barred, "Target")
    texts = R.feature_columns(features, barred, "Target", kind="text")
    # a tree has no more bins than rows to learn from
    learnt = features.filter(F.col("Target").isNotNull()).count()
    wide = [] if max_values else T.wide_columns(features, texts, min(max_categories, learnt // 3))
    features = T.with_target_statistics(features, key, wide, "Target", seed=seed)
    numeric, texts = [*numeric, *[f"{c}_target" for c in wide]], [c for c in texts if c not in wide]
    plan = M.fit_features(features, numeric, texts, max_values)
    table = plan.apply(features).select(key, F.col("Target").cast("int").alias("label"), "features")
    table = training_table(M.eval_slice(K.stratified_folds(table, key, "label", 5, seed), key, seed=seed))
    labelled = table.filter(F.col("label").isNotNull())

    bins = {"maxBins": plan.bins}
    if "maxBins" in space:  # every value keeps a bin of its own
        low, high, scale = space["maxBins"]
        space = {**space, "maxBins": (max(low, plan.bins), max(high, plan.bins), scale)}
    found = M.search(labelled, space, trials, "fold", 5, seed, parallelism, eval_col="is_eval", fixed=bins)
    oof, models = M.oof_scores(
        labelled,
        lambda: M.propensity_pipeline(eval_col="is_eval", seed=seed, **{**bins, **found.best_params}),
        "fold",
        5,
        parallelism,
    )
    oof = materialise(oof.select(key, "fold", "label", "oof_prediction", "oof_probability"))
    final = M.propensity_pipeline(seed=seed, **{**bins, **found.best_params}).fit(labelled)
    scored = M.score(table, final).select(key, F.col("label").alias("y_true"), "y_pred", "probability")
    predictions = scored.join(oof.select(key, "oof_prediction", "oof_probability"), key, "left").withColumn(
        "prediction_date", D.moment(as_of)
    )
    candidates = predictions.filter(F.coalesce(F.col("y_true"), F.lit(0)) == 0) if open_only else predictions
    actions = K.action_list(candidates, action_score, key, ["probability", "oof_probability"], threshold)

    explained = table if explain_rows is None else K.seeded_sample(table, key, explain_rows, seed)
    shares = P.contribution_rows(P.contributions(explained, models[0], len(plan.names)), key, plan.names)
    overall = V.roc_auc(oof, "label", "oof_probability").first()
    marks = V.binary_metrics(oof, "label", "oof_prediction").first()
    metadata = run_metadata(
        spark,
        as_of,
        model_filename=model_path,
        n_samples=marks["n_rows"],
        n_features=len(plan.names),
        oof_roc_auc=overall["auc"] if overall else None,
        oof_accuracy=marks["accuracy"],
        oof_f1_score=marks["f1"],
        best_search_score=found.best_score,
        n_trials=trials,
        probability_threshold=threshold,
        high_prob_contacts=actions.count(),
        best_params=found.best_params,
    )
    if model_path:
        M.save_model(final, model_path)
    return ConversionResult(
        predictions=predictions,
        action_list=actions,
        importance=M.fold_importance(spark, models, plan.names),
        shap_importance=P.mean_abs_contribution(shares),
        evaluation=V.classification_report(oof, "label", "oof_prediction"),
        confusion=V.confusion(oof, "label", "oof_prediction"),
        fold_auc=V.roc_auc(oof, "label", "oof_probability", by=["fold"]),
        metadata=metadata,
        trials=found.trials,
        model=final,
    )
