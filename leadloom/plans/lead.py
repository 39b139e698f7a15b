"""Lead scoring: which qualified leads will be accepted by sales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
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
from leadloom.operators import notes as N
from leadloom.operators import ranking as K
from leadloom.plans.contacts import clean_contacts, known_events, note_order, with_segments
from leadloom.session import materialise, training_table
from leadloom.sources.tables import run_metadata


@dataclass(frozen=True)
class LeadConfig:
    """Names and values that belong to one installation."""

    contact_types: Sequence[str]
    site: str
    site_label: str
    key: str = "HubSpotId"
    event_key: str = "AssociatedContactId"
    missing_groups: Mapping[str, Sequence[str]] = field(default_factory=lambda: vocab.MISSING_GROUPS)
    missing_threshold: float = 0.8
    embedding: str | None = "NoteEmbedding"
    seed: int = 42
    min_df: int = 5
    min_notes: int = 0  # notes are clustered if there are more; the established rule asks for more than 10
    lemmas: DataFrame | None = None  # (form, lemma)

    @property
    def note_options(self) -> dict:
        return {"min_df": self.min_df, "min_notes": self.min_notes, "lemmas": self.lemmas}


def encode_contacts(contacts: DataFrame, as_of: datetime | str, cfg: LeadConfig) -> DataFrame:
    """All contact-level features. Vocabularies are learned in two passes over the stored,
    cleaned contacts."""
    df = materialise(clean_contacts(contacts, cfg.site, cfg.site_label))
    df = df.withColumns(
        {f"Nationality_{n}": X.contains_flag("Nationality", n) for n in vocab.NATIONALITY_FLAGS}
        if "Nationality" in df.columns
        else {}
    )
    df = C.onehot(df, C.fit_onehot(df, vocab.ONE_HOT_COLUMNS))
    top = C.fit_top_values(df, ["Country", "FirstPageSeen"], 5)
    for col, values in top.items():
        df = C.onehot(C.top_or_other(df, col, values=values), {col: [*values, "Other"]})
    df = C.contact_flags(df)
    if "CreateDate" in df.columns:
        df = R.date_bins(df, "CreateDate", as_of)
        df = C.onehot(df, {"CreateDate_Bins": vocab.DATE_BIN_LABELS}, {"CreateDate_Bins": "Created"})
    return C.lead_target(df)


def meeting_features(meetings: DataFrame, as_of: datetime | str, cfg: LeadConfig) -> DataFrame:
    events = E.settle_dates(meetings)
    events = with_segments(events, E.MEETINGS, "NoteSegment", cfg.embedding, cfg.seed, **cfg.note_options)
    facts = E.engagement_features(events, cfg.key, E.MEETINGS, as_of, segment="NoteSegment")
    wanted = ["ScheduledMeetings", "CompletedMeetings", "SegmentCount_0", "SegmentCount_1", "SegmentCount_2"]
    digest = E.note_digest(
        events, cfg.key, E.MEETINGS.note, note_order(E.MEETINGS.note), 5, "\n\n", "TopSegmentRepresentative"
    )
    return R.left_attach(facts.select(cfg.key, *wanted), digest, cfg.key)


def call_features(calls: DataFrame, as_of: datetime | str, cfg: LeadConfig) -> DataFrame:
    events = calls.withColumn("ActivityDate", F.to_date("ActivityDate").cast("timestamp_ntz"))
    # Stored, so that the cleaning runs once and not again in the filter of the digest.
    cleaned = materialise(N.clean_notes(events, E.CALLS.note, E.CALLS.note, cfg.lemmas))
    facts = E.engagement_features(cleaned, cfg.key, E.CALLS, as_of)
    digest = E.note_digest(
        cleaned, cfg.key, E.CALLS.note, note_order(E.CALLS.note), 5, "\n\n", "TopSegmentRepresentativeCalls"
    )
    return R.left_attach(facts.select(cfg.key, "CallAttempts", "ConnectedCalls"), digest, cfg.key)


def lead_features(
    contacts: DataFrame, meetings: DataFrame, calls: DataFrame, as_of: datetime | str, cfg: LeadConfig
) -> DataFrame:
    """The training table: one row per qualified lead with enough known about it."""
    leads = encode_contacts(R.lead_filter(contacts, cfg.contact_types), as_of, cfg)
    leads = R.drop_existing(leads, [*vocab.PREPARATION_DROPS, *vocab.FINAL_DROPS])
    leads = R.not_equal_keep_null(leads, "LeadStageNewCEO", "Lead")
    extra = ["NoteSegment", *([cfg.embedding] if cfg.embedding else [])]
    met = known_events(meetings, leads, cfg.key, cfg.event_key, E.MEETINGS, extra)
    met = meeting_features(met, as_of, cfg)
    called = known_events(calls, leads, cfg.key, cfg.event_key, E.CALLS)
    called = call_features(called, as_of, cfg)
    zero = {c: 0 for c in (*met.columns, *called.columns) if c != cfg.key and not c.startswith("TopSegment")}
    wide = R.left_attach(R.left_attach(leads, met, cfg.key), called, cfg.key)
    wide = R.fill_defaults(wide, zero)
    wide = R.drop_high_missing(wide, cfg.missing_groups, cfg.missing_threshold)
    return R.drop_duplicate_columns(R.stamp_run(wide, as_of))


@dataclass(frozen=True)
class LeadResult:
    predictions: DataFrame
    action_list: DataFrame
    importance: DataFrame
    shap_importance: DataFrame
    evaluation: DataFrame
    train_evaluation: DataFrame
    fold_auc: DataFrame
    metadata: DataFrame
    trials: DataFrame
    model: object


def lead_scores(
    features: DataFrame,
    as_of: datetime,
    key: str = "HubSpotId",
    space: Mapping = M.SEARCH_SPACE,
    trials: int = 50,
    threshold: float = 0.5,
    seed: int = 42,
    parallelism: int | None = None,
    model_path: str = "",
    explain_rows: int | None = None,
    keep: Sequence[str] = ("CreateDate", "ContactType", "ContactOwnerId", "LeadStageNewCEO"),
) -> LeadResult:
    """Search, hold-out evaluation, out-of-fold scores, importances, contributions, action list.

    ``explain_rows`` limits the contribution summary to a seeded sample; by default it takes all rows.
    """
    spark = features.sparkSession
    safe = R.sanitize_column_names(features)
    numeric = R.feature_columns(safe, [key, *vocab.LEAD_NON_FEATURES], "Target")
    plan = M.fit_features(safe, numeric)
    table = plan.apply(safe).withColumn("label", F.col("Target").cast("int"))
    table = R.select_existing(table, list(dict.fromkeys([key, *keep, "label", "features"])))
    table = K.holdout(K.stratified_folds(table, key, "label", 5, seed), key, "label", 0.2, seed)
    table = training_table(M.eval_slice(table, key, seed=seed))

    train = table.filter(~F.col("is_test"))
    found = M.search(train, space, trials, "fold", 5, seed, parallelism, eval_col="is_eval")
    final = M.propensity_pipeline(eval_col="is_test", seed=seed, **found.best_params).fit(table)
    scored = M.score(table, final)
    split = F.when(F.col("is_test"), "test").otherwise("train")
    judged = scored.withColumn("split", split)
    auc = V.roc_auc(judged, "label", "probability", by=["split"])

    oof, models = M.oof_scores(
        table,
        lambda: M.propensity_pipeline(eval_col="is_eval", seed=seed, **found.best_params),
        "fold",
        5,
        parallelism,
        "probability",
        "y_pred",
    )
    oof = materialise(oof.drop("features"))
    stamped = oof.withColumnRenamed("label", "y_true").withColumn("prediction_date", D.moment(as_of))
    actions = K.action_list(stamped, "probability", key, keep, threshold, stage="LeadStageNewCEO")

    explained = table if explain_rows is None else K.seeded_sample(table, key, explain_rows, seed)
    shares = P.contribution_rows(P.contributions(explained, models[0], len(plan.names)), key, plan.names)
    by_split = {r["split"]: r for r in auc.collect()}
    sizes = {s: r["n_pos"] + r["n_neg"] for s, r in by_split.items()}
    none = {"auc": None}
    metadata = run_metadata(
        spark,
        as_of,
        model_filename=model_path,
        train_samples=sizes.get("train", 0),
        test_samples=sizes.get("test", 0),
        n_features=len(plan.names),
        train_roc_auc=by_split.get("train", none)["auc"],
        test_roc_auc=by_split.get("test", none)["auc"],
        best_search_score=found.best_score,
        n_trials=trials,
        probability_threshold=threshold,
        high_prob_contacts=actions.count(),
        best_params=found.best_params,
    )
    if model_path:
        M.save_model(final, model_path)
    return LeadResult(
        predictions=stamped.select(key, "y_true", "y_pred", "probability", "prediction_date"),
        action_list=actions.drop("LeadStageNewCEO"),
        importance=M.importance_table(spark, final, plan.names),
        shap_importance=P.mean_abs_contribution(shares),
        evaluation=V.classification_report(judged.filter("is_test"), "label", "y_pred"),
        train_evaluation=V.classification_report(judged.filter("NOT is_test"), "label", "y_pred"),
        fold_auc=V.roc_auc(oof, "label", "probability", by=["fold"]),
        metadata=metadata,
        trials=found.trials,
        model=final,
    )
