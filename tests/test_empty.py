"""Operators on frames without rows."""

import pytest
from pyspark.sql import functions as F

from leadloom.operators import clustering as C
from leadloom.operators import encoding as D
from leadloom.operators import engagement as E
from leadloom.operators import evaluation as V
from leadloom.operators import frames as R
from leadloom.operators import notes as N
from leadloom.operators import outliers as O
from leadloom.operators import ranking as K
from leadloom.sources import tables as T

EVENTS = "k bigint, MeetingOutcome string, CreateDate timestamp_ntz, ActivityDate timestamp_ntz, MeetingNotesPreview string, seg int, y int, s double"
CASES = {
    "settle": lambda df: E.event_days(E.settle_dates(df), "2024-01-01"),
    "facts": lambda df: E.engagement_features(df, "k", E.MEETINGS, "2024-01-01", segment="seg"),
    "digest": lambda df: E.note_digest(df, "k", "MeetingNotesPreview", [F.desc("ActivityDate")]),
    "segment notes": lambda df: E.segment_notes(df, "k", "seg", "MeetingNotesPreview", [F.desc("ActivityDate")]),
    "top segment": lambda df: E.top_segment(df, "k", "seg"),
    "one-hot": lambda df: D.onehot(df, D.fit_onehot(df, ["MeetingOutcome"])),
    "top-k": lambda df: D.top_or_other(df, "MeetingOutcome"),
    "labels": lambda df: D.label_encode(df, D.fit_labels(df, ["MeetingOutcome"])),
    "codes": lambda df: D.sorted_codes(df, "MeetingOutcome"),
    "folds": lambda df: K.stratified_folds(df, "k", "y"),
    "hold-out": lambda df: K.holdout(df, "k", "y"),
    "sample": lambda df: K.seeded_sample(df, "k"),
    "actions": lambda df: K.action_list(df, "s", "k"),
    "auc per group": lambda df: V.roc_auc(df, "y", "s", by=["seg"]),
    "known": lambda df: R.keep_known(df, df, "k"),
    "known by shuffle": lambda df: R.keep_known(df, df, "k", broadcast_limit=-1),
    "unknown": lambda df: R.drop_known(df, df, "k"),
    "tf-idf": lambda df: N.tfidf_terms(df, "k", "MeetingNotesPreview", N.fit_terms(df, "MeetingNotesPreview")),
    "note segments": lambda df: C.segment_notes_by_text(df, "MeetingNotesPreview"),
    "segments": lambda df: C.segment_entities(df, ["s"]),
    "outliers": lambda df: O.outlier_flags(df, "k", ["s"]),
    "large ints": T.widen_large_ints,
}


@pytest.mark.parametrize("name", CASES)
def test_empty_input_gives_empty_output(spark, name):
    assert CASES[name](spark.createDataFrame([], EVENTS)).count() == 0


def test_single_row_summaries_of_nothing(spark):
    empty = spark.createDataFrame([], EVENTS)
    assert V.roc_auc(empty, "y", "s").first()["auc"] is None
    assert V.class_weights(empty, "y").first()["pos_weight"] == 0.0
    assert V.binary_metrics(empty, "y", "y").first()["n_rows"] == 0
    assert T.width_profile(empty).count() == len(empty.columns)
    assert O.exact_quantile(empty, "s", 0.5) is None
