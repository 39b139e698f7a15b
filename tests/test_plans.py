from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import catalog.models as Q
from catalog import base as B
from leadloom.plans import conversion, jobs, lead, topup
from leadloom.plans.outputs import write_results
from leadloom.session import materialise, shared_dir
from leadloom.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wide(spark):
    """Ten times the customers of the smallest scale, so that every fold has both classes."""
    return "/root/testdata/sf0.01"


def test_lead_plan(spark, wide, tmp_path):
    features = materialise(Q._lead_features(spark, wide, segmented=False))
    found = lead.lead_scores(features, Q.AS_OF, "contact_id", Q.PLAN_SPACE, trials=1)
    n = features.count()
    assert found.predictions.count() == n == found.predictions.select("contact_id").distinct().count()
    listed = found.action_list.collect()
    assert [r["probability"] for r in listed] == sorted((r["probability"] for r in listed), reverse=True)
    meta = found.metadata.first()
    assert meta["train_samples"] + meta["test_samples"] == n and meta["high_prob_contacts"] == len(listed)
    assert found.fold_auc.count() == 5 and found.trials.count() == 1
    assert {r["label"] for r in found.evaluation.collect()} >= {"accuracy", "macro avg", "weighted avg"}
    names = {r["feature"] for r in found.importance.collect()}
    assert "Target" not in names and "contact_id" not in names and "Country_Other" in names
    assert names == {r["feature"] for r in found.shap_importance.collect()}

    target = {"format": "parquet", "path": str(tmp_path)}
    for _ in range(2):
        written = write_results(found, target, "lead")
    assert len(written) == 6
    assert read_table(spark, target, "lead_model_predictions").count() == n
    assert read_table(spark, target, "lead_model_metadata").count() == 2


def test_conversion_plan(spark, wide):
    features = materialise(Q._conversion_features(spark, wide, segmented=False))
    assert not [c for c in features.columns if c.startswith("__")]
    found = conversion.conversion_scores(features, Q.AS_OF, "contact_id", Q.PLAN_SPACE, trials=1)
    rows = found.predictions.collect()
    assert len(rows) == features.count()
    assert all((r["oof_probability"] is None) == (r["y_true"] is None) for r in rows)
    assert all(r["probability"] is not None for r in rows)
    assert all(r["oof_probability"] >= 0.5 for r in found.action_list.collect())
    assert found.confusion.agg(F.sum("n")).first()[0] == features.filter("Target IS NOT NULL").count()


def test_topup_plan(spark, wide):
    clients = Q._clients(spark, wide)
    features = materialise(topup.topup_features(clients, Q.AS_OF, restarts=1))
    params = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.2, "pos_weight": 0.95}
    found = topup.topup_scores(features, clients, "Explain.", params=params, trees=20)
    assert found.predictions.count() == clients.count()
    assert "RM_Name" in found.predictions.columns
    used = {r["feature"] for r in found.importance.collect()}
    assert not used & {"Top Up Frequency", "they_topped_up", "HubSpotId", "is_outlier"}
    counts = found.enrichment.first()
    assert counts["n_rows"] == found.action_list.count() and counts["n_empty"] == 0


def test_explanations_are_not_broadcast(spark, wide):
    clients = Q._clients(spark, wide)
    features = materialise(topup.topup_features(clients, Q.AS_OF, restarts=1))
    found = topup.topup_scores(features, clients, "Explain.", params={"maxIter": 1, "maxDepth": 2, "pos_weight": 0.95}, trees=5)
    joins = [x for x in found.action_list._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "HubSpotId" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    rows = found.action_list.select("HubSpotId", "rank", "explain").collect()
    assert rows and all(r["explain"] for r in rows) and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


def test_topup_rows_without_metadata_and_duplicate_metadata(spark):
    facts = topup.normalise_metadata(
        spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "`Client ID` int, RM_Name string"), "HubSpotId", ["RM_Name", "absent"]
    )
    left = spark.createDataFrame([(1,), (2,), (None,)], "HubSpotId int")
    got = topup.R.left_attach(left, facts, "HubSpotId")
    assert sorted((r["HubSpotId"], r["RM_Name"]) for r in got.collect() if r["HubSpotId"]) == [(1, "x"), (1, "y"), (2, None)]
    assert got.filter("HubSpotId IS NULL").first()["RM_Name"] is None


def test_plans_survive_empty_events(spark):
    met, called = Q._events(spark, SF, segmented=False)
    got = lead.lead_features(
        B.contacts(spark, SF), met.limit(0), called.limit(0), datetime(2001, 8, 2), Q.LEAD
    )
    row = got.first()
    assert row["ScheduledMeetings"] == 0 and row["CallAttempts"] == 0 and row["TopSegmentRepresentative"] is None


def test_jobs_leave_tables_and_no_stored_steps(spark, wide, tmp_path):
    source, target = ({"format": "parquet", "path": str(tmp_path / name)} for name in ("in", "out"))
    met, called = Q._events(spark, wide, segmented=True)
    for name, frame in {"people": B.contacts(spark, wide), "met": met, "called": called, "clients": Q._clients(spark, wide)}.items():
        frame.write.parquet(f"{source['path']}/{name}")
    steps = Path(shared_dir(spark).removeprefix("file:")) / "leadloom"
    before = set(steps.glob("run-*"))
    tables = {"contacts": "people", "meetings": "met", "calls": "called"}
    written = jobs.lead_job(spark, source, target, tables, Q.AS_OF, Q.LEAD, space=Q.PLAN_SPACE, trials=1)
    params = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.2, "pos_weight": 0.95}
    topped = jobs.topup_job(spark, source, target, {"clients": "clients"}, Q.AS_OF, "Explain.", restarts=1, params=params, trees=20)
    assert set(steps.glob("run-*")) == before
    features = read_table(spark, target, "lead_features")
    assert written[0] == "lead_features" and features.count() == read_table(spark, target, "lead_model_predictions").count() > 0
    listed = [r["rank"] for r in read_table(spark, target, "lead_rm_action_list").orderBy("rank").collect()]
    assert listed == list(range(1, len(listed) + 1))
    assert {"topup_features", "topup_model_predictions", "topup_rm_action_list"} <= set(topped)
    used = {r["feature"] for r in read_table(spark, target, "topup_feature_importance").collect()}
    assert used and not used & {"Top_Up_Frequency", "they_topped_up", "Client_ID"}


def test_lemmas_reach_the_clusters(spark):
    lemmas = spark.createDataFrame([("calls", "call"), ("calls", "call"), (None, "x")], "form string, lemma string")
    notes = spark.createDataFrame([(1, "Calls & calls"), (2, None), (3, ""), (4, "call")], "id int, note string")
    got = {r["id"]: r["clean"] for r in lead.N.clean_notes(notes, "note", "clean", lemmas).collect()}
    assert got == {1: "call call", 2: "", 3: "", 4: "call"}
    spec = lead.E.EngagementSpec(**{**lead.E.MEETINGS.__dict__, "note": "note"})

    def segments(notes, **options):
        rows = spark.createDataFrame(list(enumerate(notes)), "id int, note string")
        placed = lead.with_segments(rows, spec, "s", None, 1, min_df=1, max_df=1.0, min_notes=0, **options)
        return [r["s"] for r in placed.orderBy("id").collect()]

    notes = ["calls made", "call made", None] * 4
    assert segments(notes, lemmas=lemmas) == [0, 0, -1] * 4
    apart = segments(notes)
    assert sorted(set(apart)) == [-1, 0, 1] and apart == apart[:3] * 4
