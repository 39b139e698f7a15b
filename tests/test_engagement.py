import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from leadloom.operators import engagement as E

AS_OF = datetime(2024, 6, 1)
SCHEMA = "k bigint, MeetingOutcome string, CreateDate timestamp_ntz, ActivityDate timestamp_ntz, MeetingNotesPreview string, seg int"


def facts(spark, data, **options):
    df = spark.createDataFrame(data, SCHEMA)
    out = E.engagement_features(df, "k", E.MEETINGS, AS_OF, **options)
    return {r["k"]: r.asDict() for r in out.collect()}


def test_single_event_and_zero_span(spark):
    day = datetime(2024, 1, 1)
    got = facts(
        spark,
        [
            (1, None, day, day, None, None),
            (2, "COMPLETED", day, day, None, 0),
            (2, "NO_SHOW", day, day, None, 0),
            (3, "COMPLETED", day, None, None, 1),
        ],
    )
    assert got[1]["TotalMeetings"] == 0 and got[1]["CompletionRate"] == 0.0 and got[1]["MeetingsPerMonth"] == 0.0
    assert got[2]["MeetingSpanDays"] == 0 and got[2]["MeetingsPerMonth"] == 2.0 and got[2]["CompletionRate"] == 0.5
    assert got[3]["MeetingAvgDaysFromCreateToActivity"] is None and got[3]["FirstMeetingDate"] is None


def test_scheduled_meetings_move_to_their_creation_date(spark):
    df = spark.createDataFrame(
        [(1, "SCHEDULED", datetime(2024, 1, 1, 10), datetime(2024, 2, 1), None, None)], SCHEMA
    )
    got = E.event_days(E.settle_dates(df), AS_OF).first()
    assert got["ActivityDate"] == datetime(2024, 1, 1)
    assert got["DaysFromCreateToActivity"] == -1


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_facts_agree_with_brute_force_under_skew(spark, partitions):
    rng = random.Random(5)
    data = []
    for i in range(600):
        key = 1 if i % 3 == 0 else rng.randrange(2, 20)  # one contact holds a third of all rows
        made = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(2000))
        held = None if rng.random() < 0.1 else made + timedelta(hours=rng.randrange(-50, 400))
        outcome = rng.choice(["SCHEDULED", "COMPLETED", "CANCELED", "NO_SHOW", "RESCHEDULED", None])
        data.append((key, outcome, made, held, None, rng.choice([-1, 0, 1, 2, None])))
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    got = {r["k"]: r.asDict() for r in E.engagement_features(df, "k", E.MEETINGS, AS_OF, segment="seg").collect()}
    for key in {d[0] for d in data}:
        mine = [d for d in data if d[0] == key]
        delays = [(d[3] - d[2]) // timedelta(days=1) for d in mine if d[3]]
        held = [d[3] for d in mine if d[3]]
        total = sum(d[1] is not None for d in mine)
        done = sum(d[1] == "COMPLETED" for d in mine)
        span = (max(held) - min(held)).days if len(mine) > 1 and held else 0
        r = got[key]
        assert r["TotalMeetings"] == total and r["CompletedMeetings"] == done
        assert r["MeetingMedianDaysFromCreateToActivity"] == median(delays)
        assert abs(r["MeetingAvgDaysFromCreateToActivity"] - sum(delays) / len(delays)) < 1e-9
        assert r["DaysSinceLastActivity"] == (AS_OF - max(held)).days
        assert r["DaysSinceFirstActivity"] == (AS_OF - min(held)).days
        assert r["MeetingSpanDays"] == span
        assert abs(r["MeetingsPerMonth"] - (total / (span / 30.44) if span else total)) < 1e-9
        counts = {s: sum(d[5] == s for d in mine) for s in (-1, 0, 1, 2)}
        assert [r[f"SegmentCount_{s}"] for s in (-1, 0, 1, 2)] == list(counts.values())
        best = min(counts, key=lambda s: (-counts[s], s))
        assert r["TopSegmentRepresentative"] == best and r["TopSegmentLabel"] == f"Segment_{best}"


def test_no_segment_at_all(spark):
    day = datetime(2024, 1, 1)
    got = facts(spark, [(1, None, day, day, None, None)], segment="seg")
    assert got[1]["TopSegmentRepresentative"] == -1 and got[1]["TopSegmentLabel"] == "No_Segment"


def test_top_segment_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (3, None), (3, "z")], "k int, s string")
    got = {r["k"]: (r["top_segment"], r["top_segment_label"]) for r in E.top_segment(df, "k", "s").collect()}
    assert got == {1: ("a", "Segment_a"), 2: (None, "No_Segment"), 3: ("z", "Segment_z")}


def test_digest_skips_blanks_and_keeps_order(spark):
    df = spark.createDataFrame(
        [(1, i, t) for i, t in enumerate(["one", "  ", None, "two!", "thr(ee)", "four", "five", "six"])] + [(2, 0, " ")],
        "k int, i int, t string",
    )
    got = {r["k"]: r["notes"] for r in E.note_digest(df, "k", "t", [F.desc("i")], 5).collect()}
    assert got == {1: "six\n\nfive\n\nfour\n\nthree\n\ntwo!"}


def test_segment_notes_limit_and_empty_segments(spark):
    df = spark.createDataFrame([(1, 0, i, f"n{i:02d}") for i in range(12)] + [(1, 2, 0, None)], "k int, s int, i int, t string")
    got = E.segment_notes(df, "k", "s", "t", [F.asc("i")], descriptions=E.MEETINGS.descriptions).first().asDict()
    assert got["Segment_0_SampleNote"] == "n00"
    assert got["Segment_0_NotesPreview"] == " | ".join(f"n{i:02d}" for i in range(10))
    assert got["Segment_2_SampleNote"] == "" and got["Segment_2_NotesPreview"] == "" and got["Segment_-1_SampleNote"] == ""
    assert got["Segment_1_Description"] == "General meeting notes - Cluster 1"
    assert E.first_note(df, "k", "s", "t", "i", (0, 2)).first()["Segment_2_SampleNote"] == ""


def test_rank_limit_is_applied_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS i", "cast(id AS string) AS t")
    plan = E.note_digest(df, "k", "t", [F.desc("i")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
