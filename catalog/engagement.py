"""Engagement facts, segments and note digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from leadloom.operators import engagement as E
from leadloom.operators import frames as R

_MEETING_AGG = f"""
facts AS (
  SELECT contact_id,
    count(*) FILTER (WHERE outcome = 'SCHEDULED') AS "ScheduledMeetings",
    count(*) FILTER (WHERE outcome = 'COMPLETED') AS "CompletedMeetings",
    count(*) FILTER (WHERE outcome = 'CANCELED') AS "CanceledMeetings",
    count(*) FILTER (WHERE outcome = 'NO_SHOW') AS "NoShowMeetings",
    count(outcome) AS "TotalMeetings",
    avg({B.days_sql('created', 'activity')}) AS "MeetingAvgDaysFromCreateToActivity",
    median({B.days_sql('created', 'activity')}) AS "MeetingMedianDaysFromCreateToActivity",
    {B.days_sql('max(activity)', f"TIMESTAMP '{B.ORDERS_AS_OF}'")} AS "DaysSinceLastActivity",
    {B.days_sql('min(activity)', f"TIMESTAMP '{B.ORDERS_AS_OF}'")} AS "DaysSinceFirstActivity",
    min(activity) AS "FirstMeetingDate", max(activity) AS "LastMeetingDate",
    CASE WHEN count(*) > 1 THEN {B.days_sql('min(activity)', 'max(activity)')} ELSE 0 END AS "MeetingSpanDays",
    count(*) FILTER (WHERE seg = -1) AS "SegmentCount_-1", count(*) FILTER (WHERE seg = 0) AS "SegmentCount_0",
    count(*) FILTER (WHERE seg = 1) AS "SegmentCount_1", count(*) FILTER (WHERE seg = 2) AS "SegmentCount_2"
  FROM meetings GROUP BY contact_id),
rates AS (
  SELECT *, CASE WHEN "MeetingSpanDays" > 0 THEN "TotalMeetings" / ("MeetingSpanDays" / 30.44) ELSE "TotalMeetings" END
              AS "MeetingsPerMonth",
         CASE WHEN "TotalMeetings" = 0 THEN 0.0 ELSE "CompletedMeetings" / "TotalMeetings" END AS "CompletionRate"
  FROM facts)"""


def engagement_features(spark, d):
    """Meeting facts of every customer, typed zeros where there were no meetings."""
    facts = E.engagement_features(
        E.settle_dates(B.meetings(spark, d)), "contact_id", E.MEETINGS, B.ORDERS_AS_OF
    )
    customers = B.table(spark, d, "customer").select(F.col("c_custkey").alias("contact_id"), "c_mktsegment")
    joined = R.left_attach(customers, facts, "contact_id")
    return B.tidy(R.fill_by_type(joined, facts.columns[1:]))


_FACT_NUMBERS = (
    "ScheduledMeetings CompletedMeetings CanceledMeetings NoShowMeetings TotalMeetings"
    " DaysSinceLastActivity DaysSinceFirstActivity MeetingSpanDays"
).split()
_FACT_FLOATS = (
    "MeetingAvgDaysFromCreateToActivity MeetingMedianDaysFromCreateToActivity MeetingsPerMonth CompletionRate"
).split()
ENGAGEMENT_SQL = (
    f"WITH {B.MEETINGS_SQL}, {_MEETING_AGG} SELECT c_custkey AS contact_id, c_mktsegment, "
    + ", ".join(f'coalesce(CAST("{c}" AS BIGINT), 0) AS "{c}"' for c in _FACT_NUMBERS)
    + ", "
    + ", ".join(f'round(coalesce(CAST("{c}" AS DOUBLE), 0), 6) AS "{c}"' for c in _FACT_FLOATS)
    + ', "FirstMeetingDate", "LastMeetingDate" FROM customer LEFT JOIN rates ON contact_id = c_custkey'
)


def call_features(spark, d):
    return B.tidy(E.engagement_features(B.calls(spark, d), "contact_id", E.CALLS, B.EVENTS_AS_OF))


CALL_SQL = f"""WITH {B.CALLS_SQL}, facts AS (
  SELECT contact_id,
    count(*) FILTER (WHERE outcome = 'Connected') AS "ConnectedCalls",
    count(*) FILTER (WHERE outcome = 'No Answer') AS "NoAnswerCalls",
    count(*) FILTER (WHERE outcome = 'Left Voicemail') AS "VoicemailCalls",
    count(*) FILTER (WHERE outcome = 'Busy') AS "BusyCalls",
    count(outcome) AS "CallAttempts",
    round(avg({B.days_sql('created', 'activity')}), 6) AS "CallAvgDaysFromCreateToActivity",
    round(median({B.days_sql('created', 'activity')}), 6) AS "CallMedianDaysFromCreateToActivity",
    {B.days_sql('max(activity)', f"TIMESTAMP '{B.EVENTS_AS_OF}'")} AS "DaysSinceLastCall",
    {B.days_sql('min(activity)', f"TIMESTAMP '{B.EVENTS_AS_OF}'")} AS "DaysSinceFirstCall",
    min(activity) AS "FirstCallDate", max(activity) AS "LastCallDate",
    CASE WHEN count(*) > 1 THEN {B.days_sql('min(activity)', 'max(activity)')} ELSE 0 END AS "CallSpanDays"
  FROM calls GROUP BY contact_id)
SELECT *, round(CASE WHEN "CallSpanDays" > 0 THEN "CallAttempts" / ("CallSpanDays" / 30.44) ELSE "CallAttempts" END, 6) AS "CallsPerMonth",
  round(CASE WHEN "CallAttempts" = 0 THEN 0.0 ELSE "ConnectedCalls" / "CallAttempts" END, 6) AS "ConnectionRate"
FROM facts"""


def scheduled_override_days(spark, d):
    days = E.event_days(E.settle_dates(B.meetings(spark, d)), B.ORDERS_AS_OF)
    return days.select(
        "event_id", "MeetingOutcome", "ActivityDate", "DaysFromCreateToActivity", "DaysSinceActivity", "DaysSinceCreate"
    )


SCHEDULED_SQL = f"""WITH {B.MEETINGS_SQL}
SELECT event_id, outcome AS "MeetingOutcome", activity AS "ActivityDate",
  {B.days_sql('created', 'activity')} AS "DaysFromCreateToActivity",
  {B.days_sql('activity', f"TIMESTAMP '{B.ORDERS_AS_OF}'")} AS "DaysSinceActivity",
  {B.days_sql('created', f"TIMESTAMP '{B.ORDERS_AS_OF}'")} AS "DaysSinceCreate"
FROM meetings"""


def segment_count_pivot(spark, d):
    return E.segment_counts(B.table(spark, d, "events"), "user_id", "event_type", ("click", "error", "purchase", "signup", "view"))


def segment_facts(spark, d):
    """Segment counts and the top segment of a contact from the same pass as its other facts."""
    facts = E.engagement_features(
        E.settle_dates(B.meetings(spark, d)), "contact_id", E.MEETINGS, B.ORDERS_AS_OF, segment="seg"
    )
    counts = [f"SegmentCount_{s}" for s in (-1, 0, 1, 2)]
    return B.tidy(facts.select("contact_id", *counts, "TopSegmentRepresentative", "TopSegmentLabel"))


SEGMENT_FACTS_SQL = f"""WITH {B.MEETINGS_SQL}, {_MEETING_AGG}, best AS (
  SELECT contact_id, seg FROM (
    SELECT contact_id, seg, row_number() OVER (PARTITION BY contact_id ORDER BY count(*) DESC, seg) AS r
    FROM meetings WHERE seg IN (-1, 0, 1, 2) GROUP BY contact_id, seg) WHERE r = 1)
SELECT contact_id, "SegmentCount_-1", "SegmentCount_0", "SegmentCount_1", "SegmentCount_2",
  CAST(coalesce(seg, -1) AS BIGINT) AS "TopSegmentRepresentative",
  CASE WHEN seg IS NULL THEN 'No_Segment' ELSE concat('Segment_', seg) END AS "TopSegmentLabel"
FROM facts LEFT JOIN best USING (contact_id)"""


def top_segment(spark, d):
    return E.top_segment(B.table(spark, d, "events"), "user_id", "event_type")


TOP_SEGMENT_SQL = """
SELECT user_id, event_type AS top_segment, concat('Segment_', event_type) AS top_segment_label FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r
  FROM events GROUP BY user_id, event_type) WHERE r = 1"""


def segment_sample_note(spark, d):
    return E.first_note(
        B.table(spark, d, "conversations"), "conv_id", "role", "text", "turn", ("user", "assistant", "system")
    )


SAMPLE_NOTE_SQL = (
    "SELECT conv_id, "
    + ", ".join(
        f"coalesce(arg_min(text, turn) FILTER (WHERE role = '{r}'), '') AS \"Segment_{r}_SampleNote\""
        for r in ("user", "assistant", "system")
    )
    + " FROM conversations GROUP BY conv_id"
)


def segment_notes_preview(spark, d):
    return E.segment_notes(
        B.table(spark, d, "conversations"), "conv_id", "role", "text", [F.asc("turn")], ("user", "assistant", "system"),
        stem="Segment", descriptions={"user": "Contact", "assistant": "Advisor", "system": "Notice"},
    )


PREVIEW_SQL = (
    "SELECT conv_id, "
    + ", ".join(
        f"coalesce(arg_min(text, turn) FILTER (WHERE role = '{r}'), '') AS \"Segment_{r}_SampleNote\","
        f" coalesce(string_agg(text, ' | ' ORDER BY turn) FILTER (WHERE role = '{r}' AND rn <= 10), '')"
        f" AS \"Segment_{r}_NotesPreview\", '{t}' AS \"Segment_{r}_Description\""
        for r, t in (("user", "Contact"), ("assistant", "Advisor"), ("system", "Notice"))
    )
    + " FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn FROM conversations"
    " WHERE text IS NOT NULL) GROUP BY conv_id"
)


def recent_notes_digest(spark, d):
    return E.note_digest(B.table(spark, d, "conversations"), "conv_id", "text", [F.desc("turn")], 5)


def _digest_sql(source: str, key: str, order: str) -> str:
    line = "trim(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '[^\\p{L}\\p{N}_\\s.,!?-]', '', 'g'))"
    return f"""SELECT {key}, string_agg({line}, chr(10) || chr(10) ORDER BY rn) AS notes FROM (
  SELECT {key}, text, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}
  WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '') WHERE rn <= 5 GROUP BY {key}"""


def source_notes_digest(spark, d):
    """Digest of the longest documents per source: few, very large groups."""
    return E.note_digest(
        B.table(spark, d, "documents"), "source", "text", [F.desc("n_chars"), F.asc("doc_id")], 5
    )


def outcome_descriptions(spark, d):
    return E.describe_outcome(B.meetings(spark, d)).select("event_id", "MeetingOutcomeDescription")


OUTCOME_SQL = f"""WITH {B.MEETINGS_SQL} SELECT event_id, CASE outcome
  WHEN 'COMPLETED' THEN 'Meeting was successfully completed' WHEN 'SCHEDULED' THEN 'Meeting is scheduled for future'
  WHEN 'CANCELED' THEN 'Meeting was canceled' WHEN 'RESCHEDULED' THEN 'Meeting was rescheduled'
  WHEN 'NO_SHOW' THEN 'Contact did not attend' ELSE 'No outcome recorded' END AS "MeetingOutcomeDescription"
FROM meetings"""

QUERIES = {
    "engagement_features": (engagement_features, ENGAGEMENT_SQL),
    "call_features": (call_features, CALL_SQL),
    "scheduled_override_days": (scheduled_override_days, SCHEDULED_SQL),
    "segment_count_pivot": (
        segment_count_pivot,
        "SELECT user_id, "
        + ", ".join(
            f"count(*) FILTER (WHERE event_type = '{t}') AS \"SegmentCount_{t}\"" for t in ("click", "error", "purchase", "signup", "view")
        )
        + " FROM events GROUP BY user_id",
    ),
    "segment_facts": (segment_facts, SEGMENT_FACTS_SQL),
    "top_segment": (top_segment, TOP_SEGMENT_SQL),
    "segment_sample_note": (segment_sample_note, SAMPLE_NOTE_SQL),
    "segment_notes_preview": (segment_notes_preview, PREVIEW_SQL),
    "recent_notes_digest": (recent_notes_digest, _digest_sql("conversations", "conv_id", "turn DESC")),
    "source_notes_digest": (source_notes_digest, _digest_sql("documents", "source", "n_chars DESC, doc_id")),
    "outcome_descriptions": (outcome_descriptions, OUTCOME_SQL),
}
