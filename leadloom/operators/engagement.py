"""Per-contact engagement features from event tables (meetings, calls)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom import vocab
from leadloom.functions import dates as D
from leadloom.functions import text as X


@dataclass(frozen=True)
class EngagementSpec:
    """Column names of one kind of engagement."""

    prefix: str
    outcome: str
    categories: Mapping[str, str]
    total: str
    rate: str
    rate_of: str
    per_month: str
    span: str
    since_last: str
    since_first: str
    first: str
    last: str
    note: str
    segment_count: str
    segment: str
    segment_label: str
    label_stem: str
    no_segment: str
    descriptions: Mapping[int, str] = field(default_factory=dict)


MEETINGS = EngagementSpec(
    prefix="Meeting",
    outcome="MeetingOutcome",
    categories={
        "ScheduledMeetings": "SCHEDULED",
        "CompletedMeetings": "COMPLETED",
        "CanceledMeetings": "CANCELED",
        "NoShowMeetings": "NO_SHOW",
    },
    total="TotalMeetings",
    rate="CompletionRate",
    rate_of="CompletedMeetings",
    per_month="MeetingsPerMonth",
    span="MeetingSpanDays",
    since_last="DaysSinceLastActivity",
    since_first="DaysSinceFirstActivity",
    first="FirstMeetingDate",
    last="LastMeetingDate",
    note="MeetingNotesPreview",
    segment_count="SegmentCount",
    segment="TopSegmentRepresentative",
    segment_label="TopSegmentLabel",
    label_stem="Segment",
    no_segment="No_Segment",
    descriptions=vocab.MEETING_SEGMENT_TEXT,
)
CALLS = EngagementSpec(
    prefix="Call",
    outcome="callDisposition",
    categories={
        "ConnectedCalls": "Connected",
        "NoAnswerCalls": "No Answer",
        "VoicemailCalls": "Left Voicemail",
        "BusyCalls": "Busy",
    },
    total="CallAttempts",
    rate="ConnectionRate",
    rate_of="ConnectedCalls",
    per_month="CallsPerMonth",
    span="CallSpanDays",
    since_last="DaysSinceLastCall",
    since_first="DaysSinceFirstCall",
    first="FirstCallDate",
    last="LastCallDate",
    note="CallNotesPreview",
    segment_count="CallSegmentCount",
    segment="TopCallSegmentId",
    segment_label="TopCallSegmentLabel",
    label_stem="CallSegment",
    no_segment="No_CallSegment",
    descriptions=vocab.CALL_SEGMENT_TEXT,
)


def settle_dates(
    events: DataFrame,
    outcome: str = "MeetingOutcome",
    created: str = "CreateDate",
    activity: str = "ActivityDate",
    scheduled: str = "SCHEDULED",
) -> DataFrame:
    """A scheduled meeting counts at its creation date; activity dates lose their time."""
    moved = F.when(F.col(outcome) == scheduled, F.col(created)).otherwise(F.col(activity))
    return events.withColumn(activity, F.to_date(moved).cast("timestamp_ntz"))


def event_days(events: DataFrame, as_of: datetime | str, created: str = "CreateDate", activity: str = "ActivityDate") -> DataFrame:
    """Whole days between creation and activity, since activity and since creation."""
    at = D.moment(as_of)
    return events.withColumns(
        {
            "DaysFromCreateToActivity": D.floor_days(created, activity),
            "DaysSinceActivity": D.floor_days(F.col(activity), at),
            "DaysSinceCreate": D.floor_days(F.col(created), at),
        }
    )


def engagement_features(
    events: DataFrame,
    key: str,
    spec: EngagementSpec,
    as_of: datetime | str,
    created: str = "CreateDate",
    activity: str = "ActivityDate",
    segment: str | None = None,
    segments: Sequence[int] = vocab.SEGMENTS,
) -> DataFrame:
    """One row per contact: outcome counts, delays, recency, span, rates, note segments.

    Two grouping steps. The first groups by (contact, delay in days): plain sums and extremes
    that combine before the shuffle, with the rows of a very active contact spread over many
    tasks. The second merges these few rows per contact; only there does the exact median need
    a value-to-count buffer, whose size is bounded by the number of distinct delays.
    """
    value = F.col(spec.outcome)
    at = F.col(activity).cast("timestamp_ntz")
    first_step = [F.count_if(value == v).alias(name) for name, v in spec.categories.items()]
    first_step += [
        F.count(value).alias("__outcomes"),
        F.count("*").alias("__rows"),
        F.min(at).alias("__first"),
        F.max(at).alias("__last"),
    ]
    seg_names = {s: f"{spec.segment_count}_{s}" for s in segments} if segment else {}
    first_step += [F.count_if(F.col(segment) == s).alias(name) for s, name in seg_names.items()]
    partial = events.groupBy(
        F.col(key).alias(key), D.floor_days(created, activity).alias("__delay")
    ).agg(*first_step)

    weight = F.when(F.col("__delay").isNotNull(), F.col("__rows"))
    merged = partial.groupBy(key).agg(
        *[F.sum(name).alias(name) for name in (*spec.categories, *seg_names.values())],
        F.sum("__outcomes").alias(spec.total),
        F.sum("__rows").alias("__rows"),
        (F.sum(F.col("__delay") * weight).cast("double") / F.sum(weight)).alias("__avg"),
        F.percentile("__delay", 0.5, F.coalesce(weight, F.lit(0))).alias("__median"),
        F.min("__first").alias("__first"),
        F.max("__last").alias("__last"),
    )
    span = F.when(F.col("__rows") > 1, D.floor_days("__first", "__last")).otherwise(F.lit(0).cast("bigint"))
    total = F.col(spec.total).cast("double")
    out = {
        **{name: F.col(name) for name in spec.categories},
        spec.total: F.col(spec.total),
        f"{spec.prefix}AvgDaysFromCreateToActivity": F.col("__avg"),
        f"{spec.prefix}MedianDaysFromCreateToActivity": F.col("__median"),
        spec.since_last: D.floor_days(F.col("__last"), D.moment(as_of)),
        spec.since_first: D.floor_days(F.col("__first"), D.moment(as_of)),
        spec.first: F.col("__first"),
        spec.last: F.col("__last"),
        spec.span: F.coalesce(span, F.lit(0).cast("bigint")),
        spec.per_month: F.when(span > 0, total / (span / F.lit(vocab.DAYS_PER_MONTH))).otherwise(total),
        spec.rate: F.coalesce(F.try_divide(F.col(spec.rate_of).cast("double"), total), F.lit(0.0)),
    }
    if seg_names:
        out.update({name: F.col(name) for name in seg_names.values()})
        out.update(_top_segment(seg_names, spec))
    return merged.select(key, *[c.alias(name) for name, c in out.items()])


def _top_segment(counts: Mapping[int, str], spec: EngagementSpec) -> dict:
    """Most frequent segment from the counts of one row; the smaller id wins ties."""
    best = F.greatest(*[F.col(name) for name in counts.values()]) if len(counts) > 1 else F.col(*counts.values())
    hits = [F.when((F.col(name) == best) & (best > 0), F.lit(s)) for s, name in sorted(counts.items())]
    top = F.coalesce(*hits)
    return {
        spec.segment: F.coalesce(top, F.lit(-1)),
        spec.segment_label: F.coalesce(
            F.concat(F.lit(f"{spec.label_stem}_"), top.cast("string")), F.lit(spec.no_segment)
        ),
    }


def segment_counts(
    events: DataFrame, key: str, segment: str, values: Sequence = vocab.SEGMENTS, prefix: str = "SegmentCount"
) -> DataFrame:
    """Events per contact and segment, one column per listed segment."""
    return events.groupBy(key).agg(
        *[F.count_if(F.col(segment) == v).alias(f"{prefix}_{v}") for v in values]
    )


def top_segment(
    events: DataFrame,
    key: str,
    segment: str,
    label: str = "Segment",
    out: str = "top_segment",
    out_label: str = "top_segment_label",
    missing: str = "No_Segment",
) -> DataFrame:
    """Most frequent segment of each contact for segments that are not known beforehand.

    Counting by (contact, segment) first keeps hot contacts small; the pick is one maximum.
    """
    counted = events.groupBy(key, segment).agg(F.count("*").alias("__n"))
    named = F.when(F.col(segment).isNotNull(), F.struct(-F.col("__n"), F.col(segment)))
    best = F.min_by(F.col(segment), named).alias(out)
    return counted.groupBy(key).agg(best).withColumn(
        out_label,
        F.coalesce(F.concat(F.lit(f"{label}_"), F.col(out).cast("string")), F.lit(missing)),
    )


def first_note(events: DataFrame, key: str, segment: str, note: str, order: str, values: Sequence, suffix: str = "SampleNote", prefix: str = "Segment") -> DataFrame:
    """First non-null note of each contact in each listed segment, empty where there is none.

    Notes at the same place are ordered by their text.
    """
    picks = []
    for v in values:
        position = F.when((F.col(segment) == v) & F.col(note).isNotNull(), F.struct(order, note))
        picks.append(F.coalesce(F.min_by(note, position), F.lit("")).alias(f"{prefix}_{v}_{suffix}"))
    return events.groupBy(key).agg(*picks)


def note_digest(
    events: DataFrame,
    key: str,
    note: str,
    order: Sequence,
    k: int = 5,
    sep: str = "\n\n",
    out: str = "notes",
    clean=X.prompt_clean,
) -> DataFrame:
    """The first ``k`` non-empty notes of each contact in the given order, joined.

    The rank limit is applied before the shuffle as well as after it, so at most ``k`` rows per
    contact and input task travel, however many notes one contact has.
    """
    kept = events.filter(X.has_text(note))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    top = kept.select("*", rank.alias("__rank")).filter(F.col("__rank") <= k)
    text = clean(F.col(note)) if clean else F.col(note)
    return top.groupBy(key).agg(_joined(F.collect_list(F.struct("__rank", text.alias("t"))), sep).alias(out))


def _joined(pairs, sep: str):
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: p["t"]), sep)


def segment_notes(
    events: DataFrame,
    key: str,
    segment: str,
    note: str,
    order: Sequence,
    values: Sequence = vocab.SEGMENTS,
    k: int = 10,
    sep: str = " | ",
    stem: str = "Segment",
    descriptions: Mapping[int, str] | None = None,
) -> DataFrame:
    """Sample note, preview of up to ``k`` notes and description for each segment of a contact.

    One ranked pass serves all segments; there is no join per segment.
    """
    kept = events.filter(F.col(note).isNotNull())
    rank = F.row_number().over(Window.partitionBy(key, segment).orderBy(*order))
    top = kept.select(key, segment, note, rank.alias("__rank")).filter(F.col("__rank") <= k)
    aggs = []
    for v in values:
        here = F.col(segment) == v
        sample = F.max(F.when(here & (F.col("__rank") == 1), F.col(note)))
        pairs = F.collect_list(F.when(here, F.struct("__rank", F.col(note).alias("t"))))
        aggs.append(F.coalesce(sample, F.lit("")).alias(f"{stem}_{v}_SampleNote"))
        aggs.append(_joined(pairs, sep).alias(f"{stem}_{v}_NotesPreview"))
    out = top.groupBy(key).agg(*aggs)
    if descriptions:
        out = out.withColumns({f"{stem}_{v}_Description": F.lit(descriptions.get(v, "Unknown segment")) for v in values})
    return out


def describe_outcome(events: DataFrame, outcome: str = "MeetingOutcome", out: str = "MeetingOutcomeDescription") -> DataFrame:
    return events.withColumn(
        out, X.value_map(outcome, vocab.OUTCOME_TEXT, keep=False, null_value=vocab.OUTCOME_MISSING)
    )
