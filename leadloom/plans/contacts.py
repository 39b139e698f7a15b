"""Contact cleaning shared by the lead and the conversion plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom import vocab
from leadloom.functions import text as X
from leadloom.operators import engagement as E
from leadloom.operators import frames as R
from leadloom.operators.clustering import segment_notes_by_text
from leadloom.session import materialise


def clean_contacts(contacts: DataFrame, site: str, site_label: str) -> DataFrame:
    """Default values, title-cased city, campaign, landing page, gender and nationality classes."""
    df = R.fill_defaults(contacts, {**vocab.ZERO_FILL, **vocab.TEXT_DEFAULTS})
    rules = {
        "City": lambda c: X.title_case(c),
        "UTMCampaignFirstTouch": lambda c: X.keyword_class(c),
        "FirstPageSeen": lambda c: X.regex_class(c, vocab.page_rules(site, site_label)),
        "Gender": lambda c: X.value_map(c, vocab.GENDER_ANSWERS),
        "Nationality": lambda c: X.value_map(X.strip_all(F.lower(c)), vocab.NATIONALITY_VARIANTS),
    }
    return df.withColumns({c: rule(F.col(c)) for c, rule in rules.items() if c in df.columns})


def note_order(note: str) -> list:
    """Newest first; the remaining columns only settle ties."""
    return [F.desc_nulls_last("ActivityDate"), F.desc_nulls_last("CreateDate"), F.asc(note)]


def known_events(
    events: DataFrame,
    contacts: DataFrame,
    key: str,
    event_key: str,
    spec: E.EngagementSpec,
    extra: Sequence[str] = (),
) -> DataFrame:
    """The columns of interest of the events of the given contacts, under the contact key.

    The filter comes before any cleaning or clustering, at every size.
    """
    wanted = [event_key, "CreateDate", "ActivityDate", spec.outcome, spec.note, *extra]
    mine = R.rename_key(R.select_existing(events, wanted), event_key, key)
    return R.keep_known(mine, contacts, key)


def with_segments(events: DataFrame, spec: E.EngagementSpec, segment: str, embedding: str | None, seed: int, **options) -> DataFrame:
    """Cluster the notes unless the events bring their segments along.

    The clustered events are stored: facts and note digests both read them, the facts without
    the text.
    """
    if segment in events.columns:
        return events.withColumn(segment, F.coalesce(F.col(segment).cast("int"), F.lit(-1)))
    if embedding and embedding not in events.columns:
        embedding = None
    return materialise(
        segment_notes_by_text(events, spec.note, out=segment, seed=seed, embedding=embedding, **options)
    )
