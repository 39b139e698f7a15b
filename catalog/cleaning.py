"""Filters, joins, category normalisation, dates, defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from leadloom import vocab
from leadloom.functions import dates as D
from leadloom.functions import text as X
from leadloom.operators import engagement as E
from leadloom.operators import frames as R
from leadloom.plans.contacts import clean_contacts

_C = f"WITH {B.CONTACTS_SQL} "


def lead_filter(spark, d):
    rows = R.lead_filter(B.contacts(spark, d), ("ASIA", "AFRICA", "EUROPE"))
    return rows.select("contact_id", "LeadStageNewCEO", "ContactType")


LEAD_SQL = _C + """SELECT contact_id, "LeadStageNewCEO", "ContactType" FROM contacts
WHERE "LeadStageNewCEO" IN ('SQL 1', 'SQL 2', 'SAL 1', 'SAL 2')
  AND "IsThisLeadAlreadyFoundInAnInternalDatabase" = 'Not Found' AND "ContactType" IN ('ASIA', 'AFRICA', 'EUROPE')"""


def conversion_filter(spark, d):
    rows = R.conversion_filter(
        B.contacts(spark, d), ("ASIA", "EUROPE"), "AFRICA", excluded_ids=(7, 8, 9), extra_ids=(1, 2, 3, 4, 5, 6),
        key="contact_id",
    )
    return rows.select("contact_id", "LeadStageNew", "LeadStageNewCEO", "OnboardingId", "ClientType")


CONVERSION_SQL = _C + """SELECT contact_id, "LeadStageNew", "LeadStageNewCEO", "OnboardingId", "ClientType" FROM contacts
WHERE ("OnboardingId" IS NOT NULL AND "LeadStageNew" = 'Committed Capital' AND "OnboardingId" NOT IN (7, 8, 9)
       AND ("ClientType" = 'AFRICA' OR contact_id IN (1, 2, 3, 4, 5, 6)))
   OR "LeadStageNewCEO" IN ('SAL 1', 'SAL 2') AND "ContactType" IN ('ASIA', 'EUROPE')"""


def keep_null_not_equal(spark, d):
    return R.not_equal_keep_null(B.contacts(spark, d), "LeadStageNewCEO", "Lead").select("contact_id", "LeadStageNewCEO")


def semi_join_events(spark, d):
    ids = B.contacts(spark, d).filter(F.col("LeadStageNewCEO") == "SAL 1")
    return R.keep_known(B.calls(spark, d), ids, "contact_id").select("event_id", "contact_id", "callDisposition")


def anti_join_missing(spark, d):
    ids = B.contacts(spark, d).filter(F.col("LeadStageNewCEO") == "SAL 1")
    return R.drop_known(B.calls(spark, d), ids, "contact_id").select("event_id", "contact_id", "callDisposition")


_SEMI = """SELECT event_id, contact_id, outcome AS "callDisposition" FROM calls WHERE contact_id {} (
  SELECT contact_id FROM contacts WHERE "LeadStageNewCEO" = 'SAL 1')"""


def left_attach(spark, d):
    """Left join with a name both sides have and typed defaults."""
    customers = B.table(spark, d, "customer").select("c_custkey", "c_name")
    right = (
        B.table(spark, d, "events")
        .groupBy(F.col("user_id").alias("c_custkey"))
        .agg(F.count("*").alias("n_events"), F.max("event_type").alias("c_name"))
    )
    return R.left_attach(customers, right, "c_custkey", {"n_events": 0, "Last_c_name": "none"}, prefix="Last_")


def keyword_class(spark, d):
    words = {"page=": "paged", "ref=": "referral", "#top": "anchor", "blog": "blog"}
    return B.table(spark, d, "pages").select("page_id", X.keyword_class("url", words, "others").alias("url_class"))


def campaign_class(spark, d):
    return B.contacts(spark, d).select("contact_id", X.keyword_class("UTMCampaignFirstTouch").alias("campaign"))


CAMPAIGN_SQL = (
    _C
    + "SELECT contact_id, CASE "
    + " ".join(
        f"WHEN contains(lower(\"UTMCampaignFirstTouch\"), '{k}') THEN '{k}'" for k in vocab.CAMPAIGN_KEYWORDS
    )
    + " ELSE 'others' END AS campaign FROM contacts"
)


def page_class(spark, d):
    rules = vocab.page_rules("example", "example website")
    return B.contacts(spark, d).select("contact_id", X.regex_class("FirstPageSeen", rules).alias("page"))


_PAGE_SQL = '"FirstPageSeen"'
for _pattern, _label in vocab.page_rules("example", "example website"):
    _PAGE_SQL = f"regexp_replace({_PAGE_SQL}, '{_pattern}', '{_label}', 'g')"


def regex_class(spark, d):
    return B.table(spark, d, "pages").select(
        "page_id", X.regex_class("url", [(r".*blog.*", "Blog"), (r".*www.*", "Website"), (r".*example.org.*", "Org")]).alias("cls")
    )


def value_map(spark, d):
    cleaned = X.strip_all(F.lower("Nationality"))
    return B.contacts(spark, d).select(
        "contact_id",
        X.value_map(cleaned, vocab.NATIONALITY_VARIANTS).alias("nationality"),
        X.value_map("Gender", vocab.GENDER_ANSWERS).alias("gender"),
    )


VALUE_MAP_SQL = _C + """SELECT contact_id,
  CASE trim(lower("Nationality")) WHEN 'ksa' THEN 'saudi arabia' WHEN 'saudi' THEN 'saudi arabia'
    WHEN 'saudi_arabian' THEN 'saudi arabia' WHEN 'bahraini' THEN 'bahrain' ELSE trim(lower("Nationality")) END AS nationality,
  CASE "Gender" WHEN 'Yes' THEN 'Male' WHEN 'No' THEN 'Female' ELSE "Gender" END AS gender FROM contacts"""


def nationality_filter(spark, d):
    """Equality on the cleaned value keeps one nationality."""
    cleaned = clean_contacts(B.contacts(spark, d), "example", "example website")
    return cleaned.filter(F.col("Nationality") == "saudi arabia").select("contact_id", "Nationality")


def ordinal_map(spark, d):
    return B.whole(
        B.contacts(spark, d).select(
            "contact_id",
            X.value_map("LeadStageNew", vocab.STAGE_ORDINAL, keep=False).alias("stage"),
            X.value_map("LeadStageNew", vocab.STAGE_ORDINAL, keep=False, casefold=True).alias("stage_any_case"),
            F.coalesce(X.value_map("EngagementLabel", vocab.ENGAGEMENT_ORDINAL, keep=False), F.lit(-1)).alias("engagement"),
        )
    )


_STAGE = " ".join(f"WHEN '{k}' THEN {v}" for k, v in vocab.STAGE_ORDINAL.items())
_STAGE_LOWER = " ".join(f"WHEN '{k.lower()}' THEN {v}" for k, v in vocab.STAGE_ORDINAL.items())
ORDINAL_SQL = _C + f"""SELECT contact_id, CAST(CASE "LeadStageNew" {_STAGE} END AS BIGINT) AS stage,
  CAST(CASE lower("LeadStageNew") {_STAGE_LOWER} END AS BIGINT) AS stage_any_case,
  CAST(CASE "EngagementLabel" WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END AS BIGINT) AS engagement
FROM contacts"""


def fill_defaults(spark, d):
    filled = R.fill_defaults(B.contacts(spark, d), {**vocab.ZERO_FILL, **vocab.TEXT_DEFAULTS})
    out = filled.select("contact_id", "PageDirectoryArticles", "AgeRange", "MaritalStatus", "PreferredLanguage", "City")
    return B.whole(out.withColumn("City", X.title_case("City")))


FILL_SQL = _C + """SELECT contact_id, CAST(coalesce("PageDirectoryArticles", 0) AS BIGINT) AS "PageDirectoryArticles",
  coalesce("AgeRange", '0') AS "AgeRange", coalesce("MaritalStatus", 'Cannot be determined') AS "MaritalStatus",
  coalesce("PreferredLanguage", 'English') AS "PreferredLanguage",
  array_to_string(list_transform(regexp_extract_all(coalesce("City", 'Cannot be Determined'), '[A-Za-z]+|[^A-Za-z]+'),
    lambda w: upper(w[1]) || lower(w[2:])), '') AS "City"
FROM contacts"""


def fill_by_type(spark, d):
    cols = ["contact_id", "PageDirectoryArticles", "MaritalStatus", "LeadStageNew", "OnboardingId"]
    return B.whole(R.fill_by_type(B.contacts(spark, d).select(*cols)))


def date_bins(spark, d):
    return R.date_bins(B.table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", B.ORDERS_AS_OF, "bin")


DATE_BINS_SQL = f"""SELECT o_orderkey, o_orderdate, CASE
  WHEN o_orderdate >= TIMESTAMP '{B.ORDERS_AS_OF}' THEN NULL
  WHEN o_orderdate < s + INTERVAL 547 DAY THEN '0 to 1.5 years ago' WHEN o_orderdate < s + INTERVAL 730 DAY THEN '1.5 to 2 years ago'
  WHEN o_orderdate < s + INTERVAL 912 DAY THEN '2 to 2.5 years ago' WHEN o_orderdate < s + INTERVAL 1095 DAY THEN '2.5 to 3 years ago'
  ELSE '3+ years ago' END AS bin FROM orders, (SELECT min(o_orderdate) AS s FROM orders)"""


def days_since_999(spark, d):
    cols = ["contact_id", "LastContactedDate", "FollowUpDate"]
    return R.days_since(B.contacts(spark, d).select(*cols), vocab.DAYS_SINCE_COLUMNS, B.ORDERS_AS_OF)


DAYS_SQL = _C + "SELECT contact_id, " + ", ".join(
    f"""coalesce({B.days_sql(f'"{c}"', f"TIMESTAMP '{B.ORDERS_AS_OF}'")}, 999) AS "{c}_days\""""
    for c in ("LastContactedDate", "FollowUpDate")
) + " FROM contacts"


def parse_dates(spark, d):
    """Lenient timestamp parse: every status letter spoils the text of some rows."""
    text = F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderstatus") == "P", F.lit("?")).otherwise(F.lit(""))
    )
    return B.table(spark, d, "orders").select("o_orderkey", D.parse_moment(text).alias("parsed"))


def activity_dates(spark, d):
    """Date truncation with the scheduled override, and a filter on non-blank notes."""
    settled = E.settle_dates(B.meetings(spark, d))
    return settled.filter(X.has_text("MeetingNotesPreview")).select("event_id", "ActivityDate")


def score_threshold(spark, d):
    rows = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("score"))
    return B.tidy(R.above(rows, "score", 0.5))


def contains_filter(spark, d):
    rows = B.contacts(spark, d).filter(X.contains_ci("LeadStageNewCEO", "sql"))
    return rows.select("contact_id", "LeadStageNewCEO")


def one_line_text(spark, d):
    """Prompt clean-up and ellipsis on whole texts."""
    return B.table(spark, d, "conversations").select(
        "conv_id", "turn", X.prompt_clean("text").alias("line"), X.ellipsis("text", 30).alias("short")
    )


ONE_LINE_SQL = """SELECT conv_id, turn,
  trim(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '[^\\p{L}\\p{N}_\\s.,!?-]', '', 'g')) AS line,
  CASE WHEN length(text) > 30 THEN substr(text, 1, 29) || '…' ELSE text END AS short FROM conversations"""

QUERIES = {
    "lead_filter": (lead_filter, LEAD_SQL),
    "conversion_filter": (conversion_filter, CONVERSION_SQL),
    "keep_null_not_equal": (
        keep_null_not_equal,
        _C + """SELECT contact_id, "LeadStageNewCEO" FROM contacts WHERE "LeadStageNewCEO" IS DISTINCT FROM 'Lead'""",
    ),
    "semi_join_events": (semi_join_events, f"{_C}, {B.CALLS_SQL} " + _SEMI.format("IN")),
    "anti_join_missing": (anti_join_missing, f"{_C}, {B.CALLS_SQL} " + _SEMI.format("NOT IN")),
    "left_attach": (
        left_attach,
        """SELECT c_custkey, c_name, coalesce(n, 0) AS n_events, coalesce(t, 'none') AS "Last_c_name" FROM customer
        LEFT JOIN (SELECT user_id, count(*) AS n, max(event_type) AS t FROM events GROUP BY user_id) ON user_id = c_custkey""",
    ),
    "keyword_class": (
        keyword_class,
        """SELECT page_id, CASE WHEN contains(lower(url), 'page=') THEN 'paged' WHEN contains(lower(url), 'ref=') THEN 'referral'
        WHEN contains(lower(url), '#top') THEN 'anchor' WHEN contains(lower(url), 'blog') THEN 'blog' ELSE 'others' END AS url_class
        FROM pages""",
    ),
    "campaign_class": (campaign_class, CAMPAIGN_SQL),
    "page_class": (page_class, f"{_C} SELECT contact_id, {_PAGE_SQL} AS page FROM contacts"),
    "regex_class": (
        regex_class,
        """SELECT page_id, CASE WHEN contains(url, 'blog') THEN 'Blog' WHEN contains(url, 'www') THEN 'Website'
        WHEN regexp_matches(url, 'example.org') THEN 'Org' ELSE url END AS cls FROM pages""",
    ),
    "value_map": (value_map, VALUE_MAP_SQL),
    "nationality_filter": (
        nationality_filter,
        _C + """SELECT contact_id, 'saudi arabia' AS "Nationality" FROM contacts
        WHERE trim(lower("Nationality")) IN ('ksa', 'saudi', 'saudi_arabian')""",
    ),
    "ordinal_map": (ordinal_map, ORDINAL_SQL),
    "fill_defaults": (fill_defaults, FILL_SQL),
    "fill_by_type": (
        fill_by_type,
        _C + """SELECT contact_id, CAST(coalesce("PageDirectoryArticles", 0) AS BIGINT) AS "PageDirectoryArticles",
        coalesce("MaritalStatus", '') AS "MaritalStatus", coalesce("LeadStageNew", '') AS "LeadStageNew",
        coalesce("OnboardingId", 0) AS "OnboardingId" FROM contacts""",
    ),
    "date_bins": (date_bins, DATE_BINS_SQL),
    "days_since_999": (days_since_999, DAYS_SQL),
    "parse_dates": (
        parse_dates,
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS parsed FROM orders",
    ),
    "activity_dates": (activity_dates, f'WITH {B.MEETINGS_SQL} SELECT event_id, activity AS "ActivityDate" FROM meetings'),
    "score_threshold": (
        score_threshold,
        """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(l_discount * 10, 6) AS score
        FROM lineitem WHERE l_discount * 10 >= 0.5""",
    ),
    "contains_filter": (
        contains_filter,
        _C + """SELECT contact_id, "LeadStageNewCEO" FROM contacts WHERE lower("LeadStageNewCEO") LIKE '%sql%'""",
    ),
    "one_line_text": (one_line_text, ONE_LINE_SQL),
}
