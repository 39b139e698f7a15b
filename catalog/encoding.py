"""Encoders, targets, missing-data rule, profiles and table clean-up."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from catalog import base as B
from leadloom import vocab
from leadloom.operators import encoding as C
from leadloom.operators import frames as R
from leadloom.session import shared_dir
from leadloom.sources import tables as T

_C = f"WITH {B.CONTACTS_SQL} "
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
RUN_AT = datetime(2001, 8, 2, 6, 30, 5)


def onehot(spark, d):
    customers = B.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return B.whole(C.onehot(customers, C.fit_onehot(customers, ["c_mktsegment"])).drop("c_mktsegment"))


def onehot_with_null(spark, d):
    rows = B.contacts(spark, d).select("contact_id", "Gender", "CampaignType")
    return B.whole(C.onehot(rows, C.fit_onehot(rows, ["Gender", "CampaignType"])).drop("Gender", "CampaignType"))


def topk_bucket_onehot(spark, d):
    rows = B.contacts(spark, d).select("contact_id", "Country")
    top = C.fit_top_values(rows, ["Country"], 5)["Country"]
    bucketed = C.top_or_other(rows, "Country", values=top)
    flags = C.onehot(bucketed, {"Country": [*top, "Other"]})
    ranked = [F.col(f"`Country_{v}`").alias(f"Country_top{i}") for i, v in enumerate(top, 1)]
    return B.whole(flags.select("contact_id", "Country", "Country_Other", *ranked))


TOPK_SQL = _C + """, top AS (SELECT "Country" AS c, row_number() OVER (ORDER BY count(*) DESC, "Country") AS r FROM contacts GROUP BY 1 QUALIFY r <= 5)
SELECT contact_id, coalesce(c, 'Other') AS "Country", CAST(CASE WHEN c IS NULL THEN 1 ELSE 0 END AS BIGINT) AS "Country_Other",
  """ + ", ".join(f"CAST(coalesce(r, 0) = {i} AS BIGINT) AS \"Country_top{i}\"" for i in range(1, 6)) + """
FROM contacts LEFT JOIN top ON c = "Country" """


def top_values(spark, d):
    """The five most frequent values of several columns from one pass."""
    counts = C.category_counts(B.contacts(spark, d), ["Country", "AgeRange", "FirstPageSeen"])
    return counts


def date_bin_onehot(spark, d):
    rows = R.date_bins(B.table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", B.ORDERS_AS_OF, "bin")
    flags = C.onehot(rows, {"bin": vocab.DATE_BIN_LABELS}, {"bin": "Created"})
    return B.whole(flags.drop("o_orderdate", "bin"))


_BIN_STARTS = [0, 547, 730, 912, 1095]


def _bin_test(i: int) -> str:
    low = f"o_orderdate >= s + INTERVAL {_BIN_STARTS[i]} DAY"
    high = f"o_orderdate < s + INTERVAL {_BIN_STARTS[i + 1]} DAY" if i < 4 else f"o_orderdate < TIMESTAMP '{B.ORDERS_AS_OF}'"
    return f"CAST({low} AND {high} AS BIGINT)"


DATE_ONEHOT_SQL = (
    "SELECT o_orderkey, "
    + ", ".join(f'{_bin_test(i)} AS "Created_{label}"' for i, label in enumerate(vocab.DATE_BIN_LABELS))
    + " FROM orders, (SELECT min(o_orderdate) AS s FROM orders)"
)


def label_encode(spark, d):
    parts = B.table(spark, d, "part").select("p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"), "p_type", "p_size")
    return C.label_encode(parts, C.fit_labels(parts, ["p_brand", "p_type", "p_size"])).drop("p_brand", "p_type", "p_size")


def label_encode_wide(spark, d):
    """A column with as many values as rows: codes come from a ranked join."""
    rows = B.table(spark, d, "customer").select("c_custkey", "c_name")
    return C.label_encode(rows, C.fit_labels(rows, ["c_name"], literal_limit=4)).drop("c_name")


def contact_flags(spark, d):
    rows = C.contact_flags(B.contacts(spark, d).select("contact_id", "SegmentClass", "EngagementLabel", "AgeRange"))
    return B.whole(rows.drop("SegmentClass", "EngagementLabel", "AgeRange"))


FLAGS_SQL = (
    _C
    + "SELECT contact_id, "
    + ", ".join(f'CAST("SegmentClass" = {i} AS BIGINT) AS "SegmentClass_{i}"' for i in range(5))
    + """, CAST(CASE "EngagementLabel" WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END AS BIGINT) AS engagement_label, """
    + ", ".join(f"CAST(coalesce(\"AgeRange\" = '{v}', false) AS BIGINT) AS {n}" for n, v in vocab.AGE_BANDS.items())
    + " FROM contacts"
)


def targets(spark, d):
    rows = B.contacts(spark, d).select("contact_id", "LeadStageNewCEO", "PageDirectoryArticles")
    rows = C.conversion_target(C.lead_target(rows, out="accepted"), out="converted")
    return B.whole(C.topup_target(rows, "PageDirectoryArticles", "topped_up").drop("PageDirectoryArticles"))


TARGETS_SQL = _C + """SELECT contact_id, "LeadStageNewCEO",
  CAST(coalesce(contains("LeadStageNewCEO", 'SAL'), false) AS BIGINT) AS accepted,
  CAST(CASE "LeadStageNewCEO" WHEN 'SAL 1' THEN 0 WHEN 'SAL 2' THEN 0 WHEN 'Client' THEN 1 END AS BIGINT) AS converted,
  CAST(coalesce("PageDirectoryArticles", 0) > 0 AS BIGINT) AS topped_up FROM contacts"""

_GROUPS = {
    "Gender": ["Gender_Yes", "Gender_No", "Gender_Institution"],
    "CampaignType": ["CampaignType_Awareness", "CampaignType_Lead Gen"],
    "MaritalStatus": [f"MaritalStatus_{s}" for s in _SEGMENTS],
    "PreferredLanguage": ["PreferredLanguage_Arabic"],
    "none": ["no_such_column"],
}


def _grouped(spark, d):
    rows = B.contacts(spark, d).select("contact_id", "Gender", "CampaignType", "MaritalStatus", "PreferredLanguage")
    return C.onehot(
        rows,
        {
            "Gender": ["Yes", "No", "Institution"],
            "CampaignType": ["Awareness", "Lead Gen"],
            "MaritalStatus": _SEGMENTS,
            "PreferredLanguage": ["Arabic"],
        },
    )


def missing_group_ratio(spark, d):
    return B.tidy(R.missing_ratio(_grouped(spark, d), _GROUPS).select("contact_id", "missing_ratio"))


def drop_high_missing(spark, d):
    return R.drop_high_missing(_grouped(spark, d), _GROUPS, 0.6).select("contact_id")


_MISSING = """(CAST("Gender" IS NULL AS INT) + CAST("CampaignType" IS NULL AS INT) + CAST("MaritalStatus" IS NULL AS INT)
  + CAST("PreferredLanguage" IS NULL AS INT)) / 5.0"""


def width_profile(spark, d):
    return T.width_profile(B.table(spark, d, "documents"))


def _text_width(col: str) -> str:
    return f"""SELECT '{col}' AS "column", CAST(w AS BIGINT) AS max_len, CASE WHEN w > 4000 THEN 'NVARCHAR(MAX)'
    WHEN w > 500 THEN 'NVARCHAR(4000)' WHEN w = 0 THEN 'NVARCHAR(255)'
    ELSE 'NVARCHAR(' || CAST(least(greatest(CAST(floor(w * 1.5) AS BIGINT), 50), 500) AS VARCHAR) || ')' END AS sql_type
    FROM (SELECT max(length({col})) AS w FROM documents)"""


WIDTH_SQL = " UNION ALL ".join(
    [_text_width(c) for c in ("text", "lang", "source")]
    + [
        f"""SELECT '{c}', NULL, CASE WHEN max({c}) > 2147483647 OR min({c}) < -2147483648 THEN 'BIGINT' ELSE 'INTEGER' END
        FROM documents""" for c in ("doc_id", "n_chars")
    ]
)


def int_widening(spark, d):
    rows = B.table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderkey") + F.lit(2 * 10**14)).alias("far"), (-F.col("o_custkey")).alias("near")
    )
    return T.widen_large_ints(rows)


def clean_output(spark, d):
    """Table-safe names and values, case-insensitive duplicates dropped."""
    rows = B.contacts(spark, d).select(
        "contact_id",
        F.col("LeadStageNewCEO").alias("Lead Stage & Type"),
        F.when(F.col("OnboardingId").isNull(), F.lit("nan")).otherwise(F.col("ClientType")).alias("client-type"),
        F.col("CreateDate").alias("created at"),
        F.col("Gender").alias("GENDER"),
        F.col("City").alias("gender"),
    )
    return R.clean_output_values(R.drop_duplicate_columns(R.clean_output_names(rows)))


CLEAN_OUTPUT_SQL = _C + """SELECT contact_id, coalesce("LeadStageNewCEO", '') AS "Lead_Stage_and_Type",
  CASE WHEN "OnboardingId" IS NULL THEN '' ELSE "ClientType" END AS client_type, "CreateDate" AS created_at,
  coalesce("Gender", '') AS "GENDER" FROM contacts"""


def sanitize_names(spark, d):
    rows = B.table(spark, d, "events").select(
        F.col("event_id").alias("event id"), F.col("event_id").alias("event-id"), F.col("value").alias(" value (usd)! ")
    )
    return B.tidy(R.sanitize_column_names(rows))


def normalised_id(spark, d):
    rows = B.table(spark, d, "customer").select(F.col("c_custkey").alias("Client ID"), "c_name")
    return R.normalise_id(rows, ["Client_ID", "Client ID"], "HubSpotId")


def run_stamp(spark, d):
    return R.stamp_run(B.table(spark, d, "customer").select("c_custkey"), RUN_AT)


def table_round_trip(spark, d):
    """Overwrite, append, read back: every row twice."""
    target = {"format": "parquet", "path": f"{shared_dir(spark).rstrip('/')}/leadloom/sink-{uuid.uuid4().hex}"}
    rows = B.table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("order status"))
    T.write_table(rows, target, "orders", mode="overwrite")
    T.write_table(rows, target, "orders", mode="append")
    return T.read_table(spark, target, "orders").groupBy("order_status").agg(F.count("*").alias("n"))


def run_metadata(spark, d):
    orders = B.table(spark, d, "orders")
    facts = orders.agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("hits")).first()
    meta = T.run_metadata(
        spark, RUN_AT, train_samples=facts["n"], high_prob_contacts=facts["hits"], probability_threshold=0.5
    )
    return meta


def feature_list(spark, d):
    """Names of the numeric feature columns, one row each, with their null counts."""
    rows = B.table(spark, d, "lineitem")
    names = R.feature_columns(rows, ["l_orderkey", "l partkey", "l-suppkey"], "l_tax")
    counts = rows.agg(*[F.count(n).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("n_values")) for n in names])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def column_selection(spark, d):
    """Listed columns that exist, then listed drops; names that are absent do no harm."""
    rows = R.select_existing(B.table(spark, d, "orders"), ["o_orderkey", "no_such", "o_custkey", "o_orderstatus"])
    return R.drop_existing(rows, ["o_orderstatus", "gone"])


def text_categories(spark, d):
    """All categorical columns as text."""
    rows = B.table(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    return R.as_text(rows, ["p_size", "p_brand", "absent"])


def equality_flags(spark, d):
    rows = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return B.whole(R.flag_columns(rows, "l_returnflag", {"returned": "R", "accepted": "A", "none": "N"}).drop("l_returnflag"))


def known_contacts(spark, d):
    """Distinct contacts that have any event."""
    return B.meetings(spark, d).select("contact_id").distinct()


def model_columns(spark, d):
    """The numeric matrix a model sees: nulls as 0, sanitised names, no identifiers."""
    rows = B.contacts(spark, d).select(
        "contact_id", F.col("PageDirectoryArticles").alias("Page (articles)"), F.col("OnboardingId").alias("on-boarding id"), "Gender"
    )
    safe = R.sanitize_column_names(rows)
    names = R.feature_columns(safe, ["contact_id"], "Target")
    return B.whole(R.fill_by_type(safe, names).select("contact_id", *names))


QUERIES = {
    "column_selection": (column_selection, "SELECT o_orderkey, o_custkey FROM orders"),
    "text_categories": (text_categories, "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_brand FROM part"),
    "equality_flags": (
        equality_flags,
        """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_returnflag = 'R' AS BIGINT) AS returned,
        CAST(l_returnflag = 'A' AS BIGINT) AS accepted, CAST(l_returnflag = 'N' AS BIGINT) AS none FROM lineitem""",
    ),
    "known_contacts": (known_contacts, "SELECT DISTINCT o_custkey AS contact_id FROM orders"),
    "model_columns": (
        model_columns,
        _C + """SELECT contact_id, CAST(coalesce("PageDirectoryArticles", 0) AS BIGINT) AS "Page_articles",
        coalesce("OnboardingId", 0) AS on_boarding_id FROM contacts""",
    ),
    "onehot": (
        onehot,
        "SELECT c_custkey, " + ", ".join(f"CAST(c_mktsegment = '{s}' AS BIGINT) AS \"c_mktsegment_{s}\"" for s in _SEGMENTS) + " FROM customer",
    ),
    "onehot_with_null": (
        onehot_with_null,
        _C + "SELECT contact_id, " + ", ".join(
            f"CAST(coalesce(\"{c}\" = '{v}', false) AS BIGINT) AS \"{c}_{v}\""
            for c, values in (("Gender", ("Institution", "No", "Yes")), ("CampaignType", ("Awareness", "Lead Gen"))) for v in values
        ) + " FROM contacts",
    ),
    "topk_bucket_onehot": (topk_bucket_onehot, TOPK_SQL),
    "category_counts": (
        top_values,
        _C + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", "{c}" AS value, count(*) AS n FROM contacts WHERE "{c}" IS NOT NULL GROUP BY 2"""
            for c in ("Country", "AgeRange", "FirstPageSeen")
        ),
    ),
    "date_bin_onehot": (date_bin_onehot, DATE_ONEHOT_SQL),
    "label_encode": (
        label_encode,
        """WITH p AS (SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#1'), 'Unknown') AS b, p_type AS t FROM part)
        SELECT p_partkey, dense_rank() OVER (ORDER BY b) - 1 AS p_brand_encoded, dense_rank() OVER (ORDER BY t) - 1 AS p_type_encoded FROM p""",
    ),
    "label_encode_wide": (
        label_encode_wide, "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS c_name_encoded FROM customer"
    ),
    "contact_flags": (contact_flags, FLAGS_SQL),
    "targets": (targets, TARGETS_SQL),
    "missing_group_ratio": (
        missing_group_ratio, f"{_C} SELECT contact_id, round({_MISSING}, 6) AS missing_ratio FROM contacts"
    ),
    "drop_high_missing": (drop_high_missing, f"{_C} SELECT contact_id FROM contacts WHERE {_MISSING} < 0.6"),
    "width_profile": (width_profile, WIDTH_SQL),
    "int_widening": (
        int_widening,
        "SELECT o_orderkey, CAST(o_orderkey + 200000000000000 AS VARCHAR) AS far, -o_custkey AS near FROM orders",
    ),
    "clean_output": (clean_output, CLEAN_OUTPUT_SQL),
    "sanitize_names": (sanitize_names, "SELECT event_id, round(value, 6) AS value_usd FROM events"),
    "normalised_id": (normalised_id, 'SELECT c_custkey AS "HubSpotId", c_name FROM customer'),
    "run_stamp": (
        run_stamp,
        "SELECT c_custkey, TIMESTAMP '2001-08-02 06:30:05' AS created_at, '20010802_063005' AS pipeline_run_id FROM customer",
    ),
    "table_round_trip": (
        table_round_trip, "SELECT o_orderstatus AS order_status, 2 * count(*) AS n FROM orders GROUP BY 1"
    ),
    "run_metadata": (
        run_metadata,
        """SELECT '20010802_063005' AS model_id, TIMESTAMP '2001-08-02 06:30:05' AS training_date, count(*) AS train_samples,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS high_prob_contacts, CAST(0.5 AS DOUBLE) AS probability_threshold FROM orders""",
    ),
    "feature_list": (
        feature_list,
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count({c}) AS n_values FROM lineitem"
            for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
        ),
    ),
}
