from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadloom.functions import dates as D
from leadloom.operators import frames as R


def test_floor_days_rounds_down(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-02 10:00:00", "2024-01-02 00:00:00", -1),
            ("2024-01-02 10:00:00", "2024-01-02 10:00:00", 0),
            ("2024-01-02 10:00:00", "2024-01-03 09:00:00", 0),
            ("2024-01-02 10:00:00", "2024-01-03 10:00:00", 1),
            ("2024-01-02 10:00:00.000001", "2024-01-03 10:00:00", 0),
            ("2024-01-02 10:00:00", "2024-01-02 09:59:59.999999", -1),
            ("0001-01-01 00:00:00", "9999-12-31 00:00:00", 3652058),
            (None, "2024-01-01 00:00:00", None),
        ],
        "a string, b string, want bigint",
    )
    for r in df.select(D.floor_days(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("d"), "want").collect():
        assert r["d"] == r["want"]


def test_floor_days_ignores_daylight_saving(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-09 12:00:00' AS a, timestamp_ntz'2024-03-10 12:00:00' AS b")
        assert df.select(D.floor_days("a", "b").alias("d")).first()["d"] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_filters_keep_or_drop_nulls(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "Lead"), (3, "SAL 1")], "id int, LeadStageNewCEO string")
    assert rows(R.not_equal_keep_null(df, "LeadStageNewCEO", "Lead").select("id")) == [(1,), (3,)]


def test_conversion_filter_precedence(spark, rows):
    cols = "HubSpotId bigint, OnboardingId bigint, LeadStageNew string, ClientType string, LeadStageNewCEO string, ContactType string"
    df = spark.createDataFrame(
        [
            (1, 10, "Committed Capital", "A", None, "Z"),      # first arm only
            (2, None, None, "B", "SAL 1", "A"),                # second arm only
            (3, 10, "Committed Capital", "A", "SAL 2", "B"),   # both
            (4, None, "Committed Capital", "A", "SQL 1", "A"), # neither
            (5, 99, "Committed Capital", "A", None, "A"),      # excluded id
            (6, 10, "Committed Capital", "B", None, "A"),      # listed id
            (7, None, None, None, "SAL 1", "Z"),               # type test guards the second arm
            (None, 10, "Committed Capital", "B", None, "A"),
        ],
        cols,
    )
    got = R.conversion_filter(df, ("A", "B"), "A", excluded_ids=(99,), extra_ids=(6,))
    assert rows(got.select("HubSpotId")) == [(1,), (2,), (3,), (6,)]


def test_lead_filter(spark, rows):
    df = spark.createDataFrame(
        [(1, "SQL 1", "Not Found", "A"), (2, "Lead", "Not Found", "A"), (3, "SAL 2", "Found", "A"), (4, "SAL 2", None, "A"), (5, "SAL 2", "Not Found", "C")],
        "id int, LeadStageNewCEO string, IsThisLeadAlreadyFoundInAnInternalDatabase string, ContactType string",
    )
    assert rows(R.lead_filter(df, ("A", "B")).select("id")) == [(1,)]


def test_fill_defaults_is_typed_and_ignores_missing_columns(spark):
    df = spark.createDataFrame([(None, None)], "AgeRange string, n int")
    got = R.fill_defaults(df, {"AgeRange": 0, "n": 0, "absent": 1})
    assert tuple(got.first()) == ("0", 0) and got.columns == ["AgeRange", "n"]
    with pytest.raises(ValueError):
        R.fill_defaults(df, {"absent": 1}, strict=True)


def test_fill_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a int, b string, c boolean, d timestamp_ntz")
    assert tuple(R.fill_by_type(df).first()) == (0, "", False, None)


def test_days_since_uses_missing_value_and_drops_source(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", None, "junk")], "a string, b string, c string")
    df = df.withColumns({"a": F.col("a").cast("timestamp_ntz"), "b": F.col("b").cast("timestamp_ntz")})
    got = R.days_since(df, ["a", "b", "c", "absent"], "2024-01-03 09:00:00").first().asDict()
    assert got == {"a_days": 1, "b_days": 999, "c_days": 999}


def test_date_bins_edges_and_young_tables(spark):
    times = ["2020-01-01", "2021-06-30", "2021-07-01", "2022-12-30", "2022-12-31", "2023-01-01", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("CreateDate", F.col("t").cast("timestamp_ntz"))
    got = {r["t"]: r["CreateDate_Bins"] for r in R.date_bins(df, "CreateDate", "2023-01-01").collect()}
    assert got["2020-01-01"] == "0 to 1.5 years ago"
    assert got["2021-06-30"] == "0 to 1.5 years ago"
    assert got["2021-07-01"] == "1.5 to 2 years ago"
    assert got["2022-12-30"] == "2.5 to 3 years ago"
    assert got["2022-12-31"] == "3+ years ago"
    assert got["2023-01-01"] is None and got[None] is None
    young = R.date_bins(df.filter(F.col("t") > "2022-12-01"), "CreateDate", "2023-01-01")
    assert {r["CreateDate_Bins"] for r in young.collect()} == {"0 to 1.5 years ago", None}


def test_left_attach_guards_names_and_null_keys(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id bigint, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (None, "r")], "id bigint, x string")
    with pytest.raises(ValueError):
        R.left_attach(left, right, "id")
    got = R.left_attach(left, right, "id", {"R_x": "none"}, prefix="R_")
    assert rows(got.select("x", "R_x")) == [("a", "p"), ("a", "q"), ("b", "none"), ("c", "none")]


@pytest.mark.parametrize("limit", [1000, 3])
def test_known_and_unknown_keys_under_skew(spark, rows, limit):
    keys = [7] * 400 + [8] * 300 + list(range(100, 150)) + [None] * 5
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k bigint")
    ids = spark.createDataFrame([(k,) for k in (7, 7, 101, 102, 149, 999, None)], "k bigint")
    known = {7, 101, 102, 149}
    kept = R.keep_known(df, ids, "k", broadcast_limit=limit)
    assert rows(kept) == sorted(((i, k) for i, k in enumerate(keys) if k in known), key=repr)
    dropped = R.drop_known(df, ids, "k", broadcast_limit=limit)
    assert rows(dropped) == sorted(((i, k) for i, k in enumerate(keys) if k not in known), key=repr)
    assert {7, 8} <= set(R.hot_keys(df, "k"))


def test_missing_ratio_thresholds(spark):
    groups = {f"g{i}": [f"c{i}"] for i in range(9)} | {"g9": ["absent"]}
    cols = ", ".join(f"c{i} int" for i in range(9))
    df = spark.createDataFrame([tuple([0] * 8 + [1]), tuple([0] * 7 + [1, 1])], cols)
    ratios = sorted(r["missing_ratio"] for r in R.missing_ratio(df, groups).collect())
    assert ratios == [0.7, 0.8]
    assert R.drop_high_missing(df, groups, 0.8).count() == 1


def test_duplicate_and_unsafe_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    named = df.toDF("Score", "score", "a b", "a-b")
    assert R.drop_duplicate_columns(named).columns == ["Score", "a b", "a-b"]
    assert R.sanitize_column_names(named).columns == ["Score", "score", "a_b"]
    assert R.clean_output_names(df.toDF("x & y", "p-q", "r", "s")).columns == ["x_and_y", "p_q", "r", "s"]
    assert R.clean_output_names(df.toDF("x & y", "p-q", "r", "s"), amp=None).columns == ["x_&_y", "p_q", "r", "s"]


def test_clean_output_values(spark):
    df = spark.createDataFrame([("nan", None, "nano")], "a string, b string, c string").withColumn(
        "t", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    got = R.clean_output_values(df)
    assert tuple(got.first())[:3] == ("", "", "nano")
    assert dict(got.dtypes)["t"] == "timestamp_ntz"


def test_feature_columns_match_cleaned_names(spark):
    df = spark.createDataFrame([(1, 2.0, 3, True)], "Top_Up_Frequency int, x double, y int, z boolean")
    assert R.feature_columns(df, ["Top Up Frequency"], "y") == ["x"]


def test_normalise_id(spark):
    df = spark.createDataFrame([(1,)], "`Client ID` int")
    assert R.normalise_id(df, ["Client_ID", "Client ID"], "HubSpotId").columns == ["HubSpotId"]
    with pytest.raises(ValueError):
        R.normalise_id(df, ["other"], "HubSpotId")


def test_stamp_run(spark):
    got = R.stamp_run(spark.range(1), datetime(2024, 3, 5, 6, 7, 8)).first()
    assert got["pipeline_run_id"] == "20240305_060708" and got["created_at"] == datetime(2024, 3, 5, 6, 7, 8)


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "id int, CreateDate timestamp_ntz, s string")
    assert R.date_bins(empty, "CreateDate", "2024-01-01").count() == 0
    assert R.days_since(empty, ["CreateDate"], "2024-01-01").count() == 0
    assert R.summary(empty, "id").first()["n_rows"] == 0
