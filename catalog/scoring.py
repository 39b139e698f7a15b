"""Folds, evaluation, action lists and summaries on given labels and stand-in scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from leadloom.operators import enrichment
from leadloom.operators import evaluation as V
from leadloom.operators import explain as P
from leadloom.operators import frames as R
from leadloom.operators import ranking as K
from leadloom.session import run_folder, spread
from leadloom.sources import tables


def stratified_folds(spark, d):
    return B.whole(K.stratified_folds(B.table(spark, d, "labels"), "doc_id", "quality").select("doc_id", "quality", "fold"))


def order_folds(spark, d):
    """Folds of a large table in three uneven classes."""
    rows = B.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return B.whole(K.stratified_folds(rows, "o_orderkey", "o_orderstatus", k=7, seed=3))


def _folds_sql(table: str, key: str, label: str, k: int, seed: int) -> str:
    return f"""SELECT {key}, CAST({label} AS {{t}}) AS {label}, (row_number() OVER (PARTITION BY {label}
      ORDER BY md5(concat_ws('|', {key}, '{seed}')), {key}) - 1) % {k} AS fold FROM {table}"""


def holdout(spark, d):
    return B.whole(K.holdout(B.table(spark, d, "labels"), "doc_id", "quality").select("doc_id", "quality", "is_test"))


HOLDOUT_SQL = """SELECT doc_id, CAST(quality AS BIGINT) AS quality,
  row_number() OVER (PARTITION BY quality ORDER BY md5(concat_ws('|', doc_id, '42')), doc_id) - 1
    < 0.2 * count(*) OVER (PARTITION BY quality) AS is_test FROM labels"""


def class_weights(spark, d):
    return B.tidy(V.class_weights(B.table(spark, d, "labels"), "quality"))


def _scored(spark, d):
    rows = B.table(spark, d, "labels").join(B.table(spark, d, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    return rows.select(
        "doc_id", "quality", "lang", "n_chars", F.round(F.col("n_chars") / 500).alias("s"), (F.col("n_chars") > 2000).cast("int").alias("p")
    )


_SCORED = """s AS (SELECT doc_id, quality, lang, n_chars, round(n_chars / 500) AS s, CAST(n_chars > 2000 AS INT) AS p
  FROM labels JOIN documents USING (doc_id))"""


def confusion(spark, d):
    return B.whole(V.confusion(_scored(spark, d), "quality", "p"))


def classification_report(spark, d):
    return B.tidy(V.classification_report(_scored(spark, d), "quality", "p"))


REPORT_SQL = f"""WITH {_SCORED}, k AS (SELECT 0 AS cls UNION ALL SELECT 1),
c AS (SELECT cls, sum(CAST(quality = cls AND p = cls AS INT)) AS tp, sum(CAST(p = cls AS INT)) AS pp, sum(CAST(quality = cls AS INT)) AS support
      FROM s, k GROUP BY cls),
m AS (SELECT *, CASE WHEN pp = 0 THEN 0 ELSE tp / pp END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m),
r AS (SELECT CAST(cls AS VARCHAR) AS label, precision, recall, f1, support FROM f
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM f
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM f)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r"""


def binary_metrics(spark, d):
    return B.tidy(V.binary_metrics(_scored(spark, d), "quality", "p"))


BINARY_SQL = f"""WITH {_SCORED}, c AS (SELECT count(*) AS n, sum(quality * p) AS tp, sum(p) AS pp, sum(quality) AS ap,
  sum(CAST(quality = p AS INT)) AS hit FROM s)
SELECT n AS n_rows, round(hit / n, 6) AS accuracy, round(CASE WHEN pp = 0 THEN 0 ELSE tp / pp END, 6) AS precision,
  round(CASE WHEN ap = 0 THEN 0 ELSE tp / ap END, 6) AS recall, round(CASE WHEN pp + ap = 0 THEN 0 ELSE 2 * tp / (pp + ap) END, 6) AS f1 FROM c"""


def roc_auc(spark, d):
    return B.tidy(V.roc_auc(_scored(spark, d), "quality", "s"))


def roc_auc_by_group(spark, d):
    """One area per priority class of the orders; the score has nearly as many values as rows."""
    rows = B.table(spark, d, "orders").select(
        "o_orderpriority", "o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("y")
    )
    return B.tidy(V.roc_auc(rows, "y", "o_totalprice", by=["o_orderpriority"]))


def _auc_sql(source: str, y: str, s: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    pre = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""r AS (SELECT {pre}{y} AS y, rank() OVER ({part} ORDER BY {s}) + (count(*) OVER (PARTITION BY {pre}{s}) - 1) / 2.0 AS r FROM {source}),
      t AS (SELECT {pre}sum(y) AS n_pos, sum(1 - y) AS n_neg, sum(CASE WHEN y = 1 THEN r END) AS w FROM r {group})
      SELECT {pre}CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
        round(CAST((w - n_pos * (n_pos + 1) / 2.0) / (CAST(n_pos AS DOUBLE) * n_neg) AS DOUBLE), 6) AS auc FROM t"""


def action_list(spark, d):
    """Customers with a score of one half or more, qualified stages only."""
    rows = B.contacts(spark, d).join(
        B.table(spark, d, "customer").select(F.col("c_custkey").alias("contact_id"), (F.col("c_acctbal") / 10000).alias("score")),
        "contact_id",
    )
    return B.tidy(K.action_list(rows, "score", "contact_id", ["CreateDate", "ContactType"], 0.5, stage="LeadStageNewCEO"))


ACTION_SQL = f"""WITH {B.CONTACTS_SQL} SELECT contact_id, "CreateDate", "ContactType", round(c_acctbal / 10000, 6) AS score,
  row_number() OVER (ORDER BY c_acctbal / 10000 DESC, contact_id) AS rank
FROM contacts JOIN customer ON c_custkey = contact_id
WHERE c_acctbal / 10000 >= 0.5 AND lower("LeadStageNewCEO") LIKE '%sql%'"""


def seeded_sample(spark, d):
    return K.seeded_sample(B.table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 100)


def top_importance(spark, d):
    rows = B.table(spark, d, "part").groupBy(F.col("p_brand").alias("feature")).agg(
        F.round(F.avg("p_retailprice"), 4).alias("importance")
    )
    return B.tidy(K.top_importance(rows, 20))


def mean_abs_contribution(spark, d):
    """Mean absolute value by feature over every row, whatever its size."""
    rows = B.table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("feature"), (F.col("l_discount") - F.lit(0.05)).alias("contribution")
    )
    return B.tidy(P.mean_abs_contribution(rows))


def validation_summary(spark, d):
    return B.tidy(R.summary(B.table(spark, d, "orders"), "o_totalprice"))


def value_counts(spark, d):
    return R.value_counts(B.table(spark, d, "orders"), "o_orderpriority")


def distinct_count(spark, d):
    return R.distinct_count(B.table(spark, d, "events"), "user_id")


def score_summary(spark, d):
    rows = B.table(spark, d, "lineitem").select((F.col("l_discount") * 10).alias("score"))
    return B.tidy(V.score_summary(rows, "score"))


def best_order(spark, d):
    """The single highest-priced order."""
    return B.tidy(B.table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1))


def enrichment_errors(spark, d):
    return P.enrichment_errors(B.contacts(spark, d), ["LeadStageNew", "PreferredLanguage"])


def _opening(row: dict) -> str | None:
    """A stand-in for a text service: no answer, an error or a line about the document."""
    if row["doc_id"] % 97 == 0:
        raise RuntimeError("service refused")
    return None if row["doc_id"] % 89 == 0 else f"{row['lang']}: {row['n_chars']} characters from {row['source']}"


def guarded_enrichment(spark, d):
    """One guarded call for each document; planted ids fail on every attempt and the run goes on."""
    docs = B.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = enrichment.enriched(spread(docs), _opening, ["doc_id", "lang", "source", "n_chars"], retries=1)
    return rows.select("doc_id", "pitch", F.substring_index("pitch_error", ":", 1).alias("error"), "pitch_attempts")


def enrichment_counts(spark, d):
    """The counts that the same pass observes."""
    docs = B.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    _, counts = enrichment.enrich(spread(docs), _opening, ["doc_id", "lang", "source", "n_chars"], retries=1)
    return spark.createDataFrame([(counts["rows"], counts["failed"], counts["attempts"])], "n_rows bigint, n_failed bigint, n_attempts bigint")


def action_preview(spark, d):
    """The first ten rows of the action list."""
    return action_list(spark, d).filter(F.col("rank") <= 10)


def staged_replacement(spark, d):
    """A written table, the same table after a write that fails halfway, and after an empty result has replaced it."""
    customers = B.table(spark, d, "customer").select("c_custkey", "c_name")
    with run_folder(spark) as folder:
        target = {"format": "parquet", "path": folder}

        def held(step: str) -> tuple:
            return step, tables.read_table(spark, target, "customers").count()

        tables.write_table(customers, target, "customers")
        steps = [held("written")]
        broken = customers.withColumn("c_name", F.when(F.col("c_custkey") % 50 == 7, F.raise_error(F.lit("planted"))).otherwise(F.col("c_name")))
        try:
            tables.write_table(broken, target, "customers")
        except Exception:
            steps.append(held("failed"))
        tables.write_table(customers.filter("c_custkey < 0"), target, "customers")
        steps.append(held("emptied"))
    return spark.createDataFrame(steps, "step string, n_rows bigint")


_ENRICHED = "SELECT *, doc_id % 97 = 0 AS refused, doc_id % 89 = 0 AS silent FROM documents"


QUERIES = {
    "stratified_folds": (stratified_folds, _folds_sql("labels", "doc_id", "quality", 5, 42).format(t="BIGINT")),
    "order_folds": (order_folds, _folds_sql("orders", "o_orderkey", "o_orderstatus", 7, 3).format(t="VARCHAR")),
    "holdout_split": (holdout, HOLDOUT_SQL),
    "class_weights": (
        class_weights,
        """SELECT n0, n1, round(n0 / greatest(n1, 1), 6) AS pos_weight FROM (
        SELECT count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1 FROM labels)""",
    ),
    "confusion": (
        confusion,
        f"WITH {_SCORED} SELECT CAST(quality AS BIGINT) AS y_true, CAST(p AS BIGINT) AS y_pred, count(*) AS n FROM s GROUP BY 1, 2",
    ),
    "confusion_report": (classification_report, REPORT_SQL),
    "binary_metrics": (binary_metrics, BINARY_SQL),
    "roc_auc": (roc_auc, f"WITH {_SCORED}, " + _auc_sql("s", "quality", "s")),
    "roc_auc_by_group": (
        roc_auc_by_group,
        "WITH o AS (SELECT o_orderpriority, o_totalprice, CAST(o_orderstatus = 'F' AS INT) AS y0 FROM orders), "
        + _auc_sql("o", "y0", "o_totalprice", "o_orderpriority"),
    ),
    "action_list": (action_list, ACTION_SQL),
    "seeded_sample": (
        seeded_sample,
        "SELECT doc_id, lang FROM documents ORDER BY md5(concat_ws('|', doc_id, '42')), doc_id LIMIT 100",
    ),
    "top_importance": (
        top_importance,
        """SELECT p_brand AS feature, round(avg(p_retailprice), 4) AS importance FROM part GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 20""",
    ),
    "mean_abs_contribution": (
        mean_abs_contribution,
        "SELECT l_returnflag AS feature, round(avg(abs(l_discount - 0.05)), 6) AS mean_abs_shap FROM lineitem GROUP BY 1",
    ),
    "validation_summary": (
        validation_summary,
        """SELECT count(*) AS n_rows, count(o_totalprice) AS n_values, round(avg(o_totalprice), 6) AS mean,
        min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders""",
    ),
    "value_counts": (value_counts, "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1"),
    "distinct_count": (distinct_count, "SELECT count(DISTINCT user_id) AS n_distinct FROM events"),
    "score_summary": (
        score_summary,
        """SELECT count(*) AS n_rows, round(avg(s), 6) AS mean_score, min(s) AS min_score, max(s) AS max_score,
        count(*) FILTER (WHERE s >= 0.5) AS n_high FROM (SELECT l_discount * 10 AS s FROM lineitem)""",
    ),
    "best_order": (
        best_order, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1"
    ),
    "enrichment_errors": (
        enrichment_errors,
        f"""WITH {B.CONTACTS_SQL} SELECT count(*) AS n_rows,
        count(*) FILTER (WHERE "LeadStageNew" IS NULL OR "PreferredLanguage" IS NULL) AS n_empty FROM contacts""",
    ),
    "guarded_enrichment": (
        guarded_enrichment,
        f"""SELECT doc_id, CASE WHEN refused OR silent THEN '' ELSE concat(lang, ': ', n_chars, ' characters from ', source) END AS pitch,
        CASE WHEN refused THEN 'RuntimeError' WHEN silent THEN 'ValueError' END AS error,
        CAST(CASE WHEN refused OR silent THEN 2 ELSE 1 END AS INTEGER) AS pitch_attempts FROM ({_ENRICHED})""",
    ),
    "enrichment_counts": (
        enrichment_counts,
        f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE refused OR silent) AS n_failed,
        count(*) + count(*) FILTER (WHERE refused OR silent) AS n_attempts FROM ({_ENRICHED})""",
    ),
    "action_preview": (action_preview, f"SELECT * FROM ({ACTION_SQL}) WHERE rank <= 10"),
    "staged_replacement": (
        staged_replacement,
        """SELECT 'written' AS step, count(*) AS n_rows FROM customer UNION ALL SELECT 'failed', count(*) FROM customer
        UNION ALL SELECT 'emptied', 0""",
    ),
}
