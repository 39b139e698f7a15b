"""Segments, outliers, models, explanations and the three complete plans.

Results of iterative fits have no SQL counterpart. Where a fit has a property that SQL can
state for every row (coverage, additivity, share), a second query checks that property.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog import base as B
from catalog.text import clean_sql
from leadloom.functions import text as X
from leadloom.operators import clustering as C
from leadloom.operators import explain as P
from leadloom.operators import frames as R
from leadloom.operators import modelling as M
from leadloom.operators import outliers as O
from leadloom.operators import ranking as K
from leadloom.operators import search
from leadloom.operators import target_stats as T
from leadloom.operators.boosting import best_trees
from leadloom.plans import conversion, lead, topup
from leadloom.plans.jobs import prepared
from leadloom.session import materialise, shared_dir, spread, steps_dir, training_table

AS_OF = datetime(2001, 8, 2)
#: All eight ranges of the search; only the number of trees is cut, because a fit at the full number takes minutes.
QUICK_SPACE = {**M.SEARCH_SPACE, "maxIter": (4, 8, "int")}
#: For the whole plans, which fit a dozen models each.
PLAN_SPACE = {**M.SEARCH_SPACE, "maxIter": (2, 3, "int")}


# --- segments and outliers -----------------------------------------------------------


def _customer_numbers(spark, d):
    orders = B.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent"), F.max("o_totalprice").alias("largest")
    )
    customers = B.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return R.left_attach(customers, orders, "c_custkey", {"n_orders": 0, "spent": 0, "largest": 0})


def kmeans_segments(spark, d):
    """Every customer has the flag of its segment alone; segments are numbered by size."""
    rows = materialise(C.segment_entities(_customer_numbers(spark, d), ["c_acctbal", "n_orders", "spent", "largest"]))
    flags = F.array(*[F.col(f"SegmentClass_{i}") for i in range(4)])
    one = (F.aggregate(flags, F.lit(0), lambda a, x: a + x) == 1) & (F.element_at(flags, F.col("SegmentClass") + 1) == 1)
    sizes = rows.groupBy("SegmentClass").agg(F.count("*").alias("n"))
    placed = sizes.select("SegmentClass", (F.row_number().over(Window.orderBy(F.desc("n"), "SegmentClass")) - 1 == F.col("SegmentClass")).alias("by_size"))
    return rows.join(placed, "SegmentClass").select("c_custkey", one.alias("one_flag"), "by_size")


def kmeans_properties(spark, d):
    """Every customer sits in the segment with the nearest centre; numbers follow segment size."""
    rows = _customer_numbers(spark, d).select("c_custkey", F.array("c_acctbal", "n_orders", "spent", "largest").alias("x"))
    table = materialise(rows.withColumn("v", array_to_vector(F.transform("x", lambda a: a.cast("double")))))
    clusters = C.fit_clusters(table, "v", 4, restarts=10)
    placed = C.assign_nearest(clusters.assign(table), "x", clusters.centroids())
    sizes = placed.groupBy("segment").agg(F.count("*").alias("n"), F.count_if(F.col("segment") == F.col("nearest")).alias("ok"))
    ranked = sizes.withColumn("r", F.row_number().over(Window.orderBy(F.desc("n"), "segment")) - 1)
    return ranked.agg(
        F.sum("n").alias("n_rows"), F.sum("ok").alias("n_nearest"), F.count_if(F.col("r") == F.col("segment")).alias("n_in_order")
    )


def note_clusters(spark, d):
    """Every document is in one of the three segments, -1 exactly where cleaning leaves nothing; equal texts share theirs."""
    rows = materialise(C.segment_notes_by_text(B.table(spark, d, "documents").select("doc_id", "text"), "text"))
    alike = rows.groupBy(F.sha2("text", 256).alias("h")).agg((F.min("NoteSegment") == F.max("NoteSegment")).alias("alike"))
    placed = rows.select("doc_id", F.sha2("text", 256).alias("h"), F.col("NoteSegment").between(0, 2).alias("clustered"))
    return placed.join(alike, "h").drop("h")


def note_cluster_coverage(spark, d):
    """Every document gets a segment, -1 exactly where cleaning leaves nothing."""
    rows = C.segment_notes_by_text(B.table(spark, d, "conversations"), "text", min_df=2)
    return B.whole(rows.select("conv_id", "turn", (F.col("NoteSegment") >= 0).alias("clustered")))


def embedding_clusters(spark, d):
    """Every vector is in one of three segments, numbered by size."""
    rows = B.table(spark, d, "embeddings").withColumn("note", F.lit("note"))
    found = materialise(C.segment_notes_by_text(rows, "note", embedding="embedding").select("vec_id", "NoteSegment"))
    sizes = found.groupBy("NoteSegment").agg(F.count("*").alias("n"))
    placed = sizes.select("NoteSegment", (F.row_number().over(Window.orderBy(F.desc("n"), "NoteSegment")) - 1 == F.col("NoteSegment")).alias("by_size"))
    return found.join(placed, "NoteSegment").select("vec_id", F.col("NoteSegment").between(0, 2).alias("clustered"), "by_size")


def batch_clusters(spark, d):
    """Mini-batch clusters of the embeddings: as good as full k-means but for a tenth of the cost, the same on another layout."""
    rows = B.table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    rows = materialise(rows)
    found = C.fit_clusters_in_batches(rows, "v", 3, batch=256, batches=15)
    again = C.fit_clusters_in_batches(rows.repartition(7), "v", 3, batch=256, batches=15)
    full = C.fit_clusters(rows, "v", 3, restarts=3)

    def cost(clusters):
        near = C.assign_nearest(rows.withColumn("x", vector_to_array("v")), "x", clusters.centroids(), distance="d")
        return near.agg(F.sum(F.col("d") * F.col("d"))).first()[0]

    close = cost(found) <= 1.1 * cost(full)
    same = found.centroids() == again.centroids()
    return found.assign(rows, "segment").select("vec_id", F.col("segment").between(0, 2).alias("clustered"), F.lit(close).alias("close"), F.lit(same).alias("same"))


def outlier_flags(spark, d):
    """Flagged are exactly the customers whose score is above the interpolated 95 % quantile of the scores."""
    rows = materialise(O.outlier_flags(_customer_numbers(spark, d), "c_custkey", ["c_acctbal", "n_orders", "spent", "largest"]))
    cut = rows.agg(F.percentile("outlier_score", 0.95)).first()[0]
    above = (F.col("outlier_score") > F.lit(cut + 1e-12)).cast("int")
    return rows.select("c_custkey", F.col("outlier_score").between(0.0, 1.0).alias("in_range"), (above == F.col("is_outlier")).alias("as_scored"))


def outlier_share(spark, d):
    """The flagged share of lineitem rows is the contamination asked for."""
    rows = B.table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"), "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    flagged = O.outlier_flags(rows, "id", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return flagged.agg(
        F.count("*").alias("n_rows"),
        (F.abs(F.sum("is_outlier") / F.count("*") - F.lit(0.05)) < F.lit(0.002)).alias("as_asked"),
    )


def price_quantile(spark, d):
    """Exact interpolated quantile of a large column."""
    orders = B.table(spark, d, "orders")
    value = O.exact_quantile(orders, "o_totalprice", 0.95, small=200)
    return orders.agg(F.count_if(F.col("o_totalprice") > F.lit(value)).alias("n_above"), F.round(F.lit(value), 4).alias("q95"))


# --- models on the labelled documents -------------------------------------------------

_NUMERIC = ["n_chars", "n_words", "toxic"]
_TEXT = ["lang", "source"]


def _documents(spark, d):
    rows = B.table(spark, d, "labels").join(B.table(spark, d, "documents"), "doc_id")
    rows = spread(rows).withColumn("n_words", F.size(X.note_tokens("text"))).drop("text")
    rows = materialise(K.stratified_folds(rows, "doc_id", "quality"))
    plan = M.fit_features(rows, _NUMERIC, _TEXT)
    return plan, training_table(plan.apply(rows).withColumn("label", F.col("quality")))


def _make():
    return M.propensity_pipeline(pos_weight=2.0, maxIter=4, maxDepth=3)


def gbt_oof_scores(spark, d):
    """The score of each document equals that of a model fitted anew on the rows outside its fold."""
    _, table = _documents(spark, d)
    scored, _ = M.oof_scores(table, _make)
    again = None
    for f in range(5):
        model = _make().fit(table.filter(F.col("fold") != f))
        part = M.score(table.filter(F.col("fold") == f), model, "again").select("doc_id", "again")
        again = part if again is None else again.unionByName(part)
    both = scored.join(again, "doc_id")
    return B.whole(both.select("doc_id", "fold", "quality", (F.abs(F.col("oof_probability") - F.col("again")) < 1e-9).alias("unseen")))


def oof_coverage(spark, d):
    """Each labelled document has exactly one out-of-fold score, from its own fold."""
    _, table = _documents(spark, d)
    scored, _ = M.oof_scores(table, _make)
    valid = F.col("oof_probability").between(0.0, 1.0) & (
        F.col("oof_prediction") == (F.col("oof_probability") > 0.5).cast("int")
    )
    return B.whole(
        scored.groupBy("doc_id").agg(
            F.count("*").alias("n_scores"), F.max("fold").alias("fold"), F.bool_and(valid).alias("consistent")
        )
    )


def search_trials(spark, d):
    """Every trial draws all eight parameters inside their ranges, and is complete exactly if it was judged on all folds."""
    _, table = _documents(spark, d)
    drawn = F.col("value").between(0.0, 1.0) & (F.col("std") >= 0)
    for name, (low, high, _) in M.SEARCH_SPACE.items():
        low, high = QUICK_SPACE[name][:2] if name == "maxIter" else (low, high)
        drawn = drawn & F.col(f"params_{name}").between(low, high)
    rows = M.search(table, QUICK_SPACE, trials=4, batch=2, startup=2).trials
    judged = (F.col("state") == "COMPLETE") == (F.col("folds") == 5)
    return B.whole(rows.select("number", drawn.alias("in_range"), judged.alias("by_state")))


def adaptive_search(spark, d):
    """The sampler on an objective that is cheap to judge: which discount and quantity limits hold a quarter of the revenue.

    A second run gives the same trials, later trials lie in the better region, and halving ends some of them.
    """
    lines = B.table(spark, d, "lineitem")
    cells = lines.groupBy(F.col("l_quantity").cast("double").alias("q"), F.col("l_discount").cast("double").alias("x")).agg(F.sum("l_extendedprice").cast("double").alias("v"))
    found = cells.collect()  # 50 quantities by 11 discounts
    total = sum(r["v"] for r in found)

    def scores(jobs):
        return [-abs(sum(r["v"] for r in found if r["q"] <= p["q"] + 0.5 * rung and r["x"] <= p["x"]) / total - 0.25) for p, rung in jobs]

    space = {"q": (1.0, 50.0, "linear"), "x": (0.001, 0.1, "log")}
    runs = [search.optimise(scores, space, trials=60, rungs=3, seed=7) for _ in range(2)]
    first, later = ([t.scores[0] for t in runs[0][i : i + 20]] for i in (0, 40))
    plain = [(t.number, t.params, t.scores, t.state) for t in runs[0]]
    rows = [
        ("same_again", plain == [(t.number, t.params, t.scores, t.state) for t in runs[1]]),
        ("later_better", sum(later) > sum(first)),
        ("halved", 0 < sum(t.state == search.ENDED for t in runs[0]) < 60),
        ("near_target", search.best_of(runs[0]).value > -0.05),
    ]
    return spark.createDataFrame(rows, "property string, holds boolean")


def ordered_target_statistics(spark, d):
    """Shares of good documents by language, source and length (a nearly unique column): ordered where there is a label."""
    docs = B.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = docs.join(B.table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    found = T.target_statistics(rows, "doc_id", ["lang", "source", "n_chars"], "quality")
    return found.select("doc_id", *[F.round(f"{c}_target", 9).alias(f"{c}_target") for c in ("lang", "source", "n_chars")])


def _target_sql(column: str) -> str:
    value = f"coalesce(CAST({column} AS VARCHAR), '')"
    order = "ORDER BY md5(concat_ws('|', doc_id, '42')), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    before = f"OVER (PARTITION BY {value}, quality IS NULL {order})"
    whole = f"OVER (PARTITION BY {value})"
    ordered = f"(coalesce(sum(quality) {before}, 0) + p) / (count(quality) {before} + 1)"
    return f"round(CASE WHEN quality IS NULL THEN (coalesce(sum(quality) {whole}, 0) + p) / (count(quality) {whole} + 1) ELSE {ordered} END, 9) AS {column}_target"


ORDERED_TARGET_SQL = f"""WITH r AS (SELECT d.doc_id, lang, source, n_chars, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
o AS (SELECT avg(CAST(quality AS DOUBLE)) AS p FROM r)
SELECT doc_id, {_target_sql('lang')}, {_target_sql('source')}, {_target_sql('n_chars')} FROM r, o"""


def early_stopping(spark, d):
    """Trees kept are those up to the lowest held-out loss, with patience, of one long fit; the scores are equal."""
    _, table = _documents(spark, d)
    held = materialise(M.eval_slice(table, "doc_id", 0.25))
    params = {"maxDepth": 3, "stepSize": 0.3, "maxIter": 12}
    model = M.propensity_pipeline(eval_col="is_eval", patience=2, **params).fit(held)
    whole = M.propensity_pipeline(**params).fit(held.filter("NOT is_eval"))
    kept = M.trees_of(model).getNumTrees
    right = kept == best_trees(M.held_out_losses(whole, held.filter("is_eval")), 2)[0]
    same = M.score(held, M.first_trees(whole, kept)).select("doc_id", F.col("probability").alias("p"))
    joined = M.score(held, model).join(same, "doc_id")
    return joined.select("doc_id", (F.abs(F.col("probability") - F.col("p")) < 1e-9).alias("same"), F.lit(right).alias("up_to_lowest"))


def fold_importance(spark, d):
    """One row a feature: the mean of the folds' importances, which are shares of one."""
    plan, table = _documents(spark, d)
    _, models = M.oof_scores(table, _make)
    found = M.fold_importance(spark, models, plan.names)
    single = [M.importance_table(spark, m, plan.names) for m in models]
    total = single[0]
    for one in single[1:]:
        total = total.unionAll(one)
    means = total.groupBy("feature").agg(F.avg("importance").alias("mean"), F.min("importance").alias("least"))
    share = F.sum("importance").over(Window.partitionBy())
    both = found.join(means, "feature").withColumn("all", share)
    close = F.abs(F.col("mean") - F.col("importance")) < 1e-9
    return both.select("feature", close.alias("mean_of_folds"), ((F.col("least") >= 0) & (F.abs(F.col("all") - 1) < 1e-9)).alias("shares"))


def shap_summary(spark, d):
    """The mean absolute contribution of each feature is that of its place in the rows' arrays; unused features have none."""
    plan, table = _documents(spark, d)
    model = _make().fit(table)
    explained = materialise(P.contributions(table, model, len(plan.names)).select("doc_id", "contributions"))
    found = P.mean_abs_contribution(P.contribution_rows(explained, "doc_id", plan.names))
    cells = [F.struct(F.lit(n).alias("feature"), F.avg(F.abs(F.col("contributions")[i])).alias("mean")) for i, n in enumerate(plan.names)]
    means = explained.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).select(F.inline(F.array(*[f"c{i}" for i in range(len(cells))])))
    both = found.join(means, "feature").join(M.importance_table(spark, model, plan.names), "feature")
    return both.select(
        "feature", (F.abs(F.col("mean_abs_shap") - F.col("mean")) < 1e-9).alias("as_rows"),
        ((F.col("importance") > 0) == (F.col("mean_abs_shap") > 0)).alias("as_used"),
    )


def contribution_additivity(spark, d):
    """Contributions and base value add up to the margin of every document."""
    plan, table = _documents(spark, d)
    model = _make().fit(table)
    explained = P.contributions(model.transform(table), model, len(plan.names))
    total = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    margin = vector_to_array("rawPrediction")[1]
    return explained.select("doc_id", (F.abs(total - margin) < F.lit(1e-9)).alias("adds_up"))


def shap_action_explain(spark, d):
    """Explanations name all features, largest effect first, and with the base value give the score of the document."""
    plan, table = _documents(spark, d)
    model = _make().fit(table)
    listed = R.above(M.score(table, model), "probability", 0.0)
    explained = P.explain_json(P.contributions(listed, model, len(plan.names)), plan.names)
    parsed = F.from_json("explain", "array<struct<Feature:string,Value:string,SHAP:double>>")
    rows = explained.withColumns({"e": parsed, "base": F.element_at("contributions", -1)})
    margin = F.aggregate("e", F.col("base"), lambda a, x: a + x["SHAP"])
    sizes = F.transform("e", lambda x: -F.abs(x["SHAP"]))
    return rows.select(
        "doc_id", F.size(F.array_distinct("e.Feature")).cast("bigint").alias("n_features"),
        (sizes == F.array_sort(sizes)).alias("sorted"),
        (F.abs(1 / (1 + F.exp(-2 * margin)) - F.col("probability")) < 1e-9).alias("adds_up"),
    )


def model_round_trip(spark, d):
    """A saved and reloaded model gives the same scores."""
    _, table = _documents(spark, d)
    model = _make().fit(table)
    path = M.save_model(model, f"{shared_dir(spark).rstrip('/')}/leadloom/model-{uuid.uuid4().hex}")
    again = M.score(table, M.load_model(path), "again").select("doc_id", "again")
    both = M.score(table, model).join(again, "doc_id")
    return both.select("doc_id", (F.col("probability") == F.col("again")).alias("same"))


# --- complete plans -------------------------------------------------------------------

LEAD = lead.LeadConfig(
    ("ASIA", "AFRICA", "EUROPE", "AMERICA"), "example", "example website", key="contact_id", event_key="owner",
    missing_threshold=0.3,
)
CONVERSION = conversion.ConversionConfig(
    ("ASIA", "EUROPE", "AMERICA"), "AFRICA", "example", "example website", excluded_ids=(7, 8, 9),
    extra_ids=(1, 2, 3), key="contact_id", event_key="owner",
)


def _events(spark, d, segmented: bool):
    met = B.meetings(spark, d).withColumnsRenamed({"contact_id": "owner", "seg": "NoteSegment"})
    called = B.calls(spark, d).withColumnRenamed("contact_id", "owner").withColumn(
        "CallNoteSegment", F.pmod("event_id", F.lit(4)).cast("int") - 1
    )
    return (met, called) if segmented else (met.drop("NoteSegment"), called.drop("CallNoteSegment"))


def _lead_features(spark, d, segmented=True):
    return lead.lead_features(B.contacts(spark, d), *_events(spark, d, segmented), B.ORDERS_AS_OF, LEAD)


def lead_features(spark, d):
    rows = _lead_features(spark, d)
    return B.whole(
        rows.select(
            "contact_id", "Target", "ScheduledMeetings", "CompletedMeetings", "SegmentCount_0", "SegmentCount_1",
            "SegmentCount_2", "CallAttempts", "ConnectedCalls", "TopSegmentRepresentative",
            "TopSegmentRepresentativeCalls", "CreateDate_Bins", "Nationality", "FirstPageSeen", "Country_Other",
            "Gender_Male", "engagement_label", "City", "pipeline_run_id",
        )
    )


_PAGE = """CASE WHEN page LIKE '%linkedin%' THEN 'linkedin' WHEN page LIKE '%my.example%' THEN 'PJ'
  WHEN page LIKE '%example%' THEN 'Website' WHEN page LIKE '%facebook%' THEN 'Facebook' ELSE page END"""
LEAD_FEATURES_SQL = f"""WITH {B.CONTACTS_SQL}, {B.MEETINGS_SQL}, {B.CALLS_SQL},
l0 AS (SELECT *, "FirstPageSeen" AS page, trim(lower("Nationality")) AS nat FROM contacts
  WHERE "LeadStageNewCEO" IN ('SQL 1', 'SQL 2', 'SAL 1', 'SAL 2') AND "IsThisLeadAlreadyFoundInAnInternalDatabase" = 'Not Found'
    AND "ContactType" IN ('ASIA', 'AFRICA', 'EUROPE', 'AMERICA')),
l1 AS (SELECT * REPLACE ({_PAGE} AS page, CASE WHEN nat IN ('ksa', 'saudi', 'saudi_arabian') THEN 'saudi arabia'
    WHEN nat = 'bahraini' THEN 'bahrain' ELSE nat END AS nat) FROM l0),
tc AS (SELECT "Country" AS c FROM l1 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5),
tp AS (SELECT page AS p FROM l1 WHERE page IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5),
l2 AS (SELECT *, "Country" NOT IN (SELECT c FROM tc) AS other_country,
    CASE WHEN page IN (SELECT p FROM tp) THEN page ELSE 'Other' END AS first_page,
    (SELECT min("CreateDate") FROM l1) AS s FROM l1),
l3 AS (SELECT *, (CAST("AgeRange" IS NULL AS INT) + CAST("Gender" IS NULL AS INT) + CAST("CampaignType" IS NULL AS INT)
    + CAST(NOT other_country AS INT) + CAST(first_page NOT IN ('Facebook', 'Other', 'PJ', 'Website', 'linkedin') AS INT)
    + CAST(nat NOT IN ('bahrain', 'saudi arabia') AS INT)) / 10.0 AS missing FROM l2),
m AS (SELECT contact_id, count(*) FILTER (WHERE outcome = 'SCHEDULED') AS sm, count(*) FILTER (WHERE outcome = 'COMPLETED') AS cm,
    count(*) FILTER (WHERE seg = 0) AS s0, count(*) FILTER (WHERE seg = 1) AS s1, count(*) FILTER (WHERE seg = 2) AS s2
  FROM meetings GROUP BY 1),
mn AS (SELECT contact_id, string_agg(trim(note), chr(10) || chr(10) ORDER BY rn) AS notes FROM (
    SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY activity DESC, created DESC, note) AS rn FROM meetings)
  WHERE rn <= 5 GROUP BY 1),
cl AS (SELECT *, regexp_extract(note, '[0-9]+') AS num, CAST(CAST(activity AS DATE) AS TIMESTAMP) AS day FROM calls),
k AS (SELECT contact_id, count(outcome) AS ca, count(*) FILTER (WHERE outcome = 'Connected') AS cc FROM calls GROUP BY 1),
kn AS (SELECT contact_id, string_agg(num, chr(10) || chr(10) ORDER BY rn) AS notes FROM (
    SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY day DESC, created DESC, num) AS rn FROM cl WHERE length(num) >= 2)
  WHERE rn <= 5 GROUP BY 1)
SELECT contact_id, CAST(contains("LeadStageNewCEO", 'SAL') AS BIGINT) AS "Target", coalesce(sm, 0) AS "ScheduledMeetings",
  coalesce(cm, 0) AS "CompletedMeetings", coalesce(s0, 0) AS "SegmentCount_0", coalesce(s1, 0) AS "SegmentCount_1",
  coalesce(s2, 0) AS "SegmentCount_2", coalesce(ca, 0) AS "CallAttempts", coalesce(cc, 0) AS "ConnectedCalls",
  regexp_replace(mn.notes, '[^A-Z0-9 \\n-]', '', 'g') AS "TopSegmentRepresentative", kn.notes AS "TopSegmentRepresentativeCalls",
  CASE WHEN "CreateDate" IS NULL THEN NULL WHEN "CreateDate" < s + INTERVAL 547 DAY THEN '0 to 1.5 years ago'
    WHEN "CreateDate" < s + INTERVAL 730 DAY THEN '1.5 to 2 years ago' WHEN "CreateDate" < s + INTERVAL 912 DAY THEN '2 to 2.5 years ago'
    WHEN "CreateDate" < s + INTERVAL 1095 DAY THEN '2.5 to 3 years ago' ELSE '3+ years ago' END AS "CreateDate_Bins",
  nat AS "Nationality", first_page AS "FirstPageSeen", CAST(other_country AS BIGINT) AS "Country_Other",
  CAST(coalesce("Gender" = 'Yes', false) AS BIGINT) AS "Gender_Male",
  CAST(CASE "EngagementLabel" WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END AS BIGINT) AS engagement_label,
  array_to_string(list_transform(regexp_extract_all(coalesce("City", 'Cannot be Determined'), '[A-Za-z]+|[^A-Za-z]+'),
    lambda w: upper(w[1]) || lower(w[2:])), '') AS "City", '20010802_000000' AS pipeline_run_id
FROM l3 LEFT JOIN m USING (contact_id) LEFT JOIN mn USING (contact_id) LEFT JOIN k USING (contact_id) LEFT JOIN kn USING (contact_id)
WHERE missing < 0.3"""


def _conversion_features(spark, d, segmented=True):
    return conversion.conversion_features(B.contacts(spark, d), *_events(spark, d, segmented), B.ORDERS_AS_OF, CONVERSION)


def conversion_features(spark, d):
    rows = _conversion_features(spark, d).select(
        "contact_id", "Target", "LeadStageNew", "TotalMeetings", "CompletionRate", "MeetingSpanDays",
        "LastMeetingDate_days", "FollowUpDate_days", "FirstCallDate_days", "CallAttempts", "ConnectionRate",
        "TopSegmentLabel", "TopCallSegmentLabel", "Segment_0_SampleNote", "Segment_2_NotesPreview",
        "CallSegment_0_SampleNote", "CallSegment_1_NotesPreview", "Segment_0_Description",
    )
    return B.tidy(rows)


def _label_sql(source: str, stem: str) -> str:
    return f"""(SELECT contact_id, concat('{stem}', seg) AS label FROM (SELECT contact_id, seg,
      row_number() OVER (PARTITION BY contact_id ORDER BY count(*) DESC, seg) AS r FROM {source}
      WHERE seg IN (-1, 0, 1, 2) GROUP BY contact_id, seg) WHERE r = 1)"""


CONVERSION_FEATURES_SQL = f"""WITH {B.CONTACTS_SQL}, {B.MEETINGS_SQL}, {B.CALLS_SQL},
b AS (SELECT * FROM contacts
  WHERE (("OnboardingId" IS NOT NULL AND "LeadStageNew" = 'Committed Capital' AND "OnboardingId" NOT IN (7, 8, 9)
       AND ("ClientType" = 'AFRICA' OR contact_id IN (1, 2, 3)))
     OR "LeadStageNewCEO" IN ('SAL 1', 'SAL 2') AND "ContactType" IN ('ASIA', 'EUROPE', 'AMERICA'))
    AND trim(lower("Nationality")) IN ('ksa', 'saudi', 'saudi_arabian') AND "LeadStageNewCEO" IS DISTINCT FROM 'Lead'),
m AS (SELECT contact_id, count(outcome) AS total, count(*) FILTER (WHERE outcome = 'COMPLETED') AS done,
    CASE WHEN count(*) > 1 THEN {B.days_sql('min(activity)', 'max(activity)')} ELSE 0 END AS span,
    {B.days_sql('max(activity)', f"TIMESTAMP '{B.ORDERS_AS_OF}'")} AS last_days FROM meetings GROUP BY 1),
kc AS (SELECT *, event_id % 4 - 1 AS seg FROM calls),
k AS (SELECT contact_id, count(outcome) AS total, count(*) FILTER (WHERE outcome = 'Connected') AS done,
    {B.days_sql('min(activity)', f"TIMESTAMP '{B.ORDERS_AS_OF}'")} AS first_days FROM kc GROUP BY 1),
mr AS (SELECT *, row_number() OVER (PARTITION BY contact_id, seg ORDER BY activity DESC, created DESC, note) AS rn FROM meetings),
kr AS (SELECT *, row_number() OVER (PARTITION BY contact_id, seg ORDER BY activity DESC, created DESC, note) AS rn FROM kc),
mn AS (SELECT contact_id, max(note) FILTER (WHERE seg = 0 AND rn = 1) AS s0,
    string_agg(note, ' | ' ORDER BY rn) FILTER (WHERE seg = 2 AND rn <= 10) AS p2 FROM mr GROUP BY 1),
kn AS (SELECT contact_id, max(note) FILTER (WHERE seg = 0 AND rn = 1) AS s0,
    string_agg(note, ' | ' ORDER BY rn) FILTER (WHERE seg = 1 AND rn <= 10) AS p1 FROM kr GROUP BY 1)
SELECT b.contact_id, CAST(CASE "LeadStageNewCEO" WHEN 'SAL 1' THEN 0 WHEN 'SAL 2' THEN 0 WHEN 'Client' THEN 1 END AS BIGINT) AS "Target",
  CAST(coalesce(CASE "LeadStageNew" WHEN 'Dormant Lead' THEN 1 WHEN 'Booked Meeting' THEN 3 WHEN 'OFFER SENT' THEN 10 WHEN 'Others' THEN 0 END, 0) AS BIGINT)
    AS "LeadStageNew",
  coalesce(m.total, 0) AS "TotalMeetings", round(CASE WHEN coalesce(m.total, 0) = 0 THEN 0.0 ELSE m.done / m.total END, 6) AS "CompletionRate",
  coalesce(span, 0) AS "MeetingSpanDays", coalesce(last_days, 999) AS "LastMeetingDate_days",
  coalesce({B.days_sql('"FollowUpDate"', f"TIMESTAMP '{B.ORDERS_AS_OF}'")}, 999) AS "FollowUpDate_days",
  coalesce(first_days, 999) AS "FirstCallDate_days", coalesce(k.total, 0) AS "CallAttempts",
  round(CASE WHEN coalesce(k.total, 0) = 0 THEN 0.0 ELSE k.done / k.total END, 6) AS "ConnectionRate",
  coalesce(ml.label, CASE WHEN m.contact_id IS NULL THEN '' ELSE 'No_Segment' END) AS "TopSegmentLabel",
  coalesce(kl.label, CASE WHEN k.contact_id IS NULL THEN '' ELSE 'No_CallSegment' END) AS "TopCallSegmentLabel",
  coalesce(mn.s0, '') AS "Segment_0_SampleNote", coalesce(mn.p2, '') AS "Segment_2_NotesPreview",
  coalesce(kn.s0, '') AS "CallSegment_0_SampleNote", coalesce(kn.p1, '') AS "CallSegment_1_NotesPreview",
  CASE WHEN mn.contact_id IS NULL THEN '' ELSE 'General meeting notes - Cluster 0' END AS "Segment_0_Description"
FROM b LEFT JOIN m USING (contact_id) LEFT JOIN k USING (contact_id) LEFT JOIN mn USING (contact_id) LEFT JOIN kn USING (contact_id)
  LEFT JOIN {_label_sql('meetings', 'Segment_')} ml USING (contact_id) LEFT JOIN {_label_sql('kc', 'CallSegment_')} kl USING (contact_id)"""


def lead_predictions(spark, d):
    """The whole lead plan: clustered notes, search, out-of-fold predictions."""
    features = materialise(_lead_features(spark, d, segmented=False))
    found = lead.lead_scores(features, AS_OF, "contact_id", PLAN_SPACE, trials=2)
    valid = F.col("probability").between(0.0, 1.0) & (F.col("y_pred") == (F.col("probability") > 0.5).cast("int"))
    return B.whole(found.predictions.select("contact_id", "y_true", valid.alias("valid"), "prediction_date"))


def conversion_predictions(spark, d):
    """The whole conversion plan: clustered notes, search, in-sample and out-of-fold scores."""
    features = materialise(_conversion_features(spark, d, segmented=False))
    found = conversion.conversion_scores(features, AS_OF, "contact_id", PLAN_SPACE, trials=2)
    valid = F.col("probability").between(0.0, 1.0) & (F.col("y_pred") == (F.col("probability") > 0.5).cast("int"))
    held = F.col("oof_probability").isNull() | F.col("oof_probability").between(0.0, 1.0)
    return B.whole(
        found.predictions.select(
            "contact_id", "y_true", (valid & held).alias("valid"), F.col("oof_probability").isNotNull().alias("has_oof"), "prediction_date"
        )
    )


def _stored(spark, features, name):
    """A feature table after it went through the sink."""
    return prepared(features, {"format": "parquet", "path": steps_dir(spark)}, f"{name}-{uuid.uuid4().hex}")


def lead_stored(spark, d):
    """The lead table as the scores read it: written, with table-safe names and values, and read back."""
    rows = _stored(spark, _lead_features(spark, d), "lead")
    return B.whole(
        rows.select("contact_id", "Target", "CallAttempts", "TopSegmentRepresentative", "TopSegmentRepresentativeCalls", "FirstPageSeen", "Nationality_saudi_arabia")
    )


def conversion_stored(spark, d):
    """The conversion table as the scores read it."""
    rows = _stored(spark, _conversion_features(spark, d), "conversion")
    return B.tidy(rows.select("contact_id", "Target", "LeadStageNew", "TotalMeetings", "LastMeetingDate_days", "TopSegmentLabel", "Segment_2_NotesPreview"))


def topup_stored(spark, d):
    """The top-up table as the scores read it."""
    rows = _stored(spark, topup.topup_features(_clients(spark, d), AS_OF), "topup")
    return B.tidy(rows.select(F.col("Client_ID").alias("client_id"), "they_topped_up", "First_Commitment_Amount", "Nationality", "MaritalStatus", "pipeline_run_id"))


def _clients(spark, d):
    """Existing clients under the source names: orders before the last half year are features."""
    orders = B.table(spark, d, "orders")
    late = F.col("o_orderdate") >= F.lit("2001-02-01").cast("timestamp_ntz")
    facts = orders.groupBy(F.col("o_custkey").alias("Client ID")).agg(
        F.count_if(~late).alias("meetscounts"),
        F.sum(F.when(~late, F.col("o_totalprice"))).alias("total_commitment"),
        F.max(F.when(~late, F.col("o_totalprice"))).alias("First Commitment Amount"),
        F.count_if(late).alias("they_topped_up"),
        F.count_if(late & (F.col("o_orderstatus") == "F")).alias("Top Up Frequency"),
        F.avg("o_totalprice").alias("Activities per Quarter"),
    )
    people = B.contacts(spark, d).select(
        F.col("contact_id").alias("Client ID"), "ContactType", "LeadStageNew", "Nationality", "MaritalStatus", "AgeRange", "Gender",
        F.col("EngagementLabel").alias("engagement_label"), F.col("City").alias("Client Summary"), F.col("Country").alias("RM_Name"),
    )
    return R.left_attach(people, facts, "Client ID")


def topup_features(spark, d):
    """The source columns of the top-up table, and a segment number for every client."""
    rows = topup.topup_features(_clients(spark, d), AS_OF)
    return B.tidy(
        rows.select(
            F.col("Client ID").alias("client_id"), F.col("SegmentClass").between(0, 3).alias("placed"), "ContactType", "LeadStageNew", "Nationality",
            "MaritalStatus", "AgeRange", "Gender", "engagement_label", "meetscounts", "they_topped_up", F.col("Top Up Frequency").alias("frequency"),
            F.col("Activities per Quarter").alias("activities"), "created_at",
        )
    )


def topup_table(spark, d):
    """The top-up table: every client once, in exactly one of the four segments."""
    rows = topup.topup_features(_clients(spark, d), AS_OF)
    marks = sum(F.col(f"SegmentClass_{i}") for i in range(4))
    own = F.element_at(F.array(*[F.col(f"SegmentClass_{i}") for i in range(4)]), F.col("SegmentClass") + 1)
    return B.tidy(
        rows.select(
            F.col("Client ID").alias("client_id"), "they_topped_up", F.col("First Commitment Amount").alias("first_amount"),
            ((marks == 1) & (own == 1)).alias("one_segment"), "created_at", "pipeline_run_id",
        )
    )


TOPUP_TABLE_SQL = """SELECT c_custkey AS client_id, late AS they_topped_up, round(first_amount, 6) AS first_amount, true AS one_segment,
  TIMESTAMP '2001-08-02 00:00:00' AS created_at, '20010802_000000' AS pipeline_run_id
FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-02-01') AS late,
    max(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '2001-02-01') AS first_amount FROM orders GROUP BY 1) ON o_custkey = c_custkey"""


def topup_action_list(spark, d):
    """The whole top-up plan: segments, outliers, model, explanations, request bodies.

    Every client: a score, and exactly those of at least one half are listed, ranked by score, explained
    and phrased.
    """
    clients = _clients(spark, d)
    features = materialise(topup.topup_features(clients, AS_OF))
    found = topup.topup_scores(
        features, clients, "Explain the score in plain words.", params={"maxIter": 5, "maxDepth": 3, "stepSize": 0.2, "pos_weight": 0.95},
    )
    listed = materialise(found.action_list.select("HubSpotId", "rank", topup.SCORE, "explain", "pitch_request"))
    better = listed.select((F.col("rank") + 1).alias("rank"), F.struct((-F.col(topup.SCORE)).alias("p"), F.col("HubSpotId").alias("id")).alias("before"))
    here = F.struct((-F.col(topup.SCORE)).alias("p"), F.col("HubSpotId").alias("id"))
    place = F.coalesce(F.col("before") < here, F.col("rank") == 1)
    told = F.col("pitch_request").contains("Explain the score in plain words.") & (F.get_json_object("explain", "$[0].Feature").isNotNull())
    judged = listed.join(better, "rank", "left").select("HubSpotId", (place & told).alias("fine"))
    scored = found.predictions.select("HubSpotId", F.col(topup.SCORE).alias("p"), "RM_Name")
    rows = scored.join(judged, "HubSpotId", "left")
    right = F.coalesce("fine", ~F.col("HubSpotId").isNull() & (F.col("p") < 0.5)) & (F.col("fine").isNotNull() == (F.col("p") >= 0.5))
    return B.whole(rows.select(F.col("HubSpotId").alias("client_id"), "RM_Name", F.col("p").between(0.0, 1.0).alias("scored"), right.alias("listed_right")))


_CLIENTS_SQL = f"""WITH {B.CONTACTS_SQL}, facts AS (SELECT o_custkey AS contact_id,
    count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2001-02-01') AS early, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-02-01') AS late,
    max(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '2001-02-01') AS first_amount, avg(o_totalprice) AS activities,
    count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-02-01' AND o_orderstatus = 'F') AS frequency FROM orders GROUP BY 1)"""
_FEATURES = '["n_chars", "n_words", "toxic", "lang", "source"]'.replace('"', "'")
_STAMP = "TIMESTAMP '2001-08-02 00:00:00'"

QUERIES = {
    "kmeans_segments": (kmeans_segments, "SELECT c_custkey, true AS one_flag, true AS by_size FROM customer"),
    "kmeans_properties": (
        kmeans_properties, "SELECT count(*) AS n_rows, count(*) AS n_nearest, CAST(4 AS BIGINT) AS n_in_order FROM customer"
    ),
    "note_clusters": (
        note_clusters, f"SELECT doc_id, len({clean_sql('text')}) > 0 AS clustered, true AS alike FROM documents"
    ),
    "note_cluster_coverage": (
        note_cluster_coverage,
        "SELECT conv_id, turn, len(w) > 0 AS clustered FROM"
        f" (SELECT conv_id, turn, {clean_sql('text')} AS w FROM conversations)",
    ),
    "embedding_clusters": (embedding_clusters, "SELECT vec_id, true AS clustered, true AS by_size FROM embeddings"),
    "outlier_flags": (outlier_flags, "SELECT c_custkey, true AS in_range, true AS as_scored FROM customer"),
    "outlier_share": (outlier_share, "SELECT count(*) AS n_rows, true AS as_asked FROM lineitem"),
    "price_quantile": (
        price_quantile,
        """SELECT count(*) FILTER (WHERE o_totalprice > q) AS n_above, round(max(q), 4) AS q95 FROM orders,
        (SELECT quantile_cont(o_totalprice, 0.95) AS q FROM orders)""",
    ),
    "gbt_oof_scores": (
        gbt_oof_scores,
        """SELECT doc_id, (row_number() OVER (PARTITION BY quality ORDER BY md5(concat_ws('|', doc_id, '42')), doc_id) - 1) % 5 AS fold,
        CAST(quality AS BIGINT) AS quality, true AS unseen FROM labels""",
    ),
    "oof_coverage": (
        oof_coverage,
        """SELECT doc_id, CAST(1 AS BIGINT) AS n_scores, (row_number() OVER (PARTITION BY quality
        ORDER BY md5(concat_ws('|', doc_id, '42')), doc_id) - 1) % 5 AS fold, true AS consistent FROM labels""",
    ),
    "batch_clusters": (batch_clusters, 'SELECT vec_id, true AS clustered, true AS "close", true AS same FROM embeddings'),
    "search_trials": (search_trials, "SELECT i AS number, true AS in_range, true AS by_state FROM range(4) t(i)"),
    "adaptive_search": (adaptive_search, "SELECT unnest(['same_again', 'later_better', 'halved', 'near_target']) AS property, true AS holds"),
    "ordered_target_statistics": (ordered_target_statistics, ORDERED_TARGET_SQL),
    "early_stopping": (early_stopping, "SELECT doc_id, true AS same, true AS up_to_lowest FROM labels"),
    "fold_importance": (fold_importance, f"SELECT unnest({_FEATURES}) AS feature, true AS mean_of_folds, true AS shares"),
    "shap_summary": (shap_summary, f"SELECT unnest({_FEATURES}) AS feature, true AS as_rows, true AS as_used"),
    "contribution_additivity": (contribution_additivity, "SELECT doc_id, true AS adds_up FROM labels"),
    "shap_action_explain": (
        shap_action_explain, 'SELECT doc_id, CAST(5 AS BIGINT) AS n_features, true AS "sorted", true AS adds_up FROM labels'
    ),
    "model_round_trip": (model_round_trip, "SELECT doc_id, true AS same FROM labels"),
    "lead_features": (lead_features, LEAD_FEATURES_SQL),
    "conversion_features": (conversion_features, CONVERSION_FEATURES_SQL),
    "lead_predictions": (
        lead_predictions, f'SELECT contact_id, "Target" AS y_true, true AS valid, {_STAMP} AS prediction_date FROM ({LEAD_FEATURES_SQL})'
    ),
    "conversion_predictions": (
        conversion_predictions,
        f"""SELECT contact_id, "Target" AS y_true, true AS valid, "Target" IS NOT NULL AS has_oof, {_STAMP} AS prediction_date
        FROM ({CONVERSION_FEATURES_SQL})""",
    ),
    "lead_stored": (
        lead_stored,
        f"""SELECT contact_id, "Target", "CallAttempts", coalesce("TopSegmentRepresentative", '') AS "TopSegmentRepresentative",
        coalesce("TopSegmentRepresentativeCalls", '') AS "TopSegmentRepresentativeCalls", coalesce("FirstPageSeen", '') AS "FirstPageSeen",
        CAST("Nationality" = 'saudi arabia' AS BIGINT) AS "Nationality_saudi_arabia" FROM ({LEAD_FEATURES_SQL})""",
    ),
    "conversion_stored": (
        conversion_stored,
        f"""SELECT contact_id, "Target", "LeadStageNew", "TotalMeetings", "LastMeetingDate_days", "TopSegmentLabel", "Segment_2_NotesPreview"
        FROM ({CONVERSION_FEATURES_SQL})""",
    ),
    "topup_stored": (
        topup_stored,
        _CLIENTS_SQL + """SELECT contact_id AS client_id, late AS they_topped_up, round(first_amount, 6) AS "First_Commitment_Amount",
        "Nationality", coalesce("MaritalStatus", '') AS "MaritalStatus", '20010802_000000' AS pipeline_run_id
        FROM contacts LEFT JOIN facts USING (contact_id)""",
    ),
    "topup_features": (
        topup_features,
        _CLIENTS_SQL + f"""SELECT contact_id AS client_id, true AS placed, "ContactType", "LeadStageNew", "Nationality", "MaritalStatus", "AgeRange",
        "Gender", "EngagementLabel" AS engagement_label, early AS meetscounts, late AS they_topped_up, frequency, round(activities, 6) AS activities,
        {_STAMP} AS created_at FROM contacts LEFT JOIN facts USING (contact_id)""",
    ),
    "topup_table": (topup_table, TOPUP_TABLE_SQL),
    "topup_action_list": (
        topup_action_list, f'WITH {B.CONTACTS_SQL} SELECT contact_id AS client_id, "Country" AS "RM_Name", true AS scored, true AS listed_right FROM contacts'
    ),
}
