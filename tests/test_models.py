import itertools
import json
import math
import random
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from leadloom.operators import clustering as C
from leadloom.operators import explain as P
from leadloom.operators import modelling as M
from leadloom.operators.boosting import Boosting, best_trees
from leadloom.operators import outliers as O
from leadloom.operators import ranking as K
from leadloom.session import materialise


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(400).select(
        "id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.element_at(F.lit(["x", "y", "z"]), (F.pmod("id", F.lit(3)) + 1).cast("int")).alias("c"),
    )
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 250.0
    bonus = F.when(F.col("c") == "y", 0.3).otherwise(0.0)
    df = df.withColumn("label", (F.col("a") + 0.5 * F.col("b") + bonus + noise > 1.0).cast("int"))
    df = materialise(K.stratified_folds(df, "id", "label", 3))
    plan = M.fit_features(df, ["a", "b"], ["c"])
    return plan, materialise(plan.apply(df))


def make():
    return M.propensity_pipeline(pos_weight=1.5, maxIter=4, maxDepth=3)


def test_feature_plan_handles_nulls_and_new_values(spark, table):
    plan, _ = table
    df = spark.createDataFrame([(None, 2.0, "new"), (1.0, None, None)], "a double, b double, c string")
    got = [r["f"].toArray().tolist() for r in plan.apply(df, "f").collect()]
    assert got == [[0.0, 2.0, 3.0], [1.0, 0.0, 3.0]]


def test_oof_scores_cover_every_row_once(spark, table):
    _, df = table
    got, models = M.oof_scores(df, make, k=3)
    rows = got.select("id", "fold", "oof_probability", "oof_prediction").collect()
    assert sorted(r["id"] for r in rows) == list(range(400)) and len(models) == 3
    assert all(0 <= r["oof_probability"] <= 1 and r["oof_prediction"] == int(r["oof_probability"] > 0.5) for r in rows)
    held_out = M.score(df.filter("fold = 1"), models[1]).select("id", "probability").collect()
    by_id = {r["id"]: r["oof_probability"] for r in rows}
    assert all(by_id[r["id"]] == r["probability"] for r in held_out)


def test_contributions_equal_brute_force_shapley_values(spark, table):
    plan, df = table
    model = make().fit(df)
    leaves = P.leaf_rules(P.node_table(df, model).collect())

    def expectation(x, known):
        total = 0.0
        for value, rule in leaves:
            weight = 1.0
            for f, test, share in rule:
                met = test[0] < x[f] <= test[1] if isinstance(test, tuple) else x[f] in test
                weight *= float(met) if f in known else share
            total += value * weight
        return total

    rows = P.contributions(model.transform(df.limit(12)), model, 3).select("features", "contributions", "rawPrediction").collect()
    for r in rows:
        x, n = r["features"].toArray(), 3
        assert abs(expectation(x, {0, 1, 2}) - r["rawPrediction"][1]) < 1e-9
        for i in range(n):
            others = [j for j in range(n) if j != i]
            phi = sum(
                factorial(len(s)) * factorial(n - len(s) - 1) / factorial(n) * (expectation(x, {*s, i}) - expectation(x, set(s)))
                for size in range(n) for s in itertools.combinations(others, size)
            )
            assert abs(phi - r["contributions"][i]) < 1e-9
        assert abs(sum(r["contributions"]) - r["rawPrediction"][1]) < 1e-9


def test_explanation_json_is_sorted_and_complete(spark, table):
    plan, df = table
    model = make().fit(df)
    one = P.explain_json(P.contributions(df.limit(3), model, 3), plan.names).select("explain", "contributions").first()
    parsed = json.loads(one["explain"])
    assert sorted(p["Feature"] for p in parsed) == ["a", "b", "c"]
    sizes = [abs(p["SHAP"]) for p in parsed]
    assert sizes == sorted(sizes, reverse=True)
    empty = P.explain_json(df.limit(1).withColumn("contributions", F.lit(None).cast("array<double>")), plan.names)
    assert empty.first()["explain"] == ""
    assert P.enrichment_errors(empty, ["explain"]).first()["n_empty"] == 1


def test_mean_contribution_and_importance_tables(spark, table):
    plan, df = table
    model = make().fit(df)
    rows = P.contribution_rows(P.contributions(df, model, 3), "id", plan.names)
    assert rows.count() == 1200
    means = P.mean_abs_contribution(rows).collect()
    assert [r["mean_abs_shap"] for r in means] == sorted((r["mean_abs_shap"] for r in means), reverse=True)
    importance = M.fold_importance(spark, [model, model], plan.names).collect()
    single = {r["feature"]: r["importance"] for r in M.importance_table(spark, model, plan.names).collect()}
    assert all(abs(single[r["feature"]] - r["importance"]) < 1e-12 for r in importance)


def test_search_reports_every_trial(spark, table):
    _, df = table
    space = {"maxIter": (2, 4, "int"), "stepSize": (0.05, 0.3, "log"), "maxDepth": (2, 3, "int"), "pos_weight": (1.0, 3.0, "linear")}
    found = M.search(df, space, trials=3, k=3, batch=2, startup=2)
    trials = found.trials.collect()
    whole = [t for t in trials if t["state"] == "COMPLETE"]
    assert len(trials) == 3 and found.best_score == max(t["value"] for t in whole)
    assert all(t["folds"] == 3 for t in whole) and all(t["folds"] < 3 for t in trials if t["state"] == "PRUNED")


def test_the_best_trees_are_found_with_patience():
    assert best_trees([3.0, 2.0, 2.5, 1.0, 1.5, 1.2], 2) == (4, True)
    assert best_trees([3.0, 2.0, 2.5, 2.5, 1.0], 2) == (2, True)
    assert best_trees([3.0, 2.0, 2.0], 2) == (2, False)
    assert best_trees([1.0], 5) == (1, False)


@pytest.mark.parametrize("patience", [2, 4, 50])
def test_early_stopping_keeps_the_trees_up_to_the_lowest_loss(spark, table, patience):
    _, df = table
    marked = materialise(M.eval_slice(df, "id", 0.25))
    params = {"maxDepth": 4, "stepSize": 0.4, "maxIter": 24}
    model = M.propensity_pipeline(eval_col="is_eval", patience=patience, pos_weight=1.5, **params).fit(marked)
    whole = M.propensity_pipeline(pos_weight=1.5, **params).fit(marked.filter("NOT is_eval"))
    losses = M.held_out_losses(whole, marked.filter("is_eval"))
    kept = M.trees_of(model).getNumTrees
    assert kept == best_trees(losses, patience)[0] < 24
    assert losses[kept - 1] == min(losses[: kept + patience])
    same = M.propensity_pipeline(pos_weight=1.5, **{**params, "maxIter": kept}).fit(marked.filter("NOT is_eval"))
    a = {r["id"]: r["probability"] for r in M.score(df, model).collect()}
    assert a == pytest.approx({r["id"]: r["probability"] for r in M.score(df, same).collect()}, abs=1e-9)
    weights = [r["importance"] for r in M.importance_table(spark, model, ["a", "b", "c", "unused"]).collect()]
    assert len(weights) == 4 and sum(weights) == pytest.approx(1.0)


def test_a_fit_goes_on_where_it_stopped(spark, table):
    """Trees grown in two parts and in blocks of any length are those of one long fit of Spark's own."""
    _, df = table
    params = {"maxDepth": 3, "stepSize": 0.3, "maxIter": 7}
    weighed = df.withColumn("weight", F.lit(1.0))
    parts = Boosting.begin(weighed, params, F.col("id") % 4 == 0, block=3)
    parts.grow(2)
    parts.grow(5)
    long = M.trees_of(M.propensity_pipeline(**params).fit(df.filter("id % 4 <> 0")))
    assert len(parts.trees) == 7 and parts.weights == long.treeWeights
    for ours, theirs in zip(parts.trees, long.trees, strict=True):
        a, b = ([r["x"] for r in t.setPredictionCol("x").transform(df.select("id", "features")).orderBy("id").collect()] for t in (ours, theirs))
        assert a == pytest.approx(b, abs=1e-9) and ours.numNodes == theirs.numNodes
    assert parts.losses == pytest.approx(M.held_out_losses_of(long, weighed.filter("id % 4 = 0")))


def test_without_rows_to_hold_out_all_trees_stay(spark, table):
    _, df = table
    fitted = M.propensity_pipeline(eval_col="none", maxIter=3, maxDepth=2).fit(df.withColumn("none", F.lit(False)))
    assert M.trees_of(fitted).getNumTrees == 3


def test_a_cut_model_can_be_saved(spark, table, tmp_path):
    _, df = table
    cut = M.first_trees(make().fit(df), 2)
    again = M.load_model(M.save_model(cut, str(tmp_path / "cut")))
    a = {r["id"]: r["probability"] for r in M.score(df, cut).collect()}
    assert a == {r["id"]: r["probability"] for r in M.score(df, again).collect()}
    assert P.contributions(df.limit(2), cut, 3).count() == 2


def test_saved_model_scores_the_same(spark, table, tmp_path):
    _, df = table
    model = make().fit(df)
    again = M.load_model(M.save_model(model, str(tmp_path / "model")))
    a = {r["id"]: r["probability"] for r in M.score(df, model).collect()}
    assert a == {r["id"]: r["probability"] for r in M.score(df, again).collect()}


def test_clusters_are_numbered_by_size(spark):
    rng = np.random.default_rng(0)
    points = [(float(c + rng.normal(0, 0.1)), float(rng.normal(0, 0.1))) for c, n in ((0, 50), (10, 30), (20, 15), (30, 5)) for _ in range(n)]
    df = spark.createDataFrame(points, "x double, y double")
    seen = set()
    for n in (1, 7):
        got = C.segment_entities(df.repartition(n), ["x", "y"], restarts=4).collect()
        seen.add(tuple(sorted((round(r["x"], 6), r["SegmentClass"]) for r in got)))
        for r in got:
            assert r["SegmentClass"] == min(3, int((r["x"] + 5) // 10)) and r[f"SegmentClass_{r['SegmentClass']}"] == 1
    assert len(seen) == 1
    flat = C.segment_entities(df, []).first()
    assert flat["SegmentClass"] == 0 and flat["SegmentClass_0"] == 1


def test_mini_batches_find_the_clusters_of_the_whole_table(spark):
    rng = np.random.default_rng(4)
    at = np.array([[0.0, 0.0, 5.0], [6.0, 0.0, 0.0], [0.0, 7.0, 0.0]])
    rows = [(Vectors.dense(at[i % 3] + rng.normal(0, 0.5, 3)), float(1 + i % 2)) for i in range(6000)]
    df = materialise(spark.createDataFrame(rows, ["v", "w"]))
    full = C.fit_clusters(df, "v", 3, restarts=3, weight="w")
    made = [C.fit_clusters_in_batches(x, "v", 3, batch=200, batches=25, weight="w") for x in (df, df.repartition(9), df)]
    assert made[0].centroids() == made[1].centroids() == made[2].centroids()
    nearest = [min(np.linalg.norm(np.array(c) - f) for f in np.array(full.centroids())) for c in made[0].centroids()]
    assert max(nearest) < 0.15
    sizes = {r["s"]: r["n"] for r in made[0].assign(df, "s").groupBy("s").agg(F.sum("w").alias("n")).collect()}
    assert sizes[0] >= sizes[1] >= sizes[2] and sum(sizes.values()) == 9000.0
    few = C.fit_clusters_in_batches(spark.createDataFrame([(Vectors.dense([1.0]),), (Vectors.dense([4.0]),)] * 3, ["v"]), "v", 3)
    assert sorted(few.centroids()) == [[1.0], [4.0]]


def test_notes_keep_their_own_segment(spark):
    themes = ["pricing offer discount budget", "travel visit airport hotel", "contract signature lawyer clause"]
    notes = [(i, themes[i % 3]) for i in range(30)] + [(30, None), (31, " "), (32, "the a")]
    got = {r["i"]: r["NoteSegment"] for r in C.segment_notes_by_text(spark.createDataFrame(notes, "i int, t string"), "t", min_df=2).collect()}
    for theme in range(3):
        assert len({got[i] for i in range(30) if i % 3 == theme}) == 1
    assert {got[i] for i in range(30)} == {0, 1, 2} and got[30] == got[31] == got[32] == -1
    few = C.segment_notes_by_text(spark.createDataFrame(notes[:10], "i int, t string"), "t", min_df=2)
    assert {r["NoteSegment"] for r in few.collect()} == {-1}


def test_note_segments_do_not_depend_on_the_layout(spark):
    rng = random.Random(9)
    stock = ["call budget offer", "visit hotel travel", "contract lawyer clause", "price bank fund"]
    notes = [(i, rng.choice(stock) if i % 3 else "no answer left message") for i in range(300)]
    df = spark.createDataFrame(notes, "i int, t string")
    seen = set()
    for n in (1, 5, 13):
        got = C.segment_notes_by_text(df.repartition(n), "t", min_df=2).collect()
        seen.add(tuple(sorted((r["i"], r["NoteSegment"]) for r in got)))
    assert len(seen) == 1


def test_notes_with_embeddings(spark):
    rows = [(i, "note" if i else None, [float(i % 3) * 5, 1.0] if i != 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, t string, e array<double>")
    got = {r["i"]: r["NoteSegment"] for r in C.segment_notes_by_text(df, "t", embedding="e").collect()}
    assert got[0] == -1 and got[5] == -1
    assert all(len({got[i] for i in range(1, 40) if i % 3 == m and i != 5}) == 1 for m in range(3))


def test_nearest_centroid_breaks_ties_by_number(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([0.4, 0.0],)], "v array<double>")
    got = C.assign_nearest(df, "v", [[0.0, 0.0], [2.0, 0.0]], distance="d").collect()
    assert [(r["nearest"], r["d"]) for r in got] == [(0, 1.0), (0, 0.4)]


@pytest.mark.parametrize("pass_bytes", [C.PASS_BYTES, 8 * 3 * 700])
def test_nearest_of_five_thousand_groups(spark, pass_bytes):
    """In one pass and in blocks: the same groups as comparing all centres, ties to the smallest."""
    rng = np.random.default_rng(8)
    centres = np.round(rng.normal(size=(5000, 3)), 2)
    points = np.vstack([np.round(rng.normal(size=(300, 3)), 2), centres[:50]])
    table = spark.createDataFrame([(f"g{i:04}", c.tolist()) for i, c in enumerate(centres)] + [(None, [0.0, 0.0, 0.0])], "g string, centre array<double>")
    rows = spark.createDataFrame([(i, p.tolist(), "clash") for i, p in enumerate(points)] + [(999, None, "clash")], "i int, v array<double>, d string")
    got = {r["i"]: r for r in C.assign_nearest_of_many(rows, "v", table, "g", pass_bytes=pass_bytes).collect()}
    far = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    for i in range(len(points)):
        assert got[i]["nearest"] == f"g{int(np.argmin(far[i])):04}" and got[i]["distance"] == pytest.approx(math.sqrt(far[i].min()), abs=1e-12)
    assert got[999]["nearest"] is None and got[999]["distance"] is None
    assert {r["nearest"] for r in C.assign_nearest_of_many(rows, "v", table.limit(0), "g").collect()} == {None}


@pytest.mark.parametrize("most_visits", [C.MOST_VISITS, 0])
def test_nearest_in_cells_of_space(spark, monkeypatch, most_visits):
    """Each row meets the centres of few cells, with the groups and distances of comparing all; rows with no near cells take the passes."""
    monkeypatch.setattr(C, "CELL_CENTRES", 20)
    monkeypatch.setattr(C, "CELL_ROWS", 150)
    monkeypatch.setattr(C, "MOST_VISITS", most_visits)
    rng = np.random.default_rng(3)
    centres = np.round(np.vstack([rng.normal(size=(1500, 3)), rng.normal(size=(400, 3)) * 0.01 + 7, np.zeros((100, 3))]), 3)
    points = np.vstack([np.round(rng.normal(size=(400, 3)) * 3, 1), centres[:50], np.full((400, 3), 7.0)])
    names = rng.permutation(len(centres))
    table = spark.createDataFrame(
        [(f"g{n:04}", c.tolist()) for n, c in zip(names, centres)] + [(None, [0.0, 0.0, 0.0]), ("a", [math.nan, 0.0, 0.0]), ("b", None)], "g string, centre array<double>"
    )
    rows = spark.createDataFrame([(i, p.tolist(), "clash") for i, p in enumerate(points)] + [(9999, None, "clash")], "i int, v array<double>, d string")
    got = {r["i"]: r for r in C.assign_nearest_of_many(rows, "v", table, "g", few=100).collect()}
    far = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert len(got) == len(points) + 1 and got[9999]["nearest"] is None and got[9999]["distance"] is None
    for i in range(len(points)):
        least = far[i].min()
        assert got[i]["distance"] == pytest.approx(math.sqrt(least), abs=1e-12)
        assert got[i]["nearest"] == min(f"g{n:04}" for n in names[far[i] == least])


def test_cells_of_space_spare_most_comparisons():
    rng = np.random.default_rng(4)
    centres, points = rng.normal(size=(20_000, 3)), rng.normal(size=(500, 3))
    cells = C.cut_space(centres[::10], 6)
    place = cells.place(centres)
    known = np.unique(place)
    cells = cells.bounded(known, *(np.array([f(centres[place == c], axis=0) for c in known]) for f in (np.min, np.max)))
    _, least = C.nearest_in_block(points, centres)
    row, cell = cells.within(points, least)
    assert {place[np.argmin(((centres - p) ** 2).sum(axis=1))] in cell[row == i] for i, p in enumerate(points)} == {True}
    assert np.bincount(place)[cell].sum() < 0.06 * len(points) * len(centres)


def test_path_lengths_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(2)
    grow, x = O._tree_grower(1, 8), rng.normal(size=(700, 3))
    forest = pd.concat([grow(pd.DataFrame({"tree": t, "h": rng.permutation(200), "x": list(rng.normal(size=(200, 3)))})) for t in range(9)])
    want = np.zeros(len(x))
    for _, tree in forest.groupby("tree"):
        nodes = tree.set_index("node")
        for i, row in enumerate(x):
            at, depth = 0, 0
            while nodes.at[at, "feature"] >= 0:
                at = nodes.at[at, "left"] if row[nodes.at[at, "feature"]] <= nodes.at[at, "threshold"] else nodes.at[at, "right"]
                depth += 1
            want[i] += depth + float(O._unsuccessful(nodes.at[at, "size"]))
    assert O.path_lengths(O.flat_forest(forest), x) == pytest.approx(want)


def test_outliers(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(400)] + [(1000 + i, 40.0 + i, -40.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    got = {r["id"]: (r["is_outlier"], r["outlier_score"]) for r in O.outlier_flags(df, "id", ["x", "y"], trees=40, sample=128).collect()}
    assert all(got[1000 + i][0] == 1 for i in range(5))
    assert abs(sum(f for f, _ in got.values()) - 0.05 * len(rows)) <= 1
    again = {r["id"]: r["outlier_score"] for r in O.outlier_flags(df.repartition(5), "id", ["x", "y"], trees=40, sample=128).collect()}
    assert all(abs(again[i] - s) < 1e-12 for i, (_, s) in got.items())


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(4)
    values = [rng.choice([0.0, 1.0, rng.gauss(0, 1), rng.expovariate(1e-4)]) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert O.exact_quantile(df, "v", q, buckets=8, small=20) == pytest.approx(float(np.quantile(values, q)), abs=1e-9)
    assert O.exact_quantile(df.filter("v > 1e12"), "v", q) is None


def test_additivity_with_deep_trees(spark, table):
    _, df = table
    model = M.propensity_pipeline(maxIter=3, maxDepth=7).fit(df)
    got = P.contributions(model.transform(df), model, 3)
    total = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    assert got.agg(F.max(F.abs(total - vector_to_array("rawPrediction")[1]))).first()[0] < 1e-9


def test_contributions_by_blocks_equal_those_of_a_broadcast(spark, table):
    """Trees in blocks and rows in buckets: the same contributions, and the nodes stay with the tasks."""
    _, df = table
    model = M.propensity_pipeline(maxIter=11, maxDepth=5, maxBins=40).fit(df)
    whole = {r["id"]: r["contributions"] for r in P.contributions(df, model, 3).collect()}
    nodes = P.node_table(df, model)
    parts = P.contributions_by_block(df, nodes, 3, trees=4, rows=70)
    assert parts.columns == [*df.columns, "contributions"]
    got = {r["id"]: r["contributions"] for r in parts.collect()}
    assert set(got) == set(whole) and all(got[i] == pytest.approx(whole[i], abs=1e-9) for i in whole)
    forced = P.contributions(df, model, 3, most_nodes=10)
    assert {r["id"]: r["contributions"] for r in forced.collect()} == {i: pytest.approx(v, abs=1e-9) for i, v in whole.items()}


def test_a_rare_category_among_many_decides(spark):
    rows = spark.range(3000).select(
        "id", F.rand(4).alias("a"), F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(500))).alias("c")
    )
    rare = rows.groupBy("c").count().orderBy("count", "c").first()["c"]
    rows = materialise(rows.withColumn("label", (F.col("c") == rare).cast("int")))
    plan = M.fit_features(rows, ["a"], ["c"])
    assert len(plan.categories["c"]) == rows.select("c").distinct().count() and plan.bins > 490
    fitted = M.propensity_pipeline(maxBins=plan.bins, maxIter=2, maxDepth=2, stepSize=1.0).fit(plan.apply(rows))
    scored = M.score(plan.apply(rows), fitted)
    assert scored.filter(F.col("y_pred") != F.col("label")).count() == 0


def test_every_tree_draws_from_the_whole_table(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"), F.array(F.rand(1), F.rand(2)).alias("x")
    )
    nodes, drawn = O.fit_forest(materialise(rows), "id", "x", trees=6, sample=128)
    assert drawn == 128 and sorted(nodes["tree"].unique()) == list(range(6))


@pytest.mark.parametrize("rows_at_once, cells", [(2048, 1 << 21), (3, 40)])
def test_contributions_of_many_leaves_equal_brute_force(spark, monkeypatch, rows_at_once, cells):
    """Random leaves of up to four features with intervals and category sets, unknown categories included."""
    monkeypatch.setattr(P, "_CELLS", cells)
    rng = np.random.default_rng(5)
    n, leaves = 5, [(0.25, []), (0.0, [(0, (0.0, 1.0), 0.5)])]
    for _ in range(60):
        chosen = rng.permutation(n)[: rng.integers(1, 5)]
        rule = []
        for f in chosen:
            low, high = sorted(rng.normal(size=2))
            test = (low, high) if f < 3 else frozenset(map(float, rng.permutation(6)[: rng.integers(0, 5)]))
            rule.append((int(f), test, float(rng.uniform(0.1, 0.9))))
        leaves.append((float(rng.normal()), rule))
    x = np.column_stack([rng.normal(size=(7, 3)), rng.integers(0, 9, size=(7, 2)).astype(float)])

    def expectation(row, known):
        total = 0.0
        for value, rule in leaves:
            for f, test, share in rule:
                met = test[0] < row[f] <= test[1] if isinstance(test, tuple) else row[f] in test
                value *= float(met) if f in known else share
            total += value
        return total

    shared = spark.sparkContext.broadcast(P.packed_leaves(leaves))
    got = np.vstack([P._shares(n, shared)(x[at : at + rows_at_once]) for at in range(0, len(x), rows_at_once)])
    for row, found in zip(x, got, strict=True):
        assert abs(found[-1] - expectation(row, ())) < 1e-9
        for i in range(n):
            others = [j for j in range(n) if j != i]
            phi = sum(
                factorial(len(s)) * factorial(n - len(s) - 1) / factorial(n) * (expectation(row, {*s, i}) - expectation(row, set(s)))
                for size in range(n) for s in itertools.combinations(others, size)
            )
            assert abs(phi - found[i]) < 1e-9


def test_quantile_with_infinite_values_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    values = [-inf, -inf, 1.0, 2.0, 3.0, 4.0, inf, nan, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [O.exact_quantile(df, "v", q, buckets=2, small=1) for q in (0.0, 2 / 7, 0.5, 6 / 7, 1.0)]
    assert got[:2] == [-inf, 1.0] and got[2] == 2.5 and got[3] == inf and got[4] != got[4]
    assert O.exact_quantile(spark.createDataFrame([(inf,)], "v double"), "v", 0.3) == inf


def test_too_many_groups_are_an_error(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(5)], "g int, x array<double>")
    assert C.group_centroids(df, "g", "x") == [[0.0], [1.0], [2.0], [3.0], [4.0]]
    with pytest.raises(ValueError):
        C.group_centroids(df, "g", "x", max_groups=4)


def test_notes_become_vectors_without_arrays_of_their_terms(spark):
    """Pairs of words are numbers inside the tasks; before, every pair of every note was a string of the plan."""
    notes = ["red blue call"] * 4 + ["green tree house"] * 3 + ["", None, "red blue call back"]
    df = spark.createDataFrame(list(enumerate(notes)), "i int, t string")
    found = C.segment_notes_by_text(df, "t", "s", k=2, min_notes=0, min_df=1)
    assert "zip_with" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = [r["s"] for r in found.orderBy("i").collect()]
    assert len(set(got[:4])) == len(set(got[4:7])) == 1 and got[7:9] == [-1, -1] and set(got) == {-1, 0, 1}
