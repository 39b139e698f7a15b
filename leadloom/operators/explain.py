"""Additive per-row contributions of the features of a boosted-tree model.

The contributions are exact Shapley values of the tree-conditional expectation (Lundberg et
al. 2018): together with the base value they add up to the margin of the row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.functions import text as X
from leadloom.operators.frames import quoted
from leadloom.operators.modelling import trees_of
from leadloom.session import materialise, spread, steps_dir

#: Rows worked at once, and tests (rows x leaves x tests of a leaf) held at once.
_ROWS = 2048
_CELLS = 1 << 21
#: Nodes of a model that the driver may read and broadcast.
MOST_NODES = 100_000
#: Trees of a block and rows of a bucket beyond that.
BLOCK_TREES = 50
BUCKET_ROWS = 20_000


def node_table(df: DataFrame, model) -> DataFrame:
    """(tree, weight, id, value, cover, left, right, feature, split, categories) of all nodes of a model, from its saved tables."""
    spark = df.sparkSession
    path = f"{steps_dir(spark)}/model-{uuid.uuid4().hex}"
    trees_of(model).write().overwrite().save(path)
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("value"), n["impurityStats"][0].alias("cover"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
        n["split"]["leftCategoriesOrThreshold"].alias("split"), n["split"]["numCategories"].alias("categories"),
    )
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")  # saved by position
    return nodes.join(weights, "tree")


def leaf_rules(rows: Iterable) -> list[tuple[float, list[tuple]]]:
    """Every leaf of some trees as (value, [(feature, test, share)]), from the rows of ``node_table``.

    ``test`` is an interval (low, high] or a set of categories; ``share`` is the part of the
    training weight that meets it.
    """
    nodes: dict[int, dict] = {}
    for r in rows:
        nodes.setdefault(r["tree"], {})[r["id"]] = r
    leaves = []
    for _, table in sorted(nodes.items()):
        stack = [(0, {})]
        while stack:
            at, path_tests = stack.pop()
            node = table[at]
            if node["left"] < 0:
                rule = [(f, test, share) for f, (test, share) in path_tests.items()]
                leaves.append((node["weight"] * node["value"], rule))
                continue
            f, values = int(node["feature"]), list(node["split"])
            for child, is_left in ((node["left"], True), (node["right"], False)):
                share = table[child]["cover"] / node["cover"]
                old_test, old_share = path_tests.get(f, (None, 1.0))
                if node["categories"] >= 0:
                    chosen = frozenset(values) if is_left else frozenset(
                        c for c in map(float, range(int(node["categories"]))) if c not in values
                    )
                    test = chosen if old_test is None else old_test & chosen
                else:
                    low, high = old_test or (-np.inf, np.inf)
                    test = (low, min(high, values[0])) if is_left else (max(low, values[0]), high)
                stack.append((child, {**path_tests, f: (test, old_share * share)}))
    return leaves


@dataclass(frozen=True)
class LeafGroup:
    """Leaves whose rules have the same number of features, as arrays: one row per leaf, one column per test.

    ``allowed`` is -1 for an interval (low, high], otherwise a row of the table of category sets.
    """

    value: np.ndarray
    feature: np.ndarray
    share: np.ndarray
    low: np.ndarray
    high: np.ndarray
    allowed: np.ndarray


def packed_leaves(leaves: Sequence[tuple[float, list[tuple]]]) -> tuple[float, list[LeafGroup], np.ndarray]:
    """(base value, leaf groups, category sets) of a leaf list; leaves that add nothing but to the base are left out."""
    base, by_size, sets = 0.0, {}, {}
    for value, rule in leaves:
        base += value * float(np.prod([s for _, _, s in rule]))
        if rule and value != 0.0:
            by_size.setdefault(len(rule), []).append((value, rule))
    groups = []
    for _, rows in sorted(by_size.items()):
        tests = [[t for _, t, _ in rule] for _, rule in rows]
        spans = np.array([[t if isinstance(t, tuple) else (-np.inf, np.inf) for t in row] for row in tests])
        known = np.array([[-1 if isinstance(t, tuple) else sets.setdefault(t, len(sets)) for t in row] for row in tests])
        groups.append(
            LeafGroup(
                np.array([v for v, _ in rows]),
                np.array([[f for f, _, _ in rule] for _, rule in rows]),
                np.array([[s for _, _, s in rule] for _, rule in rows]),
                spans[:, :, 0], spans[:, :, 1], known,
            )
        )
    width = 1 + int(max((max(s) for s in sets if s), default=0))
    allowed = np.zeros((max(1, len(sets)), width + 1), dtype=bool)  # the last column stands for values no set knows
    for chosen, row in sets.items():
        allowed[row, [int(c) for c in chosen]] = True
    return base, groups, allowed


def _met(x: np.ndarray, g: LeafGroup, at: slice, allowed: np.ndarray) -> np.ndarray:
    """Rows x leaves x tests: which tests a row meets."""
    seen = x[:, g.feature[at]]
    met = (seen > g.low[at]) & (seen <= g.high[at])
    sets = g.allowed[at]
    leaf, test = np.nonzero(sets >= 0)
    if leaf.size:
        codes = seen[:, leaf, test]
        known = (codes >= 0) & (codes < allowed.shape[1] - 1) & (codes == np.floor(codes))
        place = np.where(known, codes, allowed.shape[1] - 1).astype(np.int64)
        met[:, leaf, test] = allowed[sets[leaf, test], place]
    return met


def _gains(share: np.ndarray, ones: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley value of every test, for rows of (shares, tests met, leaf value)."""
    d = share.shape[1]
    weight = np.array([factorial(s) * factorial(d - 1 - s) / factorial(d) for s in range(d)])
    out = np.empty(share.shape)
    for i in range(d):
        poly = np.ones((len(value), 1))
        for j in range(d):
            if j != i:
                longer = np.zeros((len(value), poly.shape[1] + 1))
                longer[:, :-1] += poly * share[:, j : j + 1]
                longer[:, 1:] += poly * ones[:, j : j + 1]
                poly = longer
        out[:, i] = value * (ones[:, i] - share[:, i]) * (poly @ weight)
    return out


def _shares(n_features: int, model):
    """Vectorised function: feature matrix -> contributions, base value in the last column.

    ``model`` is a broadcast variable of ``packed_leaves``: a large model must not travel with every task. Leaves
    are worked in blocks of all rows at once; (leaf, tests met) pairs that occur for many rows are computed once.
    """

    def contribute(x: np.ndarray) -> np.ndarray:
        base, groups, allowed = model.value
        n, width = len(x), n_features + 1
        out = np.zeros(n * width)
        for g in groups:
            leaves, d = g.feature.shape
            step = max(1, _CELLS // (n * d))
            for start in range(0, leaves, step):
                at = slice(start, min(start + step, leaves))
                count = at.stop - start
                met = _met(x, g, at, allowed)
                pattern = met @ (1 << np.arange(d)) + (np.arange(count) << d)
                seen, which = np.unique(pattern.ravel(), return_inverse=True)
                leaf = (seen >> d) + start
                ones = (seen[:, None] >> np.arange(d)) & 1
                gain = _gains(g.share[leaf], ones, g.value[leaf])
                rows = np.arange(n)[:, None] * width
                for i in range(d):
                    cells = (rows + g.feature[at, i]).ravel()
                    out += np.bincount(cells, weights=gain[which, i], minlength=n * width)
        out = out.reshape(n, width)
        out[:, -1] += base
        return out

    return contribute


def contributions(
    df: DataFrame, model, n_features: int, features: str = "features", out: str = "contributions", most_nodes: int = MOST_NODES
) -> DataFrame:
    """Add an array with one contribution per feature and the base value at its end.

    A model of at most ``most_nodes`` nodes is read by the driver and broadcast; beyond it the tasks read blocks of trees
    themselves and the blocks' contributions are added up (``contributions_by_block``).
    """
    nodes = node_table(df, model)
    if nodes.count() > most_nodes:
        return contributions_by_block(df, nodes, n_features, features, out)
    leaves = df.sparkSession.sparkContext.broadcast(packed_leaves(leaf_rules(nodes.collect())))
    contribute = _shares(n_features, leaves)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def explain(batch: pd.Series) -> pd.Series:
        if len(batch) == 0:
            return pd.Series([], dtype=object)
        x = np.vstack(batch.to_numpy())
        parts = [contribute(x[at : at + _ROWS]) for at in range(0, len(x), _ROWS)]
        return pd.Series(list(np.vstack(parts)))

    return spread(df).withColumn(out, explain(vector_to_array(F.col(features))))


class _Here:
    """A value that stands where a broadcast is expected."""

    def __init__(self, value):
        self.value = value


def contributions_by_block(
    df: DataFrame, nodes: DataFrame, n_features: int, features: str = "features", out: str = "contributions",
    trees: int = BLOCK_TREES, rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``contributions`` for a model of any size, from its ``node_table``: no node reaches the driver.

    Contributions of trees add up. Rows are dealt out to buckets of about ``rows`` rows and trees to blocks of ``trees``; a
    task holds one bucket and one block, and a row's partial sums are added by an aggregation. ``df`` is stored once.
    """
    stored = materialise(df.withColumn("__row", F.monotonically_increasing_id()))
    buckets = max(1, -(-stored.count() // rows))
    last = nodes.agg(F.max("tree")).first()[0]
    every_block = F.explode(F.sequence(F.lit(0), F.lit(last // trees))).alias("block")
    bucket = F.pmod(F.xxhash64("__row"), F.lit(buckets)).cast("int").alias("bucket")
    left = stored.select("__row", bucket, vector_to_array(F.col(features)).alias("x"), every_block)
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    right = nodes.select("*", F.floor(F.col("tree") / trees).cast("int").alias("block"), every)

    def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine):
            return pd.DataFrame({"__row": pd.Series(dtype="int64"), "part": pd.Series(dtype=object)})
        contribute = _shares(n_features, _Here(packed_leaves(leaf_rules(theirs.to_dict("records")))))
        x = np.vstack(mine["x"].to_numpy())
        parts = np.vstack([contribute(x[at : at + _ROWS]) for at in range(0, len(x), _ROWS)])
        return pd.DataFrame({"__row": mine["__row"].to_numpy(), "part": list(parts)})

    pairs = left.groupBy("bucket", "block").cogroup(right.groupBy("bucket", "block")).applyInPandas(run, "__row bigint, part array<double>")
    sums = pairs.groupBy("__row").agg(Summarizer.sum(array_to_vector("part")).alias("__sum"))
    return stored.join(sums, "__row").withColumn(out, vector_to_array("__sum")).drop("__row", "__sum")


def contribution_rows(df: DataFrame, id_col: str, names: Sequence[str], values: str = "contributions") -> DataFrame:
    """(id, feature, contribution), one row per entity and feature."""
    pairs = F.arrays_zip(F.lit(list(names)).alias("feature"), F.slice(values, 1, len(names)).alias("contribution"))
    return df.select(quoted(id_col), F.explode(pairs).alias("c")).select(
        quoted(id_col), F.col("c")["feature"].alias("feature"), F.col("c")["contribution"].alias("contribution")
    )


def mean_abs_contribution(rows: DataFrame, out: str = "mean_abs_shap") -> DataFrame:
    return rows.groupBy("feature").agg(F.avg(F.abs("contribution")).alias(out)).orderBy(F.desc(out), "feature")


def explain_json(
    df: DataFrame,
    names: Sequence[str],
    display: Mapping[str, str] | None = None,
    values: str = "contributions",
    out: str = "explain",
    max_value: int = 30,
) -> DataFrame:
    """JSON list of all features of a row, largest effect first; empty where there is none.

    ``display`` names the column to show for a feature whose own column is not of that name.
    """
    shown = display or {}

    def text(name: str) -> Column:
        source = shown.get(name, name)
        known = F.col(quoted(source)).cast("string") if source in df.columns else F.lit(None).cast("string")
        return X.ellipsis(known, max_value)

    items = F.array(
        *[
            F.struct(F.lit(n).alias("Feature"), text(n).alias("Value"), F.col(values)[i].alias("SHAP"))
            for i, n in enumerate(names)
        ]
    )
    keyed = F.transform(items, lambda s: F.struct((-F.abs(s["SHAP"])).alias("k"), s.alias("s")))
    ordered = F.transform(F.array_sort(keyed), lambda p: p["s"])
    return df.withColumn(out, F.when(F.col(values).isNull(), F.lit("")).otherwise(F.to_json(ordered)))


def enrichment_errors(df: DataFrame, cols: Sequence[str], out: str = "n_empty") -> DataFrame:
    """How many rows got no text in one of the enrichment columns."""
    empty = [F.coalesce(F.col(quoted(c)), F.lit("")) == "" for c in cols]
    any_empty = empty[0]
    for e in empty[1:]:
        any_empty = any_empty | e
    return df.agg(F.count("*").alias("n_rows"), F.count_if(any_empty).alias(out))
