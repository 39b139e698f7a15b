"""Isolation-forest outlier flags (Liu, Ting and Zhou 2008) as Spark jobs."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from leadloom.operators.frames import quoted
from leadloom.session import materialise, spread

_TREE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size bigint"
_MARGIN = 4  # rows let through for each tree, in multiples of one sample
_ACCURACY = 10_000  # of the quantile sketch: ranks within one part in so many
_ROWS = 512  # rows that step down all trees together


def _tree_grower(seed: int, max_depth: int):
    """Function that grows one isolation tree from the rows of one sample."""

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        x = np.vstack(pdf.sort_values("h")["x"].to_numpy())
        nodes, todo = [], [(np.arange(len(x)), 0, -1, 0)]
        while todo:
            rows, depth, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][4 + side] = me
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            splittable = np.flatnonzero(high > low)
            if depth >= max_depth or len(rows) < 2 or len(splittable) == 0:
                nodes.append([tree, me, -1, 0.0, -1, -1, len(rows)])
                continue
            feature = int(rng.choice(splittable))
            cut = float(rng.uniform(low[feature], high[feature]))
            go_left = x[rows, feature] <= cut
            nodes.append([tree, me, feature, cut, -1, -1, len(rows)])
            todo.append((rows[~go_left], depth + 1, me, 1))
            todo.append((rows[go_left], depth + 1, me, 0))
        names = ["tree", "node", "feature", "threshold", "left", "right", "size"]
        return pd.DataFrame(nodes, columns=names)

    return grow


def _unsuccessful(n) -> np.ndarray:
    """Average path length of a search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def flat_forest(forest: pd.DataFrame) -> dict:
    """All trees as one set of arrays: a node's feature, threshold and two children, a leaf its own child, and its path length.

    ``roots`` has the first node of each tree, ``levels`` the steps that reach every leaf.
    """
    rows = forest.sort_values(["tree", "node"], ignore_index=True)
    sizes = rows.groupby("tree").size().to_numpy()
    roots = np.cumsum(sizes) - sizes
    offset = np.repeat(roots, sizes)
    here = np.arange(len(rows))
    leaf = rows["feature"].to_numpy() < 0
    children = np.stack([np.where(leaf, here, rows[side].to_numpy() + offset) for side in ("left", "right")], axis=1)
    depth, level = np.zeros(len(rows)), roots
    steps = 0
    while (level := level[~leaf[level]]).size:
        below = children[level]
        depth[below] = depth[level][:, None] + 1
        level, steps = below.ravel(), steps + 1
    return {
        "feature": np.where(leaf, 0, rows["feature"].to_numpy()).astype(np.int32), "threshold": np.where(leaf, np.inf, rows["threshold"].to_numpy()),
        "children": children.ravel().astype(np.int32), "length": depth + _unsuccessful(rows["size"].to_numpy()), "roots": roots.astype(np.int32), "levels": steps,
    }


def path_lengths(forest: dict, x: np.ndarray) -> np.ndarray:
    """Sum over the trees of the path length of each row: all trees step down together, level by level."""
    feature, threshold, children = forest["feature"], forest["threshold"], forest["children"]
    out = np.empty(len(x))
    for first in range(0, len(x), _ROWS):
        part = x[first : first + _ROWS]
        flat, base = part.ravel(), (np.arange(len(part), dtype=np.int32) * part.shape[1])[:, None]
        at = np.broadcast_to(forest["roots"], (len(part), forest["roots"].size)).copy()
        for _ in range(forest["levels"]):
            right = flat[base + feature[at]] > threshold[at]
            at = children[2 * at + right]
        out[first : first + _ROWS] = forest["length"][at].sum(axis=1)
    return out


def _scorer(forest, sample: int):
    """Anomaly score per row of a batch of feature arrays; ``forest`` is a broadcast ``flat_forest``."""
    typical = max(float(_unsuccessful(sample)), 1e-12)

    def score(batch: pd.Series) -> pd.Series:
        if len(batch) == 0:
            return pd.Series([], dtype=float)
        lengths = path_lengths(forest.value, np.vstack(batch.to_numpy()))
        return pd.Series(np.power(2.0, -(lengths / forest.value["roots"].size) / typical))

    return score


def fit_forest(df: DataFrame, id_col: str, features: str, trees: int = 100, sample: int = 256, seed: int = 42) -> tuple[pd.DataFrame, int]:
    """Grow the trees in parallel, each from its own sample of the whole table.

    About four samples a tree are let through by a hash of (id, features), in a large table each row for one tree at
    most, and the smallest ``sample`` hashes of each tree stay. Rows that share an id draw for themselves. The node tables (at most ``2 * sample`` rows per tree) come back as one frame.
    """
    n = df.count()
    drawn = min(sample, n)
    key = F.col(quoted(id_col))
    share = min(1.0, _MARGIN * sample / max(n, 1))
    rows = df.select(key.alias("__id"), F.col(features).alias("x"), F.xxhash64(key, F.col(features), F.lit(seed)).alias("__row"))
    if trees * share <= 1.0:  # a large table: one draw sends a row to one tree or none
        slot = F.floor(F.pmod(F.xxhash64("__row"), F.lit(1 << 40)) / F.lit(share * (1 << 40))).cast("int")
        drawn_rows = rows.withColumn("tree", slot).filter(F.col("tree") < trees)
    else:
        numbers = F.sequence(F.lit(0), F.lit(trees - 1))
        picked = F.filter(numbers, lambda t: F.pmod(F.xxhash64(F.col("__row"), t), F.lit(1 << 30)) < math.ceil(share * (1 << 30)))
        drawn_rows = rows.select(F.explode(picked).alias("tree"), "__id", "x", "__row")
    spread = drawn_rows.withColumn("h", F.xxhash64("__row", "tree", F.lit(seed)))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("h", "__id"))
    samples = spread.withColumn("r", rank).filter(F.col("r") <= drawn).select("tree", "h", "x")
    depth = max(1, math.ceil(math.log2(max(drawn, 2))))
    return samples.groupBy("tree").applyInPandas(_tree_grower(seed, depth), _TREE_SCHEMA).toPandas(), drawn


def exact_quantile(df: DataFrame, col: str, q: float, buckets: int = 1024, small: int = 5000) -> float | None:
    """Interpolated quantile, exact at any size.

    Equal-width histograms close in on the two order statistics; every round is one aggregate
    with at most ``buckets`` result rows, until the bracket holds few distinct values.
    """
    c = F.col(quoted(col)).cast("double")
    values = df.select(c.alias("v")).filter(F.col("v").isNotNull())
    n = values.count()
    if not n:
        return None
    position = (n - 1) * q
    rank = math.floor(position)
    below = _order_statistic(values, rank, buckets, small)
    if position == rank:
        return below
    v = F.col("v")
    up_to, following = values.agg(F.count_if(v <= F.lit(below)), F.min(F.when(v > F.lit(below), v))).first()
    above = below if up_to > rank + 1 else following
    return below if above == below else below + (position - rank) * (above - below)


def _order_statistic(values: DataFrame, rank: int, buckets: int, small: int) -> float:
    """The value of a rank, counted from 0; infinite values and NaN have no place in a histogram and are counted apart."""
    v = F.col("v")
    finite = F.abs(v) < F.lit(math.inf)
    n_low, n_finite, n_high, low, high = values.agg(
        F.count_if(v == F.lit(-math.inf)), F.count_if(finite), F.count_if(v == F.lit(math.inf)),
        F.min(F.when(finite, v)), F.max(F.when(finite, v)),
    ).first()
    if rank < n_low:
        return -math.inf
    if rank >= n_low + n_finite:
        return math.inf if rank < n_low + n_finite + n_high else math.nan
    rank -= n_low
    before = 0
    if n_finite > small:  # a sketch brackets the rank; counts decide whether it holds
        at, error = rank / n_finite, 1.0 / _ACCURACY
        around = F.array(F.lit(max(0.0, at - 2 * error)), F.lit(min(1.0, at + 2 * error)))
        guess = values.agg(F.percentile_approx(F.when(finite, v), around, _ACCURACY)).first()[0]
        less, up_to = values.agg(F.count_if(finite & (v < F.lit(guess[0]))), F.count_if(finite & (v <= F.lit(guess[1])))).first()
        if less <= rank < up_to:
            low, high, before = guess[0], guess[1], less
    while low < high:
        inside = values.filter((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        width = (high - low) / buckets
        slot = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(buckets - 1)) if width > 0 else F.lit(0)
        bars = (
            inside.groupBy(slot.alias("slot"))
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("slot")
            .collect()
        )
        for bar in bars:
            if rank < before + bar["n"]:
                break
            before += bar["n"]
        if (bar["lo"], bar["hi"]) == (low, high) or bar["n"] <= small:
            within = values.filter((F.col("v") >= F.lit(bar["lo"])) & (F.col("v") <= F.lit(bar["hi"])))
            ordered = within.groupBy("v").agg(F.count("*").alias("n")).orderBy("v")
            for row in ordered.toLocalIterator():
                before += row["n"]
                if rank < before:
                    return row["v"]
        low, high = bar["lo"], bar["hi"]
    return low


def outlier_flags(
    df: DataFrame,
    id_col: str,
    cols: Sequence[str],
    contamination: float = 0.05,
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
    score: str = "outlier_score",
    out: str = "is_outlier",
) -> DataFrame:
    """Flag the ``contamination`` share of rows that isolate most easily (nulls count as 0)."""
    zeroed = F.array(*[F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for c in cols])
    wide = materialise(spread(df.withColumn("__x", zeroed)))  # counted, drawn from and scored
    forest, drawn = fit_forest(wide, id_col, "__x", trees, sample, seed)
    if len(forest) == 0:
        return df.withColumns({score: F.lit(None).cast("double"), out: F.lit(0)})
    shared = df.sparkSession.sparkContext.broadcast(flat_forest(forest))
    grade = F.pandas_udf(_scorer(shared, drawn), T.DoubleType())
    scored = materialise(wide.withColumn(score, grade("__x")).drop("__x"))
    cut = exact_quantile(scored, score, 1.0 - contamination)
    return scored.withColumn(out, (F.col(score) > F.lit(cut)).cast("int"))
