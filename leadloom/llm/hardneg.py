"""Hard negatives by slot-decomposed selection.

Every anchor has positives, and every positive a window of scores below its own. The positives' scores,
the windows' upper limits, cut the scores into disjoint slots. Each task keeps the best k negatives of
each slot, a merge keeps the best k over all tasks, and because a window consists of the upper part of a
suffix of slots, the slots of an anchor in descending order answer all its overlapping windows: the first
k of the suffix that lie above the window's lower limit. A negative is scored and filed once, however many
windows it falls into.

Anchors are a query set. They are taken in blocks of at most ``BLOCK`` (the only rows that reach the
driver, with their few positives), and each block is scored against all rows by matrix products over
Arrow batches. What a task puts out is bounded by the block, not by its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.llm.tables import running_total
from leadloom.session import spread, steps_dir

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: Lower limit of a window in percent of the positive's score.
PERCENT = 80
BLOCK = 8192
_ROWS, _ANCHORS = 2048, 512  # scores computed at once
_MOST = 1 << 24  # components are held within this size, so that scores are exact
_EXACT = 1 << 53
_NONE = np.iinfo(np.int64).min

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def whole_vectors(column: pa.Array, width: int | None = None, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are free of nulls and non-finite components, and floor(scale * x) of all, as whole float64.

    Shorter vectors are filled up with zeros to the longest, or all are brought to ``width``.
    """
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)  # a null is NaN
    longest = int(lengths.max(initial=0))
    if values.size == lengths.size * longest:
        found = values.reshape(lengths.size, longest)
    else:
        found = np.zeros((lengths.size, longest))
        found[np.arange(longest) < lengths[:, None]] = values
    usable = np.isfinite(found).all(axis=1) & np.asarray(column.is_valid())
    found = np.clip(np.floor(scale * np.where(usable[:, None], found, 0.0)), -_MOST, _MOST)
    width = longest if width is None else width
    if longest < width:
        found = np.pad(found, ((0, 0), (0, width - longest)))
    return usable, np.ascontiguousarray(found[:, :width])


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers."""
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if bound < _EXACT:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def best(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k rows of each (anchor, slot): highest scores, then smallest keys."""
    order = np.lexsort((key, -score, slot, anchor))
    a, s = anchor[order], slot[order]
    fresh = np.ones(order.size, dtype=bool)
    fresh[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    start = np.maximum.accumulate(np.where(fresh, np.arange(order.size), 0))
    return order[np.arange(order.size) - start < k]


class Combiner:
    """The best k rows of each (anchor, slot) among the rows of one task.

    ``limits`` holds each anchor's slots as descending upper limits, ``_NONE`` where it has fewer; without
    limits all scores are one slot. ``alike`` asks for rows of the anchor's label, otherwise of others.
    """

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, k: int, alike: bool, limits: np.ndarray | None = None, percent: int = PERCENT):
        self._vectors, self._labels, self._k, self._alike, self._percent = vectors, labels, k, alike, percent
        self._limits = limits
        slots = 1 if limits is None else limits.shape[1]
        self._cut = np.full((len(labels), slots), _NONE)  # score of the k-th row so far
        none = np.zeros(0, dtype=np.int64)
        self.kept = [(none, none, none, none)] * -(-len(labels) // _ANCHORS)
        if limits is not None:
            few = np.where(limits == _NONE, np.iinfo(np.int64).max, limits).min(axis=1)
            self._low = np.where(limits[:, 0] == _NONE, np.iinfo(np.int64).max, -(-percent * few // 100))

    def add(self, keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(keys), _ROWS):
            some = slice(at, at + _ROWS)
            for i, first in enumerate(range(0, len(self._labels), _ANCHORS)):
                self._meet(i, first, keys[some], labels[some], vectors[some])

    def _meet(self, chunk: int, first: int, keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        mine = slice(first, first + _ANCHORS)
        scores = products(self._vectors[mine], vectors)
        wanted = (self._labels[mine, None] == labels[None, :]) == self._alike
        wanted &= scores >= self._cut[mine].min(axis=1)[:, None]
        if self._limits is not None:
            wanted &= (scores <= self._limits[mine, :1]) & (scores >= self._low[mine, None])
        anchor, row = np.nonzero(wanted)
        score, anchor = scores[anchor, row], anchor + first
        if self._limits is None:
            slot = np.zeros(anchor.size, dtype=np.int64)
        else:
            slot = (self._limits[anchor] >= score[:, None]).sum(axis=1) - 1
        use = score >= self._cut[anchor, slot]
        if self._limits is not None:
            use &= 100 * score >= self._percent * self._limits[anchor, slot]
        if not use.any():
            return
        new = (anchor[use], slot[use], score[use], keys[row[use]])
        all_ = tuple(np.concatenate(pair) for pair in zip(self.kept[chunk], new, strict=True))
        chosen = best(*all_, self._k)
        a, s, x, _ = self.kept[chunk] = tuple(part[chosen] for part in all_)
        last = np.flatnonzero(np.append((a[1:] != a[:-1]) | (s[1:] != s[:-1]), True))
        full = np.diff(last, prepend=-1) == self._k
        self._cut[a[last[full]], s[last[full]]] = x[last[full]]


_FOUND = "number bigint, slot bigint, score bigint, key bigint"


def _combined(rows: DataFrame, width: int, scale: int, *about) -> DataFrame:
    """(number, slot, score, key) of the best rows of each (anchor, slot), over all tasks; ``about`` is a combiner's."""
    schema = pa.schema([(n, pa.int64()) for n in ("number", "slot", "score", "key")])
    k = about[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = Combiner(*about)
        for batch in batches:
            usable, vectors = whole_vectors(batch.column("vector"), width, scale)
            keys, labels = (batch.column(n).to_numpy(zero_copy_only=False)[usable] for n in ("key", "label"))
            combiner.add(keys.astype(np.int64), labels.astype(np.int64), vectors[usable])
        for part in combiner.kept:
            if part[0].size:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], schema=schema)

    place = F.row_number().over(Window.partitionBy("number", "slot").orderBy(F.desc("score"), "key"))
    return rows.mapInArrow(run, _FOUND).withColumn("place", place).filter(F.col("place") <= k).drop("place")


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT, scale: int = SCALE, block: int = BLOCK
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables have key, label (whole numbers) and vector; other columns are not read, and every anchor is
    a row of ``rows`` too. A vector counts as floor(scale * x), held within 2**24; scores are whole inner
    products, higher first, ties by the smaller key. The positives of an anchor are its first rows of the
    same label without the anchor itself (one row of its key and score); for each, the negatives are the first rows of other labels
    with ``percent`` % of the positive's score or more, and no more than its score. Rows with a null in key, label, vector or
    component, or a non-finite component, take no part; missing components are zeros; repeated rows are rows
    of their own, so a repeated anchor answers again; empty tables give no rows.
    """
    spark = rows.sparkSession
    there = F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    rows = spread(rows.select("key", "label", "vector").filter(there))
    asked = running_total(anchors.select("key", "label", "vector", F.lit(1).alias("one")).filter(there), "one", [F.col("key").asc()], [], "number").drop("one")
    total = asked.count()
    path = f"{steps_dir(spark)}/{uuid.uuid4().hex}"
    spark.createDataFrame([], RESULT).write.parquet(path)
    for start in range(0, total, block):
        mine = asked.filter(F.col("number").between(start, start + block - 1)).orderBy("number").toArrow().combine_chunks()
        column = mine.column("vector").combine_chunks()
        usable, vectors = whole_vectors(column, scale=scale)
        keys, labels = (np.asarray(mine.column(n)).astype(np.int64)[usable] for n in ("key", "label"))
        if not keys.size:
            continue
        vectors = vectors[usable]
        width = vectors.shape[1]
        first = _combined(rows, width, scale, vectors, labels, positives + 1, True).orderBy("number", F.desc("score"), "key").toArrow()
        chosen = _without_itself(first, keys, vectors, positives)
        limits = np.full((keys.size, positives), _NONE)
        for a, i, _, score in chosen:
            limits[a, i] = score
        if not chosen:
            continue
        slots = _combined(rows, width, scale, vectors, labels, negatives, False, limits, percent)
        lists = slots.groupBy("number").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "key", "slot"))).alias("found"))
        # the slot of a positive's own score: the last of the equal limits
        plan = [(a, int(keys[a]), key, score, int((limits[a] >= score).sum()) - 1) for a, _, key, score in chosen]
        windows = spark.createDataFrame(plan, "number bigint, anchor_id bigint, positive_id bigint, positive_score bigint, own bigint")
        suffix = F.expr(f"slice(filter(found, x -> x.slot >= own AND -100 * x.less >= {percent} * positive_score), 1, {negatives})")
        answered = windows.join(lists, "number").select("anchor_id", "positive_id", "positive_score", F.posexplode(suffix).alias("i", "x"))
        answered.select(
            "anchor_id", "positive_id", (F.col("i") + 1).alias("rank"), F.col("x.key").alias("negative_id"), "positive_score", (-F.col("x.less")).alias("negative_score")
        ).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


def _without_itself(found: pa.Table, keys: np.ndarray, vectors: np.ndarray, most: int) -> list[tuple[int, int, int, int]]:
    """(anchor, place, key, score) of the positives; of the rows found, the anchor itself goes once."""
    own = np.einsum("ij,ij->i", vectors.astype(np.int64), vectors.astype(np.int64))
    out, last, place, gone = [], -1, 0, False
    for a, score, key in zip(*(found.column(n).to_pylist() for n in ("number", "score", "key")), strict=True):
        if a != last:
            last, place, gone = a, 0, False
        if not gone and key == keys[a] and score == own[a]:
            gone = True
        elif place < most:
            out.append((a, place, key, score))
            place += 1
    return out
