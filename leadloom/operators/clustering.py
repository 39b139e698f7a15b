"""k-means segments with reproducible ids, and nearest-centroid assignment."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators import notes as N
from leadloom.operators.frames import quoted
from leadloom.functions import text as X
from leadloom.session import fits_at_once, materialise, spread, steps_dir

#: Rows of a mini-batch and the most batches of a fit.
BATCH_ROWS, BATCHES = 1024, 60


@dataclass(frozen=True)
class Clusters:
    """A fitted model and the stable number of each of its clusters."""

    model: KMeansModel
    relabel: dict[int, int]

    def assign(self, df: DataFrame, out: str = "segment") -> DataFrame:
        raw = self.model.getPredictionCol()
        numbered = F.element_at(F.lit([self.relabel[i] for i in range(len(self.relabel))]), F.col(raw) + 1)
        return self.model.transform(df).withColumn(out, numbered.cast("int")).drop(raw)

    def centroids(self) -> list[list[float]]:
        by_id = {new: old for old, new in self.relabel.items()}
        centers = self.model.clusterCenters()
        return [centers[by_id[i]].tolist() for i in range(len(centers))]


def different_vectors(df: DataFrame, features: str, most: int) -> int:
    """How many different vectors there are, counted up to ``most``; hashes are compared, not vectors."""
    return df.select(F.xxhash64(F.unwrap_udt(features))).distinct().limit(most).count()


def fit_clusters(
    df: DataFrame, features: str, k: int, seed: int = 42, restarts: int = 1, max_iter: int = 20, weight: str | None = None
) -> Clusters:
    """The cheapest of ``restarts`` seeded k-means fits; ``weight`` counts the rows a vector stands for.

    Cluster numbers follow (size descending, first centroid coordinate), so they do not depend
    on the order in which the algorithm found the clusters. With fewer than ``k`` different vectors
    there are as many clusters as vectors; Spark wants two at least.
    """
    k = different_vectors(df, features, k)

    @inheritable_thread_target(df.sparkSession)
    def fit(i: int) -> KMeansModel:
        means = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol=features, predictionCol="__cluster")
        return (means.setWeightCol(weight) if weight else means).fit(df)

    pool = ThreadPool(min(restarts, fits_at_once(df)))
    try:
        best = min(pool.map(fit, range(restarts), chunksize=1), key=lambda m: m.summary.trainingCost)  # the first of equals
    finally:
        pool.close()
    n = F.sum(weight) if weight else F.count("*")
    sizes = {r["__cluster"]: r["n"] for r in best.transform(df).groupBy("__cluster").agg(n.alias("n")).collect()}
    centers = best.clusterCenters()
    order = sorted(range(len(centers)), key=lambda i: (-sizes.get(i, 0), centers[i][0]))
    return Clusters(best, {old: new for new, old in enumerate(order)})


def _model_of(centres: np.ndarray) -> KMeansModel:
    """Spark's own model with the given centres."""
    jvm = SparkSession.active().sparkContext._jvm
    vectors = jvm.java.util.ArrayList()
    for c in centres:
        vectors.add(jvm.org.apache.spark.mllib.linalg.Vectors.parse(f"[{','.join(map(repr, c.tolist()))}]"))
    parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(vectors)
    return KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"KMeans_{uuid.uuid4().hex[:12]}", parent))


def fit_clusters_in_batches(
    df: DataFrame, features: str, k: int, seed: int = 42, batch: int = BATCH_ROWS, batches: int = BATCHES, weight: str | None = None, tolerance: float = 1e-4
) -> Clusters:
    """Sequential mini-batch k-means (Sculley 2010): the cost of a fit is that of ``batches`` batches, not of the table.

    Batches of about ``batch`` rows are drawn by a hash of the vector, so neither the order nor the partitions of the
    table matter. The first three give the starting centres (k-means on a bounded sample); then each batch moves every centre
    towards the mean of its rows, by their share of all rows the centre has seen. It ends early when no centre has
    moved by more than ``tolerance`` of the vectors' spread in five batches. A small table is gone through several times.
    Cluster numbers follow (size in the whole table descending, first coordinate).
    """
    k = different_vectors(df, features, k)
    total = df.count()
    parts = max(1, total // batch)
    h = F.xxhash64(F.unwrap_udt(features), F.lit(seed))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    drawn = df.select(F.col(features).alias("x"), w.alias("w"), h.alias("h"), F.pmod(h, F.lit(parts)).cast("int").alias("b"))
    path = f"{steps_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    drawn.filter(F.col("b") < batches).repartition("b").write.partitionBy("b").parquet(path)
    stored = df.sparkSession.read.parquet(path)

    def of(numbers: list[int]) -> DataFrame:
        return stored.filter(F.col("b").isin(numbers)).coalesce(1).sortWithinPartitions("h")

    start = KMeans(k=k, seed=seed, maxIter=5, featuresCol="x", weightCol="w", predictionCol="c").fit(of(list(range(min(3, parts)))))
    centres = np.array(start.clusterCenters())
    spread = of([0]).agg(Summarizer.metrics("variance").summary(F.col("x"), F.col("w")).alias("s")).first()["s"]["variance"].toArray().sum()
    seen, still = np.zeros(len(centres)), 0
    for step in range(batches):
        placed = _model_of(centres).setFeaturesCol("x").setPredictionCol("c").transform(of([step % min(parts, batches)]))
        moved = np.zeros(len(centres))
        mean, size = Summarizer.mean(F.col("x"), F.col("w")).alias("m"), F.sum("w").alias("n")
        for row in placed.groupBy("c").agg(mean, size).collect():  # k rows
            c = row["c"]
            seen[c] += row["n"]
            shift = (row["m"].toArray() - centres[c]) * (row["n"] / seen[c])
            centres[c] += shift
            moved[c] = (shift * shift).sum()
        still = still + 1 if moved.max() <= tolerance * tolerance * max(spread, 1e-300) else 0
        if still >= 5:
            break
    best = _model_of(centres).setFeaturesCol(features).setPredictionCol("__cluster")
    n = F.sum(weight) if weight else F.count("*")
    sizes = {r["__cluster"]: r["n"] for r in best.transform(df).groupBy("__cluster").agg(n.alias("n")).collect()}
    order = sorted(range(len(centres)), key=lambda i: (-sizes.get(i, 0), centres[i][0]))
    return Clusters(best, {old: new for new, old in enumerate(order)})


def _distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows with their number in ``__w``, in an order that does not depend on the input.

    Copies (empty profiles, stock phrases) collapse before the shuffle, so however many there
    are they cost one row, and a fit on the result gives the same clusters on every run.
    """
    return df.groupBy(*cols).agg(F.count("*").cast("double").alias("__w")).sortWithinPartitions(*cols)


def segment_entities(
    df: DataFrame, numeric: Sequence[str], k: int = 4, seed: int = 42, restarts: int = 10, out: str = "SegmentClass"
) -> DataFrame:
    """Segment rows by their numeric columns (null as 0) and add 0/1 columns per segment."""
    flags = {f"{out}_{i}": X.flag(F.col(out), i) for i in range(k)}
    if not numeric:
        return df.withColumn(out, F.lit(0)).withColumns(flags)
    zeroed = [F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for c in numeric]
    names = [f"__x{i}" for i in range(len(numeric))]
    assembler = VectorAssembler(inputCols=names, outputCol="__features")
    points = _distinct(df.select(*[c.alias(n) for n, c in zip(names, zeroed)]), names)
    training = materialise(assembler.transform(points).select("__features", "__w"))
    if different_vectors(training, "__features", 2) < 2:
        return df.withColumn(out, F.lit(0)).withColumns(flags)
    clusters = fit_clusters(training, "__features", k, seed, restarts, weight="__w")
    wide = assembler.transform(df.drop(out).withColumns(dict(zip(names, zeroed)))).drop(*names)
    return clusters.assign(wide, out).drop("__features").withColumns(flags)


def segment_notes_by_text(
    events: DataFrame,
    note: str,
    out: str = "NoteSegment",
    k: int = 3,
    seed: int = 42,
    min_notes: int = 10,
    embedding: str | None = None,
    lemmas: DataFrame | None = None,
    batch: int | None = None,
    **term_options,
) -> DataFrame:
    """Cluster the notes of an event table; rows without a usable note get -1.

    With an ``embedding`` column (array of numbers) those vectors are clustered, otherwise
    TF-IDF weights of the cleaned notes (their lemmas, with a table of them). Nothing is clustered unless there are more than
    ``min_notes`` notes. Each row keeps its own label. With ``batch`` the clusters are fitted in mini-batches of so many
    different notes (see ``fit_clusters_in_batches``) instead of the whole table.
    """
    valid = X.has_text(note)
    if embedding:
        numbers = F.col(embedding).cast("array<double>")
        marked = events.withColumn("__ok", valid & F.col(embedding).isNotNull())
        points = _distinct(marked.filter("__ok").select(numbers.alias("__x")), ["__x"])
        training = materialise(points.select(array_to_vector("__x").alias("__v"), "__w"))
        n_notes = training.agg(F.sum("__w")).first()[0] or 0
    else:
        # Cleaning is the costly step. It runs once, into a stored copy; the terms are derived
        # from that copy again, because they would take three times its space.
        cleaned = materialise(N.clean_notes(events, note, "__text", lemmas))
        cleaned = cleaned.withColumn("__ok", valid & (F.col("__text") != ""))
        texts = cleaned.filter("__ok").select("__text")
        terms = N.fit_terms(texts, "__text", **term_options)
        n_notes = terms.n_docs if terms.terms else 0
    if n_notes <= min_notes:
        return events.withColumn(out, F.lit(-1))
    if embedding:
        if different_vectors(training, "__v", 2) < 2:
            return _one_segment(marked, out)
        clusters = fit_clusters(training, "__v", k, seed, weight="__w") if batch is None else fit_clusters_in_batches(training, "__v", k, seed, batch, weight="__w")
        # Rows without a vector must not reach the model: it rejects other dimensions.
        blank = F.array_repeat(F.lit(0.0), len(clusters.centroids()[0]))
        vectors = marked.withColumn("__v", array_to_vector(F.when(F.col("__ok"), numbers).otherwise(blank)))
    else:
        points = _distinct(texts, ["__text"])
        training = materialise(points.select(N.tfidf_vectors("__text", terms).alias("__v"), "__w"))
        if different_vectors(training, "__v", 2) < 2:
            return _one_segment(cleaned.drop("__text"), out)
        clusters = fit_clusters(training, "__v", k, seed, weight="__w") if batch is None else fit_clusters_in_batches(training, "__v", k, seed, batch, weight="__w")
        vectors = cleaned.withColumn("__v", N.tfidf_vectors("__text", terms)).drop("__text")
    return (
        clusters.assign(vectors, "__segment")
        .withColumn(out, F.when(F.col("__ok"), F.col("__segment")).otherwise(F.lit(-1)))
        .drop("__segment", "__v", "__ok")
    )


def _one_segment(marked: DataFrame, out: str) -> DataFrame:
    """Equal notes are one segment."""
    return marked.withColumn(out, F.when(F.col("__ok"), F.lit(0)).otherwise(F.lit(-1))).drop("__ok")


def squared_distance(vector: Column, center: Sequence[float]) -> Column:
    parts = F.zip_with(vector, F.lit([float(x) for x in center]), lambda a, b: (a - b) * (a - b))
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def assign_nearest(
    df: DataFrame, vector: str, centroids: Sequence[Sequence[float]], out: str = "nearest", distance: str | None = None
) -> DataFrame:
    """Number of the closest centroid (smallest number on ties). The centroids travel as literals."""
    v = F.col(vector).cast("array<double>")
    choices = F.array(*[F.struct(squared_distance(v, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centroids)])
    best = df.withColumn("__best", F.array_min(choices))
    cols = {out: F.col("__best.i")}
    if distance:
        cols[distance] = F.sqrt("__best.d")
    return best.withColumns(cols).drop("__best")


def group_centroids(df: DataFrame, group: str, vector: str, max_groups: int = 1000) -> list[list[float]]:
    """Mean vector of each group in group order: groups times dimensions numbers.

    More than ``max_groups`` groups are an error: the vectors go to the driver and into an expression.
    """
    vectors = df.select(group, array_to_vector(F.col(vector).cast("array<double>")).alias("__v"))
    means = vectors.groupBy(group).agg(Summarizer.mean(F.col("__v")).alias("__m"))
    means = materialise(means)
    if (found := means.count()) > max_groups:
        raise ValueError(f"{found} groups in {group}, at most {max_groups} expected")
    means = means.orderBy(group)
    return [row["__m"].toArray().tolist() for row in means.collect()]


#: Bytes of centres that one pass over the rows holds in a broadcast.
PASS_BYTES = 64 << 20
_CENTRES = 2048  # centres compared at once
#: Different centres up to which every row is compared with all; beyond that those of a cell of space, and the most cells.
FEW_CENTRES, CELL_CENTRES, MOST_CELLS = 8_192, 512, 16_384
#: Cells beside its own that a row may visit, and rows of a cell worked at once.
MOST_VISITS, CELL_ROWS = 64, 20_000
_SAMPLED = 32  # centres drawn for each cell to cut space


def group_centres(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, centre) with the mean vector of each group; any number of groups, none reaches the driver."""
    vectors = df.select(group, array_to_vector(F.col(vector).cast("array<double>")).alias("__v"))
    means = vectors.groupBy(group).agg(Summarizer.mean(F.col("__v")).alias("__m"))
    return means.select(group, vector_to_array("__m").alias("centre"))


def nearest_in_block(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and squared distance of each row's nearest centre, the first of equally near ones.

    Matrix products tell which centres can be nearest; those few are compared by their differences, so that
    rounding does not decide.
    """
    place, least = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)
    norms = np.einsum("ij,ij->i", x, x)
    for first in range(0, len(centres), _CENTRES):
        some = centres[first : first + _CENTRES]
        sizes = np.einsum("ij,ij->i", some, some)
        rough = norms[:, None] - 2.0 * (x @ some.T) + sizes
        slack = 1e-9 * (norms + sizes.max(initial=0.0)) + 1e-300
        row, col = np.nonzero(rough <= (rough.min(axis=1) + slack)[:, None])
        exact = ((x[row] - some[col]) ** 2).sum(axis=1)
        order = np.lexsort((col, exact, row))
        head = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        better = exact[head] < least[row[head]]
        at = row[head][better]
        least[at], place[at] = exact[head][better], col[head][better] + first
    return place, least


def _nearer(shared, kind: str):
    """Column function: (vector, distance so far, group so far) -> the nearer of that and the centres of a broadcast (matrix, groups)."""

    @F.pandas_udf(f"d double, g {kind}")
    def nearer(vectors: pd.Series, d: pd.Series, g: pd.Series) -> pd.DataFrame:
        matrix, names = shared.value
        known = vectors.notna().to_numpy()
        best_d, best_g = d.to_numpy(dtype=float, na_value=np.nan).copy(), g.astype(object).where(g.notna(), None).to_numpy().copy()
        rows = np.flatnonzero(known)
        if rows.size:
            place, least = nearest_in_block(np.vstack(vectors[known].to_numpy()).astype(float), matrix)
            near = np.sqrt(least)
            better = np.isnan(best_d[rows]) | (near < best_d[rows])
            best_d[rows[better]] = near[better]
            best_g[rows[better]] = [names[i] for i in place[better]]
        return pd.DataFrame({"d": pd.Series(best_d).astype(object).where(~np.isnan(best_d), None), "g": pd.Series(best_g, dtype=object)})

    return nearer


def assign_nearest_of_many(
    df: DataFrame, vector: str, centres: DataFrame, group: str, out: str = "nearest", distance: str = "distance", pass_bytes: int = PASS_BYTES, few: int = FEW_CENTRES
) -> DataFrame:
    """``df`` with the group of the nearest centre (the smallest group of equally near ones) and its distance.

    ``centres`` has ``group`` and centre, any number of them, all as long as the vectors. Up to ``few`` different ones are
    compared with every row, in blocks of at most ``pass_bytes`` (see ``_by_passes``); more are parted into cells of space, and a row
    meets those of the cells that may hold its nearest one (see ``_by_cells``). Both are exact. Rows with a null vector get nulls;
    a null group or a number that is not finite make no centre; an empty table of centres gives nulls.
    """
    c = F.col("centre").cast("array<double>")
    real = c.isNotNull() & F.col(group).isNotNull() & F.forall(c, lambda a: F.coalesce(F.abs(a) < F.lit(math.inf), F.lit(False)))
    # equal centres are one, of the smallest group
    listed = materialise(centres.filter(real).groupBy(c.alias("c")).agg(F.min(group).alias("g")))
    kind = listed.schema["g"].dataType.simpleString()
    total, width = listed.agg(F.count("*"), F.max(F.size("c"))).first()
    if total <= few:
        found = _by_passes(df, F.col(vector).cast("array<double>"), listed, kind, total, width, pass_bytes)
        return found.withColumnsRenamed({"__g": out, "__d": distance})
    stored = materialise(df.withColumn("__row", F.monotonically_increasing_id()))
    found = _by_cells(stored.select("__row", F.col(vector).cast("array<double>").alias("x")), listed, kind, total, width, pass_bytes)
    return stored.join(found, "__row", "left").drop("__row").withColumnsRenamed({"__g": out, "__d": distance})


def _by_passes(df: DataFrame, vector: Column, listed: DataFrame, kind: str, total: int, width: int | None, pass_bytes: int) -> DataFrame:
    """``df`` with the nearest centre's distance and group in ``__d`` and ``__g``.

    Centres are taken in blocks of at most ``pass_bytes``; each block is a broadcast of that size and one pass over the rows,
    which keeps the nearest so far in a stored column.
    """
    spark = df.sparkSession
    found = df.withColumns({"__d": F.lit(None).cast("double"), "__g": F.lit(None).cast(kind)})
    if not total:
        return found
    per_pass = max(1, pass_bytes // (8 * max(1, width)))
    # blocks by ranges of the group, so that an earlier block wins a tie
    cuts = [] if total <= per_pass else _range_cuts(listed, math.ceil(total / per_pass))
    bounds = list(zip([None, *cuts], [*cuts, None], strict=True))
    for low, high in bounds:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("g") > F.lit(low))
        if high is not None:
            inside = inside & (F.col("g") <= F.lit(high))
        block = listed.filter(inside).orderBy("g").collect()
        if not block:
            continue
        shared = spark.sparkContext.broadcast((np.array([r["c"] for r in block], dtype=float), [r["g"] for r in block]))

        nearer = _nearer(shared, kind)
        step = found.withColumn("__n", nearer(vector, F.col("__d"), F.col("__g")))
        found = step.withColumns({"__d": F.col("__n.d"), "__g": F.col("__n.g")}).drop("__n")
        if len(bounds) > 1:
            found = materialise(found)
    return found


@dataclass(frozen=True)
class Cells:
    """Space parted by cuts: inner node i cuts at ``cut[i]`` of coordinate ``dim[i]``, its children are 2i + 1 and 2i + 2.

    ``low`` and ``high`` are the bounds of the centres below each node; ``home`` names a cell that holds centres for every cell.
    """

    dim: np.ndarray
    cut: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    home: np.ndarray | None = None

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while len(self.dim) and at.size and at[0] < len(self.dim):  # all cells are equally deep
            at = 2 * at + 1 + (x[rows, self.dim[at]] > self.cut[at])
        return at - len(self.dim)

    def bounded(self, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> Cells:
        """The same cells with the bounds of their centres; cells that are not named hold none."""
        inner, width = len(self.dim), low.shape[1]
        lows, highs = np.full((2 * inner + 1, width), np.inf), np.full((2 * inner + 1, width), -np.inf)
        lows[inner + cells], highs[inner + cells] = low, high
        for i in range(inner - 1, -1, -1):
            lows[i], highs[i] = np.minimum(lows[2 * i + 1], lows[2 * i + 2]), np.maximum(highs[2 * i + 1], highs[2 * i + 2])
        known = np.sort(cells)
        return Cells(self.dim, self.cut, lows, highs, known[np.searchsorted(known, np.arange(inner + 1)).clip(max=len(known) - 1)])

    def within(self, x: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows and cells whose bounds are no farther from the row than ``most`` (a squared distance)."""
        limit = most * (1 + 1e-9) + 1e-300
        rows, cells, todo = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [(0, np.arange(len(x)))]
        while todo:
            node, here = todo.pop()
            gap = np.maximum(self.low[node] - x[here], x[here] - self.high[node]).clip(min=0)
            here = here[np.einsum("ij,ij->i", gap, gap) <= limit[here]]
            if here.size and node < len(self.dim):
                todo += [(2 * node + 1, here), (2 * node + 2, here)]
            elif here.size:
                rows.append(here)
                cells.append(np.full(here.size, node - len(self.dim)))
        return np.concatenate(rows), np.concatenate(cells)


def cut_space(sample: np.ndarray, levels: int) -> Cells:
    """2 ** ``levels`` cells with about equally many of the sampled centres, cut at medians of the widest coordinate."""
    dim, cut = np.zeros(2**levels - 1, dtype=np.int64), np.zeros(2**levels - 1)
    parts = {0: sample}
    for i in range(len(dim)):
        part = parts.pop(i)
        if len(part):
            dim[i] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            cut[i] = np.sort(part[:, dim[i]])[(len(part) - 1) // 2]
        right = part[:, dim[i]] > cut[i]
        parts[2 * i + 1], parts[2 * i + 2] = part[~right], part[right]
    return Cells(dim, cut)


def _by_cells(rows: DataFrame, listed: DataFrame, kind: str, total: int, width: int, pass_bytes: int) -> DataFrame:
    """(__row, __d, __g) of the rows (__row, x) with a vector, for any number of different centres.

    Space is cut into cells of about ``CELL_CENTRES`` centres by a bounded sample of them. A row meets the centres of its own cell first; it
    then visits only cells whose centres' bounds are no farther than the nearest so far. Rows that would visit more than ``MOST_VISITS``
    cells (vectors of many coordinates have no near cells) or have numbers that are not finite are compared with all centres.
    Rows and centres meet by an equi-join on the cell; a cell of many rows is parted, with its centres beside each part.
    """
    spark = rows.sparkSession
    most = min(MOST_CELLS, pass_bytes // (8 * _SAMPLED * width))
    levels = max(0, min(math.ceil(math.log2(total / CELL_CENTRES)), int(math.log2(max(1, most)))))
    share = min(1.0, _SAMPLED * 2**levels / total)
    sample = listed.filter(F.pmod(F.xxhash64("c"), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30)))).select("c").collect()
    cuts = spark.sparkContext.broadcast(cut_space(np.array([r["c"] for r in sample], dtype=float).reshape(-1, width), levels))

    @F.pandas_udf("int")
    def cell(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="int32")
        v = np.vstack(x.to_numpy())
        return pd.Series(np.where(np.isfinite(v).all(axis=1), cuts.value.place(v), -1))

    placed = materialise(listed.withColumn("cell", cell("c")))
    v = array_to_vector("c")
    bounds = placed.groupBy("cell").agg(Summarizer.min(v).alias("low"), Summarizer.max(v).alias("high")).collect()  # a row for each cell
    low, high = (np.array([r[side].toArray() for r in bounds]) for side in ("low", "high"))
    tree = spark.sparkContext.broadcast(cuts.value.bounded(np.array([r["cell"] for r in bounds]), low, high))
    home = F.pandas_udf(lambda c: pd.Series(np.where(c < 0, -1, tree.value.home[c.clip(lower=0)])), "int")
    own = materialise(rows.filter(F.col("x").isNotNull()).withColumn("cell", home(cell("x"))))

    def met(mine: pd.DataFrame, theirs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list]:
        theirs = theirs.sort_values("g")  # the first of equally near ones
        x = np.vstack(mine["x"].to_numpy())
        place, least = nearest_in_block(x, np.vstack(theirs["c"].to_numpy()))
        return x, least, theirs["g"].to_numpy(dtype=object)[place].tolist()

    def first(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine):
            return pd.DataFrame({"__row": [], "d": [], "g": [], "x": [], "cells": []})
        x, least, g = met(mine, theirs)
        near, cells = tree.value.within(x, least)
        other = cells != mine["cell"].iloc[0]
        near, cells = near[other], cells[other]
        order = np.argsort(near, kind="stable")
        visits = np.split(cells[order], np.cumsum(np.bincount(near, minlength=len(x)))[:-1])
        many = [len(c) > MOST_VISITS for c in visits]
        return pd.DataFrame({
            "__row": mine["__row"].to_numpy(), "d": least, "g": pd.Series(g, dtype=object),
            "x": pd.Series([v if len(c) else None for v, c in zip(x, visits, strict=True)], dtype=object),
            "cells": pd.Series([None if m else c for m, c in zip(many, visits, strict=True)], dtype=object),
        })

    def later(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine):
            return pd.DataFrame({"__row": [], "d": [], "g": []})
        _, least, g = met(mine, theirs)
        return pd.DataFrame({"__row": mine["__row"].to_numpy(), "d": least, "g": pd.Series(g, dtype=object)})

    def meet(some: DataFrame, run, schema: str) -> DataFrame:
        parts = F.broadcast(some.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts")))  # a row for each cell
        left = some.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("__row"), F.col("parts")).cast("int")).drop("parts")
        right = placed.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        return left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInPandas(run, schema)

    begun = materialise(meet(own.filter("cell >= 0"), first, f"__row bigint, d double, g {kind}, x array<double>, cells array<int>"))
    visits = begun.filter(F.size("cells") > 0).select("__row", "x", F.explode("cells").alias("cell"))
    near = begun.filter(F.col("cells").isNotNull()).select("__row", "d", "g").unionByName(meet(visits, later, f"__row bigint, d double, g {kind}"))
    best = near.groupBy("__row").agg(F.min(F.struct("d", "g")).alias("b")).select("__row", F.sqrt("b.d").alias("__d"), F.col("b.g").alias("__g"))
    rest = begun.filter(F.col("cells").isNull()).select("__row", "x").unionByName(own.filter("cell < 0").select("__row", "x"))
    if rest.isEmpty():
        return best
    return best.unionByName(_by_passes(spread(rest), F.col("x"), listed, kind, total, width, pass_bytes).select("__row", "__d", "__g"))


def _range_cuts(listed: DataFrame, parts: int) -> list:
    """Groups that cut the table into about equal ranges: the largest of each range but the last."""
    ranged = listed.select("g").repartitionByRange(parts, "g").withColumn("__p", F.spark_partition_id())
    rows = ranged.groupBy("__p").agg(F.max("g").alias("g")).collect()
    return sorted(r["g"] for r in rows)[:-1]
