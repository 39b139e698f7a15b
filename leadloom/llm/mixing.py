"""Mix documents to target weights of their sources by entropy balancing.

Each source gets a word budget. Among all document rates that spend it, the operator takes those
closest in entropy to "every document once", with at most ``CAP`` copies of a document. They have the
form ``rate = min(CAP, exp(tilt * size / mean size of the source))``, where the tilt of each source
solves the convex dual problem. Newton steps on the logarithm of the spent words find it, each one an
aggregation over the counts of (source, size); a bracket around the solution takes over where a step
leaves it. Sums are kept in whole units of 2**-20, so that reruns agree bit by bit.

The rates become copies by one running total over the documents of a source in order of size: a
document gets as many copies as whole numbers are passed. The words taken then differ from the budget
by no more than about the longest document of the source; of ``_PHASES`` starting points of the total,
each source uses the one that comes nearest.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.tables import running_total, same, unused, word_count
from leadloom.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
_UNIT = 1 << 20
_STEPS = 60
_PHASES = 32
_CLOSE = 1e-5


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> the same with ``target``.

    Sources in code point order, null last, take the weights in turn. The targets share the sum of all
    sizes by weight, none above ``cap`` times its source's size; what a capped source leaves is shared
    again until none is above. Only sums reach the driver.
    """
    numbered = sources.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_total(numbered, "_one", [F.col("source").asc_nulls_last()], [], "_number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_number") % len(weights) + 1).cast("int"))
    weighed = materialise(numbered.select("source", "source_size", weight.alias("_weight"), (F.col("source_size") * cap).alias("_most")))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("_weight") * F.lit(level) > F.col("_most")
        spent, left, n = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("_most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0)),
            F.count_if(full),
        ).first()
        if n == capped or not left:
            break
        capped, level = n, (total - spent) / left
    return weighed.withColumn("target", F.least(F.col("_weight") * F.lit(level), F.col("_most").cast("double"))).drop("_weight", "_most")


def _rate(tilt: Column, size: Column, mean: Column, cap: int) -> Column:
    """Whole units of a document's rate; tilts without a bound (a null) mean the full cap."""
    exponent = F.least(tilt * size / mean, F.lit(math.log(cap)))
    return F.when(tilt.isNull(), F.lit(cap * _UNIT)).otherwise(F.round(F.exp(exponent) * _UNIT)).cast("bigint")


def source_tilts(cells: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Newton steps on the dual: (source, source_size, target, mean, tilt), tilt null for rates at the cap.

    ``cells`` has (source, size, n), sizes above 0. One step is one aggregation of it by source.
    """
    about = cells.groupBy("source").agg(
        F.sum("n").alias("_n"), F.min("size").alias("_least"), F.max("size").alias("_largest")
    )
    state = targets.join(about, same(targets, about, ["source"]), "left").select(
        targets["*"], (F.col("source_size") / F.col("_n")).alias("mean"), (F.col("_least") * F.col("_n") / F.col("source_size")).alias("_x")
    )
    free = (F.col("target") < F.col("source_size") * cap) & (F.col("target") > 0)
    ratio = F.log(F.col("target") / F.col("source_size"))
    state = materialise(
        state.select(
            "source", "source_size", "target", "mean",
            F.when(free, F.lit(0.0)).alias("tilt"),
            F.when(free, F.least(ratio / F.col("_x"), F.lit(0.0))).alias("_low"),
            F.when(free, F.lit(math.log(cap)) / F.col("_x")).alias("_high"),
            (~free | F.col("mean").isNull()).alias("_done"),
        )
    )
    for _ in range(_STEPS):
        if state.filter(~F.col("_done")).isEmpty():
            break
        open_ = state.filter(~F.col("_done"))
        rows = cells.join(open_, same(cells, open_, ["source"])).select(cells["source"], "size", "n", "mean", "tilt")
        rate, x = _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap), F.col("size") / F.col("mean")
        free_x = F.when(rate < cap * _UNIT, (F.round(F.col("size") * x) * rate).cast("decimal(30,0)") * F.col("n"))
        sums = rows.groupBy("source").agg(
            F.sum((F.col("size") * rate).cast("decimal(30,0)") * F.col("n")).alias("_spent"),
            F.coalesce(F.sum(free_x), F.lit(0)).alias("_slope"),
        )
        both = state.join(sums, same(state, sums, ["source"]), "left").select(
            state["*"], (F.col("_spent").cast("double") / _UNIT).alias("_spent"), (F.col("_slope").cast("double") / _UNIT).alias("_slope")
        )
        miss = F.log(F.col("target") / F.col("_spent"))
        over = F.col("_spent") > F.col("target")
        low, high = F.when(over, F.col("_low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("_high"))
        both = both.withColumns({"_l": low, "_h": high})
        step = F.col("tilt") + F.when((F.col("_slope") > 0) & (F.col("_spent") > 0), miss * F.col("_spent") / F.col("_slope"))
        inside = (step > F.col("_l")) & (step < F.col("_h"))
        better = F.when(inside, step).otherwise((F.col("_l") + F.col("_h")) / 2)
        close = (F.abs(F.col("_spent") - F.col("target")) <= _CLOSE * F.col("target")) | (F.col("_h") - F.col("_l") <= 1e-12 * F.abs(F.col("_h")))
        state = materialise(
            both.select(
                "source", "source_size", "target", "mean",
                F.when(F.col("_done") | close, F.col("tilt")).otherwise(better).alias("tilt"),
                F.when(F.col("_done"), F.col("_low")).otherwise(F.col("_l")).alias("_low"),
                F.when(F.col("_done"), F.col("_high")).otherwise(F.col("_h")).alias("_high"),
                (F.col("_done") | F.coalesce(close, F.lit(False))).alias("_done"),
            )
        )
    return state.select("source", "source_size", "target", "mean", "tilt")


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Copies of every document: ``keep``, source, size, source_size, target, rate, copies, taken (one row for each input row).

    A null or empty text has size 0 and takes nothing; a null source is a source of its own; repeated
    rows are documents of their own, and equal ones differ by at most one copy; an empty table gives no
    rows; other columns are not read. Only (id, source, size) rows are moved: the sources' figures come
    by a join that Spark broadcasts if small and splits if skewed.
    """
    columns = list(dict.fromkeys(keep))
    sized = docs.select(*columns, *([] if "source" in columns else ["source"]), word_count(text).alias("size"))
    sized = materialise(sized)
    cells = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    tilts = source_tilts(cells.filter("size > 0"), source_targets(sources, weights, cap), cap)
    joined = sized.join(tilts, same(sized, tilts, ["source"])).select(sized["*"], "source_size", "target", "mean", "tilt")
    rate = F.when((F.col("size") > 0) & (F.col("target") > 0), _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)).otherwise(F.lit(0))
    rated = joined.withColumns({"_rate": rate.cast("bigint"), "_mix": F.xxhash64(*columns)}).drop("mean", "tilt")
    placed = materialise(running_total(rated, "_rate", [F.col("size").asc(), F.col("_mix").asc()], ["source"], "_at"))
    phases = [k * (_UNIT // _PHASES) for k in range(_PHASES)]
    spent = [F.sum(_copies(F.lit(p)) * F.col("size")).alias(f"_{p}") for p in phases]
    sums = placed.groupBy("source").agg(F.first("target").alias("_target"), *spent)
    misses = F.array(*[F.struct(F.abs(F.col(f"_{p}") - F.col("_target")).alias("miss"), F.lit(p).alias("phase")) for p in phases])
    chosen = sums.select("source", F.array_min(misses)["phase"].alias("_phase"))
    done = placed.join(chosen, same(placed, chosen, ["source"])).select(placed["*"], _copies(F.col("_phase")).alias("copies"))
    return done.select(
        *columns, *([] if "source" in columns else ["source"]), "size", "source_size", "target",
        (F.col("_rate") / F.lit(_UNIT)).alias("rate"), "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def _copies(phase: Column) -> Column:
    """Whole units passed between the running total before and after a document."""
    start = F.col("_at") + phase
    return F.call_function("div", start + F.col("_rate"), F.lit(_UNIT)) - F.call_function("div", start, F.lit(_UNIT))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents, each as often as the mix takes it, with the columns of ``docs``, whatever they are called.

    Rows are told apart by two hashes of all their values and of which are null. Equal rows are told apart by
    nothing, so the copies of all of them are summed and given to one.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    key, alike, copies, n, copy = (unused(c, docs.columns) for c in ("key", "alike", "copies", "rows", "copy"))
    values = [*names, *[c.isNull() for c in names]]
    keyed = docs.withColumns({key: F.xxhash64(*values), alike: F.xxhash64(F.lit(1), *values)})
    plan = mix_plan(keyed.select("source", "text", F.col(key).alias("key"), F.col(alike).alias("alike")), weights, cap, keep=("key", "alike"))
    totals = plan.groupBy(F.col("key").alias(key), F.col("alike").alias(alike)).agg(F.sum("copies").alias(copies), F.count("*").alias(n)).filter(F.col(copies) > 0)
    found = keyed.join(totals, [key, alike])
    once = found.filter(F.col(n) == 1).unionByName(found.filter(F.col(n) > 1).dropDuplicates([key, alike]))
    return once.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))).select(*names)
