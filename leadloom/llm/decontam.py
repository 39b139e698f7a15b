"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A short test item counts as inside a document when at least ``CONTAINMENT`` = 0.8 of its distinct
five-word shingles occur there. One hash function orders all shingles. The sketch of an item with q
shingles is its ``q - ceil(0.8 q) + 1`` smallest hashes: a document that holds the item must hold one
of them, so the search loses nothing. Items are partitioned by size (powers of two). Each partition has
the largest hash of its sketches as its bound, and the fewest shingles a document needs for it; a
document is sketched by its hashes up to the largest bound among the partitions it is long enough
for. Sketches meet in an equi-join; of every document met all shingle hashes are counted against the items,
and what holds enough of them is verified by the shingles themselves, compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.tables import unused
from leadloom.session import materialise

SHINGLE = 5
CONTAINMENT = 0.8
#: Sketch or shingle tables of at most so many bytes (estimated from the text that Spark counts) are broadcast.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column | str) -> Column:
    """Lower-case runs of letters and digits; none for a null text."""
    return F.coalesce(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), F.array().cast("array<string>"))


def _each(words: str, k: int, what: str) -> str:
    """``what`` for every place i where k words begin, or for the start of a shorter text with any words."""
    places = f"CASE WHEN size({words}) = 0 THEN CAST(array() AS array<int>) ELSE sequence(0, greatest(size({words}) - {k}, 0)) END"
    return f"transform({places}, i -> {what})"


def shingle_hashes(words: str, k: int) -> Column:
    """XXH64 of each shingle, from its words."""
    return F.expr(_each(words, k, f"xxhash64({', '.join(f'get({words}, i + {j})' for j in range(k))})"))


def shingle_texts(words: str, k: int) -> Column:
    """Each distinct shingle as its words joined by blanks."""
    return F.expr(f"array_distinct({_each(words, k, f"array_join(slice({words}, i + 1, {k}), ' ')")})")


def _small(df: DataFrame) -> DataFrame:
    """A stored table marked for broadcast where Spark's figures show it within the bound."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size * 4 <= BROADCAST_BYTES else df


def _item_texts(items: DataFrame, text: str, k: int, share: float) -> tuple[DataFrame, DataFrame]:
    """(item_id, item) and, for each different item text, (item, words, hashes, q, need); both stored."""
    named = items.select("item_id", words_of(F.col(text)).alias("words")).filter("size(words) > 0")
    named = named.withColumn("item", F.array(F.xxhash64("words"), F.xxhash64(F.lit(1), "words")))
    names = materialise(named.select("item_id", "item").distinct())
    single = named.groupBy("item").agg(F.first("words").alias("words"))
    sized = single.withColumn("q", F.size(shingle_texts("words", k)).cast("bigint"))
    hashes = F.sort_array(F.array_distinct(shingle_hashes("words", k)))
    return names, materialise(sized.select("item", "words", hashes.alias("hashes"), "q", F.ceil(F.col("q") * F.lit(share)).alias("need")))


def _contained_texts(docs: DataFrame, theirs: DataFrame, text: str, k: int) -> DataFrame:
    """(body, item, n_shared, q) for each different document text and each different item text inside it.

    Only hashes are counted and moved; the texts of the few pairs that hold enough of them are compared in the end.
    """
    sketch = materialise(theirs.select("item", "need", F.floor(F.log2("q")).cast("int").alias("part"), F.explode(F.expr("slice(hashes, 1, cast(q - need + 1 as int))")).alias("h")))
    bounds = sketch.groupBy("part").agg(F.max("h").alias("bound"), F.min("need").alias("least")).collect()  # at most 63 partitions
    bound = F.lit(None).cast("bigint")
    for least in sorted({b["least"] for b in bounds}):
        most = max(b["bound"] for b in bounds if b["least"] <= least)
        bound = F.when(F.size("hashes") >= least, F.lit(most)).otherwise(bound)

    marked = docs.select(_body(text).alias("body"), F.col(text).alias("text"))
    hashed = marked.select("body", words_of("text").alias("words")).select("body", shingle_hashes("words", k).alias("hashes"))
    low = hashed.select("body", "hashes", bound.alias("bound")).select("body", F.explode(F.expr("filter(hashes, h -> h <= bound)")).alias("h"))
    keys = materialise(sketch.select("h").distinct())
    met = materialise(low.join(_small(keys), "h").select("body").distinct())
    single = materialise(marked.join(_small(met), "body", "left_semi").groupBy("body").agg(F.first("text").alias("text")))
    whole = materialise(theirs.select("item", F.explode("hashes").alias("h")))
    ours = single.select("body", words_of("text").alias("words")).select("body", F.explode(F.array_distinct(shingle_hashes("words", k))).alias("h"))
    counted = ours.join(_small(whole), "h").groupBy("body", "item").agg(F.count("*").alias("n"))
    needs = theirs.select("item", "need")
    near = materialise(counted.join(needs, "item").filter("n >= need").select("body", "item"))
    pairs = near.join(single, "body").join(theirs.select("item", F.col("words").alias("own"), "q", "need"), "item").withColumn("words", words_of("text"))
    shared = F.size(F.array_intersect(shingle_texts("words", k), shingle_texts("own", k))).cast("bigint")
    verified = materialise(pairs.select("body", "item", shared.alias("n_shared"), "q", "need"))  # stored, or the filter would cut the words anew for each shingle
    return verified.filter("n_shared >= need").drop("need")


def _body(text: str) -> Column:
    """128 bits that stand for a text."""
    return F.array(F.xxhash64(text), F.xxhash64(F.lit(1), text))


def contained_items(docs: DataFrame, items: DataFrame, text: str = "text", k: int = SHINGLE, share: float = CONTAINMENT) -> DataFrame:
    """Pairs of documents and the items inside them: doc_id, item_id, n_shared, n_shingles, containment.

    Equal item texts are one search, equal document texts are searched and verified once, and ids are attached
    in the end. Repeated rows of a document give one pair; an id used for different texts, of documents or of items, gives one for
    each. Null and empty texts hold nothing and are no items; a text of fewer than five words is one shingle
    of all its words; equal items each give a pair; empty tables give no pairs. Other columns are not read.
    """
    names, theirs = _item_texts(items, text, k, share)
    found = _contained_texts(docs, theirs, text, k)
    ids = docs.select("doc_id", _body(text).alias("body")).join(_small(found.select("body").distinct()), "body", "left_semi").distinct()
    pairs = ids.join(found, "body").join(names, "item")
    return pairs.select("doc_id", "item_id", "n_shared", F.col("q").alias("n_shingles"), (F.col("n_shared") / F.col("q")).alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, k: int = SHINGLE, share: float = CONTAINMENT) -> DataFrame:
    """The documents that hold no test item, with the columns of ``docs``, whatever they are called."""
    _, theirs = _item_texts(items, "text", k, share)
    leaked = _contained_texts(docs, theirs, "text", k).select("body").distinct()
    key = unused("body", docs.columns)
    return docs.withColumn(key, _body("text")).join(_small(leaked.withColumnRenamed("body", key)), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
