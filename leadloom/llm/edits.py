"""Fingerprints of documents and of their edited texts.

The edited text of a document ends with the beginning of the next one. Its fingerprint is not computed
anew: the paragraphs behind the cut are taken away from the document's, and those of the new end added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm import multiset
from leadloom.llm.tables import running_total
from leadloom.session import materialise

#: One part in so many of the code points, at the end of a text, is replaced.
SHARE = 4
#: A task puts out at most so many equal rows of one document at once; more are dealt out first.
CHUNK = 4096
_KEY = ["id", "none", "tie"]


def _ordered(docs: DataFrame) -> DataFrame:
    """Distinct documents with their copies m, length n, place ``at`` in ascending order, and the document before: stored."""
    slim = docs.groupBy(*_KEY).agg(F.count("*").alias("m"), F.max(F.length("text")).alias("n"))
    placed = materialise(running_total(slim.withColumn("one", F.lit(1)), "one", [F.col("none").asc(), F.col("id").asc(), F.col("tie").asc()], [], "at").drop("one"))
    total = placed.count()
    before = placed.select(*[F.col(c).alias(f"before_{c}") for c in _KEY], (F.floor(F.col("n") / SHARE)).alias("wanted"), F.pmod(F.col("at") + 1, F.lit(max(total, 1))).alias("at"))
    return materialise(placed.join(before, "at"))


def with_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    Documents are ordered by doc_id (null last), then by a hash of the text; the last is followed by the
    first, a single one by itself. A null text is empty. Repeated rows follow each other, so the next
    document of all but the last is an equal one. An empty table gives no rows; other columns are not read.

    Texts are moved once, to their key, and beginnings of texts once, to the document before; equal rows are
    made one before they move. What joins and ends the work are vectors of fixed width.
    """
    plain = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    plain = plain.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("none"), F.xxhash64("text").alias("tie"), "text")
    order = _ordered(plain)
    base = plain.groupBy(*_KEY).agg(F.first("text").alias("text"))
    linked = base.join(order, _KEY)
    heads = linked.select(*[F.col(f"before_{c}").alias(c) for c in _KEY], F.expr("substring(text, 1, cast(wanted as int))").alias("head"))
    both = linked.drop("wanted", *[f"before_{c}" for c in _KEY]).join(heads, _KEY)

    part = f"cast(n - floor(n / {SHARE}) as int)"
    both = both.withColumns({"kept": F.expr(f"substring(text, 1, {part})"), "own": F.expr(f"substring(text, 1, cast(floor(n / {SHARE}) as int))")})
    both = both.withColumn("open", F.substring_index("kept", "\n", -1))  # the paragraph that is cut
    facts = both.select(
        *_KEY, "at", "m", "n", F.sha2(F.concat("kept", "head"), 256).alias("sha_next"), F.when(F.col("m") > 1, F.sha2(F.concat("kept", "own"), 256)).alias("sha_twin")
    )
    end = F.expr(f"substring(text, {part} - length(open) + 1)")
    piece = lambda no, sign, body: F.struct(F.lit(no).alias("part"), F.lit(sign).alias("sign"), body.alias("body"))
    changes = [piece(0, 1, F.col("text")), piece(1, -1, end), piece(1, 1, F.concat("open", "head"))]
    twins = [piece(2, -1, end), piece(2, 1, F.concat("open", "own"))]
    pieces = both.select(*_KEY, F.inline(F.when(F.col("m") > 1, F.array(*changes, *twins)).otherwise(F.array(*changes))))
    pieces = pieces.select(*_KEY, "part", "sign", F.explode(multiset.paragraphs("body")).alias("paragraph"))
    vectors = multiset.summed(pieces, _KEY)

    own = multiset.reduced(multiset.part_of("vectors", 0))
    found = facts.join(vectors, _KEY).withColumn("vector", own)
    change = lambda no: multiset.added(F.col("vector"), multiset.part_of("vectors", no))
    found = materialise(found.select("id", "none", "at", "m", "n", "sha_next", "sha_twin", "vector", change(1).alias("next_edit"), F.when(F.col("m") > 1, change(2)).alias("twin_edit")))
    total, most = found.agg(F.count("*"), F.max("m")).first()
    nexts = found.select(F.pmod(F.col("at") - 1, F.lit(max(total, 1))).alias("at"), F.col("vector").alias("after"))
    joined = found.join(nexts, "at")
    last = F.struct(
        F.lit(1).cast("bigint").alias("copies"), F.col("sha_next").alias("edited_sha256"), F.col("next_edit").alias("edited"), multiset.likeness(F.col("vector"), F.col("after")).alias("near_next")
    )
    others = F.struct((F.col("m") - 1).alias("copies"), F.col("sha_twin").alias("edited_sha256"), F.col("twin_edit").alias("edited"), F.lit(1.0).alias("near_next"))
    rows = joined.select("id", "none", "n", "vector", F.inline(F.when(F.col("m") > 1, F.array(last, others)).otherwise(F.array(last))))
    if (most or 0) > CHUNK:  # many equal rows leave from many tasks
        sizes = F.expr(f"transform(sequence(0, div(copies - 1, {CHUNK})), i -> least({CHUNK}, copies - i * {CHUNK}))")
        rows = rows.withColumn("copies", F.explode(sizes)).repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return rows.select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), F.col("n").cast("bigint").alias("n_chars"), "edited_sha256",
        multiset.written(F.col("vector")).alias("fingerprint"), multiset.written(F.col("edited")).alias("edited_fingerprint"),
        multiset.likeness(F.col("vector"), F.col("edited")).alias("near_edited"), "near_next",
    )
