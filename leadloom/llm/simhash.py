"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 majority bits over the XXH64 hashes of a text's word shingles. Two fingerprints
within ``MAX_BITS`` = 3 bits differ by at most one bit in one of their two 32-bit halves. So every
distinct fingerprint is filed under both halves, and looked up under the 33 values of the Hamming
ball of radius one around each half; the complete distance of every match is then verified. Equal
fingerprints are one row throughout, so a group of copies of any size costs one lookup.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.components import connected
from leadloom.llm.tables import same, unused
from leadloom.session import materialise

SHINGLE = 3
MAX_BITS = 3
_SEED = 42
_BLOCK = 1 << 16
_HALF = 0xFFFFFFFF


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = (ends[shingle - 1 :] if len(words) > shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        pairs = zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK], strict=True)
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in pairs], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    value = np.packbits(2 * counts > n, bitorder="little")
    return int(value.view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp`` (bigint) of every row."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("bigint")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(*keep, prints(F.col(text)).alias("fp"))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs (a, b), a < b, of different fingerprints in the column ``fp`` of distinct values within ``max_bits`` bits."""
    if max_bits > 3:
        raise ValueError("two halves with balls of radius one cover distances up to 3 bits")
    low, high = F.col("fp").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("fp", 32)
    side = F.lit(1 << 33).cast("bigint")  # tells the halves apart
    filed = prints.select(F.col("fp").alias("b"), F.explode(F.array(low, high.bitwiseOR(side))).alias("key"))
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << k).cast("bigint") for k in range(32)])
    asked = prints.select(F.col("fp").alias("a"), low.alias("low"), high.bitwiseOR(side).alias("high"), F.explode(flips).alias("flip"))
    asked = asked.select("a", F.explode(F.array(F.expr("low ^ flip"), F.expr("high ^ flip"))).alias("key"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.expr("a ^ b")) <= max_bits)
    return asked.join(filed, "key").filter(near).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``fp`` and ``component_id`` (the smallest doc_id reachable over links) of every row.

    A null or empty text has fingerprint 0 and is linked like any other; repeated rows fall in one
    component; a component without any doc_id has a null id; an empty table gives no rows. Only
    fingerprints are shuffled, never texts. ``keep`` must include doc_id.
    """
    placed = _rooted(docs, text, shingle, max_bits, keep)
    return placed.select(*keep, "fp", "component_id")


def _rooted(docs: DataFrame, text: str, shingle: int, max_bits: int, keep: tuple[str, ...]) -> DataFrame:
    """``near_duplicates`` with ``_root``, the smallest fingerprint of the component: components may share a component_id."""
    stored = materialise(fingerprints(docs, text, shingle, keep))
    distinct = materialise(stored.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = connected(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = rooted.filter(F.col("root").isNotNull())
    roots = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(linked.join(roots, "root").select("fp", "component_id", F.col("root").alias("_root")))
    return stored.join(named, same(stored, named, ["fp"])).select(stored["*"], "component_id", "_root")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id (none if all are null), with the columns of ``docs``.

    Of rows that share that doc_id one stays, the one with the smallest hash of all columns. Components are told apart by
    their fingerprints, not by the document ids, which unrelated texts may share.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    row = unused("row", docs.columns)
    marked = docs.withColumn(row, F.xxhash64(*names, *[c.isNull() for c in names]))
    placed = _rooted(marked.select("doc_id", "text", F.col(row).alias("row")), "text", shingle, max_bits, ("doc_id", "row"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = placed.groupBy("_root").agg(F.min(order).alias("x")).select("x.doc_id", F.col("x.row").alias(row)).distinct()
    found = marked.join(first, same(marked, first, ["doc_id", row]), "left_semi")
    return found.dropDuplicates(["doc_id", row]).select(*names)
