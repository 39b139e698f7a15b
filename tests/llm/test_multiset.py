"""Multiset fingerprints against plain Python and against themselves."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from leadloom.llm import edits, multiset, queries
from tests.llm import edges

SF = "/root/testdata/sf0.001"


def vector(text, hashes):
    """The fingerprint from scratch; ``hashes`` maps word pairs to Spark's XXH64."""
    lanes, cells = [0] * multiset.LANES, [0] * multiset.CELLS
    for paragraph in (text or "").split("\n"):
        digest = hashlib.sha512(paragraph.encode()).hexdigest()
        lanes = [(v + int(digest[8 * i : 8 * i + 8], 16)) % (1 << 32) for i, v in enumerate(lanes)]
        for pair in pairs(paragraph):
            h = hashes(pair)
            cells[h & (multiset.CELLS - 1)] += 1 if (h >> 20) & 1 else -1
    return lanes + [(c + 32768) % 65536 - 32768 for c in cells]


def pairs(paragraph):
    words = [w for w in paragraph.translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    return list(zip([None, *words], words, strict=False))


def spark_hash(pair):
    """Spark's xxhash64 of one or two strings: seed 42, each hash the seed of the next, nulls skipped."""
    seed = 42
    for part in pair:
        if part is not None:
            seed = xxhash.xxh64_intdigest(part.encode(), seed)
    return seed


def written(v):
    return "".join(f"{x % (1 << 32):08x}" for x in v[: multiset.LANES]) + "".join(f"{x % 65536:04x}" for x in v[multiset.LANES :])


def like(a, b):
    if a == b:
        return 1.0
    x, y = a[multiset.LANES :], b[multiset.LANES :]
    squares = sum(v * v for v in x) + sum(v * v for v in y)
    return max(0.0, min(1.0, 2 * sum(p * q for p, q in zip(x, y, strict=True)) / squares)) if squares else 0.0


def plain(rows):
    """All results by brute force from (doc_id, text)."""
    def signed(pair):
        return spark_hash(pair)

    rows = [(k, t or "") for k, t in rows]
    text_hash = lambda t: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(t.encode(), 42))
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, text_hash(r[1])))
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = (vector(t, signed) for t in (text, edited, after))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), like(a, b), like(a, c)))
    return out


def comparable(rows):
    return sorted([(*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows], key=repr)


@pytest.mark.parametrize("make", [edges.documents, lambda s: s.read.parquet(f"{SF}/documents.parquet")])
@pytest.mark.parametrize("chunk", [1, 4096])
def test_equal_to_brute_force(spark, monkeypatch, make, chunk):
    monkeypatch.setattr(edits, "CHUNK", chunk)
    docs = make(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    names = ("id", "none", "tie", "m", "n", "at", "one", "head", "part", "sign", "vector", "copies")
    got = edits.with_edits(docs.withColumns({n: F.lit("clash") for n in names}).repartition(5))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert comparable(tuple(r) for r in got.collect()) == comparable(plain(rows))


def test_few_documents(spark):
    assert edits.with_edits(edges.empty(spark)).count() == 0
    for rows in ([(1, "a b c d e f g h")], [(1, None)], [(None, "")], [(2, "abcd\nefgh"), (2, "abcd\nefgh"), (2, "abcd\nefgh")], [(3, "x" * 9), (1, "two\nlines here")]):
        got = edits.with_edits(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert comparable(tuple(r) for r in got.collect()) == comparable(plain(rows))


def test_order_insertion_and_deletion(spark):
    drawn = random.Random(2)
    lines = [" ".join(drawn.choice(["red", "green", "blue", "tea"]) for _ in range(drawn.randint(0, 9))) for _ in range(300)]
    mixed = lines[:]
    drawn.shuffle(mixed)
    rows = [("whole", "\n".join(lines)), ("mixed", "\n".join(mixed)), ("front", "\n".join(lines[:120])), ("back", "\n".join(lines[120:])), ("other", "\n".join([*lines[1:], "new"]))]
    prints = {r["name"]: r["vector"] for r in multiset.fingerprints(spark.createDataFrame(rows, "name string, text string"), ["name"]).collect()}
    assert prints["whole"] == prints["mixed"] != prints["other"]
    named = spark.createDataFrame([tuple(prints[n] for n, _ in rows)], ", ".join(f"{n} array<bigint>" for n, _ in rows))
    got = named.select(
        multiset.added(F.col("front"), F.col("back")).alias("sum"), multiset.removed(F.col("whole"), F.col("back")).alias("rest"),
        multiset.likeness(F.col("whole"), F.col("mixed")).alias("same"), multiset.likeness(F.col("whole"), F.col("other")).alias("near"),
    ).first()
    assert got["sum"] == prints["whole"] and got["rest"] == prints["front"]
    assert got["same"] == 1.0 and 0.9 < got["near"] <= 1.0


def test_edits_are_nearer_than_neighbours(spark):
    rows = [r for r in queries.op11_fingerprints(spark, SF).collect() if r["n_chars"] > 400]
    closer = sum(r["near_edited"] > r["near_next"] for r in rows)
    assert closer > 0.97 * len(rows)
    assert sorted(r["near_next"] for r in rows)[len(rows) // 2] < 0.2 < 0.6 < sorted(r["near_edited"] for r in rows)[len(rows) // 2]
