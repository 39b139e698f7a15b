"""Hard negatives against brute force."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadloom.llm import hardneg, queries

SF = "/root/testdata/sf0.001"
ROWS = "key bigint, label int, vector array<float>"


def plain(rows, anchors, k=5, percent=80):
    """Every result from all scores; rows are (key, label, vector)."""

    def whole(v):
        return [max(-(1 << 24), min(1 << 24, math.floor(256 * float(np.float32(x))))) for x in v]

    def usable(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[2])

    rows = [(key, label, whole(v)) for key, label, v in filter(usable, rows)]
    out = []
    for key, label, v in [(key, label, whole(v)) for key, label, v in filter(usable, anchors)]:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), other, same) for other, same, w in rows)
        alike = [(s, o) for s, o, same in scored if same == label]
        itself = (-sum(a * a for a in v), key)
        if itself in alike:
            alike.remove(itself)
        for less, positive in alike[:k]:
            window = [(o, -s) for s, o, same in scored if same != label and percent * -less <= 100 * -s <= 100 * -less]
            out += [(key, positive, i + 1, o, -less, s) for i, (o, s) in enumerate(window[:k])]
    return sorted(out)


def drawn(n, seed, width=6, step=8):
    pick = random.Random(seed)
    return [(i if pick.random() < 0.95 else pick.randrange(n), pick.choice([0, 0, 0, 1, 2]), [pick.randint(-4, 8) / step for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("block", [3, 8192])
def test_equal_to_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(hardneg, "_ROWS", 16)
    monkeypatch.setattr(hardneg, "_ANCHORS", 2)
    rows = drawn(240, 1)
    frame = spark.createDataFrame(rows, ROWS).repartition(5).withColumns({n: F.lit("clash") for n in ("number", "slot", "score", "one", "place")})
    got = hardneg.hard_negatives(frame, frame.filter("key % 20 = 0"), block=block)
    want = plain(rows, [r for r in rows if r[0] % 20 == 0])
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [0.5, 1.0]), (1, 1, [0.9, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.9, 0.4]), (2, 2, [0.9, 0.4]),
        (3, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (4, 1, None), (5, 2, [None, 1.0]), (6, 2, [nan, 1.0]), (7, 2, [1.0, inf]), (8, 1, []), (9, 2, [1.0]),
        (10, 2, [0.9, 0.4, 7.0]), (11, 3, [3e38, -3e38]), (12, 2, [0.0, 0.0]), (13, 1, [-1.0, -1.0]),
    ]
    frame = spark.createDataFrame(rows, ROWS)
    got = hardneg.hard_negatives(frame, frame.filter("key % 2 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, [r for r in rows if r[0] is not None and r[0] % 2 == 0])
    assert [f.name for f in got.schema] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hardneg.hard_negatives(frame, frame.limit(0)).count() == 0
    assert hardneg.hard_negatives(frame.limit(0), frame.limit(0)).count() == 0
    alone = frame.filter("key = 12")
    assert hardneg.hard_negatives(alone, alone).count() == 0


def test_large_components_are_exact():
    big = np.array([[1 << 24, -(1 << 24), 3.0]] * 2)
    assert hardneg.products(big, big)[0, 0] == 2 * (1 << 48) + 9
    usable, found = hardneg.whole_vectors(pa.array([[1.0], None, [0.5, None], [0.25, -0.001]], pa.list_(pa.float32())), 3)
    assert usable.tolist() == [True, False, False, True] and found[3].tolist() == [64, -1, 0]


def test_query_equals_its_sql(spark):
    found = queries.op12_hard_negatives(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(queries.HARD_NEGATIVES_SQL)
    columns = [c[0] for c in want.description]
    assert columns == found.columns
    rows = sorted(want.fetchall())
    assert sorted(tuple(r) for r in found.collect()) == rows and rows
