"""Source mixing and benchmark decontamination."""

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from leadloom.llm import decontam, mixing, queries
from leadloom.llm.tables import running_total
from tests.llm import edges

SF = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not more:
            return {s: cap * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= more


@pytest.mark.parametrize("make", [edges.documents, lambda s: s.read.parquet(f"{SF}/documents.parquet")])
def test_mix_meets_its_contract(spark, make):
    docs = make(spark)
    texts = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()]
    sizes = defaultdict(int)
    for _, source, n in texts:
        sizes[source] += n
    want = plain_targets(sizes)
    rows = mixing.mix_plan(edges.clashing(docs).drop("size")).collect()
    assert sorted((r["doc_id"], r["source"], r["size"]) for r in rows if r["doc_id"] is not None) == sorted(
        ((k, s, n) for k, s, n in texts if k is not None), key=lambda x: (x[0], x[1] or "", x[2])
    ) or len(rows) == len(texts)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= largest[source]


def test_rates_are_tilted_by_size_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = sorted(tuple(r) for r in mixing.mix_plan(docs).collect())
    assert first == sorted(tuple(r) for r in mixing.mix_plan(docs.repartition(7)).collect())
    by_source = defaultdict(list)
    for r in mixing.mix_plan(docs).collect():
        if 0 < r["rate"] < 3 and r["size"] > 0:
            by_source[r["source"]].append((math.log(r["rate"]) / r["size"], r["rate"], r["size"]))
    for rows in by_source.values():
        slopes = [s for s, rate, size in rows if abs(math.log(rate)) > 0.05 and rate > 1e-3]
        assert not slopes or max(slopes) - min(slopes) <= 0.01 * max(map(abs, slopes))


def test_mixed_rows_and_empty_table(spark):
    docs = edges.documents(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    plan = mixing.mix_plan(docs)
    assert out.count() == plan.agg(F.sum("copies")).first()[0]
    assert mixing.mixed(edges.empty(spark)).count() == 0 and mixing.mix_plan(edges.empty(spark)).count() == 0


def test_mixed_tells_nulls_apart(spark):
    """Rows that differ only in the column that holds a value are different documents, under any column names."""
    rows = [(7, "one two three four", "a", None, 1), (7, "one two three four", None, "a", 1)]
    docs = edges.clashing(spark.createDataFrame(rows, edges.DOCUMENT)).withColumns({n: F.lit("clash") for n in ("key", "alike", "rows", "copy")})
    got = mixing.mixed(docs, weights=(1.0, 1.0))
    assert got.columns == docs.columns
    assert sorted((r["lang"] or "", r["source"] or "", r["key"]) for r in got.collect()) == [("", "a", "clash"), ("a", "", "clash")]


def test_running_total_of_a_hot_group(spark):
    rows = [(("hot" if i % 3 else None), i % 5, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o int, v bigint")
    got = running_total(df, "v", [F.col("o"), F.col("v")], ["g"], "before").collect()
    for g in ("hot", None):
        at = 0
        for r in sorted((r for r in got if r["g"] == g), key=lambda r: (r["o"], r["v"])):
            assert r["before"] == at
            at += r["v"]


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_pairs(docs, items):
    out = set()
    for key, text in set(docs):
        ours = shingles(text)
        for item, other in set(items):
            theirs = shingles(other)
            shared = len(ours & theirs)
            if theirs and shared >= math.ceil(len(theirs) * 0.8):
                out.add((key, item, shared, len(theirs)))
    return out


def test_containment_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain_pairs([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    got = {(r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in decontam.contained_items(docs, items).collect()}
    assert got == want and want


def test_containment_of_edge_rows(spark):
    words = [f"v{i}" for i in range(40)]
    near = words[:]
    near[20] = "other"  # five of 36 shingles differ
    far = words[:20] + [f"u{i}" for i in range(20)]
    texts = [
        (1, f"{edges.LONG} {' '.join(words)} {edges.LONG}"), (2, f"start {' '.join(near).upper()}, end"), (3, " ".join(far)), (4, None), (5, ""),
        (None, " ".join(words)), (6, "Too short, really"), (1, f"{edges.LONG} {' '.join(words)} {edges.LONG}"),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    items = [(10, " ".join(words)), (11, None), (12, "..."), (13, "too short really"), (None, " ".join(words)), (10, " ".join(words))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contained_items(edges.clashing(docs), edges.clashing(bench)).collect()}
    assert got == {(1, 10), (2, 10), (None, 10), (6, 13), (1, None), (2, None), (None, None)}
    clash = edges.clashing(docs)
    kept = decontam.without_items(clash, bench)
    assert kept.columns == clash.columns and {r["body"] for r in kept.collect()} == {"clash"} == {r["h"] for r in kept.collect()}
    left = decontam.without_items(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contained_items(docs, none).count() == 0 and decontam.without_items(docs, none).count() == len(texts)
    assert decontam.contained_items(docs.limit(0), bench).count() == 0


def test_one_passage_under_many_items_in_many_copies(spark):
    """One text under 60 item ids and in 20,000 documents, most of them copies: one search for each different text."""
    words = " ".join(f"v{i}" for i in range(60))
    copies = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"{words} tail "), F.pmod("id", F.lit(50)).cast("string")).alias("text"))
    items = spark.range(60).select(F.col("id").alias("item_id"), F.lit(words).alias("text"))
    found = decontam.contained_items(copies, items)
    assert found.agg(F.count("*"), F.count_distinct("doc_id"), F.count_distinct("item_id"), F.min("containment")).first() == (1_200_000, 20_000, 60, 1.0)
    names, theirs = decontam._item_texts(items, "text", decontam.SHINGLE, decontam.CONTAINMENT)
    assert names.count() == 60 and theirs.count() == 1
    assert decontam._contained_texts(copies, theirs, "text", decontam.SHINGLE).count() == 50


def test_joins_agree_beyond_the_broadcast_bound(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    first = sorted(tuple(r) for r in decontam.contained_items(docs, items).collect())
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    assert sorted(tuple(r) for r in decontam.contained_items(docs, items).collect()) == first


def test_query_forms(spark):
    assert set(queries.op10_mixing(spark, SF).columns) == {"doc_id", "size", "source_size", "target", "taken"}
    assert "doc_id" in queries.op9_decontamination(spark, SF).columns
