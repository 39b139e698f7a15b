"""Quality rules and SimHash near-duplicates against brute force, and on edge rows."""

import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from leadloom.llm import quality, queries, simhash
from leadloom.llm.components import connected
from tests.llm import edges

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)

    def inside(n):
        seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        marked = set()
        for i in range(len(words) - n + 1):
            if seen[tuple(words[i : i + n])] > 1:
                marked.update(range(i, i + n))
        return marked

    chars, lines, seen = sum(map(len, words)), 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    shares = {f"share_{n}": sum(len(words[i]) for i in inside(n)) / chars if chars else 0.0 for n in (5, 7, 10)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return {"n_words": len(words), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": len(inside(3)), **shares}


@pytest.mark.parametrize("make", [edges.documents, lambda s: s.read.parquet(f"{SF}/documents.parquet")])
def test_measures_equal_brute_force(spark, make):
    for row in quality.quality_measures(make(spark).select("doc_id", "text")).collect():
        want = plain_measures(row["text"])
        assert {k: row[k] for k in want} == pytest.approx(want)
        assert row["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        shares = [(want[f"share_{n}"], most) for n, most in quality.NGRAM_LIMITS.items()]
        assert row["kept"] == (not row["base_failed"] and row["line_share"] <= quality.LINE_LIMIT and all(a <= b for a, b in shares))


def test_repetition_is_rejected_and_prose_kept():
    prose = " ".join(f"word{i}" for i in range(200))
    assert quality.judged(quality.measure(prose))["kept"]
    line = " ".join(f"w{i}" for i in range(60))
    assert not quality.judged(quality.measure("\n".join([prose, line, line, line, line, line])))["kept"]


def test_coverage_decides_what_the_base_rule_passes(spark):
    """Texts that repeat a tenth to a third of themselves pass the base rule and are told apart by coverage."""
    for n, kept in ((5, True), (12, True), (40, False), (70, False)):
        words = [f"word{i}" for i in range(300)]
        found = quality.measure(" ".join([*words, *words[:n]]))
        verdict = quality.judged(found)
        assert not verdict["base_failed"] and verdict["kept"] == kept, n
    lines = [" ".join(f"w{i}x{k}" for i in range(20)) for k in range(10)]
    assert quality.judged(quality.measure("\n".join(lines)))["kept"]
    assert not quality.judged(quality.measure("\n".join([*lines, lines[3], lines[5]])))["kept"]
    rows = quality.quality_measures(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    base, rejected = rows.agg(F.count_if(F.expr("NOT base_failed")), F.count_if(F.expr("NOT base_failed AND NOT kept"))).first()
    assert 0 < rejected <= 0.01 * base


def test_empty_table_and_clashing_columns(spark):
    assert quality.quality_measures(edges.empty(spark)).count() == 0
    wide = quality.quality_measures(edges.clashing(edges.documents(spark)))
    assert wide.count() == 12 and dict(wide.dtypes)["kept"] == "boolean" and wide.columns.count("n_words") == 1
    assert quality.kept_documents(edges.clashing(edges.documents(spark))).columns == edges.clashing(edges.documents(spark)).columns


def plain_fingerprint(text, k=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id of each row's component; links by all pairs of different fingerprints."""
    values = sorted(set(prints.values()) if isinstance(prints, dict) else {f for _, f in prints})
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for key, f in prints:
        if key is not None:
            least[root(f)] = min(least.get(root(f), key), key)
    return [least.get(root(f)) for _, f in prints]


@pytest.mark.parametrize("make", [edges.documents, lambda s: s.read.parquet(f"{SF}/documents.parquet")])
def test_near_duplicates_equal_brute_force(spark, make):
    docs = make(spark)
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    want = sorted(zip([k for k, _ in rows], [f"{f:016x}" for _, f in rows], plain_components(rows), strict=True), key=repr)
    found = simhash.near_duplicates(edges.clashing(docs))
    got = sorted(((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in found.collect()), key=repr)
    assert got == want


def test_query_form(spark):
    found = queries.op7_simhash(spark, SF)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in found.collect())


def test_links_find_every_pair_at_three_bits(spark):
    base = 0x0123456789ABCDEF
    values = {base}
    for bits in [(0, 1, 2), (0, 33, 34), (31, 32, 63), (5, 6, 40), (60, 61, 62), (3,), (63,), (0, 1, 2, 3)]:
        v = base
        for b in bits:
            v ^= 1 << b
        values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 9)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(9)}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each(spark):
    docs = edges.documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    roots = simhash._rooted(docs, "text", simhash.SHINGLE, simhash.MAX_BITS, ("doc_id",)).select("_root").distinct()  # components may share an id
    assert kept.count() == roots.count()
    assert simhash.one_of_each(edges.empty(spark)).count() == 0


def test_one_of_each_component_of_fingerprints(spark):
    docs = edges.documents(spark)
    more = [(None, "a clean text that no other row has", "en", "a", 1), (None, "second clean text, not like any other here", "en", "a", 2), (5, "one id for two long unrelated pieces", "en", "a", 3)]
    docs = docs.unionByName(spark.createDataFrame(more, edges.DOCUMENT))
    prints = [(r["doc_id"], r["text"], simhash.fingerprint(r["text"])) for r in docs.collect()]
    root = {fp: fp for _, _, fp in prints}
    for _ in root:
        for a in root:
            root[a] = min(root[b] for b in root if bin((a ^ b) & (2**64 - 1)).count("1") <= simhash.MAX_BITS)
    want = []
    for one in set(root.values()):
        ids = [d for d, _, fp in prints if root[fp] == one]
        want.append((min((d for d in ids if d is not None), default=None), one))
    got = [(r["doc_id"], root[simhash.fingerprint(r["text"])]) for r in simhash.one_of_each(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(got) == len({fp for _, fp in got}) == len(set(root.values()))
