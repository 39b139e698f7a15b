"""Conversation repair against exhaustive search."""

import binascii
import hashlib
import itertools
import random
import re

import pytest

from leadloom.llm import dialogue, queries

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def best_repair(rows):
    """(cost, audit, roles and texts) by trying all edits; rows are (role, text, fault)."""
    n, most = len(rows), 2 * len(rows)
    found = None
    for k in range(most // dialogue.INSERT + 1):
        for spots in itertools.combinations_with_replacement(range(n + 1), k):
            for letters in itertools.product("KRD", repeat=n):
                audit = "".join("I" * spots.count(i) + (letters[i] if i < n else "") for i in range(n + 1))
                length = len(audit) - audit.count("D")
                roles = ("s" * (length % 2) + "ua" * length)[:length]
                if length == 1:
                    continue
                cost, out, at, row = 0, [], 0, 0
                for letter in audit:
                    role, text, fault = rows[row] if letter != "I" else (None, "", 0)
                    if letter != "I":
                        row += 1
                    if letter == "D":
                        cost += 2
                        continue
                    want = roles[at]
                    at += 1
                    full = {"s": "system", "u": "user", "a": "assistant"}[want]
                    if fault in (1, 2) or (letter == "K" and role[:1] != want) or (letter != "K" and want == "s"):
                        cost = None
                        break
                    cost += {"K": 0, "R": 1, "I": 5}[letter] + (5 if fault == 3 else 0)
                    out.append(f"{role if letter == 'K' else full}:{text}")
                if cost is not None and (found is None or (cost, audit) < found[:2]):
                    assert PATTERN.fullmatch(roles)
                    found = (cost, audit, out)
    return found


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        inside = text.strip(" \t\n\x0b\x0c\r")
        fault = 1 if not inside else 2 if (role, text) in seen else 3 if inside[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain(turns):
    """Every result of a conversation by brute force; turns are (turn, role, text) in order."""
    marked = faults([(r, t) for _, r, t in turns])
    numbers = {t for t, _, _ in turns if t is not None}
    cost, audit, out = best_repair(marked)
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(marked)]
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        "blank": sum(f == 1 for *_, f in marked), "duplicate": sum(f == 2 for *_, f in marked), "truncated": sum(f == 3 for *_, f in marked),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def test_least_repairs_equal_an_exhaustive_search():
    drawn = random.Random(5)
    for _ in range(400):
        rows = faults([(drawn.choice(["system", "user", "assistant", "tool", ""]), drawn.choice(["a.", "b!", "c", " ", "d?"])) for _ in range(drawn.randint(0, 5))])
        chart = dialogue.Chart()
        for role, _, fault in rows:
            chart.add(dialogue.turn_cell(role[:1], fault))
        assert dialogue.cheapest(chart.whole()) == best_repair(rows)[:2]


def test_any_cut_gives_the_same_cell():
    drawn = random.Random(9)
    for _ in range(60):
        cells = [dialogue.turn_cell(drawn.choice("suax"), drawn.choice([0, 0, 1, 2, 3])) for _ in range(9)]
        chart = {(i, i + 1): cells[i] for i in range(9)}
        for size in range(2, 10):  # the whole chart, bottom-up by length
            for i in range(10 - size):
                spans = {dialogue.joined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)}
                assert len(spans) == 1
                chart[i, i + size] = spans.pop()
        short = dialogue.Chart()
        for cell in cells:
            short.add(cell)
        assert short.whole() == chart[0, 9]


def edge_rows():
    long = "word " * 40_000 + "end."
    return [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi."),
        (2, 1, "user", "x."), (2, 1, "user", "x."), (2, 1, "assistant", "x."), (2, None, "assistant", "first."),
        (3, None, None, None), (3, None, "user", None), (None, 4, "user", "a."), (None, 9, "assistant", "b"),
        (4, 5, "", ""), (5, 1, "user", long), (5, 7, "user", long), (5, 9, "Ünï", "😀!"), (6, 0, "assistant", "only."), (7, 3, "user", " \t. \x0b"),
    ]


def by_conversation(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for c, v in out.items()}


def results(spark, frame):
    plan = dialogue.repair_plan(frame)
    named = {r["conv_id"]: r["sha256"] for r in dialogue.digests(dialogue.repaired_turns(frame, plan)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} | {"repaired_sha256": named.get(r["conv_id"], empty)} for r in plan.collect()}


@pytest.mark.parametrize("parts", [1, 5])
def test_edge_conversations(spark, parts):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(edge_rows(), TURNS).repartition(parts)
    frame = frame.withColumns({n: F.lit("clash") for n in ("pos", "piece", "h", "g", "audit", "fault", "at", "first")})
    assert results(spark, frame) == {c: plain(v) for c, v in by_conversation(edge_rows()).items()}
    assert dialogue.repair_plan(frame.limit(0)).count() == 0


@pytest.fixture
def fixed_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_a_conversation_in_many_pieces(spark, fixed_partitions):
    """One conversation that spreads over several ranges gives what one task gives."""
    drawn = random.Random(3)
    rows = [(1, i // 2, drawn.choice(["user", "assistant", "system"]), drawn.choice(["a.", "b", "c!", "", f"{i}."])) for i in range(3000)]
    frame = spark.createDataFrame(rows, TURNS)
    pieces = dialogue.faulty_turns(frame).select("piece").distinct().count()
    assert pieces > 1
    (got,) = dialogue.repair_plan(frame).collect()
    chart, ordered = dialogue.Chart(), dialogue.faulty_turns(frame).orderBy("pos").collect()
    for r in ordered:
        chart.add(dialogue.turn_cell(r["initial"], r["fault"]))
    assert (got["cost"], got["audit"]) == dialogue.cheapest(chart.whole())
    texts = [t for _, t, _ in faults([(r, t) for _, _, r, t in rows])]
    assert len(texts) == 3000 and got["blank"] == sum(not t for t in texts)
    turns = dialogue.repaired_turns(frame, spark.createDataFrame([got])).collect()
    assert PATTERN.fullmatch("".join(r["role"][0] for r in turns))
    assert [r["at"] for r in turns] == list(range(len(turns)))


def test_query_meets_its_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    damaged = []
    for conv, turn, role, text in rows:
        kind = binascii.crc32(f"{conv}:{turn}".encode()) % 20
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    groups = by_conversation(damaged)
    want = {c: plain(groups.get(c, [])) if len(groups.get(c, [])) < 7 else None for c in {r[0] for r in rows}}
    got = {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in queries.op13_conversation_repair(spark, SF).collect()}
    assert set(got) == set(want)
    assert {c: got[c] for c, v in want.items() if v} == {c: v for c, v in want.items() if v}
    assert sum(v is not None for v in want.values()) > 10


def test_query_of_an_emptied_conversation(spark, tmp_path):
    """All turns dropped by the damage: zeros, an empty audit and the hash of nothing."""
    dropped = next(i for i in range(10_000) if binascii.crc32(f"{i}:0".encode()) % 20 == 0)
    lost = next(i for i in range(10_000) if binascii.crc32(f" :{i}".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "gone."), (None, lost, "user", "gone too."), (None, None, None, None)]
    spark.createDataFrame(rows[:2], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_conversation_repair(spark, str(tmp_path)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r["conv_id"] or -1, r["cost"], r["audit"], r["gaps"], r["illegal"], r["repaired_sha256"]) for r in got) == [(-1, 0, "", 0, 0, empty), (dropped, 0, "", 0, 0, empty)]
