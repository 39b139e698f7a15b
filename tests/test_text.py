import re
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadloom import vocab
from leadloom.functions import text as X
from leadloom.operators import notes as N


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, want",
    [
        ("o'neil-smith", "O'Neil-Smith"),
        ("al ain", "Al Ain"),
        ("ABU DHABI 2nd", "Abu Dhabi 2Nd"),
        ("", ""),
        (None, None),
        ("élan vital", "Élan Vital"),
    ],
)
def test_title_case(spark, value, want):
    assert one(spark, value, X.title_case("v")) == want


@pytest.mark.parametrize(
    "value, want",
    [
        (None, "others"),
        ("", "others"),
        ("AOS retire", "retire"),
        ("Direct Traffic", "direct traffic"),
        ("x LOOKALIKE y", "lookalike"),
        ("club aos", "club"),
    ],
)
def test_keyword_class_takes_the_first_listed_word(spark, value, want):
    assert one(spark, value, X.keyword_class("v")) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("x.linkedin.client", "linkedin"),
        ("my-site", "PJ"),
        ("MY.SITE", "MY.SITE"),
        ("www.site", "Website"),
        ("site label", "Website"),
        ("a client b", "Client App"),
        ("first line\nwww.site/x\nlast", "first line\nWebsite\nlast"),
        (None, None),
        ("", ""),
    ],
)
def test_regex_class_applies_rules_in_order(spark, value, want):
    assert one(spark, value, X.regex_class("v", vocab.page_rules("site", "site label"))) == want


def test_nationality_variants(spark):
    for variant, canonical in vocab.NATIONALITY_VARIANTS.items():
        padded = f" \t{variant.upper()}\n"
        assert one(spark, padded, X.value_map(X.strip_all(F.lower("v")), vocab.NATIONALITY_VARIANTS)) == canonical
    assert one(spark, "france", X.value_map("v", vocab.NATIONALITY_VARIANTS)) == "france"


def test_value_map_without_keep_and_with_null_value(spark):
    assert one(spark, "x", X.value_map("v", {"a": 1}, keep=False)) is None
    assert one(spark, "a", X.value_map("v", {"a": 1}, keep=False)) == 1
    assert one(spark, None, X.value_map("v", {"a": "b"}, keep=False, null_value="none")) == "none"
    assert one(spark, "COMMITTED capital", X.value_map("v", vocab.STAGE_ORDINAL, keep=False, casefold=True)) == 12


def test_flags_treat_null_as_zero(spark):
    assert one(spark, None, X.flag("v", "a")) == 0
    assert one(spark, None, X.contains_flag("v", "a")) == 0
    assert one(spark, "xSALx", X.contains_flag("v", "sal")) == 1
    assert one(spark, " \n\t", X.has_text("v")) is False
    assert one(spark, None, X.has_text("v")) is False


def test_ellipsis_and_prompt_clean(spark):
    assert one(spark, "a" * 30, X.ellipsis("v", 30)) == "a" * 30
    assert one(spark, "a" * 31, X.ellipsis("v", 30)) == "a" * 29 + "…"
    assert one(spark, " café\n\n(ok) – 5 % up! ", X.prompt_clean("v")) == "café ok  5  up!"
    assert one(spark, None, X.prompt_clean("v")) == ""


CLEANED = [
    ("<b>Bold</b> text", "bold text"),
    ("see https://a.b/c?d=e or www.x.org now", "see"),
    ("mail me@x.org or @home or a@ b", "mail home"),
    ("I can't, won't, don't: it's they'll CAN'T", "cannot cannot"),
    ("curly can’t", "curly"),
    ("ﬁne ﬁrm ½ ² ＡＢＣ", "fine firm abc"),
    ("مرحبا meeting tomorrow", "meeting tomorrow"),
    ("a b c dd", "dd"),
    ("   ", ""),
    (None, ""),
    ("well-known - -- x-ray", "well-known -- x-ray"),
    ("para graph nbsp\x1cfs ogham\x85next me @x", "para graph nbsp fs ogham next"),
    ("under_score 42", "score 42"),
    ("x" * 3000 + "@" + "y" * 3000 + " tail", "tail"),
    ("< not a tag > but this", ""),
]


@pytest.mark.parametrize(("text", "want"), CLEANED)
def test_clean_text_on_edge_cases(spark, text, want):
    assert one(spark, text, X.clean_text("v")) == want


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("aB'tn @.<>/-\n  é１ﬁ:w"), max_size=40), min_size=20, max_size=60))
def test_clean_text_leaves_plain_words(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    for row in df.select(X.clean_text("v").alias("r")).collect():
        words = row["r"].split(" ") if row["r"] else []
        assert all(re.fullmatch(r"[a-z0-9-]{2,}", w) and w not in vocab.STOP_WORDS for w in words)


def test_clean_text_can_keep_other_scripts(spark):
    assert one(spark, "مرحبا été", X.clean_text("v", keep_unicode=True)) == "مرحبا été"


def test_grams(spark):
    assert one(spark, "follow-up call a ok", N.grams("v")) == [
        "follow", "up", "call", "ok", "follow up", "up call", "call ok",
    ]
    assert one(spark, "", N.grams("v")) == []
    assert one(spark, "one", N.grams("v")) == ["one"]


DOCS = ["red blue red", "blue green", "red blue green green", "solo", "blue blue", "red blue solo red blue"]


@pytest.mark.parametrize("max_features", [1, 2, 3, 4, 6, 50])
def test_terms_and_weights_agree_with_brute_force(spark, max_features):
    import math

    df = spark.createDataFrame(list(enumerate(DOCS)), "id int, t string")
    terms = N.fit_terms(df, "t", max_features=max_features, min_df=2, max_df=0.9)

    def grams(t):
        w = t.split()
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    bags = [grams(t) for t in DOCS]
    words = sorted({g for b in bags for g in b})
    freq = {w: sum(b.count(w) for b in bags) for w in words}
    docs_with = {w: sum(w in b for b in bags) for w in words}
    kept = [w for w in words if 2 <= docs_with[w] <= 0.9 * len(DOCS)]
    kept = sorted(kept, key=lambda w: (-freq[w], w))[:max_features]
    assert list(terms.terms) == kept
    assert list(terms.doc_freq) == [docs_with[w] for w in kept]

    got = {(r["id"], r["term"]): r["tfidf"] for r in N.tfidf_terms(df, "id", "t", terms).collect()}
    want = {}
    for i, b in enumerate(bags):
        raw = {w: b.count(w) * (math.log((1 + len(DOCS)) / (1 + docs_with[w])) + 1) for w in kept if w in b}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        want.update({(i, w): v / norm for w, v in raw.items()})
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    vectors = N.tfidf_model(terms, "g").transform(df.withColumn("g", N.grams("t"))).collect()
    for r in vectors:
        for j, w in enumerate(kept):
            assert abs(r["features"][j] - want.get((r["id"], w), 0.0)) < 1e-12


def test_words_and_pairs_are_counted_before_they_become_rows(spark):
    """One row for each different term of a slice, however often it occurs; before, two for each occurrence."""
    notes = spark.createDataFrame([("red blue " * 500,), ("red-red a blue",), (None,), ("",)], "t string").coalesce(1)
    counted = {pairs: sorted(map(tuple, N._term_counts(notes, pairs).collect())) for pairs in (False, True)}
    assert counted[False] == [("blue", 501, 2), ("red", 502, 2)]
    assert counted[True] == [("blue red", 499, 1), ("red blue", 501, 2), ("red red", 1, 1)]
    assert [tuple(r) for r in N._term_counts(notes, True, ["red"]).collect()] == [("red red", 1, 1)]
    assert N._term_counts(notes, True, []).collect() == []


def test_slices_are_bounded_and_lose_no_note():
    texts = pa.array(["ab"] * 5 + [None, "x" * 50, "", "cd", None])
    parts = [p.to_pylist() for p in N._slices(texts, 4)]
    assert sum(parts, []) == texts.to_pylist() and ["x" * 50] in parts
    assert all(len(p) <= 3 for p in parts) and list(N._slices(texts.slice(0, 0))) == []


@pytest.mark.parametrize("max_features", [4, 9, 50])
def test_many_words_join_the_pairs_to_the_same_terms(spark, max_features):
    df = spark.createDataFrame(list(enumerate([*DOCS, None, "", "déjà vu - vu déjà", "déjà-vu a vu"])), "id int, t string")
    few = N.fit_terms(df, "t", max_features=max_features, min_df=1)
    assert N.fit_terms(df, "t", max_features=max_features, min_df=1, most_known=0) == few
    model = N.tfidf_model(few, "g").transform(df.withColumn("g", F.coalesce(N.grams("t"), F.array().cast("array<string>"))))
    for r in model.withColumn("v", N.tfidf_vectors("t", few)).collect():
        assert r["v"] == r["features"] and r["v"].size == len(few.terms)


def test_lemma_lookup_keeps_order_and_unknown_words(spark):
    df = spark.createDataFrame([(1, ["calls", "made", "calls"]), (2, [])], "id int, w array<string>")
    lemmas = spark.createDataFrame([("calls", "call"), ("calls", "call")], "form string, lemma string")
    got = {r["id"]: r["tokens"] for r in N.lemma_lookup(df, "id", "w", lemmas).collect()}
    assert got == {1: ["call", "made", "call"], 2: []}


def test_prompt_payload(spark):
    import json

    df = spark.createDataFrame([(1, 0.456, None)], "id int, p double, s string")
    body = N.prompt_payload(df, "Do it.", {"Summary": F.col("s"), "P": N.two_decimals(F.col("p"))}, 7).first()["payload"]
    parsed = json.loads(body)
    assert parsed["max_tokens"] == 7
    assert [c["text"] for c in parsed["messages"][0]["content"]] == ["Do it.", "Summary: ", "P: 0.46"]


def test_normal_forms_hold_few_texts_at_once():
    """The peak beside Arrow's own memory does not grow with the texts of a batch."""
    texts = pa.array([None, "", "ﬁne x²", "e\u0301 \u00a0\u2028"] + ["Grüße " * 2000] * 1000)
    blanks = {0x2028: " "}
    want = [None, "", "fine x2", "é   "]
    assert X.normal_forms(texts, blanks).to_pylist()[:4] == want and X.normal_forms(texts, blanks, 3).to_pylist()[:4] == want
    tracemalloc.start()
    got = X.normal_forms(texts, blanks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == len(texts) and got[-1] == texts[-1]
    assert peak < 4e6 and X.normal_forms(texts.slice(0, 0), blanks).to_pylist() == []


def test_settled_characters_need_no_normal_form(spark):
    """None is changed, reordered or the second of a composed pair; of texts with others every one is found."""
    settled = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), X.SETTLED) + "]")
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    parts = [unicodedata.decomposition(c).split() for c in every]
    seconds = {chr(int(p[1], 16)) for p in parts if len(p) == 2 and p[0][0] != "<"} | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3), 0x85, 0x1680, 0x2028, 0x2029)}
    loose = {c for c in every if unicodedata.normalize("NFKC", c) != c or unicodedata.combining(c)} | seconds
    assert not [hex(ord(c)) for c in loose if settled.match(c) or c.isascii()]
    rows = spark.createDataFrame([(i, f"a{c}") for i, c in enumerate(sorted(loose))], "i int, v string")
    blanks = dict.fromkeys([0x85, 0x1680, 0x2028, 0x2029], " ")
    got = {r["v"]: r["n"] for r in rows.select("v", X.nfkc("v").alias("n")).collect()}
    assert got == {v: unicodedata.normalize("NFKC", v).translate(blanks) for v in got}
    plan = rows.limit(0).select(X.nfkc("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "ASCII" in plan
