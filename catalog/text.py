"""Note cleaning, lemma lookup, TF-IDF, nearest centroids, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from leadloom import vocab
from leadloom.functions import text as X
from leadloom.operators import clustering as K
from leadloom.operators import notes as N
from leadloom.session import materialise, spread


def clean_sql(col: str) -> str:
    """Cleaned words of a text as a list."""
    text = f"coalesce({col}, '')"
    for pattern in ("<[^>]+>", r"https?://\S+|www\.\S+", r"\S+@\S+"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    for short, full in vocab.CONTRACTIONS:
        pattern = short.replace("'", "''")
        text = f"regexp_replace({text}, '{pattern}', '{full}', 'gi')"
    text = rf"regexp_replace({text}, '[^a-zA-Z0-9\s\-]', ' ', 'g')"
    stops = ", ".join(f"'{w}'" for w in vocab.STOP_WORDS)
    words = rf"regexp_split_to_array(lower(regexp_replace({text}, '^\s+|\s+$', '', 'g')), '\s+')"
    return f"list_filter({words}, lambda w: length(w) >= 2 AND NOT list_contains([{stops}], w))"


def clean_text(spark, d):
    return N.clean_notes(B.table(spark, d, "documents").select("doc_id", "text"), "text", "cleaned").drop("text")


_EXTRA = " They don't ASK, IT'S info@example.net; ﬁne x² y"


def clean_pages(spark, d):
    """Raw pages with markup, addresses, a contraction and compatibility characters."""
    rows = B.table(spark, d, "pages").select("page_id", F.concat_ws(" ", "html", "url", F.lit(_EXTRA)).alias("text"))
    return N.clean_notes(rows, "text", "cleaned").drop("text")


#: DuckDB has no compatibility form: the added characters are spelled out, those of the pages are letters and signs it keeps.
CLEAN_PAGES_SQL = f"""SELECT page_id, array_to_string({clean_sql('text')}, ' ') AS cleaned FROM (
  SELECT page_id, concat_ws(' ', html, url, '{_EXTRA.replace("'", "''").replace("ﬁ", "fi").replace("²", "2")}') AS text FROM pages)"""


def clean_lemmas(spark, d):
    """Cleaned conversations with the words of a lemma table replaced, as the plans do it."""
    rows = B.table(spark, d, "conversations").select("conv_id", "turn", "text")
    forms = rows.select(F.explode(X.note_tokens("text")).alias("form")).distinct().filter(F.col("form").endswith("s") & (F.length("form") > 3))
    lemmas = forms.select("form", F.expr("substr(form, 1, length(form) - 1)").alias("lemma"))
    return B.whole(N.clean_notes(rows, "text", "cleaned", lemmas).drop("text"))


def clean_conversations(spark, d):
    words = X.note_tokens("text")
    return B.table(spark, d, "conversations").select(
        "conv_id", "turn", F.size(words).cast("bigint").alias("n_words"), F.array_join(words, " ").alias("cleaned")
    )


def lemma_lookup(spark, d):
    """Lemmas of conversation words; the lemma table strips the final s of the words that have one."""
    words = B.table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("note_id"), X.note_tokens("text").alias("words")
    )
    forms = words.select(F.explode("words").alias("form")).distinct().filter(
        F.col("form").endswith("s") & (F.length("form") > 3)
    )
    lemmas = forms.select("form", F.expr("substr(form, 1, length(form) - 1)").alias("lemma"))
    found = N.lemma_lookup(words, "note_id", "words", lemmas)
    return found.select("note_id", F.array_join("tokens", " ").alias("lemmas"))


LEMMA_SQL = f"""WITH words AS (SELECT conv_id * 1000 + turn AS note_id, {clean_sql('text')} AS w FROM conversations)
SELECT note_id, array_to_string(list_transform(w, lambda x: CASE WHEN length(x) > 3 AND ends_with(x, 's')
  THEN x[1:length(x) - 1] ELSE x END), ' ') AS lemmas FROM words"""


def term_vocabulary(spark, d):
    cleaned = materialise(clean_text(spark, d))
    terms = N.fit_terms(cleaned, "cleaned")
    return B.tidy(terms.frame(spark).select("term", F.col("df").alias("doc_freq"), "idf"))


def tfidf_top_terms(spark, d):
    """The three heaviest terms of every document."""
    cleaned = materialise(clean_text(spark, d))  # read by both passes of the fit and by the weights
    weighed = N.with_terms(cleaned, "cleaned", N.fit_terms(cleaned, "cleaned"))
    ordered = F.array_sort(F.transform("terms", lambda t: F.struct((-F.round(t["tfidf"], 6)).alias("k"), t["term"].alias("term"))))
    best = weighed.select("doc_id", F.inline(F.slice(ordered, 1, 3)))
    return best.select("doc_id", "term", (-F.col("k")).alias("tfidf"))


_GRAMS_SQL = rf"""
cleaned AS (SELECT doc_id, array_to_string({clean_sql('text')}, ' ') AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '\b\w\w+\b') AS w FROM cleaned),
grams AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
n AS (SELECT count(*) AS n FROM documents),
voc AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term
        HAVING count(*) >= 5 AND count(*) <= 0.9 * (SELECT n FROM n) ORDER BY cf DESC, term LIMIT 5000),
idf AS (SELECT term, df, ln((1 + (SELECT n FROM n)) / (1 + df)) + 1 AS idf FROM voc)"""

TFIDF_SQL = f"""WITH {_GRAMS_SQL},
w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
u AS (SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w)
SELECT doc_id, term, tfidf FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS r FROM u) WHERE r <= 3"""


def nearest_centroid(spark, d):
    """Every embedding with the closest of the mean embeddings of the labels."""
    rows = B.table(spark, d, "embeddings")
    centers = K.group_centroids(rows, "label", "embedding")
    placed = K.assign_nearest(rows, "embedding", centers, "nearest", "distance")
    return B.whole(placed.select("vec_id", "label", "nearest", F.round("distance", 4).alias("distance")))


NEAREST_SQL = """WITH cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
centers AS (SELECT label AS c, pos, avg(x) AS m FROM cells GROUP BY ALL),
ordered AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i FROM (SELECT DISTINCT c FROM centers)),
dist AS (SELECT vec_id, label, c, sum((x - m) * (x - m)) AS d FROM cells JOIN centers USING (pos) GROUP BY ALL)
SELECT vec_id, CAST(label AS BIGINT) AS label, i AS nearest, round(sqrt(d), 4) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS r FROM dist) JOIN ordered USING (c) WHERE r = 1"""


def nearest_of_many(spark, d):
    """Every order with the customer whose mean order (price in thousands, day of the year, weekday) is closest: a centre for each customer."""
    point = F.array(F.col("o_totalprice") / 1000, F.dayofyear("o_orderdate"), F.dayofweek("o_orderdate")).cast("array<double>")
    rows = materialise(B.table(spark, d, "orders").select("o_orderkey", "o_custkey", point.alias("x")))
    placed = K.assign_nearest_of_many(spread(rows), "x", K.group_centres(rows, "o_custkey", "x"), "o_custkey")
    return placed.select("o_orderkey", F.round("distance", 6).alias("distance"))


MANY_SQL = """WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice / 1000 AS a, dayofyear(o_orderdate) AS b, dayofweek(o_orderdate) + 1 AS c FROM orders),
m AS (SELECT o_custkey, avg(a) AS a, avg(b) AS b, avg(c) AS c FROM r GROUP BY 1)
SELECT o_orderkey, round(sqrt(min((r.a - m.a) ** 2 + (r.b - m.b) ** 2 + (r.c - m.c) ** 2)), 6) AS distance FROM r, m GROUP BY 1"""


def prompt_payload(spark, d):
    orders = B.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.max("o_orderpriority").alias("priority")
    )
    rows = B.table(spark, d, "customer").join(orders, "c_custkey", "left")
    built = N.prompt_payload(
        rows,
        "Explain the score in plain words.",
        {
            "Client Summary": F.col("priority"),
            "Model probability": N.two_decimals(F.coalesce(F.col("n_orders"), F.lit(0)) / F.lit(64.0)),
            "Explanation": X.ellipsis("c_name", 12),
        },
    )
    return built.select("c_custkey", "payload")


_TEXT = """json_object('type', 'text', 'text', {})"""
PROMPT_SQL = f"""SELECT c_custkey, CAST(json_object('messages', json_array(json_object('role', 'user', 'content', json_array(
    {_TEXT.format("'Explain the score in plain words.'")},
    {_TEXT.format("'Client Summary: ' || coalesce(priority, '')")},
    {_TEXT.format("'Model probability: ' || printf('%.2f', floor(coalesce(n, 0) / 64.0 * 100 + 0.5) / 100)")},
    {_TEXT.format("'Explanation: ' || CASE WHEN length(c_name) > 12 THEN substr(c_name, 1, 11) || '…' ELSE c_name END")}
  ))), 'max_tokens', 500) AS VARCHAR) AS payload
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS priority FROM orders GROUP BY 1)
  ON o_custkey = c_custkey"""

QUERIES = {
    "clean_text": (clean_text, f"SELECT doc_id, array_to_string({clean_sql('text')}, ' ') AS cleaned FROM documents"),
    "clean_conversations": (
        clean_conversations,
        f"SELECT conv_id, turn, len(w) AS n_words, array_to_string(w, ' ') AS cleaned FROM"
        f" (SELECT conv_id, turn, {clean_sql('text')} AS w FROM conversations)",
    ),
    "clean_pages": (clean_pages, CLEAN_PAGES_SQL),
    "clean_lemmas": (
        clean_lemmas,
        f"""SELECT conv_id, turn, array_to_string(list_transform({clean_sql('text')}, lambda x: CASE WHEN length(x) > 3 AND ends_with(x, 's')
          THEN x[1:length(x) - 1] ELSE x END), ' ') AS cleaned FROM conversations""",
    ),
    "lemma_lookup": (lemma_lookup, LEMMA_SQL),
    "term_vocabulary": (
        term_vocabulary, f"WITH {_GRAMS_SQL} SELECT term, df AS doc_freq, round(idf, 6) AS idf FROM idf"
    ),
    "tfidf_top_terms": (tfidf_top_terms, TFIDF_SQL),
    "nearest_centroid": (nearest_centroid, NEAREST_SQL),
    "nearest_of_many": (nearest_of_many, MANY_SQL),
    "prompt_payload": (prompt_payload, PROMPT_SQL),
}
