"""The queries of the subpackage over the test tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.llm import decontam, dialogue, edits, hardneg, linefreq, mixing, quality, secretscan, simhash, sitestyle, tokenstore, toxicity, warc
from leadloom.llm.tables import read, same
from leadloom.session import materialise


def op1_secrets(spark, d):
    return secretscan.scan(read(spark, d, "documents").select("doc_id", "text"))


def op2_warc(spark, d):
    return warc.archived(read(spark, d, "pages").select("page_id", "url", "html")).drop("file", "offset")


def op3_main_text(spark, d):
    return sitestyle.main_text(read(spark, d, "pages").select("page_id", "url", "html"))


def op4_toxicity(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.labelled_texts(docs, read(spark, d, "labels")))
    return toxicity.severity(docs, model)


def tokenizer_path() -> str:
    """The tokenizer file of the queries; every worker has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_token_ids(spark, d):
    return tokenstore.stored_layout(read(spark, d, "documents").select("doc_id", "text"), tokenizer_path())


def op6_site_lines(spark, d):
    return linefreq.drop_site_lines(read(spark, d, "pages").select("page_id", "url", "html"))


def _lines_sql() -> str:
    text = r"regexp_replace(coalesce(html, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
    mark, ends = f"chr({ord(linefreq.MARK[0])})", linefreq.ENDS[1:]
    text = f"concat({text}, {mark}, '{ends}')"
    for pattern in linefreq.HIDDEN:
        text = f"regexp_replace({text}, '{pattern}', chr(10), 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{linefreq.BREAKS}', chr(10), 'g'), '{linefreq.TAGS}', '', 'g')"
    text = f"replace({text}, concat({mark}, '{linefreq.MARK[1:]}'), '')"
    for name, sign in linefreq.SIGNS:
        text = f"replace({text}, '{name}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return f"list_filter(list_transform(string_split(regexp_replace({text}, ' +', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')"


SITE_LINES_SQL = f"""WITH cut AS (
  SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '{linefreq.HOST}', 1)) AS host, {_lines_sql()} AS lines FROM pages),
totals AS (SELECT host, count(*) AS total FROM cut GROUP BY host),
counted AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM cut) GROUP BY ALL),
often AS (SELECT host, list(line) AS o FROM counted JOIN totals USING (host) WHERE n >= {linefreq.MIN_PAGES} AND n > total * {linefreq.MAX_SHARE} GROUP BY host),
done AS (SELECT page_id, url, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(o, []), x)) AS kept FROM cut LEFT JOIN often USING (host))
SELECT page_id, url, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, array_to_string(kept, chr(10)) AS text FROM done"""


def op7_simhash(spark, d):
    found = simhash.near_duplicates(read(spark, d, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality(spark, d):
    return quality.quality_measures(read(spark, d, "documents").select("doc_id", "text")).drop("text")


def op9_decontamination(spark, d):
    return decontam.contained_items(read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "benchmark"))


_SHINGLES = """
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN [] ELSE
    list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM (
  SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table})"""
DECONTAMINATION_SQL = f"""WITH theirs AS ({_SHINGLES.format(key='item_id', table='benchmark')}),
ours AS ({_SHINGLES.format(key='doc_id, text', table='documents')}),
sizes AS (SELECT item_id, count(*) AS q FROM theirs GROUP BY item_id),
shared AS (SELECT doc_id, text, item_id, count(*) AS n FROM ours JOIN theirs USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shared, q AS n_shingles, n / q AS containment
FROM shared JOIN sizes USING (item_id) WHERE n >= ceil(q * 0.8)"""


def op10_mixing(spark, d):
    return mixing.mix_plan(read(spark, d, "documents").select("doc_id", "source", "text")).drop("source", "rate", "copies")


def op11_fingerprints(spark, d):
    return edits.with_edits(read(spark, d, "documents").select("doc_id", "text"))


def op12_hard_negatives(spark, d):
    rows = read(spark, d, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("key"), label.alias("label"), F.col("embedding").alias("vector"))
    return hardneg.hard_negatives(rows, rows.filter(F.col("key") % 100 == 0))


HARD_NEGATIVES_SQL = """WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(CAST(256 AS DOUBLE) * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5"""


def damaged_turns(turns):
    """``turns`` with one of five faults in a quarter of the rows, drawn by a checksum of conversation and turn."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"])) % 20
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(spaced["role"])
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate(spaced["text"], ".!?", "")).otherwise(spaced["text"])
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    drawn = turns.select("conv_id", "turn", "role", "text", kind.alias("kind")).filter("kind <> 0")
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("again")).drop("again")


def op13_conversation_repair(spark, d):
    turns = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    damaged = damaged_turns(turns)
    plan = materialise(dialogue.repair_plan(damaged))
    named = dialogue.digests(dialogue.repaired_turns(damaged, plan))
    every = turns.select("conv_id").distinct()
    found = every.join(plan, same(every, plan, ["conv_id"]), "left").select(every["conv_id"], *[plan[c] for c in plan.columns[1:]])
    joined = found.join(named, same(found, named, ["conv_id"]), "left").select(found["*"], "sha256")
    filled = joined.fillna(0, subset=plan.columns[1:-1]).fillna("", subset=["audit"])
    return filled.withColumn("repaired_sha256", F.coalesce("sha256", F.sha2(F.lit(""), 256))).drop("sha256")


QUERIES = {
    "op1_secrets": (op1_secrets, None),
    "op2_warc": (op2_warc, None),
    "op3_main_text": (op3_main_text, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_token_ids": (op5_token_ids, None),
    "op6_site_lines": (op6_site_lines, SITE_LINES_SQL),
    "op7_simhash": (op7_simhash, None),
    "op8_quality": (op8_quality, None),
    "op9_decontamination": (op9_decontamination, DECONTAMINATION_SQL),
    "op10_mixing": (op10_mixing, None),
    "op11_fingerprints": (op11_fingerprints, None),
    "op12_hard_negatives": (op12_hard_negatives, HARD_NEGATIVES_SQL),
    "op13_conversation_repair": (op13_conversation_repair, None),
}
