"""Secret scan: fixed patterns, and tokens that a battery of randomness tests takes for keys.

Candidates are cut from runs of at least ``MIN_TOKEN`` key characters: the parts between the signs, and the
parts with the signs of one base 64 alphabet (``CUTS``). So every candidate fits an encoding, and a key in a path is
one too. Each gets the narrowest encoding that fits it (hex, letters, base 32, base 36, base 62, base 64), and
under it four tests of randomness: chi-squared over the symbols, chi-squared over their classes (digits, small
and capital letters, signs), the number of runs above and below the middle of the alphabet, and serial correlation
at distance one. A candidate stays unless the smallest of the four p-values, times four, is under ``REJECT``.

Randomness alone does not tell a short key from a word, so the second condition controls false
discoveries. The null is text: a Markov chain over vowels, consonants, digits and signs, with the frequencies of
letters and a share of repeated characters (``text_chance``). The ratio of a token's chance as random symbols
to its chance as text has a mean of at most one over text, so its inverse (times the number of encodings to
choose from) is a p-value by Markov's inequality. Within each length class (powers of the square root of
two), the Benjamini-Hochberg procedure at level ``FALSE_SHARE`` over all candidates of the corpus sets the limit.

All steps are column functions, windows, joins and aggregations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.llm.tables import same
from leadloom.session import materialise

MIN_TOKEN = 20
REJECT = 0.001
FALSE_SHARE = 0.01
#: A part of a find is reported in its place if its p-value is under this share of the whole's: the rest is text.
PART_SHARE = 0.05

#: Fixed patterns: kind, pattern, smallest length of the group, group.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (
    ("assign", ASSIGN, 6, 2),
    ("access", r"AKIA[A-Z0-9]{16,}", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
    ("random", rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}", MIN_TOKEN, 0),
)
_BASE = ("assign", "access", "hex")
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
_UPPER = _LOWER.upper()
_SIGNS = "+/-_"
#: Name, alphabet in the order of its values and pattern of the tokens that fit; narrowest first.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef", r"^[0-9a-f]+$"),
    ("HEX", _DIGITS + "ABCDEF", r"^[0-9A-F]+$"),
    ("lower", _LOWER, r"^[a-z]+$"),
    ("upper", _UPPER, r"^[A-Z]+$"),
    ("base32", _UPPER + "234567", r"^[A-Z2-7]+$"),
    ("base32lower", _LOWER + "234567", r"^[a-z2-7]+$"),
    ("base36", _DIGITS + _LOWER, r"^[0-9a-z]+$"),
    ("BASE36", _DIGITS + _UPPER, r"^[0-9A-Z]+$"),
    ("letters", _UPPER + _LOWER, r"^[A-Za-z]+$"),
    ("base62", _UPPER + _LOWER + _DIGITS, r"^[A-Za-z0-9]+$"),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", r"^[A-Za-z0-9+/]+$"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", r"^[A-Za-z0-9_-]+$"),
)
#: Candidates inside a run of key characters: pattern, and the signs one of which a candidate must hold.
CUTS = (
    (rf"[A-Za-z0-9]{{{MIN_TOKEN},}}", ""),
    (rf"[A-Za-z0-9+/]{{{MIN_TOKEN},}}", "[+/]"),
    (rf"[A-Za-z0-9_-]{{{MIN_TOKEN},}}", "[_-]"),
)

#: Text as a Markov chain: kinds of characters, and the chance of each kind (columns) after each (rows).
_KINDS_OF_TEXT = ("aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ", _DIGITS, _SIGNS)
_AFTER = (
    (0.15, 0.75, 0.005, 0.015, 0.03, 0.05),
    (0.50, 0.40, 0.005, 0.015, 0.03, 0.05),
    (0.02, 0.08, 0.13, 0.65, 0.05, 0.07),
    (0.13, 0.07, 0.40, 0.30, 0.04, 0.06),
    (0.015, 0.025, 0.015, 0.025, 0.85, 0.07),
    (0.22, 0.42, 0.07, 0.13, 0.12, 0.04),
)
#: Parts in a thousand of letters in text of languages with Latin letters, of all vowels and of all consonants.
_VOWELS = dict(zip("aeiouy", (200, 340, 200, 160, 80, 20), strict=True))
_CONSONANTS = dict(zip("ntsrldhcmgpfbvwkzjxq", (130, 140, 115, 115, 70, 70, 60, 60, 45, 35, 35, 30, 30, 20, 15, 15, 6, 3, 3, 3), strict=True))
#: Chance that a character of a text repeats the one before for its own sake (rules, padding).
_REPEAT = 0.08


def _share_of(c: str) -> float:
    """The chance of a character among those of its kind."""
    if c.lower() in _VOWELS:
        return _VOWELS[c.lower()] / sum(_VOWELS.values())
    if c.lower() in _CONSONANTS:
        return _CONSONANTS[c.lower()] / sum(_CONSONANTS.values())
    return 1 / len(_DIGITS if c in _DIGITS else _SIGNS)


def _table(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def text_chance(chars: Column) -> Column:
    """The logarithm of the chance of an array of key characters as text; the first follows a sign."""
    every = "".join(_KINDS_OF_TEXT)
    kind = _table([i for i, kind in enumerate(_KINDS_OF_TEXT) for _ in kind])
    share, after = _table([_share_of(c) for c in every]), _table([x for row in _AFTER for x in row])
    width, signs = len(_KINDS_OF_TEXT), len(_KINDS_OF_TEXT) - 1

    def coded(c: Column) -> Column:
        at = F.instr(F.lit(every), c) - 1
        return F.struct(at.alias("c"), F.get(kind, at).alias("kind"), F.get(share, at).alias("share"))

    codes = F.transform(chars, coded)
    first = F.get(codes, F.lit(0))
    start = F.log(F.get(after, F.lit(width * signs) + first["kind"]) * first["share"])
    each = F.zip_with(
        F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1),
        lambda a, b: F.log((1 - _REPEAT) * F.get(after, a["kind"] * width + b["kind"]) * b["share"] + F.when(a["c"] == b["c"], _REPEAT).otherwise(0.0)),
    )
    return start + F.aggregate(each, F.lit(0.0), lambda s, x: s + x)


def _matches(text: Column, pattern: str) -> Column:
    """Each match with the number of code points between it and the match before."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(parts, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("found")))
    return F.when(F.rlike(text, F.lit(pattern)), pairs)


def raw_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_row, kind, number of the kind, start, end, found) of all matches; needs ``_row``.

    Positions are running totals of gaps and lengths over the matches of one document.
    """
    cells = [
        F.transform(F.coalesce(F.col(kind), F.array().cast("array<struct<gap:int,found:string>>")), _numbered(k)) for k, (kind, *_) in enumerate(KINDS)
    ]
    flat = docs.filter(F.coalesce(*[F.col(kind) for kind, *_ in KINDS]).isNotNull()).select("_row", F.explode(F.concat(*cells)).alias("x")).select("_row", "x.*")
    until = Window.partitionBy("_row", "k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("found")).over(until)
    spans = flat.select("_row", "k", "found", end.alias("end"))
    spans = spans.select("_row", "k", "found", (F.col("end") - F.length("found")).alias("start"), "end")
    held = F.lit(True)
    for k, (_, pattern, least, group) in enumerate(KINDS):
        value = F.col("found") if not group else F.regexp_extract("found", pattern, group)
        held = F.when(F.col("k") == k, F.length(value) >= least).otherwise(held)
    return spans.filter(held)


def _numbered(k: int):
    return lambda x, i: F.struct(F.lit(k).alias("k"), i.alias("at"), x["gap"].alias("gap"), x["found"].alias("found"))


def candidates(runs: DataFrame) -> DataFrame:
    """(_row, run, start, end, found) of every candidate in the runs of ``raw_spans``; run is where its run starts."""
    flat = None
    for i, (pattern, sign) in enumerate(CUTS):
        some = runs.filter(F.rlike("found", F.lit(sign))) if sign else runs
        some = some.select("_row", F.col("start").alias("run"), F.lit(i).alias("cut"), F.posexplode(_matches(F.col("found"), pattern)).alias("at", "x"))
        flat = some if flat is None else flat.unionByName(some)
    flat = flat.select("_row", "run", "cut", "at", "x.*")
    until = Window.partitionBy("_row", "run", "cut").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("run") + F.sum(F.col("gap") + F.length("found")).over(until)
    flat = flat.select("_row", "run", "cut", "found", end.alias("end"))
    held = F.lit(True)
    for i, (_, sign) in enumerate(CUTS):
        held = F.when(F.col("cut") == i, F.rlike("found", F.lit(sign))).otherwise(held)
    return flat.filter(held).select("_row", "run", (F.col("end") - F.length("found")).alias("start"), "end", "found")


def outer(picked: DataFrame) -> DataFrame:
    """(_row, start, end) of discoveries: one with signs takes the place of its parts, unless a part is by far the stronger find."""
    wide = F.rlike("found", F.lit("[^A-Za-z0-9]"))
    runs = picked.groupBy("_row", "run").agg(F.collect_list(F.struct("start", "end", "p_text", wide.alias("wide"))).alias("x"))

    def inside(a: Column, b: Column) -> Column:
        return (a["start"] >= b["start"]) & (a["end"] <= b["end"])

    def parts(w: Column) -> Column:
        return F.exists("x", lambda p: ~p["wide"] & inside(p, w) & (p["p_text"] < PART_SHARE * w["p_text"]))

    runs = runs.withColumn("w", F.filter("x", lambda w: w["wide"] & ~parts(w)))
    runs = runs.withColumn("p", F.filter("x", lambda p: ~p["wide"] & ~F.exists("w", lambda w: inside(p, w))))
    return runs.select("_row", F.explode(F.concat("w", "p")).alias("x")).select("_row", "x.start", "x.end")


def _two_sided(z: Column) -> Column:
    """P(|normal| >= |z|), by a polynomial of the error function and, far out, by the tail's leading term."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    far = F.exp(-x * x) / (F.greatest(x, F.lit(1.0)) * math.sqrt(math.pi))
    return F.when(x < 3, poly * F.exp(-x * x)).otherwise(far)


def _place_in(alphabet: str):
    return lambda c: F.instr(F.lit(alphabet), c) - 1


def randomness(tokens: DataFrame, token: str = "found") -> DataFrame:
    """``tokens`` with encoding, p_random (battery) and p_text (against text); tokens that fit no encoding get nulls.

    Built row by row from column functions over the token's characters. The tokens with their values are
    stored on the way, dealt out evenly: a few bytes of input mean much work here.
    """
    name, size, values = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(None).cast("array<int>")
    for label, alphabet, pattern in reversed(ENCODINGS):
        fits = F.rlike(token, F.lit(pattern))
        code = F.transform(F.split(token, ""), _place_in(alphabet))
        name, size = F.when(fits, F.lit(label)).otherwise(name), F.when(fits, F.lit(len(alphabet))).otherwise(size)
        values = F.when(fits, code).otherwise(values)
    squares = F.aggregate(
        F.array_distinct(F.split(token, "")), F.lit(0).cast("bigint"),
        lambda s, c: s + F.pow(F.length(token) - F.length(F.replace(F.col(token), c, F.lit(""))), 2).cast("bigint"),
    )
    tokens = tokens.repartition(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df = materialise(tokens.withColumns({"encoding": name, "_k": size, "_v": values, "_sq": squares, "_n": F.greatest(F.length(token), F.lit(2)).cast("double")}))
    k, n = F.col("_k").cast("double"), F.col("_n")
    z_symbols = (k / n * F.col("_sq") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)

    def of(pattern: str) -> Column:
        return F.length(F.regexp_replace(F.col(token), pattern, "")).cast("double")

    digits, small, capital, signs = of("[^0-9]"), of("[^a-z]"), of("[^A-Z]"), of(r"[^+/_-]")
    classes = F.lit(None).cast("double")
    for label, alphabet, _ in ENCODINGS:
        shares = [sum(c in kind for c in alphabet) for kind in (_DIGITS, _LOWER, _UPPER, _SIGNS)]
        total, used = len(alphabet), [(c, s) for c, s in zip((digits, small, capital, signs), shares, strict=True) if s]
        chi = sum(((c - n * s / total) * (c - n * s / total) / (n * s / total) for c, s in used), F.lit(0.0))
        z = (chi - (len(used) - 1)) / math.sqrt(2 * (len(used) - 1)) if len(used) > 1 else F.lit(0.0)
        classes = F.when(F.col("encoding") == label, z).otherwise(classes)
    df = df.withColumns({"_z1": z_symbols, "_z2": classes})
    # runs above and below the middle, and serial correlation, from neighbouring values
    pairs = F.zip_with(F.slice("_v", 1, F.size("_v") - 1), F.slice("_v", 2, F.size("_v") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    high = F.aggregate("_v", F.lit(0.0), lambda s, x: s + F.when(x * 2 >= F.col("_k"), 1.0).otherwise(0.0))
    mean = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x.cast("double")) / n
    df = df.withColumns({"_pairs": pairs, "_high": high, "_mean": mean})
    runs = F.aggregate("_pairs", F.lit(1.0), lambda s, p: s + F.when((p["a"] * 2 >= F.col("_k")) != (p["b"] * 2 >= F.col("_k")), 1.0).otherwise(0.0))
    cov = F.aggregate("_pairs", F.lit(0.0), lambda s, p: s + (p["a"] - F.col("_mean")) * (p["b"] - F.col("_mean")))
    var = F.aggregate("_v", F.lit(0.0), lambda s, x: s + (x - F.col("_mean")) * (x - F.col("_mean")))
    df = df.withColumns({"_runs": runs, "_cov": cov, "_var": var, "_text": text_chance(F.split(token, ""))})
    both = 2 * F.col("_high") * (n - F.col("_high"))
    z_runs = F.when(both > n, (F.col("_runs") - both / n - 1) / F.sqrt(both * (both - n) / (n * n * (n - 1)))).otherwise(F.sqrt(n))
    z_serial = F.when(F.col("_var") > 0, (F.col("_cov") / F.col("_var") + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
    df = df.withColumns({"_z3": z_runs, "_z4": z_serial})
    least = F.least(*[_two_sided(F.col(f"_z{i}")) for i in range(1, 5)])
    p_text = F.least(F.lit(1.0), len(ENCODINGS) * F.exp(F.col("_text") + F.length(token) * F.log(k)))
    known = F.col("encoding").isNotNull()
    df = df.withColumns({"p_random": F.when(known, F.least(F.lit(1.0), 4 * least)), "p_text": F.when(known, p_text)})
    return df.drop("_k", "_v", "_sq", "_n", "_pairs", "_high", "_mean", "_runs", "_cov", "_var", "_text", "_z1", "_z2", "_z3", "_z4")


def discoveries(tested: DataFrame, reject: float = REJECT, level: float = FALSE_SHARE) -> DataFrame:
    """Tested tokens that pass the battery and the length class's Benjamini-Hochberg limit.

    P-values are counted in steps of a tenth of their logarithm, at most 3,000 a class, and taken as the
    larger end of their step, which errs on the strict side.
    """
    band = F.floor(2 * F.log2(F.length("found"))).cast("int")
    step = F.floor(-10 * F.log10(F.greatest("p_text", F.lit(1e-300)))).cast("int")
    ranked = tested.filter(F.col("encoding").isNotNull()).withColumns({"_band": band, "_step": step})
    counts = ranked.groupBy("_band", "_step").agg(F.count("*").alias("n"))
    strict = Window.partitionBy("_band").orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select("_band", "_step", F.sum("n").over(strict).alias("found"), F.sum("n").over(Window.partitionBy("_band")).alias("m"))
    passing = counts.filter(F.pow(F.lit(10.0), -F.col("_step") / 10) * F.col("m") <= level * F.col("found"))
    limits = passing.groupBy("_band").agg(F.min("_step").alias("_limit"))
    joined = ranked.join(limits, same(ranked, limits, ["_band"])).select(ranked["*"], "_limit")
    return joined.filter((F.col("_step") >= F.col("_limit")) & (F.col("p_random") >= reject)).drop("_band", "_step", "_limit")


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_assign, n_access, n_hex, base_sha256, n_random and spans of every row.

    Spans are kind:start:end in code points, end exclusive, by start and then in the order of ``KINDS``; a
    random token with exactly the place of a fixed match is not repeated. Null and empty texts have no
    spans; repeated rows get the same; an empty table gives no rows. Texts are searched whole; only
    matches are stored and moved.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    cells = [_matches(body, pattern).alias(kind) for kind, pattern, *_ in KINDS]
    names = [f"_keep{i}" for i in range(len(keep))]
    found = materialise(docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.monotonically_increasing_id().alias("_row"), *cells))
    spans = materialise(raw_spans(found))
    last = len(KINDS) - 1
    tested = materialise(randomness(candidates(spans.filter(F.col("k") == last))))
    picked = outer(discoveries(tested)).select("_row", F.lit(last).alias("k"), "start", "end")
    every = spans.filter(F.col("k") < last).select("_row", "k", "start", "end").unionByName(picked)
    first = F.min("k").over(Window.partitionBy("_row", "start", "end"))
    every = every.withColumn("_first", first).filter((F.col("k") < last) | (F.col("_first") == last))
    listed = F.sort_array(F.collect_list(F.struct("start", "k", "end")))
    grouped = every.groupBy("_row").agg(listed.alias("x"), *[F.count_if(F.col("k") == i).alias(f"n_{kind}") for i, (kind, *_) in enumerate(KINDS)])
    labels = F.array(*[F.lit(kind) for kind, *_ in KINDS])

    def joined(cells: Column) -> Column:
        return F.array_join(F.transform(cells, lambda s: F.concat_ws(":", F.get(labels, s["k"]), s["start"], s["end"])), ",")

    base = F.filter("x", lambda s: s["k"] < last)
    done = grouped.select("_row", *[f"n_{kind}" for kind, *_ in KINDS], joined(base).alias("base"), joined(F.col("x")).alias("spans"))
    all_rows = found.select("_row", *names)
    both = all_rows.join(done, same(all_rows, done, ["_row"]), "left")
    zero = F.lit(0).cast("bigint")
    return both.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        *[F.coalesce(f"n_{kind}", zero).alias(f"n_{kind}") for kind in _BASE],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("n_random", zero).alias("n_random"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
