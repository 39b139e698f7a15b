"""Column functions on text. Everything but NFKC stays inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom import vocab

ColumnOrName = Column | str
#: Characters beside ASCII ones that the compatibility form neither changes, moves nor joins to others.
SETTLED = (
    "\\u00C0-\\u0131\\u0134-\\u013E\\u0141-\\u0148\\u014A-\\u017E\\u0388-\\u03CE\\u0400-\\u0482\\u048A-\\u052F\\u05D0-\\u05EA\\u0620-\\u064A\\u0904-\\u0939"
    "\\u2012-\\u2016\\u2018-\\u2023\\u20AC\\u3001-\\u3029\\u3041-\\u3096\\u30A1-\\u30FE\\u3400-\\u9FFF\\uAC00-\\uD7A3\\x{1F252}-\\x{1FBEF}"
)
_TEXTS = 64  # texts of a batch that are Python strings at the same time


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c: ColumnOrName) -> Column:
    """Remove all leading and trailing whitespace (SQL ``trim`` removes spaces only)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def has_text(c: ColumnOrName) -> Column:
    """True when the value holds something besides whitespace; null counts as empty."""
    return F.coalesce(F.rlike(_col(c), F.lit(r"(?U)[^\s\x1c-\x1f]")), F.lit(False))


def contains_ci(c: ColumnOrName, text: str) -> Column:
    """Case-insensitive substring test; null gives False."""
    return F.coalesce(F.lower(_col(c)).contains(text.lower()), F.lit(False))


def title_case(c: ColumnOrName) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the others."""
    runs = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def keyword_class(
    c: ColumnOrName,
    keywords: Sequence[str] | Mapping[str, str] = vocab.CAMPAIGN_KEYWORDS,
    default: str = vocab.CAMPAIGN_DEFAULT,
) -> Column:
    """Label of the first keyword contained in the value; ``default`` if none (or null)."""
    labels = keywords if isinstance(keywords, Mapping) else {k: k for k in keywords}
    value = strip_all(F.lower(_col(c)))
    hits = [F.when(value.contains(word), F.lit(label)) for word, label in labels.items()]
    return F.coalesce(*hits, F.lit(default))


def regex_class(c: ColumnOrName, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply every pattern in order, each on the outcome of the one before; null stays null.

    ``(?d)`` makes the dot stop at line feeds only, so multi-line values keep their other lines.
    """
    out = _col(c)
    for pattern, label in rules:
        out = F.regexp_replace(out, F.lit(f"(?d){pattern}"), F.lit(label))
    return out


def value_map(c: ColumnOrName, mapping: Mapping, keep: bool = True, null_value=None, casefold: bool = False) -> Column:
    """Exact lookup. Unmatched values stay (``keep``) or become null."""
    value = _col(c)
    key = F.lower(value) if casefold else value
    branch = F.when(F.lit(False), F.lit(None))
    for old, new in mapping.items():
        branch = branch.when(key == F.lit(old.lower() if casefold else old), F.lit(new))
    if null_value is not None:
        branch = branch.when(value.isNull(), F.lit(null_value))
    return branch.otherwise(value) if keep else branch


def flag(c: ColumnOrName, value) -> Column:
    """1 when equal, else 0 (null gives 0)."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False)).cast("int")


def contains_flag(c: ColumnOrName, text: str) -> Column:
    return contains_ci(c, text).cast("int")


def prompt_clean(c: ColumnOrName) -> Column:
    """One-line form for prompts: letters, digits, ``_ . , ! ? -`` and single blanks."""
    one_line = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)\s+", " ")
    return F.trim(F.regexp_replace(one_line, r"[^\p{L}\p{N}_\s.,!?-]", ""))


def ellipsis(c: ColumnOrName, n: int) -> Column:
    """Cut values longer than ``n`` characters to ``n`` characters ending in an ellipsis."""
    value = _col(c)
    return F.when(F.length(value) > n, F.concat(F.substring(value, 1, n - 1), F.lit("…"))).otherwise(value)


def normal_forms(texts: pa.Array, others: Mapping[int, str], at_once: int = _TEXTS) -> pa.Array:
    """Unicode compatibility form of each text, with ``others`` replaced; Python holds ``at_once`` texts."""
    parts = [texts.slice(0, 0)]
    for at in range(0, len(texts), at_once):
        some = texts.slice(at, at_once).to_pylist()
        parts.append(pa.array([None if t is None else unicodedata.normalize("NFKC", t).translate(others) for t in some], texts.type))
    return pa.concat_arrays(parts)


def nfkc(c: ColumnOrName) -> Column:
    """Unicode compatibility form, with all remaining non-ASCII blanks as plain blanks.

    Values of ASCII and ``SETTLED`` characters need neither and reach Python as nulls. The others stay in Arrow's memory, but for a few at a time.
    """
    blanks = {0x85: " ", 0x1680: " ", 0x2028: " ", 0x2029: " "}

    @F.arrow_udf(T.StringType())
    def _nfkc(texts: pa.Array) -> pa.Array:
        return normal_forms(texts, blanks)

    value = _col(c)
    return F.coalesce(_nfkc(F.when(value.rlike(rf"[\P{{ASCII}}&&[^{SETTLED}]]"), value)), value)


def expand_contractions(c: ColumnOrName) -> Column:
    """Spell out contractions. Values without an apostrophe hold none and skip the nine rules."""

    def expand(t: Column) -> Column:
        out = t
        for short, full in vocab.CONTRACTIONS:
            out = F.regexp_replace(out, f"(?i){short}", full)
        return F.when(t.contains("'"), out).otherwise(t)

    # The one-element transform names the value, so that it is computed once.
    return F.element_at(F.transform(F.array(_col(c)), expand), 1)


def note_tokens(
    c: ColumnOrName,
    min_len: int = 2,
    stop_words: Sequence[str] = vocab.STOP_WORDS,
    keep_unicode: bool = False,
) -> Column:
    """Array of the words left after cleaning a note; empty for null.

    ``keep_unicode`` keeps letters and digits of every script; by default only ASCII ones
    survive.
    """
    text = F.regexp_replace(nfkc(F.coalesce(_col(c), F.lit(""))), r"[\x1c-\x1f]", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    text = F.regexp_replace(text, r"https?://\S+|www\.\S+", " ")
    # An address starts where its run of non-blanks starts; saying so keeps long words linear.
    text = F.regexp_replace(text, r"(?<!\S)\S+@\S+", " ")
    text = expand_contractions(text)
    # Blanks and all other characters become one blank per run. Written as an intersection
    # because Java tests a negated union of ranges several times slower.
    other = r"[^\p{L}\p{N}\-]+" if keep_unicode else r"[\P{Alnum}&&[^\-]]+"
    text = F.trim(F.regexp_replace(text, other, " "))
    words = F.split(F.lower(text), " ")
    stops = list(stop_words)
    return F.filter(words, lambda w: (F.length(w) >= max(min_len, 1)) & ~w.isin(stops))


def clean_text(c: ColumnOrName, **options) -> Column:
    """Cleaned note as one blank-separated string (see ``note_tokens``)."""
    return F.array_join(note_tokens(c, **options), " ")
