"""Quality rules by repetition coverage.

Inside one text, a rolling hash over word numbers gives the n-grams of several lengths in numpy. An
n-gram found twice or more is duplicated, and all its places count: the measure is the share of the
characters of all words that lie inside duplicated n-grams. Lines are measured in the same way.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from leadloom.llm.tables import unused

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Largest share of characters inside duplicated n-grams, by n, and inside lines seen before.
#: An n-gram of five words or more lies inside repeated windows of three, so limits near the base rule's half would never decide;
#: these lie above 99.7 % (5 and 7 words) and 99.9 % (10 words, lines) of the texts that pass the base rule.
NGRAM_LIMITS = {5: 0.20, 7: 0.20, 10: 0.15}
LINE_LIMIT = 0.15
_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """64-bit values of word numbers, spread by two multiply-and-shift rounds."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ranked = np.sort(keys)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not twice.size:
        return np.zeros(keys.size, dtype=bool)
    place = np.searchsorted(twice, keys)
    return twice[np.minimum(place, twice.size - 1)] == keys


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside windows of n words that begin at the marked places."""
    edge = np.zeros(words + 1, dtype=np.int64)
    edge[: starts.size] += starts
    edge[n : n + starts.size] -= starts
    return np.cumsum(edge[:words]) > 0


def measure(text: str | None, limits: Mapping[int, float] = NGRAM_LIMITS) -> dict:
    """All measures of one text; a null text counts as empty."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at ASCII white space only
    n = len(words)
    word_chars = len(text) - sum(map(text.count, _BLANKS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen: set[bytes] = set()
    again = [x for x in lines if x in seen or seen.add(x)]
    out = {
        "n_words": n,
        "word_chars": word_chars,
        "n_symbols": sum(map(text.count, _SYMBOLS)),
        "n_dup_lines": len(again),
        "n_repeat_words": 0,
        "line_share": 0.0,
        **{f"share_{k}": 0.0 for k in limits},
    }
    if again:
        out["line_share"] = sum(len(x.decode("utf-8", "surrogatepass")) - sum(map(x.count, _BLANKS.encode())) for x in again) / word_chars
    if n < 3:
        return out
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == n:
        return out
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=n)
    size = len(number)
    pair = ids[:-1] * size + ids[1:]
    if size >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    out["n_repeat_words"] = int(_covered(_repeated(pair[:-1] * size + ids[2:]), 3, n).sum())
    if not out["n_repeat_words"]:
        return out  # without a repeated window of three words there is no longer one
    packed = np.frombuffer(b" ".join(words), dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 2
    points = np.cumsum((packed & 0xC0) != 0x80)[ends]
    chars = np.diff(points, prepend=-1) - 1  # less the blank before each word
    values = _mixed(ids)
    rolled, length = values, 1
    for k in sorted(limits):
        while length < k and rolled.size > 1:
            rolled = rolled[:-1] * _BASE + values[length:]
            length += 1
        if length < k:
            break
        out[f"share_{k}"] = float(chars[_covered(_repeated(rolled), k, n)].sum()) / word_chars
    return out


def judged(found: dict, limits: Mapping[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> dict:
    """``base_failed`` and ``kept`` from the measures of a text."""
    n = found["n_words"]
    failed = n < MIN_WORDS or 100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * n
    kept = (
        not failed
        and found["line_share"] <= line_limit
        and all(found[f"share_{k}"] <= most for k, most in limits.items())
    )
    return {"base_failed": failed, "kept": kept}


def quality_measures(docs: DataFrame, text: str = "text", limits: Mapping[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """The columns of ``docs`` with the measures and ``kept``, row by row and without a shuffle.

    A null text counts as empty and fails; texts of any length are measured whole; repeated rows get
    equal results; an empty table gives no rows; columns of the input named like a measure are replaced.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.functions import pandas_udf

    plain = {k: float(v) for k, v in limits.items()}
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    doubles = ("line_share", *(f"share_{k}" for k in plain))
    names = (*longs, *doubles, "base_failed", "kept")
    kinds = [f"{c} bigint" for c in longs] + [f"{c} double" for c in doubles] + ["base_failed boolean", "kept boolean"]

    @pandas_udf(", ".join(kinds))
    def measured(texts: pd.Series) -> pd.DataFrame:
        found = []
        for one in texts:
            got = measure(one, plain)
            found.append(got | judged(got, plain, line_limit))
        return pd.DataFrame(found, columns=list(names))

    own = [c for c in docs.columns if c not in names]
    struct = unused("measures", docs.columns)
    return docs.withColumn(struct, measured(F.col(text))).select(*[F.col(f"`{c}`") for c in own], F.col(f"{struct}.*"))


def kept_documents(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    from pyspark.sql import functions as F

    return docs.filter(verdict_column(**limits)(F.col("text")))


def verdict_column(limits: Mapping[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT):
    """A column function: whether a text passes."""
    from pyspark.sql.functions import pandas_udf

    plain = {k: float(v) for k, v in limits.items()}

    @pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        return pd.Series([judged(measure(t, plain), plain, line_limit)["kept"] for t in texts], dtype=bool)

    return passes
