"""Severity of toxic language by cumulative-link ordinal regression.

P(grade <= j) = sigmoid(t_j - w.x): the ordered thresholds t_1 < t_2 < ... share one weight vector w over sparse
features (words, and the first four and five letters of longer words, as shares of the text's words). The
operator returns the expected severity, the sum over j of P(grade > j).

The model is fitted on a bounded sample of the labelled rows (``SAMPLE_ROWS``, drawn from all
partitions) inside one task; its features are those most strongly tied to the grade there. Every document is
scored whole, row by row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.tables import same
from leadloom.session import materialise

#: The model is fitted on about so many labelled rows, of at most so many characters.
SAMPLE_ROWS = 6000
SAMPLE_CHARS = 1 << 16
MAX_FEATURES = 3000
MIN_ROWS = 4
PREFIXES = (4, 5)
GRADES = 3
_RIDGE = 1e-4
_STEPS = 400
_WORDS = re.compile(r"[^\W\d_]+")
_SCALE = 100.0
_SMOOTH = 20.0


def counts(text: str | None) -> tuple[Counter, int]:
    """Features of a text with their counts, and its number of words."""
    words = _WORDS.findall((text or "").lower())
    found: Counter = Counter()
    for word, n in Counter(words).items():
        for f in features(word):
            found[f] += n
    return found, len(words)


def features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


def strongest(rows: list[tuple[Counter, int]], high: np.ndarray, most: int = MAX_FEATURES, least: int = MIN_ROWS) -> list[str]:
    """Features whose presence differs most between toxic and other rows, by the z-value of the two shares."""
    inside: Counter = Counter()
    outside: Counter = Counter()
    for (found, _), is_high in zip(rows, high, strict=True):
        (inside if is_high else outside).update(found.keys())
    a, b = max(1, int(high.sum())), max(1, int((~high).sum()))
    scored = []
    for f, n in inside.items():
        m = outside.get(f, 0)
        if n + m < least:
            continue
        p = (n + m) / (a + b)
        z = (n / a - m / b) / np.sqrt(max(p * (1 - p), 1e-12) * (1 / a + 1 / b))
        if z >= 4:
            scored.append((-z, f))
    return [f for _, f in sorted(scored)[:most]]


def severity_grades(rows: list[tuple[Counter, int]], toxic: np.ndarray, marks: list[str], grades: int = GRADES) -> np.ndarray:
    """Grades 1 to ``grades`` of toxic rows by their share of marked words, 0 for the others.

    For tables that only say whether a text is toxic: the toxic rows are cut into parts of equal size.
    """
    words = {f for f in marks if not f.endswith("*")}
    share = np.array([sum(found[w] for w in found.keys() & words) / (n + _SMOOTH) for found, n in rows])
    out = np.zeros(len(rows), dtype=np.int64)
    if toxic.any():
        cuts = np.quantile(share[toxic], np.arange(1, grades) / grades)
        out[toxic] = 1 + np.searchsorted(cuts, share[toxic], side="right")
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_ordinal(rows: list[tuple[Counter, int]], grade: np.ndarray, names: list[str], steps: int = _STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of largest penalised likelihood, by accelerated gradient steps (Adam)."""
    place = {f: i for i, f in enumerate(names)}
    cells = [(r, place[f], c * _SCALE / (n + _SMOOTH)) for r, (found, n) in enumerate(rows) for f, c in found.items() if f in place]
    row = np.array([c[0] for c in cells], dtype=np.int64)
    col = np.array([c[1] for c in cells], dtype=np.int64)
    val = np.array([c[2] for c in cells])
    top = max(1, int(grade.max()) if grade.size else 1)
    share = [(np.sum(grade <= j) + 0.5) / (grade.size + 1.0) for j in range(top)]
    start = np.maximum.accumulate(np.log(np.array(share) / (1 - np.array(share))))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    theta = np.concatenate((np.zeros(len(names)), start[:1], gaps))
    first, second, d = np.zeros_like(theta), np.zeros_like(theta), len(names)
    for step in range(1, steps + 1):
        w, cut = theta[:d], theta[d] + np.concatenate(([0.0], np.cumsum(np.exp(theta[d + 1 :]))))
        x = np.bincount(row, weights=w[col] * val, minlength=grade.size)
        below = _sigmoid(cut[None, :] - x[:, None])
        upper = np.concatenate((below, np.ones((grade.size, 1))), axis=1)[np.arange(grade.size), grade]
        lower = np.concatenate((np.zeros((grade.size, 1)), below), axis=1)[np.arange(grade.size), grade]
        p = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / p, lower * (1 - lower) / p  # derivatives of log p by the two thresholds
        g_x = (down - up) * -1.0
        grad_w = np.bincount(col, weights=g_x[row] * val, minlength=d) / grade.size + _RIDGE * w
        g_cut = np.zeros(top)
        np.add.at(g_cut, np.minimum(grade, top - 1), np.where(grade < top, -up, 0.0))
        np.add.at(g_cut, np.maximum(grade - 1, 0), np.where(grade > 0, down, 0.0))
        g_cut /= max(1, grade.size)
        later = np.cumsum(g_cut[::-1])[::-1]
        grad = np.concatenate((grad_w, later[:1], later[1:] * np.exp(theta[d + 1 :])))
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        rate = 0.2 / np.sqrt(1 + step / 50)
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return theta[:d], theta[d] + np.concatenate(([0.0], np.cumsum(np.exp(theta[d + 1 :]))))


def fit(labelled: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS, grade: str | None = None) -> tuple[dict[str, float], list[float]]:
    """Weights by feature and thresholds, from (text, toxic) or (text, ``grade``).

    The driver receives one number for each kept feature. Rows without a label are left out; without
    any toxic row in the sample the model has no weights.
    """
    target = grade or "toxic"
    known = labelled.filter(F.col(target).isNotNull()).select(F.coalesce(text, F.lit("")).alias("text"), F.col(target).cast("int").alias("y"))
    total = known.count()
    if not total:
        return {}, [8.0]
    drawn = known.filter(F.length("text") <= SAMPLE_CHARS).sample(fraction=min(1.0, rows / total), seed=3).repartition(1).sortWithinPartitions("text", "y")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [(counts(t), y) for batch in batches for t, y in zip(batch["text"], batch["y"], strict=True)]
        if not got:
            return
        seen, y = [x for x, _ in got], np.array([v for _, v in got], dtype=np.int64)
        names = strongest(seen, y > 0)
        goal = y if grade else severity_grades(seen, y > 0, names)
        weights, cuts = fit_ordinal(seen, goal, names)
        yield pd.DataFrame({"name": [*names, *[""] * cuts.size], "value": [*weights, *cuts]})

    model = drawn.mapInPandas(run, "name string, value double").collect()
    cuts = [r["value"] for r in model if not r["name"]]
    return {r["name"]: r["value"] for r in model if r["name"]}, cuts or [8.0]


class Scorer:
    """Grade probabilities of texts; remembers the weights of the words it met, up to a bound."""

    def __init__(self, weights: dict[str, float], cuts: list[float]):
        self._weights, self._cuts = weights, np.array(cuts)
        self._words: dict[str, float] = {}

    def _weight(self, word: str) -> float:
        return sum(self._weights.get(f, 0.0) for f in features(word))

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > j) for each text and threshold."""
        logits = np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = _WORDS.findall((text or "").lower())
            known = self._words
            if len(known) > 300_000:
                known.clear()
            for word in set(words):
                if word not in known:
                    known[word] = self._weight(word)
            logits[i] = sum(map(known.__getitem__, words)) * _SCALE / (len(words) + _SMOOTH)
        return 1.0 - _sigmoid(self._cuts[None, :] - logits[:, None])


def severity(docs: DataFrame, model: tuple[dict[str, float], list[float]], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, severity (expected grade), grade (the likeliest) and toxic (P(grade > 0) >= 1/2) of every row.

    Null and empty texts are scored without features, as the thresholds alone say; repeated rows get the same; ties
    between grades go to the lower one; an empty table gives no rows; other columns are not read.
    """
    weights, cuts = model

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(weights, cuts)
        for texts in batches:
            above = scorer.above(list(texts))
            full = np.concatenate((np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))), axis=1)
            likeliest = np.argmax(full[:, :-1] - full[:, 1:], axis=1) if len(texts) else np.zeros(0, dtype=int)
            yield pd.DataFrame({"severity": above.sum(axis=1), "grade": likeliest.astype("int32"), "toxic": above[:, 0] >= 0.5})

    return docs.select(*keep, score(F.col(text)).alias("s")).select(*keep, "s.severity", "s.grade", "s.toxic")


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the documents with a label, about ``SAMPLE_ROWS`` of them.

    The labels are drawn before the join, so that no more texts move than the fit may use.
    """
    known = labels.filter("toxic IS NOT NULL").select("doc_id", "toxic")
    total = known.count()
    drawn = materialise(known.sample(fraction=min(1.0, SAMPLE_ROWS / max(total, 1)), seed=2))
    texts = docs.select("doc_id", "text")
    return texts.join(drawn, same(texts, drawn, ["doc_id"])).select(texts["doc_id"], "text", "toxic")
