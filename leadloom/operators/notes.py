"""TF-IDF on cleaned notes, lemma lookup and prompt assembly."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from leadloom.functions import text as X
from leadloom.session import materialise, small_side, spread

_AT_ONCE = 4 << 20  # bytes of notes that a task cuts into words at the same time
#: Words that may travel to the tasks that count pairs; with more of them the pairs are joined.
MOST_KNOWN = 100_000
_VECTOR = list(to_arrow_type(VectorUDT()))


def lemma_lookup(df: DataFrame, id_col: str, tokens: str, lemmas: DataFrame, out: str = "tokens") -> DataFrame:
    """Replace each token by its lemma from a (form, lemma) table; unknown tokens stay.

    An equi-join on the word: the planner broadcasts a table that is small by its statistics
    and otherwise shuffles, where adaptive execution splits frequent words.
    """
    words = df.select(id_col, F.posexplode_outer(tokens).alias("__pos", "__word"))
    forms = lemmas.select(F.col("form").alias("__word"), F.col("lemma").alias("__lemma")).dropDuplicates(["__word"])
    named = words.join(forms, "__word", "left").select(
        id_col, "__pos", F.coalesce("__lemma", "__word").alias("__w")
    )
    kept = F.collect_list(F.when(F.col("__w").isNotNull(), F.struct("__pos", "__w")))
    return named.groupBy(id_col).agg(F.transform(F.array_sort(kept), lambda p: p["__w"]).alias(out))


def clean_notes(df: DataFrame, note: str, out: str, lemmas: DataFrame | None = None, **options) -> DataFrame:
    """Add the cleaned note (see ``clean_text``); with a (form, lemma) table its words become lemmas.

    The words are then cut once and stored, and only they are shuffled, not the other columns of a note
    before the last join.
    """
    if lemmas is None:
        return spread(df).withColumn(out, X.clean_text(note, **options))
    cut = spread(df).withColumns({"__note": F.monotonically_increasing_id(), "__words": X.note_tokens(note, **options)})
    stored = materialise(cut)
    found = lemma_lookup(stored, "__note", "__words", lemmas, "__lemmas")
    return stored.join(found, "__note").withColumn(out, F.array_join("__lemmas", " ")).drop("__note", "__words", "__lemmas")


def words(text: str | Column) -> Column:
    """Words of two or more characters of a cleaned note.

    Cleaned notes hold letters, digits, blanks and hyphens, so the last two part the words.
    """
    return F.filter(F.split(X._col(text), "[ \\-]+"), lambda w: F.length(w) >= 2)


def word_pairs(w: Column) -> Column:
    """Adjacent words of an array, each pair joined by a blank."""
    joined = F.zip_with(w, F.slice(w, 2, F.size(w)), _pair)
    return F.filter(joined, lambda p: p.isNotNull())


def _pair(first: Column, second: Column) -> Column:
    return F.when(second.isNotNull(), F.concat(first, F.lit(" "), second))


def grams(text: str | Column) -> Column:
    """Words and adjacent pairs of a cleaned note."""
    # The one-element transform names the words, so that they are computed once.
    return F.element_at(F.transform(F.array(words(text)), lambda w: F.concat(w, word_pairs(w))), 1)


@dataclass(frozen=True)
class TermVocabulary:
    """Terms in rank order with the number of notes holding each; ``n_docs`` notes in all."""

    terms: tuple[str, ...]
    doc_freq: tuple[int, ...]
    n_docs: int

    def idf(self) -> list[float]:
        return [math.log((1 + self.n_docs) / (1 + d)) + 1.0 for d in self.doc_freq]

    def frame(self, spark) -> DataFrame:
        rows = list(zip(self.terms, self.doc_freq, self.idf()))
        return spark.createDataFrame(rows, "term string, df bigint, idf double")


def _slices(texts: pa.Array, at_once: int = _AT_ONCE) -> Iterator[pa.Array]:
    """Neighbouring notes of about ``at_once`` bytes together; a longer note is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + at_once, side="right")))
        yield texts.slice(first, last - first)
        first = last


def _cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Note and code of each word (see ``words``), and the different words in the order of their codes."""
    lists = pc.split_pattern(pc.replace_substring(texts, "-", " "), " ")
    flat, note = pc.list_flatten(lists), pc.list_parent_indices(lists)
    long = pc.greater_equal(pc.utf8_length(flat), 2)
    coded = flat.filter(long).dictionary_encode()
    return note.filter(long).to_numpy(), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _batch_counts(texts: pa.Array, pairs: bool, known: pa.Array | None = None) -> pa.RecordBatch:
    """(term, cf, df): occurrences of each word, or of each pair (of ``known`` words), and the notes that hold it."""
    note, code, names = _cut(texts)
    n = max(1, len(names))
    if pairs:
        near = note[1:] == note[:-1]
        if known is not None:
            listed = pc.is_in(names, value_set=known).to_numpy(zero_copy_only=False).astype(bool)[code]
            near &= listed[1:] & listed[:-1]
        both, code = np.unique((code[:-1] * n + code[1:])[near], return_inverse=True)
        note = note[1:][near]
        names = pc.binary_join_element_wise(names.take(pa.array(both // n)), names.take(pa.array(both % n)), " ")
        n = max(1, len(names))
    cf = np.bincount(code, minlength=len(names))
    cells = np.sort(note * n + code)  # several times faster than a hash table of so many numbers
    df = np.bincount(cells[np.flatnonzero(np.diff(cells, prepend=-1))] % n, minlength=len(names))
    return pa.RecordBatch.from_arrays([names, pa.array(cf[: len(names)], pa.int64()), pa.array(df[: len(names)], pa.int64())], ["term", "cf", "df"])


def _term_counts(notes: DataFrame, pairs: bool, known: Sequence[str] | None = None) -> DataFrame:
    """(term, cf, df) of slices of the notes: words or pairs are counted inside the tasks before any becomes a row."""
    listed = None if known is None else pa.array(list(known), pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _slices(batch.column(0)):
                yield _batch_counts(texts, pairs, listed)

    return notes.mapInArrow(count, "term string, cf bigint, df bigint")


def _counted(cells: DataFrame) -> DataFrame:
    return cells.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def fit_terms(
    df: DataFrame, text: str, max_features: int = 5000, min_df: int = 5, max_df: float = 0.9, most_known: int = MOST_KNOWN
) -> TermVocabulary:
    """The ``max_features`` most frequent words and pairs of a column of cleaned notes.

    Only terms in at least ``min_df`` notes and at most the share ``max_df`` of them count.

    Words are counted first. A pair occurs no more often than either of its words, so once
    the words alone fill the vocabulary, pairs with a word below its last entry cannot enter
    it and are dropped before they are counted. That is exact, and it keeps the many rare
    pairs of a large corpus out of the shuffle. Up to ``most_known`` words that remain go to the tasks;
    more are stored, and the pairs counted in each slice are joined with them.
    """
    n_docs = df.count()
    notes = df.select(X._col(text).cast("string"))

    def best(counts: DataFrame) -> list:
        kept = counts.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n_docs)))
        return kept.orderBy(F.desc("cf"), F.asc("term")).limit(max_features).collect()

    singles = materialise(_counted(_term_counts(notes, False)))
    top = best(singles)
    floor = max(min_df, top[-1]["cf"] if len(top) == max_features else 0)
    frequent = singles.filter((F.col("cf") >= floor) & (F.col("df") >= min_df)).select(F.col("term").alias("__w"))
    few = [r["__w"] for r in frequent.limit(most_known + 1).collect()]
    if len(few) <= most_known:
        cells = _term_counts(notes, True, few)
    else:
        cells, known = _term_counts(notes, True), small_side(materialise(frequent))
        for part in (1, -1):
            cells = cells.join(known, F.substring_index("term", " ", part) == F.col("__w"), "left_semi")
    rows = sorted(top + best(_counted(cells)), key=lambda r: (-r["cf"], r["term"]))[:max_features]
    return TermVocabulary(tuple(r["term"] for r in rows), tuple(r["df"] for r in rows), n_docs)


class _Lookup:
    """Finds the terms of notes by numbers: the words that occur in terms, single terms by word, pairs by the sorted numbers of both."""

    def __init__(self, vocabulary: TermVocabulary):
        parts = [t.split(" ") for t in vocabulary.terms]
        places = {w: i for i, w in enumerate(dict.fromkeys(w for p in parts for w in p))}
        self.words, self.n = pa.array(list(places), pa.string()), len(places)
        self.single = np.full(self.n, -1, dtype=np.int64)
        pairs = []
        for i, p in enumerate(parts):
            if len(p) == 1:
                self.single[places[p[0]]] = i
            elif len(p) == 2:
                pairs.append((places[p[0]] * self.n + places[p[1]], i))
        ordered = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.pairs, self.pair_terms = ordered[:, 0], ordered[:, 1]
        self.idf = np.array(vocabulary.idf())

    def weights(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets of the notes, and terms with their weights of unit length, note by note in the order of terms."""
        note, code, names = _cut(texts)
        word = pc.fill_null(pc.index_in(names, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
        alone = np.where(word >= 0, self.single[word], -1)
        near = np.flatnonzero((note[1:] == note[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0))
        key = word[near] * self.n + word[near + 1]
        at = np.searchsorted(self.pairs, key)
        found = at < len(self.pairs)
        found[found] = self.pairs[at[found]] == key[found]
        of = np.concatenate([note[alone >= 0], note[near[found]]])
        term = np.concatenate([alone[alone >= 0], self.pair_terms[at[found]]])
        cells, tf = np.unique(of * len(self.idf) + term, return_counts=True)
        of, term = cells // len(self.idf), cells % len(self.idf)
        value = tf * self.idf[term]
        value /= np.sqrt(np.bincount(of, value * value, minlength=len(texts)))[of]
        return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))]), term, value


def with_terms(df: DataFrame, text: str, vocabulary: TermVocabulary, out: str = "terms") -> DataFrame:
    """Add the array of (term, tfidf) of each note, of unit length, without a shuffle.

    Terms outside the vocabulary do not count; a null or empty note has no terms.
    """
    if not vocabulary.terms:
        return df.withColumn(out, F.lit(None).cast("array<struct<term:string,tfidf:double>>"))
    lookup, names = _Lookup(vocabulary), pa.array(vocabulary.terms, pa.string())

    @F.arrow_udf("array<struct<term:string,tfidf:double>>")
    def weigh(texts: pa.Array) -> pa.Array:
        def part(some: pa.Array) -> pa.Array:
            ends, term, value = lookup.weights(some)
            cells = pa.StructArray.from_arrays([names.take(pa.array(term)), pa.array(value)], ["term", "tfidf"])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)

        return pa.concat_arrays([part(some) for some in _slices(texts)] or [part(texts)])

    return df.withColumn(out, weigh(X._col(text).cast("string")))


def tfidf_vectors(text: str | Column, vocabulary: TermVocabulary) -> Column:
    """The vectors of ``tfidf_model`` from the cleaned note itself; no term becomes a string of its own."""
    lookup, size = _Lookup(vocabulary), len(vocabulary.terms)

    @F.arrow_udf(VectorUDT())
    def weigh(texts: pa.Array) -> pa.Array:
        def part(some: pa.Array) -> pa.Array:
            ends, term, value = lookup.weights(some)
            ends, n = pa.array(ends, pa.int32()), len(some)
            sparse, sizes = pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, size), pa.int32())
            columns = pa.array(term, pa.int32()), pa.array(value)
            lists = [pa.ListArray.from_arrays(ends, c, type=f.type) for c, f in zip(columns, _VECTOR[2:])]
            return pa.StructArray.from_arrays([sparse, sizes, *lists], fields=_VECTOR)

        return pa.concat_arrays([part(some) for some in _slices(texts)] or [part(texts)])

    return weigh(X._col(text).cast("string"))


def tfidf_terms(df: DataFrame, id_col: str, text: str, vocabulary: TermVocabulary) -> DataFrame:
    """(id, term, tfidf), one row for each different term of a note."""
    return with_terms(df, text, vocabulary).select(id_col, F.inline("terms"))


def tfidf_model(vocabulary: TermVocabulary, gram_col: str, out: str = "features") -> PipelineModel:
    """The same weights as sparse vectors, computed row by row without a shuffle."""
    counts = CountVectorizerModel.from_vocabulary(
        list(vocabulary.terms), inputCol=gram_col, outputCol="__tf", minTF=1.0
    )
    idf = ElementwiseProduct(scalingVec=Vectors.dense(vocabulary.idf()), inputCol="__tf", outputCol="__tfidf")
    unit = Normalizer(p=2.0, inputCol="__tfidf", outputCol=out)
    return PipelineModel([counts, idf, unit])


def prompt_payload(
    df: DataFrame, instruction: str, parts: Mapping[str, Column], max_tokens: int = 500, out: str = "payload"
) -> DataFrame:
    """One JSON request body per row: the instruction, then one labelled text per part."""
    texts = [F.lit(instruction)]
    texts += [F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit(""))) for label, value in parts.items()]
    content = F.array(*[F.struct(F.lit("text").alias("type"), t.alias("text")) for t in texts])
    message = F.struct(F.lit("user").alias("role"), content.alias("content"))
    body = F.struct(F.array(message).alias("messages"), F.lit(max_tokens).alias("max_tokens"))
    return df.withColumn(out, F.to_json(body))


def two_decimals(c: Column) -> Column:
    return F.format_string("%.2f", c.cast("double"))
