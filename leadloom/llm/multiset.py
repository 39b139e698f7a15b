"""Document fingerprints by a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (the pieces between line ends, empty ones included). Each
paragraph is hashed to a wide vector, and the fingerprint is the sum of the vectors: ``LANES`` entries
modulo 2**32 cut from the paragraph's SHA-512, and ``CELLS`` entries modulo 2**16 to which each pair of
neighbouring words adds plus or minus one at a place drawn by its hash. Sums do not depend on order, and
adding or subtracting the vectors of some paragraphs gives the fingerprint after their insertion or
deletion. Lanes tell texts apart. Cells are a count sketch: the inner product of two of them estimates how
many word pairs two texts share, with an error of about 1 / sqrt(CELLS) of their size.

The lanes are linear: paragraphs made on purpose may collide. Everything is plain expressions and
aggregations; a text is taken apart paragraph by paragraph, whose terms are summed before they move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES, LANE_BITS = 16, 32
CELLS, CELL_BITS = 128, 16
WIDTH = LANES + CELLS
_HEX = LANE_BITS // 4


def paragraphs(text: Column | str) -> Column:
    """The pieces between line ends; a null text is one empty paragraph, like an empty one."""
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n")


def _terms(paragraph: str, sign: str) -> Column:
    """(place, value) of the entries to which a paragraph adds, values times ``sign``."""
    digest = f"sha2({paragraph}, 512)"
    lanes = ", ".join(
        f"named_struct('place', {i}, 'value', {sign} * CAST(conv(substring(digest, {i * _HEX + 1}, {_HEX}), 16, 10) AS bigint))" for i in range(LANES)
    )
    cell = f"named_struct('place', CAST({LANES} + (h & {CELLS - 1}) AS int), 'value', {sign} * ((shiftright(h, 20) & 1) * 2 - 1))"
    words = f"filter(split({paragraph}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"
    hashes = f"transform(array({words}), words -> transform(words, (w, i) -> xxhash64(get(words, i - 1), w)))[0]"
    return F.concat(F.expr(f"transform(array({digest}), digest -> array({lanes}))[0]"), F.expr(f"transform({hashes}, h -> {cell})"))


def summed(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and the sums of the terms of their paragraphs.

    ``pieces`` has the keys, paragraph, sign and part (0, 1, ...); the result's ``vectors`` holds the vector of part 0, then
    that of part 1 and so on, ``WIDTH`` entries each, up to the largest part of the key.
    """
    terms = pieces.select(*keys, "part", F.inline(_terms("paragraph", "sign")))
    sums = terms.groupBy(*keys, "part", "place").agg(F.sum("value").alias("value"))
    entry = F.struct((F.col("part") * WIDTH + F.col("place")).alias("place"), "value")
    held = sums.groupBy(*keys).agg(F.collect_list(entry).alias("held"), F.max("part").alias("parts"))
    missing = f"array_except(sequence(0, (parts + 1) * {WIDTH} - 1), transform(held, x -> x.place))"
    whole = f"sort_array(concat(held, transform({missing}, p -> named_struct('place', p, 'value', 0L))))"
    return held.select(*keys, F.expr(f"transform({whole}, x -> x.value)").alias("vectors"))


def reduced(vector: Column) -> Column:
    """Entries brought to their moduli: lanes from 0, cells balanced around 0; array<bigint>."""
    half, size = 1 << CELL_BITS - 1, 1 << CELL_BITS
    cell = lambda x: F.pmod(x + F.lit(half), F.lit(size)) - F.lit(half)
    lane = lambda x: F.pmod(x, F.lit(1 << LANE_BITS))
    return F.transform(vector, lambda x, i: F.when(i < LANES, lane(x)).otherwise(cell(x)))


def part_of(vectors: Column | str, part: int) -> Column:
    return F.slice(vectors, part * WIDTH + 1, WIDTH)


def added(vector: Column, other: Column) -> Column:
    """Fingerprint of both multisets together; ``other`` may be a difference of paragraphs added and taken away."""
    return reduced(F.zip_with(vector, other, lambda a, b: a + b))


def removed(vector: Column, other: Column) -> Column:
    """Fingerprint after ``other``'s paragraphs are taken away."""
    return reduced(F.zip_with(vector, other, lambda a, b: a - b))


def written(vector: Column) -> Column:
    """Lower-case hex of all entries: 8 digits for a lane, 4 for a cell."""
    digits = lambda x, i: F.when(i < LANES, F.lpad(F.hex(x), _HEX, "0")).otherwise(F.lpad(F.hex(F.pmod(x, F.lit(1 << CELL_BITS))), CELL_BITS // 4, "0"))
    return F.lower(F.array_join(F.transform(vector, digits), ""))


def cells(vector: Column) -> Column:
    return F.slice(vector, LANES + 1, CELLS)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def likeness(a: Column, b: Column) -> Column:
    """Share of word pairs that two texts have in common, from 0 to 1, estimated from their fingerprints; 1 for equal ones.

    Twice the inner product of the cells over the sum of their squares; 0 if only one text has words or neither
    has and the fingerprints differ.
    """
    squares = _dot(cells(a), cells(a)) + _dot(cells(b), cells(b))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(2.0) * _dot(cells(a), cells(b)) / squares))
    return F.when(a == b, F.lit(1.0)).when(squares == 0, F.lit(0.0)).otherwise(share)


def fingerprints(docs: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``keys`` and ``vector``, the fingerprint of the texts of each key, as one multiset.

    With unique keys that is one fingerprint for each text. Null and empty texts are one empty paragraph;
    rows that share their keys are added up; an empty table gives no rows; other columns are not read.
    """
    named = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("body"))
    pieces = named.select(*named.columns[:-1], F.lit(0).alias("part"), F.lit(1).alias("sign"), F.explode(paragraphs("body")).alias("paragraph"))
    done = summed(pieces, named.columns[:-1])
    return done.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], reduced(F.col("vectors")).alias("vector"))
