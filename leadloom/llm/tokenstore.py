"""Token-id files: documents in id order, each a zstd frame under one shared dictionary.

A file is a zstd stream. It opens with a skippable frame that names the format, the width of an id and
the SHA-256 of the dictionary; one frame for each document follows; a last skippable frame holds the
index (document ids, offsets, lengths, token counts), with its own length at its end. One document is
read by its index row alone, without the frames around it. The dictionary itself, trained on a bounded
sample of serialized id arrays (``SAMPLE_ROWS``), lies beside the files.

Texts are encoded by the tokenizers library. A byte-level tokenizer never merges across a blank
between two words, so the library is asked once for each different word a task meets, and the answers
are joined; texts where this does not hold go to it whole.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.llm.rawfiles import SEPARATOR, new_folder, read_files, skippable, write_frames
from leadloom.llm.tables import same
from leadloom.session import materialise

END_ID = 0
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on about so many documents, of at most so many characters.
SAMPLE_ROWS = 1000
SAMPLE_CHARS = 1 << 16
FILE_BYTES = 64 << 20
_LEVEL = 3
_MAGIC = b"LTID\x01"
#: Words a worker remembers where the caller names no number; each takes about 130 bytes.
_CACHE = 900_000
_SHORT = 9
_JOINT = 100
_MARKS = ".,;:!?"


def _shown() -> dict[int, str]:
    """The sign that byte-level tokenizers show for each byte: itself if it can be seen, else the next one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)}


_SHOWN = _shown()
_WHOLE = re.compile(r"\s\s|<\|")


class Encoder:
    """Ids of texts as little-endian unsigned numbers of ``width`` bytes, with a bounded memory of words.

    About ``words`` different words are remembered (and those of one block of texts beyond); fewer cost time, not results.
    """

    def __init__(self, path: str, words: int | None = None):
        self._most = words or _CACHE
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        gc.set_threshold(100_000, 20, 100)  # the memory of words holds no cycles; walking it costs a fifth of the time
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self.width = 2 if self._library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._kind = f"<u{self.width}"
        self._known: dict[str, bytes] = {}
        self._first: dict[str, bytes] = {}  # words without a blank before them
        split = self._ids("a\n b")
        self._line = int(split[1]) if len(split) == 3 else -1
        # words may be taken apart only if the blank belongs to the word after it
        self._apart = len(split) == 3 and self._ids("a b").tolist() == [split[0], split[2]]
        # the usual expression of byte-level tokenizers keeps a word of letters whole, apart from the mark behind it
        parts = json.loads(self._library.to_str())
        before = parts.get("pre_tokenizer") or {}
        regular = before.get("type") == "ByteLevel" and before.get("use_regex") is True and not before.get("add_prefix_space") and not parts.get("normalizer")
        regular = regular and not any(x["content"].strip().isalpha() for x in parts.get("added_tokens", ()))
        self._marks = {m: self._ids(m).tobytes() for m in _MARKS} if regular else {}
        self._model = self._library.model if regular else None

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._library.encode(text, add_special_tokens=False).ids, dtype=self._kind)

    def _each(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts, one by one."""
        return [np.array(x.ids, dtype=self._kind).tobytes() for x in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        """Ask for new words, many in one call: a line end between words is an id of its own."""
        known, marks = self._known, self._marks
        lines = [w for w in words if w[:1] == "\n"]
        known.update(zip(lines, self._each(lines), strict=True))
        marked = [w for w in words if w[-1:] in marks and w[:-1].isalpha()]
        rest = words.difference(lines, marked).union(w[:-1] for w in marked if w[:-1] not in known)
        if self._model is not None:  # words of letters need no more than the merges of the model
            pieces, kind, width = self._model.tokenize, "little", self.width
            for w in filter(str.isalpha, rest):
                known[w] = b"".join([x.id.to_bytes(width, kind) for x in pieces((" " + w).encode().decode("latin-1").translate(_SHOWN))])
            rest = {w for w in rest if not w.isalpha()}
        plain = sorted(rest)
        parts = [plain[at : at + _JOINT] for at in range(0, len(plain), _JOINT)]
        asked = self._library.encode_batch_fast([" " + "\n ".join(part) for part in parts], add_special_tokens=False)
        for part, got in zip(parts, asked, strict=True):
            ids = np.array(got.ids, dtype=self._kind)
            cut = np.flatnonzero(ids == self._line) * self.width
            data = ids.tobytes()
            starts, stops = [0, *(cut + self.width).tolist()], [*cut.tolist(), len(data)]
            known.update(zip(part, map(data.__getitem__, map(slice, starts, stops)), strict=True))
        known.update([(w, known[w[:-1]] + marks[w[-1]]) for w in marked])

    def _forget(self) -> None:
        """Make room: the older half goes, except for short words, which come again."""
        late = len(self._known) // 2
        kept = {w: ids for i, (w, ids) in enumerate(self._known.items()) if i >= late or len(w) <= _SHORT}
        self._known = kept if len(kept) < self._most * 3 // 4 else {}

    def encode(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        for at in range(0, len(texts), 256):
            block = [t if isinstance(t, str) else "" for t in texts[at : at + 256]]
            cut = [None if not t or not self._apart or _WHOLE.search(t) else t.replace("\n", " \n").split(" ") for t in block]
            if len(self._known) > self._most:
                self._forget()
            if len(self._first) > self._most // 8:
                self._first = {}
            known, first = self._known, self._first
            fresh = list({words[0] for words in cut if words and words[0] not in first})
            first.update(zip(fresh, self._each(fresh), strict=True))
            words = [w for one in cut if one for w in one]
            ids = list(map(known.get, words))  # one look-up for each word; the first ones are not asked for
            starts = list(accumulate([len(one) for one in cut if one], initial=0))
            for start in starts[:-1]:
                ids[start] = first[words[start]]
            missing = [i for i, x in enumerate(ids) if x is None]
            if missing:
                self._learn({words[i] for i in missing})
                for i in missing:
                    ids[i] = known[words[i]]
            spans = iter(zip(starts, starts[1:], strict=False))
            for text, one in zip(block, cut, strict=True):
                if one:
                    start, stop = next(spans)
                    yield b"".join(ids[start:stop])
                else:
                    yield self._ids(text).tobytes()


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, words: int | None = None) -> Encoder:
    """The encoder of this worker process."""
    if (path, words) not in _ENCODERS:
        _ENCODERS[path, words] = Encoder(path, words)
    return _ENCODERS[path, words]


def _wide(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, dtype="<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, tokenizer: str, text: str = "text", rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES, words: int | None = None) -> bytes:
    """A dictionary for id arrays; empty where the sample is too small to train one.

    The sample is drawn from all partitions at a rate that gives about ``rows`` documents.
    """
    total = docs.count()
    if not total:
        return b""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(tokenizer, words)
        for batch in batches:
            yield pd.DataFrame({"ids": list(code.encode(list(batch["text"])))})

    short = docs.select(F.col(text).alias("text")).filter(F.length("text").between(1, SAMPLE_CHARS))
    drawn = short.sample(fraction=min(1.0, rows / total), seed=11)
    samples = [bytes(r[0]) for r in drawn.mapInPandas(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b""


def write_store(docs: DataFrame, path: str, tokenizer: str, text: str = "text", end_id: int = END_ID, words: int | None = None) -> None:
    """Write ``docs`` (doc_id, text) under ``path``: ids/ holds the files, dictionary/ the dictionary.

    Documents are dealt out by ranges of doc_id (null last; rows of one id by the hash of their text) and
    encoded where they land, so the shuffle moves texts, not ids. A null text is empty and holds
    the end id alone; repeated rows are stored each; an empty table makes no files. A worker remembers ``words`` words.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col(text).alias("text"))
    trained = train_dictionary(rows, tokenizer, words=words)
    spark.createDataFrame([(hashlib.sha256(trained).digest(), trained)], "hash binary, data binary").write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(tokenizer, words)
        packer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        end = end_id.to_bytes(code.width, "little")
        at, index = 0, []
        for batch in batches:
            frames = []
            if not index:
                frames.append(skippable(_MAGIC + bytes([code.width]) + hashlib.sha256(trained).digest()))
                at = len(frames[0])
            for key, ids in zip(batch["doc_id"], code.encode(list(batch["text"])), strict=True):
                frame = packer.compress(ids + end)
                missing = pd.isna(key)
                index.append((0 if missing else int(key), missing, at, len(frame), len(ids) // code.width + 1))
                frames.append(frame)
                at += len(frame)
            at += len(SEPARATOR)
            yield pd.DataFrame({"value": [b"".join(frames)]})
        if index:
            table = b"".join(np.array(column, dtype="<i8").tobytes() for column in zip(*index, strict=True))
            yield pd.DataFrame({"value": [skippable(table + struct.pack("<q", len(index)))]})

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("_tie")]
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size if size < 1 << 60 else 0  # Spark gives the largest number where it has no figure
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-known // FILE_BYTES))
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    write_frames(dealt.select("doc_id", "text").mapInPandas(run, "value binary"), f"{path}/ids")


def read_index(content: bytes) -> tuple[bytes, int, np.ndarray]:
    """Dictionary hash, id width and index rows (id, id is null, offset, length, tokens) of a file."""
    (size,) = struct.unpack_from("<I", content, 4)
    head = content[8 : 8 + size]
    if head[: len(_MAGIC)] != _MAGIC:
        raise ValueError("not a token-id file")
    last = len(content) - len(SEPARATOR) - 8
    (n,) = struct.unpack_from("<q", content, last)
    table = np.frombuffer(content, dtype="<i8", count=5 * n, offset=last - 40 * n).reshape(5, n)
    return head[len(_MAGIC) + 1 :], head[len(_MAGIC)], table


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, content: bytes, dictionary: bytes):
        named, self._width, self.index = read_index(content)
        if hashlib.sha256(dictionary).digest() != named:
            raise ValueError("the file was written with another dictionary")
        self._content = content
        self._opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, row: int) -> bytes:
        """Ids of the document in an index row, as little-endian unsigned 32-bit numbers."""
        start, length = int(self.index[2, row]), int(self.index[3, row])
        return _wide(self._opener.decompress(self._content[start : start + length]), self._width)


def _dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["data"])


def read_ids(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, ids) of the stored documents, or of those with the given ids."""
    trained = _dictionary(spark, path)
    wanted = None if only is None else np.array(sorted(set(only)), dtype="<i8")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                reader = Reader(content, trained)
                keys, absent = reader.index[0], reader.index[1]
                rows = range(keys.size) if wanted is None else np.flatnonzero(np.isin(keys, wanted) & (absent == 0)).tolist()
                for at in range(0, len(rows), 256):
                    part = rows[at : at + 256]
                    yield pd.DataFrame({
                        "doc_id": pd.array([None if absent[r] else int(keys[r]) for r in part], dtype="Int64"),
                        "ids": [np.frombuffer(reader.ids(r), dtype="<u4").astype("int64") for r in part],
                    })

    return _files(spark, path).mapInPandas(run, "doc_id bigint, ids array<bigint>")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return read_files(spark, f"{path}/ids")


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from decompressed files.

    Offsets inside a file come from its own order; only one row for each file is added up across files.
    """
    trained = _dictionary(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["file"], batch["content"], strict=True):
                reader = Reader(content, trained)
                ids = [reader.ids(r) for r in range(reader.index.shape[1])]
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                yield pd.DataFrame({
                    "file": name,
                    "doc_id": pd.Series([None if gone else int(k) for k, gone in zip(reader.index[0], reader.index[1], strict=True)], dtype="Int64"),
                    "inside": np.cumsum(counts) - counts,
                    "n_tokens": counts,
                    "ids_crc32": np.array([zlib.crc32(x) for x in ids], dtype=np.int64),
                })

    rows = materialise(_files(spark, path).mapInPandas(run, "file string, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"))
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return rows.join(sums, same(rows, sums, ["file"])).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def stored_layout(docs: DataFrame, tokenizer: str, end_id: int = END_ID, words: int | None = None) -> DataFrame:
    """Write the documents to a new folder and read them back: one row for each input row."""
    spark = docs.sparkSession
    path = new_folder(spark, "ids")
    write_store(docs, path, tokenizer, end_id=end_id, words=words)
    return read_layout(spark, path)
