"""Web archives: WARC records, each a zstd frame under a dictionary that the file itself carries.

A file is a valid zstd stream: first a skippable frame (magic number 0x184D2A5D) with the dictionary,
itself compressed, then one frame for each record, so any record can be opened by its offset. The
dictionary is trained on a bounded sample of the records (``SAMPLE_ROWS``). Of records with equal
payloads, one is a response and the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.rawfiles import SEPARATOR, new_folder, read_files, skippable, write_frames
from leadloom.llm.tables import same
from leadloom.session import materialise, spread

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on about so many records, of at most so many characters.
SAMPLE_ROWS = 600
SAMPLE_CHARS = 1 << 16
#: Payloads of fewer bytes are always stored as responses.
MIN_BYTES = 0
_LEVEL = 3
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE_SPACE = 0x6C6C6F6F6D5F7061 << 64  # upper half of the record ids that hold a page id
#: Records are handed to the writer in pieces of about so many bytes; so many pieces make a file.
_PIECE_BYTES = 1 << 20
_FILE_PIECES = 64


def _record_id(page_id: int | None, extra: str = "") -> str:
    """URN of a record: a page id is its lower half; rows without one get a name-based id."""
    value = uuid.uuid5(uuid.NAMESPACE_URL, extra) if page_id is None else uuid.UUID(int=_PAGE_SPACE | (page_id & (1 << 64) - 1))
    return f"<urn:uuid:{value}>"


def _page_id(record_id: str) -> int | None:
    value = uuid.UUID(record_id[10:-1]).int
    low = value & (1 << 64) - 1
    return None if value >> 64 << 64 != _PAGE_SPACE else low - (1 << 64 if low >> 63 else 0)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, target: str | None) -> bytes:
    """One WARC/1.1 record; a revisit (``refers_to`` given) has the HTTP head only."""
    target_line = "" if url is None else re.sub(r"[\r\n]+", " ", url)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, f"{target_line} {digest}")),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", target_line))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
        if target is not None:
            fields.append(("WARC-Refers-To-Target-URI", re.sub(r"[\r\n]+", " ", target)))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def train_dictionary(pages: DataFrame, rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from records drawn from all partitions; empty where they are too few."""
    total = pages.count()
    if not total:
        return b""
    short = pages.select("page_id", "url", "html").filter(F.length("html").between(1, SAMPLE_CHARS))
    drawn = short.sample(fraction=min(1.0, rows / total), seed=5).collect()
    samples = [record(r["page_id"], r["url"], p := r["html"].encode("utf-8", "surrogatepass"), _base32(p), len(p), None, None) for r in drawn]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b""


def _base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_originals(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id``, url, html, digest (SHA-1 in hex), and for revisits the original's refers_to and target.

    The original of equal payloads is the row with the largest page_id. Only digests are grouped, in
    part before the shuffle; a payload that one page alone has needs no partner and is not joined.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha1(body).alias("digest"), F.length(body).alias("size"))
    groups = rows.filter(F.col("size") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("_first"), F.max_by("url", F.struct("page_id", "url")).alias("_target"), F.count("*").alias("_n")
    )
    shared = materialise(groups.filter("_n > 1 AND _first IS NOT NULL").drop("_n"))
    joined = rows.join(shared, same(rows, shared, ["digest"]), "left").select(rows["*"], "_first", "_target")
    revisit = ~F.col("page_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull() & (F.col("size") >= min_bytes)
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("_first")).alias("refers_to"), F.when(revisit, F.col("_target")).alias("target"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write a record for every row of (page_id, url, html), in archives of about ``_PIECE_BYTES * _FILE_PIECES`` bytes.

    A partition of any size makes as many archives as it needs, each with the dictionary at its head. A null page is an empty payload; rows that repeat the largest page id of their payload are all
    responses; payloads that only rows without an id share are all responses; an empty table makes no files.
    """
    trained = train_dictionary(pages)
    rows = with_originals(pages, min_bytes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        head = skippable(zstandard.compress(trained) if trained else b"", DICTIONARY_MAGIC)
        pieces, frames, size = 0, [head], 0

        def piece() -> pd.DataFrame:
            return pd.DataFrame({"value": [b"".join(frames)]})

        for batch in batches:
            for page_id, url, html, refers, target in batch.itertuples(index=False, name=None):
                payload = html.encode("utf-8", "surrogatepass") if isinstance(html, str) else b""
                made = record(
                    None if pd.isna(page_id) else int(page_id), url if isinstance(url, str) else None, payload, _base32(payload), len(payload),
                    None if pd.isna(refers) else int(refers), target if isinstance(target, str) else None,
                )
                frames.append(packer.compress(made))
                size += len(frames[-1])
                if size >= _PIECE_BYTES:
                    yield piece()
                    pieces += 1
                    frames, size = [head] if pieces % _FILE_PIECES == 0 else [], 0
        if size:
            yield piece()

    # ids as text: a column of numbers and nulls would pass through floating point
    texts = rows.select(F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"), "target")
    write_frames(spread(texts).mapInPandas(run, "value binary"), path, _FILE_PIECES)


def _frame_end(content: bytes, at: int) -> int:
    """Where the zstd frame that begins at an offset ends, from its block headers."""
    checksum = 4 if content[at + 4] & 4 else 0
    at += zstandard.frame_header_size(content[at : at + 18])
    while True:
        word = int.from_bytes(content[at : at + 3], "little")
        at += 3 + (1 if word >> 1 & 3 == 1 else word >> 3)  # a run-length block holds one byte
        if word & 1:
            return at + checksum


def frames_of(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of every record in an archive."""
    magic, size = struct.unpack_from("<II", content, 0)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with its dictionary")
    packed = content[8 : 8 + size]
    trained = zstandard.decompress(packed) if packed else b""
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    at = 8 + size
    while at < len(content):
        if content[at : at + len(SEPARATOR)] == SEPARATOR:
            at += len(SEPARATOR)
            continue
        end = _frame_end(content, at)
        yield at, opener.decompress(content[at:end])
        at = end


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the file and offset of every record.

    A response's size and digest are those of the payload found; a digest that differs from the one
    stored is an error. A revisit has both from its fields.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset"]
        for batch in batches:
            for name, content in zip(batch["file"], batch["content"], strict=True):
                rows = []
                for at, data in frames_of(content):
                    fields, http, payload = parse(data)
                    digest, refers = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("WARC-Refers-To")
                    if refers is None and digest != _base32(payload):
                        raise ValueError(f"payload digest differs in {name} at {at}")
                    size = len(payload) if refers is None else int(http["Content-Length"])
                    rows.append((
                        _page_id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"],
                        None if refers is None else _page_id(refers), name, at,
                    ))
                made = pd.DataFrame(rows, columns=names)
                yield made.astype({"page_id": "Int64", "refers_to": "Int64"}) if rows else made

    return read_files(spark, path).mapInPandas(
        run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, file string, offset bigint"
    )


def archived(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the pages to a new folder of archives and read them back."""
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
