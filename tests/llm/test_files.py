"""Token-id files and web archives: exact round trips, random access, edge rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
import zstandard

from leadloom.llm import queries, rawfiles, tokenstore, warc
from tests.llm import edges

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


TEXTS = [
    "", "a", " a", "a ", "a  b", "\n", "\n\na", "x\n y", "x \ny", "a\tb c", "It's we'll 'Tis", "é ñ—x ½²3", "a\x1cb \x1c c", "<|endoftext|> x", "a <|endoftext|>",
    "tab\t end", "\na b\n", "日本 語", "  ", "a\r\nb", "　x y", "x\x85y z", "one\ntwo three\nfour", "<| x", "a​b c", None,
]


def test_encoder_equals_the_library(library):
    code = tokenstore.Encoder(queries.tokenizer_path())
    for text, got in zip(TEXTS * 2, code.encode(TEXTS * 2), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got, dtype=f"<u{code.width}").tolist() == want, repr(text)


def test_encoder_forgets_and_learns_again(library, monkeypatch):
    monkeypatch.setattr(tokenstore, "_CACHE", 50)
    texts = [" ".join(f"word{i}{k} longerword{i * k}" for i in range(90)) for k in range(6)] * 60
    code = tokenstore.Encoder(queries.tokenizer_path())
    for text, got in zip(texts, code.encode(texts), strict=True):
        assert np.frombuffer(got, dtype=f"<u{code.width}").tolist() == library.encode(text, add_special_tokens=False).ids


def test_encoder_of_few_words(library):
    """The number of words that a caller names bounds the memory of a worker, not the ids."""
    texts = [" ".join(f"word{i}x{k}" for i in range(40)) for k in range(2000)]
    code = tokenstore.Encoder(queries.tokenizer_path(), words=3000)
    for text, got in zip(texts, code.encode(texts), strict=True):
        assert np.frombuffer(got, dtype=f"<u{code.width}").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(code._known) <= 3000 + 256 * 40


def test_encoder_on_drawn_words(library):
    """Letters of many scripts, digits and marks in every order, so that each way of learning a word is taken."""
    drawn = random.Random(4)
    signs = ["a", "Z", "é", "ß", "日", "я", "𝒳", "ª", "̈", "'s", "7", "½", ".", ",", "!", "?", "#", "_", "\u200b"]
    texts = ["".join(drawn.choice([" ", "\n", " ", *signs, *signs]) for _ in range(drawn.randint(1, 60))) for _ in range(3000)]
    texts += [" ".join(drawn.choice(signs[:8]) * 2 + drawn.choice(["", ".", ",", ".,", "!?"]) for _ in range(40)) for _ in range(300)]
    code = tokenstore.Encoder(queries.tokenizer_path())
    for text, got in zip(texts, code.encode(texts), strict=True):
        assert np.frombuffer(got, dtype=f"<u{code.width}").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def plain_layout(rows, library):
    out, at = [], 0
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_layout_equals_brute_force(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted(tuple(r) for r in queries.op5_token_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == plain_layout(rows, library)


def test_layout_of_edge_rows(spark, library):
    docs = edges.documents(spark)
    got = tokenstore.stored_layout(edges.clashing(docs), queries.tokenizer_path()).collect()
    want = plain_layout([(r["doc_id"], r["text"]) for r in docs.collect()], library)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == sorted(((k, n, c) for k, _, n, c in want), key=repr)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda k: (k is None, k or 0))


def test_documents_are_read_one_by_one(spark, library):
    path = rawfiles.new_folder(spark, "ids")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tokenstore.write_store(docs, path, queries.tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["ids"] for r in tokenstore.read_ids(spark, path, only=[3, 150, 10**9]).collect()}
    assert got == {k: [*library.encode(texts[k], add_special_tokens=False).ids, 0] for k in (3, 150)}
    content = bytes(rawfiles.read_files(spark, f"{path}/ids").first()["content"])
    with pytest.raises(ValueError, match="another dictionary"):
        tokenstore.Reader(content, b"other")


def test_no_documents(spark):
    assert tokenstore.stored_layout(edges.empty(spark), queries.tokenizer_path()).count() == 0
    one = edges.documents(spark).filter("doc_id = 3")
    assert [tuple(r) for r in tokenstore.stored_layout(one, queries.tokenizer_path()).select("doc_id", "start", "n_tokens").collect()] == [(3, 0, 1)]


PAGES = [
    (1, "http://a.example/x", "<p>same</p>"), (2, "http://b.example/y", "<p>same</p>"), (7, "http://c.example/z", "<p>same</p>"), (3, None, ""), (4, "u", None),
    (5, "http://a.example/\r\nbad", "Ünïcödé\r\n\r\n x"), (None, "n1", "<p>same</p>"), (None, "n2", "only rows without an id"),
    (None, "n2", "only rows without an id"), (9, "r", "twice"), (9, "r", "twice"), (8, "q", "twice"), (6, "big", edges.LONG * 3),
]


def plain_archive(rows, least=0):
    first = {}
    for key, _, html in rows:
        if key is not None and len((html or "").encode()) >= least:
            first[html or ""] = max(first.get(html or "", key), key)
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        origin = first.get(html or "")
        refers = origin if origin is not None and key != origin and len(payload) >= least else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((key, len(payload), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 6])
def test_archives_of_edge_rows(spark, least):
    pages = edges.clashing(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"))
    got = warc.archived(pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_archive(PAGES, least)


def test_archives_of_the_table(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = queries.op2_warc(spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_archive(rows)


@pytest.mark.parametrize("piece, pieces", [(warc._PIECE_BYTES, warc._FILE_PIECES), (1500, 2)])
def test_archive_is_a_plain_zstd_stream_and_records_open_by_offset(spark, monkeypatch, piece, pieces):
    """With small pieces a partition makes many archives, each with its dictionary."""
    monkeypatch.setattr(warc, "_PIECE_BYTES", piece)
    monkeypatch.setattr(warc, "_FILE_PIECES", pieces)
    path = rawfiles.new_folder(spark, "warc")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    warc.write_archives(pages, path)
    index = warc.read_archives(spark, path).collect()
    files = {r["file"]: bytes(r["content"]) for r in rawfiles.read_files(spark, path).collect()}
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(index) == len(html) and (piece > 1500 or len(files) > spark.sparkContext.defaultParallelism)
    for name, content in files.items():
        assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_MAGIC
        size = int.from_bytes(content[4:8], "little")
        trained = zstandard.decompress(content[8 : 8 + size]) if size else b""
        opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        for r in (r for r in index if r["file"] == name):
            fields, _, payload = warc.parse(opener.decompressobj().decompress(content[r["offset"] :]))
            assert fields["WARC-Type"] == r["record_type"]
            if r["record_type"] == "response":
                assert payload.decode() == html[r["page_id"]]


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
