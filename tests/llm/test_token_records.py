import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import AddedToken, Tokenizer

from docsift.llm import pretoken, store, token_records
from docsift.llm.crc32c import crc32c

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = [
    " 's it's don't 'll''s  x\n\n y 's't 'sad re've '", "", "\n", "a\n b\t\tc  d   ", "<|endoftext|>' s x　y 12a3 ٣٤ x²'re'",
    "''re 're''ve!'t", "\0a\0 b", "\x1c\x1d a\x85b\xa0c", "😀😀 ‍é́",
]


def whole(text):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def slow_crc(message):
    crc = 0xFFFFFFFF
    for byte in message:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c():
    messages = [b"123456789", b"", b"a", b"ab" * 300, bytes(range(256)) * 5, b"x" * 255, b"y" * 256, b"z" * 257]
    assert crc32c(messages).tolist() == [slow_crc(m) for m in messages]
    assert crc32c([b"123456789"])[0] == 0xE3069283
    assert len(crc32c([])) == 0


def test_encoder_equals_whole_text_encoding(monkeypatch):
    encode = token_records.encoder(PATH)
    for got, text in zip(encode(TRICKY), TRICKY, strict=True):
        assert got.tolist() == whole(text)
    text = " ".join(TRICKY) * 20
    cut = [x for _, x in pretoken.segments([text], 500)]
    assert len(cut) > 3 and "".join(cut) == text
    assert [i for part in encode(cut) for i in part.tolist()] == whole(text)


LITERAL = [
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> \n<|endoftext|>'s", "x  <|endoftext|>  y <|endoftext", "", "plain",
]


def by_library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_added_tokens_get_their_ids():
    encode = token_records.encoder(PATH, added=True)
    texts = [*LITERAL, *TRICKY, " ".join(TRICKY) * 20]
    assert [x.tolist() for x in encode(texts)] == [by_library(PATH, t) for t in texts]
    assert encode(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("more", [{"lstrip": True}, {"single_word": True}, {"normalized": True}, {"normalized": False}])
def test_added_tokens_of_every_sort(tmp_path, more):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.add_tokens([AddedToken("<|end", **more), AddedToken("<|endoftext|> b", **{"normalized": False} | more)])
    path = str(tmp_path / "more.json")
    tokenizer.save(path)
    texts = [*LITERAL, "a<|end b <|end", "<|endoftext|> bc", *TRICKY]
    assert [x.tolist() for x in token_records.encoder(path, added=True)(texts)] == [by_library(path, t) for t in texts]


def test_records_hold_added_tokens(spark, docs):
    manifest = token_records.write(spark, docs(list(enumerate(LITERAL))), store.folder(spark, "test"), PATH)
    start = 0
    for row in sorted(token_records.read(spark, manifest).collect(), key=lambda r: r["doc_id"]):
        ids = [*by_library(PATH, LITERAL[row["doc_id"]]), 0]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_cache_forgets_and_recovers():
    cache = pretoken.PieceCache(lambda words: [[len(w)] * 2 for w in words], slots=4, pool=8)
    classes, hasher = pretoken.tiktoken_classes(), pretoken.Hasher(0x110000)
    for _ in range(3):
        joined, a, b, h, _ = pretoken.pieces(["aa bbb cccc d ee ffffff"], classes, hasher)
        offset, size = cache.lookup(joined, a, b, h)
        assert cache.pool[pretoken.ragged(offset, size)].tolist() == [x for n in (b - a).tolist() for x in (n, n)]


def test_write_and_read(spark, docs, edge_rows):
    folder = store.folder(spark, "test")
    manifest = token_records.write(spark, docs(edge_rows), folder, PATH)
    rows = sorted(token_records.read(spark, manifest).collect(), key=lambda r: r["start"])
    expected = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert len(rows) == len(expected)
    for row, (doc_id, text) in zip(rows, expected, strict=True):
        ids = [*whole(text), 0]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_index_gives_any_record_and_damage_is_found(spark, docs):
    manifest = token_records.write(spark, docs([(3, "c c"), (1, "a"), (2, "b b b")]), store.folder(spark, "test"), PATH)
    for row in manifest.collect():
        path, index_path = (row[c].removeprefix("file:") for c in ("path", "index_path"))
        index = np.fromfile(index_path, token_records.INDEX)
        data = open(path, "rb").read()
        for entry in index[::-1]:
            at, n = int(entry["offset"]), int(entry["n_tokens"]) * 2
            [payload] = token_records.unframed(data[at : at + n + 16], np.array([n]))
            assert np.frombuffer(payload, "<u2").tolist() == [*whole({1: "a", 2: "b b b", 3: "c c"}[entry["doc_id"]]), 0]
            broken = bytearray(data[at : at + n + 16])
            broken[13] ^= 1
            with pytest.raises(ValueError):
                token_records.unframed(bytes(broken), np.array([n]))


def test_empty(spark, docs):
    manifest = token_records.write(spark, docs([]), store.folder(spark, "test"), PATH)
    assert manifest.count() == 0 and token_records.read(spark, manifest).count() == 0
