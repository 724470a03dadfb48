import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from test_token_records import TRICKY

from docsift.llm import bpe, pretoken

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={}
    ).encode_ordinary


def test_pieces_are_matches_of_the_pattern():
    classes, hasher = pretoken.tiktoken_classes(), pretoken.Hasher(0x110000)
    joined, a, b, hashes, counts = pretoken.pieces(TRICKY, classes, hasher)
    got = [joined[x:y] for x, y in zip(a, b, strict=True)]
    assert got == [m for t in TRICKY for m in regex.findall(public_tokenizers.PATTERN, t)]
    assert len(set(hashes.tolist())) == len(set(got)) and counts.sum() == len(got)


def test_encode_and_decode(spark, docs, edge_rows, reference, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 2000)
    rows = edge_rows + [(100 + i, t) for i, t in enumerate(TRICKY)]
    got = bpe.decode(bpe.encode(spark, docs(rows), PATH), PATH).collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert len(got) == len(rows)
    for row, (doc_id, text) in zip(sorted(got, key=key), sorted(rows, key=key), strict=True):
        assert row["doc_id"] == doc_id
        assert row["ids"] == reference(text or "") and row["n_tokens"] == len(row["ids"])
        assert bytes(row["decoded"]) == (text or "").encode()


def test_digests(spark, docs, reference):
    [row] = bpe.digests(bpe.decode(bpe.encode(spark, docs([(1, "Hello  world")]), PATH), PATH)).collect()
    ids = " ".join(map(str, reference("Hello  world")))
    assert row["ids_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(b"Hello  world").hexdigest()


def test_unknown_id_is_an_error(spark):
    df = spark.createDataFrame([(1, [1, 60_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="does not have"):
        bpe.decode(df, PATH).collect()


def test_empty(spark, docs):
    assert bpe.decode(bpe.encode(spark, docs([]), PATH), PATH).count() == 0
