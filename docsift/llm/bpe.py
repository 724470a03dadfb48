"""Byte-level BPE encoding and decoding by one shuffle of distinct words.

`encode` splits texts into pre-tokens. A block of documents keeps, in a file of its own,
the sequence of its words as numbers into the block's list of distinct words; the lists
alone are shuffled, by word. There each distinct word is encoded once, and its ids go
back to the blocks that hold it, where they are put in the order of the positions.
A word occurs at most once a block, so a frequent word is no hot key: its rows are packed
by bucket of words and block. `decode` joins ids with the table of token bytes.

Null text is the empty text, with no ids; null or repeated document ids are kept as they
are, one row out for each row in; an empty table gives an empty result. Columns other than id and
text are not read. A text longer than a chunk is cut before white space, where the
pattern always ends a piece.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import pretoken, store

BLOCK = 6 << 20  # characters whose words share a list
WORDS = 1 << 19  # distinct words a task remembers at a time
_loaded: dict[str, object] = {}


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes with their ids, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _once(key: str, make):
    if key not in _loaded:
        _loaded[key] = make()
    return _loaded[key]


def _splitter():
    classes = pretoken.tiktoken_classes()
    return classes, pretoken.Hasher(len(classes))


def _piece_encoder(path: str):
    import tiktoken

    return tiktoken.Encoding("file", pat_str=r"\S+|\s+", mergeable_ranks=ranks(path), special_tokens={})


def _byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens in one array, with offset and length by id; length -1: no such id."""
    table = ranks(path)
    size = max(table.values()) + 1
    offset, length = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    at = 0
    for token, i in table.items():
        offset[i], length[i] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(table), np.uint8), offset, length


def _packed(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Arrays as one compressed string, byte planes apart."""
    import zstandard

    out = []
    for a in arrays:
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        out.append(len(a).to_bytes(8, "little") + planes)
    return zstandard.compress(b"".join(out), level)


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.decompress(data), 0, []
    for kind in map(np.dtype, kinds):
        n = int.from_bytes(raw[at : at + 8], "little")
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at + 8).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += 8 + n * kind.itemsize
    return out


class _Block:
    """Documents whose words share one list of distinct words."""

    def __init__(self):
        self.ids, self.counts, self.groups, self.size = [], [], [], 0

    def add(self, ids: list, texts: list[str]) -> None:
        classes, hasher = _once("splitter", _splitter)
        counts = np.zeros(len(texts), np.uint32)
        for numbers, group in pretoken.chunked(texts):
            joined, starts, ends, hashes, n = pretoken.pieces(group, classes, hasher)
            np.add.at(counts, numbers, n.astype(np.uint32))
            self.groups.append((joined, starts.astype(np.uint32), ends.astype(np.uint32), hashes))
        self.ids += ids
        self.counts.append(counts)
        self.size += sum(map(len, texts))

    def close(self, folder: str, buckets: int) -> Iterator[dict]:
        """Write the positions to a file; the distinct words, by bucket."""
        hashes = np.concatenate([g[3] for g in self.groups])
        words, first, code, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        by_times = np.empty(len(words), np.uint32)
        by_times[np.argsort(-times, kind="stable")] = np.arange(len(words), dtype=np.uint32)
        bucket = ((words >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        path = f"{folder}/block-{uuid.uuid4().hex}"
        known = np.array([i is not None for i in self.ids], np.uint8)
        doc_ids = np.array([i or 0 for i in self.ids], np.int64)
        fs, at = store.opened(path)
        with fs.open_output_stream(at) as f:
            f.write(_packed(doc_ids, known, np.concatenate(self.counts), by_times[order], by_times[code]))
        upto = np.cumsum([0, *(len(g[3]) for g in self.groups)])
        group = np.searchsorted(upto, first, side="right") - 1
        stops = np.cumsum(np.bincount(bucket, minlength=buckets))
        begin = 0
        for b, stop in enumerate(stops.tolist()):
            found = []
            for i in order[begin:stop].tolist():
                joined, starts, ends, _ = self.groups[group[i]]
                at = first[i] - upto[group[i]]
                found.append(joined[starts[at] : ends[at]].encode())
            if found or b == 0:  # the first bucket also stands for blocks without words
                sizes = np.fromiter(map(len, found), np.uint32, len(found))
                yield {"bucket": b, "block": path, "words": _packed(sizes, np.frombuffer(b"".join(found), np.uint8))}
            begin = stop


def _blocks(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.string()), ("words", pa.binary())])
        block = _Block()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            begin = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size + block.size >= BLOCK or i + 1 == len(texts):
                    block.add(ids[begin : i + 1], texts[begin : i + 1])
                    begin, size = i + 1, 0
                if block.size >= BLOCK:
                    yield pa.RecordBatch.from_pylist(list(block.close(folder, buckets)), schema)
                    block = _Block()
        if block.ids:
            yield pa.RecordBatch.from_pylist(list(block.close(folder, buckets)), schema)

    return run


def _encoded_words(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _once(vocabulary, lambda: _piece_encoder(vocabulary))._encode_single_piece
        seen: dict[bytes, list[int]] = {}
        last = None
        for batch in batches:
            answers = []
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if bucket != last or len(seen) > WORDS:
                    seen, last = {}, bucket
                sizes, raw = _unpacked(data, "<u4", "u1")
                text, ends = raw.tobytes(), np.cumsum(sizes, dtype=np.int64).tolist()
                ids, begin = [], 0
                for end in ends:
                    word = text[begin:end]
                    begin = end
                    got = seen.get(word)
                    if got is None:
                        got = seen[word] = encode(word)
                    ids.append(got)
                counts = np.fromiter(map(len, ids), np.uint32, len(ids))
                flat = np.fromiter((x for one in ids for x in one), np.uint32, int(counts.sum()))
                answers.append(_packed(counts, flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(answers, pa.binary())], names=["bucket", "block", "ids"]
            )

    return run


def _reassembled(answers: pa.Table) -> Iterator[pa.RecordBatch]:
    answers = answers.take(np.argsort(answers.column("bucket").to_numpy(), kind="stable"))
    fs, at = store.opened(answers.column("block")[0].as_py())
    with fs.open_input_stream(at) as f:
        doc_ids, known, counts, order, codes = _unpacked(f.read(), "<i8", "u1", "<u4", "<u4", "<u4")
    found = [_unpacked(x, "<u4", "<u4") for x in answers.column("ids").to_pylist()]
    sizes = np.concatenate([x[0] for x in found]).astype(np.int64)
    flat = np.concatenate([x[1] for x in found])
    offset = np.empty(len(sizes), np.int64)
    size = np.empty(len(sizes), np.int64)
    offset[order], size[order] = np.cumsum(sizes) - sizes, sizes
    stops = np.cumsum(counts, dtype=np.int64)
    begin = 0
    for end in _cuts(counts):
        low = int(stops[begin - 1]) if begin else 0
        here = codes[low : int(stops[end - 1])]
        ids = flat[pretoken.ragged(offset[here], size[here])].astype(np.int32)
        upto = np.concatenate([[0], np.cumsum(size[here])])
        ends = upto[stops[begin:end] - low]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids[begin:end], mask=known[begin:end] == 0),
                pa.array(np.diff(ends, prepend=0)),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)),
            ],
            names=["doc_id", "n_tokens", "ids"],
        )
        begin = end


def _cuts(counts: np.ndarray, limit: int = 1 << 18) -> Iterator[int]:
    """Ends of groups of documents with about `limit` words together."""
    total = 0
    for i, n in enumerate(counts.tolist(), 1):
        total += n
        if total >= limit or i == len(counts):
            yield i
            total = 0


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """`doc_id, n_tokens, ids` of every row of `docs(doc_id, text)`, without special tokens."""
    buckets = store.parts_of(spark)
    folder = store.folder(spark, "bpe-blocks")
    rows = docs.select("doc_id", "text").mapInArrow(
        _blocks(folder, buckets), "bucket int, block string, words binary"
    )
    words = store.keep(spark, rows, "bpe-words")
    answers = (
        words.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encoded_words(vocabulary), "bucket int, block string, ids binary")
    )

    def block(table: pa.Table) -> pa.Table:
        whole = pa.Table.from_batches(list(_reassembled(table)))
        pa.default_memory_pool().release_unused()
        return whole

    return answers.groupBy("block").applyInArrow(block, "doc_id long, n_tokens long, ids array<int>")


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """`df` with the bytes that its ids stand for; an id outside the table is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, offset, length = _once("bytes " + vocabulary, lambda: _byte_table(vocabulary))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            ids = column.flatten().to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(length) or length[ids].min() < 0):
                raise ValueError("an id that the table of tokens does not have")
            texts, at = [], 0
            for n in column.value_lengths().to_pylist():
                mine = ids[at : at + (n or 0)]
                at += n or 0
                texts.append(None if n is None else table[pretoken.ragged(offset[mine], length[mine])].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, to]
            )

    return df.mapInArrow(run, f"{df._jdf.schema().toDDL()}, {to} binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """`doc_id, n_tokens`, columns asked for, and SHA-256 of the decimal ids joined by a space and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        "n_tokens",
        *more,
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
