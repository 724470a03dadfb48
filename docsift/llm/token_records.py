"""Token ids as length-delimited binary records with an offset index.

A shard holds the documents of one range of ids, in ascending order. A record is
`length (u64) | masked CRC-32C of the length | ids | masked CRC-32C of the ids`, little
endian throughout; ids take two bytes if the vocabulary fits, else four. Beside each
shard lies an index of one entry a document, so that a reader can take records in any
order: `doc_id i64, known u8, offset u64, n_tokens u32`. `write` returns the manifest, which
alone names the files that count: a task that is run again writes files of its own.

Null text is the empty text; null ids come first; documents that share an id are kept,
ordered by their texts. An empty table gives an empty manifest. Columns other than id and text are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm import pretoken, store
from docsift.llm.crc32c import crc32c, masked

MANIFEST = "shard long, path string, index_path string, records long, tokens long, wide boolean"
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("n_tokens", "<u4")])
FRAME = 12  # bytes before the ids; four more follow them
GROUP = 1 << 22
_loaded: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Ids of texts by a vocabulary file of the `tokenizers` library: its model encodes
    each distinct pre-token, which gives what encoding the whole text gives. With `added`,
    added tokens of the file that a text spells out get their ids, as by the library's
    default; without, they are text like any other."""

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        tokens = tokenizer.get_added_tokens_decoder() if added else {}
        self.added = {t.content: np.array([i], np.uint32) for i, t in tokens.items()}
        # Tokens that ask for more than their own letters are left to the library.
        self.literal = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in tokens.values())
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})")
        self.model = tokenizer.model
        self.size = tokenizer.get_vocab_size()
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.classes = pretoken.tokenizers_classes()
        self.hasher = pretoken.Hasher(len(self.classes))
        self.cache = pretoken.PieceCache(self._ids)

    def _ids(self, words: list[str]) -> list[list[int]]:
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(w.encode().decode("latin-1").translate(self.letters))] for w in words]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        spelled = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not spelled:
            return self._without_added(texts)
        if not self.literal:
            rest = list(texts)
            for i in spelled:
                rest[i] = ""
            out = self._without_added(rest)
            for i in spelled:
                out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            return out
        # Text before the first added token, the token, the text up to the next, and so on.
        parts = [self.cut.split(t) for t in texts]
        ids = iter(self._without_added([x for p in parts for x in p[::2]]))
        return [
            next(ids) if len(p) == 1 else np.concatenate([self.added[x] if j % 2 else next(ids) for j, x in enumerate(p)])
            for p in parts
        ]

    def _without_added(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for numbers, group in pretoken.chunked(texts):
            joined, starts, ends, hashes, counts = pretoken.pieces(group, self.classes, self.hasher)
            offset, size = self.cache.lookup(joined, starts, ends, hashes)
            ids = self.cache.pool[pretoken.ragged(offset, size)]
            upto = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
            stop = np.cumsum(counts)
            for number, a, b in zip(numbers.tolist(), upto[stop - counts].tolist(), upto[stop].tolist(), strict=True):
                out[number].append(ids[a:b])
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def encoder(path: str, added: bool = False) -> Encoder:
    if (path, added) not in _loaded:
        _loaded[path, added] = Encoder(path, added)
    return _loaded[path, added]


def frames(payloads: list[bytes]) -> list[bytes]:
    """The payloads as records."""
    sizes = [len(p).to_bytes(8, "little") for p in payloads]
    heads = masked(crc32c(sizes)).astype("<u4")
    tails = masked(crc32c(payloads)).astype("<u4")
    return [
        b"".join((s, h.tobytes(), p, t.tobytes())) for s, h, p, t in zip(sizes, heads, payloads, tails, strict=True)
    ]


def unframed(data: bytes, sizes: np.ndarray) -> list[bytes]:
    """Payloads of consecutive records whose payload sizes the index gives; a wrong
    length or checksum is an error."""
    ends = np.cumsum(sizes + FRAME + 4)
    begins = ends - sizes - FRAME - 4
    lengths = [data[b : b + 8] for b in begins.tolist()]
    payloads = [data[b + FRAME : e - 4] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
    heads = np.frombuffer(b"".join(data[b + 8 : b + FRAME] for b in begins.tolist()), "<u4")
    tails = np.frombuffer(b"".join(data[e - 4 : e] for e in ends.tolist()), "<u4")
    told = np.frombuffer(b"".join(lengths), "<u8")
    if (told != sizes).any() or (heads != masked(crc32c(lengths))).any() or (tails != masked(crc32c(payloads))).any():
        raise ValueError("damaged token record")
    return payloads


def write(spark: SparkSession, docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Encode `docs(doc_id, text)` into shards below `folder`; returns the manifest."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(vocabulary, added=True)
        wide = encode.size > 1 << 16
        kind = np.dtype("<u4" if wide else "<u2")
        number = TaskContext.get().partitionId()
        base = f"{folder}/shard-{number:06d}-{uuid.uuid4().hex[:12]}"
        out = None
        entries, offset = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs, at = store.opened(base)
                out = fs.open_output_stream(at + ".rec")
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _spans([len(t) for t in texts]):
                payloads = [np.append(x, end_id).astype(kind).tobytes() for x in encode(texts[a:b])]
                entry = np.zeros(b - a, INDEX)
                entry["doc_id"] = [i or 0 for i in ids[a:b]]
                entry["known"] = [i is not None for i in ids[a:b]]
                sizes = np.fromiter(map(len, payloads), np.int64, b - a)
                entry["n_tokens"] = sizes // kind.itemsize
                ends = np.cumsum(sizes + FRAME + 4)
                entry["offset"] = offset + ends - sizes - FRAME - 4
                offset += int(ends[-1])
                entries.append(entry)
                out.write(b"".join(frames(payloads)))
        if out is not None:
            out.close()
            index = np.concatenate(entries)
            with fs.open_output_stream(at + ".idx") as f:
                f.write(index.tobytes())
            row = [number, base + ".rec", base + ".idx", len(index), int(index["n_tokens"].sum(dtype=np.int64)), wide]
            names = ["shard", "path", "index_path", "records", "tokens", "wide"]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))])

    ordered = (
        docs.withColumn("tie", F.crc32(F.coalesce("text", F.lit(""))))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
    )
    return store.keep(spark, ordered.select("doc_id", "text").mapInArrow(shard, MANIFEST), "token-manifest")


def _spans(sizes: list[int], limit: int = GROUP) -> Iterator[tuple[int, int]]:
    """Consecutive items of about `limit` together."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents of the shards, from the files: `doc_id, start, n_tokens, ids_crc32`, where
    `start` counts the ids of all documents before. Lengths and checksums are verified."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, at = store.opened(row["index_path"])
                with fs.open_input_stream(at) as f:
                    index = np.frombuffer(f.read(), INDEX)
                kind = np.dtype("<u4" if row["wide"] else "<u2")
                sizes = index["n_tokens"].astype(np.int64) * kind.itemsize
                n_tokens = index["n_tokens"].astype(np.int64)
                start = row["base"] + np.cumsum(n_tokens) - n_tokens
                fs, at = store.opened(row["path"])
                with fs.open_input_file(at) as f:
                    for a, b in _spans(sizes.tolist()):
                        f.seek(int(index["offset"][a]))
                        data = f.read(int((sizes[a:b] + FRAME + 4).sum()))
                        crcs = [
                            zlib.crc32(np.frombuffer(p, kind).astype("<u4").tobytes())
                            for p in unframed(data, sizes[a:b])
                        ]
                        unknown = index["known"][a:b] == 0
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(index["doc_id"][a:b].astype(np.int64), mask=unknown),
                                pa.array(start[a:b]),
                                pa.array(n_tokens[a:b]),
                                pa.array(crcs, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    spread = placed.repartitionByRange(max(1, manifest.count()), "shard")
    return spread.mapInArrow(records, "doc_id long, start long, n_tokens long, ids_crc32 long")
