"""Embedding models: text column in, array<float> column out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions import tokens as tk
from docsift.functions import vectors as vx


def _buckets_and_signs(tokens: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    digests = b"".join(hashlib.md5(t, usedforsecurity=False).digest() for t in tokens)
    table = np.frombuffer(digests, np.uint8).reshape(-1, 16)
    bucket = table[:, :4].copy().view(">u4")[:, 0].astype(np.int64) % dim
    sign = 1 - 2 * ((table[:, 4] >> 4) & 1).astype(np.int64)
    sign[[i for i, t in enumerate(tokens) if not t]] = 0
    return bucket, sign


def signed_counts(token_lists: pa.Array, dim: int) -> np.ndarray:
    """Hashed bags of tokens for one Arrow batch; each distinct token is hashed once."""
    n = len(token_lists)
    lengths = pc.fill_null(pc.list_value_length(token_lists), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(token_lists)
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    if len(flat) == 0:
        return np.zeros((n, dim))
    coded = flat.dictionary_encode()
    bucket, sign = _buckets_and_signs(coded.dictionary.cast(pa.binary()).to_pylist(), dim)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(n), lengths)
    cells = owner * dim + bucket[codes]
    return np.bincount(cells, weights=sign[codes], minlength=n * dim).reshape(n, dim)


def float_lists(matrix: np.ndarray) -> pa.Array:
    n, dim = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


@dataclass(frozen=True)
class HashedModel:
    """Signed hashed bag of tokens: deterministic, needs no model file.

    bucket = first 8 hex digits of md5(token) mod dim; the parity of the next
    digit gives the sign.
    """

    dim: int = 64

    @property
    def model_id(self) -> str:
        return f"hashed-bag-{self.dim}"

    def column(self, text: Column) -> Column:
        dim = self.dim

        @F.arrow_udf(T.ArrayType(T.FloatType()))
        def hashed(batch: pa.Array) -> pa.Array:
            return float_lists(signed_counts(pc.split_pattern(batch, " "), dim))

        # One string per row crosses to Python more cheaply than a token list.
        return hashed(tk.token_line(text))


@dataclass(frozen=True)
class HashedTokenModel:
    """A vector for every token, from its letters: the signed hashed bag of its letter triples, with a blank
    at either end. Spellings that share triples are alike; needs no model file."""

    dim: int = 64

    def vectors(self, tokens: list[str]) -> np.ndarray:
        """Unit rows; zero where the triples cancel out."""
        triples, owner = [], []
        for i, token in enumerate(tokens):
            padded = f" {token} "
            triples += [padded[j : j + 3] for j in range(len(padded) - 2)]
            owner += [i] * (len(padded) - 2)
        if not triples:
            return np.zeros((len(tokens), self.dim))
        distinct = pa.array(triples).dictionary_encode()
        bucket, sign = _buckets_and_signs([t.encode() for t in distinct.dictionary.to_pylist()], self.dim)
        codes = distinct.indices.to_numpy()
        cells = np.array(owner) * self.dim + bucket[codes]
        counts = np.bincount(cells, weights=sign[codes], minlength=len(tokens) * self.dim).reshape(-1, self.dim)
        lengths = np.linalg.norm(counts, axis=1, keepdims=True)
        return counts / np.where(lengths > 0, lengths, 1.0)


@dataclass(frozen=True)
class FunctionModel:
    """A user model. `load()` runs once per task and returns `texts -> matrix`."""

    model_id: str
    dim: int
    load: Callable[[], Callable[[list[str]], np.ndarray]]
    batch_size: int = 256

    def column(self, text: Column) -> Column:
        dim, load, step = self.dim, self.load, self.batch_size

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def model(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode = load()
            for batch in batches:
                texts = batch.fillna("").tolist()
                parts = [np.asarray(encode(texts[i : i + step]), dtype=np.float32) for i in range(0, len(texts), step)]
                matrix = np.vstack(parts) if parts else np.zeros((0, dim), np.float32)
                if matrix.shape != (len(texts), dim):
                    raise ValueError(f"model returned {matrix.shape}, expected {(len(texts), dim)}")
                yield pd.Series(list(matrix))

        return model(text)


def embed(df: DataFrame, text_col: str, model, out: str = "vector") -> DataFrame:
    return df.withColumn(out, model.column(F.col(text_col)))


def principal_axes(vectors: DataFrame, vector_col: str, dim: int) -> Callable[[Column], Column]:
    """Fit principal components and return the projection to `dim` values, which must
    be applied to documents and queries alike. Only the covariance leaves the tasks."""
    points = vectors.select(array_to_vector(vector_col).alias("v"))
    axes = np.asarray(PCA(k=dim, inputCol="v", outputCol="p").fit(points).pc.toArray())

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def project(batch: pa.Array) -> pa.Array:
        flat = pc.list_flatten(batch).to_numpy(zero_copy_only=False).astype(np.float64)
        return float_lists(flat.reshape(len(batch), len(axes)) @ axes)

    return project


def vector_report(df: DataFrame, key: str, vector_col: str, dim: int) -> DataFrame:
    """Per row: length, and whether it is a usable vector of `dim` numbers."""
    v = F.col(vector_col)
    return df.select(key, F.size(v).alias("n_values"), vx.is_valid(v, dim).alias("ok"))
