"""Fusing, reranking and judging hit lists (`query_id, key, score, rank`)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions import tokens as tk
from docsift.operators.embed import HashedTokenModel
from docsift.operators.topk import SCORE_DIGITS, rank_hits
from docsift.session import counted, small_side

RRF_K = 60


def fuse(first: DataFrame, second: DataFrame, k: int) -> DataFrame:
    """Reciprocal-rank fusion (Cormack et al. 2009): sum of 1 / (60 + rank)."""
    left = first.select("query_id", "key", F.col("rank").alias("_a"))
    right = second.select("query_id", "key", F.col("rank").alias("_b"))

    def part(name: str) -> Column:
        return F.coalesce(1.0 / (RRF_K + F.col(name)), F.lit(0.0))

    both = left.join(right, ["query_id", "key"], "full_outer")
    scored = both.select("query_id", "key", F.round(part("_a") + part("_b"), SCORE_DIGITS).alias("score"))
    return rank_hits(scored, k)


@dataclass(frozen=True)
class CoverageReranker:
    """Mean of two shares: distinct query tokens found, and neighbouring query
    token pairs found as neighbours. No model needed."""

    columns_to_rerank: tuple[str, ...]

    def score(self, candidates: DataFrame) -> DataFrame:
        text = F.concat_ws(" ", *[F.col(c) for c in self.columns_to_rerank])
        asked = tk.tokens(F.col("query_text"))
        rows = candidates.withColumns(
            {
                "_terms": tk.padded(F.array_distinct(asked)),
                "_pairs": tk.padded(tk.adjacent_pairs(asked)),
                "_line": F.concat(F.lit(" "), tk.token_line(text), F.lit(" ")),
            }
        )

        def share(wanted: str) -> Column:
            found = F.size(F.filter(wanted, lambda w: F.contains(F.col("_line"), w)))
            return F.when(F.size(wanted) == 0, 0.0).otherwise(found / F.size(wanted))

        score = F.round((share("_terms") + share("_pairs")) / 2, SCORE_DIGITS)
        return rows.withColumn("score", score).drop("_terms", "_pairs", "_line")


@dataclass(frozen=True)
class FunctionReranker:
    """A caller's model. `load()` runs once per task and returns
    `(queries, texts) -> scores`."""

    columns_to_rerank: tuple[str, ...]
    load: Callable[[], Callable[[list[str], list[str]], np.ndarray]]
    batch_size: int = 64

    def score(self, candidates: DataFrame) -> DataFrame:
        load, step = self.load, self.batch_size

        @F.pandas_udf("double")
        def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            model = load()
            for asked, texts in batches:
                q, t = asked.fillna("").tolist(), texts.fillna("").tolist()
                out = [np.asarray(model(q[i : i + step], t[i : i + step]), dtype=float) for i in range(0, len(q), step)]
                yield pd.Series(np.concatenate(out) if out else np.zeros(0))

        text = F.concat_ws(" ", *[F.col(c) for c in self.columns_to_rerank])
        return candidates.withColumn("score", F.round(judge(F.col("query_text"), text), SCORE_DIGITS))


@dataclass(frozen=True)
class LateInteractionReranker:
    """Sum over the query's tokens of the best match among the passage's (Khattab & Zaharia 2020).

    `model.vectors(tokens)` gives unit rows; a caller's model takes the place of the built-in one. A task embeds each
    distinct token of some candidates once, and works them off in groups whose token matrices stay below `group_bytes`;
    a passage beyond that is taken in parts, of which the best match counts. No tokens on either side: 0.
    """

    columns_to_rerank: tuple[str, ...]
    model: HashedTokenModel = HashedTokenModel()
    group_bytes: int = 1 << 24

    def score(self, candidates: DataFrame) -> DataFrame:
        model = self.model
        most = max(1, self.group_bytes // (8 * model.dim))  # tokens of a group

        def tokens_of(lines: pa.Array) -> list[list[str]]:
            return [[t for t in (x or "").split(" ") if t] for x in lines.to_pylist()]

        def best(asked: np.ndarray, held: list[str]) -> float:
            top = np.full(len(asked), -np.inf)
            for a in range(0, len(held), most):
                top = np.maximum(top, (asked @ model.vectors(held[a : a + most]).T).max(axis=1))
            return float(top.sum())

        @F.arrow_udf("double")
        def interact(queries: pa.Array, passages: pa.Array) -> pa.Array:
            asked, held = tokens_of(queries), tokens_of(passages)
            out, at = np.zeros(len(asked)), 0
            while at < len(asked):
                end, known = at, {}
                while end < len(asked):
                    new = {t for t in (*asked[end], *held[end]) if t not in known}
                    if end > at and len(known) + len(new) > most:
                        break
                    known |= dict.fromkeys(new)
                    end += 1
                if len(known) > most:  # one passage alone
                    out[at] = best(model.vectors(asked[at]), list(dict.fromkeys(held[at]))) if asked[at] and held[at] else 0.0
                else:
                    number = {t: i for i, t in enumerate(known)}
                    table = model.vectors(list(known))
                    for i in range(at, end):
                        if asked[i] and held[i]:
                            q = table[[number[t] for t in asked[i]]]
                            d = table[[number[t] for t in dict.fromkeys(held[i])]]
                            out[i] = (q @ d.T).max(axis=1).sum()
                at = end
            return pa.array(out)

        text = F.concat_ws(" ", *[F.col(c) for c in self.columns_to_rerank])
        score = interact(tk.token_line(F.col("query_text")), tk.token_line(text))
        return candidates.withColumn("score", F.round(score, SCORE_DIGITS))


def rank_shift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rank of each hit in both lists; null where a list lacks it."""
    left = before.select("query_id", "key", F.col("rank").alias("rank_before"))
    right = after.select("query_id", "key", F.col("rank").alias("rank_after"))
    return left.join(right, ["query_id", "key"], "full_outer").withColumn(
        "shift", F.col("rank_before") - F.col("rank_after")
    )


def overlap_at_k(before: DataFrame, after: DataFrame, k: int) -> DataFrame:
    """Share of the k first hits that both lists hold, per query."""
    both = rank_shift(before, after)
    shared = F.sum(((F.col("rank_before") <= k) & (F.col("rank_after") <= k)).cast("int"))
    return both.groupBy("query_id").agg(F.round(F.coalesce(shared, F.lit(0)) / k, SCORE_DIGITS).alias("overlap"))


def precision(hits: DataFrame, relevant: DataFrame) -> DataFrame:
    """Relevant hits / all hits per query; `relevant(query_id, key)`, each pair once.

    The hits are written and counted, so that the judgements stay where they are
    when the hits are few.
    """
    stored, n = counted(hits.sparkSession, hits.select("query_id", "key"), "hits")
    good = relevant.select("query_id", "key").join(small_side(stored, n), ["query_id", "key"])
    found = stored.groupBy("query_id").agg(F.count("*").alias("n_hits"))
    right = good.groupBy("query_id").agg(F.count("*").alias("_n"))
    share = F.coalesce(F.col("_n"), F.lit(0)) / F.col("n_hits")
    return found.join(right, "query_id", "left").select(
        "query_id", "n_hits", F.round(share, SCORE_DIGITS).alias("precision")
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact list that an approximate search returned, per query."""
    got = found.select("query_id", "key", F.lit(1).alias("_f"))
    return (
        exact.join(got, ["query_id", "key"], "left")
        .groupBy("query_id")
        .agg(F.round(F.avg(F.coalesce(F.col("_f"), F.lit(0))), SCORE_DIGITS).alias("recall"))
    )
