"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row: its terms are the positions of its non-zero components. Queries and
candidates are dealt into blocks, and every pair of blocks is one task-sized group. There, each
term's postings (candidates and weights) are scattered, times the weights of all queries of the
block, into a dense array of scores; a partition selects the best k of a block, and the blocks
of a query are merged. Every query meets every candidate, so the result is exact.

Scores are integers (long), and every finite vector takes part: rows with a component of
``2**30 / sqrt(length)`` or more after scaling are *wide*, and their scores are added up in Python's
integers, which have no limit. Only a score among the results that leaves the range of a long is an
error. Edge cases: vectors that are null or hold null or non-finite components take no part; an
empty vector scores 0 with all;
vectors of different lengths are compared as if padded by zeros; rows that share an id count as
one candidate with the best of their scores; rows with a null id take no part; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.exchange import first_of_runs
from millrace.llm.shared import stage

SCALE = 256
K = 5
QUERY_BLOCK = 1_024
CANDIDATE_BLOCK = 4_096


def finite_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` in double precision of all rows that take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))


class Block:
    """Rows of one side: the terms (components times ``scale`` rounded down) of ordinary rows as longs,
    of wide rows as Python integers.
    """

    def __init__(self, table: pa.Table, scale: int, ordered: bool = False):
        ids, vectors = table.column("id").to_numpy(), table.column("vector").combine_chunks()
        order = np.argsort(ids, kind="stable") if ordered else np.arange(len(ids))
        lengths = np.diff(vectors.offsets.to_numpy())
        values = np.zeros((len(lengths), int(lengths.max(initial=0))))
        values[np.arange(values.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
        self.ids, values = ids[order], values[order]
        # NaN-free: a product beyond the doubles is infinite, and such rows are wide.
        with np.errstate(over="ignore"):
            terms = np.floor(values * scale)
        limit = 2**30 / np.sqrt(np.maximum(lengths[order], 1))
        self.wide = np.abs(terms).max(axis=1, initial=0) >= limit
        self.terms = np.where(self.wide[:, None], 0, terms).astype(np.int64)
        self.large = {int(i): [_term(x, scale) for x in values[i].tolist()] for i in np.flatnonzero(self.wide)}

    def of(self, i: int) -> list[int]:
        return self.large[i] if i in self.large else self.terms[i].tolist()


def _term(x: float, scale: int) -> int:
    """Doubles of 2**53 and more are whole numbers, which may leave the range of doubles when scaled."""
    return math.floor(x * scale) if abs(x) < 2**53 else int(x) * scale


RANGE = 2**63 - 1


def held(score: int) -> tuple[int, bool]:
    """A score cut to the range of a long, and whether it was."""
    return (score, False) if -RANGE <= score <= RANGE else (RANGE if score > 0 else -RANGE, True)


def accumulate(q: Block, c: Block) -> np.ndarray:
    """Scores [candidate, query] of the ordinary rows, term by term."""
    scores = np.zeros((len(c.ids), len(q.ids)), dtype=np.int64)
    for term in range(min(q.terms.shape[1], c.terms.shape[1])):
        postings = np.flatnonzero(c.terms[:, term])
        asking = np.flatnonzero(q.terms[:, term])
        if len(asking) == len(q.ids):
            scores[postings] += c.terms[postings, term][:, None] * q.terms[:, term]
        else:
            scores[np.ix_(postings, asking)] += c.terms[postings, term][:, None] * q.terms[asking, term]
    return scores


def wide_scores(q: Block, c: Block, j: int) -> dict[int, int]:
    """Exact scores of query ``j`` with the candidates where one of both is wide."""
    own = q.of(j)
    some = range(len(c.ids)) if q.wide[j] else c.large
    return {i: sum(a * b for a, b in zip(own, c.of(i), strict=False)) for i in some}


FOUND = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64(), "beyond": pa.bool_()}


def best_of_block(k: int, scale: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({c: pa.array([], t) for c, t in FOUND.items()})
        q, c = Block(queries, scale), Block(candidates, scale, ordered=True)
        raw = accumulate(q, c)
        single = np.flatnonzero(first_of_runs(c.ids))
        ids, scores = c.ids[single], np.maximum.reduceat(raw, single, axis=0)
        out = []
        for j, own in enumerate(q.ids.tolist()):
            column, others = scores[:, j], ids != own
            if q.wide[j] or c.large:
                out.append(_best_exact(own, raw[:, j], c.ids, wide_scores(q, c, j), k))
                continue
            names, column = ids[others], column[others]
            if len(names) > k:
                floor = np.partition(column, len(names) - k)[len(names) - k]
                # Ids are sorted, so the first ties are those with the smallest ids.
                some = np.concatenate([np.flatnonzero(column > floor), np.flatnonzero(column == floor)[:k]])
            else:
                some = np.arange(len(names))
            out.append((np.full(len(some), own), names[some], column[some], np.zeros(len(some), dtype=bool)))
        return pa.table([pa.array(np.concatenate(x), t) for x, t in zip(zip(*out, strict=True), FOUND.values(), strict=True)], list(FOUND))

    return run


def _best_exact(own: int, column: np.ndarray, ids: np.ndarray, wide: dict[int, int], k: int) -> tuple:
    """The best of a query that meets wide rows, or is one: at most ``k`` ordinary ones and all wide ones compete."""
    plain = np.array([i for i in range(len(ids)) if i not in wide], dtype=np.int64)
    best = {}
    for i, score in [*zip(plain.tolist(), column[plain].tolist(), strict=True), *wide.items()]:
        name = int(ids[i])
        if name != own and (name not in best or score > best[name]):
            best[name] = score
    chosen = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    cut = [held(s) for _, s in chosen]
    return (
        np.full(len(chosen), own, dtype=np.int64), np.array([v for v, _ in chosen], dtype=np.int64),
        np.array([s for s, _ in cut], dtype=np.int64), np.array([b for _, b in cut], dtype=bool),
    )


def top_k(rows: DataFrame, is_query: F.Column, key: str = "vec_id", vector: str = "embedding", k: int = K,
          scale: int = SCALE, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the best ``k`` rows for every row with ``is_query``."""
    vectors = finite_vectors(rows, key, vector).dropDuplicates()
    queries = finite_vectors(rows.where(is_query), key, vector).dropDuplicates()
    vectors, queries = stage(vectors, "candidates"), stage(queries, "queries")
    n_c = max(1, -(-vectors.count() // candidate_block))
    n_q = max(1, -(-queries.count() // query_block))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    asked = queries.withColumn("q", own(n_q)).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    dealt = vectors.withColumn("c", own(n_c)).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    best = asked.groupBy("q", "c").cogroup(dealt.groupBy("q", "c")).applyInArrow(best_of_block(k, scale), "query_id long, vec_id long, score long, beyond boolean")
    best = best.groupBy("query_id", "vec_id").agg(F.max(F.struct("score", "beyond")).alias("best")).select("query_id", "vec_id", "best.*")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    score = F.when(F.col("beyond"), F.raise_error(F.lit("a score leaves the range of a long"))).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", "vec_id", score.cast("long").alias("score"))
