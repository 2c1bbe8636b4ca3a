"""Embedding near-dedup by iterative quantisation (ITQ) and multi-index Hamming tables.

1. Vectors of one label that are equal collapse to one with a weight.
2. ITQ learns rotations on a bounded sample (``SAMPLE`` vectors with the smallest hash of their
   id): centred principal axes, then alternating sign codes and orthogonal Procrustes steps.
   Rotations from several starts give codes of several times the dimension.
3. Codes are cut into substrings of ``bits`` bits; each substring is a Hamming table. Vectors of
   one label that agree on a whole substring meet in its bucket. ``bits`` follows from the
   largest label so that buckets of unrelated vectors hold about ``FILL``. Centring widens the
   angle of a pair if vectors share a direction, so the number of tables is fitted: sample
   vectors get partners at the threshold, and tables are added until at most ``MISS`` of these
   pairs meet in none. Of several shares of the mean the one with the least work is subtracted.
4. Buckets are dealt into cells of bounded size. A cell reranks its pairs by the cosine of the
   original vectors in double precision. A pair that meets in several tables counts in the
   first of them only, so links need no global distinct; pairs are never written as rows.

Edge cases: rows with a null label or vector, or with a null, infinite or NaN component, and
zero vectors, link with nothing; vectors of different lengths are not compared; of rows that
share an id, the one with the smallest label and vector is compared, and all are returned with
its result; an empty table gives an empty result; rows with a null id have no component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.cells import binned, cells
from millrace.llm.components import components
from millrace.llm.exchange import first_of_runs
from millrace.llm.shared import drop, stage

THRESHOLD = 0.93
SAMPLE = 20_000
ROUNDS = 40
MISS = 0.02
#: Sample vectors that get partners to fit the number of tables, and shares of the mean to try.
FITTED = 2_000
SHIFTS = (1.0, 0.75, 0.5, 0.25, 0.0)
FILL = 8
CELL = 256
PER_BIN = 8_192


def usable(vector: str) -> F.Column:
    """The vector can be compared: no null or non-finite component, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def train(vectors: np.ndarray, starts: int, rounds: int = ROUNDS, seed: int = 7, shift: float = 1.0,
          first: int = 0) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean (times ``shift``) and rotations: principal axes times an orthogonal matrix fitted to the sign codes."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    mean = shift * unit.mean(axis=0)
    centred = unit - mean
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1]
    turned = centred @ axes
    found = []
    for k in range(first, starts):
        start = np.random.default_rng([seed, k]).standard_normal((vectors.shape[1],) * 2)
        rotation = np.linalg.qr(start)[0]
        for _ in range(rounds):
            codes = np.where(turned @ rotation >= 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(codes.T @ turned)
            rotation = (u @ vt).T
        found.append(axes @ rotation)
    return mean, found


def tables_for(largest: int, threshold: float, miss: float = MISS, fill: int = FILL) -> tuple[int, int]:
    """Bits of a substring and number of tables."""
    bits = max(4, min(48, math.ceil(math.log2(max(1, largest) / fill)))) if largest > fill else 4
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Angles of the pairs of rows; a right one where a row is zero."""
    size = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
    return np.arccos(np.clip(np.einsum("ij,ij->i", x, y) / np.where(size > 0, size, 1.0), -1, 1))


def at_threshold(unit: np.ndarray, threshold: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and partners at the threshold, one half in random directions, one half towards other vectors."""
    draw = np.random.default_rng(seed)
    away = np.concatenate([draw.standard_normal(unit.shape), unit[draw.permutation(len(unit))]])
    x = np.concatenate([unit, unit])
    away -= np.einsum("ij,ij->i", away, x)[:, None] * x
    size = np.linalg.norm(away, axis=1)
    fine = size > 1e-6
    x, away = x[fine], away[fine] / size[fine, None]
    return x, threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * away


def fit(vectors: np.ndarray, bits: int, least: int, largest: int, threshold: float, miss: float = MISS) -> tuple[int, np.ndarray, list[np.ndarray]]:
    """Number of tables, mean and rotations, so that at most ``miss`` of the pairs at the threshold meet in no table."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    dim, centre = unit.shape[1], unit.mean(axis=0)
    x, y = at_threshold(unit[:FITTED], threshold)
    if not len(x):
        return least, *train(vectors, -(-least * bits // dim))
    other = np.roll(unit, 1, axis=0)

    def needed(shift: float) -> float:
        apart = 1 - (1 - angles(x - shift * centre, y - shift * centre) / math.pi) ** bits
        tables = least
        while (apart**tables).mean() > miss:
            tables += max(1, tables // 20)
            # Without a shift about ``least`` tables do, so one of the shifts always stays.
            if shift and tables > 64 * least:
                return math.inf
        return tables

    def work(shift: float) -> float:
        met = ((1 - angles(unit - shift * centre, other - shift * centre) / math.pi) ** bits).mean()
        return counts[shift] * (1 + largest * met)

    counts = {shift: needed(shift) for shift in SHIFTS}
    shift = SHIFTS[0]
    for k in SHIFTS[1:]:
        if work(k) < 0.9 * work(shift):
            shift = k
    if math.isinf(counts[shift]):
        shift = 0.0
    tables = counts[shift]
    mean, rotations = train(vectors, -(-tables * bits // dim), shift=shift)
    while True:
        same = np.concatenate([((x - mean) @ r >= 0) == ((y - mean) @ r >= 0) for r in rotations], axis=1)
        if 1 - same[:, : tables * bits].reshape(len(x), tables, bits).all(axis=2).any(axis=1).mean() <= miss:
            return tables, mean, rotations
        # Plain random rotations have the odds that the number was taken from.
        tables += max(1, tables // 10)
        rotations += train(vectors, -(-tables * bits // dim), rounds=0, shift=shift, first=len(rotations))[1]


def substrings(bits: int, tables: int, model: dict[int, tuple[np.ndarray, list[np.ndarray]]]):
    """Codes of all tables of each vector, as an array of longs."""

    def run(batches):
        weights = (1 << np.arange(bits, dtype=np.int64))
        for batch in batches:
            vectors = batch.column("vector")
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            start = np.cumsum(lengths) - lengths
            out = np.zeros((len(lengths), tables), dtype=np.int64)
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                x = flat[start[rows][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                mean, rotations = model.get(dim) or (np.zeros(dim), [np.linalg.qr(np.random.default_rng([dim, k]).standard_normal((dim, dim)))[0] for k in range(-(-tables * bits // dim))])
                signs = np.concatenate([(x - mean) @ r >= 0 for r in rotations], axis=1)[:, : tables * bits]
                out[rows] = signs.reshape(len(rows), tables, bits) @ weights
            codes = pa.ListArray.from_arrays(np.arange(0, out.size + 1, tables, dtype=np.int32), out.reshape(-1))
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=[*batch.schema.names, "codes"])

    return run


def rerank(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cell", "ascending"), ("id", "ascending")])
        column = lambda name: table.column(name).to_numpy()
        cell, sub, split, at, ids, weight = (column(c) for c in ("cell", "sub", "split", "at", "id", "weight"))
        vectors = table.column("vector").combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = np.zeros((len(lengths), int(lengths.max(initial=0))))
        x[np.arange(x.shape[1]) < lengths[:, None]] = flat
        codes = np.stack(table.column("codes").to_numpy()) if len(cell) else np.zeros((0, 1), np.int64)
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        label = column("label")
        left, right = [], []
        for step in range(1, len(cell)):
            p = np.flatnonzero(cell[:-step] == cell[step:])
            if not len(p):
                break
            q = p + step
            p, q = (v[~split[p] | (sub[p] != sub[q])] for v in (p, q))
            first = np.argmax(codes[p] == codes[q], axis=1) == at[p]
            p, q = (v[first & (label[p] == label[q]) & (lengths[p] == lengths[q])] for v in (p, q))
            near = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= threshold
            left.append(p[near]), right.append(q[near])
        p, q = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (left, right))
        names, inverse = np.unique(ids, return_inverse=True)
        count = np.zeros(len(names), dtype=np.int64)
        np.add.at(count, inverse[p], weight[q])
        np.add.at(count, inverse[q], weight[p])
        tree = np.arange(len(names))
        while True:
            low = np.minimum(tree[inverse[p]], tree[inverse[q]])
            new = tree.copy()
            np.minimum.at(new, inverse[p], low)
            np.minimum.at(new, inverse[q], low)
            new = new[new]
            if np.array_equal(new, tree):
                break
            tree = new
        some = np.flatnonzero(count)
        return pa.table({"id": names[some], "links": count[some], "root": names[tree[some]]})

    return run


def embedding_dedup(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """``id``, ``n_links`` (other vectors linked directly), ``component_id`` (smallest id
    reachable) and ``kept`` (the id is its component's), one row per row of ``rows``.
    """
    spark = rows.sparkSession
    given = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    valid = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("vector"))
    valid = valid.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("v")).select("id", "v.label", "v.vector")
    groups = valid.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    groups = stage(groups, "vectors")
    largest = groups.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(largest, threshold)
    model, least = {}, tables
    picked = groups.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow().column("vector").to_pylist()
    for dim in sorted({len(v) for v in picked}):
        own = np.array([v for v in picked if len(v) == dim], dtype=np.float64)
        own /= np.abs(own).max(axis=1, keepdims=True)
        if len(own) >= 2 * dim:
            needed, *model[dim] = fit(own, bits, least, largest, threshold)
            tables = max(tables, needed)
    for dim, (_, rotations) in model.items():
        # All lengths have the same number of tables; the further ones need not be learnt.
        own = np.random.default_rng([dim, 1])
        while len(rotations) * dim < tables * bits:
            rotations.append(np.linalg.qr(own.standard_normal((dim, dim)))[0])
    schema = f"{groups.select('id', 'label', 'vector', 'weight').schema.simpleString()[7:-1]},codes:array<bigint>"
    coded = groups.select("id", "label", "vector", "weight").mapInArrow(substrings(bits, tables, model), schema)
    coded = stage(coded, "codes")
    posts = coded.select("id", F.col("label"), F.size("vector").alias("dim"), F.posexplode("codes").alias("at", "code"))
    placed = stage(cells(posts, ["label", "dim", "at", "code"], "id", cell).select("id", "at", "sub", "split", "cell"), "cells")
    met = placed.join(coded.select("id", F.xxhash64("label").alias("label"), "vector", "weight", "codes"), "id")
    found = binned(met, PER_BIN, placed.count()).groupBy("bin").applyInArrow(rerank(threshold), "id long, links long, root long")
    found = stage(found, "links")
    drop(placed)
    drop(coded)
    direct = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    groups = groups.join(direct, "id", "left").join(linked.withColumnRenamed("node", "id"), "id", "left").select(
        "label", "vector", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component")
    )
    own = valid.join(groups, ["label", "vector"]).select("id", F.col("links").alias("n_links"), "component")
    out = given.select("id").join(own, "id", "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
