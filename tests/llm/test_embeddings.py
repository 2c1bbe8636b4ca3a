import math

import numpy as np
import pytest

from millrace.llm import embeddings_itq as itq
from millrace.llm.queries import QUERIES
from tests.llm import brute


def found_rows(df):
    return {r[0]: (r[1], r[2]) for r in df.collect()}


def clustered(seed, clusters, members, dim=16, spread=0.06):
    draw = np.random.default_rng(seed)
    out = []
    for c in range(clusters):
        centre = draw.standard_normal(dim)
        for _ in range(members):
            out.append((len(out), [float(np.float32(x)) for x in centre + spread * draw.standard_normal(dim) * (1 + len(out) % 3)], c % 2))
    return out


@pytest.mark.parametrize("cell", [5, 256])
def test_recall_and_no_false_links(spark, cell):
    rows = clustered(1, 30, 8) + [(1000 + i, [1.0] * 16, 3) for i in range(30)] + [(2000 + i, [1.0 + i / 100] * 16, 3) for i in range(3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = found_rows(itq.embedding_dedup(frame, cell=cell))
    expected = brute.near_vectors(rows)
    assert all(found[i][0] <= expected[i][0] for i in expected)
    assert sum(n for n, _ in found.values()) >= 0.95 * sum(n for n, _ in expected.values())
    # Copies, and vectors that differ in length only, are never missed.
    assert all(found[i] == expected[i] for i in expected if i >= 1000)


def test_edges(spark):
    rows = [
        (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, [1.0, 2.0], None), (4, None, 1), (5, [1.0, None], 1), (6, [math.nan, 1.0], 1),
        (7, [math.inf, 1.0], 1), (8, [0.0, 0.0], 1), (9, [1.0, 2.0, 0.0], 1), (10, [], 1), (11, [1.0, 2.0], 2), (12, [2.0, 4.0], 1),
        (13, [-0.0, 3.0], 1), (14, [0.0, 3.0], 1), (15, [-1.0, -2.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, id string, n_links int")
    frame = frame.union(frame.where("vec_id = 1")).union(spark.createDataFrame([(None, [1.0, 2.0], 1, "x", 1)], frame.schema))
    found = itq.embedding_dedup(frame).collect()
    assert len(found) == len(rows) + 2
    assert [(r.n_links, r.component_id, r.kept) for r in found if r.id is None] == [(0, None, False)]
    assert {r.id: (r.n_links, r.component_id) for r in found if r.id is not None} == brute.near_vectors(rows)
    assert all(r.kept == (r.id == r.component_id) for r in found if r.id is not None)
    assert itq.embedding_dedup(frame.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found_rows(QUERIES["op10_embedding_near_dedup"](spark, sf_dir)) == brute.near_vectors(rows)


def test_rotations_are_orthogonal_and_codes_balanced():
    x = np.random.default_rng(0).standard_normal((2_000, 12)) * np.linspace(1, 3, 12)
    mean, rotations = itq.train(x, 2)
    for r in rotations:
        assert np.allclose(r.T @ r, np.eye(12))
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        assert np.abs(((unit - mean) @ r >= 0).mean(axis=0) - 0.5).max() < 0.1


def with_common_direction(seed, pairs, mean_cosine, dim=64, threshold=0.931):
    """Unit vectors that share a direction, each with a partner a little above the threshold."""
    draw = np.random.default_rng(seed)
    normed = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = normed(draw.standard_normal((pairs, dim)) / math.sqrt(dim) * math.sqrt(1 / mean_cosine - 1) + np.eye(dim)[0])
    away = draw.standard_normal(x.shape)
    away = normed(away - np.einsum("ij,ij->i", away, x)[:, None] * x)
    return x, threshold * x + math.sqrt(1 - threshold**2) * away


@pytest.mark.parametrize("mean_cosine", [0.49, 0.64])
def test_recall_with_a_common_direction(spark, mean_cosine):
    x, y = with_common_direction(3, 1_500, mean_cosine)
    rows = [(2 * i + k, v[i].tolist(), 1) for i in range(len(x)) for k, v in enumerate((x, y))]
    found = found_rows(itq.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")))
    assert np.mean([found[2 * i + 1][1] == found[2 * i][1] for i in range(len(x))]) >= 0.95


@pytest.mark.parametrize("largest", [10_000, 1_000_000])
def test_tables_are_enough_for_large_labels(largest):
    x, _ = with_common_direction(4, 4_000, 0.64)
    bits, least = itq.tables_for(largest, 0.93)
    tables, mean, rotations = itq.fit(x, bits, least, largest, 0.93)
    a, b = with_common_direction(5, 2_000, 0.64)
    signs = [np.concatenate([(v - mean) @ r >= 0 for r in rotations], axis=1)[:, : tables * bits].reshape(-1, tables, bits) for v in (a, b)]
    assert (signs[0] == signs[1]).all(axis=2).any(axis=1).mean() >= 0.95
