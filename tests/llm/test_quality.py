import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality
from millrace.llm.queries import QUERIES
from tests.llm import brute


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op9_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = scored[scored.held_out].merge(labels, on="doc_id")
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() >= 0.95
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean() >= 0.97


def test_every_document_once_with_its_fold(spark, scored):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id").toPandas()
    assert sorted(scored.doc_id) == sorted(docs.doc_id)
    assert all(brute.held_out(i, 3) == h for i, h in zip(scored.doc_id, scored.held_out, strict=True))
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.5) == (scored.predicted == 1)).all()


def test_isotonic_is_the_best_rising_fit():
    x = np.arange(6.0)
    centres, levels = quality.isotonic(x, np.array([1, 0, 1, 1, 0, 1.0]), np.ones(6))
    assert np.allclose(np.interp(x, centres, levels)[[0, 5]], [0.5, 1.0])
    assert (np.diff(levels) > 0).all()
    assert np.allclose(levels, [0.5, 2 / 3, 1.0])


def test_features_approximate_the_gaussian_kernel():
    draw = np.random.default_rng(0)
    x = draw.standard_normal((40, 6))
    z = quality.Features(np.zeros(6), np.ones(6), 20_000, 0.05)(x)[:, :-1]
    kernel = np.exp(-0.05 * ((x[:, None] - x) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - kernel).max() < 0.06


def test_edges(spark):
    rows = [(i, ("word " * (i % 30)) + ("### ||| " * 20 if i % 3 == 0 else "fine text here. "), "en") for i in range(300)]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "x" * 300_000, "de"), (1003, "tie", "en"), (1003, "tie", "en"), (None, "tie", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = [(i, int(i % 3 != 0)) for i in range(300)] + [(5, None), (None, 1), (7, 1), (9_999, 1)]
    labels = spark.createDataFrame([(i, q, 0) for i, q in marks], "doc_id long, quality int, id int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.predicted == int(r.id % 3 != 0) for r in found if r.id is not None and r.id < 300) >= 290
    assert len({r.score for r in found if r.id in (1003, None)}) == 1
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.classify(docs.limit(9), labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.classify(docs.limit(9), labels.where("quality = 1")).collect()} == {1.0}


def test_kept_rows_are_unchanged(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.train(quality.measured(docs, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema
    assert kept.subtract(docs).count() == 0 and 0 < kept.count() < docs.count()


def test_memory_of_a_batch_follows_the_slice():
    """1,000 texts of 4 KB in one batch, measured as the workers of op9 and of the pipeline's first stage do."""
    text = pa.array([f"w{k} " + "some words of a plain text, " * 150 for k in range(1000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), text], names=["id", "text"])
    tracemalloc.start()
    rows = sum(part.num_rows for part in quality.measure([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 and peak < 100 << 20
