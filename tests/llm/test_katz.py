import math

import numpy as np
import pytest

from millrace.llm import katz
from millrace.llm.queries import QUERIES
from tests.llm import brute

TRAIN = "crc32(cast(id AS string)) % 5 <> 1"


def same(rows, expected):
    assert len(rows) == len(expected)
    for r in rows:
        held, n, known, total, base, score = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-7)


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op8_katz_lm"](spark, sf_dir).collect()
    same(rows, brute.katz(docs, katz.discounts))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("chunk", [40, 4 << 20])
def test_edges(spark, chunk):
    docs = [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 9))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "Only once here"), (103, "x" * 100_000), (104, "w1 w1 w1 unseen")]
    frame = spark.createDataFrame([(i, t, True, 0.0) for i, t in docs], "doc_id long, text string, train boolean, score double")
    found = katz.katz_scores(frame, TRAIN, chunk_bytes=chunk, bucket_bytes=chunk)
    rows = found.selectExpr("id AS doc_id", "not train AS held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    same(rows, brute.katz(docs, katz.discounts))


def test_null_ids_are_scored_but_not_trained_on(spark):
    frame = spark.createDataFrame([(None, "a b"), (0, "a"), (0, "a")], "doc_id long, text string")
    rows = katz.katz_scores(frame, TRAIN).orderBy("id").collect()
    assert [(r.id, r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [(None, 3, 2, 4), (0, 2, 2, 4), (0, 2, 2, 4)]


def test_nothing_to_train_on(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id long, text string")
    rows = katz.katz_scores(frame, "false").collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in rows] == [(0, 0, 0.0), (0, 0, 0.0)]
    assert katz.katz_scores(frame.limit(0), TRAIN).count() == 0


def test_discounts_of_counts_on_a_line():
    """n(r) = 3600 / r**2 is its own fit: factors are (r / (r + 1) - 1 / 6) / (5 / 6)."""
    found = katz.discounts(np.array([3600, 900, 400, 225, 144, 100]))
    assert np.allclose(found, [1, 0.4, 0.6, 0.7, 0.76, 0.8])


#: Words and pairs of the training documents of sf0.1.
@pytest.mark.parametrize("n", [[196853, 56582, 23638, 13634, 12848, 6779], [1480242, 227968, 47069, 19756, 17459, 7018]])
def test_discounts_of_uneven_counts_are_good_turing(n):
    b, a = np.polyfit(np.log(np.arange(1, 7)), np.log(n), 1)
    fit = [math.exp(a) * r**b for r in range(1, 7)]
    cut = 6 * fit[5] / fit[0]
    expected = [((r + 1) * fit[r] / (r * fit[r - 1]) - cut) / (1 - cut) for r in range(1, 6)]
    found = katz.discounts(np.array(n))
    assert np.allclose(found[1:], expected)
    assert (np.diff(found[1:]) > 0).all() and 0 < found[1] and found[5] < 1


def test_discounts_of_odd_counts():
    # Gaps and counts that do not fall still have factors between 0 and 1.
    for n in ([10, 4, 0, 0, 1, 0], [5, 5, 5, 5, 5, 5], [1, 9, 9, 9, 9, 9], [7, 1, 0, 0, 0, 0]):
        found = katz.discounts(np.array(n))[1:]
        assert (np.diff(found) > 0).all() and 0 < found[0] and found[4] < 1
    assert katz.discounts(np.array([3, 0, 2, 0, 0, 0]))[1:].tolist() == [1 - 0.5 / r for r in range(1, 6)]
    assert katz.discounts(np.array([0, 3, 0, 0, 0, 0])).tolist() == [1.0] * 6


def hot_chunk(split):
    """A chunk in which 2,000 words follow one; with the answers to its words."""
    import pyarrow as pa

    text = " ".join(f"the w{k}" for k in range(2_000))
    table = pa.table({"chunk": pa.array([0], pa.int32()), "id": [1], "text": [text], "train": [True]})
    chunk = katz.ChunkTokens(table, split)
    chunk.hear_words(pa.concat_tables([katz.answer_words(chunk.word_packets(1))]))
    return chunk


def test_pairs_of_a_hot_context_are_dealt_over_buckets():
    def largest(split):
        packets = hot_chunk(split).pair_packets(64).to_pylist()
        return max(int(katz.unpack(r["more"][0], np.uint32).sum()) for r in packets)

    assert largest(1 << 20) >= 2_000
    assert largest(50) < 400


@pytest.mark.parametrize("chunk", [200, 4 << 20])
def test_split_contexts_match_brute_force(spark, chunk):
    docs = [(i, " ".join(f"the w{(i * k) % 37} w{k % 5}" for k in range(20 + i % 9))) for i in range(60)]
    docs += [(100, "the new the w1 w1"), (101, ""), (102, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = katz.katz_scores(frame, TRAIN, chunk_bytes=chunk, bucket_bytes=chunk, split=10)
    rows = found.selectExpr("id AS doc_id", "not train AS held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    same(rows, brute.katz(docs, katz.discounts))
