import pytest

from millrace.llm import substrings
from millrace.llm.queries import QUERIES
from tests.llm import brute


def digest_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = sorted(brute.substring_dedup(rows, 50), key=str)
    found = digest_rows(QUERIES["op1_substring_dedup"](spark, sf_dir))
    assert found == expected
    assert sum(r[2] for r in found) > 0


@pytest.mark.parametrize("chunk", [60, 4 << 20])
def test_edges(spark, chunk):
    long = "w" * 100_000
    a = "a b c d e f"
    rows = [
        (1, a), (2, f"x {a}\n y"), (3, None), (4, ""), (5, "a b"), (None, a), (None, None), (6, f"{a} {a}"), (6, f"{a} {a}"),
        (7, "b c d e f g\tb c d"), (9, long), (8, f"{long} {long} {long}"), (10, "é é é é"), (11, "é é é é"),
        (12, "same same same same same"),
    ]
    docs = spark.createDataFrame([(i, t, 1, "z", i) for i, t in rows], "doc_id long, text string, n_words int, chunk string, id long")
    found = substrings.substring_dedup(docs, window=3, carry=["n_words", "chunk", "id"], chunk_bytes=chunk, bucket_bytes=2 * chunk)
    assert {tuple(r.row) for r in found.collect()} == {(1, "z", i) for i, _ in rows}
    assert digest_rows(substrings.digest(found)) == sorted(brute.substring_dedup(rows, 3), key=str)
    spans = {r.id: (r.removed_from, r.removed_to) for r in found.collect()}
    assert spans[2] == ([1], [7]) and spans[7] == ([0, 6], [5, 9]) and spans[1] == ([], []) and spans[12] == ([], [])


def test_layout_is_kept_where_nothing_is_removed(spark):
    docs = spark.createDataFrame([(1, "a  b\nc"), (2, " a b c d")], "doc_id long, text string")
    found = {r.id: r.kept for r in substrings.substring_dedup(docs, window=3, keep_layout=True).collect()}
    assert found == {1: "a  b\nc", 2: "d"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.substring_dedup(docs).count() == 0


def test_documents_are_shuffled_once(spark, sf_dir):
    df = QUERIES["op1_substring_dedup"](spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
