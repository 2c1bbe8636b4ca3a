import pytest

from millrace.llm import ngram_join
from millrace.llm.components import components
from millrace.llm.queries import QUERIES
from tests.llm import brute


def found_rows(df):
    return {r[0]: (r[1], r[2]) for r in df.collect()}


def test_whole_table_matches_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = found_rows(QUERIES["op6_ngram_jaccard_join"](spark, sf_dir))
    assert found == brute.ngram_join(rows)
    assert any(i != c for i, (_, c) in found.items())


def family(members, length, base):
    """Near copies: each replaces one word of a common text, some two or many."""
    common = [f"w{k}" for k in range(length)]
    out = []
    for m in range(members):
        own = list(common)
        for k in range(1 + m % 3 * (m % 5)):
            own[(m * 7 + k * 11) % length] = f"own{m}_{k}"
        out.append((base + m, " ".join(own)))
    return out


@pytest.mark.parametrize(("chunk", "cell"), [(2_000, 7), (4 << 20, 512)])
def test_families_in_small_cells(spark, chunk, cell):
    rows = family(60, 80, 100) + family(25, 30, 500) + [(1, family(1, 80, 0)[0][1]), (2, "a b c d e f g h i j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.ngram_join(docs, cell=cell, chunk_bytes=chunk, bucket_bytes=chunk).select("id", "n_shingles", "component_id")
    assert found_rows(found) == brute.ngram_join(rows)


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "Ab cd"), (5, "aB  CD"), (6, "ab cd ef"), (7, "x" * 200_000), (8, "X" * 200_000),
        (9, "a a a a a a"), (10, "a a a a"), (11, "a b c d"), (12, "a b c d e"), (13, "É é"), (14, "é é"),
    ]
    docs = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, component_id string, size int")
    docs = docs.union(docs.where("doc_id in (4, 9)")).union(spark.createDataFrame([(None, "ab cd", "c", 0)], docs.schema))
    found = ngram_join.ngram_join(docs).select("id", "n_shingles", "component_id").collect()
    assert len(found) == len(rows) + 3
    assert [r.component_id for r in found if r.id is None] == [None]
    assert {r.id: (r.n_shingles, r.component_id) for r in found if r.id is not None} == brute.ngram_join(rows)


def test_empty_table(spark):
    assert ngram_join.ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 210)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (3, 2), (2, 3), (2, 3), (None, 1)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {**dict.fromkeys(range(10, 211), 10), **dict.fromkeys(range(1000, 1100), 1000), 2: 2, 3: 2}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n", range(1, 120))
def test_prefix_length_is_enough(n):
    """Two sets of n and m tokens that reach the threshold overlap in more than n - prefix tokens."""
    import numpy as np

    prefix = int(ngram_join.prefix_length(np.array([n]), 85)[0])
    least = min(-(-85 * (n + m) // 185) for m in range(-(-85 * n // 100), n * 100 // 85 + 1))
    assert n - prefix < least
