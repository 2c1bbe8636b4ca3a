"""Chunks of documents: limits by bytes, rows without an id, numbers of chunks."""

from pyspark.sql import functions as F

from millrace.llm.exchange import chunked

TARGET = 200_000


def chunk_sizes(docs, **sizes):
    dealt, layout = chunked(docs, "doc_id", "text", chunk_bytes=TARGET, **sizes)
    rows = dealt.groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).orderBy("chunk").collect()
    assert sum(r.n for r in rows) == docs.count() and all(0 <= r.chunk < layout.chunks for r in rows)
    known = [r for r in rows if r.low is not None]
    assert all(a.high < b.low for a, b in zip(known, known[1:], strict=False)), "an earlier chunk holds smaller ids"
    return [r.bytes or 0 for r in rows], layout


def texts(spark, n, length):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 16), length).alias("text"))


def test_chunks_follow_the_bytes(spark):
    sizes, layout = chunk_sizes(texts(spark, 20_000, F.lit(15)))
    assert 24 <= layout.chunks <= 36 and max(sizes) <= 1.2 * TARGET
    twice, more = chunk_sizes(texts(spark, 40_000, F.lit(15)))
    assert 1.8 <= more.chunks / layout.chunks <= 2.2 and max(twice) <= 1.2 * TARGET


def test_long_texts_at_the_end_of_the_ids_do_not_pile_up(spark):
    """A few rows hold nearly all bytes: limits by rows would put them into one chunk."""
    long = texts(spark, 10_000, F.when(F.col("id") >= 9_800, 2_000).otherwise(1))
    sizes, _ = chunk_sizes(long)
    assert max(sizes) <= 2 * TARGET


def test_rows_without_an_id_are_dealt_over_all_chunks(spark):
    docs = texts(spark, 40_000, F.lit(10)).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    sizes, layout = chunk_sizes(docs)
    assert layout.chunks > 20 and max(sizes) <= 2 * TARGET
    none = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert sum(chunk_sizes(none)[0]) == 40_000 * 160


def test_one_id_and_no_rows(spark):
    docs = texts(spark, 5_000, F.lit(10))
    sizes, layout = chunk_sizes(docs.withColumn("doc_id", F.lit(7)))
    assert len(sizes) == 1
    empty, layout = chunk_sizes(docs.where("false"))
    assert empty == [] and layout.chunks == layout.buckets == 1
    assert len(chunk_sizes(docs.withColumn("text", F.lit(None).cast("string")))[0]) == 1
