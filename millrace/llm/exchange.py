"""Chunks of documents ask, buckets of hashes answer.

Counting every n-gram of a corpus as rows moves tens of bytes an occurrence. Here documents are
dealt into *chunks* of some megabytes. A chunk reduces its n-grams to sorted unique hashes and
sends each *bucket* (a range of hash values) one packed array; the bucket sees the arrays of all
chunks, and answers each with an array in the same order. A hash that occurs a billion times
arrives at its bucket once from each chunk, so no bucket grows with the copies of an n-gram.

Chunks are ranges of the document id, so an earlier chunk holds the smaller ids. The documents
are shuffled once: all steps on a chunk read the same exchange.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.shared import drop, stage

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20


@dataclass(frozen=True)
class Layout:
    chunks: int
    buckets: int


def byte_limits(sizes: DataFrame, parts: int, mean: float) -> list[float]:
    """Ids that cut rows of (``id``, ``bytes``) into about ``parts`` ranges of equal weight, ascending.

    A row weighs its bytes in units of the ``mean`` row, rounded up, so all rows weigh at most twice their
    number, and a range of 1 / ``parts`` of the weight at most twice its share of the bytes (a single
    id cannot be cut). Quantiles are taken in two steps, of all rows and then inside each of the ranges
    found, so neither a list of quantiles nor its aggregate grows beyond the root of ``parts``. The
    driver gets one number for each range.
    """
    outer = math.isqrt(parts - 1) + 1
    weight = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(max(1.0, mean)))).cast("int")
    rows = sizes.where("id IS NOT NULL").select(F.col("id").cast("double").alias("id"), F.explode(F.array_repeat(F.lit(0), weight)).alias("one"))

    def quantiles(n: int):
        return F.percentile_approx("id", [i / n for i in range(1, n)], max(10_000, 100 * n))

    first = sorted(set(rows.agg(quantiles(outer)).first()[0] or [])) if outer > 1 else []
    inner = -(-parts // outer)
    if inner < 2:
        return first
    ranged = ranges(rows, first, "range")
    return sorted({*first, *(x for r in ranged.groupBy("range").agg(quantiles(inner).alias("q")).collect() for x in r.q)})


def ranges(rows: DataFrame, limits: list[float], name: str) -> DataFrame:
    """``rows`` with the number of the range that the double ``id`` lies in; a limit begins its range."""
    if not limits:
        return rows.withColumn(name, F.lit(0))
    dealer = Bucketizer(splits=[-float("inf"), *limits, float("inf")], inputCol="id", outputCol="_range")
    return dealer.transform(rows).withColumn(name, F.col("_range").cast("int")).drop("_range")


def chunked(docs: DataFrame, key: str, text: str, carry: list[str] | None = None,
            chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, Layout]:
    """``chunk``, ``id``, ``text`` and the carried columns as struct ``row``, dealt by chunk.

    The number of chunks follows from all text bytes, their limits from quantiles of the ids weighted
    by bytes, so long texts do not pile up. Rows without an id are dealt over all chunks by their text.
    Rows that share one id stay in one chunk, and so do rows without an id that have the same text.
    """
    base = docs.select(
        F.col(key).cast("long").alias("id"),
        F.col(text).cast("string").alias("text"),
        F.struct(*[F.col(c) for c in carry]).alias("row") if carry else F.lit(None).cast("int").alias("row"),
    )
    sizes = stage(base.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")), "sizes")
    total, n = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    wanted = max(1, -(-total // chunk_bytes))
    limits = byte_limits(sizes, wanted, total / n) if wanted > 1 else []
    drop(sizes)
    layout = Layout(len(limits) + 1, max(1, -(-total // bucket_bytes)))
    anywhere = F.pmod(F.xxhash64("text"), F.lit(layout.chunks)).cast("int")
    numbered = ranges(base.withColumnsRenamed({"id": "_id"}).withColumn("id", F.coalesce(F.col("_id").cast("double"), F.lit(0.0))), limits, "chunk")
    dealt = numbered.select(F.when(F.col("_id").isNull(), anywhere).otherwise(F.col("chunk")).alias("chunk"), F.col("_id").alias("id"), "text", "row")
    return dealt.repartition(layout.chunks, "chunk"), layout


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes; small or repetitive values cost next to nothing."""
    values = np.ascontiguousarray(values)
    head = np.array([values.dtype.itemsize, len(values)], dtype=np.int64).tobytes()
    if not len(values):
        return head
    planes = values.view(np.uint8).reshape(len(values), -1).T.tobytes()
    return head + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    size, n = (int(x) for x in np.frombuffer(data[:16], dtype=np.int64))
    if not n:
        return np.zeros(0, dtype=dtype)
    planes = pa.Codec("zstd").decompress(data[16:], decompressed_size=size * n, asbytes=True)
    return np.frombuffer(planes, dtype=np.uint8).reshape(size, n).T.copy().view(dtype).reshape(n)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Limits of the buckets in sorted 64-bit keys; bucket b holds keys in [b, b+1) * 2**64 / buckets."""
    cuts = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, cuts, "left"), [len(keys)]]).astype(np.int64)


def first_of_runs(keys: np.ndarray) -> np.ndarray:
    """True at the first of each run of equal values in a sorted array."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


PACKET = T.StructType([
    T.StructField("bucket", T.IntegerType()),
    T.StructField("chunk", T.IntegerType()),
    T.StructField("keys", T.BinaryType()),
    T.StructField("more", T.ArrayType(T.BinaryType())),
])


def packets(chunk: int, keys: np.ndarray, buckets: int, more: list[np.ndarray] = ()) -> pa.Table:
    """One packet for each bucket, empty ones too, from sorted unique keys and aligned arrays."""
    edges = bucket_edges(keys, buckets)
    rows = [(edges[b], edges[b + 1]) for b in range(buckets)]
    return pa.table({
        "bucket": pa.array(range(buckets), pa.int32()),
        "chunk": pa.array([chunk] * buckets, pa.int32()),
        "keys": pa.array([pack_sorted(keys[a:b]) for a, b in rows], pa.binary()),
        "more": pa.array([[pack(m[a:b]) for m in more] for a, b in rows], pa.list_(pa.binary())),
    })


def answered(answers: pa.Table, kind: int | None = None) -> list[dict]:
    """The packets that came back to a chunk, in the order of its keys."""
    return sorted(answers.to_pylist(), key=lambda r: r["bucket"])
