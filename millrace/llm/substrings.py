"""Substring dedup: windows of words that also start in an earlier document are cut out.

Method: Rabin-Karp hashes of every window of ``window`` words, counted in Spark
(:mod:`millrace.llm.exchange`); the words under repeated windows merge into maximal intervals.

A hash has 64 bits with 16 check bits beside it. With W windows about W**2 / 2**81 pairs of
different windows share both: far below one for terabytes of text.

Edge cases: a null or empty text has no words; texts shorter than a window lose nothing; rows
with a null id are passed on whole and repeat nothing; rows that share an id (repeated rows)
do not count as earlier than each other; an empty table gives an empty result. Other columns
of the input may have any name: they travel in one struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.exchange import PACKET, answered, bucket_edges, chunked, first_of_runs, pack, packets, unpack, unpack_sorted
from millrace.llm.words import Words, mix, window_sums, windows_inside

WINDOW = 50
CHECK = np.uint64(0xA24BAED4963EE407)


class ChunkWindows:
    """Windows of one chunk of documents, in the order of their ids."""

    def __init__(self, table: pa.Table, window: int):
        self.table = table.sort_by("id")
        ids = self.table.column("id")
        self.known = np.array(ids.is_valid())
        values = ids.fill_null(0).to_numpy()
        self.rank = np.unique(values, return_inverse=True)[1] if len(values) else np.zeros(0, np.int64)
        self.words = Words(self.table.column("text"))
        hashes = self.words.hashes()
        self.at, self.text = windows_inside(self.words.first, np.where(self.known, self.words.count, 0), window)
        sums = window_sums(hashes, window)[self.at]
        order = np.argsort(sums, kind="stable")
        first = first_of_runs(sums[order])
        self.keys = sums[order][first]
        self.entry = np.empty(len(sums), dtype=np.int64)
        self.entry[order] = np.cumsum(first) - 1
        # The sort is stable and windows come in document order: the first of a run has the smallest id.
        self.first_rank = self.rank[self.text[order][first]]
        self._first_at = self.at[order][first]
        self._hashes = hashes

    def checks(self, window: int) -> np.ndarray:
        other = window_sums(mix(self._hashes ^ CHECK), window)
        return (other[self._first_at] >> np.uint64(48)).astype(np.uint16)


def ask(window: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = ChunkWindows(table, window)
        return packets(table.column("chunk")[0].as_py(), chunk.keys, buckets, [chunk.checks(window)])

    return run


def answer(table: pa.Table) -> pa.Table:
    """For each packet one bit per key: does a chunk with smaller ids hold the window too?"""
    rows = table.sort_by("chunk")
    keys = [unpack_sorted(k) for k in rows.column("keys").to_pylist()]
    checks = np.concatenate([unpack(m[0], np.uint16) for m in rows.column("more").to_pylist()])
    sizes = [len(k) for k in keys]
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if np.any(same & (checks[order][1:] != checks[order][:-1])):
        order = np.lexsort((checks, keys))  # stable, too
    later = ~(first_of_runs(keys[order]) | first_of_runs(checks[order]))
    bits = np.zeros(len(keys), dtype=bool)
    bits[order] = later
    parts = np.split(bits, np.cumsum(sizes)[:-1])
    return pa.table({
        "bucket": rows.column("bucket"), "chunk": rows.column("chunk"),
        "keys": pa.array([b""] * len(sizes), pa.binary()),
        "more": pa.array([[pack(np.packbits(p))] for p in parts], pa.list_(pa.binary())),
    })


def removed_words(chunk: ChunkWindows, answers: pa.Table, window: int, buckets: int) -> np.ndarray:
    sizes = np.diff(bucket_edges(chunk.keys, buckets))
    bits = [np.unpackbits(unpack(r["more"][0], np.uint8), count=int(sizes[r["bucket"]])) for r in answered(answers)]
    earlier = np.concatenate(bits).astype(bool) if bits else np.zeros(0, dtype=bool)
    if len(earlier) != len(chunk.keys):
        raise RuntimeError("the answers do not fit the windows of this chunk")
    hit = earlier[chunk.entry] | (chunk.rank[chunk.text] > chunk.first_rank[chunk.entry])
    change = np.zeros(len(chunk.words.start) + 1, dtype=np.int32)
    np.add.at(change, chunk.at[hit], 1)
    np.add.at(change, chunk.at[hit] + window, -1)
    return np.cumsum(change[:-1]) > 0


def cut(window: int, buckets: int, keep_layout: bool):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = ChunkWindows(table, window)
        gone = removed_words(chunk, answers, window, buckets)
        words = chunk.words
        begins, ends, kept = [], [], []
        data, offsets = words.data.tobytes(), words.offsets.tolist()
        lost = np.add.reduceat(np.append(gone, False), words.first[:-1]) * (words.count > 0) if len(words.count) else np.zeros(0, int)
        for i in range(len(words.count)):
            own = data[offsets[i] : offsets[i + 1]]
            if not lost[i] and keep_layout:
                begins.append([]), ends.append([]), kept.append(own)
                continue
            own = own.split()
            if not lost[i]:
                begins.append([]), ends.append([])
            else:
                mask = gone[words.first[i] : words.first[i + 1]]
                edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
                begins.append(edge[0::2].tolist()), ends.append(edge[1::2].tolist())
                own = [own[k] for k in np.flatnonzero(~mask).tolist()]
            kept.append(b" ".join(own))
        out = chunk.table
        return pa.table({
            "id": out.column("id"),
            "n_words": pa.array(words.count, pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "removed_from": pa.array(begins, pa.list_(pa.int32())),
            "removed_to": pa.array(ends, pa.list_(pa.int32())),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "row": out.column("row"),
        })

    return run


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                    carry: list[str] | None = None, keep_layout: bool = False, **sizes) -> DataFrame:
    """One row per document: ``id``, ``n_words``, ``n_removed``, the removed word intervals
    ``[removed_from, removed_to)``, the ``kept`` words joined by one space, and ``row``, a struct
    of the columns named in ``carry``. With ``keep_layout``, texts that lose nothing are returned
    as they were.
    """
    dealt, layout = chunked(docs, key, text, carry, **sizes)
    asked = dealt.groupBy("chunk").applyInArrow(ask(window, layout.buckets), PACKET)
    answers = asked.repartition(layout.buckets, "bucket").groupBy("bucket").applyInArrow(answer, PACKET)
    row = dealt.schema["row"].dataType.simpleString()
    schema = f"id long, n_words long, n_removed long, removed_from array<int>, removed_to array<int>, kept string, row {row}"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cut(window, layout.buckets, keep_layout), schema)


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
