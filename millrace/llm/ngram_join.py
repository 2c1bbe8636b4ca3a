"""N-gram Jaccard self-join of documents, with prefix filters under several token orders.

Tokens are the distinct 4-word shingles of a document. A pair that reaches the threshold t
shares a token in its prefixes, the first ``n - ceil(t n) + 1`` tokens of either set, under
*every* global order of tokens. Three orders are used: all put rare tokens first, and break the
many ties of document frequency differently. A pair is verified only if all three agree.

1. Chunks ask buckets (:mod:`millrace.llm.exchange`) for the document frequency of their
   shingles, and for the smallest id of every exact word sequence. Copies collapse to that one.
2. A document whose prefix has only tokens of its own has no partner. The others post the tokens
   of their first prefix; documents that share one form *families* (connected components).
3. Families are dealt into cells of bounded size; a cell verifies its pairs by the exact sizes
   of intersection and union, and returns a spanning forest of the links, not all pairs.
4. Components of the links give the result.

Frequencies and intersections are computed on 48-bit hashes of shingles: a pair of documents is
misjudged with a chance of about n**2 / 2**48 for sets of n. ``n_shingles`` counts 64-bit hashes.

Edge cases: null and empty texts have no shingles and link with nothing; one to three words form
one shingle; rows with a null id are returned without a component; rows that share an id are one
node; an empty table gives an empty result. Other columns may have any name, they are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.cells import binned, cells
from millrace.llm.components import components
from millrace.llm.exchange import PACKET, answered, bucket_edges, chunked, first_of_runs, pack, packets, pack_sorted, unpack, unpack_sorted
from millrace.llm.shared import drop, stage
from millrace.llm.words import Words, mix, window_sums, windows_inside
from millrace.operators.joins import join_groups

SHINGLE = 4
THRESHOLD = 85
CELL = 512
PER_BIN = 1024
LOW_BITS = np.uint64(0xFFFF)
SEQUENCE = np.uint64(0x8CB92BA72F3D8DD7)
#: What breaks ties of frequency in each order.
ORDERS = [np.uint64(x) for x in (0, 0x632BE59BD9B4E019, 0xE220A8397B1DCDAF)]


class ChunkShingles:
    """Distinct shingles of the documents of a chunk, sorted by document and hash."""

    def __init__(self, table: pa.Table, size: int):
        self.ids = table.column("id").fill_null(0).to_numpy()
        self.known = np.array(table.column("id").is_valid())
        words = Words(table.column("text"), lower=True)
        self.n_words, hashes = words.count, words.hashes()
        at, text = windows_inside(words.first, words.count, size)
        parts = [window_sums(hashes, size)[at]]
        texts = [text]
        for short in range(1, size):
            some = np.flatnonzero(words.count == short)
            sums = window_sums(hashes, short)
            parts.append(mix(sums[words.first[some]] + np.uint64(short)) if len(some) else sums[:0])
            texts.append(some)
        keys, text = np.concatenate(parts), np.concatenate(texts)
        order = np.lexsort((keys, text))
        keys, text = keys[order], text[order]
        once = first_of_runs(keys) | first_of_runs(text)
        keys, text = keys[once], text[once]
        self.n_shingles = np.bincount(text, minlength=len(self.ids))
        # From here on 48 bits.
        keys = keys & ~LOW_BITS
        once = first_of_runs(keys) | first_of_runs(text)
        self.keys, self.text = keys[once], text[once]
        self.size = np.bincount(self.text, minlength=len(self.ids))
        order = np.argsort(self.keys, kind="stable")
        first = first_of_runs(self.keys[order])
        self.unique = self.keys[order][first]
        self.entry = np.empty(len(order), dtype=np.int64)
        self.entry[order] = np.cumsum(first) - 1
        self._sequences(words, hashes)

    def counts(self) -> np.ndarray:
        """Documents of this chunk with each unique shingle; those without an id do not count."""
        return np.bincount(self.entry[self.known[self.text]], minlength=len(self.unique)).astype(np.uint32)

    def _sequences(self, words: Words, hashes: np.ndarray) -> None:
        """A 128-bit hash of each document's words, and the documents in its order."""

        def whole(values: np.ndarray) -> np.ndarray:
            rank = np.arange(len(values)) - np.repeat(words.first[:-1], words.count)
            spread = mix(values + mix(rank.astype(np.uint64)))
            sums = np.zeros(len(values) + 1, dtype=np.uint64)
            np.cumsum(spread, out=sums[1:])
            return mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.count.astype(np.uint64))

        one, two = whole(hashes), whole(mix(hashes ^ SEQUENCE))
        self.with_words = np.flatnonzero((words.count > 0) & self.known)
        order = np.lexsort((self.ids[self.with_words], two[self.with_words], one[self.with_words]))
        self.with_words = self.with_words[order]
        self.one, self.two = one[self.with_words], two[self.with_words]


def ask(size: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = ChunkShingles(table, size)
        out = packets(table.column("chunk")[0].as_py(), chunk.unique, buckets, [chunk.counts()])
        edges = bucket_edges(chunk.one, buckets)
        more = [
            [counts, pack_sorted(chunk.one[a:b]), pack(chunk.two[a:b]), pack(chunk.ids[chunk.with_words[a:b]])]
            for (counts,), a, b in zip(out.column("more").to_pylist(), edges[:-1], edges[1:], strict=True)
        ]
        return out.set_column(3, "more", pa.array(more, pa.list_(pa.binary())))

    return run


def answer(table: pa.Table) -> pa.Table:
    """Per packet: document frequencies (65,535 at most), and smallest ids of equal sequences."""
    rows = table.sort_by("chunk")
    more = rows.column("more").to_pylist()

    def split(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
        return np.split(values, np.cumsum(sizes)[:-1])

    keys = [unpack_sorted(k) for k in rows.column("keys").to_pylist()]
    sizes, keys = [len(k) for k in keys], np.concatenate(keys)
    counts = np.concatenate([unpack(m[0], np.uint32) for m in more]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    run = np.cumsum(first_of_runs(keys[order])) - 1
    total = np.bincount(run, weights=counts[order]).astype(np.int64) if len(run) else run
    df = np.empty(len(keys), dtype=np.uint16)
    df[order] = np.minimum(total, 0xFFFF)[run]

    one = [unpack_sorted(m[1]) for m in more]
    docs, one = [len(k) for k in one], np.concatenate(one)
    two = np.concatenate([unpack(m[2], np.uint64) for m in more])
    ids = np.concatenate([unpack(m[3], np.int64) for m in more])
    order = np.lexsort((ids, two, one))
    first = first_of_runs(one[order]) | first_of_runs(two[order])
    smallest = np.empty(len(ids), dtype=np.int64)
    smallest[order] = ids[order][first][np.cumsum(first) - 1]
    answers = [[pack(a), pack(b)] for a, b in zip(split(df, sizes), split(smallest, docs), strict=True)]
    return pa.table({
        "bucket": rows.column("bucket"), "chunk": rows.column("chunk"),
        "keys": pa.array([b""] * len(answers), pa.binary()), "more": pa.array(answers, pa.list_(pa.binary())),
    })


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-(percent * n) // 100) + 1


def describe(size: int, percent: int):
    """One row per document; those that may have partners carry their shared tokens and posts."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = ChunkShingles(table, size)
        got = answered(answers)
        df = np.concatenate([unpack(r["more"][0], np.uint16) for r in got])
        smallest = np.concatenate([unpack(r["more"][1], np.int64) for r in got])
        if len(df) != len(chunk.unique) or len(smallest) != len(chunk.with_words):
            raise RuntimeError("the answers do not fit the shingles of this chunk")
        n = len(chunk.ids)
        copy_of = chunk.ids.copy()
        copy_of[chunk.with_words] = smallest
        df = df[chunk.entry]
        shared = df > 1
        alone = np.bincount(chunk.text[~shared], minlength=n)
        open_ = prefix_length(chunk.size, percent) - alone
        asks = chunk.known & (copy_of == chunk.ids) & (chunk.size > 0) & (open_ > 0)
        take = shared & asks[chunk.text]
        text, keys, df = chunk.text[take], chunk.keys[take], df[take]
        ends = np.searchsorted(text, np.arange(n + 1))
        posts = posted(keys, df, text, open_, ORDERS[0])
        tokens, freqs, posted_keys = [None] * n, [None] * n, [None] * n
        for i in np.flatnonzero(asks).tolist():
            a, b = ends[i], ends[i + 1]
            if b > a:
                tokens[i], freqs[i] = pack_sorted(keys[a:b]), pack(df[a:b])
                posted_keys[i] = keys[a:b][posts[a:b]].view(np.int64)
        return pa.table({
            "id": table.column("id"),
            "n_shingles": pa.array(chunk.n_shingles, pa.int64()),
            "copy_of": pa.array(copy_of, pa.int64(), mask=~chunk.known),
            "size": pa.array(chunk.size, pa.int64()),
            "open": pa.array(open_, pa.int64()),
            "tokens": pa.array(tokens, pa.binary()),
            "freqs": pa.array(freqs, pa.binary()),
            "posts": pa.array(posted_keys, pa.list_(pa.int64())),
        })

    return run


def posted(keys: np.ndarray, df: np.ndarray, text: np.ndarray, open_: np.ndarray, tie: np.uint64) -> np.ndarray:
    """Which shared tokens lie in the prefix of their text under one order (text is sorted)."""
    order = np.lexsort((mix(keys ^ tie), df, text))
    start = np.searchsorted(text, np.arange(len(open_)))
    rank = np.arange(len(keys)) - start[text]
    out = np.zeros(len(keys), dtype=bool)
    out[order] = rank < open_[text]
    return out


def verified(rows: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one cell: a spanning forest of the pairs that reach the threshold."""
    m = rows.num_rows
    ids = rows.column("id").to_numpy()
    size, open_ = rows.column("size").to_numpy(), rows.column("open").to_numpy()
    sub = rows.column("sub").to_numpy() if rows.column("split")[0].as_py() else np.arange(m)
    tokens = [unpack_sorted(t) for t in rows.column("tokens").to_pylist()]
    df = np.concatenate([unpack(t, np.uint16) for t in rows.column("freqs").to_pylist()])
    text = np.repeat(np.arange(m), [len(t) for t in tokens])
    flat = np.concatenate(tokens)
    names = np.unique(flat, return_inverse=True)[1]
    indexes = []
    for tie in ORDERS:
        inside = posted(flat, df, text, open_, tie)
        indexes.append(Postings(names[inside], text[inside], m))
    full = Postings(names, text, m)
    label = np.arange(m)
    left, right = [], []
    fits = lambda x, y: 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
    for x in range(1, m):
        y = np.arange(x)
        y = y[(label[:x] != label[x]) & (sub[:x] != sub[x]) & fits(x, y)]
        for index in indexes:
            if len(y):
                y = y[index.shared_with(x)[y] > 0]
        if not len(y):
            continue
        common = full.shared_with(x)[y]
        for z in y[100 * common >= percent * (size[x] + size[y] - common)].tolist():
            if label[z] != label[x]:
                left.append(ids[x]), right.append(ids[z])
                label[label == label[z]] = label[x]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


class Postings:
    """Texts by token and tokens by text, to count the tokens that one text shares with each."""

    def __init__(self, names: np.ndarray, text: np.ndarray, m: int):
        self.m, self.names = m, names
        self.of_text = np.searchsorted(text, np.arange(m + 1))
        order = np.argsort(names, kind="stable")
        self.texts = text[order]
        top = int(names.max()) + 1 if len(names) else 0
        self.of_name = np.searchsorted(names[order], np.arange(top + 1))

    def shared_with(self, x: int) -> np.ndarray:
        own = self.names[self.of_text[x] : self.of_text[x + 1]]
        start, count = self.of_name[own], self.of_name[own + 1] - self.of_name[own]
        at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.bincount(self.texts[at], minlength=self.m)


def verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cell", "ascending"), ("id", "ascending")])
        cell = table.column("cell").to_numpy()
        starts = np.flatnonzero(first_of_runs(cell)) if len(cell) else []
        found = [verified(table.slice(a, b - a), percent) for a, b in zip(starts, [*starts[1:], len(cell)], strict=True) if b - a > 1]
        a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
               percent: int = THRESHOLD, cell: int = CELL, **sizes) -> DataFrame:
    """``id``, ``n_shingles``, ``copy_of`` (smallest id with the same words) and ``component_id``
    (smallest id reachable by links of Jaccard similarity ``percent`` / 100 or more).
    """
    dealt, layout = chunked(docs, key, text, **sizes)
    asked = dealt.groupBy("chunk").applyInArrow(ask(size, layout.buckets), PACKET)
    answers = asked.repartition(layout.buckets, "bucket").groupBy("bucket").applyInArrow(answer, PACKET)
    schema = "id long, n_shingles long, copy_of long, size long, open long, tokens binary, freqs binary, posts array<long>"
    described = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(describe(size, percent), schema)
    described = stage(described, "described")

    posts = described.where("posts is not null").select("id", F.explode("posts").alias("token"))
    heads = posts.groupBy("token").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1")
    same = join_groups(posts, heads, ["token"], "inner").where("id != head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    families = components(same.distinct()).select(F.col("node").alias("id"), F.col("component").alias("family"))
    placed = stage(cells(families, ["family"], "id", cell).select("id", "sub", "split", "cell"), "cells")
    payload = described.where("tokens is not null").select("id", "size", "open", "tokens", "freqs")
    found = binned(placed.join(payload, "id"), PER_BIN, placed.count()).groupBy("bin").applyInArrow(verify(percent), "a long, b long")
    linked = components(found)
    drop(placed)
    nodes = linked.select(F.col("node").alias("copy_of"), F.col("component").alias("component_id"))
    return described.select("id", "n_shingles", "copy_of").join(nodes, "copy_of", "left").select(
        "id", "n_shingles", "copy_of", F.coalesce("component_id", "copy_of").alias("component_id")
    )
