"""Spelling variant grouping: words of a corpus that differ by one code point, found by probing edits.

Words are maximal runs of letters, counted over all documents; the vocabulary holds those that are
long and frequent enough. Two words are near if one inserted, deleted or replaced code point turns
one into the other. A word's *form* is its near word of largest count, if that is ``RATIO`` times its
own count; following forms to the last gives its *root*.

Bloom-guided neighbourhoods: the vocabulary is put into blocked Bloom filters, one or more *pieces*
for each word length. Each word's deletions and replacements are generated as hashes only (a
polynomial hash of an edit follows from prefix sums by one product) and looked up in the filter of
their length. What the filter lets pass is written out as text and joined with the vocabulary, which
removes the false positives and brings the counts. An insertion is a deletion seen from the longer
word, and a replacement is generated from its smaller side only, so every pair arises once.

Filters are broadcast in rounds of at most ``ROUND_BYTES``: a vocabulary of any size is probed, in as
many rounds as it needs, and a round reads only the words whose edits can have its lengths. Nothing
else goes through the driver but counts by length. Documents are counted where they are; tasks send
partial counts and never hold more than ``HOLD`` bytes of words. A word has a bounded number of near
words unless it is very long, so no group of the join grows with the corpus.

The corpus is made with misspellings: a run whose crc32 with its document id is divisible by
``EVERY`` loses one code point before it is counted (see :class:`Misspell`).

Edge cases: null texts have no words; a null id counts as an empty one; repeated rows count as often
as they occur; runs of any length are words; counts that tie are ordered by code points; an empty
table, or one without frequent words, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import drop, stage
from millrace.llm.words import WORD_BASE, lower_table, mix, powers
from millrace.operators.joins import join_groups

#: a-z and U+00C0 to U+00FF as UTF-8.
RUN = re.compile(rb"(?:[a-z]++|(?:\xc3[\x80-\xbf])++)++")
LOWER = lower_table().tobytes()
RATIO = 2
#: Longest length with filters of its own; longer words share one.
LENGTHS = 64
HOLD = 16 << 20
LONG_TEXT = 1 << 20
#: Filter bits for a word, bytes of a line (8 lanes of 64 bits, one bit set in each), words in a piece.
BITS, LINE, PIECE = 16, 64, 1 << 21
ROUND_BYTES = 32 << 20
#: Hashes that a task holds at a time.
PROBES = 1 << 20


@dataclass(frozen=True)
class Misspell:
    """Runs whose crc32 of ``id:run`` is divisible by ``every`` lose the code point at crc32 modulo length."""

    every: int = 97


def counted(column: str, least: int, misspell: Misspell | None):
    """Counts of words of at least ``least`` code points, added up over many documents."""

    def run(batches):
        counts, held = Counter(), 0
        for batch in batches:
            texts, ids = batch.column(column).cast(pa.large_binary()), batch.column("id")
            for text, key in zip(texts, ids, strict=True):
                text = (text.as_py() or b"").translate(LOWER)
                own = Counter(RUN.findall(text) if len(text) <= LONG_TEXT else (m[0] for m in RUN.finditer(text)))
                seed = zlib.crc32(f"{'' if not key.is_valid else key.as_py()}:".encode())
                for word, n in own.items():
                    if misspell is not None and (h := zlib.crc32(word, seed)) % misspell.every == 0:
                        letters = word.decode()
                        at = h % len(letters)
                        word = (letters[:at] + letters[at + 1 :]).encode()
                    if len(word) >= least and (len(word) >= 2 * least or len(word.decode()) >= least):
                        if word not in counts:
                            held += len(word) + 120
                        counts[word] += n
                if held > HOLD:
                    yield _counts(counts)
                    counts, held = Counter(), 0
        yield _counts(counts)

    return run


def _counts(counts: Counter) -> pa.RecordBatch:
    words = pa.array(list(counts), pa.large_binary()).cast(pa.large_string()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])


# hashes of words and of their edits

LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
SECOND = np.uint64(0xA0761D6478BD642F)


def same_length(words: pa.Array, cells: int):
    """(length, rows, code points [row, position]) of words of one length, about ``cells`` at a time."""
    texts = words.to_pylist()
    lengths = np.array([len(w) for w in texts], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    for length in np.unique(lengths):
        rows = order[np.searchsorted(lengths[order], length) : np.searchsorted(lengths[order], length, "right")]
        step = max(1, cells // max(1, int(length)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            codes = np.frombuffer("".join(texts[i] for i in part).encode("utf-32-le"), dtype=np.uint32)
            yield int(length), part, codes.reshape(len(part), int(length))


class Polynomial:
    """Hashes of words [row, position] and of all their deletions and replacements."""

    def __init__(self, codes: np.ndarray):
        self.codes, n = codes, codes.shape[1]
        self.power, inverse = powers(WORD_BASE, n + 1)
        self.back = inverse[1]
        terms = LETTER[codes] * self.power[:n]
        self.ahead = np.zeros((len(codes), n + 1), dtype=np.uint64)
        np.cumsum(terms, axis=1, out=self.ahead[:, 1:])
        self.whole, self.terms = self.ahead[:, -1], terms

    def keys(self) -> np.ndarray:
        return mix(self.whole + np.uint64(self.codes.shape[1]))

    def deletions(self):
        """(row, position, key), a run of equal letters once."""
        n = self.codes.shape[1]
        first = np.ones(self.codes.shape, dtype=bool)
        first[:, 1:] = self.codes[:, 1:] != self.codes[:, :-1]
        row, at = np.nonzero(first)
        rest = (self.whole[row] - self.ahead[row, at + 1]) * self.back
        return row, at, mix(self.ahead[row, at] + rest + np.uint64(n - 1))

    def replacements(self, letter: int):
        """(row, position, key) of all places where a smaller letter gives way to ``letter``."""
        row, at = np.nonzero(self.codes < letter)
        value = self.whole[row] - self.terms[row, at] + LETTER[letter] * self.power[at]
        return row, at, mix(value + np.uint64(self.codes.shape[1]))


def hashed(batches):
    """Adds ``length`` and ``key``."""
    for batch in batches:
        lengths, keys = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows, dtype=np.uint64)
        for length, rows, codes in same_length(batch.column("word"), PROBES):
            lengths[rows], keys[rows] = length, Polynomial(codes).keys()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths), pa.array(keys.view(np.int64))], ["word", "n", "length", "key"])


# filters


def piece_of(key: np.ndarray, pieces: int) -> np.ndarray:
    return (key & np.uint64(0xFFFF)) % np.uint64(pieces) if pieces > 1 else np.zeros(len(key), dtype=np.uint64)


def line_of(key: np.ndarray, lines: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(lines)) >> np.uint64(32)


def lane_bits(key: np.ndarray):
    """For each of the 8 lanes, the word with the key's bit set."""
    bits = mix(key ^ SECOND)
    for lane in range(8):
        yield np.uint64(1) << ((bits >> np.uint64(6 * lane)) & np.uint64(63))


@dataclass(frozen=True)
class Layout:
    """Pieces and lines of the filters of each length, by the number of its words."""

    shape: dict[int, tuple[int, int]]

    @classmethod
    def of(cls, sizes: dict[int, int]) -> Layout:
        shape = {}
        for length, words in sizes.items():
            pieces = -(-words // PIECE)
            shape[length] = pieces, -(-words * BITS // (pieces * LINE * 8)) + 1
        return cls(shape)

    def rounds(self) -> list[list[tuple[int, int]]]:
        """Groups of (length, piece) of at most ROUND_BYTES, or of one piece."""
        out, room = [], 0
        for length, (pieces, lines) in sorted(self.shape.items()):
            for piece in range(pieces):
                if not out or room < lines * LINE:
                    out.append([])
                    room = ROUND_BYTES
                out[-1].append((length, piece))
                room -= lines * LINE
        return out


def lines(layout: Layout):
    """The line of each word and the bits that it sets there."""

    def run(batches):
        for batch in batches:
            length = np.minimum(batch.column("length").to_numpy(), LENGTHS)
            key = batch.column("key").to_numpy().view(np.uint64)
            piece, line = np.zeros(len(key), dtype=np.int32), np.zeros(len(key), dtype=np.int64)
            for k in np.unique(length):
                here = length == k
                pieces, n = layout.shape[int(k)]
                piece[here], line[here] = piece_of(key[here], pieces), line_of(key[here], n)
            lanes = [pa.array(b.view(np.int64)) for b in lane_bits(key)]
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int32()), pa.array(piece), pa.array(line), *lanes], ["length", "piece", "line", *LANES])

    return run


LANES = [f"b{i}" for i in range(8)]
LINES = "length int, piece int, line long, " + ", ".join(f"{b} long" for b in LANES)


def filters(rows: pa.Table, group: list[tuple[int, int]], layout: Layout) -> dict[tuple[int, int], np.ndarray]:
    """The filters of one round, from the lines that are not empty."""
    out = {(length, piece): np.zeros((layout.shape[length][1], 8), dtype=np.uint64) for length, piece in group}
    length, piece, line = (rows[c].to_numpy() for c in ("length", "piece", "line"))
    lanes = np.stack([rows[b].to_numpy().view(np.uint64) for b in LANES], axis=1)
    for (k, p), table in out.items():
        here = (length == k) & (piece == p)
        table[line[here]] = lanes[here]
    return out


def holds(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of the keys that the filter lets pass."""
    places, line = np.arange(len(key)), line_of(key, len(table))
    for lane, bit in enumerate(lane_bits(key)):
        left = (table[line, lane] & bit[places]) != 0
        places, line = places[left], line[left]
    return places


def probed(given, layout: Layout, alphabet: list[int]):
    """Candidates: ``word``, ``n`` and a text one edit away that a filter of the round lets pass."""

    def run(batches):
        tables = given.value
        present = {length for length, _ in tables}

        def passing(length, row, at, key):
            shard = min(length, LENGTHS)
            piece = piece_of(key, layout.shape[shard][0])
            for p in range(layout.shape[shard][0]):
                if (shard, p) in tables:
                    mine = np.flatnonzero(piece == p) if layout.shape[shard][0] > 1 else np.arange(len(key))
                    mine = mine[holds(tables[shard, p], key[mine])]
                    yield from zip(row[mine].tolist(), at[mine].tolist(), strict=True)

        def edits(length, poly):
            """Row, position and the letter put there ('' for a deletion) of edits that pass."""
            if min(length - 1, LENGTHS) in present:
                for r, at in passing(length - 1, *poly.deletions()):
                    yield r, at, ""
            if min(length, LENGTHS) in present:
                for letter in alphabet:
                    for r, at in passing(length, *poly.replacements(letter)):
                        yield r, at, chr(letter)

        for batch in batches:
            words, counts = batch.column("word"), batch.column("n").to_pylist()
            texts, out, held = words.to_pylist(), [], 0
            for length, rows, codes in same_length(words, PROBES):
                for r, at, letter in edits(length, Polynomial(codes)):
                    word = texts[rows[r]]
                    out.append((word, counts[rows[r]], word[:at] + letter + word[at + 1 :]))
                    held += 2 * length
                    if held > HOLD:
                        yield _candidates(out)
                        out, held = [], 0
            yield _candidates(out)

    return run


def _candidates(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("word", pa.string()), ("n", pa.int64()), ("near", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [c for c, _ in kinds])


# operator


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, misspell: Misspell | None = Misspell()) -> DataFrame:
    """``word``, ``n``, ``length`` and ``key`` (a hash), staged."""
    base = docs.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    parts = base.mapInArrow(counted("text", least_length, misspell), "word string, n long")
    words = parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    return stage(words.mapInArrow(hashed, "word string, n long, length int, key long"), "vocabulary")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: each pair of near words once, exactly."""
    spark = words.sparkSession
    shard = F.least("length", F.lit(LENGTHS))
    layout = Layout.of({r["s"]: r["n"] for r in words.groupBy(shard.alias("s")).agg(F.count("*").alias("n")).collect()})
    if not layout.shape:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    alphabet = sorted(ord(r["c"]) for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect())
    bits = words.select("length", "key").mapInArrow(lines(layout), LINES)
    bits = bits.groupBy("length", "piece", "line").agg(*[F.bit_or(b).alias(b) for b in LANES])
    rounds = layout.rounds()
    if len(rounds) > 1:
        bits = stage(bits, "lines")
    found = []
    for group in rounds:
        lengths = sorted({length for length, _ in group})
        of_round = F.struct("length", "piece").isin([F.struct(F.lit(a).cast("int"), F.lit(b).cast("int")) for a, b in group])
        given = spark.sparkContext.broadcast(filters(bits.where(of_round).toArrow(), group, layout))
        within = shard.isin(lengths) | F.least(F.col("length") - 1, F.lit(LENGTHS)).isin(lengths)
        hits = words.where(within).select("word", "n").mapInArrow(probed(given, layout, alphabet), "word string, n long, near string")
        found.append(stage(hits, "candidates"))
        given.destroy()
    if len(rounds) > 1:
        drop(bits)
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.union(more)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return candidates.join(known, "near").select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """The last form of each ``word`` with a ``form``, by doubling: counts rise along forms, so no cycle
    occurs, and the rounds are the logarithm of the logarithm of the largest count.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if join_groups(now, onward, ["root"], "inner").isEmpty():
            return now
        further = join_groups(now, onward, ["root"]).select("word", F.coalesce("next", "root").alias("root"))
        later = stage(further, "roots")
        drop(now)
        now = later


def spelling_variants(words: DataFrame) -> DataFrame:
    """A row for each word of a :func:`vocabulary`: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    pairs = near_pairs(words)
    both = pairs.union(pairs.select("near", "near_n", "word", "n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    joined = words.select("word", "n").join(best, "word", "left")
    enough = -F.col("best.minus") >= RATIO * F.col("n")
    joined = joined.select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    known = stage(joined, "forms")
    last = roots(known.where("form IS NOT NULL"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
