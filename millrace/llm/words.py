"""Words, word hashes and window hashes of whole batches of texts, on numpy arrays.

Texts are taken as UTF-8 bytes. Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``;
as these are ASCII, runs of bytes and runs of characters are the same. Hashes are polynomial
(Rabin-Karp) in arithmetic modulo 2**64 with odd, hence invertible, bases: a prefix sum gives
the hash of every word or window by one subtraction and one product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)


def is_word_byte() -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i in 0..n, modulo 2**64."""
    out = []
    for b in (int(base), pow(int(base), -1, 1 << 64)):
        p = np.full(n + 1, b, dtype=np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        out.append(p)
    return out[0], out[1]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(c.cast(pa.large_string()) for c in column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, rows: int, size: int = PIECE):
    """Parts of a batch of at most ``rows`` rows and about ``size`` bytes of text, but one row at least."""
    bytes_ = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0).to_numpy()
    ahead = np.concatenate([[0], np.cumsum(bytes_)])
    at = 0
    while at < batch.num_rows:
        end = min(at + rows, max(at + 1, int(np.searchsorted(ahead, ahead[at] + size, "right")) - 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


class Words:
    """Words of a batch of texts: byte spans, and per text its first word and word count."""

    def __init__(self, column, lower: bool = False):
        self.data, self.offsets = text_bytes(column)
        if lower:
            self.data = lower_table()[self.data]
        inside = is_word_byte()[self.data]
        n = len(inside)
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        full = self.offsets[1:] > self.offsets[:-1]
        before[self.offsets[:-1][full]] = False
        after[self.offsets[1:][full] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets).astype(np.int64)
        self.count = np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, piece by piece so that temporary arrays stay small."""
        value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        out = np.empty(len(self.start), dtype=np.uint64)
        pw, inv = powers(BYTE_BASE, PIECE)
        k = 0
        while k < len(out):
            j = max(k + 1, int(np.searchsorted(self.end, self.start[k] + PIECE, "right")))
            lo, hi = int(self.start[k]), int(self.end[j - 1])
            if hi - lo >= len(pw):
                pw, inv = powers(BYTE_BASE, hi - lo)
            sums = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(value[self.data[lo:hi]] * pw[: hi - lo], out=sums[1:])
            s, e = self.start[k:j] - lo, self.end[k:j] - lo
            out[k:j] = mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64))
            k = j
        return out


def window_sums(ids: np.ndarray, size: int, base: np.uint64 = WORD_BASE) -> np.ndarray:
    """Rabin-Karp value of every run of ``size`` ids; runs may cross texts, callers mask those."""
    n = len(ids)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    pw, inv = powers(base, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(ids * pw[:n], out=sums[1:])
    return mix((sums[size:] - sums[: n - size + 1]) * inv[: n - size + 1])


def windows_inside(first: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word and text of every window of ``size`` words that lies in one text."""
    per = np.maximum(count - size + 1, 0)
    text = np.repeat(np.arange(len(count)), per)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    return np.repeat(first[: len(count)], per) + rank, text
