"""SentencePiece encoding and decoding that keeps byte offsets.

1. *Normalisation.* The compiled character map of a model is a trie from source strings to
   replacements. The longest prefix found in it is replaced, else one character is copied, and
   for every normalised character the source byte it came from is recorded.
2. *Segmentation.* As no piece has a word-start sign behind another character, the text falls
   into units that start at such signs, and units repeat a lot. The distinct units of a batch
   are merged in lockstep: in every round each unit merges its best pair, for all units at once
   on arrays. Units over ``LONG`` characters are merged with a heap.
3. *Projection.* Piece lengths in normalised characters, looked up in the record of step 1,
   give the byte span of every piece in the original text. Byte pieces of one character share
   its span.

Supported are BPE models with byte fallback and without user-defined pieces; ids equal those of the sentencepiece
library, and decoding is the library's.

Edge cases: null and empty texts give no pieces and decode to an empty text; texts of any length
and without any space are encoded whole; repeated rows are encoded each; rows with a null id are
encoded, too; an empty table gives an empty result. Other columns travel in one struct.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import PIECE, slices

START = "▁"
LONG = 256
CACHE = 120_000
ROWS = 256
#: Bytes of text that a worker encodes at once.
SLICE = PIECE // 4
NEVER = np.iinfo(np.int32).max


@dataclass(frozen=True)
class Model:
    """What a model file says, as plain values."""

    raw: bytes
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool
    escape: bool

def load(path: str) -> Model:
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        raw = file.read()
    m = proto.ModelProto.FromString(raw)
    kinds = [p.type for p in m.pieces]
    if m.trainer_spec.model_type != 2 or m.trainer_spec.treat_whitespace_as_suffix or not m.trainer_spec.byte_fallback or {4, 5} & {*kinds}:
        raise ValueError("only BPE models with byte fallback and without user-defined or unused pieces are supported")
    n = m.normalizer_spec
    return Model(
        raw, [p.piece for p in m.pieces], [p.score for p in m.pieces], kinds, n.precompiled_charsmap, n.add_dummy_prefix,
        n.remove_extra_whitespaces, n.escape_whitespaces,
    )


def character_map(blob: bytes) -> dict[bytes, str]:
    """All entries of a compiled map: a double-array trie over bytes, then the replacements."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
    texts = blob[4 + size :]
    offset = lambda u: (u >> 10) << ((u & (1 << 9)) >> 6)
    found = {}
    todo = [(offset(units[0]), b"")]
    while todo:
        at, prefix = todo.pop()
        for byte in range(1, 256):
            place = at ^ byte
            if place < len(units) and units[place] & ((1 << 31) | 0xFF) == byte:
                unit, key = units[place], prefix + bytes([byte])
                below = place ^ offset(unit)
                if unit >> 8 & 1:
                    value = units[below] & 0x7FFFFFFF
                    found[key] = texts[value : texts.index(0, value)].decode()
                todo.append((below, key))
    return found


class Normalizer:
    """Normalised text and, for every boundary of its characters, the byte offset in the source."""

    def __init__(self, model: Model):
        self.model = model
        self.map = {k.decode(): v for k, v in character_map(model.charsmap).items()}
        self.longest = max(map(len, self.map), default=0)
        self.space = START if model.escape else " "

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        if not text:
            return "", np.zeros(1, np.int64)
        if self.map or self.model.squeeze:
            return self._mapped(text)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        head = [0, 0] if self.model.dummy_prefix else [0]
        return (self.space if self.model.dummy_prefix else "") + text.replace(" ", self.space), np.concatenate([head, np.cumsum(width)])

    def _prefix(self, text: str, at: int) -> tuple[str, int]:
        for n in range(min(self.longest, len(text) - at), 0, -1):
            found = self.map.get(text[at : at + n])
            if found is not None:
                return found, n
        return text[at], 1

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        out, source = [], []
        at = byte = 0
        squeeze = self.model.squeeze
        parts = []
        while at < len(text):
            new, n = self._prefix(text, at)
            size = len(text[at : at + n].encode())
            parts.append((new, byte, byte + size))
            at, byte = at + n, byte + size
        if squeeze:
            first = 0
            while first < len(parts) and parts[first][0] == " ":
                first += 1
            parts = parts[first:]
            if not parts:
                return "", np.zeros(1, np.int64)
        if self.model.dummy_prefix:
            out.append(" "), source.append(parts[0][1])
        after_space = squeeze
        for new, begin, _ in parts:
            if after_space:
                new = new.lstrip(" ")
            if new:
                out.append(new)
                source += [begin] * len(new)
                after_space = new.endswith(" ")
            if not squeeze:
                after_space = False
        done = "".join(out).replace(" ", self.space)
        end = parts[-1][2]
        if squeeze:
            # The library cuts signs that stood in the text, too.
            short = done.rstrip(self.space)
            if len(short) < len(done):
                end = source[len(short)]
            done, source = short, source[: len(short)]
        return done, np.array([*source, end], dtype=np.int64)


class Merges:
    """Symbols of a model and the table of pairs that merge; a symbol beyond the pieces is a
    character without a piece of its own.
    """

    def __init__(self, model: Model):
        self.model = model
        normal = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == 1}
        self.symbol = dict(normal)
        for piece in normal:
            for char in piece:
                self.symbol.setdefault(char, len(model.pieces) + ord(char))
        rank = {i: r for r, i in enumerate(sorted(normal.values(), key=lambda i: (-model.scores[i], i)))}
        levels = {s: r for r, s in enumerate(sorted({model.scores[i] for i in rank}, reverse=True))}
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[self.key(left, right)] = (levels[model.scores[i]], i)
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        self.of_point = np.arange(0x110000, dtype=np.int64) + len(model.pieces)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.of_point[ord(piece)] = i
        self.byte = np.zeros(256, dtype=np.int32)
        for piece, kind, i in zip(model.pieces, model.kinds, range(len(model.pieces)), strict=True):
            if kind == 6:
                self.byte[int(piece[3:5], 16)] = i
        self.length = np.array([len(p) for p in model.pieces])
        self.splits = not any(START in p.lstrip(START) for p in normal)

    @staticmethod
    def key(left, right):
        return (left << 22) | right

    def symbols(self, text: str) -> np.ndarray:
        return self.of_point[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.key(left, right)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NEVER), self.merged[at]

    def lockstep(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left when no pair merges any more, and the unit of each."""
        owner = np.repeat(np.arange(len(units)), [len(u) for u in units])
        symbol = self.symbols("".join(units))
        done_owner, done_symbol = [], []
        rank = np.full(len(symbol), NEVER, dtype=np.int32)
        target = np.zeros(len(symbol), dtype=np.int64)

        def refresh(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at + 1 < len(symbol))]
            rank[at], target[at] = self.look_up(symbol[at], symbol[at + 1])
            rank[at[owner[at] != owner[at + 1]]] = NEVER

        refresh(np.arange(len(symbol) - 1))
        while len(symbol):
            start = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(rank, start)
            per = np.diff(start, append=len(owner))
            level = np.repeat(best, per)
            over = level == NEVER
            if over.any():
                done_owner.append(owner[over]), done_symbol.append(symbol[over])
                owner, symbol, rank, target, level = (v[~over] for v in (owner, symbol, rank, target, level))
                if not len(owner):
                    break
            hits = np.flatnonzero(rank == level)
            hits = hits[np.diff(owner[hits], prepend=-1) != 0]
            symbol[hits] = target[hits]
            stay = np.ones(len(symbol), dtype=bool)
            stay[hits + 1] = False
            at = np.cumsum(stay)[hits] - 1
            owner, symbol, rank, target = (v[stay] for v in (owner, symbol, rank, target))
            rank[at] = NEVER
            refresh(np.concatenate([at - 1, at]))
        if not done_owner:
            return owner, symbol
        owner, symbol = np.concatenate(done_owner), np.concatenate(done_symbol)
        order = np.argsort(owner, kind="stable")
        return owner[order], symbol[order]

    def heap(self, unit: str) -> np.ndarray:
        """The same for one long unit."""
        symbol = self.symbols(unit).tolist()
        n = len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []

        def push(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                found = self.pairs.get(self.key(symbol[left], symbol[right]))
                if found:
                    heapq.heappush(queue, (found[0], left, right, symbol[left], symbol[right], found[1]))

        for i in range(n - 1):
            push(i, i + 1)
        while queue:
            _, left, right, a, b, new = heapq.heappop(queue)
            if symbol[left] != a or symbol[right] != b or after[left] != right:
                continue
            symbol[left], symbol[right] = new, -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            push(before[left], left)
            push(left, after[left])
        return np.array([s for s in symbol if s >= 0], dtype=np.int64)

    def ids(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids of symbols, which symbol each comes from, and how many normalised characters
        it advances by; all but the last byte piece of a character advance by none.
        """
        n = len(self.model.pieces)
        count = np.ones(len(symbols), dtype=np.int64)
        raw = np.flatnonzero(symbols >= n)
        coded = [chr(s).encode() for s in (symbols[raw] - n).tolist()]
        count[raw] = [len(c) for c in coded]
        source = np.repeat(np.arange(len(symbols)), count)
        last = np.cumsum(count) - 1
        step = np.zeros(len(source), dtype=np.int64)
        whole = symbols < n
        step[last] = 1
        step[last[whole]] = self.length[symbols[whole]]
        ids = np.zeros(len(source), dtype=np.int32)
        ids[last[whole]] = symbols[whole]
        ids[~whole[source]] = self.byte[np.frombuffer(b"".join(coded), dtype=np.uint8)]
        return ids, source, step


def gathered(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of all runs ``starts .. starts + counts``, one behind the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


class Encoder:
    """Encodes texts; keeps the pieces of the distinct units that it has seen, up to ``CACHE``."""

    def __init__(self, model: Model):
        self.normalize = Normalizer(model)
        self.merges = Merges(model)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.step = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.start = np.zeros(1, np.int64)

    def units(self, text: str) -> list[str]:
        if not self.merges.splits:
            return [text] if text else []
        parts = text.split(START)
        out, signs = [parts[0]] if parts[0] else [], 0
        if "" not in parts[1:]:
            return out + [START + p for p in parts[1:]]
        for part in parts[1:]:
            signs += 1
            if part:
                out.append(START * signs + part)
                signs = 0
        return [*out, START * signs] if signs else out

    def learn(self, new: list[str]) -> None:
        new.sort(key=len)
        cut = next((i for i, u in enumerate(new) if len(u) > LONG), len(new))
        owner, symbol = self.merges.lockstep(new[:cut]) if cut else (np.zeros(0, np.int64),) * 2
        for i, unit in enumerate(new[cut:], cut):
            own = self.merges.heap(unit)
            owner, symbol = np.append(owner, np.full(len(own), i)), np.append(symbol, own)
        ids, source, step = self.merges.ids(symbol)
        ends = np.searchsorted(owner[source], np.arange(1, len(new) + 1))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.start = np.append(self.start, len(self.ids) + ends)
        self.ids, self.step = np.append(self.ids, ids), np.append(self.step, step)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of all texts: ids, begins and ends, and where each text's pieces start."""
        normal = [self.normalize(t) for t in texts]
        split = [self.units(t) for t, _ in normal]
        if len(self.known) > CACHE:
            self.forget()
        new = set().union(*split).difference(self.known)
        if new:
            self.learn(list(new))
        unit = np.fromiter((self.known[u] for units in split for u in units), dtype=np.int64)
        counts = self.start[unit + 1] - self.start[unit]
        at = gathered(self.start[unit], counts)
        ids, step = self.ids[at], self.step[at]
        pieces = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, split)])]
        # The sources of all texts in one array; each text starts behind the end of the one before.
        lengths = np.array([len(s) for _, s in normal], dtype=np.int64)
        base = np.repeat(np.cumsum(lengths) - lengths, np.diff(pieces))
        ahead = np.concatenate([[0], np.cumsum(step)])
        end = ahead[1:] - np.repeat(ahead[pieces[:-1]], np.diff(pieces)) + base
        source = np.concatenate([s for _, s in normal]) if normal else np.zeros(0, np.int64)
        return ids, source[end - step], source[end + (step == 0)], pieces


OUT = "id long, ids array<int>, begins array<int>, ends array<int>, decoded string"


def encoder(model: Model):
    def run(batches):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_proto=model.raw)
        own = Encoder(model)
        for batch in batches:
            for part in slices(batch, "text", ROWS, SLICE):
                *found, cuts = own.encode([t or "" for t in part.column("text").to_pylist()])
                arrays = [pa.ListArray.from_arrays(cuts.astype(np.int32), x.astype(np.int32)) for x in found]
                plain = found[0].tolist()
                decoded = library.decode([plain[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *arrays, pa.array(decoded, pa.string()), part.column("row")],
                    names=["id", "ids", "begins", "ends", "decoded", "row"],
                )

    return run


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``id``, the piece ``ids`` of the text, the byte offsets ``begins`` and ``ends`` of every piece
    in it, the ``decoded`` text, and ``row``, a struct of the columns named in ``carry``.

    ``path`` is the model's file; only the driver reads it.
    """
    base = docs.select(
        F.col(key).cast("long").alias("id"),
        F.col(text).cast("string").alias("text"),
        F.struct(*[F.col(c) for c in carry]).alias("row") if carry else F.lit(None).cast("int").alias("row"),
    )
    return base.mapInArrow(encoder(load(path)), f"{OUT}, row {base.schema['row'].dataType.simpleString()}")


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
