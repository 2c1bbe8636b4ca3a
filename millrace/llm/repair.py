"""Conversation structure repair: the cheapest edits that give every conversation a legal turn order.

The legal orders are the role initials ``(s?(ua)+)?``. A row is kept (K, free), given the role user
or assistant (R), or deleted (D); empty user and assistant turns can be inserted anywhere (I). Rows
that are blank, or repeat role and text of an earlier row, must be deleted; a truncated row that is
not deleted costs extra. Of all cheapest edits those with the ASCII-least audit (their letters in
order) are taken.

A conversation is a layered graph: a node is a number of rows done and a state of the order, arcs are
edits. Conversations are cut into *blocks* of at most ``BLOCK`` rows, so that no task holds one:

1. Rows are dealt by ranges of conversation and turn; tasks cut their runs into blocks.
2. Cost DP: a block gives the costs from each state before it to each state behind it. A scan over
   the blocks of a conversation, last one first, turns these into the cost to the end behind each block.
3. Path ranking by prefix doubling: with that cost a block knows its optimal arcs. Nodes are ranked
   by the first 1, 2, 4, ... letters of their best audit, each rank made of the pair of ranks of the
   node and of the node that its doubled pointer reaches. One edit leads from a state to one other
   state only, so arcs of equal rank never leave one node. A scan, first block first, picks the state
   in which each block is entered, and the doubled pointers spell the least path from it.

The scans see a few numbers for each block; texts take no part until :func:`apply` or :func:`digest`,
which stream the rows of a conversation in order (a hash is a sequence; they hold one row at a time,
and the digest one letter for each row).

Edge cases: null roles and texts count as one space, as does an empty role; rows are ordered by turn
(nulls first), then by role, then by SHA-256 of the text, so ties and repeats have a fixed order;
rows with a null id form one conversation; other columns are ignored; an empty table gives nothing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import stage
from millrace.operators.joins import join_groups

BLOCK = 1024
#: Rows whose nodes a task holds at a time.
PORTION = 1 << 15
NEVER = 1 << 40

#: States: nothing yet, then the initial of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a row of role class s, u, a, other; -1 where it may not stand.
NEXT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: State after an inserted or renamed turn.
TURN = np.array([USER, USER, ASSISTANT, USER])
#: Inserts that end a conversation legally.
CLOSING = np.array([0, 2, 1, 0])
CLASSES = "sua"
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = ["", "blank", "duplicate", "truncated"]
LETTERS = np.frombuffer(b" DIKR", dtype=np.uint8)
INITIALS = np.frombuffer(b" sua", dtype=np.uint8)
SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3

    def __post_init__(self):
        if min(self.rerole, self.delete, self.insert) < 1 or self.truncated < 0:
            raise ValueError("edits must cost something")


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with faults put in by crc32 of ``conv_id:turn``."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    hit = rows.where(kind != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(blank("role")).alias("role"),
        text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    )
    return hit.drop("_copy")


# rows


def _distinct(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``digest`` of their text and how often they occur, staged."""
    spaced = lambda c: F.when(F.length(c) > 0, F.col(c).cast("string")).otherwise(" ")
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    counted = clean.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    return stage(counted.withColumn("digest", F.sha2("text", 256)), "turns")


def _coded(once: DataFrame) -> DataFrame:
    """A row for each row of the input, without its text: order key and ``code`` of role class and fault."""
    stripped = F.rtrim("text", F.lit(SPACE))
    slim = once.select(
        "conv_id", "turn", "role", "digest", "copies",
        F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn")).alias("when"),
        (F.length(stripped) == 0).alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    seen = slim.groupBy("conv_id", "role", "digest").agg(F.min("when").alias("first"), F.count("*").alias("_n"))
    again = seen.where("_n > 1").drop("_n")
    slim = join_groups(slim, again, ["conv_id", "role", "digest"], null_group=True)
    slim = slim.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    repeated = (F.col("copy") > 1) | F.coalesce(F.col("when") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), BLANK).when(repeated, DUPLICATE).when(F.col("open"), TRUNCATED).otherwise(NO_FAULT)
    initial = F.left("role", F.lit(1))
    role_class = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return slim.select(*ORDER, (role_class + 4 * fault).cast("int").alias("code"))


ORDER = ["conv_id", "turn", "role", "digest", "copy"]
ROW = "struct<turn:long,role:string,digest:string,copy:long,code:int>"


def _changes(conv: pa.ChunkedArray) -> np.ndarray:
    """True where a conversation begins."""
    value = conv.fill_null(0).to_numpy()
    known = conv.is_valid().to_numpy()
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (known[1:] != known[:-1])
    return new


def cut(batches):
    """Runs of one conversation in pieces of at most BLOCK rows."""
    first, count, rest = TaskContext.get().partitionId() << 40, 0, None

    def blocks(table: pa.Table, limits: np.ndarray) -> pa.RecordBatch:
        nonlocal count
        table = table.combine_chunks()
        columns = {c: table[c].combine_chunks() for c in table.column_names}
        codes = columns["code"].to_numpy().astype(np.uint8)
        rows = pa.StructArray.from_arrays([columns[c] for c in ("turn", "role", "digest", "copy", "code")], ["turn", "role", "digest", "copy", "code"])
        n = len(limits) - 1
        ids = pa.array(first + count + np.arange(n), pa.int64())
        count += n
        packed = pa.array([codes[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:], strict=True)], pa.binary())
        lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), rows)
        return pa.RecordBatch.from_arrays([columns["conv_id"].take(pa.array(limits[:-1])), ids, packed, lists], ["conv_id", "block", "codes", "rows"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        new = _changes(table["conv_id"])
        begin = np.flatnonzero(new)
        rank = np.arange(len(new)) - np.repeat(begin, np.diff(np.append(begin, len(new))))
        starts = np.flatnonzero(rank % BLOCK == 0)
        if len(starts) > 1:
            yield blocks(table.slice(0, int(starts[-1])), starts)
        rest = table.slice(int(starts[-1]))
    if rest is not None:
        yield blocks(rest, np.array([0, rest.num_rows]))


# the graph of some blocks


class Graph:
    """Blocks side by side: ``codes`` of all rows, and the layers of nodes between them."""

    def __init__(self, codes: list[bytes]):
        self.lengths = np.array([len(c) for c in codes], dtype=np.int64)
        self.codes = np.frombuffer(b"".join(codes), dtype=np.uint8).astype(np.int64)
        self.row = np.cumsum(self.lengths) - self.lengths
        self.layer = self.row + np.arange(len(codes))

    def costs(self, ends: np.ndarray, costs: Costs) -> np.ndarray:
        """Least cost from every node to its block's end, where ``ends`` (block, state, case) has to be paid."""
        layers, cases = int(self.lengths.sum()) + len(self.lengths), ends.shape[2]
        value = np.empty((layers, 4, cases), dtype=np.int64)
        value[self.layer + self.lengths] = ends
        order = np.argsort(-self.lengths, kind="stable")
        longest_first = -self.lengths[order]
        for back in range(1, int(self.lengths.max(initial=0)) + 1):
            active = order[: np.searchsorted(longest_first, -back, "right")]
            at = self.layer[active] + self.lengths[active] - back
            code = self.codes[self.row[active] + self.lengths[active] - back]
            ahead = np.concatenate([value[at + 1], np.full((len(at), 1, cases), NEVER)], axis=1)
            extra = np.where(code // 4 == TRUNCATED, costs.truncated, 0)[:, None, None]
            kept = np.take_along_axis(ahead, NEXT[:, code % 4].T[:, :, None], axis=1) + extra
            turned = ahead[:, TURN] + costs.rerole + extra
            best = ahead[:, :4] + costs.delete
            free = np.isin(code // 4, (NO_FAULT, TRUNCATED))[:, None, None]
            best = np.where(free, np.minimum(best, np.minimum(kept, turned)), best)
            once = np.minimum(best, best[:, TURN] + costs.insert)
            value[at] = np.minimum(np.minimum(once, once[:, TURN] + costs.insert), NEVER)
        return value

    def best_arcs(self, value: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the least first letter of every node (0 at a block's end), and where its arc leads."""
        layers = len(value)
        inner = np.ones(layers, dtype=bool)
        inner[self.layer + self.lengths] = False
        at = np.flatnonzero(inner)
        code, here, ahead = self.codes, value[at], value[at + 1]
        fault = (code // 4)[:, None]
        free = (fault == NO_FAULT) | (fault == TRUNCATED)
        extra = np.where(fault == TRUNCATED, costs.truncated, 0)
        target = NEXT[:, code % 4].T
        padded = np.concatenate([ahead, np.full((len(at), 1), NEVER)], axis=1)
        state = np.arange(4)[None, :]
        ways = [  # in the order of LETTERS: delete, insert, keep, change the role
            (here == ahead + costs.delete, state, 1),
            (here == here[:, TURN] + costs.insert, TURN[None, :], 0),
            (free & (here == np.take_along_axis(padded, target, axis=1) + extra), target, 1),
            (free & (here == ahead[:, TURN] + costs.rerole + extra), TURN[None, :], 1),
        ]
        rank = np.zeros((layers, 4), dtype=np.int64)
        succ = np.arange(layers * 4).reshape(layers, 4)
        for letter, (fits, to, step) in reversed(list(enumerate(ways, 1))):
            rank[at] = np.where(fits, letter, rank[at])
            succ[at] = np.where(fits, 4 * (at[:, None] + step) + to, succ[at])
        return rank.ravel(), succ.ravel()

    def doubled(self, rank: np.ndarray, succ: np.ndarray) -> list[np.ndarray]:
        """Pointers over 1, 2, 4, ... arcs of the least path, until all stand at a block's end."""
        pointers = [succ]
        while True:
            ahead = pointers[-1]
            if not rank[ahead].any():
                return pointers
            _, rank = np.unique(rank * (rank.max() + 1) + rank[ahead], return_inverse=True)
            pointers.append(ahead[ahead])

    def exits(self, pointers: list[np.ndarray]) -> np.ndarray:
        """State behind each block for each state before it."""
        return pointers[-1].reshape(-1, 4)[self.layer] % 4

    def paths(self, pointers: list[np.ndarray], first: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Nodes of the least paths from the entry states, block by block, without the ends."""
        nodes = 4 * self.layer + entry
        nodes = nodes[first[nodes] > 0]
        for pointer in reversed(pointers):
            nodes = np.stack([nodes, pointer[nodes]], axis=1).ravel()
            nodes = nodes[first[nodes] > 0]
        return nodes

    def edits(self, value: np.ndarray, entry: np.ndarray, last: np.ndarray, costs: Costs) -> tuple[pa.Array, pa.Array]:
        """Lists of ``edits`` and ``made`` (letters and initials of the turns made) of each block's rows."""
        rank, succ = self.best_arcs(value, costs)
        pointers = self.doubled(rank, succ)
        nodes = self.paths(pointers, rank, entry)
        letter, row = rank[nodes], self._row_of(nodes // 4)
        state = succ[nodes] % 4
        inserts = np.where(last, CLOSING[np.take_along_axis(self.exits(pointers), entry[:, None], 1)[:, 0]], 0)
        ends = np.repeat(np.flatnonzero(last), inserts[last])
        tail = np.concatenate([[USER, ASSISTANT][2 - k :] for k in inserts[last]] or [[]]).astype(np.int64)
        behind = np.searchsorted(row, (self.row + self.lengths)[ends])
        letter = np.insert(letter, behind, 2)
        state = np.insert(state, behind, tail)
        row = np.insert(row, behind, (self.row + self.lengths - 1)[ends])
        made = letter > 1
        total = len(self.codes)
        limits = pa.array(np.append(self.row, total), pa.int32())
        strings = [_strings(LETTERS[letter], row, total), _strings(INITIALS[state[made]], row[made], total)]
        return tuple(pa.ListArray.from_arrays(limits, s) for s in strings)

    def _row_of(self, layers: np.ndarray) -> np.ndarray:
        return layers - (np.searchsorted(self.layer, layers, "right") - 1)


def _strings(letters: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    offsets = np.zeros(rows + 1, dtype=np.int32)
    np.cumsum(np.bincount(row, minlength=rows), out=offsets[1:])
    return pa.StringArray.from_buffers(rows, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.astype(np.uint8).tobytes()))


def portions(batch: pa.RecordBatch):
    """Parts of a batch of blocks with about PORTION rows in all."""
    sizes = np.array([len(x) for x in batch.column("codes").to_pylist()], dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // PORTION
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts, np.append(starts[1:], len(sizes)), strict=True):
        yield batch.slice(int(a), int(b - a))


def _numbers(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return np.array(batch.column(column).to_pylist(), dtype=np.int64).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.array(values.reshape(len(values), -1).tolist(), pa.list_(pa.int64()))


def crossing(costs: Costs):
    """Adds to each block its costs from state to state."""

    def run(batches):
        unit = np.where(np.eye(4, dtype=bool), 0, NEVER)
        for batch in batches:
            for part in portions(batch):
                graph = Graph(part.column("codes").to_pylist())
                value = graph.costs(np.repeat(unit[None], part.num_rows, axis=0), costs)
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(value[graph.layer])], [*part.schema.names, "matrix"])

    return run


def scan_back(costs: Costs):
    """Cost to the end of the conversation behind each block; blocks come last one first."""

    def run(batches):
        at, ends = object(), None
        for batch in batches:
            out = []
            for conv, block, matrix in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "matrix")), strict=True):
                last = conv != at
                if last:
                    at, ends = conv, CLOSING * costs.insert
                out.append((block, ends.tolist(), last))
                ends = (np.array(matrix).reshape(4, 4) + ends).min(axis=1)
            yield _batch(out, [("block", pa.int64()), ("ends", pa.list_(pa.int64())), ("last", pa.bool_())])

    return run


def scan_forth(batches):
    """State in which each block is entered; blocks come first one first."""
    at, state = object(), START
    for batch in batches:
        out = []
        for conv, block, exits in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "exits")), strict=True):
            if conv != at:
                at, state = conv, START
            out.append((block, state))
            state = exits[state]
        yield _batch(out, [("block", pa.int64()), ("entry", pa.int32())])


def leaving(costs: Costs):
    def run(batches):
        for batch in batches:
            for part in portions(batch):
                graph = Graph(part.column("codes").to_pylist())
                value = graph.costs(_numbers(part, "ends", 4)[:, :, None], costs)[:, :, 0]
                exits = graph.exits(graph.doubled(*graph.best_arcs(value, costs)))
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(exits)], [*part.schema.names, "exits"])

    return run


def spelling(costs: Costs):
    def run(batches):
        for batch in batches:
            for part in portions(batch):
                graph = Graph(part.column("codes").to_pylist())
                value = graph.costs(_numbers(part, "ends", 4)[:, :, None], costs)[:, :, 0]
                entry = part.column("entry").to_numpy().astype(np.int64)
                last = np.array(part.column("last").to_pylist(), dtype=bool)
                yield pa.RecordBatch.from_arrays([part.column("block"), *graph.edits(value, entry, last, costs)], ["block", "edits", "made"])

    return run


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


@dataclass(frozen=True)
class Repair:
    """``turns``: distinct rows with text and digest; ``plan``: what happens to each row of the input."""

    turns: DataFrame
    plan: DataFrame


def repair(rows: DataFrame, costs: Costs = Costs()) -> Repair:
    """``rows`` has the columns ``conv_id``, ``turn``, ``role`` and ``text``.

    The plan has, for each row: ``conv_id``, ``turn``, ``role``, ``digest`` and ``copy`` (its place in
    the order), ``fault``, ``edits`` (inserts before it, its own letter; behind the last row also closing
    inserts) and ``made`` (the initials of the turns that these leave).
    """
    turns = _distinct(rows)
    ordered = _coded(turns).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    cells = ordered.mapInArrow(cut, f"conv_id long, block long, codes binary, rows array<{ROW}>")
    cells = stage(cells, "blocks")
    crossed = cells.select("conv_id", "block", "codes").mapInArrow(crossing(costs), "conv_id long, block long, codes binary, matrix array<long>")
    ends = crossed.select("conv_id", "block", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc())
    ends = ends.mapInArrow(scan_back(costs), "block long, ends array<long>, last boolean")
    known = cells.select("conv_id", "block", "codes").join(ends, "block").select("conv_id", "block", "codes", "ends", "last")
    known = stage(known.mapInArrow(leaving(costs), "conv_id long, block long, codes binary, ends array<long>, last boolean, exits array<long>"), "ends")
    entries = known.select("conv_id", "block", "exits").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    entries = entries.mapInArrow(scan_forth, "block long, entry int")
    spelt = known.select("block", "codes", "ends", "last").join(entries, "block")
    spelt = spelt.mapInArrow(spelling(costs), "block long, edits array<string>, made array<string>")
    row = cells.select("conv_id", "block", "rows").join(spelt, "block")
    row = row.select("conv_id", F.explode(F.arrays_zip("rows", "edits", "made")).alias("r"))
    fault = F.element_at(F.array(*[F.lit(f) for f in FAULTS]), F.floor(F.col("r.rows.code") / 4).cast("int") + 1)
    place = [F.col(f"r.rows.{c}").alias(c) for c in ORDER[1:]]
    return Repair(turns, row.select("conv_id", *place, fault.alias("fault"), F.col("r.edits").alias("edits"), F.col("r.made").alias("made")))


# back to texts


def _merged(done: Repair) -> DataFrame:
    """Each text, then the plan of its copies, in the order of the conversations."""
    none = F.lit(None).cast("string")
    texts = done.turns.select(*ORDER[:4], F.lit(0).cast("long").alias("copy"), "text", none.alias("fault"), none.alias("edits"), none.alias("made"))
    plan = done.plan.select(*ORDER, none.alias("text"), "fault", "edits", "made")
    return texts.unionByName(plan).repartition("conv_id").sortWithinPartitions(*ORDER)


def _walk(batches):
    """(conversation, turn, role, text, fault, edits, made) of all rows in order, batch by batch."""
    text = None
    for batch in batches:
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "edits", "made")), strict=True):
            if row[5] is None:
                text = row[3]
            else:
                out.append((*row[:3], text, *row[4:]))
        yield out


def _turns(role: str, text: str, edits: str, made: str):
    """Role and text of the turns that a row leaves."""
    initials = iter(made)
    for letter in edits:
        if letter != "D":
            initial = next(initials)
            yield (role if letter == "K" else {"u": "user", "a": "assistant"}[initial]), (text if letter in "KR" else "")


def _apply(batches):
    at, position = object(), 0
    for rows in _walk(batches):
        out = []
        for conv, _, role, text, _, edits, made in rows:
            if conv != at:
                at, position = conv, 0
            for name, said in _turns(role, text, edits, made):
                out.append((conv, position, name, said))
                position += 1
        yield _batch(out, [("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def apply(done: Repair) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``position``, ``role``, ``text``."""
    return _merged(done).mapInArrow(_apply, "conv_id long, position long, role string, text string")


DIGEST = [
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
]


def _digests(costs: Costs):
    price = {"D": costs.delete, "I": costs.insert, "K": 0, "R": costs.rerole}

    class Conversation:
        def __init__(self, conv):
            self.conv, self.first, self.turn, self.distinct, self.initial = conv, None, None, 0, None
            self.counts, self.illegal, self.cost, self.audit = dict.fromkeys(FAULTS, 0), 0, 0, bytearray()
            self.hash, self.empty = hashlib.sha256(), True

        def add(self, turn, role, text, fault, edits, made):
            if turn is not None and turn != self.turn:
                self.first = turn if self.first is None else self.first
                self.turn, self.distinct = turn, self.distinct + 1
            if self.initial is not None:
                self.illegal += self.initial + role[0] not in ("su", "ua", "au")
            self.initial = role[0]
            self.counts[fault] += 1
            self.cost += sum(price[x] for x in edits)
            if fault == "truncated" and ("K" in edits or "R" in edits):
                self.cost += costs.truncated
            self.audit += edits.encode()
            for name, said in _turns(role, text, edits, made):
                self.hash.update(f"{'' if self.empty else chr(10)}{name}:{said}".encode())
                self.empty = False

        def row(self):
            gaps = 0 if self.first is None else self.turn - self.first + 1 - self.distinct
            found = [self.counts[f] for f in FAULTS[1:]]
            return (self.conv, gaps, *found, self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest())

    def run(batches):
        now = None
        for rows in _walk(batches):
            out = []
            for conv, *row in rows:
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.row())
                    now = Conversation(conv)
                now.add(*row)
            yield _batch(out, DIGEST)
        if now is not None:
            yield _batch([now.row()], DIGEST)

    return run


def digest(done: Repair, costs: Costs = Costs()) -> DataFrame:
    """A row for each conversation of the plan: counts of faults and gaps, cost, audit, and a hash of
    the repaired turns as ``role:text``, joined by newlines.
    """
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _merged(done).mapInArrow(_digests(costs), schema)


def with_lost(digests: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds the conversations of ``rows`` of which no row was left."""
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = digests.withColumn("_there", F.lit(True))
    joined = join_groups(ids, found, ["conv_id"], null_group=True).drop("_there")
    numbers = {n: F.coalesce(n, F.lit(0).cast("long")) for n, t in DIGEST[1:] if t == pa.int64()}
    empty = hashlib.sha256().hexdigest()
    return joined.withColumns({**numbers, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(empty))})
