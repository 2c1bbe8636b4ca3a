"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. Every text gives a fixed list of statistics (shares of byte classes, word shapes, repetition,
   line shapes), computed on whole texts in one pass.
2. Random Fourier features ``sqrt(2/D) cos(W x + b)`` of the standardised statistics approximate
   a Gaussian kernel. Each task sums the normal equations of its rows, ``Z'Z`` and ``Z'y``; the
   sums are added by row of the matrix, and the D x D system is solved on the driver (D is a
   parameter, so its size is fixed).
3. Part of the labelled rows (``CALIBRATE`` in 10) is kept out of the fit. Their scores are
   counted on a grid of ``GRID`` steps, and pool-adjacent-violators turns the grid into an
   isotonic probability, interpolated between the pools' centres.

All labelled rows are used; language, source, ids and labels are no statistics.

Edge cases: null and empty texts have all statistics zero and are scored like any text; label
rows without a document, with a null id or a null quality are not used; several labels of one
document are averaged; without usable labels the score is 0.5 for all, with labels of one kind
it is that kind's share; repeated documents are scored each; an empty table gives an empty
result. Other columns travel in one struct and may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import drop, stage
from millrace.llm.words import PIECE, Words, slices

FEATURES = 384
GAMMA = 0.02
RIDGE = 1e-3
GRID = 512
CALIBRATE = 3
SEED = 11
#: Bytes of text that a worker measures at once; its arrays take some 50 bytes for each of them.
SLICE = PIECE // 2

#: Classes of bytes; the rest (all of multi-byte characters) is the last class.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\r\n", ".,;:?!'\"()-", "!", "|", "*#$%&@^~=+<>{}[]\\/_`"]

STATISTICS = (
    [f"share_{k}" for k in range(len(CLASSES) + 1)]
    + ["log_words", "word_length", "word_length_spread", "longest_word", "upper_words", "capital_words", "odd_endings", "symbol_words"]
    + ["same_as_last", "distinct_words", "log_lines", "line_words", "stopped_words", "distinct_pairs"]
)


def class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), dtype=np.uint8)
    for k, chars in enumerate(CLASSES):
        table[list(chars.encode())] = k
    return table


def statistics(column) -> np.ndarray:
    """One row of :data:`STATISTICS` per text."""
    words = Words(column)
    n = len(words.count)
    kinds = class_table()[words.data]
    text_of_byte = np.repeat(np.arange(n), np.diff(words.offsets))
    width = len(CLASSES) + 1
    shares = np.bincount(text_of_byte * width + kinds, minlength=n * width).reshape(n, width).astype(np.float64)
    lines = shares[:, 4] + 1
    size = np.maximum(shares.sum(axis=1), 1)
    text, count = words.text_of_word(), np.maximum(words.count, 1)
    mean = lambda values: np.bincount(text, weights=values, minlength=n) / count
    length = (words.end - words.start).astype(np.float64)
    before = np.concatenate([[0], np.cumsum(kinds == 1)])
    symbols = np.concatenate([[0], np.cumsum((kinds == 6) | (kinds == 7) | (kinds == 8))])
    uppers = before[words.end] - before[words.start]
    marks = symbols[words.end] - symbols[words.start]
    hashes = words.hashes()
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((hashes, text))
    new = np.ones(len(hashes))
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order], weights=new, minlength=n) / count
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) > 1 else hashes[:0]
    inside = np.flatnonzero(text[1:] == text[:-1]) if len(text) > 1 else np.zeros(0, np.int64)
    order = inside[np.lexsort((pairs[inside], text[inside]))]
    new = np.ones(len(order))
    new[1:] = (pairs[order][1:] != pairs[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct_pairs = np.bincount(text[order], weights=new, minlength=n) / np.maximum(words.count - 1, 1)
    last = kinds[words.end - 1] if len(hashes) else kinds[:0]
    average = mean(length)
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    return np.column_stack([
        shares / size[:, None],
        np.log1p(words.count), average, np.sqrt(np.maximum(mean(length**2) - average**2, 0)), np.log1p(longest),
        mean((uppers == length) & (length > 1)), mean(uppers > 0), mean((last == 6) | (last == 8)), mean(marks == length),
        mean(same), distinct, np.log(lines), np.log1p(words.count / lines), mean(last == 5), distinct_pairs,
    ])


def measure(batches):
    for batch in batches:
        for part in slices(batch, "text", 1_000, SLICE):
            stats = statistics(part.column("text"))
            lists = pa.ListArray.from_arrays(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32), stats.reshape(-1))
            kept = [part.column(c) for c in range(part.num_columns) if part.schema.names[c] != "text"]
            names = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=[*names, "stats"])


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``stats`` of every document."""
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return base.mapInArrow(measure, "id long, stats array<double>")


def to_matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy().reshape(len(lists), len(STATISTICS))


class Features:
    """Random Fourier features of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, size: int, gamma: float, seed: int = SEED):
        self.mean, self.spread = mean, spread
        draw = np.random.default_rng(seed)
        self.weights = draw.standard_normal((len(mean), size)) * np.sqrt(2 * gamma)
        self.shift = draw.uniform(0, 2 * np.pi, size)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        z = np.sqrt(2 / len(self.shift)) * np.cos(x @ self.weights + self.shift)
        return np.column_stack([z, np.ones(len(x))])


def normal_equations(features: Features):
    """Each task's sums, one row for every row of the matrix ``[Z'Z | Z'y]``."""

    def run(batches):
        total = None
        for batch in batches:
            z = features(to_matrix(batch.column("stats")))
            own = z.T @ np.column_stack([z, batch.column("y").to_numpy(zero_copy_only=False)])
            total = own if total is None else total + own
        if total is not None:
            lists = pa.ListArray.from_arrays(np.arange(0, total.size + 1, total.shape[1], dtype=np.int32), total.reshape(-1))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), lists], names=["i", "values"])

    return run


def add_rows(table: pa.Table) -> pa.Table:
    values = table.column("values").combine_chunks()
    total = values.flatten().to_numpy().reshape(len(values), -1).sum(axis=0)
    return pa.table({"i": table.column("i").slice(0, 1), "values": pa.array([total.tolist()], pa.list_(pa.float64()))})


def isotonic(x: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; centres and levels of the pools."""
    pools: list[list[float]] = []
    for v, p, c in zip(x, positive, count, strict=True):
        pools.append([v * c, p, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    pools_ = np.array(pools)
    return pools_[:, 0] / pools_[:, 2], pools_[:, 1] / pools_[:, 2]


class Model:
    """Score of statistics: calibrated ridge regression, or a constant."""

    def __init__(self, constant: float, features: Features | None = None, weights=None, grid=None):
        self.constant, self.features, self.weights, self.grid = constant, features, weights, grid

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.constant)
        return np.clip(np.interp(self.raw(stats), *self.grid), 0.0, 1.0)


def fit(stats: DataFrame, size: int = FEATURES, gamma: float = GAMMA, ridge: float = RIDGE) -> Model:
    """``stats`` has ``id``, ``stats`` and the label ``y`` (0 to 1)."""
    sums = [F.avg("y"), F.count("*"), F.min("y"), F.max("y")]
    sums += [f(F.col("stats")[k]) for k in range(len(STATISTICS)) for f in (F.avg, F.stddev_pop)]
    found = list(stats.agg(*sums).first())
    if not found[1]:
        return Model(0.5)
    if found[2] == found[3]:
        return Model(float(found[0]))
    mean, spread = np.array(found[4::2], dtype=float), np.array(found[5::2], dtype=float)
    features = Features(mean, np.where(spread > 1e-9, spread, 1.0), size, gamma)
    held = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(10)) < CALIBRATE
    sums = stats.where(~held).mapInArrow(normal_equations(features), "i int, values array<double>")
    rows = sums.groupBy("i").applyInArrow(add_rows, "i int, values array<double>").orderBy("i").collect()
    if not rows:
        return Model(float(found[0]))
    both = np.array([r["values"] for r in rows])
    gram, right = both[:, :-1], both[:, -1]
    weights = np.linalg.solve(gram + ridge * gram[-1, -1] * np.eye(len(gram)) / size, right)
    model = Model(float(found[0]), features, weights)

    def raw(batches):
        for batch in batches:
            values = pa.array(model.raw(to_matrix(batch.column("stats"))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("y"), values], names=["y", "raw"])

    step = F.round(F.least(F.greatest(F.col("raw"), F.lit(-1.0)), F.lit(2.0)) * (GRID / 3)).cast("int")
    counts = stats.where(held).select("y", "stats").mapInArrow(raw, "y double, raw double").groupBy(step.alias("step"))
    grid = counts.agg(F.avg("raw"), F.sum("y"), F.count("*")).orderBy("step").collect()
    if not grid:
        model.grid = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    else:
        model.grid = isotonic(*(np.array(column, dtype=float) for column in list(zip(*grid, strict=True))[1:]))
    return model


def training_rows(stats: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Measured documents with a label, but for those held out: crc32 of the id as text, modulo 3, is 1."""
    own = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull())
    own = own.groupBy(F.col(key).cast("long").alias("id")).agg(F.avg(F.col(quality).cast("double")).alias("y"))
    return stats.where(~held_out("id")).join(own, "id")


def held_out(key: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def train(stats: DataFrame, labels: DataFrame) -> Model:
    rows = stage(training_rows(stats, labels), "training")
    model = fit(rows)
    drop(rows)
    return model


def keep_good(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores ``least`` or more."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text_", 1_000, SLICE):
                good = model.score(statistics(part.column("text_"))) >= least
                yield part.select(part.schema.names[:-1]).filter(pa.array(good))

    schema = docs.schema
    return docs.withColumn("text_", F.col(text).cast("string")).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``held_out``, ``score`` (probability of quality 1) and ``predicted`` of every document."""
    stats = stage(measured(docs, key, text), "statistics")
    model = train(stats, labels)

    def score(batches):
        for batch in batches:
            values = pa.array(model.score(to_matrix(batch.column("stats"))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), values], names=["id", "score"])

    scored = stats.mapInArrow(score, "id long, score double")
    return scored.select("id", held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
