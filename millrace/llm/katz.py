"""Katz backoff language model of words: trained on part of a corpus, scoring all of it.

P(w | v) = d(c(v w)) c(v w) / c(v)   if the pair was seen in training,
         = alpha(v) P(w)             else;
P(w)     = d(c(w)) c(w) / N          if the word was seen, else the mass that is left.

``d`` are Good-Turing discounts of counts up to 5 (none above), from the counts of counts of
all training n-grams of the order, smoothed by a log-linear fit. ``alpha(v)`` makes the probabilities over all seen words and
the unknown word sum to one: what the discounts of v leave, over what the words seen after v
leave of P. Texts start in the context of a begin sign and end with an end token.

Tables are partitioned by hash and never gathered: a bucket of the first exchange
(:mod:`millrace.llm.exchange`) holds the counts of its words, a bucket of the second the counts
of all pairs of its contexts, with the sums that alpha needs. A context that occurs more than
``SPLIT`` times is dealt by ranges of its continuations' hashes, each with a key of its own: counts
are exact within a range, and a chunk adds up the sums of the ranges. Chunks of documents send their
distinct words and pairs with their training counts, and get back the corpus counts in the same
order, so that each token is evaluated where its document is. Counts of counts come back with
every answer. What travels grows with the corpus; the driver gets nothing.

Words are told apart by 64-bit hashes, continuations of one context by 40 bits.

Edge cases: a null or empty text has one token, the end; documents of any length are whole;
rows with a null id are not trained on and count as not held out; repeated rows are counted as
often as they occur; without training documents every token has probability one in the model
(there is only the unknown word); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.exchange import PACKET, answered, bucket_edges, chunked, first_of_runs, pack, pack_sorted, unpack, unpack_sorted
from millrace.llm.words import Words, mix

END = np.uint64(0x3C6EF372FE94F82B)
BEGIN = np.uint64(0xA54FF53A5F1D36F1)
TOP = 5
#: Larger chunks repeat fewer words and pairs between them.
CHUNK_BYTES = 8 << 20
WORDS, PAIRS = 1, 2
#: Training occurrences of a context in one range of continuations, about.
SPLIT = 1 << 20
RANGE = np.uint64(0xD1B54A32D192ED03)
#: Bits of a word's hash that tell it apart among the continuations of one context.
KEEP_BITS = np.uint64(40)


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    """How many n-grams occur 1 .. TOP + 1 times."""
    return np.bincount(np.minimum(counts, TOP + 2), minlength=TOP + 3)[1 : TOP + 2]


def slope_of(n: np.ndarray) -> float | None:
    """Slope b of the line of Simple Good-Turing, ``log n(r) = a + b log r``, if n(1) and n(2) are known.

    Missing counts are averaged into their neighbours. The slope is kept at -1 or steeper, the
    best fit for which tokens do not gather at higher counts.
    """
    some = np.flatnonzero(n > 0) + 1.0
    if n[0] <= 0 or n[1] <= 0:
        return None
    below = np.concatenate([[0.0], some[:-1]])
    above = np.append(some[1:], 2 * some[-1] - below[-1])
    y = np.log(n[n > 0] / (0.5 * (above - below)))
    x = np.log(some)
    x -= x.mean()
    return min(-1.0, float(x @ y / (x @ x)))


def discounts(n: np.ndarray) -> np.ndarray:
    """Factors for counts 0 .. TOP from the counts of counts; 0 and 1 where nothing is known.

    Katz's formula on the smoothed counts of counts; its values always rise with the count
    between 0 and 1. Only where no n-gram occurs twice there is no line to fit, and counts are
    lowered by one half; where none occurs once, nothing is discounted.
    """
    out = np.ones(TOP + 1)
    n = n.astype(np.float64)
    r = np.arange(1, TOP + 1)
    slope = slope_of(n)
    if slope is not None:
        # n(r + 1) (r + 1) / (n(r) r) is a power of (r + 1) / r, and the cut the same of TOP + 1.
        rise, top = np.log1p(1 / r), np.log(TOP + 1)
        power = slope + 1
        out[1:] = 1 - rise / top if power > -1e-9 else 1 - np.expm1(power * rise) / np.expm1(power * top)
    elif n[0] > 0:
        out[1:] = 1 - 0.5 / r
    return out


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return np.where(counts > TOP, 1.0, factors[np.minimum(counts, TOP)]) * counts


class WordModel:
    """P(w) from the counts of the words of a chunk and the sums over all words."""

    def __init__(self, total: int, types: int, n: np.ndarray):
        self.total, self.types = total, types
        self.factors = discounts(n)
        low = np.arange(1, TOP + 1)
        lost = float((n[:TOP] * low * (1 - self.factors[1:])).sum())
        # Without discounts one token is set aside for the unknown word.
        self.scale = 1.0 / total if lost > 0 else 1.0 / (total + 1)
        self.unknown = lost / total if lost > 0 else 1.0 / (total + 1)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.factors) * self.scale, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.types + 1)))


def pack_runs(values: np.ndarray, per: np.ndarray) -> bytes:
    """Values that rise within runs of given lengths, as steps; each run starts with its first value."""
    steps = np.diff(values, prepend=np.uint64(0))
    starts = (np.cumsum(per) - per)[per > 0]
    steps[starts] = values[starts]
    return pack(steps)


def unpack_runs(data: bytes, per: np.ndarray) -> np.ndarray:
    sums = np.cumsum(unpack(data, np.uint64), dtype=np.uint64)
    starts = np.cumsum(per) - per
    ahead = np.concatenate([[np.uint64(0)], sums])[starts].astype(np.uint64)
    return sums - np.repeat(ahead, per)


class ChunkTokens:
    """Tokens of the documents of a chunk: the words of each text, then its end."""

    def __init__(self, table: pa.Table, split: int = SPLIT):
        self.table, self.split = table, split
        self.train = np.array(table.column("train"))
        words = Words(table.column("text"), lower=True)
        self.count = words.count + 1
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.text = np.repeat(np.arange(len(self.count)), self.count)
        tokens = np.full(len(self.text), END, dtype=np.uint64)
        ends = self.first[1:] - 1
        inner = np.ones(len(tokens), dtype=bool)
        inner[ends] = False
        tokens[inner] = words.hashes()
        order = np.argsort(tokens, kind="stable")
        first = first_of_runs(tokens[order])
        self.words = tokens[order][first]
        self.word = np.empty(len(tokens), dtype=np.int64)
        self.word[order] = np.cumsum(first) - 1
        self.trained = self.train[self.text]
        #: The word before each token; the number of words stands for the begin sign.
        self.before = np.empty(len(tokens), dtype=np.int64)
        self.before[1:] = self.word[:-1]
        self.before[self.first[:-1]] = len(self.words)

    def word_packets(self, buckets: int) -> pa.Table:
        counts = np.bincount(self.word[self.trained], minlength=len(self.words)).astype(np.uint64)
        edges = bucket_edges(self.words, buckets)
        return self._table([
            (pack_sorted(self.words[a:b]), [pack(counts[a:b])]) for a, b in zip(edges[:-1], edges[1:], strict=True)
        ])

    def hear_words(self, answers: pa.Table) -> None:
        got = [r for r in answered(answers) if len(r["more"]) == WORDS + 1]
        sums = sum(unpack(r["more"][0], np.int64) for r in got)
        self.counts = np.concatenate([unpack(r["more"][1], np.int64) for r in got])
        if len(self.counts) != len(self.words):
            raise RuntimeError("the answers do not fit the words of this chunk")
        self.sums = sums
        self.model = WordModel(int(sums[0]), int(sums[1]), sums[2:])
        self.p_word = self.model(self.counts)
        # Occurrences of each context in training; texts begin as often as they end.
        end = np.searchsorted(self.words, END)
        self.context_counts = np.append(self.counts, self.counts[end])
        self._pairs()

    def _pairs(self) -> None:
        """Distinct pairs whose two words were seen in training, sorted by context and word."""
        context_hash = np.append(self.words, BEGIN)
        ask = self.context_counts[self.before] > 0
        order_of = np.argsort(context_hash, kind="stable")
        place = np.empty(len(order_of), dtype=np.int64)
        place[order_of] = np.arange(len(order_of))
        # All contexts seen in training get an answer; a pair with an unknown word needs none.
        used = np.unique(place[self.before[ask]])
        self.context = np.full(len(order_of), -1, dtype=np.int64)
        self.context[order_of[used]] = np.arange(len(used))
        self.contexts = context_hash[order_of[used]]
        # Only documents that are not trained on can hold a pair that training has not seen.
        self.backs_off = np.zeros(len(used), dtype=np.uint8)
        self.backs_off[self.context[self.before[ask & ~self.trained]]] = 1
        known = np.flatnonzero(ask & (self.counts[self.word] > 0))
        context = self.context[self.before[known]]
        code = context * len(self.words) + self.word[known]
        order = np.argsort(code, kind="stable")
        first = first_of_runs(code[order])
        self.pair = np.full(len(self.word), -1, dtype=np.int64)
        number = np.empty(len(known), dtype=np.int64)
        number[order] = np.cumsum(first) - 1
        self.pair[known] = number
        code = code[order][first]
        self.pair_context, self.pair_word = code // max(1, len(self.words)), code % max(1, len(self.words))
        self.pair_trained = np.bincount(number[self.trained[known]], minlength=len(code)).astype(np.uint64)
        self._ranges(order_of[used])

    def _ranges(self, used: np.ndarray) -> None:
        """Cut hot contexts into ranges of the next word's hash; all chunks cut a context alike."""
        bits = np.ceil(np.log2(np.maximum(self.context_counts[used] / self.split, 1))).astype(np.uint64)
        parts = np.left_shift(np.uint64(1), bits).astype(np.int64)
        start = np.cumsum(parts) - parts
        owner = np.repeat(np.arange(len(used)), parts)
        part = (np.arange(len(owner)) - start[owner]).astype(np.uint64)
        keys = self.contexts[owner]
        cut = parts[owner] > 1
        keys[cut] = mix(keys[cut] ^ mix(part[cut] + RANGE))
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        #: Keys that are sent, in their order, and the context of each.
        self.keys, self.owner = keys[order], owner[order]
        some = bits[self.pair_context]
        own = np.zeros(len(some), dtype=np.int64)
        hot = some > 0
        own[hot] = (self.words[self.pair_word[hot]] >> (np.uint64(64) - some[hot])).astype(np.int64)
        self.pair_key = place[start[self.pair_context] + own]
        # Words of a context are sorted by hash, and stay so within a range.
        order = np.argsort(self.pair_key, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        has = self.pair >= 0
        self.pair[has] = rank[self.pair[has]]
        self.pair_context, self.pair_word, self.pair_key, self.pair_trained = (
            x[order] for x in (self.pair_context, self.pair_word, self.pair_key, self.pair_trained)
        )

    def pair_packets(self, buckets: int) -> pa.Table:
        edges = bucket_edges(self.keys, buckets)
        cuts = np.searchsorted(self.pair_key, edges)
        per = np.bincount(self.pair_key, minlength=len(self.keys)).astype(np.uint32)
        backs_off = self.backs_off[self.owner]
        rows = []
        for a, b, i, j in zip(edges[:-1], edges[1:], cuts[:-1], cuts[1:], strict=True):
            word = self.pair_word[i:j]
            rows.append((pack_sorted(self.keys[a:b]), [
                pack(per[a:b]), pack(backs_off[a:b]), pack_runs(self.words[word] >> (np.uint64(64) - KEEP_BITS), per[a:b]),
                pack(self.pair_trained[i:j]), pack(self.counts[word]), pack(self.sums),
            ]))
        return self._table(rows)

    def hear_pairs(self, answers: pa.Table) -> None:
        got = [r for r in answered(answers) if len(r["more"]) == PAIRS + 2]
        factors = discounts(sum(unpack(r["more"][0], np.int64) for r in got))
        pairs = np.concatenate([unpack(r["more"][1], np.int64) for r in got])
        low = np.concatenate([unpack(r["more"][2], np.uint32).reshape(-1, TOP) for r in got]).astype(np.float64)
        sums = np.concatenate([unpack(r["more"][3], np.uint64).view(np.float64) for r in got])
        if len(pairs) != len(self.pair_word) or len(sums) != len(self.keys):
            raise RuntimeError("the answers do not fit the pairs of this chunk")
        # Ranges of one context add up, in the same order in every chunk.
        sums = np.bincount(self.owner, weights=sums, minlength=len(self.contexts))
        low = np.stack([np.bincount(self.owner, weights=x, minlength=len(self.contexts)) for x in low.T], axis=1)
        total = np.zeros(len(self.contexts))
        has = self.context >= 0
        total[self.context[has]] = self.context_counts[has]
        lost = (low * np.arange(1, TOP + 1) * (1 - factors[1:])).sum(axis=1)
        # A context without discounts sets one occurrence aside.
        total, lost = np.where(lost > 0, total, total + 1), np.where(lost > 0, lost, 1.0)
        alpha = lost / total / (1 - sums)
        self.p_pair = discounted(pairs, factors) / total[self.pair_context]
        self.p_pair[pairs == 0] = -1.0
        self.alpha = alpha

    def log_probability(self) -> np.ndarray:
        """log10 P of every token after the one before it."""
        p = self.p_word[self.word]
        context = self.context[self.before]
        backed = np.where(context >= 0, self.alpha[np.maximum(context, 0)], 1.0) * p if len(self.alpha) else p
        seen = np.full(len(p), -1.0)
        asked = self.pair >= 0
        seen[asked] = self.p_pair[self.pair[asked]]
        return np.log10(np.where(seen > 0, seen, backed))

    def _table(self, rows: list) -> pa.Table:
        chunk = self.table.column("chunk")[0].as_py()
        return pa.table({
            "bucket": pa.array(range(len(rows)), pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int32()),
            "keys": pa.array([r[0] for r in rows], pa.binary()), "more": pa.array([r[1] for r in rows], pa.list_(pa.binary())),
        })


def answer_words(table: pa.Table) -> pa.Table:
    """Counts of the words of a bucket over all chunks, and the bucket's share of the sums."""
    rows = table.sort_by("chunk")
    keys = [unpack_sorted(k) for k in rows.column("keys").to_pylist()]
    sizes, keys = [len(k) for k in keys], np.concatenate(keys)
    own = np.concatenate([unpack(m[0], np.uint64) for m in rows.column("more").to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    first = first_of_runs(keys[order])
    total = np.add.reduceat(own[order], np.flatnonzero(first)) if len(keys) else own
    sums = np.concatenate([[total.sum(), (total > 0).sum()], counts_of_counts(total)])
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = total[np.cumsum(first) - 1]
    return answers_table(rows, [[pack(sums), pack(x)] for x in np.split(out, np.cumsum(sizes)[:-1])])


def answer_pairs(table: pa.Table) -> pa.Table:
    """Per packet: the corpus counts of its pairs; per context the number of continuations that
    occur 1 .. TOP times and, if the chunk may back off there, the sum of P(w) over all that occur.
    """
    rows = table.sort_by("chunk")
    more = rows.column("more").to_pylist()
    contexts = [unpack_sorted(k) for k in rows.column("keys").to_pylist()]
    per = [unpack(m[0], np.uint32).astype(np.int64) for m in more]
    n_contexts, n_pairs = [len(c) for c in contexts], [int(p.sum()) for p in per]
    names, context = np.unique(np.concatenate(contexts), return_inverse=True)
    of_pair = np.repeat(context, np.concatenate(per))
    asks = [unpack(m[1], np.uint8) for m in more]
    word = np.concatenate([unpack_runs(m[2], p) for m, p in zip(more, per, strict=True)])
    own = np.concatenate([unpack(m[3], np.uint64) for m in more]).astype(np.int64)
    sums = unpack(more[0][5], np.int64)
    lower = WordModel(int(sums[0]), int(sums[1]), sums[2:])(np.concatenate([unpack(m[4], np.int64) for m in more]))
    order = np.lexsort((word, of_pair))
    first = first_of_runs(of_pair[order]) | first_of_runs(word[order])
    at = np.flatnonzero(first)
    total = np.add.reduceat(own[order], at) if len(own) else own
    out = np.empty(len(own), dtype=np.int64)
    out[order] = total[np.cumsum(first) - 1]
    seen = total > 0
    home = of_pair[order][at]
    sums = np.bincount(home[seen], weights=lower[order][at][seen], minlength=len(names))
    low = np.zeros((len(names), TOP), dtype=np.uint32)
    few = seen & (total <= TOP)
    np.add.at(low, (home[few], total[few] - 1), 1)
    # Where a chunk does not back off it only has to know whether anything is discounted.
    some = np.zeros_like(low)
    some[:, 0] = low.any(axis=1)
    stats = pack(counts_of_counts(total))
    answers = [
        [stats, pack(pairs), pack(np.where(asked[:, None] > 0, low[mine], some[mine]).reshape(-1)), pack(np.where(asked, sums[mine], 0.0).view(np.uint64))]
        for pairs, mine, asked in zip(np.split(out, np.cumsum(n_pairs)[:-1]), np.split(context, np.cumsum(n_contexts)[:-1]), asks, strict=True)
    ]
    return answers_table(rows, answers)


def answers_table(rows: pa.Table, more: list[list[bytes]]) -> pa.Table:
    return pa.table({
        "bucket": rows.column("bucket"), "chunk": rows.column("chunk"),
        "keys": pa.array([b""] * len(more), pa.binary()), "more": pa.array(more, pa.list_(pa.binary())),
    })


def ask_words(buckets: int):
    return lambda table: ChunkTokens(table).word_packets(buckets)


def ask_pairs(buckets: int, split: int = SPLIT):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = ChunkTokens(table, split)
        chunk.hear_words(answers)
        return chunk.pair_packets(buckets)

    return run


def score(split: int = SPLIT):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = ChunkTokens(table, split)
        chunk.hear_words(answers)
        chunk.hear_pairs(answers)
        add = lambda values: np.add.reduceat(values, chunk.first[:-1])
        counts = chunk.counts[chunk.word]
        return pa.table({
            "id": table.column("id"),
            "train": table.column("train"),
            "n_tokens": pa.array(chunk.count, pa.int64()),
            "n_known": pa.array(add((counts > 0).astype(np.int64)), pa.int64()),
            "train_tokens": pa.array(np.full(len(chunk.count), chunk.model.total), pa.int64()),
            "base_score": pa.array(add(chunk.model.base(counts)), pa.float64()),
            "score": pa.array(add(chunk.log_probability()), pa.float64()),
        })

    return run


def katz_scores(docs: DataFrame, train: str, key: str = "doc_id", text: str = "text",
                chunk_bytes: int = CHUNK_BYTES, split: int = SPLIT, **sizes) -> DataFrame:
    """``id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``
    (log10 probability of the text). ``train`` is a boolean SQL expression over ``id``.
    """
    dealt, layout = chunked(docs, key, text, chunk_bytes=chunk_bytes, **sizes)
    dealt = dealt.withColumn("train", F.coalesce(F.expr(train), F.lit(False)))
    by_chunk = dealt.groupBy("chunk")
    answer = lambda asked, f: asked.repartition(layout.buckets, "bucket").groupBy("bucket").applyInArrow(f, PACKET)
    words = answer(by_chunk.applyInArrow(ask_words(layout.buckets), PACKET), answer_words)
    pairs = answer(by_chunk.cogroup(words.groupBy("chunk")).applyInArrow(ask_pairs(layout.buckets, split), PACKET), answer_pairs)
    schema = "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_chunk.cogroup(words.union(pairs).groupBy("chunk")).applyInArrow(score(split), schema)
