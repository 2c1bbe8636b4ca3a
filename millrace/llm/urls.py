"""URL filter: host and path rules, and for the rest a ratio of two character language models.

A model is a smoothed variable-order Markov model of UTF-8 bytes: the probability of a byte after
its context of up to ``order`` bytes interpolates, from the shortest context to the longest,
the counts of the context with the estimate of the one shorter (Witten-Bell weights; below order
zero uniform over the 256 bytes and the end, so the probabilities sum to one for any text). One model is learnt from URLs that rules accept, one from those they reject.
The score of a URL is the difference of its log likelihoods divided by its bytes and the end; the
threshold is calibrated on URLs kept out of the counts, for the least mean error of both classes.

The models are learnt from all distinct URLs that a rule judges, of any length: in the order of their
hashes every fifth of a class calibrates, the others count. A model has an entry for each byte
after each context, and these grow with the URLs, so no task and no driver holds a model:

1. URLs are dealt into chunks. A chunk sends each *window*, a byte with the ``order`` symbols before
   it, once, with the number of times it occurs in the URLs that count, of either class.
2. Counts of shorter contexts are sums over windows with the same end. The probabilities of the last
   symbols of all windows are joined from the shortest context to the longest.
3. Each chunk gets the log ratio of its windows back and adds it up for its URLs.
4. The threshold is found by running counts over the scores of all URLs that calibrate.

`MarkovModel`, `ratio` and `calibrated` are the same for texts in one process.

Edge cases: a null URL, or one without ``://``, has an empty host and path and no rule; it is
judged by its text, null as empty. Without ``://`` rules never fit. An empty text gets ratio 0
and is allowed if 0 reaches the threshold. If a class has no URLs, its model is uniform and the
threshold 0. Repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import drop, stage

ORDER = 4
#: Bounds of the number and the length of the URLs to learn from: none.
SAMPLE, LONGEST = None, math.inf
CHUNK_BYTES = 256 << 10
#: Ranges of hashes, and of scores, that are put in order each by itself.
RANGES = 1 << 16
#: Next symbols: the bytes and the end. The marks of begin and end are no bytes.
ALPHABET = 257
BEGIN, END = "\u0100", "\u0101"
#: Symbols with both marks; a window is a number with one digit a symbol, the last one lowest.
BASE = 258


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = [
    Rule("com", "/", True),
    Rule("example.com", "/en/", False),
    Rule("www.example.com", "/en/", True),
    Rule("net", "/es/", False),
    Rule("net", "/fr/", False),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[F.Column, F.Column]:
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: F.Column, path: F.Column, rules: list[Rule]) -> tuple[F.Column, F.Column]:
    """The text and the verdict of the longest rule that fits, else null."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit("allow" if rule.allow else "block")).otherwise(verdict)
    return text, verdict


def symbols(text: str, order: int) -> str:
    """The UTF-8 bytes of a text, one character each, between marks."""
    return BEGIN * order + text.encode("utf-8", "surrogatepass").decode("latin-1") + END


def context_counts(texts: list[str], order: int) -> dict[str, Counter]:
    """How often each byte follows each context of up to ``order`` bytes."""
    counts: dict[str, Counter] = {}
    for text in texts:
        padded = symbols(text, order)
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts.setdefault(padded[i - k : i], Counter())[padded[i]] += 1
    return counts


class MarkovModel:
    def __init__(self, counts: dict[str, Counter], order: int):
        self.order, self.counts = order, counts
        self.totals = {c: sum(n.values()) for c, n in counts.items()}

    def log_likelihood(self, text: str) -> float:
        padded = symbols(text, self.order)
        total = 0.0
        for i in range(self.order, len(padded)):
            p = 1 / ALPHABET
            for k in range(self.order + 1):
                seen = self.counts.get(padded[i - k : i])
                if seen is None:
                    break
                n = self.totals[padded[i - k : i]]
                p = (seen.get(padded[i], 0) + len(seen) * p) / (n + len(seen))
            total += math.log(p)
        return total


def ratio(models: tuple[MarkovModel, MarkovModel], text: str) -> float:
    if not text:
        return 0.0
    return (models[0].log_likelihood(text) - models[1].log_likelihood(text)) / (len(text.encode("utf-8", "surrogatepass")) + 1)


def calibrated(accepted: list[float], rejected: list[float]) -> float:
    """The threshold with the least sum of both classes' error rates; the middle of its gap."""
    if not accepted or not rejected:
        return 0.0
    marks = sorted([(x, 1) for x in accepted] + [(x, 0) for x in rejected])
    below = {1: 0, 0: 0}
    best, at = 1.0, marks[0][0]
    for i, (x, kind) in enumerate(marks):
        below[kind] += 1
        if i + 1 < len(marks) and marks[i + 1][0] > x:
            error = below[1] / len(accepted) + 1 - below[0] / len(rejected)
            if error < best:
                best, at = error, (x + marks[i + 1][0]) / 2
    return at


def windows(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of every byte and end of the texts, and the place of its text in the list."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts)), lengths)
    symbols = np.full(lengths.sum() + (order + 1) * len(texts), ord(BEGIN), np.int64)
    symbols[np.arange(len(of)) + (order + 1) * of + order] = np.frombuffer(b"".join(texts), np.uint8)
    symbols[np.cumsum(lengths + order + 1) - 1] = ord(END)
    at = np.flatnonzero(symbols != ord(BEGIN))
    return sum(symbols[at - j] * BASE**j for j in range(order + 1)), np.repeat(np.arange(len(texts)), lengths + 1)


def in_chunks(judged: DataFrame) -> tuple[DataFrame, int]:
    """All distinct texts but the empty one, with ``by_rule``, ``held`` (calibrates) and ``chunk``; the number of chunks."""
    distinct = judged.where("url != ''").groupBy("url").agg(F.first("by_rule").alias("by_rule"), F.xxhash64("url").alias("h"))
    distinct = stage(distinct.withColumn("range", F.shiftright("h", 48)), "urls")
    size = distinct.agg(F.sum(F.octet_length("url"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    known = distinct.where("by_rule IS NOT NULL")
    earlier = Window.partitionBy("by_rule").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = known.groupBy("by_rule", "range").agg(F.count("*").alias("n"))
    starts = starts.select("by_rule", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("by_rule", "range").orderBy("h", "url")) - 1
    known = known.withColumn("place", place).join(starts, ["by_rule", "range"])
    rows = known.select("url", "by_rule", "h", ((F.col("start") + F.col("place")) % 5 == 0).alias("held"))
    rows = rows.union(distinct.where("by_rule IS NULL").select("url", "by_rule", "h", F.lit(False)))
    out = stage(rows.select("url", "by_rule", "held", F.pmod("h", F.lit(chunks)).alias("chunk")), "urls")
    drop(distinct)
    return out, chunks


def ask(order: int):
    """A chunk's distinct windows, with their counts in the URLs that count of each class."""

    def run(table: pa.Table) -> pa.Table:
        found, of = windows(table.column("text").to_pylist(), order)
        found, at = np.unique(found, return_inverse=True)
        counts = {v: np.array([x == v for x in table.column("counts").to_pylist()])[of] for v in ("allow", "block")}
        columns = {v: np.bincount(at, weights=c, minlength=len(found)).astype(np.int64) for v, c in counts.items()}
        chunk = np.full(len(found), table.column("chunk")[0].as_py(), np.int64)
        return pa.table({"chunk": chunk, "window": found, **columns})

    return run


def log_ratios(asked: DataFrame, order: int) -> DataFrame:
    """``window`` and ``ratio``: how much likelier the accepting model finds its last symbol, as a logarithm."""
    counts = stage(asked.groupBy("window").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "windows")
    known = None
    for k in range(order + 1):
        own = counts.groupBy((F.col("window") % BASE ** (k + 1)).alias("window")).agg(*(F.sum(v).alias(v) for v in ("allow", "block")))
        after = Window.partitionBy(F.expr(f"window div {BASE}"))
        for v in ("allow", "block"):
            own = own.withColumns({f"n_{v}": F.sum(v).over(after), f"d_{v}": F.sum((F.col(v) > 0).cast("long")).over(after)})
        if known is None:
            own = own.withColumns({f"p_{v}": F.lit(1 / ALPHABET) for v in ("allow", "block")})
        else:
            own = own.withColumn("shorter", F.col("window") % BASE**k).join(known.withColumnRenamed("window", "shorter"), "shorter")
        p = {v: (F.col(v) + F.col(f"d_{v}") * F.col(f"p_{v}")) / (F.col(f"n_{v}") + F.col(f"d_{v}")) for v in ("allow", "block")}
        known = own.select("window", *(F.when(F.col(f"n_{v}") > 0, p[v]).otherwise(F.col(f"p_{v}")).alias(f"p_{v}") for v in p))
    ratios = stage(known.select("window", (F.log("p_allow") - F.log("p_block")).alias("ratio")), "ratios")
    drop(counts)
    return ratios


def add_up(order: int):
    """The scores of a chunk's URLs from the log ratios of its windows."""

    def run(table: pa.Table, ratios: pa.Table) -> pa.Table:
        texts = table.column("text").to_pylist()
        found, of = windows(texts, order)
        known, values = ratios.column("window").to_numpy(), ratios.column("ratio").to_numpy()
        sort = np.argsort(known)
        each = values[sort][np.searchsorted(known, found, sorter=sort)]
        score = np.bincount(of, weights=each, minlength=len(texts)) / np.bincount(of, minlength=len(texts))
        return table.select(["url", "by_rule", "held"]).append_column("score", pa.array(score))

    return run


def threshold_of(held: DataFrame) -> float:
    """`calibrated` for any number of scores: running counts inside ranges of scores, and over the ranges."""
    marks = held.groupBy("score").agg(*(F.count_if(F.col("by_rule") == v).alias(v) for v in ("allow", "block")))
    low, high, accepted, rejected = marks.agg(F.min("score"), F.max("score"), F.sum("allow"), F.sum("block")).first()
    if not accepted or not rejected:
        return 0.0
    step = (high - low) / RANGES or 1.0
    marks = marks.withColumn("range", F.floor((F.col("score") - low) / step))
    order = Window.orderBy("range")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ranges = marks.groupBy("range").agg(F.sum("allow").alias("a"), F.sum("block").alias("b"), F.min("score").alias("first"))
    starts = ranges.select("range", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in "ab"), F.lead("first").over(order).alias("later"))
    inside = Window.partitionBy("range").orderBy("score")
    below = {c: F.sum(v).over(inside) + F.col(c) for c, v in (("a", "allow"), ("b", "block"))}
    error = below["a"] / F.lit(accepted) + 1 - below["b"] / F.lit(rejected)
    gaps = marks.join(starts, "range").select("score", F.coalesce(F.lead("score").over(inside), "later").alias("next"), error.alias("error"))
    best = gaps.where("next IS NOT NULL").orderBy("error", "score").limit(1).collect()
    return (best[0].score + best[0].next) / 2 if best and best[0].error < 1 else low


def learn(judged: DataFrame, order: int) -> tuple[DataFrame, float]:
    """``url`` and ``score`` of all distinct URLs but the empty one, and the threshold."""
    texts, chunks = in_chunks(judged)
    counts = F.when(~F.col("held"), F.col("by_rule")).alias("counts")
    dealt = texts.repartition(chunks, "chunk")
    asked = dealt.select("chunk", F.col("url").cast("binary").alias("text"), counts).groupBy("chunk").applyInArrow(ask(order), "chunk long, window long, allow long, block long")
    asked = stage(asked, "asked")
    ratios = log_ratios(asked, order)
    answers = asked.select("chunk", "window").join(ratios, "window").repartition(chunks, "chunk").groupBy("chunk")
    dealt = dealt.withColumn("text", F.col("url").cast("binary")).groupBy("chunk")
    scores = stage(dealt.cogroup(answers).applyInArrow(add_up(order), "url string, by_rule string, held boolean, score double"), "scores")
    for df in (texts, asked, ratios):
        drop(df)
    return scores.select("url", "score"), threshold_of(scores.where("held"))


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: list[Rule] = RULES, order: int = ORDER) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score`` (log-likelihood
    ratio per byte, the decision where no rule fits). ``order`` is at most 6, so that a window is one number.
    """
    if not 0 <= order <= 6:
        raise ValueError("order must be 0 to 6")
    base = pages.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"))

    def judged(rows: DataFrame) -> DataFrame:
        host, path = host_and_path("url")
        rows = rows.withColumns({"host": host, "path": path})
        rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
        return rows.withColumns({"rule": rule, "by_rule": verdict})

    scores, threshold = learn(judged(base), order)
    scored = judged(base.join(scores, "url", "left")).withColumn("score", F.coalesce("score", F.lit(0.0)))
    decided = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("id", "host", "path", "rule", F.coalesce("by_rule", decided).alias("verdict"), "score")
