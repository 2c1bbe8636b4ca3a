"""Mixing sources to target weights, by hierarchical token budgets.

Documents are leaves of a tree, here domain, language and source. A node's capacity is the
tokens below it times the number of epochs allowed. A budget is passed down from the root: the
children of a node share its budget by weight, and a child that cannot take its share leaves it
to its siblings. As a node is never given more than its capacity, a shortage goes to siblings
first, and reaches the ancestor's siblings only if all of them are full.

For one node with children of capacity c and weight w, in the order of c / w, a child is full if
``(B - sum of c before) w >= c (sum of w from it on)``; the others share what the full ones
leave. All is whole-number arithmetic, shares are rounded down.

A leaf's quota is taken from epochs: in each one its documents are ordered by a seeded hash.
Whole epochs come first, then the longest prefix of the next one that fits the rest. Sums over
ranges of the hash find the one range in which the prefix ends, so only that range is sorted:
no task ever holds a leaf.

Edge cases: null language or source is the leaf of the empty name; null and empty texts have no
tokens, cost nothing and are taken with the prefix they fall into; nodes without weight get
nothing; a budget beyond all capacity takes every epoch whole; rows with a null id are left out;
repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import stage

RANGE_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"
WIDE = "decimal(20,0)"


@dataclass(frozen=True)
class Mix:
    """``domain`` is an SQL expression over the documents; weights not named are 1."""

    domain: str
    domain_weights: dict[str, int] = field(default_factory=dict)
    lang_weights: dict[str, int] = field(default_factory=dict)
    source_weights: dict[str, int] = field(default_factory=dict)
    percent: int = 60
    epochs: int = 2
    seed: int = 1


LEVELS = ["domain", "lang", "source"]


def weight(level: str, weights: dict[str, int]) -> F.Column:
    out = F.lit(1)
    for name, value in sorted(weights.items()):
        out = F.when(F.col(level) == name, value).otherwise(out)
    return out


def share(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds ``quota`` to nodes with ``capacity``, ``weight`` and their parent's ``budget``."""
    whole = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = whole.orderBy(F.col("capacity").cast("double") / F.col("weight"), name)
    ahead = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    full = (F.col("budget") - ahead).cast(WIDE) * F.col("weight") >= F.col("capacity").cast(WIDE) * behind
    nodes = nodes.where("weight > 0").withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0))
    left = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    nodes = nodes.withColumns({"taken": taken, "left": left})
    exact = F.expr(f"(cast(budget - taken AS {WIDE}) * weight) div left")
    return nodes.withColumn("quota", F.when(F.col("full"), F.col("capacity")).otherwise(exact)).drop("full", "taken", "left")


def quotas(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Quota of every leaf, from ``tokens`` per leaf."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * mix.epochs)
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    weights = [mix.domain_weights, mix.lang_weights, mix.source_weights]
    given = None
    for depth, (level, own) in enumerate(zip(LEVELS, weights, strict=True)):
        path = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", weight(level, own))
        if given is None:
            nodes = nodes.withColumn("total", total).withColumn("budget", F.expr(f"total * {mix.percent} div 100"))
        else:
            nodes = nodes.join(given, path[:-1])
        given = share(nodes, path[:-1], level).select(*path, F.col("quota").alias("budget"))
    return given.withColumnRenamed("budget", "quota").join(leaves, LEVELS)


def mixed(docs: DataFrame, mix: Mix, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``id``, ``epoch``, ``domain``, ``lang``, ``source`` and ``n_tokens`` of every selected document,
    once for each epoch that takes it.
    """
    base = docs.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.expr(mix.domain), F.lit("")).alias("domain"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )
    base = stage(base, "leaves")
    leaves = quotas(base.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), mix)
    whole = F.when(F.col("tokens") > 0, F.expr("least(quota div tokens, capacity div tokens)")).otherwise(F.lit(mix.epochs)).cast("int")
    leaves = stage(leaves.withColumn("whole", whole).withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens")), "quotas")
    placed = base.join(leaves.select(*LEVELS, "whole", "rest"), LEVELS)
    every = placed.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
    columns = ["id", "epoch", *LEVELS, "n_tokens"]

    last = placed.where(F.col("whole") < mix.epochs).withColumn("epoch", F.col("whole"))
    last = last.withColumn("place", F.md5(F.concat_ws(":", F.lit(str(mix.seed)), "epoch", "id")))
    last = last.withColumn("range", F.substring("place", 1, RANGE_DIGITS))
    ranges = last.groupBy(*LEVELS, "range").agg(F.sum("n_tokens").alias("sum"))
    running = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("sum").over(running), F.lit(0)))
    met = last.join(ranges, [*LEVELS, "range"]).where("before <= rest")
    inside = met.where(F.col("before") + F.col("sum") <= F.col("rest"))
    edge = met.where(F.col("before") + F.col("sum") > F.col("rest"))
    order = Window.partitionBy(*LEVELS, "range").orderBy("place", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("until", F.col("before") + F.sum("n_tokens").over(order)).where("until <= rest")
    return every.select(columns).unionByName(inside.select(columns)).unionByName(edge.select(columns))


def oracle(mix: Mix) -> str:
    """The same in DuckDB's SQL, with one window over each leaf."""

    def case(level: str, weights: dict[str, int]) -> str:
        return "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {v}" for n, v in sorted(weights.items())) + " ELSE 1 END" if weights else "1"

    steps, weights = [], [mix.domain_weights, mix.lang_weights, mix.source_weights]
    for depth, (level, own) in enumerate(zip(LEVELS, weights, strict=True)):
        path, up = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        over = f"PARTITION BY {up}" if up else ""
        order = f"{over} ORDER BY capacity::DOUBLE / weight, {level}"
        budget = f"(SELECT sum(tokens)::BIGINT * {mix.percent} // 100 FROM leaf)" if not up else "quota"
        source = f"leaf JOIN l{depth} USING ({up})" if up else "leaf"
        group = f"{path}, quota" if up else path
        steps.append(f"""
            n{depth} AS (SELECT {path}, sum(leaf.capacity)::BIGINT AS capacity, {case(level, own)} AS weight, {budget} AS budget
                FROM {source} GROUP BY {group}),
            f{depth} AS (SELECT *, (budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
                >= capacity::HUGEINT * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS full_ FROM n{depth}),
            l{depth + 1} AS (SELECT {path}, CASE WHEN full_ THEN capacity ELSE ((budget - coalesce(sum(CASE WHEN full_ THEN capacity END) OVER ({over}), 0))::HUGEINT
                * weight // sum(CASE WHEN NOT full_ THEN weight END) OVER ({over}))::BIGINT END AS quota FROM f{depth})""")
    return f"""
        WITH d AS (SELECT doc_id, {mix.domain} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens FROM documents),
            leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, {mix.epochs} * sum(n_tokens)::BIGINT AS capacity FROM d GROUP BY ALL),
            {",".join(steps)},
            q AS (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE {mix.epochs} END AS whole FROM l3 JOIN leaf USING (domain, lang, source)),
            e AS (SELECT d.*, unnest(range({mix.epochs})) AS epoch FROM d),
            r AS (SELECT doc_id, epoch, domain, lang, source, n_tokens, whole, quota - whole * tokens AS rest,
                sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY md5('{mix.seed}:' || epoch || ':' || doc_id)
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
                FROM e JOIN q USING (domain, lang, source))
        SELECT doc_id, epoch::INTEGER AS epoch, domain, lang, source, n_tokens FROM r
        WHERE epoch < whole OR (epoch = whole AND until <= rest)
    """
