"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens raised to an exponent and normalised. Bisection finds
the exponent: the one whose weights have a wanted entropy, below 1 to even sources out and above 1 to
set them apart, moved towards 1 where a source would be read more often than a limit allows. The
weights are then realised exactly to within one document:

* a source's budget is so many whole passes and a rest,
* a source is dealt into BLOCKS blocks by hash; every pass reads its blocks in a new permutation,
* the last pass takes whole blocks in that order while the rest lasts, and of the next block the
  documents in hash order while it lasts.

What is compared with the documents is one row per source, block and pass, whose number does not grow
with the documents. Place and cut of a block are found from block sums, and only the documents of one
block per source are ever sorted. The totals of up to MAX_SOURCES sources are bisected on the driver.
Of more sources, a histogram of their totals is, in steps of 1 / STEPS; exponents then differ by as
little, and weights and quotas are computed where the sources are.

Without a budget, the budget is the least for which every source is read whole at least once, so
no document is lost. A budget is a number of tokens or of passes over all tokens.

Rows: tokens are words; a null or empty text has none and is taken in every whole pass and in the
last one with its block. A null source is a source. Repeated rows are documents like others and
tie with each other: equal ids are taken together, up to the budget. A source without tokens is
read once. Very long texts are counted whole. ``detail`` replaces a column of that name; others pass
through. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from candlewick.llm.common import SPACES, free_name, stored, without

BLOCKS = 256
MAX_SOURCES = 10_000
STEPS = 4096
SEED = 17
BISECTIONS = 60
MOST_EXPONENT = 64.0
# The passes of so many blocks are sent to every task; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Target:
    """``entropy`` is relative to that of equal weights; ``repeats`` bounds passes over a source.
    ``budget`` is in tokens, ``read`` in passes over all tokens."""

    entropy: float | None = None
    repeats: float | None = None
    budget: int | None = None
    read: float | None = None

    def tokens(self, total: int) -> int | None:
        return round(self.read * total) if self.read is not None else self.budget


Counts = Sequence[int] | None


def _counted(tokens: Sequence[float], counts: Counts) -> list[tuple[float, int]]:
    return list(zip(tokens, counts or [1] * len(tokens), strict=True))


def weights(tokens: list[int], exponent: float, counts: Counts = None) -> list[float]:
    """The weight of each source; of several with the same total, given by ``counts``, that of one."""
    pairs = _counted(tokens, counts)
    total = sum(t * n for t, n in pairs)
    powers = [(t / total) ** exponent if t else 0.0 for t in tokens]
    whole = sum(p * n for p, (_, n) in zip(powers, pairs, strict=True))
    return [p / whole for p in powers]


def relative_entropy(parts: list[float], counts: Counts = None) -> float:
    live = [(p, n) for p, n in _counted(parts, counts) if p]
    number = sum(n for _, n in live)
    return -sum(n * p * math.log(p) for p, n in live) / math.log(number) if number > 1 else 1.0


def passes(tokens: list[int], parts: list[float], budget: int | None) -> list[float]:
    """How often each source is read."""
    rates = [p / t if t else 0.0 for p, t in zip(parts, tokens, strict=True)]
    if budget is None:
        least = min(r for r in rates if r)
        return [r / least for r in rates]
    return [r * budget for r in rates]


def find_exponent(tokens: list[int], target: Target, counts: Counts = None) -> float:
    """The exponent for the target; 1 keeps the sources' own shares."""
    budget = target.tokens(sum(t * n for t, n in _counted(tokens, counts)))

    def bisect(fits, low: float, high: float) -> float:
        """The end of the exponents that fit, from ``high``, which fits, towards ``low``."""
        if fits(low):
            return low
        for _ in range(BISECTIONS):
            middle = (low + high) / 2
            low, high = (low, middle) if fits(middle) else (middle, high)
        return high

    def entropy(x: float) -> float:
        return relative_entropy(weights(tokens, x, counts), counts)

    def allowed(x: float) -> bool:
        return max(passes(tokens, weights(tokens, x, counts), budget)) <= target.repeats

    exponent = 1.0
    if target.entropy is not None:
        # Entropy falls as the exponent grows: find where it drops to the target.
        if entropy(1.0) <= target.entropy:
            exponent = bisect(lambda x: entropy(x) <= target.entropy + 1e-12, 0.0, 1.0)
        else:
            exponent = bisect(lambda x: entropy(x) >= target.entropy - 1e-12, MOST_EXPONENT, 1.0)
    elif target.repeats is not None:
        exponent = 0.0
    if target.repeats is not None and not allowed(exponent) and allowed(1.0):
        exponent = bisect(allowed, exponent, 1.0)
    elif target.repeats is not None and not allowed(exponent):
        exponent = 1.0  # more is to be read than the limit lets any weights read
    return round(exponent, 9)


def quotas(tokens: list[int], target: Target) -> list[tuple[float, int]]:
    """Weight and token budget of each source."""
    if not sum(tokens):
        return [(0.0, 0) for _ in tokens]
    parts = weights(tokens, find_exponent(tokens, target))
    rates = passes(tokens, parts, target.tokens(sum(tokens)))
    return [(w, round(r * t)) for w, r, t in zip(parts, rates, tokens, strict=True)]


def source_plan(sizes: DataFrame, target: Target) -> DataFrame:
    """(s, weight, whole, rest) of sources (source, tokens): whole passes, and what is left of the budget."""
    spark = sizes.sparkSession
    schema = "s string, weight double, whole long, rest long"
    listed = sizes.limit(MAX_SOURCES + 1).collect()
    if len(listed) > MAX_SOURCES:
        return _plan_of_many(sizes, target)
    listed = sorted(listed, key=lambda r: (r["source"] is not None, r["source"] or ""))
    plan = []
    for row, (weight, quota) in zip(listed, quotas([r["tokens"] for r in listed], target), strict=True):
        whole, rest = divmod(quota, row["tokens"]) if row["tokens"] else (1, 0)
        plan.append((row["source"], weight, whole, rest))
    return F.broadcast(spark.createDataFrame(plan, schema))


def _plan_of_many(sizes: DataFrame, target: Target) -> DataFrame:
    """The same, with the exponent from a histogram; its steps bound what is collected."""
    step = F.round(F.log2(F.col("tokens").cast("double")) * STEPS)
    bins = sizes.where("tokens > 0").groupBy(step.alias("step")).agg(
        F.avg("tokens").alias("tokens"), F.count("*").alias("n")
    ).orderBy("step").collect()
    total = sizes.agg(F.sum("tokens")).first()[0]
    if not total:
        return sizes.select(
            F.col("source").alias("s"), F.lit(0.0).alias("weight"), F.lit(1).cast("long").alias("whole"),
            F.lit(0).cast("long").alias("rest"),
        )
    exponent = find_exponent([r["tokens"] for r in bins], target, [r["n"] for r in bins])
    power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent))
    live = sizes.where("tokens > 0").withColumn("power", power)
    whole = live.agg(F.sum("power").alias("sum"), F.min(F.col("power") / F.col("tokens")).alias("least")).first()
    budget = target.tokens(total)
    factor = 1 / whole["least"] if budget is None else budget / whole["sum"]
    quota = F.round(F.col("power") * F.lit(factor)).cast("long")
    planned = live.select(
        F.col("source").alias("s"), (F.col("power") / F.lit(whole["sum"])).alias("weight"),
        F.floor(quota / F.col("tokens")).cast("long").alias("whole"), (quota % F.col("tokens")).alias("rest"),
    )
    silent = sizes.where("tokens = 0").select(
        F.col("source").alias("s"), F.lit(0.0).alias("weight"), F.lit(1).cast("long").alias("whole"),
        F.lit(0).cast("long").alias("rest"),
    )
    return planned.unionByName(silent)


def count_words(text: Column) -> Column:
    word = "[^" + SPACES[1:] + "+"
    return F.coalesce(F.regexp_count(text, F.lit(word)), F.lit(0)).cast("long")


def _hash(*parts: Column) -> Column:
    return F.xxhash64(F.lit(SEED), *parts)


def mix(
    docs: DataFrame, target: Target, id_column: str = "doc_id", text: str = "text",
    source: str = "source", detail: str | None = None,
) -> DataFrame:
    """The rows, each as often as it is read; ``detail`` names a struct (epoch, rank, weight,
    n_tokens) where ``rank`` is the place of the row's block in its pass, from 0."""
    extra = free_name(docs, "_mix")
    body = F.struct(
        count_words(F.col(f"`{text}`")).alias("n_tokens"),
        F.pmod(_hash(F.col(f"`{id_column}`")), F.lit(BLOCKS)).cast("int").alias("block"),
        F.xxhash64(F.lit(SEED + 1), F.col(f"`{id_column}`")).alias("key"),
        F.col(f"`{source}`").cast("string").alias("source"),
    )
    rows = docs.withColumn(extra, body)
    small = stored(rows.select(f"`{extra}`.*"), "mix-rows")
    blocks = stored(small.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "mix-blocks")
    sizes = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    taken = stored(_passes(_last_pass(small, blocks, source_plan(sizes, target))), "mix-passes")
    if taken.count() <= BROADCAST_ROWS:
        taken = F.broadcast(taken)
    return _repeat(rows, extra, taken, detail)


def _last_pass(small: DataFrame, blocks: DataFrame, per_source: DataFrame) -> DataFrame:
    """One row per source and block: whole passes, and the greatest key read in the last one.

    Of each source at most one block is read in part.
    """
    same = F.col("source").eqNullSafe(F.col("s"))
    known = blocks.join(per_source, same)
    order = Window.partitionBy("source").orderBy(
        _hash(F.col("source"), F.col("whole"), F.col("block")), "block"
    ).rowsBetween(Window.unboundedPreceding, -1)
    placed = known.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    left = F.col("rest") - F.col("before")
    state = placed.select(
        "source", "block", "weight", "whole", F.greatest(left, F.lit(0)).alias("left"),
        F.when(left <= 0, "none").when(F.col("tokens") <= left, "all").otherwise("part").alias("take"),
    )
    part = state.where("take = 'part'").select(
        F.col("source").alias("s"), F.col("block").alias("b"), "left"
    )
    inside = small.join(part, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    running = Window.partitionBy("s", "b").orderBy("key").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cut = inside.withColumn("sum", F.sum("n_tokens").over(running)).where("sum <= left").groupBy(
        "s", "b"
    ).agg(F.max("key").alias("cut"))
    joined = state.join(
        cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left"
    )
    top = F.when(F.col("take") == "all", F.lit((1 << 63) - 1)).when(F.col("take") == "part", F.col("cut"))
    return joined.select("source", "block", "weight", "whole", top.alias("top"))


def _passes(state: DataFrame) -> DataFrame:
    """One row per source, block and pass, with the block's place in the pass's permutation.

    ``top`` is the greatest key that a pass reads; whole passes read every key.
    """
    every = F.lit((1 << 63) - 1)
    last = F.when(F.col("top").isNotNull(), F.array(F.struct((F.col("whole") + 1).alias("epoch"), F.col("top").alias("top"))))
    whole = F.when(F.col("whole") > 0, F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("whole")),
        lambda e: F.struct(e.alias("epoch"), every.alias("top")),
    ))
    empty = F.array().cast("array<struct<epoch: long, top: long>>")
    each = state.select("source", "block", "weight", F.explode(F.concat(
        F.coalesce(whole, empty), F.coalesce(last, empty)
    )).alias("pass")).select("source", "block", "weight", "pass.*")
    order = Window.partitionBy("source", "epoch").orderBy(
        _hash(F.col("source"), F.col("epoch") - 1, F.col("block")), "block"
    )
    return each.withColumn("rank", (F.row_number().over(order) - 1).cast("int"))


def _repeat(rows: DataFrame, extra: str, taken: DataFrame, detail: str | None) -> DataFrame:
    """The rows joined with the passes of their block."""
    own = [F.col(f"d.`{name}`") for name in without(rows.columns, extra, detail)]
    field = {name: F.col(f"d.`{extra}`.{name}") for name in ("n_tokens", "block", "key", "source")}
    out = rows.alias("d").join(
        taken.alias("t"),
        field["source"].eqNullSafe(F.col("t.source")) & (field["block"] == F.col("t.block"))
        & (field["key"] <= F.col("t.top")),
    )
    if detail is None:
        return out.select(*own)
    return out.select(*own, F.struct(
        F.col("t.epoch").alias("epoch"), F.col("t.rank").alias("rank"), F.col("t.weight").alias("weight"),
        field["n_tokens"].alias("n_tokens"),
    ).alias(detail))
