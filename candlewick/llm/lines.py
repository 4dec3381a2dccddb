"""Removal of lines that many sites share.

A line's spread is the number of distinct sites that have it. One aggregation merges a HyperLogLog
sketch of sites per line hash; sketches of few sites are short lists, so they stay small before
and after the shuffle. Lines whose estimate is far from the threshold are settled by it, lines
close to it get exact distinct counts. A line at or above the threshold stays in the first
document that has it (the smallest id) and goes from all others.

Only DataFrame functions are used. Lines are told apart by a 64-bit and a 32-bit hash together.

Rows: lines of white space only are never removed; a null text stays null and a text can become
empty. Rows without a site count for no site but lose boilerplate like others. Where no holder of
a line has an id, all keep it. Rows with one id count as one document. Very long texts and lines are
read whole; shuffled are hashes of lines, so their length does not matter. Other columns pass
through, but one named like ``removed`` is replaced by it; a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import SPACES, free_name, stored, without

MIN_SITES = 10
SKETCH_LG = 11
# Sketches err by 1.04 / sqrt(2^lg) at one standard deviation; four are taken as near.
NEAR = 4 * 1.04 / 2 ** (SKETCH_LG / 2)


def line_hash(line: Column) -> Column:
    data = line.cast("binary")
    return F.struct(F.xxhash64(data).alias("h"), F.crc32(data).alias("c"))


def _has_word(line: Column) -> Column:
    return F.length(F.regexp_replace(line, f"^{SPACES}+", "")) > 0


def _lines(docs: DataFrame, *keep: Column) -> DataFrame:
    each = docs.select(*keep, F.explode(F.split("text", "\n", -1)).alias("line"))
    kept = [c for c in each.columns if c != "line"]
    return each.where(_has_word(F.col("line"))).select(*kept, line_hash(F.col("line")).alias("key"))


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(key, first_id) of the lines that ``min_sites`` sites or more have.

    ``rows`` has id, site and text.
    """
    lines = _lines(rows, F.col("id"), F.col("site"))
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_agg("site", F.lit(SKETCH_LG)).alias("sketch"), F.min("id").alias("first_id")
    ).select("key", "first_id", F.hll_sketch_estimate("sketch").alias("sites"))
    likely = stored(sketched.where(F.col("sites") >= min_sites * (1 - NEAR) - 1), "line-spread")
    sure = F.col("sites") > min_sites * (1 + NEAR) + 1
    near = likely.where(~sure).select("key", "first_id")
    exact = lines.join(near, "key").where("site IS NOT NULL").groupBy("key", "first_id", "site").agg(
        F.lit(1).alias("one")
    ).groupBy("key", "first_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    settled = likely.where(sure).select("key", "first_id")
    return settled.unionByName(exact.select("key", "first_id"))


def remove_boilerplate(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", site: str = "source",
    min_sites: int = MIN_SITES, removed: str | None = None,
) -> DataFrame:
    """The rows with shared lines taken out of ``text``; ``removed`` names a column for their number."""
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{site}`").cast("string").alias("site"),
        F.col(f"`{text}`").alias("text"),
    )
    shared = stored(boilerplate(rows, min_sites), "boilerplate")
    mark = F.xxhash64(F.col("text").cast("binary"))
    hits = _lines(rows, F.col("id"), mark.alias("mark")).join(shared, "key").where(
        ~F.col("id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull()
    ).groupBy("id", "mark").agg(F.collect_set("key").alias("gone"))
    key, names = free_name(docs, "_mark"), without(docs.columns, removed)
    body = F.col(f"`{text}`")
    marked = docs.withColumn(key, F.xxhash64(body.cast("binary")))
    joined = marked.alias("d").join(
        hits.alias("h"),
        F.col(f"d.`{id_column}`").eqNullSafe(F.col("h.id")) & (F.col(f"d.`{key}`") == F.col("h.mark")),
        "left",
    )
    lines = F.split(F.col(f"d.`{text}`"), "\n", -1)
    left = F.filter(lines, lambda line: ~(
        F.array_contains(F.col("h.gone"), line_hash(line)) & _has_word(line)
    ))
    cleaned = F.when(F.col("h.gone").isNull(), F.col(f"d.`{text}`")).otherwise(F.array_join(left, "\n"))
    count = F.when(F.col("h.gone").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(left))
    out = [cleaned.alias(n) if n == text else F.col(f"d.`{n}`").alias(n) for n in names]
    if removed is not None:
        out.append(count.cast("long").alias(removed))
    return joined.select(*out)
