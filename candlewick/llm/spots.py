"""SpotSigs fingerprints of documents.

A spot starts at a common word, the anchor, and is the chain of the next two content words after
it. The set of a text's spots leaves out menus and the like, which have few common words, and
changes little when a text is edited a little. The fingerprint is a hash of the set; likeness of
two texts is the Jaccard ratio of their sets. A text without any spot is one spot of all its words.

``similar_pairs`` finds all pairs above a likeness, ``linked`` all sets like some of them, the queries.
Sets are partitioned by length into classes as wide as the likeness allows, so a set meets only its
own and the neighbouring classes; there it meets sets that share one of its first spots, common
spots being last, and a pair is dropped as soon as lengths and positions show that the overlap
cannot suffice. Only then are sets compared. ``with_links`` gives each document its class of equal
sets and, to the classes of the queries, the number of classes linked to them. Equal sets are one
entry, so copies are never paired.

Only DataFrame functions are used.

Rows: a null text counts as an empty one, which has no spots; two texts without spots are alike.
Equal texts have equal fingerprints. Words are runs of letters and digits, in lower case. In
``with_next``, rows of one id follow each other by text hash and null ids come last, so repeated
rows are each other's next document; a single row is its own. A null id is no query. Texts are read
whole, however long, and however many common words follow each other. Other columns are not read;
no rows give no rows.
"""

from __future__ import annotations

import math
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from candlewick.llm.common import only, stored

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his in is it its not of on or "
    "she that the their they this to was were which with you "
    "als am auch auf aus bei das dem den der des die ein eine einen einer er es für im ist mit "
    "nicht sich sie sind so und von war wie zu zum zur "
    "au aux avec ce ces dans de du elle en est et il je la le les leur mais ne nous ou par pas "
    "pour que qui sa se ses son sur un une "
    "al como con del el ella era esta este fue ha las lo los más no o para pero por sin su sus "
    "una y ya"
).split()

CHAIN = 2
LIKENESS = 0.8
ROWS_PER_BUCKET = 2000
MAX_BUCKETS = 1 << 17
RANGES = 64
# One set in SAMPLED tells which COMMON spots are common; they go last in every set, for speed alone.
SAMPLED = 16
COMMON = 1000
PART = 1000
# Up to so many sets to compare are marked in every task by a hash of 8 bytes each, so that only they
# are shuffled; more are joined by a shuffle of all sets.
MARKED = 4_000_000
QUERY_EVERY = 50


def _pattern(words: list[str]) -> str:
    """A pattern for any of the words that branches letter by letter."""
    tails: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        if word:
            tails.setdefault(word[0], []).append(word[1:])
    branches = [letter + _pattern(rest) for letter, rest in tails.items()]
    if not branches:
        return ""
    return f"(?:{'|'.join(branches)})" + ("?+" if "" in words else "")


# The blank after an anchor becomes a mark that ties it to the next word.
TIE = "\x02"
ANCHOR = f"(?<![^ ])({_pattern(ANCHORS)}) "


def with_spots(frame: DataFrame, text: str, name: str, *keep: str) -> DataFrame:
    """The columns ``keep`` and the text's distinct spots, sorted, as an array of long."""
    words = F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "))
    normal = frame.select(*keep, words.alias("_words"))
    # Each group is a content word with the anchors before it. What follows the last blank is empty
    # or anchors without a content word.
    tied = F.split(F.regexp_replace(F.concat("_words", F.lit(" ")), ANCHOR, f"$1{TIE}"), " ")
    parts = normal.select(*keep, "_words", tied.alias("_tied"))
    groups = parts.select(*keep, "_words", F.transform(
        F.slice("_tied", F.lit(1), F.size("_tied") - 1), lambda g: F.split(g, TIE)
    ).alias("_groups"))
    size = F.size("_groups") - CHAIN + 1

    def chains(group: Column, index: Column) -> Column:
        follow = [
            F.element_at(F.get(F.col("_groups"), index + k), -1) for k in range(1, CHAIN)
        ]
        return F.transform(
            F.slice(group, F.lit(1), F.size(group) - 1),
            lambda anchor: F.xxhash64(anchor, F.element_at(group, -1), *follow),
        )

    starts = F.slice("_groups", F.lit(1), F.greatest(size, F.lit(0)))
    found = groups.select(*keep, "_words", F.array_sort(F.array_distinct(
        F.flatten(F.transform(starts, chains))
    )).alias("_found"))
    whole = F.when(F.col("_words") == "", F.array().cast("array<long>")).otherwise(
        F.array(F.xxhash64("_words"))
    )
    return found.select(*keep, F.when(F.size("_found") > 0, F.col("_found")).otherwise(whole).alias(name))


def fingerprint(spots: Column) -> Column:
    """128 bits of the set as 32 hex digits."""
    halves = [F.lower(F.lpad(F.hex(h), 16, "0")) for h in (F.xxhash64(spots), F.xxhash64(F.lit(8), spots))]
    return F.concat(*halves)


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard ratio of two sets; two empty sets are alike."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b)
    return (
        F.when(either == 0, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(shared / (either - shared))
    )


# ---- the next document -------------------------------------------------------------------


def _bucketed(rows: DataFrame) -> DataFrame | None:
    """The rows with ``bucket``: ranges of ids, in their order, of about ROWS_PER_BUCKET rows.

    Quantiles cut the ids into RANGES ranges and each range is cut evenly.
    """
    quantiles = [k / RANGES for k in range(1, RANGES)]
    seen = rows.agg(
        F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.percentile_approx("doc_id", quantiles, 10_000).alias("cuts"),
    ).first()
    if not seen["n"]:
        return None
    bucket = F.lit(-1)
    if seen["low"] is not None:
        edges = sorted({seen["low"], *seen["cuts"], seen["high"] + 1})
        wanted = min(MAX_BUCKETS, math.ceil(seen["n"] / ROWS_PER_BUCKET))
        each = math.ceil(wanted / (len(edges) - 1))
        bucket = F.when(F.col("doc_id").isNull(), bucket)
        for k, (low, high) in enumerate(pairwise(edges)):
            place = F.floor((F.col("doc_id").cast("double") - low) * (each / (high - low)))
            inside = F.lit(k * each) + F.least(place, F.lit(each - 1))
            bucket = bucket.when(F.col("doc_id") < high, inside)
    return rows.withColumn("bucket", bucket.cast("int"))


def with_next(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, spots and ``next``, a struct (text, spots) of the document that follows.

    Documents follow each other by descending id, and the first follows the last. Texts are
    shuffled once, by ranges of ids; the first document of each range, of which there are at most
    MAX_BUCKETS, is also given to the range before it.
    """
    rows = only(docs, id_column, text).toDF("doc_id", "text").withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    placed = _bucketed(rows)
    if placed is None:
        kind = "struct<text: string, spots: array<long>>"
        return rows.select("doc_id", "text", F.array().cast("array<long>").alias("spots"), F.lit(None).cast(kind).alias("next"))
    tied = F.xxhash64("text")
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "tie", "text")
    spotted = with_spots(
        placed.withColumn("tie", tied).repartition("bucket"), "text", "spots",
        "doc_id", "text", "bucket", "tie",
    )
    inner = spotted.withColumn("follower", F.lead(F.struct("text", "spots")).over(order))
    # One row per bucket, in one small window.
    around = Window.orderBy(F.desc("bucket"))
    tops = placed.groupBy("bucket").agg(F.max("doc_id").alias("top")).select(
        "bucket", "top", F.lag("bucket").over(around).alias("before"),
        F.min("bucket").over(Window.partitionBy()).alias("last"),
    ).select(F.col("bucket").alias("b"), "top", F.coalesce("before", "last").alias("for_bucket"))
    first = placed.join(
        F.broadcast(tops), (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("top"))
    ).groupBy("for_bucket").agg(F.min(F.struct(tied.alias("tie"), "text")).alias("m"))
    heads = with_spots(
        first.select("for_bucket", F.col("m.text").alias("text")), "text", "spots", "for_bucket", "text"
    ).select("for_bucket", F.struct("text", "spots").alias("head"))
    joined = inner.join(
        heads, (F.col("bucket") == F.col("for_bucket")) & F.col("follower").isNull(), "left"
    )
    return joined.select("doc_id", "text", "spots", F.coalesce("follower", "head").alias("next"))


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of an edited text and of the next document.

    The edited text has its last half replaced by the beginning of the next document. Each
    document also has its class of equal sets and the number of other classes like it.
    """
    rows = with_next(docs, id_column, text)
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), size - half), F.col("next.text").substr(F.lit(1), half)
    )
    own = rows.select(
        "doc_id", size.cast("long").alias("n_chars"), edited.alias("edited"), "spots",
        likeness(F.col("spots"), F.col("next.spots")).alias("near_next"),
    )
    # Digests are kept as bytes, half as long, until the end.
    hashed = own.withColumn("edited_sha256", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    both = with_spots(
        hashed, "edited", "edited_spots", "doc_id", "n_chars", "edited_sha256", "spots", "near_next"
    )
    compared = both.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("spots")).alias("fingerprint"),
        F.unhex(fingerprint(F.col("edited_spots"))).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"), "near_next",
        F.size("spots").alias("n_spots"), "spots",
    )
    digests = ("edited_sha256", "edited_fingerprint")
    return with_links(compared).withColumns({name: F.lower(F.hex(name)) for name in digests})


# ---- near-duplicates ---------------------------------------------------------------------


def length_class(least: float) -> Column:
    """Sets so alike are of the same class or of neighbouring ones."""
    return F.floor(F.log(F.size("spots").cast("double")) / -math.log(least)).cast("int")


def rarest_first(sized: DataFrame) -> tuple[Column, DataFrame]:
    """A set's spots with the common ones last, and the table of one row that it needs.

    Any one order of all spots finds the same pairs; with the common spots last it meets few others.
    """
    common = (
        sized.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLED)) == 0).select(F.explode("spots").alias("spot"))
        .groupBy("spot").agg(F.count("*").alias("df")).where(F.col("df") > 1)
        .orderBy(F.desc("df"), "spot").limit(COMMON).agg(F.collect_list("spot").alias("common"))
    )
    return F.concat(F.array_except("spots", "common"), F.array_intersect("spots", "common")), common


def first_spots(least: float) -> Column:
    """So many of its first spots hold one that a set so alike has among its own first ones."""
    return (F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1).cast("int")


def similar_pairs(sets: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(a, b, likeness) for all pairs of different sets at least so alike; a < b.

    ``sets`` has distinct keys in ``key`` and distinct sorted ``spots``, none empty; equal sets are
    one row, so copies are not expanded into pairs. It is read several times, so it should be stored.
    """
    sized = sets.select("key", "spots", F.size("spots").alias("n"), length_class(least).alias("class"))
    by_rarity, common = rarest_first(sized)
    # The first spots of a set: a likely partner shares one of them.
    each = sized.crossJoin(F.broadcast(common)).select("key", "n", "class", F.posexplode(F.slice(
        by_rarity, F.lit(1), first_spots(least)
    )).alias("place", "spot"))
    counts = each.groupBy("spot").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    # Holders of a common (class, spot) are cut into parts, and each part meets each part on its own.
    posts = stored(
        each.join(counts, "spot").withColumn("parts", F.ceil(F.col("df") / PART).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("df"),
        "spot-posts",
    )
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    longer = posts.select(
        *(F.col(c).alias(f"{c}_2") for c in ("key", "n", "place")), "class", "spot",
        F.col("part").alias("part_2"), F.explode(every).alias("part"),
    )
    shorter = posts.select(
        "key", "n", "place", "spot", "part", "parts",
        F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"),
    ).select("key", "n", "place", "spot", "part", "class", F.explode(every).alias("part_2"))
    ordered = (F.col("n") < F.col("n_2")) | ((F.col("n") == F.col("n_2")) & (F.col("key") < F.col("key_2")))
    needed = F.lit(least / (1 + least)) * (F.col("n") + F.col("n_2")) - 1e-9
    possible = F.least(F.col("n") - F.col("place"), F.col("n_2") - F.col("place_2"))
    pairs = shorter.join(longer, ["class", "spot", "part", "part_2"]).where(
        ordered & (F.col("n") >= F.lit(least) * F.col("n_2") - 1e-9) & (possible >= needed)
    ).select("key", "key_2").distinct()
    one = sized.select("key", F.col("spots").alias("spots_1"))
    two = sized.select(F.col("key").alias("key_2"), F.col("spots").alias("spots_2"))
    return pairs.join(one, "key").join(two, "key_2").select(
        F.least("key", "key_2").alias("a"), F.greatest("key", "key_2").alias("b"),
        likeness(F.col("spots_1"), F.col("spots_2")).alias("likeness"),
    ).where(F.col("likeness") >= least - 1e-12)


def linked(held: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(query, key, likeness) for the sets that are queries and all other sets at least so alike.

    ``held`` has ``key``, equal for equal sets only, ``spots``, none empty, and ``is_query``; rows may
    repeat. It is read several times, so it should be stored. Only the first spots of each set
    are shuffled, and whole sets where a pair is left to be compared.
    """
    sized = held.select(
        "key", "spots", "is_query", F.size("spots").alias("n"), length_class(least).alias("class")
    )
    by_rarity, common = rarest_first(sized)
    firsts = sized.crossJoin(F.broadcast(common)).select(
        "key", "n", "class", "is_query", F.slice(by_rarity, F.lit(1), first_spots(least)).alias("firsts")
    )
    entries = stored(
        firsts.groupBy("key").agg(
            F.first("n").alias("n"), F.first("class").alias("class"), F.first("firsts").alias("firsts"),
            F.max("is_query").alias("is_query"),
        ).withColumn("id", F.monotonically_increasing_id()), "spot-firsts",
    )
    # What meets is a hash of class and spot: another hash would only be one more pair to compare.
    meets = F.xxhash64("class", "spot").alias("meets")
    at = (F.shiftleft(F.col("n").cast("long"), 32) + F.col("place")).alias("at")
    posts = entries.select("id", "n", "class", F.posexplode("firsts").alias("place", "spot")).select("id", at, meets)
    near = F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)
    asked = entries.where("is_query").select(
        "id", "n", F.explode(near).alias("class"), "firsts"
    ).select("id", "n", "class", F.posexplode("firsts").alias("place", "spot")).select(
        F.col("id").alias("query"), at.alias("at_q"), meets
    )
    n, n_q = (F.shiftright(F.col(c), 32) for c in ("at", "at_q"))
    left, left_q = (F.shiftright(F.col(c), 32) - F.col(c).bitwiseAND(0xFFFFFFFF) for c in ("at", "at_q"))
    alike = F.least(n, n_q) >= F.lit(least) * F.greatest(n, n_q) - 1e-9
    possible = F.least(left, left_q) >= F.lit(least / (1 + least)) * (n + n_q) - 1e-9
    pairs = stored(
        posts.join(asked, "meets").where((F.col("id") != F.col("query")) & alike & possible)
        .select("query", "id").distinct(), "spot-pairs",
    )
    wanted = stored(
        pairs.select(F.explode(F.array("query", "id")).alias("id")).distinct()
        .join(entries.select("id", "key"), "id"), "spot-wanted",
    )
    marks = wanted.select(F.xxhash64("key").alias("mark"))
    if wanted.count() <= MARKED:
        marks = F.broadcast(marks)
    whole = stored(
        held.select("key", "spots").join(marks, F.xxhash64("key") == F.col("mark"), "left_semi")
        .groupBy("key").agg(F.first("spots").alias("spots")).join(wanted, "key"), "spot-whole",
    )
    one = whole.select("id", "key", F.col("spots").alias("spots_1"))
    two = whole.select(F.col("id").alias("query"), F.col("key").alias("key_q"), F.col("spots").alias("spots_2"))
    return pairs.join(one, "id").join(two, "query").select(
        F.col("key_q").alias("query"), "key", likeness(F.col("spots_1"), F.col("spots_2")).alias("likeness")
    ).where(F.col("likeness") >= least - 1e-12)


def with_links(rows: DataFrame, least: float = LIKENESS, every: int = QUERY_EVERY) -> DataFrame:
    """The rows, which have doc_id, fingerprint and spots, with ``class_id`` and ``n_links``.

    Documents of equal sets are one class, named by its smallest doc_id; where ids repeat, the
    fingerprint tells classes apart. ``n_links`` is the number of other classes at least so alike,
    over the whole table, for the classes of documents whose id ``every`` divides; null for others.
    Spots are dropped.
    """
    is_query = F.coalesce(F.pmod("doc_id", F.lit(every)) == 0, F.lit(False))
    keyed = rows.withColumn("key", F.unhex("fingerprint")).withColumn("is_query", is_query)
    held = stored(keyed.drop("fingerprint"), "spot-documents")
    pairs = linked(held.where(F.size("spots") > 0).select("key", "spots", "is_query"), least)
    links = pairs.groupBy("query").agg(F.count("*").alias("n"))
    classes = held.groupBy("key").agg(
        F.min("doc_id").alias("class_id"), F.max("is_query").alias("asked")
    ).join(links, F.col("key") == F.col("query"), "left").select(
        F.col("key").alias("k"), "class_id",
        F.when(F.col("asked"), F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
    )
    named = held.drop("spots").withColumn("fingerprint", F.lower(F.hex("key")))
    return named.join(classes, F.col("key") == F.col("k")).select(
        *(f"`{c}`" for c in rows.columns if c != "spots"), "class_id", "n_links"
    )
