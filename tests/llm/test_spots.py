"""Spots, edited texts and pairs against plain forms."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from candlewick.llm import spots
from candlewick.llm.spots import ANCHORS


def plain_spots(text: str | None) -> set:
    words = re.findall(r"[^\W_]+", (text or "").lower())
    content = [k for k, w in enumerate(words) if w not in ANCHORS]
    found = set()
    for k, w in enumerate(words):
        if w in ANCHORS:
            chain = [words[c] for c in content if c > k][:2]
            if len(chain) == 2:
                found.add((w, *chain))
    return found or ({" ".join(words)} if words else set())


def ratio(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string, spots string, bucket int")
    got = {}
    for r in spots.edited_fingerprints(frame).collect():
        got.setdefault((r.doc_id, r.n_chars), []).append(r)
    order = sorted({(d[0], d[1]) for d in docs}, key=lambda d: -d[0])
    assert len(got) == len(order)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        (row,) = got[i, len(text)]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.n_spots == len(plain_spots(text))
        assert row.near_edited == pytest.approx(ratio(plain_spots(text), plain_spots(edited)))
        assert row.near_next == pytest.approx(ratio(plain_spots(text), plain_spots(after)))
        assert (row.fingerprint == row.edited_fingerprint) == (plain_spots(text) == plain_spots(edited))


WORDS = ["the", "of", "and", "a", "der", "la", "für", "más", "house", "cat", "Größe", "été", "tree,",
         "x1", "(dog)", "then", "42", "漢字", "🙂"]


@pytest.mark.parametrize("rows", [1, 7, 60])
def test_edited_texts_follow_descending_ids(spark, monkeypatch, rows):
    monkeypatch.setattr(spots, "ROWS_PER_BUCKET", 20)
    pick = random.Random(rows)
    ids = pick.sample(range(-50, rows * 40), min(rows, 150)) if rows > 1 else [5]
    docs = [(i * (i % 7 + 1), " ".join(pick.choices(WORDS, k=pick.randint(0, 60))), "x", 1) for i in ids]
    docs = list({d[0]: d for d in docs}.values())
    if rows > 1:
        docs += [(10**12, None, None, 1), (-10**12, "", "x", 1), (7 * 10**11, "the big cat " * 9000, "x", 1)]
    check(spark, docs)


def test_long_runs_of_anchors(spark):
    texts = ["the " * 100_000 + "cat dog", "x" * 1_000_000, "of the cat " * 50_000, "the of"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in spots.edited_fingerprints(frame).collect()}
    assert [out[k].n_spots for k in range(4)] == [len(plain_spots(t)) for t in texts]


@pytest.mark.parametrize("text", [
    "the " * 40 + "cat sat in the", "the cat sat in the", "in the", "the", "cat", "cat the of dog a", "an and ant andy",
    "The der LA, house of the\ncat of", "the cat the dog the", "of of of cat of of dog of of",
])
def test_only_content_words_follow_anchors(spark, text):
    frame = spark.createDataFrame([(text,)], "text string")
    row = spots.with_spots(frame, "text", "spots").first()
    assert len(row.spots) == len(plain_spots(text))
    chains = [F.xxhash64(*map(F.lit, c)) if isinstance(c, tuple) else F.xxhash64(F.lit(c)) for c in plain_spots(text)]
    assert row.spots == sorted(frame.select(F.array(*chains)).first()[0])


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = [(1, "the old tree of a house", "x", 1)] * 3 + [(None, "the old tree of a house", "x", 1), (None, None, "x", 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, spots string, bucket int")
    out = spots.edited_fingerprints(frame).collect()
    assert len(out) == 5
    assert len({r.fingerprint for r in out if r.n_chars}) == 1
    assert spots.edited_fingerprints(frame.where("false")).count() == 0


def test_pairs_are_those_of_brute_force(spark):
    pick = random.Random(6)
    sets = []
    for _ in range(40):
        base = set(pick.sample(range(900), pick.randint(1, 60)))
        for _ in range(pick.randint(1, 4)):
            sets.append(frozenset(base))
            base = (base - set(pick.sample(sorted(base), len(base) // 12))) | {pick.randint(0, 900)}
    sets = sorted(set(sets), key=sorted)
    frame = spark.createDataFrame(
        [(k, sorted(s)) for k, s in enumerate(sets)], "key long, spots array<long>"
    )
    for least in (0.5, 0.8, 1.0 - 1e-6):
        got = {(r.a, r.b): r.likeness for r in spots.similar_pairs(frame, least).collect()}
        want = {(i, j): ratio(sets[i], sets[j]) for j in range(len(sets)) for i in range(j)
                if ratio(sets[i], sets[j]) >= least}
        assert got == pytest.approx(want)


def test_linked_sets_are_those_of_brute_force(spark):
    pick = random.Random(7)
    sets = set()
    for _ in range(40):
        base = set(pick.sample(range(900), pick.randint(1, 60)))
        for _ in range(pick.randint(1, 5)):
            sets.add(frozenset(base))
            base = (base - set(pick.sample(sorted(base), len(base) // 12))) | {pick.randint(0, 900)}
    sets = sorted(sets, key=sorted)
    queries = {k for k in range(len(sets)) if k % 3 == 0}
    rows = [(k, sorted(x), k in queries and copy == 0) for k, x in enumerate(sets) for copy in range(1 + k % 2)]
    frame = spark.createDataFrame(rows, "key long, spots array<long>, is_query boolean")
    for least in (0.5, 0.8):
        got = {(r.query, r.key): r.likeness for r in spots.linked(frame, least).collect()}
        want = {(i, j): ratio(sets[i], sets[j]) for i in queries for j in range(len(sets))
                if i != j and ratio(sets[i], sets[j]) >= least}
        assert got == pytest.approx(want)


@pytest.mark.parametrize("every", [1, 50])
def test_documents_have_their_class_and_all_links(spark, every):
    pick = random.Random(9)
    words = [f"w{k}" for k in range(500)]
    bases = [[x for _ in range(60) for x in ("the", *pick.choices(words, k=2))] for _ in range(3)]
    texts = [None, "", "12"]
    for k in range(40):
        base = list(bases[k % 3])
        base[3 * pick.randrange(58) + 1] = f"n{k}"  # a near copy, not next to its likes
        texts += [" ".join(base)] * (1 + k % 2)
    docs = [(10 * k, t) for k, t in enumerate(texts)] + [(None, texts[-1]), (30, texts[3])]
    frame = spark.createDataFrame([(i, t or "") for i, t in docs], "doc_id long, text string")
    rows = spots.with_spots(frame, "text", "spots", "doc_id")
    marked = rows.withColumn("fingerprint", spots.fingerprint(F.col("spots")))
    got = {r.doc_id: r for r in spots.with_links(marked, every=every).collect()}
    sets = {i: frozenset(plain_spots(t)) for i, t in docs}
    for i, one in sets.items():
        others = {x for x in sets.values() if x != one and x and one and ratio(one, x) >= 0.8}
        asked = any(x == one and j is not None and j % every == 0 for j, x in sets.items())
        assert got[i].n_links == (len(others) if asked else None)
        assert got[i].class_id == min(j for j, x in sets.items() if j is not None and x == one)
    assert max(r.n_links or 0 for r in got.values()) >= 12


def test_the_given_tables_have_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = spots.edited_fingerprints(docs)
    assert out.count() == docs.count()
    assert out.where("near_edited < 0 OR near_edited > 1").count() == 0
    joined = out.join(docs.select("doc_id", "text"), "doc_id")
    uneven = joined.groupBy("text").agg(F.countDistinct("fingerprint").alias("n")).where("n > 1")
    assert uneven.count() == 0
