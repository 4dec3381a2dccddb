"""Runs of words against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from candlewick.llm import periods
from candlewick.llm.queries import QUERIES, looped_words

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(6, 4 * q):
                # Of equal stretches the smallest period came first.
                found.setdefault((i, end + q - i), q)
            i = end
    return sorted((start, length, q) for (start, length), q in found.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def numbered(text):
    return periods.words_of(text.encode())[0]


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_random_words(seed):
    pick = random.Random(seed)
    for _ in range(150):
        words = []
        while len(words) < 120:
            part = [pick.choice("ab" if seed % 2 else "abcdef") for _ in range(pick.randint(1, 14))]
            words += part * pick.choice([1, 1, 2, 3, 4, 5, 9])
        got = periods.find_runs(numbered(" ".join(words)))
        assert got == plain_runs(words)


@pytest.mark.parametrize("period", [1, 5, 6, 18, 19, 57, 58, 100])
def test_each_level_finds_its_periods(period):
    words = [f"w{k % period}" for k in range(4 * period)]
    for cut in (0, 1, 7):
        text = ["x", *words[:len(words) - cut], "y", "z"]
        assert periods.find_runs(numbered(" ".join(text))) == plain_runs(text)


def test_equal_words_take_no_square_time():
    words = np.zeros(300_000, np.int64)
    assert periods.find_runs(words) == [(0, 300_000, 1)]
    words = np.arange(300_000) % 1000
    assert periods.find_runs(words) == [(0, 300_000, 1000)]


def test_collapse_keeps_the_first_period():
    runs, text = periods.describe("so it is la la la la la la \n end".encode())
    assert runs == [{"start": 3, "length": 6, "period": 1}] and text == "so it is la end"
    assert periods.describe(None) == ([], "") == periods.describe(b" \n ")


def test_the_query_over_whole_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == sorted(plain_row(d.doc_id, d.text) for d in docs)
    assert sum(r.n_runs > 0 for r in rows) > len(docs) / 20


def test_edge_rows(spark):
    docs = [(None, "a a a a a a a", 1), (1, None, 2), (2, "", 3), (2, "", 3), (3, "é " * 9, 4),
            *((k, " ".join(f"w{j % (k + 2)}" for j in range(3 * k)), 5) for k in range(40))]
    frame = spark.createDataFrame(docs, "doc_id long, text string, Runs int")
    found = periods.with_runs(frame)
    assert found.columns == ["doc_id", "text", "runs", "collapsed"]
    for row in found.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        assert [tuple(r) for r in row.runs] == plain_runs(words)
    looped = {tuple(r) for r in looped_words(frame).collect()}
    assert {(None, "a a a a a a a"), (1, None), (2, "")} <= looped
    assert periods.with_runs(frame.where("false")).collect() == []


def test_a_very_long_text(spark):
    text = "start " + "\t\n" * 1_000_000 + "one two three " * 300_000
    frame = spark.createDataFrame([(text,)], "text string")
    row = periods.with_runs(frame).drop("text").first()
    assert [tuple(r) for r in row.runs] == [(1, 900_000, 3)] and row.collapsed == "start one two three"
