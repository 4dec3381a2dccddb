"""The rule ledger against brute force, policies and ablations."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from candlewick.llm import quality
from candlewick.llm.quality import MEASURES, measure_text

LONG = " ".join(f"word{i}" for i in range(30))


def plain(text: str | None) -> dict[str, int]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(marked), "n_capitals": len(re.findall("[A-Z]", text)),
        "n_stutters": sum(a == b for a, b in zip(words, words[1:])),
    }


TEXTS = [
    None, "", " \n\t ", "a", "a\nb\na\n\n\n", "Ünï cödé ££ 漢字  x", "a b c d e f g h " * 3,
    "one two three four five six seven eight nine " * 2, "x " * 400, LONG, LONG + "\n" + LONG,
    "#a *b $c %d &e |f <g >h", "SHOUT " * 25, "a\r\nb\r\na\r\n", "a\x1cb\x85c d",
]


@pytest.mark.parametrize("text", TEXTS)
def test_measures_match_the_plain_form(text):
    got = measure_text(None if text is None else text.encode())
    assert dict(zip(MEASURES, got, strict=True)) == plain(text)


def test_ledger_keeps_other_columns_and_rows(spark):
    docs = [(k % 5, text, "x", 1) for k, text in enumerate(TEXTS + TEXTS)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, _measures string, failed int")
    got = quality.with_ledger(frame).collect()
    assert len(got) == len(docs)
    for row in got:
        want = plain(row.text)
        assert {name: row.ledger[name] for name in MEASURES} == want
        assert bool(row.ledger.failed & 1) == (want["n_words"] < 20)
        assert bool(row.ledger.failed & 2) == (100 * want["n_repeat_words"] > 30 * want["n_words"])
    kept = quality.filter_documents(frame)
    assert kept.columns == frame.columns
    assert {r.text for r in kept.collect()} == {LONG}


def test_a_very_long_text_is_measured_whole(spark):
    text = "\n".join(f"long line {k % 9000} of many words" for k in range(40_000))
    frame = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, ledger int")
    (row,) = quality.with_ledger(frame).collect()
    assert row.ledger.n_words == 240_000 and row.ledger.n_dup_lines == 31_000
    assert row.ledger.n_lines == 40_000 and row.ledger.n_repeat_words == 240_000


def test_ablation_counts_what_only_one_rule_rejects(spark):
    bits = spark.createDataFrame([(0,), (1,), (1,), (3,), (2,), (4,)], "failed long")
    rows = {r["rule"]: r for r in quality.ablations(bits, quality.BASE).collect()}
    assert set(rows) == {"few_words", "repeated_windows"}
    assert (rows["few_words"].n_failed, rows["few_words"].n_only_this) == (3, 2)
    assert (rows["repeated_windows"].n_failed, rows["repeated_windows"].n_only_this) == (2, 1)
    assert rows["few_words"].n_docs == 6


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.with_ledger(empty).count() == 0
    assert quality.ablations(spark.createDataFrame([], "failed long"), quality.BASE).count() == 0
