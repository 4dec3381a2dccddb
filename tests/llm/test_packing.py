"""Packing against brute-force best fit, and an exact way back to every text."""

from __future__ import annotations

import random

import numpy as np
import pytest

from candlewick.llm import packing
from candlewick.llm.packing import best_fit, read_ranks, tokenizer, unpack_row

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256


def plain_best_fit(sizes, capacity):
    rooms, places = [], []
    for size in sizes:
        fits = [r for r in rooms if r >= size]
        if fits:
            k = max(i for i, r in enumerate(rooms) if r == min(fits))
        else:
            rooms.append(capacity)
            k = len(rooms) - 1
        rooms[k] -= size
        places.append(k)
    return rooms, places


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_leaves_the_rooms_of_the_plain_form(seed):
    pick = random.Random(seed)
    capacity = pick.choice([1, 7, 64, 100])
    sizes = sorted((pick.randint(1, capacity) for _ in range(300)), reverse=True)
    places = best_fit(sizes, capacity)
    rooms = [capacity] * (max(places) + 1)
    for place, size in zip(places, sizes, strict=True):
        rooms[place] -= size
    assert sorted(rooms) == sorted(plain_best_fit(sizes, capacity)[0])
    assert min(rooms) >= 0


def check(spark, docs, row_tokens, window_tokens):
    with open(RANKS, "rb") as file:
        coder = tokenizer(read_ranks(file.read()))
    frame = spark.createDataFrame(docs, "doc_id long, text string, ids string")
    rows = packing.pack_documents(
        frame, RANKS, END, row_tokens=row_tokens, window_tokens=window_tokens
    ).collect()
    assert len({row.pack_id for row in rows}) == len(rows)
    parts: dict = {}
    for row in rows:
        assert len(row.ids) == len(row.positions) == 2 * row_tokens
        assert row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] <= row_tokens
        positions = np.frombuffer(row.positions, "<u2")
        edges = [*row.cu_seqlens, row_tokens]
        want = [p for a, b in zip(edges, edges[1:]) for p in range(b - a)]
        assert positions.tolist() == want
        used = row.cu_seqlens[-1]
        assert (np.frombuffer(row.ids, "<u2")[used:] == END).all()
        for doc_id, offset, ids in unpack_row(row, row_tokens):
            parts.setdefault((doc_id, offset), []).append(ids.tolist())
    want = {}
    for doc_id, text, _ in docs:
        ids = [*coder.encode_ordinary(text or ""), END]
        for start in range(0, len(ids), row_tokens):
            want.setdefault((doc_id, start), []).append(ids[start:start + row_tokens])
    assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items()}
    return rows


def test_every_token_comes_back(spark):
    pick = random.Random(3)
    docs = [(k, " ".join(pick.choices(["the", "cat", "naïve", "\n", "漢字"], k=pick.randint(0, 90))), "x")
            for k in range(120)]
    docs += [(500, None, None), (501, "", "y"), (501, "", "y"), (None, "null id", "y"),
             (502, "word " * 5000, "y"), (503, "<|endoftext|>", "y")]
    check(spark, docs, 64, 1 << 22)
    check(spark, docs, 64, 200)
    rows = check(spark, docs, 2048, 1 << 22)
    assert len(rows) <= 12


@pytest.mark.parametrize("seed", range(4))
def test_long_white_space_is_cut_where_the_pattern_cuts_it(seed):
    with open(RANKS, "rb") as file:
        ranks = read_ranks(file.read())
    pick, whole = random.Random(seed), tokenizer(ranks)
    white = " \n\t\r\x0b\x0c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000"
    for _ in range(300):
        parts = []
        for _ in range(pick.randint(1, 9)):
            kinds = pick.choice([" ", "\n", " \n", white])
            parts.append("".join(pick.choices(kinds, k=pick.randint(0, 60))))
            parts.append(pick.choice(["word", "x", "12", "'s", "!?", "\x1f", "é", "", "\u200b", "🙂"]))
        text = "".join(parts)
        assert packing.encoder(ranks, 7)(text) == whole.encode_ordinary(text)


@pytest.mark.parametrize("white", [" ", "\n", "\t", " \n\t\u3000"])
def test_a_million_blanks(spark, white):
    with open(RANKS, "rb") as file:
        encode = packing.encoder(read_ranks(file.read()))
    run = white * (1_000_000 // len(white))
    docs = [(1, run), (2, f"start{run}end of it{run}"), (3, f" {run}x"), (4, "after")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    parts: dict = {}
    for row in packing.pack_documents(frame, RANKS, END).collect():
        for doc_id, offset, ids in unpack_row(row):
            parts.setdefault(doc_id, []).append((offset, ids))
    for doc_id, text in docs:
        got = np.concatenate([ids for _, ids in sorted(parts[doc_id], key=lambda x: x[0])])
        assert got.tolist() == [*encode(text), END]


def test_no_rows(spark):
    assert check(spark, [], 64, 100) == []


def test_written_rows_are_the_rows_of_a_matrix(spark, tmp_path):
    docs = [(k, "some words " * (k % 40), "x") for k in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, ids string")
    folder = str(tmp_path / "packed")
    packing.write_packed(packing.pack_documents(frame, RANKS, END, row_tokens=32), folder)
    rows = spark.read.parquet(folder).orderBy("pack_id").collect()
    ids, positions = (packing.matrix(rows, name, 32) for name in ("ids", "positions"))
    assert ids.shape == positions.shape == (len(rows), 32)
    assert ((positions == 0).sum(axis=1) >= [len(r.doc_ids) for r in rows]).all()
    assert packing.matrix([]).shape == (0, packing.ROW_TOKENS)
