"""Reconciliation by digests against the plain full outer join."""

import random

import pytest

from candlewick.operators import compare, digest


def random_sides(rng):
    """Two copies of some series; a few days hold a changed, a missing, a surplus or a repeated candle."""
    left, right = [], []
    for unit, starts in (
        ("15m", [f"2024-01-{d:02} {h:02}:30:00" for d in range(1, 7) for h in range(0, 24, 5)]),
        ("4h", [f"2024-0{m}-15 0{h}:00:00" for m in range(1, 5) for h in (0, 4, 8)]),
        ("1d", [f"{y}-03-{d:02} 00:00:00" for y in (2022, 2023, 2024) for d in range(1, 9)]),
    ):
        for symbol in ("A/KRW", "B/KRW", "SAME/KRW"):
            for at in starts:
                row = (unit, at, symbol, *(rng.randrange(1, 5) for _ in range(4)), rng.randrange(9) / 8)
                fate = rng.random() if symbol != "SAME/KRW" else 1
                if fate >= 0.02:
                    left.append(row)
                if fate < 0.04:
                    row = (*row[:3], row[3] + 1, *row[4:])
                elif fate < 0.06:
                    row = (*row[:7], row[7] + 0.05)
                elif fate < 0.08:
                    continue
                elif fate < 0.10:
                    right.append(row)
                right.append(row)
    return left, right


def rows_of(frame):
    return sorted(map(str, (r.asDict(True) for r in frame.select(sorted(frame.columns)).collect())))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("created_at", [None, "2024-01-03 12:00:00"])
def test_equals_the_plain_join(make_candles, seed, created_at):
    left, right = random_sides(random.Random(seed))
    stored, served = make_candles(left, created_at=created_at), make_candles(right)
    blocks = digest.compared_blocks(stored, served).persist()
    pairs = digest.flagged_pairs(stored, served, blocks).persist()
    assert rows_of(digest.summary_by_digest(pairs, blocks, 7)) == rows_of(
        compare.reconcile_summary(stored, served, 7))
    plain = rows_of(compare.reconcile_diffs(stored, served))
    assert plain and rows_of(compare.diff_rows(pairs)) == plain
    # Only candles of blocks that differ are joined, and no block of equal copies does.
    differing = blocks.where("differs").collect()
    assert differing and not any(r["symbol"] == "SAME/KRW" for r in differing)
    assert pairs.where("db_candle IS NOT NULL").dropDuplicates(
        ["unit", "symbol", "timestamp"]).count() == sum(r["db_count"] for r in differing)
    assert sum(r["db_count"] for r in differing) < len(left)


def test_nulls_do_not_move_up(make_candles):
    left = make_candles([("1m", "2024-01-15", "A/KRW", 1, 1, 1, 1, 1)])
    one = left.selectExpr("* EXCEPT (open, high)", "2D AS open", "CAST(null AS DOUBLE) AS high")
    two = left.selectExpr("* EXCEPT (open, high)", "CAST(null AS DOUBLE) AS open", "2D AS high")
    (block,) = digest.compared_blocks(one, two).collect()
    assert block["differs"]


def test_repeated_and_nameless_rows(make_candles):
    row = ("1m", "2024-01-15", "A/KRW", 1, 1, 1, 1, 1)
    other = (*row[:7], 2)
    (block,) = digest.compared_blocks(make_candles([row, row]), make_candles([other, other])).collect()
    assert (block["db_count"], block["exchange_count"], block["differs"]) == (2, 2, True)
    nameless = make_candles([row]).selectExpr("* EXCEPT (symbol)", "CAST(null AS STRING) AS symbol")
    blocks = digest.compared_blocks(nameless, nameless)
    pairs = digest.flagged_pairs(nameless, nameless, blocks)
    assert rows_of(digest.summary_by_digest(pairs, blocks)) == rows_of(
        compare.reconcile_summary(nameless, nameless))


def test_empty_sides(make_candles):
    empty, some = make_candles([]), make_candles([("1h", "2024-01-15", "A/KRW", 1, 1, 1, 1, 1)])
    assert digest.compared_blocks(empty, empty).count() == 0
    blocks = digest.compared_blocks(empty, some)
    assert rows_of(compare.diff_rows(digest.flagged_pairs(empty, some, blocks))) == rows_of(
        compare.reconcile_diffs(empty, some))
