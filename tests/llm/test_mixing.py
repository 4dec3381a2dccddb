"""Exponents, quotas and the realised mixture against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from candlewick.llm import mixing
from candlewick.llm.queries import QUERIES
from candlewick.llm.mixing import Target, find_exponent, passes, quotas, relative_entropy, weights

TOKENS = [36_000, 3_000, 3_100, 2_500, 900, 0]


def test_exponent_meets_the_entropy():
    x = find_exponent(TOKENS, Target(entropy=0.9))
    assert relative_entropy(weights(TOKENS, x)) == pytest.approx(0.9, abs=1e-6)
    assert find_exponent(TOKENS, Target(entropy=1.0)) == pytest.approx(0, abs=1e-5)


def test_exponent_meets_the_repetition_limit():
    for budget in (None, 60_000):
        x = find_exponent(TOKENS, Target(repeats=3.0, budget=budget))
        assert max(passes(TOKENS, weights(TOKENS, x), budget)) == pytest.approx(3.0, rel=1e-6)
    both = find_exponent(TOKENS, Target(entropy=0.99, repeats=3.0))
    assert both == find_exponent(TOKENS, Target(repeats=3.0))


def test_exponents_above_one_set_sources_apart():
    near = [1000, 1100, 900, 1200]
    assert relative_entropy(weights(near, 1.0)) > 0.98
    x = find_exponent(near, Target(entropy=0.9))
    assert x > 1 and relative_entropy(weights(near, x)) == pytest.approx(0.9, abs=1e-6)
    limited = find_exponent(near, Target(entropy=0.5, repeats=1.5))
    assert 1 < limited < find_exponent(near, Target(entropy=0.5))
    assert max(passes(near, weights(near, limited), None)) == pytest.approx(1.5, rel=1e-6)
    # More is to be read than the limit allows.
    assert find_exponent(near, Target(entropy=0.9, repeats=2.0, read=3.0)) == 1.0


def test_equal_totals_count_as_so_many_sources():
    target = Target(entropy=0.93, repeats=5.0)
    assert find_exponent([50, 200], target, [3, 2]) == pytest.approx(find_exponent([50, 50, 50, 200, 200], target))


def test_a_budget_in_passes_is_one_in_tokens():
    assert quotas(TOKENS, Target(entropy=0.9, read=2.0)) == quotas(TOKENS, Target(entropy=0.9, budget=2 * sum(TOKENS)))


def test_without_a_budget_no_source_is_cut():
    for target in (Target(), Target(entropy=0.95, repeats=4.0)):
        for tokens, (_, quota) in zip(TOKENS, quotas(TOKENS, target), strict=True):
            assert quota >= tokens


def docs():
    out = []
    for k in range(900):
        source = "hot" if k % 3 == 0 else f"s{k % 7}"
        out.append((k, "word " * (k * 37 % 23 + (k == 4) * 5000), source, "x"))
    return out + [(2000, None, "s1", "x"), (2001, "", None, "x"), (2002, "a b", None, "x"),
                  (2002, "a b", None, "x"), (None, "a", "s2", "x"), (3000, "", "silent", None)]


@pytest.mark.parametrize("target", [
    Target(entropy=0.97, repeats=4.0), Target(entropy=0.8, budget=9_000), Target(budget=4_000),
])
def test_quotas_are_realised_to_within_a_document(spark, target):
    rows = docs()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, _mix string")
    out = mixing.mix(frame, target, detail="mix")
    assert out.columns == [*frame.columns, "mix"]
    got = out.collect()
    size = {(i, t): len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    tokens, read, most = Counter(), Counter(), defaultdict(int)
    for i, t, s, _ in rows:
        tokens[s] += size[i, t]
        most[s] = max(most[s], size[i, t])
    for r in got:
        read[r.source] += size[r.doc_id, r.text]
        assert r.mix.n_tokens == size[r.doc_id, r.text]
    names = sorted(tokens, key=lambda s: (s is not None, s or ""))
    for name, (weight, quota) in zip(names, quotas([tokens[n] for n in names], target), strict=True):
        assert quota - 2 * most[name] <= read[name] <= quota
        assert {r.mix.weight for r in got if r.source == name} <= {weight}
    times = Counter((r.doc_id, r.text, r.mix.epoch) for r in got)
    rows_of = Counter((i, t) for i, t, *_ in rows)
    assert all(n == rows_of[i, t] for (i, t, _), n in times.items())
    by_source = defaultdict(list)
    for (i, t), n in Counter((r.doc_id, r.text) for r in got).items():
        by_source[next(s for a, b, s, _ in rows if (a, b) == (i, t))].append(n // rows_of[i, t])
    assert all(max(n) - min(n) <= 1 for n in by_source.values())
    if target.budget is None:
        assert {(r.doc_id, r.text) for r in got} == set(rows_of)


def plain_mix(rows, target):
    """(id, text, epoch, rank) by hand, with the hashes of blocks and keys that Spark gives in ``rows``."""
    tokens, blocks = Counter(), defaultdict(Counter)
    for r in rows:
        tokens[r.source] += r.size
        blocks[r.source][r.block] += r.size
    names = sorted(tokens, key=lambda s: (s is not None, s or ""))
    out = []
    for name, (_, quota) in zip(names, quotas([tokens[n] for n in names], target), strict=True):
        whole, rest = divmod(quota, tokens[name]) if tokens[name] else (1, 0)
        own = [r for r in rows if r.source == name]
        for epoch in range(1, whole + 2):
            order = sorted(blocks[name], key=lambda b: (next(r.orders[epoch - 1] for r in own if r.block == b), b))
            left = rest
            for rank, block in enumerate(order):
                held = [r for r in own if r.block == block]
                if epoch <= whole:
                    out += [(r.doc_id, r.text, epoch, rank) for r in held]
                elif left > 0:
                    for key in sorted({r.key for r in held}):
                        same = [r for r in held if r.key == key]
                        if sum(r.size for r in held if r.key <= key) > left:
                            break
                        out += [(r.doc_id, r.text, epoch, rank) for r in same]
                    left -= blocks[name][block]
    return out


@pytest.mark.parametrize("target", [Target(entropy=0.97, repeats=4.0), Target(entropy=0.8, read=0.7)])
def test_passes_are_those_of_the_plain_form(spark, target):
    frame = spark.createDataFrame(docs(), "doc_id long, text string, source string, _mix string")
    hashed = frame.select(
        "doc_id", "text", "source", mixing.count_words(F.col("text")).alias("size"),
        F.pmod(F.xxhash64(F.lit(mixing.SEED), "doc_id"), F.lit(mixing.BLOCKS)).cast("int").alias("block"),
        F.xxhash64(F.lit(mixing.SEED + 1), "doc_id").alias("key"),
    ).withColumn("orders", F.array(*(
        F.xxhash64(F.lit(mixing.SEED), "source", F.lit(e).cast("long"), "block") for e in range(6)
    )))
    want = plain_mix(hashed.collect(), target)
    got = [(r.doc_id, r.text, r.mix.epoch, r.mix.rank) for r in mixing.mix(frame, target, detail="mix").collect()]
    assert Counter(got) == Counter(want)


@pytest.mark.parametrize("target", [Target(entropy=0.97, repeats=4.0), Target(entropy=0.8, read=0.7)])
def test_many_sources_get_about_the_same_plan(spark, monkeypatch, target):
    rows = [(f"s{k}", 1000 + 37 * k * k % 5000) for k in range(200)] + [(None, 700), ("silent", 0)]
    sizes = spark.createDataFrame(rows, "source string, tokens long")
    few = {r.s: r for r in mixing.source_plan(sizes, target).collect()}
    monkeypatch.setattr(mixing, "MAX_SOURCES", 5)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    many = {r.s: r for r in mixing.source_plan(sizes, target).collect()}
    assert many.keys() == few.keys()
    for name, tokens in rows:
        a, b = few[name], many[name]
        assert b.weight == pytest.approx(a.weight, rel=2e-3)
        assert b.whole * tokens + b.rest == pytest.approx(a.whole * tokens + a.rest, rel=2e-3, abs=2)
    frame = spark.createDataFrame(docs(), "doc_id long, text string, source string, _mix string")
    assert mixing.mix(frame, target).count() > 0


def test_the_given_sources_are_mixed(spark):
    rows = QUERIES["op3_mixing"](spark, "/root/testdata/sf0.01")
    read = {r.doc_id for r in rows.collect()}
    assert rows.where("epoch > 1").count() > 0 and len(read) < 1000


def test_rows_alone_and_no_rows(spark):
    frame = spark.createDataFrame(docs(), "doc_id long, text string, source string, _mix string")
    target = Target(entropy=0.97, repeats=4.0)
    plain = mixing.mix(frame, target)
    assert plain.columns == frame.columns
    assert plain.count() == mixing.mix(frame, target, detail="mix").count()
    assert mixing.mix(frame.where("false"), target).count() == 0
