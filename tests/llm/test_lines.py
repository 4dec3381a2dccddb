"""Boilerplate lines against brute force."""

from __future__ import annotations

import random

from candlewick.llm import lines


def plain(docs, min_sites):
    sites, first = {}, {}
    for i, text, site, _ in docs:
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\v\f\r"):
                sites.setdefault(line, set())
                if site is not None:
                    sites[line].add(site)
                if i is not None:
                    first[line] = min(first.get(line, i), i)
    shared = {line: first[line] for line, s in sites.items() if len(s) >= min_sites and line in first}
    out = []
    for i, text, *_ in docs:
        parts = None if text is None else text.split("\n")
        kept = None if text is None else [x for x in parts if shared.get(x, i) == i]
        out.append((i, None if kept is None else "\n".join(kept),
                    0 if kept is None else len(parts) - len(kept)))
    return sorted(out, key=str)


def run(spark, docs, min_sites=4):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, mark string")
    out = lines.remove_boilerplate(frame, min_sites=min_sites, removed="n")
    assert out.columns == [*frame.columns, "n"]
    return sorted(((r.doc_id, r.text, r.n) for r in out.collect()), key=str)


def test_against_brute_force(spark):
    pick = random.Random(9)
    pool = [f"line {k}" for k in range(30)] + ["", "  ", "\t", "a\rb", "ünï"]
    docs = [(k, "\n".join(pick.choices(pool, k=pick.randint(1, 6))), f"s{pick.randint(0, 9)}", "m")
            for k in range(80)]
    docs += [(3, "line 1\nline 1\nown", "s1", "m")] * 2
    docs += [(None, "line 1\nline 2", "s2", "m"), (200, None, None, None), (201, "", "s1", "m"),
             (202, "line 3", None, "m"), (203, "x" * 300_000 + "\nline 4", "s3", "m")]
    got = run(spark, docs)
    assert got == plain(docs, 4)
    assert any(n for _, _, n in got)


def test_many_sites_are_estimated_and_near_ones_counted(spark):
    docs = [(k, "everywhere\nown %d" % k, f"site{k}", "m") for k in range(400)]
    docs += [(1000 + k, "nearly", f"site{k}", "m") for k in range(99)]
    docs += [(2000 + k, "just", f"site{k}", "m") for k in range(100)]
    assert run(spark, docs, 100) == plain(docs, 100)


def test_very_long_lines_and_a_clashing_name(spark):
    long = "long words " * 100_000
    docs = [(k, f"{long}\nown {k}", f"s{k}", "m") for k in range(4)]
    assert run(spark, docs) == plain(docs, 4)
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, mark string")
    out = lines.remove_boilerplate(frame, min_sites=4, removed="mark")
    assert out.columns == frame.columns
    assert sorted(r.mark for r in out.collect()) == [0, 1, 1, 1]


def test_no_rows(spark):
    assert run(spark, []) == []
