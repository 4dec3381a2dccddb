"""Votes, label model and classifier against plain forms, and accuracy on held-out labels."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.llm import toxicity
from candlewick.llm.queries import QUERIES
from candlewick.llm.toxicity import BIT, VOTERS, LabelModel


def plain_terms(text):
    words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    return words | {w[:4] + "*" for w in words if len(w) >= 6}


@pytest.mark.parametrize("text", [None, "", " \n", "Ein Wort, zwei-drei_vier 5fünf", "É" * 50, "a\x0bb " * 200_000 + "Ende"])
def test_terms(text):
    assert toxicity.terms_of(None if text is None else text.encode()) == plain_terms(text)


def test_given_voters():
    def fired(text, lexicon=None):
        bits = toxicity.votes(text.encode(), toxicity.terms_of(text.encode()), lexicon or {})
        return {name for name, bit in BIT.items() if bits & bit}

    assert fired("You are such an Idiot, really.") == {"foolish", "direct"}
    assert fired("The idiot. You came.") == {"foolish"}
    assert fired("Just shut up!!!") == {"phrase", "loud"}
    assert fired("They shut it up there, hell of a day") == set()
    assert fired("quargel morn", {"quargel": BIT["words_3"], "quar*": BIT["stems_1"]}) == {"words_3", "stems_1"}


def test_term_counts_and_terms(spark):
    pick = random.Random(3)
    rows = []
    for k in range(400):
        toxic = float(k % 5 == 0)
        words = [f"w{chr(97 + pick.randint(0, 25))}x" for _ in range(20)] + ["quargel"] * int(toxic and k % 10 == 0)
        rows.append((" ".join(words).encode(), toxic, 1.0 + k % 2))
    frame = spark.createDataFrame(rows, "text binary, toxic double, weight double").repartition(5)
    want = {}
    for data, toxic, weight in rows:
        for term in {"", *plain_terms(data.decode())}:
            a, b = want.get(term, (0.0, 0.0))
            want[term] = (a + toxic * weight, b + (1 - toxic) * weight)
    got = {r.term: (r.toxic, r.clean) for r in toxicity.term_counts(frame).collect()}
    assert got == want

    def sure(term):
        (a, b), (all_a, all_b) = want[term], want[""]
        odds = math.log((a + .5) / (all_a + 1)) - math.log((b + .5) / (all_b + 1))
        return odds - 1.64 * math.sqrt(1 / (a + .5) + 1 / (b + .5))

    told = [t for t in want if t and want[t][0] > 1 and sure(t) > (3.0 if t.endswith("*") else 1.5)]
    assert toxicity.telling_terms(frame) == sorted(told, key=lambda t: (-round(sure(t), 9), t))
    assert "quargel" in told


def drawn(n, copies, seed=5):
    """Votes of a known model: three good voters, two more like one of them, and a poor one."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.15
    x = np.zeros((n, VOTERS), int)
    for j, (on, off) in enumerate([(0.8, 0.03), (0.7, 0.05), (0.6, 0.02)]):
        x[:, j] = rng.random(n) < np.where(y, on, off)
    for j in (3, 4):
        if copies:
            x[:, j] = np.where(rng.random(n) < 0.95, x[:, 0], 1 - x[:, 0])
        else:
            x[:, j] = rng.random(n) < np.where(y, 0.7, 0.06)
    x[:, 5] = rng.random(n) < 0.3
    return y, x @ (1 << np.arange(VOTERS))


def patterns_of(y, bits, labelled):
    rows = {}
    for is_toxic, b, known in zip(y, bits, labelled, strict=True):
        row = rows.setdefault(int(b), [0, 0, 0])
        row[0] += 1
        row[1] += int(known and is_toxic)
        row[2] += int(known and not is_toxic)
    return pd.DataFrame([(b, *r) for b, r in rows.items()], columns=["bits", "n", "toxic", "clean"])


# Without any label near copies of a voter would be taken for the class itself.
@pytest.mark.parametrize(("share", "copies"), [(0.0, False), (0.1, False), (0.1, True)])
def test_label_model_recovers_what_made_the_votes(share, copies):
    y, bits = drawn(40_000, copies)
    labelled = np.random.default_rng(1).random(len(y)) < share
    model = toxicity.fit_label_model(patterns_of(y, bits, labelled))
    assert abs(model.prior - y.mean()) < 0.02
    # The copies depend on each other, the other voters on none.
    edges = {frozenset((j, p)) for j, p in enumerate(model.parents) if p >= 0}
    assert bool(edges) == copies and edges <= {frozenset(e) for e in itertools.combinations((0, 3, 4), 2)}
    # Accuracies of the voters without parents.
    for j, (on, off) in {1: (0.7, 0.05), 2: (0.6, 0.02), 5: (0.3, 0.3)}.items():
        assert abs(model.fires[1, j, 0] - on) < 0.04 and abs(model.fires[0, j, 0] - off) < 0.02
    # Posteriors are those of Bayes' rule on the classes' own frequencies of each combination.
    posterior = model.posterior(bits)
    for b, n in Counter(bits.tolist()).most_common(12):
        assert abs(posterior[bits == b][0] - y[bits == b].mean()) < 4 * math.sqrt(0.25 / n) + 0.05


def test_posterior_by_hand():
    fires = np.full((2, VOTERS, 2), 0.5)
    fires[0, 0], fires[1, 0] = 0.1, 0.8
    fires[0, 1], fires[1, 1] = (0.2, 0.4), (0.3, 0.9)
    model = LabelModel(0.25, (-1, 0, *[-1] * (VOTERS - 2)), fires)
    for a, b in itertools.product((0, 1), repeat=2):
        logs = []
        for c, prior in ((0, 0.75), (1, 0.25)):
            one, two = fires[c, 0, 0], fires[c, 1, a]
            logs.append(prior * (one if a else 1 - one) * (two if b else 1 - two))
        assert model.posterior(np.array([a + 2 * b]))[0] == pytest.approx(logs[1] / sum(logs))


def test_logistic_fit_has_no_slope_left():
    rng = np.random.default_rng(2)
    x = (rng.random((300, 6)) < 0.3).astype(float)
    target, weight = rng.random(300), rng.random(300) + 0.5
    w = toxicity.fit_logistic(x, target, weight)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.abs(x.T @ (weight * (target - p)) - w[:-1]).max() < 1e-4
    assert abs(weight @ (target - p)) < 1e-3


def corpus(n=1500):
    """Texts of made-up words; toxic ones have two of thirty words that no list knows."""
    pick = random.Random(9)
    bad = [f"{a}{b}" for a in ("zonk", "blarg") for b in "abcdefghijklmno"]
    docs, labels = [], []
    for k in range(n):
        words = ["".join(pick.choice("aeiou") + pick.choice("lmnrst") for _ in range(pick.randint(1, 4)))
                 for _ in range(pick.randint(5, 60))]
        toxic = int(pick.random() < 0.15)
        for _ in range(2 * toxic):
            words.insert(pick.randint(0, len(words)), pick.choice(bad))
        docs.append((k, " ".join(words), 1))
        if k % 2:
            labels.append((k, toxic))
    return docs, labels


def test_words_that_no_list_knows_are_learned(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, Score int").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.classify(frame, marks, F.crc32(F.col("k").cast("string")) % 4 != 2)
    assert found.columns == ["doc_id", "text", "score"]
    score = {r.doc_id: r.score for r in found.collect()}
    held = [(k, t) for k, t in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    wrong = sum((score[k] >= 0.3) != bool(t) for k, t in held)
    assert len(held) > 100 and wrong <= len(held) * 0.05


def test_edge_rows(spark):
    docs = [(None, "you idiot", 1), (1, None, 2), (2, "", 3), (3, "fine words here", 4), (3, "fine words here", 4),
            (4, "moron " + "x " * 200_000, 5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, k int")
    for marks in ([], [(3, 0), (3, 0), (4, 1), (None, 1), (1, None), (2, 7)]):
        labels = spark.createDataFrame(marks, "doc_id long, toxic int")
        rows = toxicity.classify(frame, labels, F.lit(True)).collect()
        assert sorted(str(r[:3]) for r in rows) == sorted(str(d) for d in docs)
        by = {(r.doc_id, r.text): r.score for r in rows}
        assert all(0 <= s <= 1 for s in by.values()) and by[1, None] == by[2, ""]
        assert by[None, "you idiot"] > by[2, ""]
        assert toxicity.classify(frame.where("false"), labels, F.lit(True)).collect() == []


def test_held_out_labels(spark):
    rows = QUERIES["op12_toxicity"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert rows.count() == 1000
    clean = [r for r in held if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in held if r.toxic == 1) >= 8
