"""Each stage of the pipeline against a plain form, on a small table with awkward rows."""

from __future__ import annotations

import random

import corpus_pipeline
import sentencepiece

from candlewick.llm import quality

from .test_lines import plain as plain_lines
from .test_simhash import plain_components, plain_fingerprint

# Columns beyond those of the table, named like ones that operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, n int, "
    "ids string, e int, w string, `_mix` int, d string, h string, component long, fingerprint int"
)
EXTRA = ("i", 2, "w", 3, "d", "h", 4, 5)


def table():
    pick = random.Random(11)
    docs = []
    for k in range(150):
        words = [f"w{pick.randint(0, 300)}" for _ in range(60)]
        for copy in range(pick.choice([1, 1, 1, 3])):
            text = "Terms apply to all of this\n" * (k % 2) + " ".join(words) + f" end{copy}" * (copy > 0)
            docs.append((len(docs), text, "en", f"s{pick.randint(0, 14)}", len(text), "x", 1))
    docs += [docs[5], docs[5], (900, None, None, None, None, None, None), (901, "", "en", "s1", 0, "x", 1),
             (902, "$$$ ### " * 40, "en", "s2", 1, "x", 1), (None, docs[7][1], "en", None, 1, "x", 1),
             (None, " ".join(f"q{j}" for j in range(50)), "en", None, 1, "x", 1)]
    return [(*doc, *EXTRA) for doc in docs]


def run_stage(spark, k, docs):
    frame = spark.createDataFrame(docs, SCHEMA)
    out = corpus_pipeline.STAGES[k][1](spark, frame, "")
    assert k < 4 or len(out.columns) == len(frame.columns) + 2
    if k < 4:
        assert out.columns == frame.columns
    return [tuple(r) for r in out.collect()]


def test_stages_one_after_the_other(spark):
    docs = table()
    kept = run_stage(spark, 0, docs)
    strict = quality.STRICT
    assert strict.mask == sum(1 << r.bit for r in quality.RULES)
    assert {d[0] for d in docs} - {d[0] for d in kept} == {900, 901, 902}

    cleaned = run_stage(spark, 1, kept)
    want = [(i, t) for i, t, _ in plain_lines([(d[0], d[1], d[3], "m") for d in kept], 10)]
    assert sorted(((d[0], d[1]) for d in cleaned), key=str) == sorted(want, key=str)
    assert sum("Terms" in d[1] for d in cleaned) == 1

    single = run_stage(spark, 2, cleaned)
    group = plain_components([plain_fingerprint(d[1]) for d in cleaned], list(range(len(cleaned))))
    members = {}
    for g, d in zip(group, cleaned, strict=True):
        members.setdefault(g, []).append(d)
    assert len(single) == len(members)
    ids = {min((m[0] for m in x if m[0] is not None), default=None) for x in members.values()}
    assert {d[0] for d in single} == ids

    mixed = run_stage(spark, 3, single)
    assert {d[:2] for d in mixed} == {d[:2] for d in single} and len(mixed) >= len(single)

    coded = run_stage(spark, 4, mixed)
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.MODEL)
    assert len(coded) == len(mixed)
    assert all(d[-3] == library.encode(d[1]) and d[-2] == len(d[-3]) and d[-1] for d in coded)


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_given_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.where("NOT round_trip").count() == 0
    assert 0 < out.select("doc_id").distinct().count() <= 200
