"""Compression classes: accuracy on held-out texts, rejection and edge rows."""

from __future__ import annotations

import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from candlewick.llm import language
from candlewick.llm.language import Classifier
from candlewick.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op5_language_id"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(docs, "doc_id")
    right = held.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right >= 0.98
    assert found.where("score < 0 OR score > 1 OR lang_pred = 'und'").count() == 0


def plain_judge(dictionaries, text):
    """Every chunk compressed anew with every dictionary."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, True
    data = text.lower().encode()
    sizes = []
    for name, content in dictionaries.items():
        total = 0
        for k in range(0, len(data), 512):
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            packer = zstandard.ZstdCompressor(
                level=6, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            total += len(packer.compress(data[k:k + 512]))
        sizes.append((total, name))
    (best, name), (second, _) = sorted(sizes)[:2]
    margin = (second - best) / second
    return name, margin / (margin + 0.02), margin < 0.02


def test_predictions_are_those_of_plain_compression(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    dictionaries = language.train(docs.where(learned))
    assert len(dictionaries) == 4
    for r in QUERIES["op5_language_id"](spark, "/root/testdata/sf0.001").join(docs, "doc_id").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred, r.score, r.rejected) == pytest.approx(plain_judge(dictionaries, r.text))


def test_every_language_is_learned(spark):
    rows = [(f"words{k} of{k} their{k} own{k} " * 8, f"l{k}") for k in range(1500)]
    assert len(language.train(spark.createDataFrame(rows, "text string, lang string"))) == 1500


ROWS = [(1, "the cat and the dog and the house " * 9, "en"), (2, "der Hund und die Katze " * 9, "de"),
        (3, None, "en"), (4, "", "de"), (5, "12 34 ½ .", "en"), (6, "the dog and the house", None),
        (6, "the dog and the house", None), (None, "und die Katze der", None)]


def test_edge_rows(spark):
    frame = spark.createDataFrame(
        [(*row, "x") for row in ROWS], "doc_id long, text string, lang string, score string"
    )
    out = language.identify(frame, F.lit(True))
    assert out.columns == [*frame.columns, "prediction"]
    again = language.identify(out, F.lit(True))
    assert again.columns == out.columns and sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
    got = {(r.doc_id, r.text): r.prediction for r in out.collect()}
    assert got[1, ROWS[0][1]].language == "en" and got[2, ROWS[1][1]].language == "de"
    assert got[6, "the dog and the house"].language == "en" and got[None, "und die Katze der"].language == "de"
    for key in ((3, None), (4, ""), (5, "12 34 ½ .")):
        assert tuple(got[key]) == ("und", 0.0, True)
    assert out.count() == len(ROWS)


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.identify(frame, F.lit(True)).first().prediction.language == "und"
    assert language.identify(frame.where("false"), F.lit(True)).count() == 0


def test_a_clashing_name_is_replaced(spark):
    frame = spark.createDataFrame([(1, "abc", 7)], "doc_id long, text string, prediction int").selectExpr("*", "'x' AS lang")
    out = language.identify(frame, F.lit(True))
    assert out.columns == frame.columns and out.first().prediction.language == "x"


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "TEXTS_PER_LANGUAGE", 5)
    monkeypatch.setattr(language, "CHARS_PER_TEXT", 10)
    rows = [(k, f"{k} some words of no use {k * k}", "ab"[k % 2]) for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.train(frame)
    assert set(found) == {"a", "b"}
    assert all(40 <= len(data) <= 54 for data in found.values())
    assert language.train(frame.orderBy(F.desc("doc_id"))) == found


def test_copies_leave_the_sample_whole(spark):
    few = [(f"{k} text of the first language {k * k}", "a") for k in range(50)]
    many = [(f"{k} text of the second language {k * k}", "b") for k in range(2001)]
    kinds = spark.createDataFrame([*few, *many], "text string, lang string")
    copied = kinds.where("lang = 'a' OR text = '7 text of the second language 49'")
    copies = copied.crossJoin(spark.range(4000)).drop("id")
    hot = copied.where("lang = 'b'").crossJoin(spark.range(200_000)).drop("id")
    found = language.train(kinds.unionByName(copies).unionByName(hot))
    assert len(found["a"].splitlines()) == 50
    assert len(found["b"].splitlines()) == language.TEXTS_PER_LANGUAGE
    assert found["b"] == language.train(kinds)["b"]


@pytest.mark.parametrize("text", ["x" * 500_000, "der die das " * 40_000])
def test_long_texts(text):
    model = Classifier({"de": b"der die das und " * 50, "en": b"the and of this " * 50})
    name, score, _ = model.judge(text)
    assert name in ("de", "en") and 0 <= score <= 1
