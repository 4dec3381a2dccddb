"""Language identification by compression.

Each language gets a raw-content zstandard dictionary made of labelled texts. A text is encoded
once with every dictionary; the language whose dictionary gives the fewest bytes wins, and a text
whose two best sizes lie close together is marked as rejected.

The dictionaries are fitted on a bounded sample: for each language at most TEXTS_PER_LANGUAGE
different labelled texts, chosen by hash whatever the number of their copies, and CHARS_PER_TEXT
characters of each. There is a dictionary for each language label, so these are expected to be
languages, of which there are thousands at most. Every text is encoded whole, in chunks, so that a
long text still leans on the dictionary rather than on itself.

Rows: a null text, or one without a letter, is ``und`` with score 0 and rejected. Texts or labels
that are null are not learned from; if nothing can be learned, every text is ``und``. Equal texts
get equal predictions, and ties go to the first language in alphabetical order. ``prediction``
replaces a column of that name; others pass through. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from candlewick.llm.common import small_batches, stored

UNDETERMINED = "und"
TEXTS_PER_LANGUAGE = 256
CHARS_PER_TEXT = 256
# The shares of so many labels are sent to every task; more are joined by a shuffle.
SENT_LANGUAGES = 100_000
CHUNK_BYTES = 512
LEVEL = 6
MIN_MARGIN = 0.02

LETTER = regex.compile(r"\p{L}")
PREDICTION = StructType([
    StructField("language", StringType()), StructField("score", DoubleType()),
    StructField("rejected", BooleanType()),
])


def train(labelled: DataFrame, text: str = "text", language: str = "lang") -> dict[str, bytes]:
    """A dictionary per language. Hashes of the texts choose the sample, not their order."""
    rows = labelled.select(
        F.col(f"`{language}`").alias("language"), F.lower(F.col(f"`{text}`")).alias("text")
    ).where("language IS NOT NULL AND text IS NOT NULL AND text <> ''").withColumn(
        "pick", F.pmod(F.xxhash64("text"), F.lit(1 << 31))
    )
    # Thin the table before ranking, so that no language is sorted whole. Copies share one pick, so
    # the share comes from the different texts; four times as many as needed outweigh its error.
    shares = stored(rows.groupBy("language").agg(
        F.least(F.lit(1.0), 4.0 * TEXTS_PER_LANGUAGE / F.approx_count_distinct("pick")).alias("share")
    ), "language-shares")
    if shares.count() <= SENT_LANGUAGES:
        shares = F.broadcast(shares)
    thin = rows.join(shares, "language").where(F.col("pick") < F.col("share") * F.lit(float(1 << 31)))
    start = F.col("pick") % F.greatest(F.length("text") - CHARS_PER_TEXT + 1, F.lit(1)) + 1
    place = F.row_number().over(Window.partitionBy("language").orderBy("pick", "text"))
    sample = (
        thin.select(
            "language", "pick",
            F.col("text").substr(start.cast("int"), F.lit(CHARS_PER_TEXT)).alias("text"),
        )
        .distinct().withColumn("place", place).where(F.col("place") <= TEXTS_PER_LANGUAGE)
    )
    found: dict[str, list[str]] = {}
    for row in sample.orderBy("language", "place").collect():
        found.setdefault(row["language"], []).append(row["text"])
    return {name: "\n".join(texts).encode() for name, texts in found.items()}


class Classifier:
    """Compressors by language. ``judge`` gives (language, score, rejected) for one text."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.compressors = []
        for name in sorted(dictionaries):
            content = zstandard.ZstdCompressionDict(
                dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=LEVEL)
            packer = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=content, write_content_size=False,
                write_checksum=False, write_dict_id=False,
            )
            self.compressors.append((name, packer.compress))

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        if not self.compressors or text is None or not LETTER.search(text):
            return UNDETERMINED, 0.0, True
        data = text.lower().encode()
        chunks = [data[k:k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]
        sizes = sorted(
            (sum(len(pack(chunk)) for chunk in chunks), name) for name, pack in self.compressors
        )
        best = sizes[0]
        if len(sizes) == 1:
            return best[1], 1.0, False
        margin = (sizes[1][0] - best[0]) / sizes[1][0]
        return best[1], margin / (margin + MIN_MARGIN), margin < MIN_MARGIN


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> Column:
    """A struct (language, score, rejected). The score is one half at the rejection margin."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf(PREDICTION)
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(shared.value)
        for batch in texts:
            yield pd.DataFrame([model.judge(x) for x in batch], columns=PREDICTION.names)

    return predicted(F.col(f"`{text}`"))


def identify(
    docs: DataFrame, learn_from: Column, text: str = "text", language: str = "lang",
    prediction: str = "prediction",
) -> DataFrame:
    """The rows with a struct ``prediction``, learned from the rows where ``learn_from`` is true.

    A column that has this name is replaced.
    """
    dictionaries = train(docs.where(learn_from), text, language)
    return small_batches(docs).withColumn(prediction, classify(docs, dictionaries, text))
