"""A training corpus from raw documents: five stages, each written and read by the next.

1. Quality rules: documents that fail a rule of the strict policy go.
2. Line dedup: lines that ten sources or more share stay in one document only.
3. SimHash near-dedup: of each group of near copies the document with the smallest id stays.
4. Mixing: sources are repeated until their weights have 0.95 of the entropy of equal ones, or one is
   read four times; the least repeated one is read once, so none is cut.
5. SentencePiece: texts become piece ids and are decoded again.

Rows: stage 1 rejects null and empty texts. Stage 3 leaves one row of repeated rows, and a row
without id only where its group has no id. Stage 4 repeats rows by design. Every stage passes the
columns it is given, whatever their names; the last one adds ``ids``, ``n_ids``, ``round_trip``.
An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import lines, mixing, pieces, quality, simhash
from candlewick.llm.common import free_name, stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MIX = mixing.Target(entropy=0.95, repeats=4.0)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, quality.STRICT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, MIX)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decoded = free_name(docs, "_decoded")
    coded = pieces.encode_documents(docs, MODEL, decoded=decoded)
    return coded.withColumn("n_ids", F.size("ids").cast("long")).withColumn(
        "round_trip", F.col(decoded).eqNullSafe(F.col("text"))
    ).drop(decoded)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Connected components of fingerprints and piece ids have no SQL; tests hold the rows against
# a brute-force form of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
