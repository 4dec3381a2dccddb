"""One query per operator over its whole table, and SQL with the same rows where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    language, lines, merkle, mixing, packing, periods, pieces, quality, sharding, simhash, sites,
    spots, toxicity,
)

TOKENIZERS = "/opt/tokenizers"
END_ID = 50256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run
    return register


# The unsigned crc32 of a decimal doc_id, bit by bit.
SQL_CRC32 = """xor(list_reduce(
  list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda k: ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT),
  lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
  4294967295::BIGINT), 4294967295)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


SQL_QUALITY = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(regexp_extract_all(t, '[A-Z]')) AS n_capitals,
         len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_stutters
  FROM d LEFT JOIN covered USING (doc_id)),
b AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
         + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
         + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT
         + 64 * (100 * n_capitals > 40 * word_chars)::BIGINT
         + 128 * (100 * n_stutters > 30 * n_words)::BIGINT AS failed
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed = 0 AS kept, failed
FROM b"""


@query("op4_quality_rules", SQL_QUALITY)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.with_ledger(documents(spark, sf_dir))
    failed = F.col("ledger.failed")
    return judged.select(
        "doc_id", "ledger.n_words", "ledger.word_chars", "ledger.n_symbols", "ledger.n_dup_lines",
        "ledger.n_repeat_words", (~quality.passes(quality.BASE, failed)).alias("base_failed"),
        quality.passes(quality.STRICT, failed).alias("kept"), failed.alias("failed"),
    )


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    found = language.identify(docs, ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), F.col("prediction.language").alias("lang_pred"),
        F.col("prediction.score").alias("score"), F.col("prediction.rejected").alias("rejected"),
    )


@query("op6_token_packing")
def op6_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        documents(spark, sf_dir), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", END_ID
    )


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = pieces.encode_documents(docs, model, decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


SHARDS = 24


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


SQL_LINES = r"""
WITH each AS (
  SELECT doc_id, source, line, p
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents)),
shared AS (
  SELECT line, min(doc_id) AS first_id FROM each
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY line HAVING count(DISTINCT source) >= 10),
judged AS (
  SELECT doc_id, line, p, coalesce(first_id <> doc_id, false) AS gone
  FROM each LEFT JOIN shared USING (line))
SELECT doc_id, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id"""


@query("op9_line_dedup", SQL_LINES)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_boilerplate(documents(spark, sf_dir), removed="n_removed")
    return cleaned.select("doc_id", "n_removed", "text")


# As many tokens as there are, dealt anew: sources grow apart or closer until the entropy is met.
MIX_TARGET = mixing.Target(entropy=0.95, repeats=4.0, read=1.0)


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"), MIX_TARGET, detail="mix")
    return mixed.select(
        "doc_id", "source", "mix.epoch", "mix.rank", "mix.weight", "mix.n_tokens"
    )


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = sites.classify(
        documents(spark, sf_dir), labels, "doc_id", "text", F.col("source"), F.col("lang"), "quality"
    )
    return found.withColumn("kept", F.col("posterior") >= 0.5)


@query("op8_spotsigs")
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.edited_fingerprints(documents(spark, sf_dir))


def looped_words(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, chosen by id, repeat some of their words to the end.

    Of n words those from ``a`` on are the ``p`` words that start there, again and again.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    found = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    at = found.withColumn("n", n).withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    size = F.col("n") - F.col("a")
    cycle = at.withColumn("p", (1 + F.floor(size / (3 + F.col("g") % 8))).cast("int"))
    rounds = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(size / F.col("p")).cast("int"))
    looped = F.concat(
        F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(rounds), F.lit(1), size)
    )
    text = F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(looped, " "))
    return cycle.select("doc_id", text.alias("text"))


SQL_RUNS = rf"""
WITH d AS (
  SELECT doc_id, {SQL_CRC32} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sized AS (
  SELECT doc_id, len(w) AS n, h // 10 AS g,
         CASE WHEN h % 10 = 0 AND n > 0 THEN h // 10 % n END AS a FROM d),
original AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
placed AS (
  SELECT doc_id, n, i, CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END AS j
  FROM original JOIN sized USING (doc_id)),
words AS (
  SELECT p.doc_id, p.n, p.i, o.word FROM placed p JOIN original o ON o.doc_id = p.doc_id AND o.i = p.j),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x
  JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs)
  GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
top AS (
  SELECT * FROM runs QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words w
  WHERE NOT EXISTS (
    SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id
    AND w.i BETWEEN r.start + r.period AND r.start + r.length - 1)
  GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
       1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM sized LEFT JOIN listed USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op13_periodic_runs", SQL_RUNS)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.with_runs(looped_words(documents(spark, sf_dir)))
    # Runs come by start and period, so of equal exponents the first one stays.
    most = F.aggregate(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )
    lines = F.transform("runs", lambda run: F.concat(
        F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")
    ))
    digests = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), most.alias("top"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return digests.select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


# Levels of a tree that the SQL can count: 16 ** 5 leaves.
SQL_LEVELS = 5


def sql_encoded(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def sql_leaf(text: str) -> str:
    return f"sha256({' || '.join(map(sql_encoded, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def sql_tree(name: str, leaves: str) -> str:
    """The levels of all trees; ``leaves`` has t (tree), i (place), n (leaves of the tree), h."""
    levels = [f"{name}0 AS ({leaves})"]
    for k in range(SQL_LEVELS):
        levels.append(f"""{name}{k + 1} AS (
      SELECT t, i // 16 AS i, (n + 15) // 16 AS n,
             CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h
      FROM {name}{k} GROUP BY t, i // 16, n)""")
    return ", ".join(levels)


def sql_climb(name: str, start: str) -> str:
    """(doc_id, t, i, h, proof) of ``start`` folded to the last node, proofs growing on the way."""
    steps, before = [], start
    for k in range(SQL_LEVELS):
        steps.append(f"""{name}_up{k} AS (
      SELECT b.doc_id, b.t, b.i // 16 AS i,
             CASE WHEN any_value(x.n) > 1 THEN sha256(
               coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < b.i), '') || b.h
               || coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > b.i), '')) ELSE b.h END AS h,
             b.proof || coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i <> b.i), '') AS proof
      FROM {before} b JOIN {name}{k} x ON x.t IS NOT DISTINCT FROM b.t AND x.i // 16 = b.i // 16
      GROUP BY b.doc_id, b.t, b.i, b.h, b.proof)""")
        before = f"{name}_up{k}"
    return ", ".join(steps)


SQL_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_MANIFEST = f"""
WITH d AS (
  SELECT doc_id, source AS t, {sql_leaf('text')} AS leaf, {sql_leaf(SQL_LOWER)} AS lower_leaf,
         {SQL_CRC32} % 5 = 0 AS tampered FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id) - 1 AS i,
         count(*) OVER (PARTITION BY t) AS n FROM d),
{sql_tree('a', 'SELECT t, i, n, leaf AS h FROM placed')},
subroots AS (
  SELECT t AS source, h, row_number() OVER (ORDER BY t NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM a{SQL_LEVELS}),
{sql_tree('r', 'SELECT 0 AS t, i, n, h FROM subroots')},
begun AS (
  SELECT doc_id, t, i, CASE WHEN tampered THEN lower_leaf ELSE leaf END AS h, '' AS proof FROM placed),
{sql_climb('a', 'begun')},
crossed AS (
  SELECT b.doc_id, 0 AS t, s.i, b.h, b.proof
  FROM a_up{SQL_LEVELS - 1} b JOIN subroots s ON s.source IS NOT DISTINCT FROM b.t),
{sql_climb('r', 'crossed')}
SELECT doc_id, p.leaf, s.h AS subroot, r{SQL_LEVELS}.h AS root, sha256(u.proof) AS proof_sha256,
       u.h AS folded_root, u.h = r{SQL_LEVELS}.h AS verified
FROM placed p JOIN r_up{SQL_LEVELS - 1} u USING (doc_id)
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.t CROSS JOIN r{SQL_LEVELS}"""


@query("op11_merkle_manifest", SQL_MANIFEST)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", capitals, capitals.lower())
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = documents(spark, sf_dir).select(
        F.col("source").alias("tree"), F.col("doc_id").alias("key"),
        merkle.leaf_digest(*fields, F.col("text")).alias("digest"),
        F.when(tampered, merkle.leaf_digest(*fields, lowered)).alias("changed"),
    )
    return merkle.manifest(leaves).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", "proof").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    fold = F.crc32(F.col("k").cast("string")) % 4
    found = toxicity.classify(docs, labels, fold != 2)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
