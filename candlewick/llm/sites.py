"""Quality of documents by hierarchical empirical Bayes over their sites.

A logistic classifier of a text's form gives each document its own evidence. Documents of one host,
and of one path below it, then lend each other strength: a host's share of good documents is the
mean of a Beta posterior whose prior has the global mean, a path's share one whose prior has its
host's mean. How strongly the priors pull is estimated from the spread between groups beyond what
chance gives, so sparse sites shrink to the global mean and large ones keep their own. A
document's posterior odds are its evidence with the global prior odds replaced by those of its
path; its own evidence is left out of its path and host first.

The classifier is fitted on at most MAX_LABELS labelled texts, chosen by hash; all else uses every
document. Sums per host and path are partial sums before the shuffle, so a hot host costs no more.

Rows: a null or empty text has the features of an empty one. Null hosts and paths are groups like
others. Repeated rows are documents like others. Without labels of both kinds every document has
evidence one half. Very long texts are measured whole. Other columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import small_batches, stored
from candlewick.llm.quality import MEASURES, measure_text

MAX_LABELS = 20_000
RIDGE = 1.0
NEWTON_STEPS = 25
MOST_LOGIT = 30.0
MOST_PULL = 1e6

_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n",
    b".,;:'\"-()", b"!?", b"#*$%&|<>", b"@/\\_=+^~`[]{}",
]
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _bytes in enumerate(_CLASSES):
    _CLASS_OF[list(_bytes)] = _k


def features(data: bytes | None) -> list[float]:
    """Shares and ratios that describe a text's form, each of moderate size."""
    data = data or b""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = np.bincount(_CLASS_OF, weights=counts, minlength=len(_CLASSES) + 1)
    m = dict(zip(MEASURES, measure_text(data), strict=True))
    words, lines, total = max(1, m["n_words"]), max(1, m["n_lines"]), max(1, len(data))
    return [
        *(classes / total), np.log1p(m["n_words"]), m["word_chars"] / words / 10,
        min(4.0, m["n_symbols"] / words), m["n_dup_lines"] / lines, m["n_repeat_words"] / words,
        m["n_stutters"] / words, min(4.0, classes[6] / words), np.log1p(words / lines),
    ]


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([RIDGE] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -MOST_LOGIT, MOST_LOGIT)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, marks: DataFrame) -> np.ndarray | None:
    """Weights from at most MAX_LABELS labelled texts, or None if there is only one kind.

    ``docs`` has (k, text) and ``marks`` (k, label); labels other than 0 and 1 do not count. The
    sample is drawn from the labels, so it is small enough to be sent to where the texts are.
    Equal marks count once, and of the texts of one k the one with the least hash does.
    """
    sample = (
        marks.where("k IS NOT NULL AND label IN (0, 1)").distinct()
        .orderBy(F.xxhash64("k", "label"), "k", "label").limit(MAX_LABELS)
    )

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [features(t) for t in batch["text"]], "label": batch["label"]})

    # Where an id repeats, partial aggregation leaves one text per task before the shuffle.
    mark = F.struct(F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c"))
    held = docs.join(F.broadcast(sample.select("k").distinct()), "k").select("k", "text", mark.alias("mark"))
    one = held.groupBy("k").agg(F.min_by("text", "mark").alias("text"))
    joined = one.join(F.broadcast(sample), "k").select(F.col("text").cast("binary").alias("text"), "label")
    rows = joined.mapInPandas(described, "x array<double>, label int").toPandas()
    if rows["label"].nunique() < 2:
        return None
    x, y = np.array(rows["x"].tolist()), rows["label"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # sums of doubles depend on their order
    return fit(x[order], y[order])


def evidence(docs: DataFrame, weights: np.ndarray | None, text: str = "text") -> Column:
    """The classifier's probability that a text is good."""
    fixed = None if weights is None else weights.tolist()

    @F.pandas_udf("double")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            if fixed is None:
                yield pd.Series(np.full(len(batch), 0.5))
            else:
                x = np.array([features(t) for t in batch]).reshape(-1, len(fixed) - 1)
                z = np.clip(x @ np.array(fixed[:-1]) + fixed[-1], -MOST_LOGIT, MOST_LOGIT)
                yield pd.Series(1 / (1 + np.exp(-z)))

    return judged(F.col(f"`{text}`").cast("binary"))


def pull(groups: DataFrame, good: str, n: str, centre: Column) -> float:
    """The prior's weight in documents, by the method of moments over groups.

    The squared deviations of the groups' means from their centre, less what chance alone gives,
    are the variance between groups; a Beta prior with that variance has this weight.
    """
    mean = F.col(good) / F.col(n)
    chance = centre * (1 - centre)
    sums = groups.agg(
        F.sum(F.col(n) * (mean - centre) ** 2).alias("apart"), F.sum(chance).alias("chance"),
        F.sum(F.col(n)).alias("n"), F.sum(F.col(n) * chance).alias("inner"),
    ).first()
    between = max(0.0, (sums["apart"] or 0.0) - (sums["chance"] or 0.0)) / max(1.0, sums["n"] or 0)
    inner = (sums["inner"] or 0.0) / max(1.0, sums["n"] or 0)
    return MOST_PULL if between * MOST_PULL <= inner else max(1.0, inner / between - 1)


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(safe / (1 - safe))


def posteriors(scored: DataFrame) -> DataFrame:
    """The rows (host, path, evidence and others) with host_mean, path_mean and posterior."""
    paths = stored(
        scored.groupBy("host", "path").agg(F.sum("evidence").alias("path_good"), F.count("*").alias("path_n")),
        "site-paths",
    )
    hosts = paths.groupBy("host").agg(F.sum("path_good").alias("host_good"), F.sum("path_n").alias("host_n"))
    total = paths.agg(F.sum("path_good").alias("good"), F.sum("path_n").alias("n")).first()
    if not total["n"]:
        mean = 0.5
    else:
        mean = min(max(total["good"] / total["n"], 1e-6), 1 - 1e-6)
    to_global = pull(hosts, "host_good", "host_n", F.lit(mean))
    named = hosts.withColumnRenamed("host", "h")
    both = paths.join(named, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    centre = (F.col("host_good") + to_global * mean) / (F.col("host_n") + to_global)
    to_host = pull(both, "path_good", "path_n", centre)
    sums = both.select(
        F.col("host").alias("h"), F.col("path").alias("p"), "path_good", "path_n", "host_good", "host_n"
    )
    joined = scored.join(sums, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    own = F.col("evidence")
    host_mean = (F.col("host_good") - own + to_global * mean) / (F.col("host_n") - 1 + to_global)
    path_mean = (F.col("path_good") - own + to_host * F.col("host_mean")) / (F.col("path_n") - 1 + to_host)
    odds = _logit(own) + _logit(F.col("path_mean")) - _logit(F.lit(mean))
    return (
        joined.withColumn("host_mean", host_mean).withColumn("path_mean", path_mean)
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .select(*(f"`{c}`" for c in scored.columns), "host_mean", "path_mean", "posterior")
    )


def classify(
    docs: DataFrame, labels: DataFrame, id_column: str, text: str, host: Column, path: Column,
    label: str,
) -> DataFrame:
    """doc_id, host, path, evidence, host_mean, path_mean, posterior for every document.

    ``labels`` has the id column and ``label``.
    """
    marks = labels.select(F.col(f"`{id_column}`").alias("k"), F.col(f"`{label}`").cast("int").alias("label"))
    texts = docs.select(F.col(f"`{id_column}`").alias("k"), F.col(f"`{text}`").alias("text"))
    weights = train(texts, marks)
    scored = stored(
        small_batches(docs).select(
            F.col(f"`{id_column}`").alias("doc_id"), host.cast("string").alias("host"),
            path.cast("string").alias("path"), evidence(docs, weights, text).alias("evidence"),
        ),
        "site-evidence",
    )
    return posteriors(scored)
