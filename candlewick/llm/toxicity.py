"""Toxicity by weak supervision.

1. Voters. VOTERS lexicons and patterns each look at a text and fire or not. Some are word lists and
   phrases given here; the others are dealt the words and word beginnings that are more frequent
   among texts labelled toxic than chance explains.
2. Label model. How often each combination of votes occurs is counted over all documents; combinations
   number at most 2 ** VOTERS, whatever the number of documents. Expectation maximisation on the
   counts estimates how often a text is toxic, how often each voter fires on toxic and on other
   texts, and which voters depend on each other beyond that: each voter may have one other voter as
   parent (a tree of the strongest dependences, taken from labelled texts where there are any), so
   that correlated voters do not count twice. Labels, where there are any, fix the class of their texts; without any the given lists
   start the estimate, and voters that nearly always agree may then be taken for the class. The
   result is a posterior for each combination.
3. Classifier. A ridge logistic regression learns the posteriors from votes and from the words that
   go with high posteriors, and so also learns words that no voter knows. It scores every text.

Bounds, all parameters: MAX_LABELS labelled rows are used, chosen by hash of id; MAX_FIT documents on
either side of posterior 1/2 are sampled by hash for the classifier; lexicon and classifier have at
most MAX_TERMS terms each. Votes and their counts cover all documents, and texts are read whole.

Rows: a null or empty text has no votes and the score of a text without known words. Repeated rows
get equal scores; of several labels of one id the highest counts; null ids and labels other than
0 and 1 teach nothing. Without labels the given lists alone teach. The column ``score`` replaces one
of that name; others pass through. No rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import free_name, small_batches, stored, without, word_runs

MAX_LABELS = 50_000
MAX_FIT = 10_000
MAX_TERMS = 400
FLUSH_TERMS = 200_000
STEM_LETTERS, STEMMED = 4, 6
# A beginning is shared by more words, harmless ones among them, and must tell more.
Z, LEAST_LOG_ODDS, LEAST_STEM_LOG_ODDS = 1.64, 1.5, 3.0
RIDGE, NEWTON_STEPS, MOST_LOGIT = 1.0, 25, 30.0
EM_NAIVE, EM_TREE, SMOOTHING = 60, 60, 1.0
LEAST_INFORMATION, CHANCE_INFORMATION = 1e-3, 6.0
PICKS = 1 << 31

# Word lists of the given voters.
LISTS = {
    "foolish": "idiot idiots moron morons stupid dumb imbecile fool brainless clown retard cretin dimwit halfwit",
    "worthless": "worthless pathetic loser losers useless trash garbage scum vermin filth parasite coward",
    "disgust": "disgusting disgust repulsive vile sickening gross hideous filthy revolting ugly",
    "profane": "damn shit bullshit crap fuck fucking bitch bastard asshole whore slut dick piss",
    "foreign": (
        "dumm blöd trottel arschloch scheiße abschaum versager hurensohn stupide connard salaud merde "
        "ordure imbécile débile estúpido idiota imbécil basura mierda puta cabrón asqueroso inútil"
    ),
}
# Phrases, looked for where the first word occurs at all.
PHRASES = {
    "shut": r"\bshut (?:the \w+ )?up\b", "hate": r"\bhate (?:you|them|him|her)\b",
    "hell": r"\b(?:go to|rot in) hell\b", "kill": r"\bkill (?:yourself|you|them|him|her)\b",
    "die": r"\b(?:go|should|must) die\b", "hang": r"\bhang (?:yourself|him|her|them)\b",
}
ADDRESS = "you your you're du dich dein tu toi ton tú tus usted"
DIRECT, PHRASE, LOUD = "direct", "phrase", "loud"
WORD_VOTERS, STEM_VOTERS = 6, 2
VOTER_NAMES = (
    *LISTS, DIRECT, PHRASE, LOUD, *(f"words_{k}" for k in range(WORD_VOTERS)),
    *(f"stems_{k}" for k in range(STEM_VOTERS)),
)
VOTERS = len(VOTER_NAMES)
BIT = {name: 1 << k for k, name in enumerate(VOTER_NAMES)}
GIVEN = sum(BIT[name] for name in (*LISTS, DIRECT, PHRASE, LOUD))
LOUD_MARKS = 3

_LETTERS = re.compile(r"[^\W\d_]+")
_PHRASES = {word: re.compile(pattern) for word, pattern in PHRASES.items()}
_GIVEN_WORDS = {word: BIT[name] for name, words in LISTS.items() for word in words.split()}
_DIRECT = re.compile(
    rf"\b(?:{'|'.join(ADDRESS.split())})\b[^.!?\n]{{0,40}}\b(?:{'|'.join(sorted(_GIVEN_WORDS))})\b"
)


def terms_of(data: bytes | None) -> set[str]:
    """The distinct words of a text in lower case, and the beginnings of the longer ones."""
    words: set[str] = set()
    for run in word_runs(data or b""):
        words.update(_LETTERS.findall(b" ".join(run).decode().lower()))
    return words | {word[:STEM_LETTERS] + "*" for word in words if len(word) >= STEMMED}


def votes(data: bytes | None, terms: set[str], lexicon: dict[str, int]) -> int:
    """The bits of the voters that fire; ``lexicon`` has the learned terms' voters."""
    bits = 0
    for term in terms & lexicon.keys():
        bits |= lexicon[term]
    given = terms & _GIVEN_WORDS.keys()
    for word in given:
        bits |= _GIVEN_WORDS[word]
    data = data or b""
    if data.count(b"!") >= LOUD_MARKS:
        bits |= BIT[LOUD]
    told = terms & _PHRASES.keys()
    if given or told:
        text = data.decode().lower()
        if any(_PHRASES[word].search(text) for word in told):
            bits |= BIT[PHRASE]
        if given and _DIRECT.search(text):
            bits |= BIT[DIRECT]
    return bits


# ---- terms that go with a class ----------------------------------------------------------


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): the weight of the texts with a term by class; the empty term has all.

    ``rows`` has ``text`` (binary), ``toxic`` and ``weight``. Tasks add up their own texts first.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list[float]] = {}
        for batch in batches:
            for data, toxic, weight in zip(batch["text"], batch["toxic"], batch["weight"], strict=True):
                for term in ("", *terms_of(data)):
                    known = sums.setdefault(term, [0.0, 0.0])
                    known[0] += toxic * weight
                    known[1] += (1 - toxic) * weight
                if len(sums) > FLUSH_TERMS:
                    yield _sums(sums)
                    sums = {}
        yield _sums(sums)

    each = rows.select("text", "toxic", "weight").mapInPandas(counted, "term string, toxic double, clean double")
    return each.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _sums(sums: dict[str, list[float]]) -> pd.DataFrame:
    table = np.array(list(sums.values())).reshape(-1, 2)
    terms = pd.Series(list(sums), dtype=object)
    return pd.DataFrame({"term": terms, "toxic": table[:, 0], "clean": table[:, 1]})


def telling_terms(rows: DataFrame, most: int = MAX_TERMS) -> list[str]:
    """Terms whose log odds of the toxic class are surely high, the surest first."""
    counts = stored(term_counts(rows), "toxic-terms")
    whole = counts.where("term = ''").first()
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return []
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (whole["toxic"] + 1)) - F.log(b / (whole["clean"] + 1))
    sure = F.round(odds - Z * F.sqrt(1 / a + 1 / b), 9)
    least = F.when(F.endswith("term", F.lit("*")), LEAST_STEM_LOG_ODDS).otherwise(LEAST_LOG_ODDS)
    found = counts.where("term <> '' AND toxic > 1").withColumn("sure", sure).where(F.col("sure") > least)
    return [row["term"] for row in found.orderBy(F.desc("sure"), "term").limit(most).collect()]


def dealt(terms: list[str]) -> dict[str, int]:
    """Learned terms dealt to voters in turn, so that voters are about equally good."""
    stems = [term for term in terms if term.endswith("*")]
    words = [term for term in terms if not term.endswith("*")]
    lexicon = {word: BIT[f"words_{k % WORD_VOTERS}"] for k, word in enumerate(words)}
    return lexicon | {stem: BIT[f"stems_{k % STEM_VOTERS}"] for k, stem in enumerate(stems)}


# ---- the label model ---------------------------------------------------------------------


@dataclass(frozen=True)
class LabelModel:
    """``fires[c, j, v]``: how often voter j fires on class c if its parent's vote is v."""

    prior: float
    parents: tuple[int, ...]  # -1: none
    fires: np.ndarray

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        """The probability of the toxic class for each combination of votes."""
        x = bit_matrix(bits)
        logs = []
        for c, share in enumerate((1 - self.prior, self.prior)):
            total = np.full(len(x), math.log(share))
            for j, parent in enumerate(self.parents):
                fire = self.fires[c, j, x[:, parent]] if parent >= 0 else self.fires[c, j, 0]
                total += np.log(np.where(x[:, j] == 1, fire, 1 - fire))
            logs.append(total)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -MOST_LOGIT, MOST_LOGIT)))


def bit_matrix(bits: np.ndarray) -> np.ndarray:
    return (np.asarray(bits, np.int64)[:, None] >> np.arange(VOTERS)) & 1


def _maximised(x: np.ndarray, weights: tuple[np.ndarray, np.ndarray], parents: tuple[int, ...]) -> LabelModel:
    totals = [w.sum() for w in weights]
    fires = np.empty((2, VOTERS, 2))
    for c, w in enumerate(weights):
        alone = (w @ x + SMOOTHING * 0.01) / (totals[c] + SMOOTHING)
        for j, parent in enumerate(parents):
            for v in (0, 1):
                here = w if parent < 0 else w * (x[:, parent] == v)
                fires[c, j, v] = (here @ x[:, j] + SMOOTHING * alone[j]) / (here.sum() + SMOOTHING)
    prior = (totals[1] + SMOOTHING) / (sum(totals) + 2 * SMOOTHING)
    return LabelModel(float(prior), parents, np.clip(fires, 1e-6, 1 - 1e-6))


def dependences(x: np.ndarray, weights: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Mutual information of two voters within the classes, for all pairs."""
    total = sum(w.sum() for w in weights)
    found = np.zeros((VOTERS, VOTERS))
    for w in weights:
        share = max(w.sum(), 1e-12)
        both = (x * w[:, None]).T @ x / share
        one = np.diag(both)
        for a in (0, 1):
            for b in (0, 1):
                pa, pb = (one if a else 1 - one)[:, None], (one if b else 1 - one)[None, :]
                joint = {
                    (1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both,
                    (0, 0): 1 - one[:, None] - one[None, :] + both,
                }[a, b]
                joint = np.maximum(joint, 0.0)
                safe = np.where(joint > 1e-12, joint / np.maximum(pa * pb, 1e-12), 1.0)
                found += share / total * joint * np.log(safe)
    np.fill_diagonal(found, 0.0)
    return found


def dependence_tree(information: np.ndarray, texts: float) -> tuple[int, ...]:
    """Each voter's parent in the tree of the strongest dependences, without those that are weak or
    that chance gives in so many texts."""
    least = max(LEAST_INFORMATION, CHANCE_INFORMATION / max(texts, 1.0))
    parents, inside = [-1] * VOTERS, [0]
    while len(inside) < VOTERS:
        rest = [j for j in range(VOTERS) if j not in inside]
        gain, j, parent = max((information[i, j], -j, i) for i in inside for j in rest)
        if gain > least:
            parents[-j] = parent
        inside.append(-j)
    return tuple(parents)


def fit_label_model(patterns: pd.DataFrame) -> LabelModel:
    """From ``bits`` and the documents ``n`` with them, labelled ``toxic``, ``clean`` or not."""
    patterns = patterns.sort_values("bits")
    x = bit_matrix(patterns["bits"].to_numpy())
    toxic, clean = patterns["toxic"].to_numpy(float), patterns["clean"].to_numpy(float)
    open_ = patterns["n"].to_numpy(float) - toxic - clean
    none = tuple([-1] * VOTERS)
    labelled = bool(toxic.sum() and clean.sum())
    if labelled:
        model = _maximised(x, (clean, toxic), none)
        r = model.posterior(patterns["bits"].to_numpy())
    else:
        r = np.where(patterns["bits"].to_numpy() & GIVEN, 0.9, 0.05)
    parents = none
    for step in range(EM_NAIVE + EM_TREE):
        weights = (clean + open_ * (1 - r), toxic + open_ * r)
        if step == EM_NAIVE:
            # Posteriors that take voters for independent hide what they share; labels do not.
            seen = (clean, toxic) if labelled else weights
            parents = dependence_tree(dependences(x, seen), sum(w.sum() for w in seen))
        model = _maximised(x, weights, parents)
        r = model.posterior(patterns["bits"].to_numpy())
    return model


# ---- the classifier ----------------------------------------------------------------------


def fit_logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression on targets between 0 and 1; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    w[-1] = math.log((weight @ target + 1) / (weight @ (1 - target) + 1))
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -MOST_LOGIT, MOST_LOGIT)))
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (weight * (target - p)) - penalty * w)
        w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    """Voters' learned terms, the label model, and the classifier's weights."""

    lexicon: dict[str, int]
    label_model: LabelModel
    vote_weights: list[float]
    term_weights: dict[str, float]
    constant: float

    def score(self, data: bytes | None) -> float:
        terms = terms_of(data)
        bits = votes(data, terms, self.lexicon)
        total = self.constant + sum(w for k, w in enumerate(self.vote_weights) if bits >> k & 1)
        # In a fixed order, as sums of doubles depend on it.
        total += sum(self.term_weights[term] for term in sorted(terms & self.term_weights.keys()))
        return 1 / (1 + math.exp(-min(max(total, -MOST_LOGIT), MOST_LOGIT)))


def with_votes(docs: DataFrame, lexicon: dict[str, int], text: str, name: str) -> DataFrame:
    """The rows with the bits of their voters."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("long")
    def voted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([votes(x, terms_of(x), shared.value) for x in batch], dtype="int64")

    return small_batches(docs).withColumn(name, voted(F.col(f"`{text}`").cast("binary")))


def marked(labels: DataFrame, learn_from: Column) -> DataFrame:
    """(k, toxic) of at most MAX_LABELS ids, of rows (k, toxic) where ``learn_from`` holds."""
    known = labels.where(learn_from).where("k IS NOT NULL AND toxic IN (0, 1)")
    one = known.groupBy("k").agg(F.max("toxic").cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("k"), "k").limit(MAX_LABELS)


def sample(docs: DataFrame, lexicon: dict[str, int], model: LabelModel, patterns: pd.DataFrame) -> DataFrame:
    """(text, bits, toxic, weight) of at most MAX_FIT documents on each side of posterior 1/2.

    ``docs`` has (k, text). Weights restore the shares that the sides have among all documents.
    """
    high = model.posterior(patterns["bits"].to_numpy()) >= 0.5
    n = patterns["n"].to_numpy(float)
    sides = {True: n[high].sum(), False: n[~high].sum()}
    share = {side: min(1.0, 1.5 * MAX_FIT / max(count, 1.0)) for side, count in sides.items()}
    pick = F.pmod(F.xxhash64("k", "text"), F.lit(PICKS)) / F.lit(float(PICKS))
    thin = docs.withColumn("pick", pick).where(F.col("pick") < max(share.values()))
    voted = with_votes(thin, lexicon, "text", "bits")
    table = model.posterior(patterns["bits"].to_numpy()).tolist()
    known = docs.sparkSession.createDataFrame(
        list(zip(patterns["bits"].tolist(), table, strict=True)), "b long, toxic double"
    )
    # One row per combination of votes, at most 2 ** VOTERS.
    side_share = F.when(F.col("toxic") >= 0.5, F.lit(share[True])).otherwise(F.lit(share[False]))
    judged = voted.join(F.broadcast(known), F.col("bits") == F.col("b")).drop("b")
    held = stored(judged.where(F.col("pick") < side_share), "toxic-judged")
    parts = [
        held.where((F.col("toxic") >= 0.5) == F.lit(side)).orderBy("pick", "k", "text").limit(MAX_FIT)
        .withColumn("high", F.lit(side)) for side in sides
    ]
    both = stored(parts[0].unionByName(parts[1]), "toxic-sample")
    taken = {row["high"]: row["count"] for row in both.groupBy("high").count().collect()}
    whole = max(sum(taken.values()), 1) / max(sum(sides.values()), 1.0)
    weight = {side: sides[side] * whole / max(taken.get(side, 0), 1) for side in sides}
    return both.select(
        F.col("text").cast("binary").alias("text"), "bits", "toxic",
        F.when(F.col("high"), F.lit(weight[True])).otherwise(F.lit(weight[False])).alias("weight"),
    )


def fit_classifier(rows: DataFrame) -> tuple[list[float], dict[str, float], float]:
    """Weights of votes and of terms, and the constant, from a bounded sample."""
    terms = telling_terms(rows)
    places = {term: k for k, term in enumerate(terms)}

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = [sorted(places[t] for t in terms_of(x) & places.keys()) for x in batch["text"]]
            yield pd.DataFrame({"at": at, **{c: batch[c] for c in ("bits", "toxic", "weight")}})

    each = rows.mapInPandas(found, "at array<int>, bits long, toxic double, weight double")
    # Texts with the same votes and terms are one row; most have neither.
    merged = each.groupBy("at", "bits", "toxic").agg(F.sum("weight").alias("weight"))
    table = merged.toPandas()
    if table.empty:
        return [0.0] * VOTERS, {}, 0.0
    order = sorted(range(len(table)), key=lambda k: (table["bits"][k], tuple(table["at"][k]), table["toxic"][k]))
    table = table.iloc[order].reset_index(drop=True)
    x = np.zeros((len(table), VOTERS + len(terms)), np.float32)
    x[:, :VOTERS] = bit_matrix(table["bits"].to_numpy())
    for k, at in enumerate(table["at"]):
        x[k, VOTERS + np.asarray(at, int)] = 1
    w = fit_logistic(x, table["toxic"].to_numpy(float), table["weight"].to_numpy(float))
    return w[:VOTERS].tolist(), dict(zip(terms, w[VOTERS:-1].tolist(), strict=True)), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, learn_from: Column) -> Model:
    """``docs`` has (k, text), ``labels`` (k, toxic); ``learn_from`` is a condition on k."""
    marks = stored(marked(labels, learn_from), "toxic-marks")
    held = docs.join(F.broadcast(marks), "k")
    labelled = held.select(
        F.col("text").cast("binary").alias("text"), F.col("toxic").cast("double").alias("toxic"),
        F.lit(1.0).alias("weight"),
    )
    lexicon = dealt(telling_terms(labelled))
    voted = with_votes(docs, lexicon, "text", "bits").select("k", "bits")
    known = voted.join(F.broadcast(marks), "k", "left")
    patterns = known.groupBy("bits").agg(
        F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("toxic"),
        F.count_if(F.col("toxic") == 0).alias("clean"),
    ).toPandas()
    if patterns.empty:
        return Model({}, LabelModel(0.5, (-1,) * VOTERS, np.full((2, VOTERS, 2), 0.5)), [0.0] * VOTERS, {}, 0.0)
    model = fit_label_model(patterns)
    chosen = stored(sample(docs.where(learn_from), lexicon, model, patterns), "toxic-chosen")
    return Model(lexicon, model, *fit_classifier(chosen))


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """The rows with the classifier's probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(x) for x in batch], dtype="float64")

    held = free_name(docs, "_score")
    found = small_batches(docs).withColumn(held, judged(F.col(f"`{text}`").cast("binary")))
    return found.select(
        *(F.col(f"`{name}`") for name in without(docs.columns, score)), F.col(f"`{held}`").alias(score)
    )


def classify(
    docs: DataFrame, labels: DataFrame, learn_from: Column, id_column: str = "doc_id",
    text: str = "text", label: str = "toxic", score: str = "score",
) -> DataFrame:
    """The rows with ``score``. ``learn_from`` is a condition on the id, under the name ``k``."""
    model = train(
        docs.select(F.col(f"`{id_column}`").alias("k"), F.col(f"`{text}`").alias("text")),
        labels.select(F.col(f"`{id_column}`").alias("k"), F.col(f"`{label}`").alias("toxic")),
        learn_from,
    )
    return scored(docs, model, text, score)
