"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.llm.common import bounded_batches, crc_of_id, plain_words

FOLDS = 5
POSITIVES = 6_000  # documents: the bound of the sample that is fitted
UNLABELLED = 14_000
FEATURES = 200
STEMS = (4, 5, 6)  # bytes of a word's beginning that count as a feature too
DEVIATIONS = 6  # by which a feature must be more frequent among the positives
SEED = 17


def word_counts(text: str | None) -> Counter[bytes]:
    """How often each word occurs, and each beginning of longer words, marked by a star."""
    words = Counter(plain_words(text))
    stems: Counter[bytes] = Counter()
    for word, n in words.items():
        for k in STEMS:
            if len(word) > k:
                stems[word[:k] + b"*"] += n
    words.update(stems)
    return words


@dataclass(frozen=True)
class ToxicityModel:
    """``words`` with a weight each, for one plus the log of how often they occur."""

    words: dict[bytes, int]
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        known, stems = self.words, {k: {w[:-1] for w in self.words if len(w) == k + 1 and w[-1:] == b"*"} for k in STEMS}
        sums = np.full(len(texts), self.bias)
        for row, text in enumerate(texts):
            words = Counter(plain_words(text))
            found = Counter({w: words[w] for w in known.keys() & words.keys()})
            for k, some in stems.items():
                for word in words if some else ():
                    if word[:k] in some and len(word) > k:
                        found[word[:k] + b"*"] += words[word]
            for word, n in found.items():
                sums[row] += self.weights[known[word]] * (1 + np.log(n))
        return 1 / (1 + np.exp(-np.clip(sums, -40, 40)))


def non_negative_fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 1e-5
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier from positives and unlabelled rows.

    With class prior p the risk is p E+[l(+1)] + max(0, Eu[l(-1)] - p E+[l(-1)]):
    unlabelled rows count as negative, less the share of them that is positive.
    Where that difference, which no true risk can be, falls below zero, a step
    goes against it instead (so it can't be driven down by over-fitting).
    """
    size = positive.shape[1]
    w, b = np.zeros(size), np.log(prior / (1 - prior))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(positive @ w + b)))
        u = 1 / (1 + np.exp(-(unlabelled @ w + b)))
        negative_risk = -np.log1p(-u * (1 - 1e-12)).mean() + prior * np.log1p(-p * (1 - 1e-12)).mean()
        as_positive = prior * (p - 1) / len(p)
        as_negative = -prior * p / len(p)
        from_u = u / len(u)
        if negative_risk >= 0:
            gp, gu = as_positive + as_negative, from_u
        else:
            gp, gu = -as_negative, -from_u
        gradient = np.append(positive.T @ gp + unlabelled.T @ gu + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return w, float(b)


def _sampled(ids: DataFrame, rows: int) -> DataFrame:
    order = F.xxhash64("doc_id", F.lit(SEED))
    return ids.orderBy(order, "doc_id").limit(rows)


def fit_toxicity(documents: DataFrame, labels: DataFrame, prior: float | None = None) -> ToxicityModel:
    """Fit on documents outside fold 0 of the id's checksum.

    At most ``POSITIVES`` confirmed toxic documents and ``UNLABELLED`` others
    without regard to labels, those whose id hashes lowest; whole texts.
    ``prior`` is the share of toxic documents; by default that of the labels
    outside fold 0, over all of them. The words and beginnings of words that
    occur in clearly more of the positives than of the unlabelled are the features.

    Without positives or without documents, the model scores everything 0.
    Null ids and labels teach nothing; of repeated labels the largest counts.
    """
    bounded_batches(documents.sparkSession)
    taught = crc_of_id() % FOLDS != 0
    marked = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null").filter(taught)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = marked.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    ids = documents.select("doc_id").filter("doc_id is not null").filter(taught).distinct()
    positives = _sampled(ids.join(marked.filter("toxic = 1"), "doc_id", "left_semi"), POSITIVES)
    unlabelled = _sampled(ids, UNLABELLED)
    chosen = positives.withColumn("positive", F.lit(1)).unionByName(unlabelled.withColumn("positive", F.lit(0)))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counted = [word_counts(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "positive": batch["positive"],
                    "words": [[w.decode("latin-1") for w in c] for c in counted],
                    "counts": [list(c.values()) for c in counted],
                }
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    taken = (
        documents.select("doc_id", "text")
        .filter(taught)
        .join(F.broadcast(chosen), "doc_id")  # at most POSITIVES + UNLABELLED ids
        .mapInPandas(words, f"doc_id {kind}, positive int, words array<string>, counts array<int>")
    )
    sizes = taken.groupBy("positive").count().collect()
    rows_of = {r["positive"]: r["count"] for r in sizes}
    n_pos, n_unl = rows_of.get(1, 0), rows_of.get(0, 0)
    if not n_pos or not n_unl or not 0 < prior < 1:
        return ToxicityModel({}, np.zeros(0), -40.0)
    # How far a word's share among the positives exceeds its share among the others, in deviations.
    per_word = taken.select("positive", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("positive").alias("p"), F.count_if(F.col("positive") == 0).alias("u")
    )
    share, other = F.col("p") / n_pos, F.col("u") / n_unl
    pooled = (F.col("p") + F.col("u") + 1) / (n_pos + n_unl + 2)
    z = (share - other) / F.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_unl))
    best = per_word.filter("p >= 4").withColumn("z", z).filter(F.col("z") > DEVIATIONS).orderBy(F.desc("z"), "word").limit(FEATURES)
    features = {r["word"].encode("latin-1"): k for k, r in enumerate(best.collect())}
    if not features:
        return ToxicityModel({}, np.zeros(0), float(np.log(prior / (1 - prior))))
    names = F.array(*[F.lit(w.decode("latin-1")) for w in features])
    kept = taken.select(
        "doc_id",
        "positive",
        F.filter(F.arrays_zip("words", "counts"), lambda x: F.array_contains(names, x["words"])).alias("kept"),
    ).toPandas()
    kept = kept.sort_values(["positive", "doc_id"])
    matrix = np.zeros((len(kept), len(features)))
    for row, found in enumerate(kept["kept"]):
        for x in found:
            matrix[row, features[x["words"].encode("latin-1")]] = 1 + np.log(x["counts"])
    positive = kept["positive"].to_numpy() == 1
    weights, bias = non_negative_fit(matrix[positive], matrix[~positive], prior)
    return ToxicityModel(features, weights, bias)


def score_toxicity(documents: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """Add ``score`` and ``predicted`` to every row; only the whole text counts. Null counts as empty."""
    bounded_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # FEATURES words at most
    score = F.pandas_udf(lambda texts: pd.Series(shared.value.scores(texts.tolist())), "double")
    scored = documents.withColumn("score", score("text"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
