"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; unlabelled text stands for the
whole mixture. A few linear numpy classifiers are trained, each in its own task
on a bounded sample, with the risk estimator that corrects for the share of
positives in the mixture (Kiryo, Niu, du Plessis and Sugiyama, 2017):

    prior * loss(+, positives) + max(0, loss(-, unlabelled) - prior * loss(-, positives))

Their mean then scores every document in one pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import as_bytes, map_batches
from statewise.llm.decontaminate import normal_words
from statewise.workspace import settle

POSITIVES = 4_000  # documents sampled as confirmed toxic, at about most
UNLABELLED = 6_000  # unlabelled documents for each classifier, at about most
CLASSIFIERS = 3
FEATURES = 512  # per classifier
PREFIXES = (4, 5, 6)  # bytes of a word's beginning
FOLDS = 5  # rows of fold 0 are held out
STEPS = 400
RATE = 0.05
DECAY = 3e-4
LEAST_STRENGTH = 2.5  # deviations by which a feature must be more frequent
CACHE = 400_000  # words whose features a task remembers

_RANGE = 2**32


def fold_of(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def word_features(word: bytes) -> list[int]:
    """Numbers of a word and of its beginnings."""
    found = [zlib.crc32(b"=" + word)]
    found += [zlib.crc32(b"%d" % n + word[:n]) for n in PREFIXES if len(word) >= n]
    return found


def text_features(text: bytes) -> list[int]:
    words = set(normal_words(text))
    return sorted({number for word in words for number in word_features(word)})


def choose_features(positives: list, unlabelled: list, most: int = FEATURES) -> list[int]:
    """Features more frequent among the positives, by the size of the excess."""
    counts = []
    for rows in (positives, unlabelled):
        flat = np.concatenate([np.asarray(row, dtype=np.int64) for row in rows] or [np.empty(0, np.int64)])
        counts.append(dict(zip(*(x.tolist() for x in np.unique(flat, return_counts=True)))))
    in_p, in_u = counts
    n_p, n_u = max(1, len(positives)), max(1, len(unlabelled))
    strength = {}
    for number, count in in_p.items():
        share, mixed = count / n_p, in_u.get(number, 0) / n_u
        if count >= 3 and share > 2 * mixed:
            spread = (share + mixed + 1 / n_u) * (1 / n_p + 1 / n_u)
            strength[number] = (share - mixed) / np.sqrt(spread)
    strength = {number: value for number, value in strength.items() if value >= LEAST_STRENGTH}
    return sorted(strength, key=lambda number: (-strength[number], number))[:most]


def design(rows: list, features: list[int]) -> np.ndarray:
    """Presence of each feature in each row, and a constant."""
    place = {number: at for at, number in enumerate(features)}
    matrix = np.zeros((len(rows), len(features) + 1), dtype=np.float32)
    matrix[:, -1] = 1
    for at, row in enumerate(rows):
        matrix[at, [place[number] for number in row if number in place]] = 1
    return matrix


def train(positives: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights minimising the non-negative risk under the logistic loss, by Adam."""

    def negative_share(scores):  # derivative of the loss of calling a row negative
        return 1 / (1 + np.exp(-scores))

    weights = np.zeros(positives.shape[1])
    weights[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    penalty = np.full_like(weights, DECAY)
    penalty[-1] = 0
    for step in range(1, STEPS + 1):
        of_p, of_u = positives @ weights, unlabelled @ weights
        negative = np.logaddexp(0, of_u).mean() - prior * np.logaddexp(0, of_p).mean()
        slope = (
            unlabelled.T @ negative_share(of_u) / len(of_u)
            - prior * (positives.T @ negative_share(of_p)) / len(of_p)
        )
        if negative < 0:
            gradient = -slope  # the estimate is below any true risk: step back
        else:
            gradient = slope - prior * (positives.T @ negative_share(-of_p)) / len(of_p)
        gradient = gradient + penalty * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(training rows: ``member``, ``positive``, ``features``; class prior).

    The prior is the share of toxic rows among the labelled ones. Only counts
    reach the driver; ids of the sampled positives, bounded, are broadcast.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold_of() != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n_known, n_toxic = known.agg(
        F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))
    ).first()
    prior = n_toxic / n_known if n_known else 0.0
    n_docs = docs.count()

    def below(column, share):
        return column < F.lit(int(min(1.0, share) * _RANGE))

    draw = F.pmod(F.xxhash64("doc_id"), F.lit(_RANGE))
    picked = known.where((F.col("toxic") == 1) & below(draw, POSITIVES / max(1, n_toxic)))
    picked = picked.select("doc_id", F.lit(True).alias("positive"))
    turn = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(_RANGE))
    rows = (
        docs.where(fold_of() != 0)
        .select("doc_id", as_bytes().alias("text"))
        .join(F.broadcast(picked), "doc_id", "left")
        .withColumn("taken", below(turn, CLASSIFIERS * UNLABELLED / max(1, n_docs)))
        .where(F.col("positive").isNotNull() | F.col("taken"))
        .select(
            F.coalesce("positive", F.lit(False)).alias("positive"),
            "taken",
            F.pmod(F.xxhash64("doc_id", F.lit("member")), F.lit(CLASSIFIERS)).alias("member"),
            "text",
        )
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(text.as_py()) for text in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))],
                names=["positive", "taken", "member", "features"],
            )

    schema = "positive boolean, taken boolean, member long, features array<long>"
    found = settle(map_batches(rows, features, schema), "toxic")
    every = F.sequence(F.lit(0).cast("long"), F.lit(CLASSIFIERS - 1).cast("long"))
    positives = found.where("positive").withColumn("member", F.explode(every))
    unlabelled = found.where("taken").withColumn("positive", F.lit(False))
    columns = ["member", "positive", "features"]
    return positives.select(*columns).unionByName(unlabelled.select(*columns)), prior


def fit(docs: DataFrame, labels: DataFrame) -> tuple[list[dict[int, float]], float]:
    """(weights by feature of each classifier, class prior).

    A classifier's constant has the number -1. Without confirmed toxic rows, or
    without any others, there is no classifier.
    """
    sample, prior = _sample(docs, labels)
    if not 0 < prior < 1:
        return [], prior

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        is_positive = rows["positive"].to_numpy(dtype=bool)
        positives = list(rows["features"][is_positive])
        unlabelled = list(rows["features"][~is_positive])
        if not positives or not unlabelled:
            return pd.DataFrame({"member": [], "feature": [], "weight": []})
        chosen = choose_features(positives, unlabelled)
        weights = train(design(positives, chosen), design(unlabelled, chosen), prior)
        return pd.DataFrame(
            {"member": rows["member"].iloc[0], "feature": [*chosen, -1], "weight": weights}
        )

    learned = sample.groupBy("member").applyInPandas(learn, "member long, feature long, weight double")
    models: dict[int, dict[int, float]] = {}
    for row in learned.collect():  # at most CLASSIFIERS * (FEATURES + 1) rows
        models.setdefault(row["member"], {})[row["feature"]] = row["weight"]
    return [models[member] for member in sorted(models)], prior


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row ``doc_id, held_out, score, predicted``.

    ``score`` is the mean classifiers' probability; NULL and empty texts get
    that of a text without features. Labels are read only for rows outside fold
    0 of crc32 of the id; of several labels of one id the largest counts, NULL
    ones do not. Without usable labels every score is the share of toxic
    labels. Repeated rows are scored each; only the text enters a score.
    """
    models, prior = fit(docs.select("doc_id", "text"), labels)
    mean: dict[int, float] = {}
    for model in models:
        for number, weight in model.items():
            mean[number] = mean.get(number, 0.0) + weight / len(models)
    constant = mean.pop(-1, None)
    shared = docs.sparkSession.sparkContext.broadcast(mean)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known = shared.value, {}
        for batch in batches:
            scores = []
            for text in batch.column(2):
                if constant is None:
                    scores.append(prior)
                    continue
                present: set[int] = set()
                for word in set(normal_words(text.as_py())):
                    numbers = known.get(word)
                    if numbers is None:
                        if len(known) >= CACHE:
                            known.clear()
                        numbers = tuple(n for n in word_features(word) if n in weights)
                        known[word] = numbers
                    if numbers:
                        present.update(numbers)
                total = constant + sum(weights[number] for number in sorted(present))
                scores.append(1 / (1 + np.exp(-np.clip(total, -500, 500))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(value >= 0.5) for value in scores], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (fold_of() == 0).alias("held_out"), as_bytes().alias("text")
    )
    return map_batches(rows, score, "doc_id long, held_out boolean, score double, predicted int")
