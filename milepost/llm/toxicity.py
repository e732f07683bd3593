"""Toxicity from two class-conditional Kneser-Ney models.

A text is scored by how much better the model of toxic texts explains its words than that
of ordinary ones. Both models estimate a word by its continuation count, the number of
different words that it follows in texts of the class, less an absolute discount; the
discounted mass goes to continuation counts shared by both classes. So a rare expression,
met ``DISCOUNT`` times or less, is smoothed entirely by the shared counts and says nothing.
The log-likelihoods are compared per word; what a word tells below ``NOISE`` nats is chance
of the sample and left out, and ``PAD`` silent words steady the mean of short texts. A
logistic curve, fitted to labelled texts that the models have not seen, turns the difference
into a probability.

The models are fitted to a bounded sample: at most ``PER_CLASS`` labelled texts of the
ordinary and the toxic class, the first by a hash of their id; a quarter of them is left to
the curve. Words are runs of letters, digits and apostrophes in lower case, hashed to
``WORDS`` buckets. Counts are Spark aggregations; tables of at most that many entries come
to the driver.

Defined results: texts that are null, empty or without a word have difference 0 and get the
score of that. Rows with null or other labels than 0 and 1 teach nothing; of repeated labels
the greatest counts. Without labels of both classes every score is the share of toxic labels
(0 if there are none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.llm.arrays import U64, text_runs, word_hashes, words
from milepost.operators.windows import write_once

PER_CLASS = (16_000, 4_000)
WORDS = 1 << 20
DISCOUNT = 3.0
NOISE, PAD = 1.2, 50


def _letters() -> np.ndarray:
    kinds = np.zeros(256, bool)
    kinds[[*b"abcdefghijklmnopqrstuvwxyz0123456789'"]] = True
    kinds[0x80:] = True
    return kinds


LETTERS = _letters()


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word (never 0), and the first word of each text."""
    starts, ends, bounds = words(data, offsets, LETTERS)
    return (word_hashes(data, starts, ends) % U64(WORDS - 1) + U64(1)).astype(np.int64), bounds


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (label, word before, word); 0 stands before the first word of a text."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for first, last, data, offsets in text_runs(batch.column("text")):
            word, bounds = _buckets(data, offsets)
            before = np.concatenate(([0], word[:-1]))[: len(word)]
            before[bounds[:-1][bounds[:-1] < len(word)]] = 0
            label = np.repeat(toxic[first:last], np.diff(bounds))
            code = np.unique((label * WORDS + before) * WORDS + word)
            yield pa.RecordBatch.from_arrays([pa.array(code // WORDS**2), pa.array(code // WORDS % WORDS), pa.array(code % WORDS)], names=["toxic", "before", "word"])


class ToxicityModel:
    """What each word tells, in nats for toxic, and the curve from a text's mean to its score."""

    def __init__(self, base: float):
        self.evidence = np.zeros(WORDS, np.float32)
        self.curve = (float(np.log(max(base, 1e-9) / max(1 - base, 1e-9))), 0.0)


def _evidence(pairs: DataFrame) -> np.ndarray:
    """Log ratio of the two models for each word, less what chance explains."""
    counts = np.zeros((3, WORDS))
    by_class = pairs.groupBy("toxic", "word").count()
    shared = pairs.select("before", "word").distinct().groupBy("word").count().select(F.lit(2).cast("long").alias("toxic"), "word", "count")
    table = by_class.unionByName(shared).toArrow()
    counts[table.column("toxic").to_numpy(), table.column("word").to_numpy()] = table.column("count").to_numpy()
    p_shared = (counts[2] + 0.5) / (counts[2] + 0.5).sum()
    logs = []
    for kinds in counts[:2]:
        spared = np.minimum(kinds, DISCOUNT).sum()
        logs.append(np.log((np.maximum(kinds - DISCOUNT, 0) + spared * p_shared) / kinds.sum()))
    ratio = logs[1] - logs[0]
    return (np.sign(ratio) * np.maximum(np.abs(ratio) - NOISE, 0)).astype(np.float32)


def differences(evidence: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Difference of the log-likelihoods per word of each text."""
    word, bounds = _buckets(data, offsets)
    sums = np.concatenate(([0.0], np.cumsum(evidence[word], dtype=np.float64)))
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / (np.diff(bounds) + PAD)


def _score(docs: DataFrame, model: ToxicityModel, output: str) -> DataFrame:
    keep = [c for c in docs.columns if c != output]
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(output, T.DoubleType())])
    evidence_of = docs.sparkSession.sparkContext.broadcast(model.evidence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [differences(evidence_of.value, data, offsets) for _, _, data, offsets in text_runs(batch.column(len(keep)))]
            values = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=[*keep, output])

    return docs.select(*keep, F.lower("text").alias("_lower")).mapInArrow(run, schema)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a slight pull to 0."""
    scale = float(x.std()) or 1.0
    design, beta = np.stack((np.ones_like(x), x / scale), axis=1), np.zeros(2)
    pull = np.diag([1e-6, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - pull @ beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + pull, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]) / scale


def learn_toxicity(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS) -> ToxicityModel:
    """Model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    known = write_once(known, "toxicity-labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    model = ToxicityModel(sizes.get(1, 0) / max(sum(sizes.values()), 1))
    place = F.xxhash64("doc_id", F.lit(8))
    firsts = [known.where(F.col("toxic") == c).orderBy(place, "doc_id").limit(per_class[c]) for c in (0, 1)]
    # at most sum(per_class) rows of two numbers: small enough to send everywhere
    sample = write_once(
        docs.select("doc_id", "text").join(F.broadcast(firsts[0].union(firsts[1])), "doc_id").select("toxic", "text", (F.pmod(place, F.lit(4)) == 0).alias("held")),
        "toxicity-sample",
    )
    fit = sample.where(~F.col("held")).select("toxic", F.lower("text").alias("text"))
    pairs = write_once(fit.mapInArrow(_pairs, "toxic long, before long, word long").distinct(), "toxicity-pairs")
    if pairs.select("toxic").distinct().count() < 2:
        return model
    model.evidence = _evidence(pairs)
    held = _score(sample.where("held").select("toxic", "text"), model, "difference").select("toxic", "difference").toArrow()
    y, x = held.column("toxic").to_numpy().astype(float), held.column("difference").to_numpy()
    if len(set(y)) == 2:
        # the sample has other shares of the classes than the labels
        weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum()) * len(y) / sum(sizes.values())
        model.curve = _logistic(x, y, weight)
    else:
        model.curve = (model.curve[0], 1.0)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``difference`` (log-likelihoods per word) and ``score`` (0 to 1)."""
    intercept, slope = model.curve
    logit = F.lit(intercept) + F.lit(slope) * F.col("difference")
    return _score(docs, model, "difference").withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(500.0)), F.lit(-500.0)))))

