"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its distinct words and the words' stems (first bytes), hashed into ``SLOTS``
places. Each has a weight, and ``FACTORS`` numbers whose products are the weights of pairs, so that
two terms can mean together what neither means alone. Weights are learned by FTRL with an L1
penalty, which leaves most of them 0. A term has factors if it is common, since a pair may tell
what neither of its words does, or while it has a weight.

The model is fitted on the driver, on a sample bounded by ``SAMPLE`` rows a class; the intercept
then makes up for the classes' shares in the sample. Every word of every text counts in a score.

A null or empty text has the score of no terms. Without labels of both classes the score is
the share of toxic labels, 0 without any. Of several texts of one key one is learned,
that of the least digest. Repeated rows are scored alike, row by row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lists, pieces
from .words import U, lowered, mix, span_hashes, split_words

SLOTS, STEMS = 1 << 20, (4, 5, 6)
#: A term of the model is in so many rows of the sample at least; a frequent one is left to the penalty.
LEAST_ROWS = 3
FACTORS, SAMPLE = 6, 2500
#: Terms in this share of the sample's rows have factors whatever their weight; others once they have a weight.
COMMON = 0.05
#: The L1 penalty is for each square root of the sample's rows, as chance gradients grow.
EPOCHS, BATCH, RATE, L1, L2, FACTOR_RATE, FACTOR_PENALTY, START = 10, 64, 0.5, 0.2, 0.0, 0.05, 0.02, 0.05


class Model(NamedTuple):
    intercept: float
    #: Known slots in ascending order, their weights and factors.
    slots: np.ndarray
    weights: np.ndarray
    factors: np.ndarray


def terms(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and slot of the words and stems of all texts, with repetitions."""
    words = split_words(data, ends)
    low = lowered(data)
    rows, slots = [words.row], [words.hash]
    for n in STEMS:
        long = np.flatnonzero(words.end - words.start > n)
        rows.append(words.row[long])
        slots.append(mix(span_hashes(low, words.start[long], words.start[long] + n) + U(n)))
    return np.concatenate(rows), (np.concatenate(slots) & U(SLOTS - 1)).astype(np.int64)


def _distinct(rows: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(rows * SLOTS + slots)
    return key // SLOTS, key % SLOTS


def _sample_rows(batches):
    for batch, data, ends in pieces(batches, "text"):
        rows, slots = _distinct(*terms(data, ends))
        counts = np.bincount(rows, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), lists(slots.astype(np.int32), counts, pa.int32())], names=["label", "slots"]
        )


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def margins(model: Model, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log odds of rows; ``at`` are places of their terms among the model's slots."""
    factors = model.factors[at]
    pairs = (_sums(factors, first) ** 2 - _sums(factors**2, first)).sum(axis=1) / 2
    return model.intercept + _sums(model.weights[at], first) + pairs


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model learned from documents (key, text) and labels (key, label 0 or 1).

    The key chooses the sample, so that only sampled texts meet their labels.
    """
    labels = labels.filter("label is not null and key is not null")
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    empty = np.zeros(0)
    if not counts.get(0) or not counts.get(1):
        share = 1.0 if counts.get(1) else 0.0
        return Model(35 * (2 * share - 1), empty.astype(np.int64), empty, np.zeros((0, FACTORS)))
    order = F.xxhash64("key")
    cut = F.when(F.col("label") == 1, sample / counts[1]).otherwise(sample / counts[0]) * (1 << 20)
    drawn = labels.filter(F.pmod(order, F.lit(1 << 20)) < cut).orderBy(order, "key").limit(3 * sample)
    # 3 * sample rows at most; of several texts of one key the one whose digest comes first.
    matching = documents.join(F.broadcast(drawn), "key").select("key", "label", F.coalesce("text", F.lit("")).alias("text"))
    told = (
        matching.groupBy("key").agg(F.min_by(F.struct("label", "text"), F.sha2("text", 256)).alias("row"))
        .select("row.label", "row.text")
        .mapInArrow(_sample_rows, "label int, slots array<int>").toArrow()
    )
    lists_ = told.column("slots").combine_chunks()
    first = lists_.offsets.to_numpy().astype(np.int64)
    label = told.column("label").to_numpy().astype(np.float64)
    if not len(label):
        return Model(float(np.log(counts[1] / counts[0])), empty.astype(np.int64), empty, np.zeros((0, FACTORS)))
    model = _train(lists_.flatten().to_numpy().astype(np.int64), first - first[0], label)
    drawn = np.log(max(label.sum(), 1) / max((1 - label).sum(), 1))
    return model._replace(intercept=model.intercept + float(np.log(counts[1] / counts[0]) - drawn))


def _train(slots: np.ndarray, first: np.ndarray, label: np.ndarray) -> Model:
    random = np.random.default_rng(5)
    known, at, rows = np.unique(slots, return_inverse=True, return_counts=True)
    often = rows >= LEAST_ROWS
    penalty = L1 * np.sqrt(len(label))
    place = np.cumsum(often) - 1
    keep = often[at]
    first = np.concatenate([[0], np.cumsum(keep)])[first]
    at, known = place[at[keep]], known[often]
    # A pair can tell what neither of its words does, if both are common enough for their pair to be met often.
    common = rows[often] >= COMMON * len(label)
    n = len(known)
    z, square, weights = np.zeros(n), np.zeros(n), np.zeros(n)
    factors, factor_square = random.normal(0, START, (n, FACTORS)), np.ones((n, FACTORS))
    bias, bias_square = 0.0, 1.0
    for _ in range(EPOCHS):
        order = random.permutation(len(label))
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            many = first[rows + 1] - first[rows]
            begin = np.concatenate([[0], np.cumsum(many)])
            spot = at[np.repeat(first[rows] - begin[:-1], many) + np.arange(begin[-1])]
            active = common[spot] | (weights[spot] != 0)
            own = factors[spot] * active[:, None]
            total = _sums(own, begin)
            margin = bias + _sums(weights[spot], begin) + (total**2 - _sums(own**2, begin)).sum(axis=1) / 2
            error = _logistic(margin) - label[rows]
            each = np.repeat(error, many)
            # FTRL-proximal for weights: no step before the gradients outgrow the penalty.
            used, where = np.unique(spot, return_inverse=True)
            g = np.bincount(where, each, len(used))
            new = square[used] + g * g
            z[used] += g - (np.sqrt(new) - np.sqrt(square[used])) / RATE * weights[used]
            square[used] = new
            weights[used] = np.where(
                np.abs(z[used]) <= penalty, 0,
                -(z[used] - np.sign(z[used]) * penalty) / ((1 + np.sqrt(new)) / RATE + L2),
            )
            live = np.flatnonzero(active)
            if len(live):
                used, where = np.unique(spot[live], return_inverse=True)
                slope = each[live, None] * (np.repeat(total, many, axis=0)[live] - own[live])
                for f in range(FACTORS):
                    g = np.bincount(where, slope[:, f], len(used)) + FACTOR_PENALTY * factors[used, f]
                    factor_square[used, f] += g * g
                    factors[used, f] -= FACTOR_RATE * g / np.sqrt(factor_square[used, f])
            bias_square += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(bias_square)
    live = common | (weights != 0)
    return Model(float(bias), known[live], weights[live], factors[live])


def score(documents: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``carry`` columns with the score of each row's text, 0 to 1."""
    rows = documents.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # SLOTS terms at most

    def run(batches):
        fitted = shared.value
        place = np.full(SLOTS, -1, np.int32)
        place[fitted.slots] = np.arange(len(fitted.slots))
        for batch, data, ends in pieces(batches, "_text", 1 << 18):
            row, slot = terms(data, ends)
            known = place[slot] >= 0
            row, slot = _distinct(row[known], slot[known])
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], pa.array(_logistic(margins(fitted, place[slot], first)))],
                names=[*carry, "score"],
            )

    return rows.mapInArrow(run, rows.drop("_text").withColumn("score", F.lit(0.0)).schema)
