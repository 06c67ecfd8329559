"""Quality by weak labels: overlapping heuristics, their accuracies by expectation-maximisation,
and a hashed linear scorer trained on the posteriors.

Each labeller looks at one statistic of a text and votes bad, good or nothing. All documents are
counted by their pattern of votes (3 ** labellers patterns at most), and on this histogram EM
estimates how often each labeller votes so on good and on bad texts, and how many are good. The
posterior of a document's pattern is its soft label. A logistic scorer over hashed features (byte
trigrams by frequency, and the statistics in steps) learns these on the driver, from a sample
bounded by ``SAMPLE`` rows on either side of 1/2, and scores every whole text.

A null or empty text gets no votes; it is scored by its statistics, all 0. Repeated rows are scored
alike, row by row. An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import RowNumbers, kept, lists, pieces
from .words import U, mix, span_hashes, split_words

#: (statistic, bad from or up to, good up to or from): thresholds of the labellers.
LABELLERS = (
    ("repeated_neighbours", 0.20, 0.05),
    ("common_word", 0.30, 0.15),
    ("distinct_words", 0.30, 0.50),
    ("symbols", 0.04, 0.02),
    ("symbol_runs", 0.20, 0.03),
    ("lone_symbols", 0.20, 0.03),
    ("capitals", 0.40, 0.12),
    ("repeated_lines", 0.50, 0.05),
)
#: Texts of fewer words say nothing about repetition.
FEW_WORDS = 20
ROUNDS = 200
SLOTS, STEPS, SAMPLE = 1 << 16, 10, 4000
EPOCHS, BATCH, RATE, PENALTY = 12, 64, 0.2, 1e-3

_SYMBOL = np.zeros(256, bool)
for _low, _high in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _SYMBOL[_low:_high] = True
#: Marks of ordinary sentences are no symbols where they stand alone.
_MARK = _SYMBOL.copy()
_MARK[[ord(c) for c in ".,;:?!'\"()-"]] = False
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _runs_of(mask: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the runs of true bytes, cut at the borders of texts."""
    new = np.diff(mask.astype(np.int8), prepend=0) == 1
    border = ends[:-1][ends[:-1] < len(mask)]
    new[border] |= mask[border]
    start = np.flatnonzero(new)
    stops = np.flatnonzero(np.diff(mask.astype(np.int8), append=0) == -1) + 1
    end = np.minimum(stops[np.searchsorted(stops, start, "right")] if len(start) else start,
                     ends[np.searchsorted(ends, start, "right")] if len(start) else start)
    return np.searchsorted(ends, start, "right") - 1, start, end


def statistics(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labellers' statistics of every text, and its number of words."""
    n = len(ends) - 1
    count = lambda rows: np.bincount(rows, minlength=n)
    words = split_words(data, ends)
    many = np.diff(words.first)
    twin = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    order = np.lexsort((words.hash, words.row))
    row, value = words.row[order], words.hash[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, row[at], np.diff(np.append(at, len(row))))
    owner = np.repeat(np.arange(n), np.diff(ends))
    symbol = _SYMBOL[data]
    mark_row, mark_start, mark_end = _runs_of(symbol, ends)
    token_row, token_start, token_end = _runs_of(~_SPACE[data], ends)
    sums = np.concatenate([[0], np.cumsum(symbol)])
    lone = sums[token_end] - sums[token_start] == token_end - token_start
    capital = (data >= 65) & (data <= 90)
    capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    letter[1:] |= data[:-1] == 0xC3
    line_row, line_start, line_end = _runs_of(data != 10, ends)
    line = span_hashes(data, line_start, line_end) if len(line_start) else np.zeros(0, U)
    lines = np.unique(np.stack([line_row.astype(U), line], 1), axis=0) if len(line) else np.zeros((0, 2), U)
    stats = [
        _share(count(words.row[1:][twin]), many),
        _share(most, many),
        _share(count(row[at]), many),
        _share(count(owner[_MARK[data]]), np.diff(ends)),
        _share(count(mark_row[mark_end - mark_start > 1]), many),
        _share(count(token_row[lone]), many),
        _share(count(owner[capital]), count(owner[letter])),
        1 - _share(count(lines[:, 0].astype(np.int64)), count(line_row)) if n else np.zeros(0),
    ]
    return np.stack(stats, 1), many


def votes(stats: np.ndarray, many: np.ndarray) -> np.ndarray:
    """0 for no vote, 1 for bad, 2 for good; a column per labeller."""
    out = np.zeros(stats.shape, np.int64)
    for k, (name, bad, good) in enumerate(LABELLERS):
        up = 1 if bad > good else -1
        out[:, k] = np.where(up * stats[:, k] >= up * bad, 1, np.where(up * stats[:, k] <= up * good, 2, 0))
        if name in ("repeated_neighbours", "common_word", "distinct_words"):
            out[many < FEW_WORDS, k] = 0
    out[many == 0] = 0
    return out


def _pattern_rows(batches):
    number = RowNumbers()
    base = 3 ** np.arange(len(LABELLERS))
    for batch, data, ends in pieces(batches, "text", 1 << 18):
        yield pa.RecordBatch.from_arrays(
            [pa.array(number.take(batch.num_rows)), batch.column("doc_id"), batch.column("text"),
             pa.array(votes(*statistics(data, ends)) @ base)],
            names=["row", "doc_id", "text", "pattern"],
        )


class Accuracies(NamedTuple):
    #: Share of good texts, and P(vote | bad), P(vote | good) by labeller and vote.
    good: float
    chances: np.ndarray


def estimate(patterns: dict[int, int]) -> tuple[Accuracies, dict[int, float]]:
    """EM on the histogram of vote patterns, from majority votes; the posterior of good by pattern."""
    keys = np.array(sorted(patterns))
    weight = np.array([patterns[k] for k in keys.tolist()], float)
    vote = keys[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    n_bad, n_good = (vote == 1).sum(1), (vote == 2).sum(1)
    # One bad sign weighs more than one good: most labellers do not see a text's fault.
    good = np.where(n_bad > 0, 0.2 / n_bad.clip(1), np.where(n_good > 0, 0.9, 0.5))
    for _ in range(ROUNDS):
        chances = np.empty((2, len(LABELLERS), 3))
        for c, part in enumerate((weight * (1 - good), weight * good)):
            for v in range(3):
                chances[c, :, v] = ((vote == v) * part[:, None]).sum(0) + 0.5
        chances /= chances.sum(axis=2, keepdims=True)
        share = np.clip((weight * good).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        log = np.log(chances[:, np.arange(len(LABELLERS)), vote]).sum(axis=2)
        odds = np.log(share / (1 - share)) + log[1] - log[0]
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
        if np.abs(good - before).max() < 1e-9:
            break
    return Accuracies(float(share), chances), dict(zip(keys.tolist(), good.tolist()))


# --- hashed linear scorer ------------------------------------------------------------------------

def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of the hashed features; a text's trigrams have length 1."""
    n = len(ends) - 1
    stats, _ = statistics(data, ends)
    step = np.minimum((stats * STEPS * 2).astype(np.int64), STEPS)
    names = np.arange(stats.shape[1]) * (STEPS + 1) + step
    rows = [np.repeat(np.arange(n), stats.shape[1])]
    slots = [(mix(names.reshape(-1).astype(U) + U(1 << 40)) & U(SLOTS - 1)).astype(np.int64)]
    values = [np.ones(names.size)]
    if len(data) > 2:
        wide = data.astype(U)
        owner = np.repeat(np.arange(n), np.diff(ends))
        inside = owner[2:] == owner[:-2]
        slot = (mix(wide[:-2] | wide[1:-1] << U(8) | wide[2:] << U(16)) & U(SLOTS - 1)).astype(np.int64)[inside]
        key, times = np.unique(owner[:-2][inside] * SLOTS + slot, return_counts=True)
        rows.append(key // SLOTS)
        slots.append(key % SLOTS)
        length = np.sqrt(np.bincount(key // SLOTS, times.astype(float) ** 2, n))
        values.append(times / length[key // SLOTS])
    return np.concatenate(rows), np.concatenate(slots), np.concatenate(values)


def _feature_rows(batches):
    for batch, data, ends in pieces(batches, "text", 1 << 18):
        row, slot, value = features(data, ends)
        order = np.argsort(row, kind="stable")
        counts = np.bincount(row, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("good"), lists(slot[order].astype(np.int32), counts, pa.int32()),
             lists(value[order].astype(np.float32), counts, pa.float32())],
            names=["good", "slots", "values"],
        )


def _train(first: np.ndarray, slots: np.ndarray, values: np.ndarray, good: np.ndarray, weight: np.ndarray):
    """Logistic regression by AdaGrad on soft labels; the last weight is the intercept."""
    random = np.random.default_rng(3)
    w, past = np.zeros(SLOTS + 1), np.full(SLOTS + 1, 1e-6)
    for _ in range(EPOCHS):
        order = random.permutation(len(good))
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            many = first[rows + 1] - first[rows]
            begin = np.concatenate([[0], np.cumsum(many)])
            at = np.repeat(first[rows] - begin[:-1], many) + np.arange(begin[-1])
            of = np.repeat(np.arange(len(rows)), many)
            margin = np.bincount(of, w[slots[at]] * values[at], len(rows)) + w[-1]
            error = (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - good[rows]) * weight[rows] / len(rows)
            used, where = np.unique(slots[at], return_inverse=True)
            g = np.bincount(where, error[of] * values[at], len(used)) + PENALTY * w[used]
            past[used] += g * g
            w[used] -= RATE * g / np.sqrt(past[used])
            past[-1] += error.sum() ** 2
            w[-1] -= RATE * error.sum() / np.sqrt(past[-1])
    return w


def score(documents: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, Accuracies | None]:
    """row, doc_id, label (posterior of good by votes) and score (of the linear scorer), and the
    estimated accuracies."""
    told = kept(
        documents.select("doc_id", "text").mapInArrow(
            _pattern_rows, "row bigint, doc_id bigint, text string, pattern bigint"
        ),
        "quality-votes",
    )
    # A row per pattern: 3 ** labellers at most.
    patterns = {r["pattern"]: r["count"] for r in told.groupBy("pattern").count().collect()}
    if not patterns:
        return told.select("row", "doc_id", F.lit(0.0).alias("label"), F.lit(0.0).alias("score")), None
    accuracies, posterior = estimate(patterns)
    spark = documents.sparkSession
    by_pattern = spark.createDataFrame(list(posterior.items()), "pattern bigint, good double")
    labelled = told.join(F.broadcast(by_pattern), "pattern")
    sides = [sum(patterns[k] for k, p in posterior.items() if (p >= 0.5) == side) for side in (False, True)]
    order = F.xxhash64("row", F.lit(7))
    cut = [min(1.0, sample / max(1, n)) * (1 << 20) for n in sides]
    drawn = (
        labelled.filter(F.pmod(order, F.lit(1 << 20)) < F.when(F.col("good") >= 0.5, cut[1]).otherwise(cut[0]))
        .orderBy(order, "row").limit(3 * sample).select("good", "text")
        .mapInArrow(_feature_rows, "good double, slots array<int>, values array<float>").toArrow()
    )
    slots = drawn.column("slots").combine_chunks()
    first = slots.offsets.to_numpy().astype(np.int64)
    good = drawn.column("good").to_numpy()
    # Either side of the sample weighs half.
    high = good >= 0.5
    weight = np.where(high, 0.5 / max(high.mean(), 1e-9), 0.5 / max(1 - high.mean(), 1e-9))
    weights = _train(
        first - first[0], slots.flatten().to_numpy(), drawn.column("values").combine_chunks().flatten().to_numpy(),
        good, weight,
    )
    shared = spark.sparkContext.broadcast(weights)  # SLOTS + 1 numbers

    def run(batches):
        w = shared.value
        for batch, data, ends in pieces(batches, "text", 1 << 18):
            row, slot, value = features(data, ends)
            margin = np.bincount(row, w[slot] * value, batch.num_rows) + w[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("good"),
                 pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))],
                names=["row", "doc_id", "label", "score"],
            )

    return labelled.select("row", "doc_id", "text", "good").mapInArrow(
        run, "row bigint, doc_id bigint, label double, score double"
    ), accuracies
