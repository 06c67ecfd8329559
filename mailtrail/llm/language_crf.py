"""Languages of the words of a text by a linear-chain conditional random field.

A word's features are itself (lexicon), its first and last bytes (affixes) and its byte
trigrams, hashed into one table of weights per language; transitions between the languages of
neighbouring words are learned too. Words are labelled in segments of ``SEGMENT`` words by
forward-backward, and a text's language is the one with the largest share of the posteriors.

The model is fitted on the driver, on a sample bounded by ``DOCUMENTS`` rows a language and
``CHUNKS`` runs of ``CHUNK`` words a row, spread over the row's whole text; segments of runs from
different texts teach it to switch. Every word of every text counts in a prediction.

A text without any letter (null, empty) is ``und`` with score 0, and so is every text if there is no
row to learn from. Repeated rows are predicted alike, row by row; equal shares: the first language
in alphabetical order.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import pieces, text_bytes
from .words import U, Words, lowered, mix, span_hashes, split_words

SLOTS = 1 << 18
SEGMENT, CHUNK, CHUNKS, DOCUMENTS = 64, 16, 24, 240
AFFIXES = (1, 2, 3)
EPOCHS, BATCH, RATE, PENALTY = 4, 512, 0.3, 1e-6
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray


# --- features --------------------------------------------------------------------------------

def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the Latin-1 capitals lowered."""
    low = lowered(data)
    capital = np.zeros(len(low), bool)
    capital[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
    return np.where(capital, low + np.uint8(32), low)


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + U(kind * 0x51ED27)) & U(SLOTS - 1)).astype(np.int32)


class Features(NamedTuple):
    #: Slots of a word's own features, one column each.
    words: np.ndarray
    #: Slots of all words' trigrams, and where each word's begin.
    trigrams: np.ndarray
    first: np.ndarray


def features(low: np.ndarray, words: Words) -> Features:
    start, end = words.start, words.end
    columns = [_slots(span_hashes(low, start, end), 1)]
    for n in AFFIXES:
        cut = np.minimum(start + n, end)
        columns.append(_slots(span_hashes(low, start, cut), 2 * n))
        columns.append(_slots(span_hashes(low, np.maximum(end - n, start), end), 2 * n + 1))
    many = np.maximum(end - start - 2, 0)
    first = np.concatenate([[0], np.cumsum(many)])
    at = np.repeat(start - first[:-1], many) + np.arange(first[-1])
    wide = low.astype(np.uint32)
    values = wide[at] | wide[at + 1] << np.uint32(8) | wide[at + 2] << np.uint32(16) if len(at) else wide[:0]
    return Features(np.stack(columns, 1), _slots(values.astype(U), 99), first)


def emissions(found: Features, weights: np.ndarray) -> np.ndarray:
    """Score of every word for every language."""
    scores = weights[found.words].sum(axis=1, dtype=np.float64)
    sums = np.zeros((len(found.trigrams) + 1, weights.shape[1]))
    np.cumsum(weights[found.trigrams], axis=0, out=sums[1:])
    return scores + sums[found.first[1:]] - sums[found.first[:-1]]


# --- forward-backward --------------------------------------------------------------------------

def posteriors(scores: np.ndarray, transitions: np.ndarray, inside: np.ndarray, pairs: bool = False):
    """Posterior of each label at each place, for segments x places x labels; ``inside`` marks the
    places in use, which come first. With ``pairs`` also the expected transitions."""
    n, length, labels = scores.shape
    likely = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(transitions)
    forward, backward = np.empty_like(likely), np.empty_like(likely)
    at = likely[:, 0] / likely[:, 0].sum(axis=1, keepdims=True)
    forward[:, 0] = at
    for t in range(1, length):
        at = np.where(inside[:, t, None], (at @ step) * likely[:, t], at)
        at /= at.sum(axis=1, keepdims=True)
        forward[:, t] = at
    back = np.full((n, labels), 1.0 / labels)
    backward[:, -1] = back
    for t in range(length - 2, -1, -1):
        back = np.where(inside[:, t + 1, None], (back * likely[:, t + 1]) @ step.T, back)
        back /= back.sum(axis=1, keepdims=True)
        backward[:, t] = back
    both = forward * backward
    both /= both.sum(axis=2, keepdims=True)
    both *= inside[..., None]
    if not pairs:
        return both
    joint = forward[:, :-1, :, None] * step * (likely[:, 1:] * backward[:, 1:])[:, :, None, :]
    joint /= joint.sum(axis=(2, 3), keepdims=True)
    return both, (joint * inside[:, 1:, None, None]).sum(axis=(0, 1))


def _segments(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of the segments of all texts."""
    counts = np.diff(words.first)
    parts = -(-counts // SEGMENT)
    first = np.repeat(words.first[:-1], parts)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = first + nth * SEGMENT
    return start, np.minimum(SEGMENT, np.repeat(words.first[1:], parts) - start)


def label_words(data: np.ndarray, ends: np.ndarray, model: Model) -> tuple[Words, np.ndarray]:
    """The words of all texts and the posterior of every language for each."""
    words = split_words(data, ends)
    out = np.zeros((len(words.start), len(model.languages)))
    if not len(out):
        return words, out
    scores = emissions(features(folded(data), words), model.weights)
    start, length = _segments(words)
    at = np.arange(SEGMENT)
    inside = at < length[:, None]
    place = np.minimum(start[:, None] + at, len(out) - 1)
    out[place[inside]] = posteriors(scores[place], model.transitions, inside)[inside]
    return words, out


# --- fitting -------------------------------------------------------------------------------------

def _chunk_rows(batches):
    """Up to CHUNKS runs of words, spread evenly over each text."""
    for batch, data, ends in pieces(batches, "text"):
        words = split_words(data, ends)
        rows, texts = [], []
        for row in range(batch.num_rows):
            first, last = words.first[row], words.first[row + 1]
            parts = -(-(last - first) // CHUNK)
            for part in np.unique(np.linspace(0, parts - 1, min(parts, CHUNKS)).astype(int)) if parts else []:
                a, b = first + part * CHUNK, min(first + (part + 1) * CHUNK, last)
                rows.append(row)
                texts.append(data[words.start[a] : words.end[b - 1]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").take(pa.array(rows, pa.int64())), pa.array(texts, pa.binary())],
            names=["lang", "text"],
        )


def fit(labelled: DataFrame, documents: int = DOCUMENTS) -> Model | None:
    """A model learned from rows with text, lang and a ``key`` that chooses the sample."""
    labelled = labelled.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(documents / counts[k]))])
    order = F.xxhash64("key")
    sample = (
        labelled.filter(F.pmod(order, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
        .orderBy(order, "key", "text").limit(2 * documents * len(languages))
        .select("lang", "text").mapInArrow(_chunk_rows, "lang string, text binary").toArrow()
    )
    data, ends = text_bytes(sample.column("text"))
    words = split_words(data, ends)
    found = features(folded(data), words)
    known = {k: n for n, k in enumerate(languages)}
    label = np.array([known[x] for x in sample.column("lang").to_pylist()], np.int64)
    return _train(languages, found, words, label)


def _train(languages: list[str], found: Features, words: Words, label: np.ndarray) -> Model:
    """AdaGrad on the conditional likelihood of segments of runs in random order."""
    labels = len(languages)
    random = np.random.default_rng(11)
    weights, past = np.zeros((SLOTS, labels)), np.full((SLOTS, labels), 1e-8)
    step, step_past = np.zeros((labels, labels)), np.full((labels, labels), 1e-8)
    counts = np.diff(words.first)
    per = SEGMENT // CHUNK
    at = np.arange(SEGMENT)
    for _ in range(EPOCHS):
        order = random.permutation(np.flatnonzero(counts))
        for k in range(0, len(order), BATCH * per):
            runs = order[k : k + BATCH * per]
            # Words of ``per`` runs follow each other in a segment.
            group = np.arange(len(runs)) // per
            size = counts[runs]
            word = np.repeat(words.first[runs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            of = np.repeat(group, size)
            nth = np.arange(len(word)) - np.searchsorted(of, of)
            length = np.bincount(of)
            inside = at < length[:, None]
            place = np.zeros(inside.shape, np.int64)
            place[of, nth] = np.arange(len(word))
            truth = np.repeat(label[runs], size)
            part = _take(found, word)
            scores = emissions(part, weights)
            both, joint = posteriors(scores[place], step, inside, pairs=True)
            slope = np.zeros((len(word), labels))
            slope[place[inside]] = both[inside]
            slope[np.arange(len(word)), truth] -= 1
            many = np.diff(part.first)
            slots = np.concatenate([part.words.T.reshape(-1), part.trigrams])
            for c in range(labels):
                value = np.concatenate([np.tile(slope[:, c], part.words.shape[1]), np.repeat(slope[:, c], many)])
                g = np.bincount(slots, value, SLOTS) / len(length) + PENALTY * weights[:, c]
                past[:, c] += g * g
                weights[:, c] -= RATE * g / np.sqrt(past[:, c])
            seen = np.zeros((labels, labels))
            next_in = np.flatnonzero(of[1:] == of[:-1])
            np.add.at(seen, (truth[next_in], truth[next_in + 1]), 1)
            g = (joint - seen) / len(length)
            step_past += g * g
            step -= RATE * g / np.sqrt(step_past)
    return Model(languages, weights.astype(np.float32), step)


def _take(found: Features, word: np.ndarray) -> Features:
    many = np.diff(found.first)[word]
    first = np.concatenate([[0], np.cumsum(many)])
    at = np.repeat(found.first[word] - first[:-1], many) + np.arange(first[-1])
    return Features(found.words[word], found.trigrams[at], first)


# --- prediction ------------------------------------------------------------------------------------

def predict(documents: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """``carry`` columns with lang_pred and score of each row's text."""
    has_letter: Column = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = documents.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"), has_letter.alias("_letter"))
    if model is None:
        return rows.drop("_text", "_letter").withColumns(
            {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)}
        )
    shared = documents.sparkSession.sparkContext.broadcast(model)  # SLOTS x languages numbers

    def run(batches):
        fitted = shared.value
        names = np.array([*fitted.languages, UNKNOWN], dtype=object)
        for batch, data, ends in pieces(batches, "_text", 1 << 18):
            words, found = label_words(data, ends, fitted)
            sums = np.zeros((len(found) + 1, len(fitted.languages)))
            np.cumsum(found, axis=0, out=sums[1:])
            share = sums[words.first[1:]] - sums[words.first[:-1]]
            total = np.diff(words.first)
            best = share.argmax(axis=1)
            score = share[np.arange(len(best)), best] / np.maximum(total, 1)
            known = batch.column("_letter").to_numpy(zero_copy_only=False) & (total > 0)
            best = np.where(known, best, len(fitted.languages))
            kept_columns = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays(
                [*kept_columns, pa.array(names[best], pa.string()), pa.array(np.clip(np.where(known, score, 0.0), 0, 1))],
                names=[*carry, "lang_pred", "score"],
            )

    schema = rows.drop("_text", "_letter").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(run, schema)
