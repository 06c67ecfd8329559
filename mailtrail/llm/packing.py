"""Packing of documents into token sequences, shortest pack first over the length histogram.

Documents are cut into pieces of at most ``size`` tokens; only the histogram of piece lengths
(``size`` counts, whatever the corpus) reaches the driver. It is walked from the longest length
down; a length goes to the open packs with the most room, in bulk, so what is kept is a count
per packing pattern. The pattern slots are joined back to the pieces by length and rank.

Null and empty texts are documents of the closing id alone. Repeated and null doc_ids are
documents like any other. An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import re
import zlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe_transducer
from .shared import kept, lists

SIZE = 1024
#: The id after each document.
CLOSING = 0


#: Longer texts go through the transducer of ``bpe_transducer``, which takes one step a byte: the pattern
#: engine of the library runs out of stack on a million blanks in a row. The ids are the same.
LONG_CHARS = 100_000


@lru_cache(maxsize=2)
def encoding(vocabulary: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """Byte-level BPE from a file of ranks; ``added`` strings are one id wherever they stand in a text."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added))


@lru_cache(maxsize=2)
def _added_pattern(added: tuple[tuple[str, int], ...]) -> re.Pattern:
    longest_first = sorted((text for text, _ in added), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")


def token_ids(text: str, vocabulary: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> np.ndarray:
    """Ids of a text of any length and any runs."""
    if len(text) <= LONG_CHARS:
        return encoding(vocabulary, pattern, added).encode_to_numpy(text, allowed_special="all")
    bpe = bpe_transducer.codec(vocabulary, pattern)
    if not added:
        return bpe.encode(text).astype(np.uint32)
    ids = dict(added)
    parts = [
        np.array([ids[part]], np.int32) if part in ids else bpe.encode(part)
        for part in _added_pattern(added).split(text)
    ]
    return np.concatenate(parts).astype(np.uint32)


def _piece_rows(vocabulary: str, pattern: str, added: tuple[tuple[str, int], ...], size: int, keep_ids: bool):
    def run(batches):
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            rows, ids = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                tokens = token_ids(text.as_py() or "", vocabulary, pattern, added)
                tokens = np.append(tokens, np.uint32(CLOSING))
                tokens = tokens.astype("<u4")
                for start in range(0, len(tokens), size):
                    piece = tokens[start : start + size]
                    n = len(piece)
                    rows.append((doc_id, start, n, zlib.crc32(piece), len(tokens), seen[n]))
                    seen[n] += 1
                    if keep_ids:
                        ids.append(piece)
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 6)]
            columns.insert(0, pa.array(np.full(len(rows), part), pa.int64()))
            if keep_ids:
                flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
                columns.append(lists(flat, np.array([len(x) for x in ids], np.int64), pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=_names(keep_ids))

    return run


def _names(keep_ids: bool) -> list[str]:
    return ["part", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth"] + ["ids"] * keep_ids


def shortest_pack_first(counts: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """How often each pattern of lengths is packed: (count, lengths), every length used up."""
    heap: list[tuple[int, int]] = []  # (filled, number of the group), the emptiest first
    groups: dict[int, tuple[int, tuple[int, ...]]] = {}
    done, numbers = [], itertools.count()

    def open_group(count: int, lengths: tuple[int, ...]) -> None:
        if count and sum(lengths) == size:
            done.append((count, lengths))
        elif count:
            key = next(numbers)
            groups[key] = (count, lengths)
            heapq.heappush(heap, (sum(lengths), key))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and heap and heap[0][0] + length <= size:
            _, key = heapq.heappop(heap)
            count, lengths = groups.pop(key)
            used = min(count, left)
            open_group(count - used, lengths)
            open_group(used, (*lengths, length))
            left -= used
        per = size // length
        open_group(left // per, (length,) * per)
        if left % per:
            open_group(1, (length,) * (left % per))
    return done + [groups[key] for _, key in heap]


def slots(patterns: Iterable[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): runs of ranks dealt to sequences."""
    out, dealt, base = [], {}, 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = dealt.get(length, 0)
            out.append((length, first, first + count, base, offset))
            dealt[length] = first + count
            offset += length
        base += count
    return out


def pack(
    documents: DataFrame, vocabulary: str, pattern: str, size: int = SIZE, keep_ids: bool = False,
    added: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    ``vocabulary`` is a file of ranks on every executor, ``pattern`` splits text before merges, ``added``
    are the strings that the tokenizer matches before it splits, with their ids.
    """
    spark = documents.sparkSession
    numbers = "part bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, " \
        "doc_tokens bigint, nth bigint"
    pieces = kept(
        documents.select("doc_id", "text").mapInArrow(
            _piece_rows(vocabulary, pattern, added, size, keep_ids),
            numbers + (", ids array<int>" if keep_ids else ""),
        ),
        "pack-pieces",
    )
    # A row per task and length; ranks need no sort of the pieces of a common length.
    dealt = pieces.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.select(
        "part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    counts = {r["length"]: r["n"] for r in dealt.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = spark.createDataFrame(
        slots(shortest_pack_first(counts, size)),
        "length bigint, first bigint, end bigint, sequence bigint, offset bigint",
    )
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    # The slots follow the histogram, not the corpus: some per length of 1 to ``size``.
    return ranked.join(
        F.broadcast(plan),
        (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")),
    ).select(
        "doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
        *(["ids"] if keep_ids else []),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and its ids, from pieces that keep theirs; at most ``size`` ids each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
