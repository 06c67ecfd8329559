"""Benchmark decontamination by winnowing.

Of every ``WINDOW - K + 1`` consecutive K-word hashes the least is a fingerprint, so any
``WINDOW`` words that a document shares with a benchmark item share a fingerprint at the
same place. Fingerprints are joined and each hit is extended to both sides; what reaches
``WINDOW`` words is covered. Items of fewer words have one fingerprint, all their words.

Nulls and texts without words have no fingerprints. A null item_id counts as an item, but has no
name to list. Repeated documents are reported one by one; items that share an id are one item.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import (
    RowNumbers, kept, lists, pieces, restored, schema_with_rest, with_columns, with_rest,
)
from .words import U, Words, grams, sliding_argmin, split_words

WINDOW, K = 10, 5
#: Words known on each side of a fingerprint: a window that holds it reaches no further.
SIDE = WINDOW - K
#: Bits of the filter that documents' fingerprints pass before the join. Its size is fixed;
#: it only saves shuffling, the join decides.
FILTER_BITS = 1 << 23

_HITS = "array<struct<fp:bigint,at:int,size:int,around:array<bigint>>>"
_HIT = pa.struct([("fp", pa.int64()), ("at", pa.int32()), ("size", pa.int32()),
                  ("around", pa.list_(pa.int64()))])


def _fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed K-grams of all texts of WINDOW words and more."""
    hashes, _ = grams(words, K)
    least = sliding_argmin(hashes, WINDOW - K + 1)
    whole = np.flatnonzero(words.row[: len(least)] == words.row[WINDOW - 1 :]) if len(least) else []
    at = np.unique(least[whole])
    return at, hashes[at]


def _around(words: Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of SIDE words before, ``size`` at and SIDE after each place; 0 beyond the text."""
    spread = at[:, None] + np.arange(-SIDE if size == K else 0, size + (SIDE if size == K else 0))
    row = words.row[at]
    inside = (spread >= words.first[row][:, None]) & (spread < words.first[row + 1][:, None])
    return np.where(inside, words.hash[np.clip(spread, 0, len(words.hash) - 1)], U(0)), row


def _short_sizes(items: DataFrame) -> list[int]:
    """Lengths below WINDOW that items have: WINDOW - 1 numbers at most."""
    return sorted(r[0] for r in items.filter(F.col("size") < WINDOW).select("size").distinct().collect())


def _item_rows(batches):
    for batch, data, ends in pieces(batches, "text"):
        words = split_words(data, ends)
        counts = np.diff(words.first)
        ids = batch.column("item_id")
        at, fp = _fingerprints(words)
        around, row = _around(words, at, K)
        yield _items(ids, row, fp, np.full(len(at), K), counts[row], around)
        for size in range(1, WINDOW):
            rows = np.flatnonzero(counts == size)
            if len(rows):
                hashes, _ = grams(words, size)
                around, row = _around(words, words.first[rows], size)
                yield _items(ids, row, hashes[words.first[rows]], np.full(len(rows), size),
                             np.full(len(rows), size), around)


def _items(ids, row, fp, length, size, around):
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(row)), pa.array(fp.view(np.int64)), pa.array(length.astype(np.int32)),
         pa.array(size.astype(np.int32)),
         lists(around.reshape(-1).view(np.int64), np.full(len(fp), around.shape[1]))],
        names=["item_id", "fp", "length", "size", "around"],
    )


def item_fingerprints(benchmark: DataFrame) -> DataFrame:
    """item_id, fp, length (words of the fingerprint), size (words of a window), around."""
    return benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(
        _item_rows, "item_id string, fp bigint, length int, size int, around array<bigint>"
    ).withColumn("size", F.least("size", F.lit(WINDOW)))


def _filter(items: DataFrame) -> np.ndarray:
    """A bit per hashed fingerprint, FILTER_BITS bits whatever the benchmark's size."""
    bit = F.col("fp").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = (
        items.groupBy(F.shiftright(bit, 5).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(fp & 31 as int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(FILTER_BITS >> 5, np.uint32)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def _document_rows(bits, sizes: list[int]):
    def run(batches):
        table, number = bits.value, RowNumbers()
        for batch, data, ends in pieces(batches, "text"):
            words = split_words(data, ends)
            found = []
            places = [(K, *_fingerprints(words))]
            for size in sizes:
                hashes, one_text = grams(words, size)
                places.append((size, np.flatnonzero(one_text), hashes[one_text]))
            for k, (size, at, fp) in enumerate(places):
                slot = (fp & U(FILTER_BITS - 1)).astype(np.int64)
                known = (table[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 == 1
                at, fp = at[known], fp[known]
                # The first entry holds fingerprints of windows, the others whole short items.
                around, row = _around(words, at, size if k else K)
                if k and size == K:
                    around = around[:, SIDE : SIDE + K]
                found.append((row, fp, at - words.first[row], np.full(len(at), size if k else -K), around))
            row = np.concatenate([x[0] for x in found])
            order = np.argsort(row, kind="stable")
            around = [x[4] for x in found]
            flat = np.concatenate([x.reshape(-1) for x in around])
            width = np.concatenate([np.full(len(x), x.shape[1]) for x in around])
            hits = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([x[1] for x in found]).view(np.int64)),
                 pa.array(np.concatenate([x[2] for x in found]).astype(np.int32)),
                 pa.array(np.concatenate([x[3] for x in found]).astype(np.int32)),
                 lists(flat.view(np.int64), width)],
                fields=list(_HIT),
            ).take(pa.array(order))
            per_row = np.bincount(row, minlength=batch.num_rows)
            starts = pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32))
            columns = {
                "row": pa.array(number.take(batch.num_rows)), "doc_id": batch.column("doc_id"),
                "n_words": pa.array(np.diff(words.first).astype(np.int64)),
                "hits": pa.ListArray.from_arrays(starts, hits),
            }
            if "rest" in batch.schema.names:
                columns["text"] = batch.column("text")
            yield with_columns(columns, batch)

    return run


def _same(a: str, b: str, places: list[int]) -> F.Column:
    """How many of the places, nearest first, agree without a gap."""
    total, so_far = F.lit(0), F.lit(True)
    for p in places:
        so_far = so_far & (F.col(a)[p] == F.col(b)[p]) & (F.col(a)[p] != 0)
        total = total + so_far.cast("int")
    return total


def contaminated_spans(documents: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents (row, doc_id, n_words; text and rest, if there is a rest) and the spans of words in which they hold windows
    of items (row, item_id, start, end)."""
    items = kept(item_fingerprints(benchmark), "winnow-items")
    spark = documents.sparkSession
    bits = spark.sparkContext.broadcast(_filter(items))
    sizes = _short_sizes(items)
    told = f"row bigint, doc_id bigint, n_words bigint, hits {_HITS}"
    if "rest" in documents.columns:
        told += ", text string"
    docs = kept(
        documents.mapInArrow(_document_rows(bits, sizes), schema_with_rest(told, documents)),
        "winnow-documents",
    )
    hits = docs.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    long_items = items.filter(F.col("size") == WINDOW).select(
        "item_id", "fp", F.col("around").alias("of_item")
    ).distinct()
    before = _same("around", "of_item", list(range(SIDE - 1, -1, -1)))
    after = _same("around", "of_item", list(range(SIDE + K, 2 * SIDE + K)))
    middle = F.slice("around", SIDE + 1, K) == F.slice("of_item", SIDE + 1, K)
    long_hits = (
        hits.filter("size < 0").join(long_items, "fp").filter(middle)
        .select("row", "item_id", (F.col("at") - before).alias("start"),
                (F.col("at") + K + after).alias("end"))
        .filter(F.col("end") - F.col("start") >= WINDOW)
    )
    short_items = items.filter(F.col("size") < WINDOW).select(
        "item_id", "fp", "size", F.col("around").alias("of_item")
    ).distinct()
    short_hits = (
        hits.filter("size > 0").join(short_items, ["fp", "size"])
        .filter(F.col("around") == F.col("of_item"))
        .select("row", "item_id", F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end"))
    )
    return docs.drop("hits"), long_hits.unionByName(short_hits)


def decontamination_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids) and contaminated, per document."""
    docs, spans = contaminated_spans(documents.select("doc_id", "text"), benchmark)
    # Hits of a document meet in one row each: as many as it has words, at most.
    spot = F.struct("start", "end")
    covered = F.aggregate(
        "spots",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], x["end"]).alias("to"),
        ),
    )["n"]
    per_row = spans.groupBy("row").agg(
        F.array_sort(F.collect_set(spot)).alias("spots"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.max(F.col("item_id").isNull().cast("int")).alias("unnamed"),
    ).select("row", covered.cast("bigint").alias("n_hit"), "items",
             (F.size("items") + F.col("unnamed")).cast("bigint").alias("n_items"))
    return docs.join(per_row, "row", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no window of any item, with all their columns."""
    docs, spans = contaminated_spans(with_rest(documents), benchmark)
    return restored(docs.join(spans.select("row").distinct(), "row", "left_anti"), documents)
