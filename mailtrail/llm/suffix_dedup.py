"""Removal of repeated byte spans by sorted suffixes.

Every ``SPAN``-byte string (a window) that also starts in a document with a smaller doc_id is
covered, and covered bytes go. Windows are not sorted one by one:

* Equal texts are one text, owned by the smallest doc_id.
* The least hash of the ``GRAM``-byte strings in a window is its anchor; equal windows have equal
  anchors at equal places. About one byte in 18 is an anchor; only anchors that two texts share
  go on, with the bytes around them that their windows cover.
* Occurrences of an anchor are sorted by what follows and by what precedes it, deep-shallow: a
  multikey sort by characters of 8 bytes to a shallow depth, then a blind trie for each group that
  still shares its prefix. Two windows at the same distance from their anchor are equal where
  both common prefixes are long enough, so the smallest owner per window follows from two ranks.
* An anchor in more than ``HOT`` texts is dealt out by its windows instead of meeting in
  one task: its windows are grouped by their bytes, combined on the map side.

A null text is empty. A null doc_id is not smaller than another, and keeps its bytes. Rows with equal
doc_ids do not remove each other's bytes.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept, lists, pieces, restored, text_bytes, with_rest
from .words import U, mix, sliding_argmin

SPAN, GRAM = 50, 16
#: Bytes beside an anchor that its windows can reach, on either side of its GRAM bytes.
REACH = SPAN - GRAM
#: Texts with an anchor whose occurrences one task sorts.
HOT = 1 << 17
#: Occurrences sorted at once, those of an anchor together.
CHUNK = 1 << 13
#: Bytes of text whose anchors are sought at once: their arrays fit a core's cache.
PIECE = 1 << 16
#: Bytes to which the multikey sort goes before the blind tries.
SHALLOW = 16
_NO_OWNER = np.iinfo(np.int64).max
_LEFT, _RIGHT = U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)


# --- anchors -------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each place on."""
    wide = data.astype(U)
    for step in (1, 2, 4):
        wide = wide[:-step] | (wide[step:] << U(8 * step)) if len(wide) > step else wide[:0]
    return mix(wide[:-8] * _LEFT ^ wide[8:] * _RIGHT) if len(wide) > 8 else wide[:0]


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, row, place, and first and last window start of each anchor of the texts."""
    hashes = gram_hashes(data)
    least = sliding_argmin(hashes, SPAN - GRAM + 1)
    low = np.flatnonzero(np.diff(least, prepend=-1))
    high = np.append(low[1:], len(least)) - 1 if len(low) else low
    at = least[low]
    row = np.searchsorted(ends, at, "right") - 1
    # Windows that reach into another text are none.
    low, high = np.maximum(low, ends[row]), np.minimum(high, ends[row + 1] - SPAN) if len(low) else high
    real = low <= high
    at, row, low, high = at[real], row[real], low[real], high[real]
    base = ends[row]
    return hashes[at], row, at - base, low - base, high - base


def _anchor_rows(batches):
    for batch, data, ends in pieces(batches, "text", PIECE):
        hashes, row, _, _, _ = anchors(data, ends)
        hashes = hashes[order := np.lexsort((hashes, row))]
        row = row[order]
        new = (np.diff(row, prepend=-1) != 0) | (np.diff(hashes, prepend=U(0)) != 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[new].view(np.int64)), batch.column("text_id").take(pa.array(row[new]))],
            names=["hash", "text_id"],
        )


def _context_rows(batches):
    """Shared anchors with the bytes that their windows cover, zeros around them.

    Places of a text with the same bytes and windows are one row.
    """
    for batch, data, ends in pieces(batches, "text", PIECE):
        hashes, row, at, low, high = anchors(data, ends)
        counts = np.diff(batch.column("shared").offsets.to_numpy())
        known = batch.column("shared").flatten()
        pairs = np.zeros(len(known), [("row", np.int64), ("hash", U)])
        pairs["row"] = np.repeat(np.arange(len(counts)), counts)
        pairs["hash"] = known.field("hash").to_numpy().view(U)
        order = np.lexsort((pairs["hash"], pairs["row"]))
        pairs, is_hot = pairs[order], known.field("hot").to_numpy(zero_copy_only=False)[order]
        # One number per pair, found again for each anchor.
        key = lambda r, h: mix(h + mix(r.astype(U)))
        marks = key(pairs["row"], pairs["hash"])
        sort = np.argsort(marks)
        spot = np.minimum(np.searchsorted(marks[sort], key(row, hashes)), max(len(marks) - 1, 0))
        found = marks[sort][spot] == key(row, hashes) if len(marks) else np.zeros(len(row), bool)
        hot = is_hot[sort][spot[found]]
        hashes, row, at, low, high = (x[found] for x in (hashes, row, at, low, high))
        spread = at[:, None] + np.arange(-REACH, SPAN)
        used = (spread >= low[:, None]) & (spread < (high + SPAN)[:, None])
        spread = np.where(used, spread + ends[row][:, None], 0)
        around = np.where(used, data[spread] if len(data) else np.uint8(0), np.uint8(0))
        width = REACH + SPAN
        look = np.zeros((len(at), -(-(width + 10) // 8) * 8), np.uint8)
        look[:, :width] = around
        look[:, width : width + 8] = row.astype("<i8").reshape(-1, 1).view(np.uint8)
        look[:, width + 8] = at - low
        look[:, width + 9] = at - high
        mark = np.zeros(len(at), U)
        for word in look.view("<u8").T:
            mark = mix(mark + word.astype(U))
        order = np.argsort(mark, kind="stable")
        new = np.flatnonzero(np.diff(mark[order], prepend=mark[order][:1] - U(1)))
        one = order[new]
        spans = np.diff(np.append(new, len(order)))
        around = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(width), len(one), [None, pa.py_buffer(np.ascontiguousarray(around[one]))]
        ).cast(pa.binary())
        of = pa.array(row[one])
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[one].view(np.int64)), batch.column("text_id").take(of),
             batch.column("owner").take(of), lists(at[order].astype(np.int32), spans, pa.int32()),
             pa.array((at - low)[one].astype(np.int32)), pa.array((at - high)[one].astype(np.int32)),
             around, pa.array(hot[one])],
            names=["hash", "text_id", "owner", "at", "most", "least", "around", "hot"],
        )


#: at: places in the text; most, least: how far before them their windows start.
_CONTEXT = "hash bigint, text_id bigint, owner bigint, at array<int>, most int, least int, " \
    "around binary, hot boolean"


# --- deep-shallow sort ---------------------------------------------------------------

class BlindTrie:
    """Equal-length keys (as integers) in order, by the bits in which neighbours first differ.

    A branch is [bit, zero side, one side]; a leaf is a key. Descents look at branch bits only; one
    comparison with the leaf they reach finds the true first difference.
    """

    def __init__(self, key: int):
        self.root: list | int = key

    def add(self, key: int) -> None:
        node = self.root
        while isinstance(node, list):
            node = node[1 + (key >> node[0] & 1)]
        differs = (key ^ node).bit_length() - 1
        if differs < 0:
            return
        above, node = None, self.root
        while isinstance(node, list) and node[0] > differs:
            above, node = node, node[1 + (key >> node[0] & 1)]
        branch = [differs, key, node] if not key >> differs & 1 else [differs, node, key]
        if above is None:
            self.root = branch
        else:
            above[1 + (key >> above[0] & 1)] = branch

    def in_order(self) -> list[tuple[int, int]]:
        """Keys in order, each with the first bit in which it differs from the one before."""
        out, waiting = [], [(self.root, -1)]
        while waiting:
            node, bit = waiting.pop()
            if isinstance(node, list):
                waiting += [(node[2], node[0]), (node[1], bit)]
            else:
                out.append((node, bit))
        return out


def deep_shallow(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``strings`` within their groups (ascending numbers) and the length of
    the prefix each shares with the row before it in that order, -1 at a group's first."""
    n, width = strings.shape
    order = np.argsort(group, kind="stable")
    run = group[order]
    shared = np.full(n, width, np.int64)
    shared[np.flatnonzero(np.diff(run, prepend=run[:1] - 1))] = -1
    for depth in range(0, min(SHALLOW, width), 8):
        # Runs of equal prefixes are split by their next character of 8 bytes.
        starts = shared < depth
        run = np.cumsum(starts)
        size = np.bincount(run)[run]
        at = np.flatnonzero(size > 1)
        block = np.zeros((len(at), 8), np.uint8)
        part = strings[order[at], depth : depth + 8]
        block[:, : part.shape[1]] = part
        key = block.view(">u8")[:, 0].astype(U)
        turn = np.lexsort((key, run[at]))
        order[at], key = order[at][turn], key[turn]
        differs = np.zeros(len(at), U)
        differs[1:] = key[1:] ^ key[:-1]
        new = np.flatnonzero((differs != 0) & ~starts[at])
        # Equal leading bytes of the character: its highest different bit decides.
        bit = np.frexp((differs[new] >> U(11)).astype(np.float64))[1] + 10
        low = differs[new] >> U(11) == 0
        bit[low] = np.frexp(differs[new][low].astype(np.float64))[1] - 1
        shared[at[new]] = depth + (63 - bit) // 8
    if width > SHALLOW:
        _deepen(strings, order, shared, width)
    return order, shared


def _deepen(strings: np.ndarray, order: np.ndarray, shared: np.ndarray, width: int) -> None:
    """Orders, in place, runs that share SHALLOW bytes by a blind trie of what follows."""
    starts = np.flatnonzero(shared < SHALLOW)
    sizes = np.diff(np.append(starts, len(order)))
    head = np.repeat(starts, sizes)
    rest = strings[order, SHALLOW:]
    unlike = np.unique(head[(rest != rest[head]).any(axis=1)])
    size_of = dict(zip(starts.tolist(), sizes.tolist()))
    bits = 8 * (width - SHALLOW)
    for first in unlike.tolist():
        run = order[first : first + size_of[first]].copy()
        keys = [int.from_bytes(x, "big") for x in map(bytes, strings[run, SHALLOW:])]
        rows: dict[int, list[int]] = {}
        trie = BlindTrie(keys[0])
        for row, key in zip(run.tolist(), keys):
            if key in rows:
                rows[key].append(row)
            else:
                rows[key] = [row]
                trie.add(key)
        to = first
        for key, bit in trie.in_order():
            same = rows[key]
            order[to : to + len(same)] = same
            if to > first:
                shared[to] = SHALLOW + (bits - 1 - bit) // 8
            shared[to + 1 : to + len(same)] = width
            to += len(same)


# --- covered spans -------------------------------------------------------------------

def covered(hashes, owner, most, least, around) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, and start and end beside the anchor, of the spans whose windows also start in a text
    of a smaller owner."""
    n = len(hashes)
    group = np.unique(hashes, return_inverse=True)[1]
    ranks = []
    for strings in (around[:, REACH + GRAM :], around[:, REACH - 1 :: -1] if REACH else around[:, :0]):
        order, shared = deep_shallow(group, np.ascontiguousarray(strings[:, :REACH]))
        ranks.append((order, shared))
    covers = np.zeros((n, REACH + 3), np.int8)
    for before in range(REACH + 1):
        valid = np.flatnonzero((most >= before) & (least <= before))
        if not len(valid):
            continue
        key = np.zeros(n, np.int64)
        for (order, shared), needed in zip(ranks, (REACH - before, before)):
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(shared < needed)
            key = key * (n + 1) + rank
        key = key[valid]
        one = np.argsort(key)
        key, valid = key[one], valid[one]
        fresh = np.diff(key, prepend=key[0] - 1) != 0
        first_owner = np.minimum.reduceat(owner[valid], np.flatnonzero(fresh))
        covers[valid, before + 1] = first_owner[np.cumsum(fresh) - 1] < owner[valid]
    turn = np.diff(covers, axis=1)
    row, first = np.nonzero(turn == 1)
    _, after = np.nonzero(turn == -1)
    # Column k of ``turn`` is the window that starts k bytes before the anchor.
    return row, 1 - after, SPAN - first


def _span_rows(batches):
    """Spans of sorted occurrences; the last anchor of a chunk waits for the rest of it."""
    waiting: list[pa.RecordBatch] = []
    count = 0

    def spans(rows: pa.Table) -> pa.RecordBatch:
        take = lambda name: rows.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        data, _ = text_bytes(rows.column("around"))
        owner = rows.column("owner").fill_null(_NO_OWNER).combine_chunks().to_numpy()
        row, start, end = covered(
            take("hash"), owner, take("most"), take("least"), data.reshape(-1, REACH + SPAN)
        )
        at = rows.column("at").combine_chunks()
        first = at.offsets.to_numpy()
        places = np.diff(first)[row]
        # Each span of a row at each of the row's places.
        nth = np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        base = at.values.to_numpy()[np.repeat(first[row], places) + nth]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(take("text_id")[row], places)),
             pa.array((np.repeat(start, places) + base).astype(np.int32)),
             pa.array((np.repeat(end, places) + base).astype(np.int32))],
            names=["text_id", "start", "end"],
        )

    for batch in batches:
        waiting.append(batch)
        count += batch.num_rows
        if count < CHUNK:
            continue
        rows = pa.Table.from_batches(waiting)
        hashes = rows.column("hash").to_numpy()
        cut = int(np.searchsorted(hashes, hashes[-1]))
        if cut:
            yield spans(rows.slice(0, cut))
            waiting = rows.slice(cut).combine_chunks().to_batches()
            count = rows.num_rows - cut
    if count:
        yield spans(pa.Table.from_batches(waiting))


def _hot_spans(contexts: DataFrame) -> DataFrame:
    """Spans of the occurrences of hot anchors, by their windows."""
    windows = contexts.select(
        "text_id", "owner", "at", "around", F.explode(F.sequence("least", "most")).alias("before")
    ).select(
        "text_id", "owner", "at", "before",
        F.expr(f"substring(around, {REACH + 1} - before, {SPAN})").alias("window"),
    )
    least = windows.groupBy("window").agg(F.min("owner").alias("least"))
    return windows.join(least, "window").filter(
        "least is not null and (owner is null or owner > least)"
    ).select("text_id", F.explode("at").alias("at"), "before").select(
        "text_id", (F.col("at") - F.col("before")).alias("start"),
        (F.col("at") - F.col("before") + SPAN).alias("end"),
    )


def repeated_spans(documents: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (text_id, text, owner) and the spans (text_id, start, end) to remove, which
    may overlap."""
    texts = kept(
        documents.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id")
        .groupBy("text").agg(F.min("doc_id").alias("owner"))
        .withColumn("text_id", F.monotonically_increasing_id()),
        "suffix-texts",
    )
    found = texts.select("text_id", "text").mapInArrow(_anchor_rows, "hash bigint, text_id bigint")
    shared = kept(
        found.groupBy("hash")
        .agg(F.min("text_id").alias("a"), F.max("text_id").alias("b"), F.count("*").alias("n"))
        .filter("a < b").select("hash", (F.col("n") > hot).alias("hot")),
        "suffix-shared",
    )
    per_text = kept(
        found.join(shared, "hash").groupBy("text_id")
        .agg(F.collect_list(F.struct("hash", "hot")).alias("shared")),
        "suffix-per-text",
    )
    contexts = texts.join(per_text, "text_id").mapInArrow(_context_rows, _CONTEXT)
    if hot_anchors := shared.filter("hot").limit(1).count():
        contexts = kept(contexts, "suffix-contexts")
    spans = contexts.filter("not hot").repartition("hash").sortWithinPartitions("hash").mapInArrow(
        _span_rows, "text_id bigint, start int, end int"
    )
    if hot_anchors:
        spans = spans.unionByName(_hot_spans(contexts.filter("hot")))
    return texts, kept(spans, "suffix-spans")


def _whole_characters(gone: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The bytes of the characters that are gone as a whole."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(start):
        return gone
    return np.repeat(np.minimum.reduceat(gone, start), np.diff(np.append(start, len(data))))


def _kept_rows(batches, characters: bool = False):
    """What is left of each text, and its maximal removed runs."""
    for batch, data, ends in pieces(batches, "text"):
        edge = np.zeros(len(data) + 1, np.int32)
        spans = batch.column("spans")
        counts = np.diff(spans.offsets.to_numpy())
        base = np.repeat(ends[:-1], counts)
        flat = spans.flatten()
        np.add.at(edge, flat.field("start").to_numpy() + base, 1)
        np.add.at(edge, flat.field("end").to_numpy() + base, -1)
        gone = np.cumsum(edge[:-1]) > 0
        if characters:
            gone = _whole_characters(gone, data)
        turn = gone.copy()
        turn[1:] &= ~gone[:-1]
        border = ends[:-1][ends[:-1] < len(data)]
        turn[border] = gone[border]
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])
        left = ends - np.concatenate([[0], np.cumsum(gone)])[ends]
        keep = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), batch.num_rows,
            [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~gone]))],
        ).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("text_id"), pa.array(np.diff(ends)), pa.array(sums(gone)), pa.array(sums(turn)), keep],
            names=["text_id", "n_bytes", "n_removed", "n_spans", "left"],
        )


def shortened(texts: DataFrame, spans: DataFrame, characters: bool = False) -> DataFrame:
    """text_id, n_bytes, n_removed, n_spans and the bytes left, of every distinct text.

    With ``characters`` the bytes of a character stay unless all of them go.
    """
    # The spans of a text are some per anchor, and so bounded by its length.
    per_text = spans.groupBy("text_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return texts.join(per_text, "text_id", "left").select(
        "text_id", "text", F.coalesce("spans", none).alias("spans")
    ).mapInArrow(partial(_kept_rows, characters=characters), "text_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, left binary")


def per_document(
    documents: DataFrame, texts: DataFrame, results: DataFrame, empty: dict, carry: list[str] | None = None
) -> DataFrame:
    """Every row of ``documents`` (of its doc_id and ``carry`` columns) with the results of its text.

    ``empty`` gives, by result column, its values for a copy that loses all its bytes and for a row
    that keeps all.
    """
    # Texts meet by digest: rows are small, and copies of one text are split as a skewed join.
    keys = texts.select("text_id", "owner", F.md5(F.col("text").cast("binary")).alias("digest"))
    told = keys.join(results, "text_id").drop("text_id")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")
    docs = documents.select("doc_id", *(["text"] if carry is None else carry), digest)
    later = (F.col("doc_id") > F.col("owner")) & (F.col("n_bytes") >= SPAN)
    out = docs.join(told, "digest")
    for name, (gone, whole) in empty.items():
        out = out.withColumn(
            name, F.when(F.col("doc_id").isNull(), whole).when(later, gone).otherwise(F.col(name))
        )
    return out.drop("digest", "owner")


def without_repeats(documents: DataFrame) -> DataFrame:
    """All rows of ``documents`` with their repeated spans, in whole characters, cut from the text."""
    rows = with_rest(documents)
    texts, spans = repeated_spans(rows.select("doc_id", "text").filter("doc_id is not null"))
    left = kept(
        shortened(texts, spans, characters=True).select("text_id", "n_bytes", "left"), "suffix-left"
    )
    # A row without an id keeps its bytes, and takes none from others.
    told = per_document(rows.filter("doc_id is not null"), texts, left, {
        "left": (F.lit("").cast("binary"), F.col("left")),
    }, carry=["rest"])
    cut = told.select(F.col("left").cast("string").alias("text"), "rest")
    return restored(cut.unionByName(rows.filter("doc_id is null").select("text", "rest")), documents)
