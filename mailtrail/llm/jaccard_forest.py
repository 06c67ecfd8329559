"""Jaccard join of texts over word n-grams with a MinHash LSH forest.

Texts become sets of hashes of ``NGRAM`` words (of all their words, if fewer), and equal sets
one member with a number of copies. A member has a label of ``DEPTH`` MinHash values in each of
``TREES`` sorted prefix tries. A pair of similarity s shares a prefix of d values with probability
1 - (1 - s**d)**TREES. Members below a common prefix are compared, the longest with which that
reaches ``RECALL`` for a pair at the threshold; so it does for every closer pair, whatever else is
in the table. Pairs with longer common prefixes are among these.

No pairs of a common prefix leave a task: members are compared in blocks, and a task returns
the links as counts and as stars. Members that full labels show as possibly similar form groups;
in these the Jaccard similarity of whole sets decides.

Texts without words (null, empty) are similar to nothing and are their own class. A null doc_id comes
after all others. Repeated rows are copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import (
    RowNumbers, kept, pieces, restored, schema_with_rest, text_bytes, whole_groups, with_columns, with_rest,
)
from .words import U, grams, mix, split_words

NGRAM, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 20, 6, 0.9999
#: Share of equal label values from which a pair is compared exactly. At 0.8 a pair has fewer with
#: a probability of about 1e-7.
POSSIBLE = 0.6
#: Members on each side of a comparison; larger groups are dealt out in blocks.
BLOCK = 1024
#: Rows of sorted groups that a task takes at once.
CHUNK = 1 << 12
_MAX = (1 << 63) - 1


# --- sets and labels -------------------------------------------------------------------

def shingle_sets(data: np.ndarray, ends: np.ndarray, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts, and the n+1 offsets of each text's."""
    words = split_words(data, ends)
    hashes, one_text = grams(words, ngram)
    found, rows = [hashes[one_text]], [words.row[: len(hashes)][one_text]]
    counts = np.diff(words.first)
    for k in range(1, ngram):
        short = np.flatnonzero(counts == k)
        if len(short):
            hashes, _ = grams(words, k)
            found.append(mix(hashes[words.first[short]] + U(k)))
            rows.append(short)
    hashes, row = np.concatenate(found), np.concatenate(rows)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(len(ends)))


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, TREES * DEPTH + 1, dtype=U)
    return mix(at * U(0x9E3779B97F4A7C15)), mix(at * U(0xC2B2AE3D27D4EB4F)) | U(1)


def labels(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values, TREES x DEPTH per text; zeros for a text without words."""
    out = np.zeros((len(first) - 1, TREES * DEPTH), np.uint32)
    rows = np.flatnonzero(np.diff(first))
    if len(rows):
        starts = first[:-1][rows]
        for k, (flip, scale) in enumerate(zip(*_seeds())):
            out[rows, k] = np.minimum.reduceat((hashes ^ flip) * scale, starts) >> U(32)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(rows), [None, pa.py_buffer(rows)]
    ).cast(pa.binary())


def _label_rows(ngram: int):
    def run(batches):
        number = RowNumbers()
        for batch, data, ends in pieces(batches, "text", 1 << 18):
            hashes, first = shingle_sets(data, ends, ngram)
            sums = lambda x: np.diff(np.concatenate([np.zeros(1, U), np.cumsum(x)])[first]).view(np.int64)
            yield with_columns({
                "row": pa.array(number.take(batch.num_rows)), "doc_id": batch.column("doc_id"),
                "text": batch.column("text"), "n": pa.array(np.diff(first)), "sum1": pa.array(sums(hashes)),
                "sum2": pa.array(sums(mix(hashes + U(1)))), "label": _binary(labels(hashes, first)),
            }, batch)

    return run


# --- prefix tries ------------------------------------------------------------------------

def _node_rows(depth: int):
    """The node at ``depth`` of each tree under which a member lies."""

    def run(batches):
        tree = mix(np.arange(1, TREES + 1, dtype=U))
        for batch in batches:
            data, _ = text_bytes(batch.column("label"))
            label = data.view(np.uint32).reshape(-1, TREES, DEPTH)
            node = np.repeat(tree[None, :], len(label), 0)
            for k in range(depth):
                node = mix(node + label[:, :, k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.reshape(-1).view(np.int64)),
                 pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(label))),
                 pa.array(np.repeat(batch.column("member").to_numpy(), TREES))],
                names=["node", "tree", "member"],
            )

    return run


def _blocks(rows: DataFrame, size: str, member: str) -> DataFrame:
    """Rows dealt to all pairs (p, q) of blocks of their group that hold them; side 0 for p, 1 for q."""
    count = F.ceil(F.col(size) / BLOCK).cast("int")
    dealt = rows.withColumn("_n", count).withColumn("_own", F.pmod(F.xxhash64(member), F.col("_n")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return dealt.withColumn("p", F.least("_own", "_other")).withColumn("q", F.greatest("_own", "_other")).withColumn(
        "side", (F.col("_own") > F.col("_other")).cast("int")
    ).drop("_n", "_own", "_other", size)


def _roots(linked: np.ndarray, left: np.ndarray, right: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Least member linked with each of ``members``; linked[i, j]: left[i] with right[j] (places)."""
    root = members.copy()
    while True:
        before = root.copy()
        most = np.where(linked, root[right][None, :], _MAX).min(axis=1, initial=_MAX)
        np.minimum.at(root, left, most)
        most = np.where(linked, root[left][:, None], _MAX).min(axis=0, initial=_MAX)
        np.minimum.at(root, right, most)
        if (root == before).all():
            return root


def _sides(side: np.ndarray, start: int, end: int, one: bool) -> tuple[np.ndarray, np.ndarray]:
    places = np.arange(start, end)
    return (places, places) if one else (places[side[start:end] == 0], places[side[start:end] == 1])


def _possible_rows(depth: int):
    """Stars of members that may be similar; a pair counts at the first tree where it shares a prefix."""

    def run(batches):
        for rows, starts in whole_groups(batches, ["node", "p", "q"], CHUNK):
            data, _ = text_bytes(rows.column("label"))
            label = data.view(np.uint32).reshape(-1, TREES, DEPTH)
            side, tree = rows.column("side").to_numpy(), rows.column("tree").to_numpy()
            member = rows.column("member").to_numpy()
            one = rows.column("p").to_numpy() == rows.column("q").to_numpy()
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(member)]):
                left, right = _sides(side, start, end, one[start])
                if not len(left) or not len(right) or end - start < 2:
                    continue
                linked = np.zeros((len(left), len(right)), bool)
                step = max(1, (4 << 20) // (len(right) * TREES * DEPTH))
                for k in range(0, len(left), step):
                    same = label[left[k : k + step]][:, None] == label[right][None]
                    agree = same.sum(axis=(2, 3))
                    shares = same[..., :depth].all(-1)
                    new = ~shares[..., : tree[start]].any(-1)
                    if one[start]:
                        new &= member[left[k : k + step]][:, None] < member[right][None]
                    linked[k : k + step] = new & (agree >= POSSIBLE * TREES * DEPTH)
                if linked.any():
                    root = _roots(linked, left - start, right - start, member[start:end])
                    more = root != member[start:end]
                    a.append(member[start:end][more])
                    b.append(root[more])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
            )

    return run


def recall_of(met: dict[int, int], depth: int) -> float:
    """Least share of the pairs that tries meet at ``depth``, over the similarities at and above the threshold.

    ``met`` counts pairs by values in common. It may add similarities; one at the threshold is
    always among them, so that no number of closer pairs can stand for it.
    """
    at_least = {THRESHOLD, *(k / (TREES * DEPTH) for k, n in met.items() if n and k >= THRESHOLD * TREES * DEPTH)}
    return min(1 - (1 - s**depth) ** TREES for s in at_least)


def possible_links(members: DataFrame) -> DataFrame:
    """Edges (a, b) whose components hold every pair that the tries meet and labels allow."""
    depth = max((d for d in range(1, DEPTH + 1) if recall_of({}, d) >= RECALL), default=1)
    nodes = members.select("member", "label").mapInArrow(
        _node_rows(depth), "node bigint, tree int, member bigint"
    )
    busy = nodes.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
    below = kept(nodes.join(busy, "node"), "forest-nodes")
    return kept(
        _blocks(below.join(members.select("member", "label"), "member"), "size", "member")
        .repartition("node", "p", "q").sortWithinPartitions("node", "p", "q")
        .mapInArrow(_possible_rows(depth), "a bigint, b bigint"),
        "forest-links",
    )


# --- exact verification --------------------------------------------------------------------

def _verified_rows(ngram: int, threshold: float):
    """member, links (copies of similar members) and root (least similar member) in a block pair."""

    def run(batches):
        for rows, starts in whole_groups(batches, ["root", "p", "q"], CHUNK):
            side, member, copies = (rows.column(c).to_numpy() for c in ("side", "member", "copies"))
            one = rows.column("p").to_numpy() == rows.column("q").to_numpy()
            links, roots = np.zeros(len(member), np.int64), member.copy()
            text = rows.column("text").combine_chunks()
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(member)]):
                left, right = _sides(side, start, end, one[start])
                if not len(left) or not len(right) or end - start < 2:
                    continue
                data, ends = text_bytes(text.slice(start, end - start))
                hashes, first = shingle_sets(data, ends, ngram)
                size = np.diff(first)
                known, place = np.unique(hashes, return_inverse=True)
                on_right = np.concatenate([place[first[j - start] : first[j - start + 1]] for j in right])
                right_first = np.concatenate([[0], np.cumsum(size[right - start])[:-1]])
                linked = np.zeros((len(left), len(right)), bool)
                mark = np.zeros(len(known), bool)
                for k, i in enumerate(left - start):
                    own = place[first[i] : first[i + 1]]
                    mark[own] = True
                    common = np.add.reduceat(mark[on_right].astype(np.int64), right_first)
                    mark[own] = False
                    linked[k] = common >= threshold * (size[i] + size[right - start] - common) - 1e-9
                if one[start]:
                    np.fill_diagonal(linked, False)
                links[left] += linked @ copies[right]
                if not one[start]:
                    links[right] += linked.T @ copies[left]
                roots[start:end] = _roots(linked, left - start, right - start, member[start:end])
            yield pa.RecordBatch.from_arrays(
                [pa.array(member), pa.array(links), pa.array(roots)], names=["member", "links", "root"]
            )

    return run


def one_per_class(documents: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that lead their class, with all their columns."""
    docs, told = _classes(with_rest(documents), ngram, threshold)
    leads = kept(told.filter("leads").select("row"), "forest-leads")
    return restored(docs.join(leads, "row", "left_semi"), documents)


def near_duplicates(
    documents: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: row, doc_id, class_id, n_links, copy_of and leads.

    n_links counts the other documents of at least that similarity. A class is a connected
    component of such links, class_id its smallest doc_id, copy_of the smallest doc_id with the same
    set; ``leads`` is true for one document of each class, of that doc_id.
    """
    return _classes(documents.select("doc_id", "text"), ngram, threshold)[1]


def _classes(documents: DataFrame, ngram: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The numbered rows, and what near_duplicates tells of them."""
    told = "row bigint, doc_id bigint, text string, n bigint, sum1 bigint, sum2 bigint, label binary"
    docs = kept(
        documents.mapInArrow(_label_rows(ngram), schema_with_rest(told, documents)), "forest-documents"
    )
    same = ["n", "sum1", "sum2"]
    with_words = docs.filter("n > 0")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(_MAX)).alias("doc"), "row"))
    classes = kept(
        with_words.groupBy(*same).agg(F.min("row").alias("member"), F.count("*").alias("copies"), first.alias("first")),
        "forest-classes",
    )
    members = kept(
        with_words.join(classes.select(F.col("member").alias("row")), "row", "left_semi")
        .select(F.col("row").alias("member"), "label"),
        "forest-members",
    )
    groups = components(possible_links(members)).withColumnRenamed("root", "group")
    groups = kept(
        groups.unionByName(groups.select(F.col("group").alias("node"), "group").distinct()), "forest-groups"
    )
    sizes = groups.groupBy("group").agg(F.count("*").alias("size"))
    compared = (
        groups.join(sizes, "group")
        .join(classes.select(F.col("member").alias("node"), "copies"), "node")
        .join(with_words.select(F.col("row").alias("node"), "text"), "node")
        .select(F.col("group").alias("root"), F.col("node").alias("member"), "copies", "size", "text")
    )
    told = kept(
        _blocks(compared, "size", "member").repartition("root", "p", "q").sortWithinPartitions("root", "p", "q")
        .mapInArrow(_verified_rows(ngram, threshold), "member bigint, links bigint, root bigint"),
        "forest-verified",
    )
    links = told.groupBy("member").agg(F.sum("links").alias("links"))
    joined = components(told.filter("member != root").select(F.col("member").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.join(links, "member", "left").join(joined.withColumnRenamed("node", "member"), "member", "left")
        .withColumn("root", F.coalesce("root", "member"))
    )
    lead = per_class.groupBy("root").agg(F.min("first").alias("lead"))
    told_classes = per_class.join(lead, "root").select(
        *same, "lead", "first",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
    )
    named = lambda c: F.when(F.col(c)["doc"] != _MAX, F.col(c)["doc"])
    found = with_words.select("row", "doc_id", *same).join(told_classes, same).select(
        "row", "doc_id", named("lead").alias("class_id"), "n_links", named("first").alias("copy_of"),
        (F.col("row") == F.col("lead")["row"]).alias("leads"),
    )
    alone = docs.filter("n = 0").select(
        "row", "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.col("doc_id").alias("copy_of"), F.lit(True).alias("leads"),
    )
    return docs, found.unionByName(alone)
