"""Nearest neighbours by cosine through a kd-tree over low-dimensional stable projections.

Vectors of unit length are projected by a Gaussian (2-stable) matrix to ``M`` numbers: the squared
projected distance of two vectors, over their squared distance, follows a chi-square law of M
degrees. The projections are split into kd cells (fitted on a bounded sample; every vector is in
one), and a cell into blocks. A query meets all vectors of its own cell on their full length, many
queries in one matrix product; with its k-th best it then goes on to the other cells, but for
those where a vector as near would lie nearer in projection with probability ``SURE``.

Vectors that are null, zero, or hold null or non-finite numbers take no part, nor do rows without
vec_id; vectors of different lengths are not compared. Of equal vectors only the k + 1 smallest
ids can be among k nearest; the others are not searched. A query's own id is no candidate for it.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept, text_bytes

M, SURE = 8, 0.999
#: Rows on which cells are fitted, per vector length.
SAMPLE = 8192
MAX_CELLS, CELL_ROWS, BLOCK_ROWS = 1024, 4096, 8192
#: Cosines that a task has in memory at once, and their rounding at most.
PAIRS, SLACK = 1 << 20, 1e-9
#: Partial groups of equal vectors, before they meet.
SALTS = 64
_ROW = "cell bigint, block int, kind int, id bigint, ids array<bigint>, bound double, vec binary"


def chi_square_quantile(p: float, degrees: int) -> float:
    """Where the chi-square distribution of an even number of degrees reaches p."""
    half = degrees // 2

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(half))

    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Cells(NamedTuple):
    """A stable projection and kd splits: node i splits at ``cut[i]`` along ``axis[i]`` to 2i+1, 2i+2."""

    matrix: np.ndarray
    axis: np.ndarray
    cut: np.ndarray

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ self.matrix

    def cell(self, projected: np.ndarray) -> np.ndarray:
        at = np.zeros(len(projected), np.int64)
        for _ in range((len(self.axis) + 1).bit_length() - 1):
            right = projected[np.arange(len(at)), self.axis[at]] >= self.cut[at]
            at = 2 * at + 1 + right
        return at - len(self.axis)


def fit_cells(sample: np.ndarray, dimension: int, cells: int) -> Cells:
    """Splits at sample medians, along the widest axis of each part; ``cells`` is a power of two."""
    matrix = np.random.default_rng(dimension).standard_normal((dimension, M))
    model = Cells(matrix, np.zeros(cells - 1, np.int64), np.zeros(cells - 1))
    parts = [model.project(sample)]
    for node in range(cells - 1):
        part = parts[node]
        if len(part):
            axis = int(np.argmax(np.ptp(part, axis=0)))
            model.axis[node], model.cut[node] = axis, np.median(part[:, axis])
        right = part[:, model.axis[node]] >= model.cut[node]
        parts += [part[~right], part[right]]
    return model


def _matrix(column: pa.Array) -> np.ndarray:
    data, ends = text_bytes(column)
    return data.view("<f8").reshape(len(ends) - 1, -1) if len(data) else np.zeros((0, 1))


# --- preparing -----------------------------------------------------------------------------

def _usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, dim and vec (its numbers as doubles) of the rows that take part."""
    numbers = F.col("embedding").cast("array<double>")
    fine = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.select("vec_id", numbers.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine
        & F.exists("embedding", lambda x: x != 0)
    )

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            ends = (ends - ends[0]) * 8
            vec = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(column),
                [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat, "<f8"))],
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array((np.diff(ends) // 8).astype(np.int32)), vec],
                names=["vec_id", "dim", "vec"],
            )

    # -0.0 is 0.0 in a comparison, so also as bytes.
    return rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0))).mapInArrow(
        run, "vec_id bigint, dim int, vec binary"
    )


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """Each vector once, with the k + 1 smallest of its ids; a hot vector is cut down in parts."""
    salted = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    few = salted.withColumn("nth", F.row_number().over(Window.partitionBy("vec", "salt").orderBy("vec_id")))
    few = few.filter(F.col("nth") <= k + 1).withColumn(
        "nth", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    )
    return few.filter(F.col("nth") <= k + 1).groupBy("dim", "vec").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids")
    )


def _fit(vectors: DataFrame) -> dict[int, Cells]:
    """A model per vector length, on SAMPLE rows at most of each."""
    models = {}
    for r in vectors.groupBy("dim").count().collect():
        sample = (
            vectors.filter(F.col("dim") == r["dim"]).select("vec")
            .orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).toPandas()["vec"]
        )
        rows = np.frombuffer(b"".join(map(bytes, sample)), "<f8").reshape(len(sample), r["dim"])
        cells = min(MAX_CELLS, max(1, r["count"] // CELL_ROWS), max(1, len(rows) // 8))
        models[r["dim"]] = fit_cells(rows, r["dim"], 1 << (cells.bit_length() - 1))
    return models


def _in_cells(models: dict[int, Cells]):
    """Adds the cell (numbered over all lengths) and the projection to rows with dim and vec."""
    base = {dim: k * MAX_CELLS for k, dim in enumerate(sorted(models))}

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                projected = models[dim].project(_matrix(part.column("vec")))
                cell = models[dim].cell(projected) + base[dim]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(projected.reshape(-1)), M).cast(
                    pa.list_(pa.float64())
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell), lists], names=[*part.schema.names, "cell", "projected"]
                )

    return run


# --- searching -----------------------------------------------------------------------------

class Block:
    """The vectors of a block, searched by a batch of queries at once."""

    def __init__(self, vectors: np.ndarray, ids: list):
        self.vectors, self.ids = vectors, ids
        self.norms = np.linalg.norm(vectors, axis=1)

    def nearest(self, own: list, queries: np.ndarray, bounds: np.ndarray, k: int):
        """Per query up to k (score, id), the best first, among what can be nearer than its bound."""
        norms = np.linalg.norm(queries, axis=1)
        step = max(1, PAIRS // len(self.vectors))
        for start in range(0, len(queries), step):
            part = slice(start, start + step)
            cosines = (queries[part] / norms[part, None]) @ self.vectors.T / self.norms
            cosines[np.isnan(cosines)] = -2  # a length that is 0 in double precision
            # Products are rounded by their place in the matrix: what is within SLACK is scored by itself.
            least = 1 - bounds[part] / 2
            if len(self.vectors) > k + 1:  # the query's own vector can be one of them
                top = np.argpartition(cosines, -(k + 1), axis=1)[:, -(k + 1):]
                least = np.maximum(least, np.take_along_axis(cosines, top, axis=1).min(axis=1))
            query, row = np.nonzero(cosines >= (least - SLACK)[:, None])
            turn = np.searchsorted(query, np.arange(len(cosines) + 1))
            for n in range(len(cosines)):
                vector, rows = queries[start + n], row[turn[n]:turn[n + 1]]
                scores = (self.vectors[rows] * vector).sum(axis=1) / (self.norms[rows] * norms[start + n])
                best = [
                    (score, x) for score, r in zip(scores.tolist(), rows.tolist())
                    for x in self.ids[r] if x != own[start + n]
                ]
                yield sorted(best, key=lambda x: (-x[0], x[1]))[:k]


def _search_rows(k: int):
    def run(batches):
        key, rows, held = None, [], None
        for batch in batches:
            cells, blocks, kinds = (batch.column(c).to_numpy() for c in ("cell", "block", "kind"))
            turn = np.flatnonzero(np.diff(cells, prepend=-1) | np.diff(blocks, prepend=-1) | np.diff(kinds, prepend=-1))
            out = []
            for start, end in zip(turn.tolist(), [*turn[1:].tolist(), batch.num_rows]):
                part = batch.slice(start, end - start)
                if (now := (cells[start], blocks[start])) != key:
                    key, rows, held = now, [], None
                if kinds[start] == 0:
                    rows.append(part)
                    continue
                if not rows:
                    continue
                if held is None:
                    vectors = np.concatenate([_matrix(x.column("vec")) for x in rows])
                    held = Block(vectors, [i for x in rows for i in x.column("ids").to_pylist()])
                query, own = part.column("id").to_pylist(), [x[0] for x in part.column("ids").to_pylist()]
                bounds = part.column("bound").to_numpy()
                best = held.nearest(own, _matrix(part.column("vec")), bounds, k)
                out += [(q, o, score, i) for q, o, found in zip(query, own, best) for score, i in found]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64())],
                names=["query", "query_id", "score", "vec_id"],
            )

    return run


def _search(index: DataFrame, routed: DataFrame, k: int) -> DataFrame:
    """The k best of each block for the queries routed to its cell (query, vec_id, cell, bound, vec)."""
    blocks = index.select("cell", "blocks").distinct()
    sent = routed.join(blocks, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"),
        F.col("query").alias("id"), F.array("vec_id").alias("ids"), "bound", "vec",
    )
    held = index.select(
        "cell", "block", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("id"), "ids",
        F.lit(0.0).alias("bound"), "vec",
    )
    # A block's vectors come first, then its queries, of which a task holds a batch at a time.
    return held.unionByName(sent).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind").mapInArrow(
        _search_rows(k), "query bigint, query_id bigint, score double, vec_id bigint"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _other_cells(models: dict[int, Cells], boxes: list):
    """Sends a query to the other cells whose projections pass the chi-square test."""
    limit = chi_square_quantile(SURE, M)
    cells = np.array([b["cell"] for b in boxes])
    low, high = np.array([b["low"] for b in boxes]), np.array([b["high"] for b in boxes])
    first = {dim: n * MAX_CELLS for n, dim in enumerate(sorted(models))}

    def run(batches):
        for batch in batches:
            query, cell = [], []
            own = batch.column("cell").to_numpy()
            projected = batch.column("projected").flatten().to_numpy().reshape(-1, M)
            for n, (q, dim, bound) in enumerate(zip(
                batch.column("query").to_pylist(), batch.column("dim").to_pylist(), batch.column("bound").to_pylist()
            )):
                gap = np.maximum(0, np.maximum(low - projected[n], projected[n] - high))
                go = ((gap * gap).sum(axis=1) <= limit * bound) & (cells // MAX_CELLS == first[dim] // MAX_CELLS)
                go &= cells != own[n]
                query += [n] * int(go.sum())
                cell += cells[go].tolist()
            at = pa.array(query, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(at) for c in ("query", "vec_id", "bound", "vec")] + [pa.array(cell, pa.int64())],
                names=["query", "vec_id", "bound", "vec", "cell"],
            )

    return run


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest rows found for each query.

    Both have vec_id and embedding. Equal scores are in order of vec_id.
    """
    rows = kept(_usable(embeddings), "search-vectors")
    vectors = kept(_distinct(rows, k), "search-distinct")
    models = _fit(vectors)
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if not models:
        return embeddings.sparkSession.createDataFrame([], empty)
    placed = vectors.mapInArrow(
        _in_cells(models), "dim int, vec binary, ids array<bigint>, cell bigint, projected array<double>"
    )
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    index = kept(
        placed.join(F.broadcast(sizes), "cell")  # some per vector length, MAX_CELLS at most
        .withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int")),
        "search-index",
    )
    boxes = index.groupBy("cell").agg(
        F.array(*[F.min(F.col("projected")[i]) for i in range(M)]).alias("low"),
        F.array(*[F.max(F.col("projected")[i]) for i in range(M)]).alias("high"),
    ).collect()
    asked = kept(
        _usable(queries).withColumn("query", F.monotonically_increasing_id())
        .filter(F.col("dim").isin(list(models)))
        .mapInArrow(
            _in_cells(models),
            "vec_id bigint, dim int, vec binary, query bigint, cell bigint, projected array<double>",
        ),
        "search-queries",
    )
    near = kept(
        _best(_search(index, asked.withColumn("bound", F.lit(4.1)), k), k), "search-near"
    )
    bounds = near.filter(F.col("rank") == k).select(
        "query", (F.greatest(2 - 2 * F.col("score"), F.lit(0.0)) + 1e-12).alias("bound")
    )
    more = (
        asked.join(bounds, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(4.1)))
        .mapInArrow(
            _other_cells(models, boxes), "query bigint, vec_id bigint, bound double, vec binary, cell bigint"
        )
    )
    found = near.drop("rank").unionByName(_search(index, more, k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
