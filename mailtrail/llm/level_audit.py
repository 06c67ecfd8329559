"""How far the sources of a language differ in their words, priced from exact joint tables.

A term's level in a group (language and source) follows its count there, zero included. The
terms of a language are rows of 0/1 indicators, a column for each group and level; a block of
terms multiplied by its own transpose holds, for every two groups, how many terms have each
pair of levels: their joint table. A pair of groups costs what its table's cells cost, each
priced once however many terms are in it. Blocks are as long as their columns stay few; a block
of more columns is multiplied in pieces. Products are of small whole numbers, so they are exact.

Tasks add up the terms of their texts before anything is shuffled, by language and term; a
frequent term is a row per task. Tables leave a task as one sum per pair of groups, so what is
shuffled follows the sources and not the terms. Rows of a term meet the list of its language's
sources, as long as the report's own list of each of them, in a join salted by term.

Null text, language and source count as ''. Repeated rows are documents like any other, doc_id
and extra columns are not read. Equal values rank by item. A language without kept terms has
pairs of value 0 and no terms. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe_transducer import plain_text
from .shared import kept

#: Documents of its language that a kept term is in.
LEAST_DOCUMENTS = 10
#: Terms in the report of a group.
TERMS = 10
SCALE = 1_000_000_000
#: In a text of bytes, A-Z lowered: letters of ASCII and all beyond.
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Counts that a task holds before it gives them out.
HELD = 300_000
#: Indicator columns multiplied at once, and terms of a block.
COLUMNS, ROWS = 512, 8192
SALTS = 32


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, documents = defaultdict(Counter), defaultdict(Counter)

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            terms, n = list(found), len(found)
            within = documents[lang, source]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64()),
                    pa.array([within[t] for t in terms], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "documents"],
            )
        counts.clear()
        documents.clear()

    held = 0
    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for group, text in zip(groups, plain_text(batch.column("text"))):
            terms = _TERM.findall(text.encode().lower())
            within = documents[group]
            held -= len(within)
            counts[group].update(terms)
            within.update(set(terms))
            held += len(within)
            if held >= HELD:
                yield from given()
                held = 0
    yield from given()


def term_counts(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term, n and by_source (its counts) of the terms that a language keeps."""
    rows = documents.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    ).mapInArrow(_count_rows, "lang string, source string, term string, n bigint, documents bigint")
    # Tasks have added up already: one shuffle serves both groupings.
    by_source = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents")
    )
    return by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents"),
        F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("by_source"),
    ).filter(F.col("documents") >= least).drop("documents")


def group_totals(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """Per language: n_terms, total, and the totals of all its sources by name."""
    groups = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    each = terms.select("lang", F.explode("by_source").alias("source", "n"))
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    told = groups.join(totals, ["lang", "source"], "left").groupBy("lang").agg(
        F.map_from_entries(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0))))).alias("totals")
    )
    whole = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("total"))
    return told.join(whole, "lang", "left").select(
        "lang", F.array_sort(F.map_keys("totals")).alias("sources"), "totals",
        F.coalesce("n_terms", F.lit(0)).alias("n_terms"), F.coalesce("total", F.lit(0)).alias("total"),
    )


def share(count: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * n_terms)), exact for every count."""
    above = (count.cast("decimal(19,0)") + F.lit(2).cast("decimal(1,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(18,0)") + F.lit(2).cast("decimal(1,0)") * n_terms.cast("decimal(15,0)")
    return (F.lit(1) + F.call_function("div", above, below)).cast("bigint")


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _with_totals(terms: DataFrame, totals: DataFrame) -> DataFrame:
    """Terms with the sources, totals and sizes of their language; a language may hold all terms."""
    salted = totals.withColumnsRenamed({"total": "lang_total"}).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    return terms.withColumn("salt", salt).join(salted, ["lang", "salt"]).drop("salt")


def term_levels(terms: DataFrame, totals: DataFrame) -> DataFrame:
    """lang and levels: of each kept term its share in every source of the language, in their order."""
    level = lambda source: share(
        F.coalesce(F.try_element_at("by_source", source), F.lit(0)), F.element_at("totals", source), F.col("n_terms")
    )
    return _with_totals(terms, totals).select("lang", F.transform("sources", level).alias("levels"))


class Cells:
    """Cells of joint tables: first and second group, their levels, and the number of terms."""

    def __init__(self, first, second, p, q, n):
        self.first, self.second, self.p, self.q, self.n = first, second, p, q, n


def joint_cells(levels: np.ndarray) -> Iterator[Cells]:
    """The joint tables of every two columns of a matrix of terms and groups, block by block."""
    levels = levels[np.argsort(levels.sum(axis=1), kind="stable")]  # like terms have few columns
    at, size = 0, ROWS
    while at < len(levels):
        size = min(ROWS, 2 * size)
        while True:
            block = levels[at : at + size]
            found = [np.unique(column, return_inverse=True) for column in block.T]
            if len(block) == 1 or sum(len(values) for values, _ in found) <= COLUMNS:
                break
            size = len(block) // 2
        yield from _products(found, len(block))
        at += len(block)


def _products(found: list[tuple[np.ndarray, np.ndarray]], n_rows: int) -> Iterator[Cells]:
    sizes = np.array([len(values) for values, _ in found])
    start = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(found)), sizes)
    level = np.concatenate([values for values, _ in found])
    spots = np.stack([spot + first for (_, spot), first in zip(found, start)], axis=1)
    rows = np.arange(n_rows)

    def indicators(low: int, high: int) -> np.ndarray:
        # Sums of at most ROWS ones: exact in single precision.
        hot = np.zeros((n_rows, high - low), np.float32)
        row, column = np.nonzero((spots >= low) & (spots < high))
        hot[rows[row], spots[row, column] - low] = 1
        return hot

    pieces = [(low, min(low + COLUMNS, len(level))) for low in range(0, len(level), COLUMNS)]
    for k, (low, high) in enumerate(pieces):
        left = indicators(low, high).T
        for other_low, other_high in pieces[k:]:
            table = left @ indicators(other_low, other_high)
            i, j = np.nonzero(table)
            n = table[i, j].astype(np.int64)
            i, j = i + low, j + other_low
            upper = group[i] < group[j]
            i, j = i[upper], j[upper]
            yield Cells(group[i], group[j], level[i], level[j], n[upper])


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    langs = batch.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy()
    ends = batch.column("levels").offsets.to_numpy()
    flat = batch.column("levels").values.to_numpy()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        rows = np.flatnonzero(codes == code)
        width = ends[rows[0] + 1] - ends[rows[0]]
        yield lang, flat[ends[rows][:, None] + np.arange(width)]


def joint_tables(levels: DataFrame) -> DataFrame:
    """lang, first, second (places of sources), p, q, n: all joint tables of ``term_levels``."""

    def run(batches):
        for batch in batches:
            for lang, matrix in _by_language(batch):
                for c in joint_cells(matrix):
                    columns = [pa.array([lang] * len(c.n), pa.string())]
                    columns += [pa.array(x, pa.int64()) for x in (c.first, c.second, c.p, c.q, c.n)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["lang", "first", "second", "p", "q", "n"]
    cells = levels.mapInArrow(run, "lang string, first bigint, second bigint, p bigint, q bigint, n bigint")
    return cells.groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def pair_values(levels: DataFrame) -> DataFrame:
    """lang, first, second, value: the priced joint table of each pair of sources."""

    def run(batches):
        for batch in batches:
            for lang, matrix in _by_language(batch):
                size = matrix.shape[1]
                values = np.zeros(size * size, np.int64)
                for c in joint_cells(matrix):
                    np.add.at(values, c.first * size + c.second, c.n * ((c.p - c.q) ** 2 // (c.p + c.q)))
                first, second = np.triu_indices(size, 1)
                columns = [pa.array([lang] * len(first), pa.string())]
                columns += [pa.array(x, pa.int64()) for x in (first, second, values[first * size + second])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "first", "second", "value"])

    priced = levels.mapInArrow(run, "lang string, first bigint, second bigint, value bigint")
    return priced.groupBy("lang", "first", "second").agg(F.sum("value").alias("value"))


def audit(documents: DataFrame, least: int = LEAST_DOCUMENTS, n_terms: int = TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each other source lies, and what stands out."""
    terms = kept(term_counts(documents, least), "audit-terms")
    totals = kept(group_totals(documents, terms), "audit-totals")
    values = pair_values(term_levels(terms, totals))
    both = values.unionByName(values.select("lang", F.col("second").alias("first"), F.col("first").alias("second"), "value"))
    # As many rows as the report itself has: each source against each other one.
    listed = totals.select("lang", "sources", F.posexplode("sources").alias("first", "source")).select(
        "lang", "first", "source", F.posexplode("sources").alias("second", "item")
    ).filter("first != second")
    pairs = listed.join(both, ["lang", "first", "second"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")
    )
    counted = _with_totals(terms, totals).select(
        "lang", "term", share(F.col("n"), F.col("lang_total"), F.col("n_terms")).alias("q"), "totals", "n_terms",
        F.explode("by_source").alias("source", "count"),
    )
    p = share(F.col("count"), F.element_at("totals", F.col("source")), F.col("n_terms"))
    above = counted.withColumn("p", p).filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        price(F.col("p"), F.col("q")).alias("value"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    first = F.row_number().over(order).alias("rank")
    return pairs.select("*", first).unionByName(above.select("*", first).filter(F.col("rank") <= n_terms))
