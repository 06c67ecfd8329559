"""Alignment of two tokenizers' tokens over the same bytes, and how often ids are linked.

Offsets where tokens of A and B both end cut a text into groups; the tokens that end a group
are linked. An array made once maps each A id to the B id of the same bytes. A group of one
token a side is a group of equal bytes: its links are counted in a vector as long as the
vocabulary, one a task, and the sum of the vectors goes to all tasks. Only the links of other
groups are pairs that are shuffled: added up per document first, then counted by pair. Pairs
with at least one in ``SHARE`` of these links, so no more than ``SHARE``, go to all tasks as
well; documents meet the counts of the others in a join without hot keys.

Texts are encoded once; what the documents hold of links is written as arrays of ids and times.
Memory follows a slice of some hundred KB, or one text. A text that is null or empty, or whose
tokens' bytes are not a blank and the text, has no tokens: zeros. Repeated and null ids of
documents are rows like any other; extra columns stay out. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_transducer import Codec, plain_text
from .shared import RowNumbers, kept, lists, pieces

SHARE = 1 << 16
#: Bytes of texts that are aligned at once; a longer text is aligned alone.
SLICE_BYTES = 1 << 18
#: A longer text is split for B before blanks between other characters.
PART_CHARS = 1 << 18
_BORDER = re.compile(r"(?<=[^ ]) (?=[^ ])")
#: What a model's file says of a normaliser that leaves texts as they are: its name, and no table.
_IDENTITY = b"\n\x08identity\x12\x00"
_BLANK = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with.

    Visible characters of Latin-1 stand for themselves, the other bytes for those after 255.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteBpe:
    """A: a tokenizers file of a byte-level BPE without normalisation."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as told:
            vocabulary = json.load(told)["model"]["vocab"]
        added, letters = set(), _byte_letters()
        ranks = {}
        for entry, number in vocabulary.items():
            if all(c in letters for c in entry):
                ranks[bytes(letters[c] for c in entry)] = number
            else:
                added.add(number)
        with open(path, encoding="utf-8") as told:
            specials = {t["id"] for t in json.load(told)["added_tokens"]}
        ranks = {token: number for token, number in ranks.items() if number not in specials}
        self.codec = Codec(ranks, pattern)
        self.bytes_of = self.codec.bytes_of + [b""] * (len(vocabulary) - len(self.codec.bytes_of))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        found = [self.codec.encode(text) for text in texts]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(x) for x in found], np.int64)


class Pieces:
    """B: a sentencepiece model that adds a blank before the text.

    Where blanks only begin its pieces and it does not normalise texts, no piece goes on across
    a blank after another character: a long text is then encoded in parts.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(name)) else name.replace(_BLANK, " ").encode()
            for name in names
        ]
        plain = _IDENTITY in self.model.serialized_model_proto()
        self.apart = plain and not any(_BLANK in name.lstrip(_BLANK) for name in names)

    def _parts(self, text: str) -> Iterator[str]:
        """Parts that are encoded alike alone; the blank between two is the one that the model adds."""
        at = 0
        while self.apart and len(text) - at > PART_CHARS and (border := _BORDER.search(text, at + PART_CHARS)):
            yield text[at : border.start()]
            at = border.end()
        yield text[at:]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has; those of an empty text are none."""
        found, counts = array("i"), []
        for text in texts:
            before = len(found)
            for part in self._parts(text) if text else ():
                found.extend(self.model.encode(part))
            counts.append(len(found) - before)
        return np.frombuffer(found, np.int32) if found else np.zeros(0, np.int32), np.array(counts, np.int64)


class Strings:
    """Byte strings by number, put together for many numbers at once."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        length = self.length[numbers]
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0)
        return self.data[at + np.repeat(self.start[numbers] - (ends - length), length)]


class Aligner:
    """Both tokenizers, the map of equal bytes and the names of all ids."""

    def __init__(self, first: str, pattern: str, second: str):
        self.a, self.b = ByteBpe(first, pattern), Pieces(second)
        self.n_a, self.n_b = len(self.a.bytes_of), len(self.b.bytes_of)
        self.same = identity(self.a.bytes_of, self.b.bytes_of)
        self.bytes_a, self.bytes_b = Strings(self.a.bytes_of), Strings(self.b.bytes_of)
        #: Ids with what follows them: within a side, at the end of A's side, at the end of a group.
        self.names = Strings([
            f"{i}{mark}".encode() for size, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for mark in marks
            for i in range(size)
        ])


def identity(first: list[bytes], second: list[bytes]) -> np.ndarray:
    """Per id of the first vocabulary the id of the same bytes in the second, or -1.

    Of several in the second the last: byte pieces stand before the pieces of characters.
    """
    known = {token: number for number, token in enumerate(second) if token}
    return np.array([known.get(token, -1) if token else -1 for token in first], np.int32)


@lru_cache(maxsize=1)
def aligner(first: str, pattern: str, second: str) -> Aligner:
    return Aligner(first, pattern, second)


class Links(NamedTuple):
    """What a slice of texts holds: per text numbers, and its links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    told: pa.Array
    #: Row and id of each link of a group of equal bytes.
    exact_row: np.ndarray
    exact: np.ndarray
    #: Row and pair (A id times the size of B, plus B id) of each other link.
    pair_row: np.ndarray
    pair: np.ndarray


def _are(strings: Strings, ids: np.ndarray, counts: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """Whether each row's tokens are these bytes."""
    ends = np.concatenate([[0], np.cumsum(strings.length[ids])])[np.concatenate([[0], np.cumsum(counts)])]
    data = strings.joined(ids).tobytes()
    return np.array([data[ends[k] : ends[k + 1]] == want for k, want in enumerate(wanted)], bool)


def links(own: Aligner, texts: list[str]) -> Links:
    """The groups and links of texts, all at once."""
    wanted = [b" " + text.encode() if text else b"" for text in texts]
    a, count_a = own.a.encode([" " + text if text else "" for text in texts])
    b, count_b = own.b.encode(texts)
    equal = _are(own.bytes_a, a, count_a, wanted) & _are(own.bytes_b, b, count_b, wanted)
    a, b = a[np.repeat(equal, count_a)].astype(np.int64), b[np.repeat(equal, count_b)].astype(np.int64)
    count_a, count_b = np.where(equal, count_a, 0), np.where(equal, count_b, 0)
    end_a, end_b = np.cumsum(own.bytes_a.length[a]), np.cumsum(own.bytes_b.length[b])
    # Texts end where both end, so no group goes beyond one.
    ends_a, ends_b = (np.zeros(end_a[-1] + 1 if len(a) else 1, bool) for _ in range(2))
    ends_a[end_a], ends_b[end_b] = True, True
    last_a, last_b = np.flatnonzero(ends_b[end_a]), np.flatnonzero(ends_a[end_b])
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    row = np.repeat(np.arange(len(texts)), count_a)[last_a]
    alone = (size_a == 1) & (size_b == 1) & (own.same[a[last_a]] == b[last_b])
    # A group is its A ids, then its B ids: place all ids in this order.
    group_a = np.repeat(np.arange(len(last_a)), size_a)
    group_b = np.repeat(np.arange(len(last_a)), size_b)
    before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b)
    names = np.empty(len(a) + len(b), np.int64)
    code_a, code_b = a.copy(), b + 2 * own.n_a
    code_a[last_a] += own.n_a
    code_b[last_b] += own.n_b
    names[np.arange(len(a)) + (before_b - size_b)[group_a]] = code_a
    names[np.arange(len(b)) + (before_a + size_a)[group_b]] = code_b
    ends = np.concatenate([[0], np.cumsum(own.names.length[names])])[np.concatenate([[0], np.cumsum(count_a + count_b)])]
    told = own.names.joined(names).tobytes().decode()
    return Links(
        count_a, count_b, np.bincount(row, minlength=len(texts)),
        pa.array([told[ends[k] : max(ends[k], ends[k + 1] - 1)] for k in range(len(texts))], pa.string()),
        row[alone], a[last_a][alone], row[~alone], (a[last_a] * own.n_b + b[last_b])[~alone],
    )


def _per_row(rows: np.ndarray, values: np.ndarray, n: int, span: int, kind: pa.DataType) -> tuple[pa.Array, pa.Array]:
    """Per row its different values, all below ``span``, and how often it has each."""
    keys, times = np.unique(rows * span + values, return_counts=True)
    counts = np.bincount(keys // span, minlength=n)
    return lists(keys % span, counts, kind), lists(times, counts, pa.int32())


_COLUMNS = (
    "number bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, told string, "
    "exact array<int>, exact_times array<int>, pairs array<bigint>, pair_times array<int>, "
    "counts array<bigint>"
)


def aligned(documents: DataFrame, first: str, pattern: str, second: str) -> DataFrame:
    """Per document its numbers, groups and links; per task a last row with its vector of counts.

    ``first`` and ``second`` are files on every executor. ``told`` holds the groups, as in
    ``a1,a2|b1;a3|b2,b3``; ``counts`` is null but in the rows of vectors, which have no ``number``.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own, numbers = aligner(first, pattern, second), RowNumbers()
        vector = np.zeros(own.n_a, np.int64)
        schema, names = None, ["doc_id", *[c.split()[0] for c in _COLUMNS.split(", ")]]
        for batch in batches:
            schema = batch.schema.field("doc_id").type
            for rows, _, _ in pieces([batch], "text", SLICE_BYTES):
                found = links(own, list(plain_text(rows.column("text"))))
                vector += np.bincount(found.exact, minlength=own.n_a)
                n = rows.num_rows
                exact = _per_row(found.exact_row, found.exact, n, own.n_a, pa.int32())
                pairs = _per_row(found.pair_row, found.pair, n, own.n_a * own.n_b, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"), pa.array(numbers.take(n)), pa.array(found.n_a), pa.array(found.n_b),
                        pa.array(found.n_groups), pa.array(found.n_groups), found.told,
                        *exact, *pairs, pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names=names,
                )
        if schema is not None:
            columns = [pa.nulls(1, schema), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string())]
            columns += [pa.nulls(1, pa.list_(t)) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*columns, lists(vector, np.array([len(vector)]), pa.int64())], names=names
            )

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_COLUMNS}")


def _exact_counts(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' vectors."""
    each = rows.filter("counts IS NOT NULL").select(F.posexplode("counts").alias("id", "n")).filter("n > 0")
    total = np.zeros(size, np.int64)
    for row in each.groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():  # a row per id at most
        total[row["id"]] = row["n"]
    return total


def _pairs(rows: DataFrame, *columns: str) -> DataFrame:
    """A row per document and pair: pair and times, and the named columns."""
    both = F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("pair_times").alias("times")))
    return rows.select(*columns, both.alias("both")).select(*columns, "both.*")


def link_counts(
    documents: DataFrame, first: str, pattern: str, second: str, shown: Callable[[Column], Column] = lambda told: told
) -> DataFrame:
    """Per document n_a, n_b, n_groups, n_links, n_best, count_sum and ``told``, its groups.

    ``shown`` is what is written of ``told``, as a digest of it. A pair of ids counts as often as links of the corpus hold it. ``count_sum`` adds this up over a
    document's links; ``n_best`` are links whose count is the highest of all pairs of their B id.
    """
    spark = documents.sparkSession
    own = aligner(first, pattern, second)
    n_a, n_b, same = own.n_a, own.n_b, own.same
    found = aligned(documents, first, pattern, second)
    rows = kept(found.withColumn("told", shown(F.col("told"))), "align-links")
    exact = _exact_counts(rows, n_a)
    each = rows.filter("number IS NOT NULL")

    counted = kept(_pairs(each).groupBy("pair").agg(F.sum("times").alias("n")), "align-pairs")
    # A row per B id at most; ids that no link ends with have none.
    best = np.zeros(n_b, np.int64)
    np.maximum.at(best, same[same >= 0], exact[same >= 0])
    for row in counted.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("n")).toLocalIterator():
        best[row["b"]] = max(best[row["b"]], row["n"])
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = F.col("n") * SHARE >= total
    often = counted.filter(frequent).toArrow()  # at most SHARE of them
    order = np.argsort(often.column("pair").to_numpy())
    keys, times = often.column("pair").to_numpy()[order], often.column("n").to_numpy()[order]
    is_best = (exact == best[np.maximum(same, 0)]) & (same >= 0)

    def price(batches):
        for batch in batches:
            n = batch.num_rows
            ids, of_ids, row = _exploded(batch, "exact", "exact_times")
            total, good = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(total, row, exact[ids] * of_ids)
            np.add.at(good, row, np.where(is_best[ids], of_ids, 0))
            pairs, of_pairs, row = _exploded(batch, "pairs", "pair_times")
            at = np.searchsorted(keys, pairs)
            hit = np.zeros(len(pairs), bool) if not len(keys) else keys[np.minimum(at, len(keys) - 1)] == pairs
            known = times[at[hit]]
            np.add.at(total, row[hit], known * of_pairs[hit])
            np.add.at(good, row[hit], np.where(known == best[pairs[hit] % n_b], of_pairs[hit], 0))
            left = np.bincount(row[~hit], minlength=n)
            columns = [batch.column(c) for c in passed]
            columns += [pa.array(good), pa.array(total), lists(pairs[~hit], left, pa.int64())]
            columns += [lists(of_pairs[~hit], left, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed, "good", "total", "pairs", "pair_times"])

    passed = ["doc_id", "number", "n_a", "n_b", "n_groups", "n_links", "told"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in each.select(*passed).schema)
    priced = each.select(*passed, "exact", "exact_times", "pairs", "pair_times").mapInArrow(
        price, f"{schema}, good bigint, total bigint, pairs array<bigint>, pair_times array<int>"
    )
    highest = F.broadcast(  # a row per B id
        spark.createDataFrame([(i, int(n)) for i, n in enumerate(best)], "b bigint, highest bigint")
    )
    rare = counted.filter(~frequent).join(highest, F.col("pair") % n_b == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("is_best")
    )
    others = _pairs(priced, "number").join(rare, "pair").groupBy("number").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_good"),
        F.sum(F.col("n") * F.col("times")).alias("more"),
    )
    return priced.drop("pairs", "pair_times").join(others, "number", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("good") + F.coalesce("more_good", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more", F.lit(0))).alias("count_sum"), "told",
    )


def _exploded(batch: pa.RecordBatch, values: str, times: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values of a list column, how often each stands there, and its row."""
    column = batch.column(values)
    row = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
    return column.flatten().to_numpy(), batch.column(times).flatten().to_numpy().astype(np.int64), row


def pair_counts(documents: DataFrame, first: str, pattern: str, second: str) -> DataFrame:
    """a, b, n: how many links hold each pair of ids, for users of the alignment itself."""
    own = aligner(first, pattern, second)
    rows = kept(aligned(documents, first, pattern, second), "align-links")
    n_b, same = own.n_b, own.same.tolist()
    others = _pairs(rows.filter("number IS NOT NULL")).groupBy("pair").agg(F.sum("times").alias("n")).select(
        F.expr(f"pair div {n_b}").alias("a"), (F.col("pair") % n_b).alias("b"), "n"
    )
    exact = _exact_counts(rows, own.n_a)
    equal = documents.sparkSession.createDataFrame(
        [(int(a), same[a], int(exact[a])) for a in np.flatnonzero(exact)], "a bigint, b bigint, n bigint"
    )
    return equal.unionByName(others)
