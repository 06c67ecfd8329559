"""Byte-level BPE as a lazily determinised finite-state transducer, and its streaming decoder.

A BPE result is a chain of tokens in which no merge ever crosses a border, and whether one
does depends on the two tokens at the border alone. So each prefix of a piece of text has
exactly one chain that ends with it. The nondeterministic transducer follows all chains whose
next token the text may still complete: a thread is the last token of such a chain and the
trie node of the bytes read since. A state of the deterministic one is the set of threads; it
is made when first met, as is each of its edges. An edge tells which token ends with its byte,
on the chain of that prefix. Where the chains of all threads meet, the tokens before are
certain and are emitted: the lookahead is bounded by what the vocabulary can still complete.

Caches are emptied when they are full: memory is bounded, results do not depend on them. A
piece of any length (a run of a million blanks) takes one step per byte and no stack.

Decoding puts token bytes through an incremental UTF-8 state machine that gives out whole
characters only; a token that neither begins nor ends inside a character passes unlooked at.

Null and empty texts have no ids and decode to nothing. Strings of special tokens are ordinary
text. Repeated and null ids of documents are rows like any other; extra columns stay out.
Bytes that are no UTF-8 count as U+FFFD. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lists, pieces

#: States, and twice as many pieces, that are kept; full caches take some 200 MB of a worker.
STATES = 200_000
PIECES = 300_000
#: Longer pieces are not kept.
PIECE_CHARS = 48
#: A longer text is split before blanks between two words, where pieces always end.
PART_CHARS = 1 << 20
#: A border of pieces for every pattern in which a blank can only begin a piece of other characters.
_BORDER = regex.compile(r"(?<=\S) (?=\S)")
#: Bytes of a long piece between two looks for tokens that are certain.
CHUNK = 4096
#: An edge is a state and a token in one number; the greatest token stands for none.
_BITS = 24
_MASK = _START = (1 << _BITS) - 1


def rank_file(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file of base64 tokens."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Token ids of byte strings: merges of the least rank first, the leftmost of equal ones."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks = ranks
        if min(ranks.values()) < 0 or max(ranks.values()) >= _START:
            raise ValueError("ranks must be from 0 to 2**24 - 2")
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        #: The trie of all tokens: next nodes by byte, and the token that ends in a node.
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[int | None] = [None]
        self.depth = [0]
        for token, rank in ranks.items():
            self.ends[self._node(token)] = rank
        self.most = states
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[tuple[int, int], list[int]] = {}
        self._growing: dict[int, bool] = {}
        self.follow: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        """Drop all states but the first, which is number 0."""
        self.keys: list[tuple[int, ...]] = []  # by state: last token and trie node of each thread
        self.numbers: dict[tuple[int, ...], int] = {}
        self.edges: dict[int, int] = {}  # state and byte to next state and ended token
        self._state((_START, 0))

    def _node(self, token: bytes) -> int:
        node = 0
        for byte in token:
            if byte not in self.next[node]:
                self.next[node][byte] = len(self.next)
                self.next.append({})
                self.ends.append(None)
                self.depth.append(self.depth[node] + 1)
            node = self.next[node][byte]
        return node

    # Merges

    def merged(self, data: bytes) -> list[int]:
        """The merges played out, for short strings; ids of the last parts."""
        return [self.ranks[p] for p in self._merge(data, 1)]

    def _merge(self, data: bytes, least: int) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            found = [
                (rank, i) for i in range(len(parts) - 1)
                if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None
            ]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two parts whose merge is the token; None for a byte and for what merges do not make."""
        if token not in self._splits:
            data = self.tokens[token]
            parts = self._merge(data, 2) if len(data) > 1 else []
            made = len(parts) == 2 and (self.ranks[parts[0]], self.ranks[parts[1]])
            self._splits[token] = made or None
        return self._splits[token]

    def _is_made(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self._split(token) is not None

    def _grows(self, token: int) -> bool:
        """Whether every part of the token has a smaller rank than what it is merged into."""
        known = self._growing.get(token)
        if known is None:
            known = True
            for part in self._split(token) or ():
                known = known and (len(self.tokens[part]) == 1 or part < token) and self._grows(part)
            self._growing[token] = known
        return known

    def _edge_parts(self, token: int, side: int) -> list[int]:
        """The parts at one end of a token, from its byte up to itself."""
        known = self._edges.get((token, side))
        if known is None:
            split = self._split(token)
            known = [*(self._edge_parts(split[side], side) if split else ()), token]
            self._edges[token, side] = known
        return known

    def _may_follow(self, first: int, second: int) -> bool:
        """Whether no merge crosses the border of the two tokens."""
        if not self._is_made(second):
            return False
        if first == _START:
            return True
        if not (self._grows(first) and self._grows(second)):
            return self.merged(self.tokens[first] + self.tokens[second]) == [first, second]
        left, right = self._edge_parts(first, 1), self._edge_parts(second, 0)
        i = j = 0
        while True:
            own = left[i + 1] if i + 1 < len(left) else None
            other = right[j + 1] if j + 1 < len(right) else None
            across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]])
            if across is not None and (own is None or across < own) and (other is None or across <= other):
                return False
            if own is None and other is None:
                return True
            if other is None or (own is not None and own <= other):
                i += 1
            else:
                j += 1

    def may_follow(self, first: int, second: int) -> bool:
        key = first << _BITS | second
        known = self.follow.get(key)
        if known is None:
            if len(self.follow) >= 2 * self.most:
                self.follow.clear()
            known = self.follow[key] = self._may_follow(first, second)
        return known

    # States

    def _state(self, key: tuple[int, ...]) -> int:
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.keys)
            self.keys.append(key)
        return number

    def _edge(self, state: int, byte: int) -> int:
        """The next state, and the token that ends with this byte."""
        key, after, ended = self.keys[state], [], _START
        for last, node in zip(key[::2], key[1::2]):
            node = self.next[node].get(byte)
            if node is None:
                continue
            if ended == _START and (token := self.ends[node]) is not None and self.may_follow(last, token):
                ended = token
            if self.next[node]:
                after += (last, node)
        edge = self._state((*after, ended, 0)) << _BITS | ended
        self.edges[state << 8 | byte] = edge
        return edge

    def _run(self, state: int, data: bytes, ended: list[int]) -> int:
        """The state after these bytes; the token that ends with each goes to ``ended``."""
        edges = self.edges
        for byte in data:
            edge = edges.get(state << 8 | byte)
            if edge is None:
                if len(self.keys) > self.most:
                    kept = self.keys[state]
                    self._forget()
                    state, edges = self._state(kept), self.edges
                edge = self._edge(state, byte)
            state = edge >> _BITS
            ended.append(edge & _MASK)
        return state

    def _chain(self, ended: list[int], at: int) -> list[int]:
        """The tokens up to a border, back from the one that ends there."""
        chain = []
        while at:
            chain.append(ended[at - 1])
            at -= self.length[chain[-1]]
        return chain[::-1]

    def stream(self, chunks: Iterable[bytes]) -> Iterator[list[int]]:
        """Ids of one piece that comes in chunks; after each chunk those that are certain."""
        kept, ended = self.keys[0], []
        for chunk in chunks:
            # Another piece may have emptied the cache meanwhile: its threads make a state again.
            kept = self.keys[self._run(self._state(kept), chunk, ended)]
            # Back from where each thread began, the last first, until all have met.
            open_ends = {len(ended) - self.depth[node] for node in kept[1::2]}
            while len(open_ends) > 1:
                last = max(open_ends)
                open_ends.remove(last)
                open_ends.add(last - self.length[ended[last - 1]])
            met = open_ends.pop()
            yield self._chain(ended, met)
            del ended[:met]
        yield self._chain(ended, len(ended))

    def piece(self, data: bytes) -> tuple[int, ...]:
        """Ids of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        if len(data) > CHUNK:
            chunks = (data[at : at + CHUNK] for at in range(0, len(data), CHUNK))
            return tuple(i for ids in self.stream(chunks) for i in ids)
        self._run(0, data, ended := [])
        return tuple(self._chain(ended, len(data)))


class Memo:
    """Values met lately, and those met before these: what is met again stays, memory is bounded."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> bytes:
        if len(self.new) >= self.most:
            self.new, self.old = {}, self.new
        self.new[key] = value
        return value


class Codec:
    """Texts to ids and back: pieces by a pattern, each through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.transducer = Transducer(ranks)
        self.known = Memo(PIECES)
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of = [b""] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        #: Tokens of whole characters.
        self.whole = np.array([advance(0, token) == (0, 0) for token in self.bytes_of], bool)

    def _piece(self, piece: str) -> bytes:
        ids = array("i", self.transducer.piece(piece.encode())).tobytes()
        return self.known.put(piece, ids) if len(piece) <= PIECE_CHARS else ids

    def encode(self, text: str) -> np.ndarray:
        known, found = self.known, []
        for part in parts_of(text):
            found += [
                known.new.get(piece) or known.get(piece) or self._piece(piece) for piece in self.pattern.findall(part)
            ]
        return np.frombuffer(b"".join(found), np.int32)

    def decoder(self) -> Decoder:
        return Decoder(self)


def parts_of(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """The text in parts that end where no piece crosses; without such places it stays whole."""
    at = 0
    while len(text) - at > most and (border := _BORDER.search(text, at + most)):
        yield text[at : border.start()]
        at = border.start()
    yield text[at:] if at else text


# UTF-8. The well-formed byte sequences of the Unicode Standard, table 3-7, as
# (first byte from, to, range of the second byte, number of the bytes that follow it).
_SEQUENCES = [
    (0xC2, 0xDF, 0x80, 0xBF, 0),
    (0xE0, 0xE0, 0xA0, 0xBF, 1),
    (0xE1, 0xEC, 0x80, 0xBF, 1),
    (0xED, 0xED, 0x80, 0x9F, 1),
    (0xEE, 0xEF, 0x80, 0xBF, 1),
    (0xF0, 0xF0, 0x90, 0xBF, 2),
    (0xF1, 0xF3, 0x80, 0xBF, 2),
    (0xF4, 0xF4, 0x80, 0x8F, 2),
]


def _utf8_machine() -> list[dict[int, int]]:
    """Next states by byte. State 0: between characters; 1, 2: so many plain bytes to come; others: a second byte."""
    tails = range(0x80, 0xC0)
    table = [dict.fromkeys(range(0x80), 0), dict.fromkeys(tails, 0), dict.fromkeys(tails, 1)]
    for first, last, low, high, more in _SEQUENCES:
        table.append(dict.fromkeys(range(low, high + 1), more))
        table[0].update(dict.fromkeys(range(first, last + 1), len(table) - 1))
    return table


_MACHINE = _utf8_machine()


def advance(state: int, data: bytes) -> tuple[int, int]:
    """The state after these bytes, and the places where they broke a character."""
    broken = 0
    for byte in data:
        after = _MACHINE[state].get(byte)
        if after is None:
            broken += 1
            after = _MACHINE[0].get(byte, 0) if state else 0
        state = after
    return state, broken


class Decoder:
    """Bytes of ids that come in chunks: each answer ends with a character."""

    def __init__(self, codec: Codec):
        self.codec, self.state, self.broken, self.waiting = codec, 0, 0, b""

    def feed(self, ids: np.ndarray) -> bytes:
        """All bytes up to the last whole character."""
        bytes_of = self.codec.bytes_of
        data = self.waiting + b"".join([bytes_of[i] for i in ids.tolist()])
        last = -1
        for at in np.flatnonzero(~self.codec.whole[ids]).tolist():
            self._cross(at - last > 1)
            self.state, broken = advance(self.state, bytes_of[ids[at]])
            self.broken += broken
            last = at
        self._cross(len(ids) - 1 - last > 0)
        # The bytes of the open character: back to its first byte, three at most.
        n = len(data)
        if self.state:
            n -= 1
            while data[n] & 0xC0 == 0x80:
                n -= 1
        self.waiting = data[n:]
        return data[:n]

    def _cross(self, any_between: bool) -> None:
        """Tokens of whole characters: they break one that is still open."""
        if any_between and self.state:
            self.state, self.broken = 0, self.broken + 1

    def finish(self) -> bytes:
        """What is left of a character that never ended."""
        rest, self.waiting = self.waiting, b""
        self.broken += bool(self.state)
        self.state = 0
        return rest


@lru_cache(maxsize=2)
def codec(vocabulary: str, pattern: str) -> Codec:
    """The codec of a rank file, one per worker."""
    return Codec(rank_file(vocabulary), pattern)


def plain_text(column: pa.Array) -> Iterator[str]:
    """Texts; null is empty, bytes that are no UTF-8 are U+FFFD."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield (value.as_py() or b"").decode("utf-8", "replace")


def _encoded(own: Codec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, _, _ in pieces(batches, "text"):
        found = [own.encode(text) for text in plain_text(rows.column("text"))]
        ids = lists(np.concatenate(found), np.array([len(x) for x in found]), pa.int32())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids], names=["doc_id", "ids"])


#: Ids decoded at once.
FEED = 1 << 16


def _decoded(own: Codec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, broken = [], []
        for row in batch.column("ids"):
            ids = row.values.to_numpy() if row.is_valid else np.zeros(0, np.int32)
            stream = own.decoder()
            got = [stream.feed(ids[at : at + FEED]) for at in range(0, len(ids), FEED)]
            found.append(b"".join([*got, stream.finish()]))
            broken.append(stream.broken)
        told = [pa.array(found, pa.binary()), pa.array(broken, pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ids"), *told], names=["doc_id", "ids", "decoded", "n_broken"]
        )


def _mapped(frame: DataFrame, column: str, steps: list, columns: str, files: tuple[str, str]) -> DataFrame:
    """One pass of tasks with the codec, and one set of its caches, for all steps."""
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for step in steps:
            batches = step(codec(*files), batches)
        return batches

    return frame.select("doc_id", column).mapInArrow(run, f"doc_id {kind}, ids array<int>{columns}")


def encode(documents: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text.

    ``vocabulary`` is a file of ranks on every executor, ``pattern`` splits text into pieces.
    """
    return _mapped(documents, "text", [_encoded], "", (vocabulary, pattern))


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded`` (binary) and ``n_broken``, its breaches of UTF-8."""
    return _mapped(encoded, "ids", [_decoded], ", decoded binary, n_broken bigint", (vocabulary, pattern))


def round_trip(documents: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``decode`` of ``encode`` in one pass."""
    return _mapped(documents, "text", [_encoded, _decoded], ", decoded binary, n_broken bigint", (vocabulary, pattern))


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by blanks) and decoded_sha256."""
    told = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(told, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
