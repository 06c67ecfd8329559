"""Byte-level BPE, token alignment and the source audit against libraries, brute force and DuckDB."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailtrail.llm import bpe_transducer, level_audit, packing, queries, token_alignment
from mailtrail.llm.oracles import ORACLES

SMALL = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
DOCS = "doc_id bigint, text string, lang string, source string, ids string, told string, n bigint"


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe_transducer.rank_file(RANKS), special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    return bpe_transducer.Codec(bpe_transducer.rank_file(RANKS), PATTERN)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    rng = random.Random(8)
    prose = " ".join(rng.choice(["über", "the", "alpha", "I'll", "日本語", "x1y2", "…", "😀"]) for _ in range(400))
    texts = [None, "", " ", "\n \n", prose, prose, prose * 20, "a" * 30000, " " * 40000, "▁ x", "\x00a\x00", "<|endoftext|> <s>",
             "<0x41> <unk>", "A b a B", "é" * 50, "a  b   c", "tab\tend "]
    rows = [(i, t, "en" if i % 3 else None, "s" + str(i % 2), "x", "y", 1) for i, t in enumerate(texts)]
    rows += [rows[4], (None, "no id", None, None, None, None, None), (None, None, None, None, None, None, None)]
    rows += [(100 + i, "common words here", "en", "s0", None, None, None) for i in range(12)]
    rows += [(200 + i, f"common word{i}", "de", "t", None, None, None) for i in range(5)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# Byte-level BPE


def test_transducer_equals_the_library(codec, library):
    rng = random.Random(1)
    letters = "abeinrst' hT1.\n -=ü日́\U0001f600"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_any_bytes_in_any_chunks(codec, library):
    rng = random.Random(2)
    for _ in range(1000):
        data = bytes(rng.choice(b"aabc \n-=etionr\xc3\xa9\xff") for _ in range(rng.randint(1, 50)))
        cut = rng.randint(0, len(data))
        given = [i for ids in codec.transducer.stream((data[:cut], data[cut:])) for i in ids]
        assert given == library._encode_single_piece(data) == list(codec.transducer.piece(data))


def test_ids_come_out_before_the_piece_ends(codec):
    ids = list(codec.transducer.stream(b"tion" for _ in range(2000)))
    late = 0
    for given, seen in zip(np.cumsum([len(x) for x in ids]), range(1, 2001)):
        late = max(late, seen - given)
    assert late < 40  # chunks of one token: the lookahead does not grow with the piece


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_transducer, "PIECES", 5)
    small = bpe_transducer.Codec(bpe_transducer.rank_file(RANKS), PATTERN)
    small.transducer.most = 7
    text = open(bpe_transducer.__file__, encoding="utf-8").read()
    assert small.encode(text).tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("ranks", [
    {b"ab": 258, b"bc": 256, b"abc": 257, b"ca": 259},  # a token of smaller rank than its part
    {b"aa": 256, b"aaaa": 257, b"aaa": 258, b"ba": 259, b"aab": 260},
])
def test_odd_vocabularies(ranks):
    ranks = {bytes([i]): i for i in range(256)} | ranks
    own = bpe_transducer.Transducer(ranks)
    rng = random.Random(3)
    for _ in range(500):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        whole = ranks.get(data)
        assert list(own.piece(data)) == ([whole] if whole is not None else own.merged(data))


def test_parts_end_where_pieces_end(codec, library):
    text = "one  two 'tis\n\n three 4 5 !! \t six" * 30
    parts = list(bpe_transducer.parts_of(text, 10))
    assert len(parts) > 20 and "".join(parts) == text
    assert [i for p in parts for i in codec.encode(p)] == library.encode_ordinary(text)


def test_long_runs(codec):
    """A million blanks take one step each; the library's pattern fails on them."""
    for text in (" " * 1_500_000, "\n" * 1_500_000, "a" * 1_500_000, " x" * 700_000):
        ids = codec.encode(text)
        stream = codec.decoder()
        decoded = b"".join(stream.feed(ids[at : at + 999]) for at in range(0, len(ids), 999)) + stream.finish()
        assert decoded == text.encode() and not stream.broken


def test_decoder_gives_whole_characters(codec):
    text = "aé日😀" * 50
    ids = np.array([codec.transducer.ranks[bytes([b])] for b in text.encode()], np.int32)
    stream, got = codec.decoder(), []
    for at in range(0, len(ids), 3):
        got.append(stream.feed(ids[at : at + 3]).decode())  # raises inside a character
    assert "".join(got) + stream.finish().decode() == text and not stream.broken


@pytest.mark.parametrize("data", [b"\xff", b"a\xc3", b"\xe2\x82a", b"\xf0\x9f\x98", b"\xed\xa0\x80", b"\xc0\xaf", b"\xe2\x82\xe2\x82\xac"])
def test_decoder_counts_broken_characters(codec, data):
    ids = np.array([codec.transducer.ranks[bytes([b])] for b in data], np.int32)
    stream = codec.decoder()
    assert stream.feed(ids) + stream.finish() == data
    assert stream.broken > 0


def test_op12_equals_the_library(spark, library):
    got = {r["doc_id"]: r for r in queries.op12_byte_bpe(spark, SMALL).collect()}
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(texts)
    for row in texts:
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        found = got[row["doc_id"]]
        assert (found["n_tokens"], found["ids_sha256"], found["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(text))


def test_op12_odd_rows(odd, nothing, library):
    files = (RANKS, PATTERN)
    decoded = bpe_transducer.decode(bpe_transducer.encode(odd, *files), *files).collect()
    wanted = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    got = [(r["doc_id"], bytes(r["decoded"]).decode()) for r in decoded]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    for row in decoded:
        text = bytes(row["decoded"]).decode()
        assert row["n_broken"] == 0 and row["ids"] == library.encode_ordinary(text)
    assert bpe_transducer.digests(bpe_transducer.decode(bpe_transducer.encode(nothing, *files), *files)).collect() == []


@pytest.mark.parametrize("text", [
    " " * 1_200_000 + "x", "\n" * 1_000_000, "a" * 1_000_000,
    " a" * 80_000 + "<|endoftext|>  b<|endoftext|><|endoftext|>" + "q" * 120_000 + " <|endoftext|>",
])
def test_packing_takes_long_texts(text):
    """Texts that the packing operator gives to the transducer have the ids of the contract's tokenizer."""
    wanted = Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids
    got = packing.token_ids(text, *queries.tokenizer_files(), queries.added_tokens())
    assert got.tolist() == wanted


def test_packing_of_five_million_blanks(spark):
    rows = [(1, " " * 5_000_000), (2, "\n" * 5_000_000), (3, "b" * 5_000_000)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), *queries.tokenizer_files())
    totals = {r["doc_id"]: (r["n"], r["t"]) for r in pieces.groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()}
    assert all(n == t for n, t in totals.values()) and totals[1][0] == 5_000_001


# Alignment


def brute_alignment(rows):
    first = Tokenizer.from_file(JSON)
    first.encode_special_tokens = True
    own = token_alignment.aligner(JSON, PATTERN, PIECES)
    counts, found = Counter(), []
    for doc_id, text in rows:
        a, b, groups = [], [], []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = own.b.model.encode(text)
            whole = (" " + text).encode()
            joined = [b"".join(side[i] for i in ids) for side, ids in ((own.a.bytes_of, a), (own.b.bytes_of, b))]
            if joined != [whole, whole]:
                a, b = [], []
        i = j = end_a = end_b = 0
        here = ([], [])
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                here[0].append(a[i])
                end_a += len(own.a.bytes_of[a[i]])
                i += 1
            else:
                here[1].append(b[j])
                end_b += len(own.b.bytes_of[b[j]])
                j += 1
            if end_a == end_b:
                groups.append(here)
                here = ([], [])
        links = [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((doc_id, len(a), len(b), links, told))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (d, na, nb, len(ls), len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), told)
        for d, na, nb, ls, told in found
    ], counts


@pytest.mark.parametrize("share", [1 << 16, 40, 1])
def test_alignment_equals_brute_force(spark, odd, monkeypatch, share):
    """With every bound of what goes to all tasks: pairs beyond it are joined."""
    monkeypatch.setattr(token_alignment, "SHARE", share)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    wanted, _ = brute_alignment([tuple(r) for r in documents.collect()])
    got = [tuple(r) for r in token_alignment.link_counts(documents, JSON, PATTERN, PIECES).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_op11_digest(spark):
    wanted, _ = brute_alignment([tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()])
    frame = queries.op11_token_alignment(spark, SMALL)
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in frame.collect()) == sorted((*w[:7], sha(w[7]) if w[7] else "") for w in wanted)


def test_pair_counts(odd):
    _, counts = brute_alignment([(r["doc_id"], r["text"]) for r in odd.collect()])
    got = token_alignment.pair_counts(odd, JSON, PATTERN, PIECES).collect()
    assert {(r["a"], r["b"]): r["n"] for r in got} == dict(counts)


def test_alignment_of_nothing(nothing):
    assert token_alignment.link_counts(nothing, JSON, PATTERN, PIECES).collect() == []


def test_identity_is_of_equal_bytes():
    own = token_alignment.aligner(JSON, PATTERN, PIECES)
    for a, b in enumerate(own.same.tolist()):
        assert b < 0 or own.a.bytes_of[a] == own.b.bytes_of[b]
    codes = bpe_transducer.rank_file(RANKS)
    assert own.a.codec.transducer.ranks == codes  # the two files hold one vocabulary


@pytest.mark.parametrize("most", [1, 7, 100])
def test_parts_of_long_texts_are_encoded_alike(spark, monkeypatch, most):
    own = token_alignment.aligner(JSON, PATTERN, PIECES)
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["One two  three\n four, five ▁ six é seven " * 50, "  ", " a", "a ", "   a   b", "日本 語", "\u2581", " " * 500 + "x",
              "tab\tend ", "\n \n"]
    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)
    monkeypatch.setattr(token_alignment, "PART_CHARS", most)
    ids, counts = own.b.encode(texts)
    assert own.b.apart and [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == whole


# Source audit


def audited(spark, frame, folder):
    frame.select("doc_id", "text", "lang", "source").write.parquet(folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/*.parquet'")
    wanted = con.sql(ORACLES["op13_level_audit"]).fetchall()
    got = [tuple(r) for r in level_audit.audit(spark.read.parquet(folder)).collect()]
    return sorted(got), sorted(wanted)


def test_audit_odd_rows(spark, odd, tmp_path):
    more = spark.createDataFrame([(i, "Common words", "en", "s1") for i in range(9)], DOCS.split(", ids")[0])
    got, wanted = audited(spark, odd.select(more.columns).union(more), f"{tmp_path}/odd")
    assert got == wanted and any(r[2] == "term" for r in got)
    # A language whose terms are in too few documents has pairs of nothing.
    assert {r[4] for r in got if r[0] == ""} == {0}


def test_audit_of_nothing(spark, nothing):
    assert level_audit.audit(nothing).collect() == []


def test_audit_held_counts_and_pieces(spark, tmp_path, monkeypatch):
    """Any size of blocks and of what a task holds gives the same rows."""
    for name, value in (("COLUMNS", 7), ("ROWS", 3), ("HELD", 50), ("SALTS", 3)):
        monkeypatch.setattr(level_audit, name, value)
    got, wanted = audited(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), f"{tmp_path}/all")
    assert got == wanted


def test_joint_tables(spark, odd):
    terms = level_audit.term_counts(odd, 1)
    levels = level_audit.term_levels(terms, level_audit.group_totals(odd, terms))
    wanted = Counter()
    for row in levels.collect():
        for i, p in enumerate(row["levels"]):
            for j, q in enumerate(row["levels"][i + 1 :], i + 1):
                wanted[row["lang"], i, j, p, q] += 1
    got = level_audit.joint_tables(levels).collect()
    assert {tuple(r)[:5]: r["n"] for r in got} == dict(wanted)


def test_shares_are_exact(spark):
    rows = [(10**14, 3 * 10**15, 10**7), (0, 0, 1), (7, 13, 2), (10**17, 10**17, 10**10)]
    frame = spark.createDataFrame(rows, "c bigint, n bigint, v bigint")
    got = [r[0] for r in frame.select(level_audit.share(frame["c"], frame["n"], frame["v"])).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]
