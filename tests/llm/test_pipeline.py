"""The whole pipeline against a plain version of its stages, one document after another."""

import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def leaders(rows):
    """The smallest id of each connected class of texts whose 5-gram sets are similar by 0.8 or more."""
    sets = {}
    for doc_id, text in rows:
        w = words(text)
        sets[doc_id] = frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(d, text) for d, text in rows if find(d) == d]


def without_repeats(rows):
    """Bytes of 50-byte strings that a smaller id has too, in whole characters."""
    first, out = {}, []
    for d, text in rows:
        b = text.encode()
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    for d, text in rows:
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = True
        at, left = 0, []
        for character in text:
            n = len(character.encode())
            if not gone[at : at + n].all():
                left.append(character)
            at += n
        out.append((d, "".join(left)))
    return out


def clean(rows, items):
    """Documents without ten words in a row of an item, or all words of a shorter one."""
    windows = set()
    for text in items:
        w = words(text)
        windows.update(tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w)
    sizes = {len(w) for w in windows}
    return [
        (d, text) for d, text in rows
        if not any(tuple(w[i : i + n]) in windows for w in [words(text)] for n in sizes for i in range(len(w) - n + 1))
    ]


def test_pipeline_equals_plain_stages(spark):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    lettered = [(d, t) for d, t in sorted(table.items()) if any(c.isalpha() for c in t or "")]
    kept = clean(without_repeats(leaders(lettered)), items)
    assert 0 < len(kept) < len(lettered) <= len(table)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for d, t in kept}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append(r)
    assert found.keys() == ids.keys()
    for d, pieces in found.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(ids[d][r["start"] : r["start"] + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[d]), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids[d])
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, ids.values()))
    assert len(sequences) <= total / 1024 * 1.02 + 2
