"""The operators against DuckDB, brute force, round trips and held-out labels, and on odd rows."""

import hashlib
import html
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mailtrail.llm import (
    html_consensus, jaccard_forest, language_crf, packing, projection_search, quality_weak, queries, suffix_dedup,
    toxicity_fm, warc_seekable, winnowing,
)
from mailtrail.llm.oracles import ORACLES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, rest int, score double"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ordered(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    rng = random.Random(4)
    base = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Éta", "zeta"]) + str(rng.randint(0, 50)) for _ in range(300))
    texts = [None, "", "   ", "!!! ...", "one", "one two three", base, base, base + " tail", base[:400], "x" * 70000,
             "ab " * 9000, "\x00é" * 60, base.upper(), "12 34", "<|endoftext|> hi", base[200:900]]
    rows = [(i, t, "en" if i % 2 else "de", "s", 0, "r", 1, 0.5) for i, t in enumerate(texts)]
    rows += [rows[6], (6, "one", None, None, None, None, None, None), (None, base, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    wanted = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert ordered(tuple(r) for r in frame.select(*columns).collect()) == ordered(wanted)


# --- 1 -----------------------------------------------------------------------------------

def check_packs(rows, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    ids = {}
    for doc_id, text in texts:
        ids.setdefault(doc_id, []).append(np.array([*bpe.encode(text or "", add_special_tokens=False).ids, 0], "<u4"))
    filled = {}
    for r in rows:
        assert any(
            len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32
            for x in ids[r.doc_id]
        )
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in filled.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r.length for r in rows) == sum(len(x) for own in ids.values() for x in own)
    return len(filled)


def test_packing(spark, odd, nothing):
    rows = queries.op1_packing(spark, SMALL).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    n = check_packs(rows, texts)
    assert sum(r.length for r in rows) > 0.9 * 1024 * n
    files = queries.tokenizer_files()
    pieces = packing.pack(odd, *files, keep_ids=True)
    check_packs(pieces.collect(), [(r.doc_id, r.text) for r in odd.collect()])
    whole = packing.sequences(pieces).select(F.sum(F.size("ids"))).first()[0]
    assert whole == pieces.agg(F.sum("length")).first()[0]
    assert packing.pack(nothing, *files).count() == 0


def test_packing_matches_added_tokens(spark, monkeypatch):
    """The ids of the contract's own call, where texts hold the added token, whole or in part."""
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"{end} hi", f"a  {end}  b", end * 3, f"word{end}word", end[:-1], f"{end[:5]}{end}", "plain", f" {end}\n" * 700]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(queries, "table", lambda *_: frame)
    wanted = {}
    for k, text in enumerate(texts):
        ids = np.array([*bpe.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), 1024):
            wanted[k, start] = (len(ids), zlib.crc32(ids[start : start + 1024].tobytes()))
    for rows in (queries.op1_packing(spark, ""), corpus_pipeline.packs(spark, frame, "")):
        assert {(r.doc_id, r.start): (r.doc_tokens, r.ids_crc32) for r in rows.collect()} == wanted


def test_patterns_use_every_length():
    rng = random.Random(1)
    for top in (1024, 60, 3):
        counts = {rng.randint(1, top): rng.randint(1, 300) for _ in range(200)}
        used = {}
        for n, lengths in packing.shortest_pack_first(counts, 1024):
            assert n > 0 and sum(lengths) <= 1024
            for x in lengths:
                used[x] = used.get(x, 0) + n
        assert used == counts


# --- 2 -----------------------------------------------------------------------------------

def brute_classes(rows):
    sets = []
    for doc_id, text in rows:
        w = words(text)
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4))))
    last = float("inf")
    key = [last if d is None else d for d, _ in rows]
    root = list(range(len(rows)))
    links, copies = [0] * len(rows), list(key)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
                if a == b:
                    copies[i] = copies[j] = min(copies[i], copies[j])
    classes = [min(key[j] for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))]
    none = lambda x: None if x == last else x
    return [(d, none(c), n, none(k)) for (d, _), c, n, k in zip(rows, classes, links, copies)]


def test_jaccard_join(spark, odd, nothing):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 999)}" for _ in range(120)]
    near = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(120)] = f"n{rng.randint(0, 999)}"
        near.append((1000 + i, " ".join(w)))
    frame = odd.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id bigint, text string"))
    found = jaccard_forest.near_duplicates(frame)
    got = [(r.doc_id, r.class_id, r.n_links, r.copy_of) for r in found.collect()]
    assert ordered(got) == ordered(brute_classes([tuple(r) for r in frame.collect()]))
    leads = jaccard_forest.one_per_class(odd)
    assert leads.columns == odd.columns
    assert leads.filter("doc_id = 6").count() == 1 and leads.filter("doc_id = 7").count() == 0
    assert jaccard_forest.near_duplicates(nothing).count() == 0


def test_blocks_and_recall(spark, monkeypatch):
    rows = [(i, " ".join(f"w{k}" for k in range(200) if k != 7 * i)) for i in range(40)]
    whole = jaccard_forest.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    wanted = ordered((r.doc_id, r.class_id, r.n_links) for r in whole.collect())
    assert wanted == ordered((d, c, n) for d, c, n, _ in brute_classes(rows))
    monkeypatch.setattr(jaccard_forest, "BLOCK", 6)
    dealt = jaccard_forest.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert ordered((r.doc_id, r.class_id, r.n_links) for r in dealt.collect()) == wanted
    assert jaccard_forest.recall_of({}, 6) < jaccard_forest.RECALL < jaccard_forest.recall_of({}, 4)


def test_close_copies_do_not_end_the_search_for_others(spark):
    """Eight equal labels, and a pair that agrees in 100 of 120 values and shares four at most from the front."""
    trees, depth = jaccard_forest.TREES, jaccard_forest.DEPTH
    rng = np.random.default_rng(1)
    hot, one = rng.integers(0, 1 << 32, (2, trees, depth), dtype=np.uint32)
    other = one.copy()
    other[:, 0] ^= 1
    other[0] = one[0]
    other[0, 4] ^= 1
    rows = [(k, bytearray(hot.tobytes())) for k in range(8)]
    rows += [(100, bytearray(one.tobytes())), (101, bytearray(other.tobytes()))]
    links = jaccard_forest.possible_links(spark.createDataFrame(rows, "member bigint, label binary"))
    assert (101, 100) in {(r.a, r.b) for r in links.collect()}
    assert jaccard_forest.recall_of({114: 400_000}, 6) < jaccard_forest.RECALL


# --- 3 -----------------------------------------------------------------------------------

def test_decontamination(spark, odd, nothing):
    w = words(odd.filter("doc_id = 6 and n_chars = 0").first().text)
    items = [(1, " ".join(w[5:30])), (2, "Zeta0 nowhere at all"), (3, "one two"), (4, None), (5, ""), (None, "34"),
             (10, " ".join(w[5:15])), (3, "ab ab ab ab ab ab ab ab ab ab ab ab")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = winnowing.decontamination_report(odd, bench).select("doc_id", "n_words", "n_hit", "n_items", "items").collect()
    wanted = []
    for r in odd.collect():
        own, hit, ids = words(r.text), set(), set()
        for item_id, text in items:
            x = words(text)
            size = min(10, len(x))
            for p in range(len(x) - size + 1) if x else []:
                for q in range(len(own) - size + 1):
                    if own[q : q + size] == x[p : p + size]:
                        hit.update(range(q, q + size))
                        ids.add(item_id)
        wanted.append((r.doc_id, len(own), len(hit), len(ids), sorted(str(i) for i in ids if i is not None)))
    assert ordered(tuple(r) for r in got) == ordered(wanted)
    clean = winnowing.clean_documents(odd, bench)
    assert clean.columns == odd.columns and clean.count() == sum(not x[2] for x in wanted)
    assert winnowing.clean_documents(odd, bench.limit(0)).count() == odd.count()
    assert winnowing.decontamination_report(nothing, bench).count() == 0


# --- 4, 8, 9 -------------------------------------------------------------------------------

def test_toxicity_pairs_and_odd_rows(spark, odd, nothing):
    """Two words that mean something only together; an additive model cannot tell."""
    rng = random.Random(7)
    filler = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(6000):
        a, b = rng.random() < 0.2, rng.random() < 0.2
        rows.append((i, " ".join(rng.sample(filler, 12) + ["insult"] * a + ["praise"] * b), int(a != b)))
    frame = spark.createDataFrame(rows, "key bigint, text string, label int")
    model = toxicity_fm.fit(frame.filter("key < 5000").select("key", "text"), frame.filter("key < 5000").select("key", "label"))
    scored = toxicity_fm.score(frame.filter("key >= 5000"), model, ["key", "label"]).collect()
    assert np.mean([(r.score >= 0.5) == r.label for r in scored]) > 0.95
    told = toxicity_fm.score(odd, model, odd.columns[:1]).collect()
    assert len(told) == odd.count() and all(0 <= r.score <= 1 for r in told)
    empty = toxicity_fm.fit(frame.select("key", "text").limit(0), frame.select("key", "label").limit(0))
    assert all(r.score < 1e-9 for r in toxicity_fm.score(odd, empty, ["doc_id"]).collect())
    assert toxicity_fm.score(nothing, model, ["doc_id"]).count() == 0


def test_toxicity_of_pairs_with_equal_single_rates(spark):
    """Both words are as common in toxic texts as in others; only both or neither is toxic. One key has many texts."""
    rng = random.Random(5)
    filler = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(6000):
        a = rng.random() < 0.5
        b = a if i % 2 else not a
        rows.append((i, " ".join(rng.sample(filler, 12) + ["insult"] * a + ["group"] * b), i % 2))
    frame = spark.createDataFrame(rows, "key bigint, text string, label int")
    learned = frame.filter("key < 5000")
    texts = learned.select("key", "text")
    repeated = texts.unionByName(texts.filter("key = 7").withColumn("text", F.explode(F.array_repeat("text", 50))))
    model = toxicity_fm.fit(repeated, learned.select("key", "label"))
    scored = toxicity_fm.score(frame.filter("key >= 5000"), model, ["key", "label"]).collect()
    assert np.mean([(r.score >= 0.5) == r.label for r in scored]) > 0.9


def test_toxicity_of_frequent_terms(spark):
    """One slur in most toxic texts: half the sample's rows are toxic, so over a quarter hold it."""
    rng = random.Random(11)
    filler = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(4000):
        toxic = i % 2
        slur = rng.random() < (0.9 if toxic else 0.02)
        rows.append((i, " ".join(["they", *rng.sample(filler, 12), *["slur"] * slur]), toxic))
    frame = spark.createDataFrame(rows, "key bigint, text string, label int")
    learned = frame.filter("key < 3000")
    model = toxicity_fm.fit(learned.select("key", "text"), learned.select("key", "label"))
    scored = toxicity_fm.score(frame.filter("key >= 3000"), model, ["key", "label"]).collect()
    assert np.mean([(r.score >= 0.5) == r.label for r in scored]) > 0.9


def test_language(spark, odd, nothing):
    got = queries.op8_language(spark, MEDIUM)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    held = got.filter("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    model = language_crf.fit(spark.read.parquet(f"{MEDIUM}/documents.parquet").select(F.col("doc_id").alias("key"), "text", "lang"))
    assert model.transitions.diagonal().min() > model.transitions[~np.eye(4, dtype=bool)].max()
    told = {(r.doc_id, r.text): r for r in language_crf.predict(odd, model, ["doc_id", "text"]).collect()}
    for text in (None, "", "   ", "!!! ...", "12 34"):
        assert all(r.lang_pred == "und" and r.score == 0 for (_, t), r in told.items() if t == text)
    assert told[(4, "one")].lang_pred in model.languages
    assert language_crf.fit(nothing.select(F.col("doc_id").alias("key"), "text", "lang")) is None
    assert {r.lang_pred for r in language_crf.predict(odd, None, ["doc_id"]).collect()} == {"und"}
    assert language_crf.predict(nothing, model, ["doc_id"]).count() == 0


def test_forward_backward_sums_over_paths():
    rng = np.random.default_rng(0)
    scores, step = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    inside = np.array([[True] * 4, [True, True, False, False]])
    both, joint = language_crf.posteriors(scores, step, inside, pairs=True)
    wanted, pairs = np.zeros((2, 4, 3)), np.zeros((3, 3))
    for s in range(2):
        n = int(inside[s].sum())
        paths = [tuple(p) for p in np.ndindex(*[3] * n)]
        weight = np.array([np.exp(sum(scores[s, t, p[t]] for t in range(n)) + sum(step[p[t], p[t + 1]] for t in range(n - 1))) for p in paths])
        for p, x in zip(paths, weight / weight.sum()):
            for t in range(n):
                wanted[s, t, p[t]] += x
            for t in range(n - 1):
                pairs[p[t], p[t + 1]] += x
    assert np.allclose(both, wanted) and np.allclose(joint, pairs)


def test_quality(spark, odd, nothing):
    got = queries.op9_quality(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got if r.quality is not None]) > 0.95
    scored, _ = quality_weak.score(odd)
    assert scored.count() == odd.count()
    scored, accuracies = quality_weak.score(nothing)
    assert scored.count() == 0 and accuracies is None


# --- 5 -----------------------------------------------------------------------------------

def brute_spans(rows):
    first = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - 49) if d is not None else []:
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49) if d is not None else []:
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1 << 17, 2])
def test_suffix_dedup(spark, odd, monkeypatch, hot):
    rng = random.Random(3)
    base = "".join(rng.choice("ab") for _ in range(400))
    rows = [(r.doc_id, r.text) for r in odd.filter("text is null or length(text) < 9000").collect()]
    for i in range(60):
        a = rng.randint(0, 300)
        rows.append((rng.choice([i, 7, None]), rng.choice([base[a : a + rng.randint(20, 200)], "xy" * rng.randint(5, 120),
                                                            "\x00é" * rng.randint(0, 30) + base[:55]])))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda docs: whole(docs, hot=hot))
    monkeypatch.setattr(queries, "table", lambda *_: frame)
    got = queries.op5_suffix_dedup(spark, "").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute_spans(rows))


def test_deep_shallow_order():
    rng = np.random.default_rng(0)
    strings = rng.integers(0, 2, (900, 34)).astype(np.uint8)
    strings[:, :14] = 0
    strings[300:500] = strings[:200]
    strings[::3, :30] = 255
    group = rng.integers(0, 20, 900)
    order, shared = suffix_dedup.deep_shallow(group, strings)
    key = [(group[i], bytes(strings[i])) for i in order]
    assert key == sorted(key)
    for (g, a), (h, b), n in zip(key, key[1:], shared[1:]):
        assert n == (len(os.path.commonprefix([a, b])) if g == h else -1)


def test_cut_texts_keep_whole_characters(spark, odd, nothing):
    rows = [(1, "é" * 40 + "a"), (2, "xé" + "é" * 40 + "b"), (None, "é" * 40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = {r.doc_id: r.text for r in suffix_dedup.without_repeats(frame).collect()}
    assert cut == {1: rows[0][1], 2: "xéb"[:1] + cut[2][1:], None: rows[2][1]} and len(cut[2]) < 5
    assert suffix_dedup.without_repeats(odd).columns == odd.columns
    assert suffix_dedup.without_repeats(odd).count() == odd.count()
    assert suffix_dedup.without_repeats(nothing).count() == 0


# --- 6, 7 ----------------------------------------------------------------------------------

PAGE = (
    '<html><body class="no-sidebar"><header><h1>Site</h1></header><div class="menu"><a href=x>Home</a></div>'
    '<div class="content{n}"><h1>Title &amp; more</h1><p>First  para<br>line two<p>Second <a href=y>link</a> here with'
    ' more words<ul><li>one<li>two</ul></div><div class="sidebar">side</div><div id="comments"><p>nice!</p></div>'
    '<form><p>x</p></form><script>if(a<b){{"</p>"}}</script><footer>foot</footer><!-- open'
)


def test_main_text(spark):
    pages = [(i, f"http://A.example/{i}", PAGE.format(n=i)) for i in range(5)]
    pages += [(5, "http://a.example/5", '<div class="content9"><p>few</p></div><div class="text"><p>many more words here</p></div>'),
              (6, None, None), (7, "nonsense", ""), (None, None, "a < b <p>c"), (8, "http://b.example", '<div class="ad"><p>all</p></div>'),
              (5, "http://a.example/5", "<p>" + "long " * 30000)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("paths", F.lit(1))
    got = [r.text for r in html_consensus.main_text(frame).orderBy("page_id", F.length("text")).collect()]
    main = "Title & more\nFirst para line two\nSecond link here with more words\none\ntwo"
    assert got == ["a < b\nc", *[main] * 5, "few", ("long " * 30000).strip(), "", "", "all"]
    assert html_consensus.main_text(frame.limit(0)).count() == 0


def test_main_text_in_several_containers(spark):
    """Siblings of an article that differ in size, and a small box on the path that the host's pages vote for."""
    lead, body = " ".join(["lead"] * 40), " ".join(["body"] * 60)
    post = f'<div class=post><div class=lead><p>{lead}</div><div class=body><p>{body}</div></div>'
    box = f'<div class=content><p>box</div><div class=story><p>{body}</div>'
    pages = [(i, f"http://a.example/{i}", post) for i in range(3)]
    pages += [(i, f"http://b.example/{i}", f"<div class=content><p>{body}</div>") for i in range(3, 6)]
    pages.append((6, "http://b.example/6", box))
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = [r.text for r in html_consensus.main_text(frame).orderBy("page_id").collect()]
    assert got == [f"{lead}\n{body}"] * 3 + [body] * 4


def test_main_text_of_articles(spark):
    for r in queries.op6_main_text(spark, SMALL).join(
        spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h\d)>", body)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_warc(spark, tmp_path):
    import zstandard

    same = "é" * 60
    rows = [(3, "u", same), (1, "v\r\nx", same), (1, "v", same), (2, None, "short"), (4, "w", "short"), (None, "n", same),
            (5, "e", None), (6, "l", "x" * 600_000), (7, "h", "a\r\n\r\nb" * 40)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    archives = warc_seekable.write_archives(pages)
    got = warc_seekable.read_archives(archives).collect()
    assert ordered((r.page_id, r.record_type, r.refers_to) for r in got) == ordered([
        (3, "revisit", 1), (1, "response", None), (1, "response", None), (2, "response", None), (4, "response", None),
        (None, "revisit", 1), (5, "response", None), (6, "response", None), (7, "response", None)])
    payload = {r.page_id: bytes(r.payload) for r in got if r.payload is not None}
    assert payload == {p: (h or "").encode() for p, _, h in rows if p not in (3, None)}
    assert {r.payload_bytes for r in got if r.page_id in (1, 3, None)} == {120}
    looked = warc_seekable.look_up(archives, spark.createDataFrame([(6,), (7,)], "page_id bigint")).collect()
    assert {r.page_id: r.payload_bytes for r in looked} == {6: 600_000, 7: 240}
    files = warc_seekable.export(archives, f"file://{tmp_path}").collect()
    for r in files:
        with open(tmp_path / r.archive, "rb") as raw:
            data = raw.read()
        # A plain decoder passes over the seek table.
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert len(data) == r.n_bytes and list(warc_seekable.parse_records(plain))
    assert warc_seekable.read_archives(warc_seekable.write_archives(pages.limit(0))).count() == 0


# --- 10 ------------------------------------------------------------------------------------

def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(projection_search, "CELL_ROWS", 100)
    monkeypatch.setattr(projection_search, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 24))
    vectors = {i: (centres[i % 8] + 0.4 * rng.normal(size=24)).astype(np.float32) for i in range(1500)}
    for i in range(200, 500):
        vectors[i] = vectors[200]
    rows = [(i, [float(x) for x in v], 0) for i, v in vectors.items()]
    odd = [(5001, None, 0), (5050, [0.0] * 24, 0), (5100, [float("nan")] * 24, 0), (None, rows[0][1], 0),
           (5150, [None] + [1.0] * 23, 0), (5200, [1.0, 2.0], 0), (5201, [1.0, 2.5], 0), (50, rows[50][1], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, rank int")
    got = {}
    for r in projection_search.nearest(frame, frame.filter(F.col("vec_id") % 50 == 0), 5).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {*range(0, 1500, 50), 5200} and got[5200][1][0] == 5201 and len(got[5200]) == 1
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        scores = np.round(matrix @ matrix[q], 12)
        scores[q] = -2
        wanted = ids[np.lexsort((ids, -scores))[:5]].tolist()
        hits += len(set(wanted) & {v for v, _ in got[q].values()})
        if 200 <= q < 500:
            assert [got[q][k][0] for k in range(1, 6)] == wanted
    assert hits >= 0.97 * 5 * 30
    assert projection_search.nearest(frame.limit(0), frame.limit(0), 5).count() == 0


def test_nearest_in_a_block(monkeypatch):
    """A batch of queries is one search: the same rows as by brute force, ties to smaller ids."""
    monkeypatch.setattr(projection_search, "PAIRS", 5000)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(2000, 16))
    vectors[1000:1100] = 2 * vectors[:100]  # the same directions, and exactly so: ties
    block = projection_search.Block(vectors, [[10 * i, 10 * i + 1] for i in range(2000)])
    queries = vectors[:300] + 0.1 * rng.normal(size=(300, 16))
    cosines = (queries @ vectors.T) / np.linalg.norm(vectors, axis=1) / np.linalg.norm(queries, axis=1)[:, None]
    near = np.sort(np.round(cosines, 12), axis=1)[:, -3]
    for bounds in (np.full(300, 4.1), 2 - 2 * near + 1e-11):
        found = list(block.nearest([10 * n for n in range(300)], queries, bounds, 5))
        for n, best in enumerate(found):
            wanted = sorted(
                (-round(c, 12), i) for r, c in enumerate(cosines[n]) for i in (10 * r, 10 * r + 1) if i != 10 * n
            )[:5]
            least = 5 if bounds[n] > 4 else 3
            assert [i for _, i in best[:least]] == [i for _, i in wanted[:least]]
            assert np.allclose([score for score, _ in best[:least]], [-c for c, _ in wanted[:least]], atol=1e-10)
    small = projection_search.Block(vectors[:3], [[0], [1], [2]])
    assert sorted(i for _, i in next(small.nearest([0], vectors[:1], np.full(1, 4.1), 5))) == [1, 2]
    assert sorted(i for _, i in next(small.nearest([7], vectors[:1], np.full(1, 4.1), 5))) == [0, 1, 2]


# --- pipeline --------------------------------------------------------------------------------

@pytest.mark.parametrize("part", [
    "<a ", '<a "', '<a ">" ', "<a '> \" ", "</ ", "<!-", "<", "<!--", "<script>", "<p>a", "<a href=x>", "<div>", "<td class=a>",
    "<p>x<a href='>'>y</a>",
])
def test_pages_of_broken_markup(part):
    """Half a megabyte of it takes time in proportion, not in its square."""
    import time
    begun = time.process_time()
    html_consensus.extract(part * (500_000 // len(part)), [])
    assert time.process_time() - begun < 20


def test_markup_in_words():
    page = "<article><p>super<wbr>cali x<img src='a>b'>y a<br>b <i>c</i>d</p><p title='x>y'>e &lt;f&gt;</p></article>"
    assert html_consensus.extract(page, []) == "supercali xy a b cd\ne <f>"
    # Quotes that never close hide no end of a tag.
    assert html_consensus.extract("<article><p class=\"a>one</p><p>two</p></article>", []).split() == ["one", "two"]


def test_pipeline_stages(spark, odd, nothing, tmp_path):
    for n, docs in enumerate((odd, nothing)):
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{k}")
            if k < 4:
                assert docs.columns == columns
            if n == 0 and k == 0:
                assert docs.filter("doc_id in (0, 1, 2, 3, 14)").count() == 0
            if n == 0 and k == 1:
                assert docs.filter("doc_id = 7").count() == 0 and docs.filter("doc_id = 6").count() == 1
        assert bool(docs.count()) == (n == 0)


def test_language_stage_without_labels(spark, odd):
    """Missing labels reject no text that has letters."""
    bare = odd.withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.language(spark, bare, SMALL)
    assert left.columns == odd.columns
    wanted = [tuple(r) for r in bare.collect() if any(c.isalpha() for c in r.text or "")]
    assert wanted and ordered(tuple(r) for r in left.collect()) == ordered(wanted)


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())
