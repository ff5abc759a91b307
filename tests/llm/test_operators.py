"""Corpus operators against brute force, on awkward rows and hot groups."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
import sys
import zlib
from html.parser import HTMLParser

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from shoplens.llm import (  # noqa: E402
    attention_lm, exact_dedup, licenses, packing, quality, queries, sentencepiece_scan, sharding, simhash, topk, warc,
)
from shoplens.llm.common import table  # noqa: E402
from shoplens.llm.components import components  # noqa: E402

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, recipe string, _uid string, words string"


def _documents() -> list[tuple]:
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aeioultnrs") for _ in range(rng.randint(1, 7)))
    prose = [" ".join(word() for _ in range(n)) + "." for n in (3, 40, 40, 300, 1200)]
    texts = [None, "", "", " \n ", "A", "a", "É é", "x  y\n z ", "<|endoftext|> a b", *prose, prose[3], prose[3].upper(),
             prose[3] + " one more", *[prose[4].replace("a", "e", k) for k in range(3)], "z" * 5000, prose[4] * 12,
             "Released under the MIT License.", prose[1] + " licensed under CC BY-NC 4.0"]
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, prose[3], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows + [(1000 + i, prose[1], "en", "hot", 1, "x", "y", "z") for i in range(60)]


@pytest.fixture(scope="module")
def rows():
    return _documents()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    from oracle_compare import compare

    assert compare(queries.QUERIES[name](spark, SF001), con, queries.SQL[name])["values_match"]


def test_exact_dedup(docs, rows, empty):
    found = exact_dedup.duplicate_groups(docs).collect()
    groups = {}
    for r in rows:
        groups.setdefault(_lower(r[1]), []).append(r[0])
    want = sorted((str(i), str(max((x for x in g if x is not None), default=None)), len(g),
                   hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == len(groups)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.duplicate_groups(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0


def test_exact_dedup_tells_clashing_chunks_apart(docs, rows):
    found = exact_dedup.duplicate_groups(docs, hashed=lambda c: F.xxhash64(c) % 3, min_chunk=4, max_chunk=64)
    assert found.filter("kept").count() == len({_lower(r[1]) for r in rows})


def _fingerprint(text):
    words = [w for w in _lower(text).encode().split()]
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def _roots(items, linked):
    root = {i: i for i in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


@pytest.mark.parametrize("segments", [2, 3, 4])
def test_simhash(docs, rows, segments):
    prints = [_fingerprint(r[1]) for r in rows]
    roots = _roots(sorted(set(prints)), lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[roots[p]] = min(least.get(roots[p], r[0]), r[0])
    found = simhash.near_duplicates(docs, segments=segments).collect()
    got = sorted((str(r.doc_id), r.fp & (2 ** 64 - 1), str(r.component_id)) for r in found)
    assert got == sorted((str(r[0]), p, str(least.get(roots[p]))) for r, p in zip(rows, prints))
    assert sum(r._uid == r.keep_uid for r in found) == len({roots[p] for p in prints})


def test_simhash_links_of_random_and_dense_fingerprints(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (0, 1, 3, 4, 5)}
    prints |= {base[0] ^ (1 << i) ^ (1 << j) for i in range(0, 64, 5) for j in range(i)}
    prints = sorted(p - (p >> 63 << 64) for p in prints)
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = _roots(prints, lambda a, b: bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 4)
    for segments in (2, 3, 4):
        got = {r.node: r.root for r in components(simhash.links(nodes, segments=segments)).collect()}
        assert {p: got.get(p, p) for p in prints} == want


def test_components_of_a_path_and_nothing(spark):
    path = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(path).collect()
    assert len(found) == 200 and {r.root for r in found} == {0}
    assert components(path.limit(0)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 3]) for i in range(300)]
    vectors += [(5, vectors[5][1]), (301, None), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (None, [1.0] * 6),
                (320, [3e300] * 6), (304, [1.0, 2.0]), (340, []), (306, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("dim", F.lit("x"))
    ok = [(i, np.clip(np.floor(64 * np.array(v, float)), -2.0 ** 62, 2.0 ** 62).astype(object)) for i, v in vectors
          if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for q, a in ok:
        if q % 20 == 0:
            scores = [(-min(sum(int(x) * int(y) for x, y in zip(a, b)), 2 ** 63 - 1), i) for i, b in ok
                      if i != q and len(b) == len(a)]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:20], 1)]
    for block, tile, edge in ((2048, 512, 16), (16, 4, 16), (4, 2, 3), (8, 512, 2)):
        got = topk.top_k(df, df.filter("vec_id % 20 = 0"), block=block, tile=tile, fan=3, edge=edge)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0


def test_top_k_grid(spark):
    """Cells are bounded, one tile spreads over many, and numbers have no gaps."""
    assert topk.grid(100_000, 10_000) == (16, 6250, 625) and topk.grid(0, 0)[1:] == (1, 1)
    assert topk.grid(1000, 1)[1] >= 32 and topk.grid(1000, 1)[2] == 1
    rng = np.random.default_rng(4)
    for top in (127, 128, 2 ** 15, 2 ** 31, 2 ** 62):
        for x in (rng.integers(-top, top, (5, 3)), np.full((5, 3), -top), np.zeros((0, 3), np.int64), np.zeros((5, 0), np.int64)):
            assert (topk._matrix(topk._narrow(x), *x.shape) == x).all()
    low = np.full((2, 4), -128, np.int8)
    assert (topk._products(low, low) == 4 * 128 * 128).all()
    packed = spark.range(90).repartition(7).select("id", F.array(F.col("id").cast("double")).alias("v")) \
        .mapInArrow(topk._pack(4, 1), topk._PACKED)
    numbered, n = topk._numbered(packed)
    assert sorted(r.block for r in numbered.collect()) == list(range(n)) and n >= 23


class _Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head", "noscript", "template")
        if tag in warc.BLOCK_TAGS:
            self.out.append("\0")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head", "noscript", "template")
        if tag in warc.BLOCK_TAGS:
            self.out.append("\0")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def _visible(markup):
    p = _Text()
    p.feed(markup)
    lines = "".join(p.out).replace("\n", " ").split("\0")
    return [" ".join(x.replace("\xa0", " ").split(" ")).split() for x in lines if x.strip()]


def test_warc(spark, tmp_path):
    pages = table(spark, SF001, "pages")
    odd = spark.createDataFrame([(None, None, None), (-1, "http://a", ""), (-2, "http://b/", "<p>x<!-- y <a href='c d'>z</a>"),
                                 (-3, "http://c", "<a href=/q?x=1&amp;y=2 title='>'>t</a><script>var a = '</p>'")],
                                "page_id long, url string, html string")
    made = warc.responses(pages.unionByName(odd))
    derived = warc.derive(made).collect()
    source = {r.record_id: r for r in made.collect()}
    assert len(derived) == 2 * len(source) == 2 * (pages.count() + 4)
    for r in derived:
        s = source[r.refers_to]
        assert (r.target_uri, r.date, r.payload_digest) == (s.target_uri, s.date, s.payload_digest)
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.block).digest()).decode()
        if r.record_type == "metadata":
            assert s.block_digest.encode() in r.block and b"source-content-type: text/html" in r.block
    html = {str(r.page_id): r.html for r in pages.collect()}
    for r in derived:
        if r.record_type == "conversion" and r.source_key in html:
            assert [x.split() for x in bytes(r.block).decode().split("\n")] == _visible(html[r.source_key])
    assert warc.page_fields("<a href=/q?x=1&amp;y=2 title='>'>t</a>", "http://c")[2] == ["http://c/q?x=1&y=2"]
    path = str(tmp_path / "w")
    warc.write_warc(warc.derive(made), path)
    again = {r.record_id: r for r in warc.read_warc(spark, path + "/*.txt").collect()}
    assert {k: bytes(r.block) for k, r in again.items()} == {r.record_id: bytes(r.block) for r in derived}
    assert all(again[r.record_id].refers_to == r.refers_to for r in derived)


def test_warc_keeps_foreign_headers(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nX-Tight:a:b\r\nX-Empty:\r\nX-Wide:   c \r\n\r\n<p>x</p>"
    head = ("WARC/1.1\r\nWARC-Type:response\r\nWARC-Record-ID: <urn:a>\r\nWARC-Date: d\r\nWARC-Target-URI: http://a/\r\n"
            "WARC-IP-Address: 10.0.0.1\r\nWARC-Concurrent-To: <urn:b>\r\nWARC-Concurrent-To: <urn:c>\r\n"
            f"Content-Length: {len(block)}\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(head.encode() + block + b"\r\n\r\n")
    read = warc.read_warc(spark, str(tmp_path / "a.warc")).withColumn("source_key", F.lit("a"))
    (meta,) = warc.derive(read).filter("record_type = 'metadata'").collect()
    assert bytes(meta.block).decode().split("\r\n")[:-1] == [
        "source-status: HTTP/1.1 200 OK", "source-x-tight: a:b", "source-x-empty: ", "source-x-wide: c",
        "source-warc-ip-address: 10.0.0.1", "source-warc-concurrent-to: <urn:b>", "source-warc-concurrent-to: <urn:c>"]


def test_licenses(spark, docs, empty):
    found = {(r.doc_id, r.license): r.containment for r in licenses.scan(docs).collect()}
    assert set(found) == {(22, "MIT"), (23, "CC-BY-NC-4.0")} and set(found.values()) == {1.0}
    assert licenses.scan(empty).count() == 0 and licenses.scan(docs, {}).count() == 0
    long = "lorem " * 997 + licenses.TEMPLATES["GPL-3.0-file"].replace("modify", "change") + " ipsum" * 900
    one = spark.createDataFrame([(1, long)], "doc_id long, text string")
    (hit,) = licenses.scan(one, containment=0.7).collect()
    assert hit.license == "GPL-3.0-file" and hit.first_word <= 997 <= hit.first_word + hit.window_words


def test_whole_license_texts_in_a_long_list(spark):
    """Each whole text is found where it stands, also altered in places, whatever else is on the list."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    other = {f"other-{k}": " ".join(rng.choices(words, k=5 + k)) for k in range(150)}
    names, docs = list(licenses.FULL_TEXTS), []
    for i, name in enumerate(names):
        text = licenses.FULL_TEXTS[name].split()
        text[len(text) // 2] = "changed"
        docs.append((i, "ipsum " * (400 + 37 * i) + " ".join(text).upper() + " dolor" * 900))
        docs.append((100 + i, "ipsum " * 50 + " ".join(text[:len(text) // 2]) + " dolor" * 50))  # a half is not the text
    docs.append((200, other["other-70"]))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.license): r for r in licenses.scan(d, licenses.TEMPLATES | other).collect()}
    assert {k for k in found if k[1] in licenses.FULL_TEXTS} == set(enumerate(names))
    assert {k for k in found if k[1] in other} == {(200, "other-70")}
    for i, name in enumerate(names):
        r, n = found[i, name], len(licenses.words_of(licenses.FULL_TEXTS[name]))
        shingles = dict((x, s) for x, _, s in licenses.template_rows(licenses.FULL_TEXTS))[name]
        changed = licenses.words_of(docs[2 * i][1])[400 + 37 * i:][:n]
        held = {" ".join(changed[k:k + 5]) for k in range(n - 4)} & set(shingles)
        assert r.containment == len(held) / len(shingles) >= 0.8
        assert r.first_word <= 400 + 37 * i and r.first_word + r.window_words >= 400 + 37 * i + n


def test_licenses_of_fewer_than_five_words(spark):
    short = licenses.SHORT_TEMPLATES
    texts = [f"{'lorem ' * n}{short[name]}{' ipsum' * 900}" for n in range(12) for name in short]
    texts += ["all rights, reserved", "rights reserved", "All rights " + "x " * 9 + "reserved", None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = {(r.doc_id, r.license): r for r in licenses.scan(d).collect()}
    want = {(i, name): (i // len(short), len(licenses.words_of(short[name]))) for i in range(12 * len(short))
            for name in [list(short)[i % len(short)]]}
    want[(12 * len(short), "rights-reserved")] = (0, 3)
    assert set(found) == set(want)
    for key, (p, n) in want.items():
        r, words = found[key], len(licenses.words_of(texts[key[0]]))
        first = next(k for k in range(0, words, 5) if k <= p and p + n <= k + 10)
        assert (r.containment, r.first_word, r.window_words) == (1.0, first, min(10, words - first))
    assert {(r.doc_id, r.license) for r in licenses.scan(d, short).collect()} == set(want)


def test_language_model(spark, docs, rows, empty):
    got = {}
    for r in attention_lm.score_documents(docs).collect():
        got.setdefault(r.doc_id, r)
    train = [r for r in rows if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 != 2]
    counts = {}
    for r in train:
        for w in [*_lower(r[1]).encode().split(), None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        tokens = [*_lower(r[1]).encode().split(), None]
        want = sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        g = got[r[0]]
        if r[0] is not None:
            assert (g.n_tokens, g.n_known, g.train_tokens) == (len(tokens), sum(w in counts for w in tokens), n)
            assert abs(g.base_score - want) < 1e-6 * max(1, abs(want)) and np.isfinite(g.score) and g.score < 0
    assert attention_lm.score_documents(empty).count() == 0


def test_language_model_gradients_and_windows():
    rng = np.random.default_rng(2)
    size = attention_lm.END + 1
    begins = attention_lm.begins_word()
    m = attention_lm.Model(np.arange(size) % 50, np.where(begins, np.arange(size) % 3, 3 + np.arange(size) % 4),
                           np.zeros(size, np.float32), 3, None)
    m.weights = {n: rng.standard_normal(s) * 0.4 for n, s in m.shapes()}
    x, y, ok = rng.integers(0, 50, (3, 9)), rng.integers(0, 7, (3, 9)), rng.random((3, 9)) < 0.8

    def loss():
        logits = attention_lm.forward(m.weights, x)[0]
        lp = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        return -(np.take_along_axis(lp, y[:, :, None], 2)[:, :, 0] * ok).sum() / ok.sum()

    g, touched = attention_lm.gradients(m.weights, x, y, ok)
    assert touched.tolist() == sorted(set(x.ravel().tolist()))
    g["e"] = dict(zip(((int(i), 3) for i in touched), g["e"][:, 3]))
    for name, _ in m.shapes():
        at = tuple(rng.integers(0, s) for s in m.weights[name].shape)
        if name == "e":
            at = (x[0, 0], 3)
        kept = m.weights[name][at]
        m.weights[name][at] = kept + 1e-5
        up = loss()
        m.weights[name][at] = kept - 1e-5
        down = loss()
        m.weights[name][at] = kept
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4
    m.weights = {n: w.astype(np.float32) for n, w in m.weights.items()}
    # every id once: the classes' probabilities, computed window by window
    ids = rng.integers(0, size, 200).astype(np.int32)
    lp, _ = attention_lm.id_scores(m, ids, [(0, 1, 200)])
    for at in (1, 7, 40, 41, 100, 199):
        lo = max(1, (at - 1) // 40 * 40 + 1 - attention_lm.OVERLAP)
        logits = attention_lm.forward(m.weights, m.row_of[ids[lo - 1:at]][None])[0][0, -1].astype(float)
        assert abs(lp[at] - (logits[m.class_of[ids[at]]] - np.log(np.exp(logits).sum()))) < 1e-3


def test_language_model_score_is_the_mixture_word_by_word(spark):
    """Each word by ``forward`` alone, window by window; a small broadcast sends most words
    through the join. Trained on texts of one pattern, it beats the base on held-out ones."""
    rng = random.Random(8)
    pairs = {"alpha": "beta", "gamma": "delta", "kilo": "lima", "quebec": "romeo"}
    rows = []
    for i in range(400):
        words = [w for _ in range(rng.randint(1, 60)) for a in [rng.choice(list(pairs))] for w in (a, pairs[a])]
        if i % 9 == 0:
            words.insert(rng.randrange(len(words)), f"unseen{i}x")
        rows.append((i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, "Alpha beta"), (402, "Alpha beta")]
    texts = attention_lm._texts(spark.createDataFrame(rows, "doc_id long, text string"))
    training = texts.filter("not held_out")
    counts = attention_lm.word_counts(training)
    model = attention_lm.train(training, counts)
    got = attention_lm.mixed_scores(texts, counts, model, most=3).collect()
    assert len(got) == len(rows)
    of = {bytes(r.word): r.n for r in counts.collect()}
    n, v = sum(of.values()), len(of)
    ids_of, lag, stride = attention_lm.subwords(), attention_lm.OVERLAP, attention_lm.WINDOW - attention_lm.OVERLAP
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows[::23] + rows[-4:]:
        words = (text or "").lower().encode().split()
        each = [[attention_lm.END], *(list(ids_of(w)) for w in words), [attention_lm.END]]
        ids = np.concatenate(each).astype(int)
        lp, begin = np.zeros(len(ids)), np.zeros(len(ids))  # of the id; of any id that begins a word
        for at in range(1, len(ids)):
            lo = max(1, 1 + (at - 1) // stride * stride - lag)
            logits = attention_lm.forward(model.weights, model.row_of[ids[lo - 1:at]][None])[0][0, -1].astype(float)
            logits -= np.log(np.exp(logits).sum())
            lp[at] = logits[model.class_of[ids[at]]] + model.log_share[ids[at]]
            begin[at] = np.log(np.exp(logits[:model.starts]).sum())
        want, at = 0.0, 1
        for word, own in zip([*words, attention_lm.END_WORD], each[1:]):
            log_own = lp[at:at + len(own)].sum() - begin[at]
            at += len(own)
            if at < len(ids):
                log_own += begin[at]
            want += np.log10(0.5 * np.exp(log_own) + 0.5 * (of.get(word, 0) + 1) / (n + v + 1))
        assert abs(by_id[doc_id].score - want) < 1e-3 * max(1, abs(want))
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_trains_on_every_id(spark):
    rng = random.Random(3)
    ids_of = attention_lm.subwords()
    for n in (0, 1, 47, 3000, attention_lm.SEGMENT, 2 * attention_lm.SEGMENT + 5):
        text = " ".join(rng.choice(("alpha", "beta", "gammadelta", "x9q")) for _ in range(n))
        made = attention_lm.windows(spark.createDataFrame([(text.encode(),)], "text binary").coalesce(1))
        w = np.concatenate([attention_lm._windows_of(b) for b in made.toArrow().to_batches()])
        want = [i for x in text.encode().split() for i in ids_of(x)] + [attention_lm.END]
        assert w[0, 0] == attention_lm.END and (w[1:, 0] == w[:-1, -1]).all()
        assert w[:, 1:][w[:, 1:] >= 0].tolist() == want


def test_language_model_words_encoded_together_have_their_own_ids():
    e = attention_lm.encoder(attention_lm.VOCABULARY)
    plain = [b"plain", "\u00e9t\u00e9".encode(), b"don't", b"'s", b"<|endoftext|>", b"z" * 3000, "\u65e5\u672c".encode(), b"\xff\xfe", b"a1.b"]
    spaced = [b"\x1cx", "a\u00a0b".encode(), "\u3000".encode(), "b\u2028".encode()]  # none of them splits bytes
    for words in ([], plain, [*plain, spaced[0]], *([w] for w in spaced), [spaced[3], *plain]):
        assert e.words(words) == [e.word(w.decode("utf-8", "replace")) for w in words]


def test_language_model_remembers_words_in_use(monkeypatch):
    monkeypatch.setattr(attention_lm, "FLUSH", 8)
    ids_of, encoded = attention_lm.Subwords(), []
    real = ids_of._encoder

    class Spy:
        def word(self, word):
            encoded.append(word.encode())
            return real.word(word)

        def words(self, words):
            encoded.extend(words)
            return real.words(words)

    ids_of._encoder = Spy()
    for i in range(60):
        for found, w in zip(ids_of.packed_all([b"often", b"rare%d" % i]), ("often", f"rare{i}")):
            assert found == real.word(w)
        assert len(ids_of._known) + len(ids_of._older) <= 8
    assert encoded.count(b"often") == 1 and len(encoded) == 61


def test_language_model_workers_keep_freed_memory(spark, monkeypatch):
    """In the workers of its own functions only."""
    def setting():
        def run(batches):
            import os

            for _ in batches:
                yield pa.RecordBatch.from_pydict({"v": pa.array([os.environ.get("MALLOC_TRIM_THRESHOLD_")], pa.string())})

        return spark.range(1, numPartitions=1).mapInArrow(run, "v string").first().v

    seen, train = [], attention_lm.train
    monkeypatch.setattr(attention_lm, "train", lambda *a: seen.append(setting()) or train(*a))
    attention_lm.score_documents(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).collect()
    assert seen == [str(32 << 20)] and setting() is None


def test_packing(docs, rows, empty):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    found = packing.pack_documents(docs).collect()
    want = []
    for r in rows:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 0]
        lo = 0
        for k in range(-(-len(ids) // 2048)):
            n = (len(ids) % 2048 or 2048) if k == 0 else 2048
            want.append((str(r[0]), k, lo, n, zlib.crc32(np.array(ids[lo:lo + n], "<u4").tobytes())))
            lo += n
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    used = {}
    for r in found:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    bound = packing.lower_bound(np.array([w[3] for w in want]), 2048)
    assert bound <= len(used) <= bound + 1
    assert packing.pack_documents(empty).count() == 0


def test_packing_exchanges_between_groups(spark, monkeypatch):
    rng = np.random.default_rng(4)
    sizes = np.concatenate([rng.integers(1, 900, 3000), rng.integers(900, 2048, 500), np.full(40, 2048)])
    items = spark.createDataFrame([(i, 0, int(s)) for i, s in enumerate(sizes)], "_uid long, piece int, length long")
    monkeypatch.setattr(packing, "GROUP_TOKENS", 60_000)
    placed = packing.pack(items).toPandas()
    assert sorted(placed["_uid"]) == list(range(len(sizes)))
    assert placed.groupby("bin")["length"].sum().max() <= 2048
    bound = packing.lower_bound(sizes, 2048)
    alone = packing.best_fit_decreasing(sizes, 2048)[0].max() + 1
    assert bound <= placed["bin"].nunique() <= 1.01 * alone + 1


def test_lower_bound_holds_for_optimal_packings():
    rng = np.random.default_rng(8)
    for _ in range(200):
        cuts = [np.diff(np.concatenate([[0], np.sort(rng.choice(np.arange(1, 60), rng.integers(0, 5), False)), [60]]))
                for _ in range(7)]
        assert packing.lower_bound(np.concatenate(cuts), 60) <= 7


def test_sharding(docs, rows, empty):
    found = sharding.shard_documents(docs, shards=7).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == want
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(s) for s in slots.values()]
    assert len(counts) == 7 and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(empty).count() == 0


def test_sharding_moves_little():
    rng = np.random.default_rng(1)
    counts = {c: int(n) for c, n in enumerate(rng.poisson(12, sharding.CELLS))}
    where = []
    for shards in (40, 41):
        placed = np.full((sharding.CELLS, max(counts.values())), -1)
        for cell, lo, hi, shard, _ in sharding.layout(counts, shards):
            placed[cell, lo:hi] = shard
        where.append(placed)
    real = where[0] >= 0
    assert (where[1] >= 0).sum() == real.sum() == sum(counts.values())
    assert (where[0] != where[1])[real].mean() < 0.25  # a plain modulus moves 97 %


def test_quality(spark, docs, empty):
    d, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    found = quality.score_documents(d, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = found[found.quality == 1].score, found[found.quality == 0].score
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    odd = quality.score_documents(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in odd)
    none = labels.limit(0)
    assert {r.score for r in quality.score_documents(docs, none).collect()} == {0.5}
    assert quality.score_documents(empty, labels).count() == 0
    kept = quality.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_quality_counts_every_word_of_short_texts():
    at = quality.FEATURES.index("top_word")
    for n in range(65, 251):
        words = [f"w{i}" for i in range(n - n // 4)] + [f"often{n}"] * (n // 4)
        random.Random(n).shuffle(words)
        got = quality.statistics(" ".join(words).encode())[at]
        assert abs(got - (max(words.count(x) for x in words) / n) ** 0.5) < 1e-12


def _best_path(text):
    """Greatest sum of scores over all ways to cut a marked text; among equal sums the
    earliest start of the last piece, from the end back."""
    from public_tokenizers import path
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    vocabulary = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
                  if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))}
    # a piece of rank r scores -log(r + 2), in whole units
    unit = sentencepiece_scan.UNIT
    value = {i: -round(math.log(2 - sp.get_score(i)) * unit) for i in vocabulary.values()}
    unknown = min(value.values()) - 10 * unit
    best = [(0.0, [])]
    for j in range(1, len(text) + 1):
        ways = []
        for i in range(j):
            piece = text[i:j]
            if piece in vocabulary:
                ways.append((best[i][0] + value[vocabulary[piece]], -i, best[i][1] + [vocabulary[piece]]))
            elif j == i + 1:
                ways.append((best[i][0] + unknown, -i, best[i][1] + [sp.piece_to_id(f"<0x{b:02X}>") for b in piece.encode()]))
        score, _, ids = max(ways, key=lambda w: w[:2])
        best.append((score, ids))
    return best[-1]


def test_sentencepiece(docs, rows, empty):
    whole = {r._uid: r for r in sentencepiece_scan.encode(docs, chunk=1 << 20).collect()}
    cut = {r._uid: r for r in sentencepiece_scan.encode(docs, chunk=48).collect()}
    assert len(whole) == len(cut) == len(rows)
    assert max(r.n_chunks for r in cut.values()) > 64  # two levels of the tree
    for uid, r in whole.items():
        assert (cut[uid].ids, cut[uid].score, cut[uid].text_crc32) == (r.ids, r.score, r.text_crc32)
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None and len(r[1] or "") < 400}
    for r in whole.values():
        if r.doc_id in texts and r.doc_id < 1005:
            marked = "\u2581" + texts[r.doc_id].replace(" ", "\u2581") if texts[r.doc_id] else ""
            score, ids = _best_path(marked)
            assert (np.frombuffer(r.ids, "<u4").tolist(), r.score) == (ids, int(score))
    back = sentencepiece_scan.decode(sentencepiece_scan.encode(docs, chunk=48))
    assert {r._uid: zlib.crc32(r.decoded) for r in back.collect()} == {u: r.text_crc32 for u, r in whole.items()}
    assert sentencepiece_scan.encode(empty).count() == 0


def test_sentencepiece_paths_are_the_librarys_but_for_ties():
    """The library, given the same scores as a unigram model, finds the same best paths."""
    from public_tokenizers import path
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    scores = sentencepiece_scan.unit_scores([piece.score for piece in proto.pieces])
    for piece, score in zip(proto.pieces, scores):
        piece.score = score / sentencepiece_scan.UNIT
    library = SentencePieceProcessor(model_proto=proto.SerializeToString())
    con = duckdb.connect()
    texts = [r[0] for r in con.execute(f"SELECT text FROM '{SF001}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    words = sorted({w for t in texts for w in t.split()})
    p = sentencepiece_scan.pieces(sentencepiece_scan.MODEL)
    other = 0
    for w, theirs in zip(words, library.encode(words)):
        mine = p.word(sentencepiece_scan.MARK + w)
        if np.frombuffer(mine, "<u4").tolist() != theirs:
            other += 1
            assert abs(p.score(mine) - p.score(np.array(theirs, "<u4").tobytes())) <= 32  # a tie, but for rounding
    assert len(words) > 3000 and other < len(words) / 100
    assert len(p.word(sentencepiece_scan.MARK + "the")) == 4  # one piece


def test_sentencepiece_words_in_blocks():
    """Words taken together have the ids of the plain pass, byte pieces and ties included."""
    rng, mark = random.Random(11), sentencepiece_scan.MARK
    letters = "aeioultnrs" * 4 + "ABz019-._|\u00e9\u0436\u4e2d\U0001f600\u0e5b\x07"
    words = {mark * rng.randint(0, 2) + "".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(3000)}
    words |= {mark, "a", "z" * 64, mark + "the", "\u0e5b"}
    p = sentencepiece_scan.pieces(sentencepiece_scan.MODEL)
    found = p._solve(sorted(words, key=len))
    assert len(found) == len(words)
    for w in words:
        assert found[w] == p.trace(w, p.forward(w, len(w), [0.0])[1], len(w))[1]
    texts = ["", *(mark.join(["", *rng.sample(sorted(words), 50)]) for _ in range(40))]
    plain = [b"".join(p.trace(w, p.forward(w, len(w), [0.0])[1], len(w))[1] for w in p.words(t)) for t in texts]
    assert list(p.encode_all(texts)) == plain == [p.encode(t) for t in texts]
