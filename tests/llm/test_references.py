"""Plain reference versions: the ring walk, the discriminant, foreign WARC files, and the pipeline on awkward rows."""

from __future__ import annotations

import gzip
import os
import struct
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from shoplens.llm import quality, queries, sharding, simhash, warc  # noqa: E402

SF001 = "/root/testdata/sf0.001"




def _signed_cell(doc_id):
    h = xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
    return (h - 2 ** 64 if h >= 2 ** 63 else h) % sharding.CELLS


def test_sharding_equals_a_walk_round_the_ring(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    hot = docs.limit(1).withColumn("doc_id", F.lit(7).cast("long")).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("_n")
    docs = docs.unionByName(hot)  # one id overflows its shard
    got = [(r.doc_id, r.shard) for r in sharding.shard_documents(docs).collect()]
    waiting = Counter(_signed_cell(i) for i, _ in got)
    nodes = sharding.virtual_nodes(sharding.SHARDS)
    n = len(got)
    room = [n // sharding.SHARDS + (s < n % sharding.SHARDS) for s in range(sharding.SHARDS)]
    want, over = Counter(), []
    for cell in sorted(waiting):  # first every key's own shard, up to its bound
        k = next((k for k, (c, _) in enumerate(nodes) if c >= cell), 0)
        for _ in range(waiting[cell]):
            if room[nodes[k][1]]:
                room[nodes[k][1]] -= 1
                want[cell, nodes[k][1]] += 1
            else:
                over.append((cell, k))
    for cell, k in over:  # then what overflows goes on clockwise
        while not room[nodes[k][1]]:
            k = (k + 1) % len(nodes)
        room[nodes[k][1]] -= 1
        want[cell, nodes[k][1]] += 1
    assert over and Counter((_signed_cell(i), s) for i, s in got) == want


def test_quality_scores_equal_a_plain_discriminant(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    x = {r.doc_id: np.array(quality.statistics((r.text or "").encode())) for r in docs}
    train = [i for i in labels if i in x and zlib.crc32(str(i).encode()) % 5 and labels[i] in (0, 1)]
    rows = {c: np.stack([x[i] for i in train if labels[i] == c]) for c in (0, 1)}
    scatter = {c: (v - v.mean(0)).T @ (v - v.mean(0)) for c, v in rows.items()}
    n = len(train)
    pooled = (scatter[0] + scatter[1]) / n

    def log_density(c, v):
        share = max(quality.TO_POOLED, (x[train[0]].size + 1) / (x[train[0]].size + 1 + len(rows[c])))
        cov = (1 - share) * scatter[c] / len(rows[c]) + share * pooled
        cov = (1 - quality.TO_DIAGONAL) * cov + quality.TO_DIAGONAL * np.diag(np.diag(cov)) + quality.RIDGE * np.eye(len(cov))
        off = v - rows[c].mean(0)
        return np.log(len(rows[c]) / n) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * off @ np.linalg.solve(cov, off)

    got = {r.doc_id: r for r in queries.op10_quality_qda(spark, SF001).collect()}
    assert set(got) == set(x)
    for i, v in x.items():
        want = 1 / (1 + np.exp(-np.clip(log_density(1, v) - log_density(0, v), -500, 500)))
        assert abs(got[i].score - want) < 1e-6
        assert got[i].predicted == int(got[i].score >= 0.3)


def _record(i, block, kind="response", length=None):
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{i}>\r\nContent-Length: {len(block) if length is None else length}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_foreign_warc_files(spark, tmp_path):
    a, b = _record(1, b"HTTP/1.1 200 OK\r\n\r\n<p>one\nWARC/1.1\r\nnot a record</p>"), _record(2, b"HTTP/1.1 200 OK\r\n\r\n<p>two</p>")

    def read(name, data):
        path = tmp_path / name
        path.write_bytes(data)
        rows = warc.read_warc(spark, str(path)).collect()
        return [(r.record_id, r.damage) for r in rows], rows

    whole = [("<urn:x:1>", None), ("<urn:x:2>", None)]
    assert read("plain.warc", a + b)[0] == whole
    assert read("members.warc.gz", gzip.compress(a) + gzip.compress(b))[0] == whole  # the usual form
    assert read("one.warc.gz", gzip.compress(a + b))[0] == whole
    assert read("blank.warc", a + b"\r\n" + b)[0] == whole  # a stray empty line
    assert read("stray.warc", b"junk\r\n" + a + b"more junk\r\n" + b)[0] == [
        (None, "stray bytes"), whole[0], (None, "stray bytes"), whole[1]]
    assert read("cut.warc", a + b[:30])[0] == [whole[0], (None, "header cut short")]
    found, rows = read("block.warc", a + b[:-12])
    assert found == [whole[0], ("<urn:x:2>", "block cut short")] and rows[1].block.startswith(b"HTTP/1.1 200")
    assert read("length.warc", _record(3, b"x", length="many") + b)[0] == [("<urn:x:3>", "no length"), whole[1]]
    assert read("long.warc", _record(4, b"short", length=10_000) + b)[0] == [("<urn:x:4>", "block cut short"), whole[1]]
    broken = bytearray(gzip.compress(a))
    broken[40] ^= 0xFF
    found, _ = read("broken.warc.gz", bytes(broken) + gzip.compress(b))
    assert found[-1] == whole[1] and all(d for _, d in found[:-1])
    assert read("empty.warc", b"")[0] == []
    # nothing is derived from a damaged piece
    made = warc.derive(warc.read_warc(spark, str(tmp_path / "block.warc")).withColumn("source_key", F.lit("k")))
    assert {r.refers_to for r in made.collect()} == {"<urn:x:1>"}


def _parsed(data, size, most=warc.STRAY):
    parts = (data[i:i + size] for i in range(0, len(data), size))
    return [(dict(f).get("WARC-Record-ID"), bytes(b), d) for f, b, d in warc.parse_records(parts, most)]


def test_warc_pieces_do_not_matter():
    """Streams of whole, damaged and stray pieces read alike however they are cut."""
    rng = np.random.default_rng(11)
    for _ in range(40):
        data = b""
        for i in range(int(rng.integers(1, 8))):
            body = rng.choice(np.frombuffer(b"WARC/1.1\r\n x", np.uint8), int(rng.integers(0, 60))).tobytes()
            one = _record(i, body, **({} if rng.random() < .7 else {"length": ["many", 10 ** 4, 10 ** 17, 5][rng.integers(4)]}))
            if rng.random() < .2:
                one = one[:int(rng.integers(1, len(one)))]
            data += [b"", b"\r\n", b"junk\r\n", b"WARC/1.1\r\n"][rng.integers(4)] + one
        want = _parsed(data, len(data))
        for size in (1, 2, 7, 64):
            assert _parsed(data, size) == want
        # small bounds only cut damaged pieces up further: whole records stay
        assert [x for x in _parsed(data, 7, 4096) if not x[2]] == [x for x in want if not x[2]]


def test_warc_gzip_members():
    records = [_record(i, b"x" * (i % 300)) for i in range(3000)]
    data = b"".join(map(gzip.compress, records))

    def ids(content, size=warc.BATCH_BYTES):
        batches = list(warc.record_batches(content, size))
        return [r["record_id"] for b in batches for r in b.to_pylist()], len(batches), \
            {r["damage"] for b in batches for r in b.to_pylist()}

    want = [f"<urn:x:{i}>" for i in range(3000)]
    assert ids(data) == (want, 1, {None}) and ids(b"".join(records), 100_000)[0] == want
    assert ids(data, 100_000)[1] > 10  # records leave in batches
    assert ids(gzip.compress(data[:0]))[0] == [] and ids(data + b"\0" * 512)[2] == {None}
    found, _, damage = ids(data + b"no gzip at all" + gzip.compress(records[0]))
    assert found == [*want, None, want[0]] and damage == {None, "stray bytes"}
    big = _record(7, b"y" * (3 * warc.STRAY)) + _record(8, b"z")  # inflated twice rather than held
    assert ids(gzip.compress(big))[0] == ["<urn:x:7>", "<urn:x:8>"]
    wrong = bytearray(gzip.compress(big))
    wrong[-6] ^= 1  # the checksum: no record of that member is trusted
    found, _, damage = ids(bytes(wrong) + gzip.compress(records[5]))
    assert found[-1] == want[5] and damage == {None, "damaged gzip member"} and "<urn:x:7>" in found


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, a null id, a very long text, columns named as the operators' own."""
    folder = str(tmp_path)
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = base + [base[5], base[5], (None, base[7][1]), (None, None), (90_001, None), (90_002, ""), (90_003, base[9][1].upper()),
                   (90_004, base[11][1] + " last"), (90_005, " ".join(t for _, t in base[:40] if t))]
    schema = "doc_id long, text string, lang string, _uid string, _row_uid string, recipe string, fp string"
    spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], schema).repartition(4) \
        .write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))

    predicted = {r.doc_id: r.predicted for r in quality.score_documents(docs, labels).collect()}
    good = {t for i, t in rows if i is not None and predicted[i]}  # every text has a row with an id
    kept = defaultdict(list)
    for i, t in rows:
        if t in good:
            kept["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")].append(i)
    order = lambda i: (i is not None, i or 0)
    single = [(max(ids, key=order), t) for t, ids in kept.items()]
    groups = simhash.near_duplicates(spark.createDataFrame(single, "doc_id long, text string")).collect()
    want = sorted({str(r.component_id) for r in groups})
    placed = corpus_pipeline.run(spark, folder).collect()
    assert sorted({str(r.doc_id) for r in placed}) == want
    # whole texts, in sequences without gaps
    assert all(r.length > 0 for r in placed)
    in_order = defaultdict(list)
    for r in placed:
        in_order[r.sequence_id].append((r.offset, r.length))
    for pieces in in_order.values():
        pieces.sort()
        assert pieces[0][0] == 0 and sum(n for _, n in pieces) <= 2048
        assert all(o + n == o2 for (o, n), (o2, _) in zip(pieces, pieces[1:]))
