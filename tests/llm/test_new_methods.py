"""Centroids, archives and hard negatives against plain versions, and their odd rows."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from obsloom.llm import sql, warc
from obsloom.llm.centroids import Orchard, cluster, with_inertia
from obsloom.llm.mining import Postings, hard_negatives

NAN, INF = float("nan"), float("inf")


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


# Centroids.


def test_orchard_equals_measuring_all():
    draw = np.random.default_rng(1)
    for k, spread in ((1, 5), (2, 3), (9, 2), (40, 4), (40, 200)):
        centroids = draw.integers(-spread, spread + 1, (k, 6))
        if k > 4:
            centroids[3] = centroids[1]  # equal centroids: the smaller number wins
        vectors = np.concatenate([draw.integers(-spread, spread + 1, (500, 6)), centroids])
        distances = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        number, least = Orchard(centroids).nearest(vectors)
        assert (number == distances.argmin(axis=1)).all() and (least == distances.min(axis=1)).all()


def test_orchard_measures_few():
    draw = np.random.default_rng(2)
    centroids = draw.normal(0, 1000, (60, 4)).astype(np.int64)
    vectors = centroids[draw.integers(0, 60, 3000)] + draw.integers(-20, 21, (3000, 4))
    orchard, measured = Orchard(centroids), 0
    plain = orchard.distance

    def counted(v, c):
        nonlocal measured
        measured += len(v)
        return plain(v, c)

    orchard.distance = counted
    orchard.nearest(vectors)
    assert measured < 60 * 3000 / 2


def plain_clusters(rows, size, k, rounds, scale):
    kept = [(i, np.floor(scale * np.array(v, np.float64)).astype(int)) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), j) for j, (i, _) in enumerate(kept) if i is not None)
    middle = [list(map(int, kept[j][1])) for _, j in first[:k]]
    near = lambda v: min((sum((int(a) - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(middle))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for c in range(len(middle)):
            own = [v for (_, v), x in zip(kept, at, strict=True) if x == c]
            middle[c] = [int(sum(int(v[d]) for v in own)) // len(own) for d in range(size)] if own else middle[c]
    ends = [(i, *near(v)) for i, v in kept]
    total = sum(e[1] for e in ends)
    return sorted(
        (i, c, d, sum(e[1] for e in ends if e[2] == c), total, hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest()) for i, d, c in ends
    )


def test_clusters_equal_plain_rounds(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(i % 5, 0.4, 4).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(40)]  # a hot vector, ties between its copies
    rows += [(500, None), (501, []), (502, [1.0]), (503, [NAN, 1.0, 1.0, 1.0]), (504, [1.0, None, 1.0, 1.0]), (505, [INF, 0.0, 0.0, 0.0])]
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string")
    for k in (1, 7, 16):
        found = with_inertia(cluster(docs, size=4, k=k))
        columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
        assert sorted(tuple(r) for r in found.select(*columns).collect()) == plain_clusters(rows, 4, k, 3, 64)


def test_clusters_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, distance string"
    assert with_inertia(cluster(spark.createDataFrame([], schema), size=2)).collect() == []
    assert cluster(spark.createDataFrame([(1, None, ""), (2, [NAN, 0.0], "")], schema), size=2).collect() == []
    rows = [(1, [0.0, 0.0], ""), (1, [0.0, 0.0], ""), (None, [9.0, 9.0], None), (2, [3.0e38, -3.0e38], "")]
    found = with_inertia(cluster(spark.createDataFrame(rows, schema), size=2)).collect()
    assert sorted((r["vec_id"] or 0, r["distance"]) for r in found)[1:3] == [(1, 0), (1, 0)] and len(found) == 4
    assert all(0 <= r["distance"] <= r["cluster_inertia"] <= r["inertia"] for r in found)


# Archives.


def plain_pages(rows, least=0):
    heads = {}
    for i, _, html in rows:
        if i is not None:
            heads[html or ""] = max(heads.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        head = heads.get(html or "") if len(body) >= least and i is not None else None
        again = head is not None and head != i
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "revisit" if again else "response", head if again else None))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


PAGES = "page_id long, url string, html string, digest string, head int"
RESULT = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.fixture(scope="module")
def odd_pages():
    draw = random.Random(4)
    rows = [(i, f"http://h{i % 9}.org/{i}", draw.choice(["<p>hot</p>", f"<p>{i}\r\n\r\nWARC/1.1\r\n\n\r</p>", f"é😀 {i // 2}"])) for i in range(300)]
    return rows + [
        (1000, None, None), (1001, "x", ""), (1002, "bad url <a>\r\nWARC-Type: metadata\r\n\r\n", "b\n"), (1003, "u" * 5000, "long " * 400_000),
        (None, "n", "<p>hot</p>"), (None, None, None), (1004, "a", "tie"), (1004, "b", "tie"), (1005, "a", "same id"), (1005, "a", "other text"), (1006, "e", "ends\r\n\r\n"),
    ]


@pytest.mark.parametrize("least", [0, 12])
def test_pages_come_back(spark, odd_pages, least):
    pages = spark.createDataFrame([(*r, "x", 1) for r in odd_pages], PAGES).repartition(3)
    index, folder = warc.archive_pages(pages, least_bytes=least)
    found = warc.page_ids(warc.read_records(index, folder))
    assert tuples(found, *RESULT) == plain_pages(odd_pages, least)
    # Whole texts of the responses, and each page's own URL.
    stored = {(r["page_id"], bytes(r["payload"]).decode()) for r in found.where("record_type = 'response'").collect()}
    assert stored == {(i, h or "") for i, _, h in odd_pages if any(x[0] == i and x[3] == "response" for x in plain_pages(odd_pages, least))}
    urls = {r["page_id"]: r["target_uri"] for r in found.where("page_id in (3, 1000, 1002)").collect()}
    assert urls == {3: "http://h3.org/3", 1000: None, 1002: "bad%20url%20%3Ca%3E%0D%0AWARC-Type:%20metadata%0D%0A%0D%0A"}


def test_no_pages(spark):
    index, folder = warc.archive_pages(spark.createDataFrame([], PAGES))
    assert warc.page_ids(warc.read_records(index, folder)).collect() == []


def test_every_record_is_a_member_at_its_offset(spark, odd_pages, tmp_path):
    pages = spark.createDataFrame([(*r, "x", 1) for r in odd_pages], PAGES).repartition(2)
    index, folder = warc.archive_pages(pages, folder=f"file://{tmp_path}/w")
    streams = [gzip.decompress(f.read_bytes()) for f in (tmp_path / "w/streams").glob("*.gz")]
    by: dict = {}
    for r in index.collect():
        by.setdefault(r["archive"], []).append(r)
    assert sorted(by) == sorted(p.name for p in (tmp_path / "w/archives").iterdir()) and len(by) == len([s for s in streams if s])
    rewritten = []
    for name, rows in by.items():
        data = (tmp_path / "w/archives" / name).read_bytes()
        records, at = [], None
        for r in sorted(rows, key=lambda r: r["offset"]):
            at = r["offset"] if at is None else at
            assert r["offset"] == at  # the members follow each other
            at += r["length"]
            one = zlib.decompressobj(31)
            records.append(one.decompress(data[r["offset"] : at]))
            assert one.eof and not one.unused_data
        assert at == len(data)
        rewritten.append(b"".join(records))
    assert sorted(rewritten) == sorted(s for s in streams if s)
    # Any rows of the index can be read alone.
    some = index.where(F.col("record_id").isin("<urn:page:7>", "<urn:page:1003>"))
    assert {r["record_id"] for r in warc.read_records(some, folder).collect()} == {"<urn:page:7>", "<urn:page:1003>"}


def record(kind: str, block: bytes, extra: str = "") -> bytes:
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{len(block)}>\r\n{extra}Content-Length: {len(block)}".encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """One stream, many members, blocks with any bytes; several archives for one file; what is damaged raises."""
    blocks = [bytes([b % 256 for b in range(n)]) for n in (0, 1, 300, 5000, 70_000)] + [b"\r\n\r\nWARC/1.0\r\n\r\n\n"]
    good = [record("resource", b) for b in blocks]
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.warc.gz").write_bytes(gzip.compress(b"".join(good)))
    (source / "many.warc.gz").write_bytes(b"".join(map(gzip.compress, good)))
    folder = f"file://{tmp_path}/out"
    index = warc.normalise(spark, f"file://{source}", folder, roll_bytes=600)
    assert index.count() == 2 * len(good) and index.select("archive").distinct().count() > 2
    found = warc.read_records(index, folder).collect()
    assert sorted(bytes(r["payload"]) for r in found) == sorted(blocks * 2) and all(r["payload_bytes"] == len(r["payload"]) for r in found)
    for n, bad in enumerate([good[2][:-150], b"WARC/1.0\r\nWARC-Type: x\r\n\r\n", b"no archive\r\n\r\n" * 3, good[2][:-2] + b"xx" + good[3]]):
        path = tmp_path / f"bad{n}"
        path.mkdir()
        (path / "x.warc.gz").write_bytes(gzip.compress(good[0] + bad))
        with pytest.raises(Exception, match="x.warc.gz"):
            warc.normalise(spark, f"file://{path}", f"file://{tmp_path}/o{n}")
    wrong = record("resource", b"abc", "WARC-Payload-Digest: sha1:AAAA\r\n")
    (tmp_path / "wrong").mkdir()
    (tmp_path / "wrong/x.warc.gz").write_bytes(gzip.compress(wrong))
    index = warc.normalise(spark, f"file://{tmp_path}/wrong", f"file://{tmp_path}/ow")
    with pytest.raises(Exception, match="payload is not"):
        warc.read_records(index, f"file://{tmp_path}/ow").collect()


# Hard negatives.


def plain_negatives(rows, every=10, keep=5, take=3):
    usable = {(i, label, tuple(v)) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    whole = [(i, label, [int(np.floor(256 * float(x))) for x in v]) for i, label, v in usable]
    out = []
    for i, label, v in whole:
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, m) for j, m, w in whole if j != i)
        for s, j, _ in [x for x in scores if x[2] == label][:keep]:
            window = [(t, n) for t, n, m in scores if m != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, rank + 1, n, -s, -t) for rank, (t, n) in enumerate(window[:take])]
    return sorted(out)


NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
VECTORS = "vec_id long, embedding array<float>, label int, score string"


@pytest.mark.parametrize("options", [{}, {"sample": 20}, {"sample": 3, "block": 40}, {"sample": 1}])
def test_negatives_equal_all_pairs(spark, options):
    draw = np.random.default_rng(5)
    middle = draw.standard_normal((4, 12))
    rows = [(i, (middle[i % 4] * draw.uniform(0, 1) + draw.standard_normal(12) * 0.5).astype(np.float32).tolist(), int(i * 7 % 5)) for i in range(260)]
    rows += [(300 + i, rows[10][1], i % 2) for i in range(30)]  # a hot vector: ties by id
    rows += [(400, [1.0, 1.0], 9), (410, None, 1), (420, [NAN] * 12, 1), (430, [0.0] * 12, 1), (441, [0.0] * 12, 2), (450, [], 1), (460, [1.0], None)]
    rows += [(rows[0][0], rows[0][1], rows[0][2])]
    found = hard_negatives(spark.createDataFrame([(*r, "x") for r in rows], VECTORS), F.col("vec_id") % 10 == 0, **options)
    assert sorted(tuple(r) for r in found.select(*NEGATIVES).collect()) == plain_negatives(rows)


def test_negatives_of_odd_tables(spark):
    anchors = F.col("vec_id") % 10 == 0
    for rows in ([], [(None, None, None, None)], [(10, [1.0], None, ""), (None, [1.0], 1, "")], [(10, [1.0], 1, ""), (20, [2.0], 1, "")]):
        assert hard_negatives(spark.createDataFrame(rows, VECTORS), anchors).collect() == []
    rows = [(10, [3.0e38], 1, ""), (11, [3.0e38], 1, ""), (12, [1.0e38], 2, "")]
    assert hard_negatives(spark.createDataFrame(rows, VECTORS), anchors).collect() == []  # the same bound for all: 100 percent
    rows = [(10, [1.0], 1, ""), (11, [1.0], 1, ""), (11, [1.0], 1, "again"), (12, [0.75], 2, ""), (11, [0.75], 2, "")]
    found = hard_negatives(spark.createDataFrame(rows, VECTORS), anchors).collect()
    assert [(r["rank"], r["negative_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 11), (2, 12)]


def test_postings_leave_out_what_cannot_count():
    draw = np.random.default_rng(6)
    rows = np.floor(draw.standard_normal((400, 64)) * 40 * np.linspace(3, 0.01, 64))
    anchors = rows[:30]
    scores = anchors @ rows.T
    low = np.sort(scores, axis=1)[:, -4]
    index = Postings(rows, anchors, low.min())
    a, r, s = index.search(anchors, low)
    assert set(zip(a, r, s, strict=True)) == {(i, j, scores[i, j]) for i, j in zip(*np.nonzero(scores >= low[:, None]), strict=True)}
    assert index.lengths[0] < 400 or index.lengths[-1] < 100  # rows or their tails are not posted


@pytest.mark.parametrize("kind", ["centroids", "negatives"])
def test_sql_of_hot_tables(spark, kind):
    """The SQL of the queries on a table in which a third of the vectors are equal."""
    draw = np.random.default_rng(8)
    vectors = [(i, (draw.standard_normal(64) * 0.2).astype(np.float32).tolist() if i % 3 else [0.125] * 64, i % 4) for i in range(240)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame(vectors, columns=["vec_id", "embedding", "label"]).astype({"vec_id": "int64", "label": "int32"}))
    if kind == "centroids":
        found, text = with_inertia(cluster(table)).drop("centroid"), sql.centroids()
    else:
        label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        found, text = hard_negatives(table.withColumn("label", label), F.col("vec_id") % 50 == 0), sql.HARD_NEGATIVES
    columns = sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(con.sql(text).select(*columns).fetchall())
