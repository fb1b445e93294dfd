"""Archives, nearest neighbours, the pipeline, and every SQL text of the subpackage."""

import base64
import hashlib
import math
import random

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import archives, nearest, queries
from tessera.session import scratch_path

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert differences(spark, connect(FOLDER), queries.QUERIES[name], queries.SQL[name], FOLDER) is None


# -- archives -------------------------------------------------------------------------------------


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_are_found_by_length(version):
    payloads = [b"", b"x\n\r\n\r\ny\n", b"http://fake 0.0.0.0 2020 text/html 5\nhello", "é日".encode()]
    data = archives.arc_opening(version, "a.arc", "20200101000000")
    for i, p in enumerate(payloads):
        data += archives.arc_record(version, len(data), "a.arc", "20200101000000", i or None, "http://a b", p)
    found = list(archives.arc_captures(data))
    assert [c.payload for c in found] == payloads and [c.row_id for c in found] == [None, 1, 2, 3]
    assert {(c.url, c.status) for c in found} == {("http://a%20b", "200")}
    warc = list(archives.warc_records(archives.warc_of("a.arc", data, {})))
    assert len(warc) == 5 and [b.partition(b"\r\n\r\n")[2] for _, b in warc[1:]] == payloads


def test_arc_with_a_wrong_length_or_version_is_an_error():
    good = archives.arc_opening(1, "a", "20200101000000")
    with pytest.raises(ValueError, match="declares"):
        list(archives.arc_captures(good + b"http://x 0.0.0.0 20200101000000 text/html 50\nshort"))
    with pytest.raises(ValueError, match="fields"):
        list(archives.arc_captures(good + b"http://x text/html 5\nshort"))
    with pytest.raises(ValueError, match="version 7"):
        list(archives.arc_captures(good.replace(b"\n1 0", b"\n7 0")))


def test_archive_round_trip_of_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 400)
    long = "<p>" + "long text " * 50_000
    rows = [(3, "u", "<p>a", 1), (1, None, "<p>a", 2), (2, "u v", None, 3), (5, "u", "", 4), (None, "u", "<p>a", 5), (1, "u", "<p>a", 6), (7, "u", long, 7), (8, "u", "\r\n\r\n\n", 8)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, offset int").repartition(2)
    got = archives.archive_pages(table, scratch_path(spark, "test")).collect()
    assert len(got) == len(rows)
    want = {i: (html or "").encode() for i, _, html, _ in rows}
    for r in got:
        body = want[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert r.payload == (body if r.record_type == "response" else None)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=repr)
    assert kinds == sorted(
        [(1, "response", None), (1, "revisit", 1), (3, "revisit", 1), (None, "revisit", 1), (2, "response", None), (5, "revisit", 2), (7, "response", None), (8, "response", None)],
        key=repr,
    )
    assert archives.archive_pages(table.limit(0), scratch_path(spark, "test")).collect() == []


def test_short_payloads_can_be_left_alone(spark):
    path = scratch_path(spark, "test")
    table = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    archives.write_arc(table, f"{path}/arc", "20200101000000", "page_id", "url", "html")
    archives.convert(archives.load_archives(table, f"{path}/arc"), f"{path}/warc", revisit_from=3)
    got = {r.page_id: r.record_type for r in archives.read_warc(archives.load_archives(table, f"{path}/warc")).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


# -- nearest neighbours ---------------------------------------------------------------------------


def brute_nearest(rows, every, k):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for query in sorted({i for i, _ in usable if i % every == 0}):
        own = min(v for i, v in usable if i == query)
        scored = sorted((math.dist(own, v), i) for i, v in usable if i != query and len(v) == len(own))
        out += [(query, rank, i, round(d, 9)) for rank, (d, i) in enumerate(scored[:k], 1)]
    return out


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "TILE_BYTES", 3000)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 7)
    pick = random.Random(6)
    rows = [(i, [float(pick.choice([0, 1, pick.gauss(0, 1)])) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, [1.0] * 8) for i in range(60)]  # ties
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] * 4), (304, [math.nan] * 8), (305, [math.inf] * 8), (None, [1.0] * 8)]
    rows += [(306, [1.0, 2.0]), (310, [2.0, 2.0]), (20, [9.0] * 8), (5, rows[5][1]), (400, [1e6] * 8), (410, [1e-9] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(4)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest.nearest(table, 10, 7).collect())
    assert got == brute_nearest(rows, 10, 7)
    assert nearest.nearest(table.limit(0), 10).collect() == []
    assert nearest.nearest(table.where("vec_id = 20"), 10).collect() == []


# -- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "decontaminate", "surrogates", "bpe"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first().text
    extra = [
        (100_001, "1234 ... !!", "en", "s", 11), (100_002, None, None, None, None),
        (100_003, f"Before it. {item} Behind it.", "en", "s", 9), (100_004, "Write to some.one@mail.example.com today", "en", "s", 9),
        (100_005, "Write to some.one@mail.example.com today", "en", "s", 9),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("row", F.lit(1))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, FOLDER).write.parquet(path)
        columns, docs = docs.columns, spark.read.parquet(path)
        if name != "bpe":
            assert docs.columns == columns
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    gone = [before - after for before, after in zip([{*seen[0], 100_001, 100_002}, *seen], seen)]
    assert {100_001, 100_002} <= gone[0] and 100_005 in gone[1] and 100_003 in gone[2] and 100_004 in seen[-1]
    assert seen[2] == seen[3] == seen[4]


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < rows.count() <= 200
