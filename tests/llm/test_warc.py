import gzip
import hashlib
import io

import pytest

from sojourn.llm import warc as W
from sojourn.session import shared_dir
from tests.harness import compare, duck

BIG = "<p>é" * 2000
ROWS = [(1, "http://a b/\r\nx", BIG), (2, None, BIG), (3, "u", None), (4, "u", ""), (None, "u", BIG), (2, "q", BIG), (5, "http://é", "x\r\n\r\nWARC/1.1 y"), (6, "u", "s" * 999), (7, "u", "s" * 999), (8, "", "t" * 1000), (9, "", "t" * 1000)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string").repartition(2)


@pytest.mark.parametrize("size", [7, 1000, 1 << 20])
def test_round_trip(spark, size):
    manifest = W.write(W.chunk_rows(W.records(pages(spark)), size), shared_dir(spark, "warc-test"))
    assert manifest.selectExpr("sum(records)").first()[0] == len(ROWS)
    chunks = W.read(manifest, size, with_data=True).collect()
    parts = {}
    for c in chunks:
        assert c.n_bytes == len(c.data) <= size
        if c.record_type == "response":
            parts.setdefault((c.page_id, c.url, c.declared), []).append(c)
    for (page_id, _, declared), cs in parts.items():
        data = b""
        for c in sorted(cs, key=lambda c: (c.chunk)):
            assert c.offset == len(data)
            data += c.data
            assert c.digest == hashlib.sha1(data).hexdigest()
        assert declared == hashlib.sha1(data).hexdigest() and c.last
        assert data.decode() in {h or "" for i, _, h in ROWS if i == page_id}
    got = sorted(map(repr, W.payloads(W.read(manifest, size)).collect()))
    top = {h: max(i or -1 for i, _, x in ROWS if x == h) for _, _, h in ROWS}
    want = []
    for i, _, h in ROWS:
        data = (h or "").encode()
        again = len(data) >= 1000 and (i or -1) < top[h]
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top[h] if again else None))
    assert got == sorted(f"Row(page_id={a!r}, payload_bytes={b!r}, payload_digest={c!r}, record_type={d!r}, refers_to={e!r})" for a, b, c, d, e in want)


def test_archives_are_gzip_members_of_warc_records(spark):
    manifest = W.write(W.chunk_rows(W.records(pages(spark, [(1, "http://x/", "abc")]))), shared_dir(spark, "warc-test"))
    path = [r.path for r in manifest.collect() if r.records][0].removeprefix("file:").replace("///", "/")
    text = gzip.open(path).read()
    head, http, body = text.split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"WARC-Target-URI: http://x/" in head
    assert body == b"abc\r\n\r\n" and f"Content-Length: {len(http) + 4 + 3}".encode() in head


def test_a_cut_archive_raises():
    whole = W._head(1, "u", hashlib.sha1(b"abc").hexdigest(), None, 3) + b"abc\r\n\r\n"
    assert [r[-1] for r in W.parse(io.BytesIO(whole), 2)] == [b"ab", b"c"]
    with pytest.raises(EOFError):
        list(W.parse(io.BytesIO(whole[:-6]), 2))


def test_files_roll_over(spark, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 100)
    manifest = W.write(W.chunk_rows(W.records(pages(spark).coalesce(1))), shared_dir(spark, "warc-test"))
    assert manifest.count() > 3
    assert W.payloads(W.read(manifest)).count() == len(ROWS)


def test_empty_table_and_oracle(spark):
    assert W.payloads(W.read(W.write(W.chunk_rows(W.records(pages(spark).limit(0))), shared_dir(spark, "warc-test")))).count() == 0
    ok, message = compare(W.op1_chunked_warc(spark, "/root/testdata/sf0.001"), duck("/root/testdata/sf0.001"), W.ORACLE)
    assert ok, message


def test_a_digest_of_most_pages_is_spread(spark, monkeypatch):
    """80 % of the pages share one payload: the joins on its digest have no task over twice the mean, and the result is that of plain code."""
    monkeypatch.setattr(W, "HOT", 1000)
    n, conf = 20_000, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = W.stage_table(spark.range(n).repartition(8).selectExpr("id AS page_id", "CASE WHEN id % 5 < 4 THEN 'hot' ELSE concat('d', id % 1000) END AS digest"), "hot-test")
        unique = rows.groupBy("digest").agg(W.F.max("page_id").alias("refers_to"))
        met = W.meet_unique(rows, unique, ["digest"])
        tasks = [r["count"] for r in met.where("digest = 'hot'").groupBy(W.F.spark_partition_id().alias("p")).count().collect()]
        assert sum(tasks) == n * 4 // 5 and max(tasks) <= 2 * n / 8
        top = {"hot": n - 2} | {f"d{k % 1000}": k for k in range(n) if k % 5 == 4}
        assert sorted(map(tuple, met.select("page_id", "refers_to").collect())) == [(k, top["hot" if k % 5 < 4 else f"d{k % 1000}"]) for k in range(n)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_most_pages_are_revisits(spark, monkeypatch):
    monkeypatch.setattr(W, "HOT", 50)
    html = {k: ("a hot page" if k % 5 else f"page {k}") * 300 for k in range(500)}
    table = spark.createDataFrame([(k, "u", h, "d") for k, h in html.items()], "page_id long, url string, html string, digest string")
    got = W.payloads(W.read(W.write(W.chunk_rows(W.records(table), 100), shared_dir(spark, "warc-test")), 100)).collect()
    want = [(k, len(h), hashlib.sha1(h.encode()).hexdigest(), *(("revisit", 499) if k % 5 and k < 499 else ("response", None))) for k, h in html.items()]
    assert sorted(map(tuple, got)) == [w for w in want]


def test_a_large_payload_moves_in_chunks(spark):
    size = 64 << 20
    table = spark.range(1).selectExpr("1L AS page_id", "'u' AS url", f"repeat(concat('0123456789abcde', id), {size // 16}) AS html")
    table = W.stage_table(table, "large-test")
    got = W.payloads(W.read(W.write(W.chunk_rows(W.records(table)), shared_dir(spark, "warc-test")))).collect()
    assert [tuple(r) for r in got] == [(1, size, hashlib.sha1(b"0123456789abcde0" * (size // 16)).hexdigest(), "response", None)]
