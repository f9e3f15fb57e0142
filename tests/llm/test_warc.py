import gzip
import os

from pickwise.llm import warc


def _write(spark, tmp_dir, rows):
    path = os.path.join(tmp_dir, f"w{len(os.listdir(tmp_dir))}")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "'k' as sha")
    warc.write_warc(warc.with_revisits(pages, "page_id", "html", "url"), path)
    return path


ROWS = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, "http://b", ""), (4, None, None),
        (5, "http://c", "x\r\n\r\nWARC/1.1\r\n\r\n" * 3000), (6, "http://d", "y" * 3_000_000), (9, "http://a/3", "<p>é</p>"),
        (9, "http://a/3", "<p>é</p>"), (None, "http://e", "<p>é</p>")]


def test_round_trip_and_revisits(spark, tmp_dir):
    rows = warc.read_warc(spark, _write(spark, tmp_dir, ROWS)).collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r["record_id"], []).append(r)
    html = {f"{warc.ID_PREFIX}{i}" if i else None: (h or "").encode() for i, _, h in ROWS}
    for name, found in by.items():
        for r in found:
            assert r["payload_bytes"] == len(html[name]) and r["payload_digest"] == warc.digest(html[name])
            if r["record_type"] == "response":
                assert bytes(r["payload"]) == html[name] and r["refers_to"] is None
    kinds = {k: [r["record_type"] for r in v] for k, v in by.items()}
    assert kinds[f"{warc.ID_PREFIX}1"] == kinds[f"{warc.ID_PREFIX}2"] == kinds[None] == ["revisit"]
    assert kinds[f"{warc.ID_PREFIX}9"] == ["response"] * 2
    assert by[f"{warc.ID_PREFIX}3"][0]["refers_to"] == f"{warc.ID_PREFIX}4"


def test_predicates_are_pushed_and_payloads_skipped(spark, tmp_dir):
    df = warc.read_warc(spark, _write(spark, tmp_dir, ROWS))
    revisits = df.filter("record_type = 'revisit' and target_uri like 'http://a%'").select("record_id", "payload_bytes")
    assert sorted(r["record_id"] for r in revisits.collect()) == [f"{warc.ID_PREFIX}{i}" for i in (1, 2)]
    assert df.filter("record_type in ('response', 'x') and payload_bytes > 10").count() == 2
    reader = warc.WarcReader({"path": "x"}, df.schema)
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 10)]))
    assert len(left) == 1 and reader.wanted({"record_type": "revisit"}) and not reader.wanted({"record_type": "response"})


def test_foreign_archive_plain_and_gzipped(spark, tmp_dir):
    def record(kind, body, ctype):
        return (f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <urn:x:{len(body)}>\r\nContent-Type: {ctype}\r\n"
                f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    data = [record("warcinfo", b"software: x\r\n", "application/warc-fields"),
            record("response", b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\nbody", "application/http; msgtype=response")]
    for name, blob in (("a.warc", b"".join(data)), ("b.warc.gz", b"".join(map(gzip.compress, data)))):
        path = os.path.join(tmp_dir, name)
        with open(path, "wb") as f:
            f.write(blob)
        rows = {r["record_type"]: bytes(r["payload"]) for r in warc.read_warc(spark, path).collect()}
        assert rows == {"warcinfo": b"software: x\r\n", "response": b"body"}


def test_min_bytes_and_empty_table(spark, tmp_dir):
    pages = spark.createDataFrame([(1, "a"), (2, "a"), (3, "long text"), (4, "long text")], "page_id long, html string")
    kinds = {r["record_id"][-1]: r["record_type"] for r in warc.with_revisits(pages, "page_id", "html", min_bytes=5).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "revisit", "4": "response"}
    assert warc.read_warc(spark, _write(spark, tmp_dir, [])).count() == 0


def test_line_breaks_in_headers_come_back(spark, tmp_dir):
    odd = ["http://a/\r\n\r\nx", "http://b/%0D%0A?q=1%20", " blank\t", "<angle>", "tab\there", "", None, "http://é/ü", "x\u2028y\x85z"]
    rows = [(f"id {k}\r\n{k}" if k % 2 else f"<{k}>", "response", u, None, None, None, b"body %d" % k) for k, u in enumerate(odd)]
    rows.append(("back", "revisit", "http://c/", "id 1\r\n1", "A" * 32, 6, None))
    warc.write_warc(spark.createDataFrame(rows, warc.SCHEMA).repartition(2), f"{tmp_dir}/w")
    got = {r["record_id"]: (r["target_uri"], r["refers_to"], r["payload"]) for r in warc.read_warc(spark, f"{tmp_dir}/w").collect()}
    assert got == {i: (u or "", ref, bytearray(body) if body else None) for i, _, u, ref, _, _, body in rows}
