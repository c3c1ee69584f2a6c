import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import warc as w


def row(**over):
    base = dict(
        record_id="<urn:page:1>", record_type="response", target_uri="http://a/", warc_date="2024-01-01T00:00:00Z", refers_to=None,
        payload_digest=hashlib.sha1(b"body").hexdigest(), payload_bytes=4, content_type="text/html", payload=b"body",
    )
    return {**base, **over}


def plain(*rows):
    return b"".join(w.encode_record(r) for r in rows)


def test_a_record_is_a_standard_gzip_member():
    data = w.encode_record(row())
    assert gzip.decompress(w.gzip_member(data)) == data
    head = data.split(b"\r\n\r\n")[0].decode()
    assert head.startswith("WARC/1.1\r\nWARC-Type: response") and "WARC-Payload-Digest: sha1:" in head


@pytest.mark.parametrize("packed", ["plain", "members", "foreign"])
def test_archives_of_any_packing_are_read(packed):
    rows = [row(record_id=f"<urn:page:{i}>", payload=b"x\r\n\r\ny" * i * 3000, payload_bytes=18000 * i) for i in range(4)]
    make = {"plain": lambda d: d, "members": w.gzip_member, "foreign": gzip.compress}[packed]
    source = io.BytesIO(b"".join(make(w.encode_record(r)) for r in rows))
    got = [w.row_of(r, "f", True) for r in w.records(source)]
    assert [g["payload"] for g in got] == [r["payload"] for r in rows]
    source.seek(0)
    some = list(w.records(source, lambda h: h["warc-record-id"] == "<urn:page:2>", payload=False))
    assert len(some) == 1 and w.row_of(some[0], "f", False)["payload_bytes"] == 36000


def test_unwanted_payloads_are_not_inflated(monkeypatch):
    big = w.gzip_member(w.encode_record(row(payload=bytes(range(256)) * 4000, payload_bytes=1_024_000)))
    source = io.BytesIO(big * 3)
    inflated = []
    real = w._Member.read
    monkeypatch.setattr(w._Member, "read", lambda self, n: inflated.append(n) or real(self, n))
    assert list(w.records(source, lambda h: False)) == []
    assert sum(inflated) < 20_000


def test_line_breaks_and_missing_headers():
    data = w.encode_record(row(target_uri="http://a/\r\nWARC-Type: x", warc_date=None, payload=None, payload_bytes=0))
    got = [w.row_of(r, "f", True) for r in w.records(io.BytesIO(data))]
    assert got[0]["target_uri"] == "http://a/%0D%0AWARC-Type: x" and got[0]["warc_date"] is None and got[0]["payload"] == b""
    with pytest.raises(ValueError):
        w.encode_record(row(record_type="else"))


PAGES = [
    (1, "http://a/1", "x" * 1000),
    (2, "http://a/2", "x" * 1000),
    (3, "http://a/3", "x" * 999),
    (4, None, "x" * 999),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (7, "http://ü/7", "é" * 500),
    (9, "http://a/9", "é" * 500),
    (8, "http://a/8", "é" * 500),
    (10, "http://a/10", "long " * 60_000),
    (9, "http://a/9", "é" * 500),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "d", 1) for p in PAGES], "page_id bigint, url string, html string, payload string, k int")


def test_round_trip_of_pages(spark, pages, tmp_path):
    folder = str(tmp_path / "archive")
    w.write_warc(w.page_records(pages.repartition(3), "2024-01-01T00:00:00Z"), folder)
    got = w.read_warc(spark, folder).withColumns({"page": w.page_key("record_id"), "to": w.page_key("refers_to")}).collect()
    assert len(got) == len(PAGES)
    html = {i: (t or "").encode() for i, _, t in PAGES}
    newest = {}
    for i, t in html.items():
        newest[t] = max(i, newest.get(t, 0))
    for r in got:
        content = html[r.page]
        again = len(content) >= 1000 and newest[content] != r.page
        assert r.record_type == ("revisit" if again else "response")
        assert r.to == (newest[content] if again else None)
        assert r.payload_digest == hashlib.sha1(content).hexdigest() and r.payload_bytes == len(content)
        assert (r.payload is None) if again else (bytes(r.payload) == content)
    assert {(r.page, r.target_uri) for r in got} == {(i, u) for i, u, _ in PAGES}


def test_predicates_reach_the_parser(spark, pages, tmp_path):
    folder = str(tmp_path / "archive")
    w.write_warc(w.page_records(pages, "2024-01-01T00:00:00Z"), folder)
    some = w.read_warc(spark, folder, payload=False).filter(
        (F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://a/")
    )
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan or "record_type" not in plan.split("Filter (")[1].split("\n")[0]
    assert sorted(r.target_uri for r in some.collect()) == ["http://a/1", "http://a/8"]


def test_only_committed_files_count(spark, pages, tmp_path):
    folder = tmp_path / "archive"
    w.write_warc(w.page_records(pages, "2024-01-01T00:00:00Z"), str(folder))
    (folder / "part-lost.warc.gz").write_bytes(w.gzip_member(w.encode_record(row())))
    assert w.read_warc(spark, str(folder)).count() == len(PAGES)


def test_a_folder_without_manifest_and_an_empty_table(spark, pages, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.warc").write_bytes(plain(row(), row(record_type="metadata", content_type="text/plain")))
    assert sorted(r.record_type for r in w.read_warc(spark, str(tmp_path / "one")).collect()) == ["metadata", "response"]
    w.write_warc(w.page_records(pages.limit(0), "2024-01-01T00:00:00Z"), str(tmp_path / "none"))
    assert w.read_warc(spark, str(tmp_path / "none")).collect() == []
