import base64
import hashlib

from transpark.llm import warc


def test_round_trip_with_magic_and_ties(spark, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    html = {
        0: "<p>one</p>", 1: "<p>one</p>", 2: None, 3: "", 4: "x" + fake + fake + "tail\r\n\r\n", 5: fake, 6: "é\r\n\r\nWARC/1.1\r\n",
        7: "long " * 40000, 8: "x" + fake + fake + "tail\r\n\r\n", 9: "WARC/1.1\r\n",
    }
    rows = [(k, f"http://h/{k} \r\nx", v, "clash") for k, v in html.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(2)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "1000b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = {int(r.page): r for r in warc.read_archives(spark, path).collect()}
        assert sorted(got) == sorted(html)
        for k, v in html.items():
            data = (v or "").encode()
            first = min(i for i, w in html.items() if (w or "") == (v or ""))
            r = got[k]
            assert r.intact and r.payload_bytes == len(data) and r.digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert (r.record_type, r.refers_to) == (("response", None) if k == first else ("revisit", str(first))) or (k == first and not r.refers_to)
        texts = {int(r.page): bytes(r.payload) for r in warc.read_payloads(spark, path).collect()}
        assert texts == {k: (v or "").encode() for k, v in html.items() if got[k].record_type == "response"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_empty_table_and_false_chains(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0
    links = [("a", 0, 10), ("a", 4, 10), ("a", 10, 25), ("a", 15, 25), ("a", 25, 40), ("a", 30, 35), ("a", 35, 99), ("a", 40, None), ("b", 3, 9), ("b", 9, 12)]
    got = warc.reachable(spark.createDataFrame(links, "file string, start long, next long")).collect()
    assert sorted(tuple(r) for r in got) == [("a", 0), ("a", 10), ("a", 25), ("a", 40)]


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_splits_may_change_between_reads(spark, tmp_path, monkeypatch):
    """400 payloads quote magic lines; the read that fetches them again is split in another way."""
    monkeypatch.setattr(warc, "STRETCH", 5000)  # many stretches in a file
    fake = "WARC/1.1\r\nContent-Length: %d\r\n\r\nabcd\r\n\r\n"
    html = {i: f"page {i} " + fake % (4 if i % 3 else 10**6 + i) * (i % 4) + "\r\n\r\ntail" for i in range(400)}
    pages = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in html.items()], "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "s")
    warc.write_archives(pages, path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        found, payloads = warc.read_archives(spark, path), warc.read_payloads(spark, path)
        for size in ("3000b", "50000b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {int(r.page): r for r in found.select("*").collect()}
            assert len(got) == 400 and all(r.intact and r.digest == sha1(html[i].encode()) for i, r in got.items())
            assert {int(r.page): bytes(r.payload).decode() for r in payloads.select("*").collect()} == html
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_null_and_repeated_ids_and_null_urls(spark, tmp_path):
    rows = [(1, None, "same"), (1, "u", "same"), (2, "v", "same"), (None, None, "same"), (3, None, None), (3, "x", "other"), (None, "y", "lone")]
    path = str(tmp_path / "n")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = sorted((r.page, r.target or "", r.record_type, r.refers_to or "", r.payload_bytes) for r in warc.read_archives(spark, path).collect())
    assert got == sorted([
        ("1", "", "response", "", 4), ("1", "u", "response", "", 4), ("2", "v", "revisit", "1", 4), ("", "", "response", "", 4),
        ("3", "", "response", "", 0), ("3", "x", "response", "", 5), ("", "y", "response", "", 4),
    ])
