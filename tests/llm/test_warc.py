"""Archives against DuckDB, real files, and hostile payloads."""

import hashlib

import duckdb
import pytest

from ferrywright.llm import common, warc


def test_table(spark, data):
    pages = common.table(spark, data, "pages")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{data}/pages.parquet'")
    got = warc.archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.execute(warc.ORACLE_SQL).fetchall(), key=str)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_edge_rows_and_small_splits(spark, compression):
    big = "<p>" + "é漢 long " * 60000 + "</p>"
    trap = "\r\n\r\nWARC/1.1\r\nWARC-Record-ID: <urn:uuid:00000000-0000-0000-0000-000000000000>\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3
    html = [None, "", "short", "short", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "y" * 100, big, big, trap, trap, "\r\n" * 80, "z" * 200, "z" * 200]
    ids = [1, 2, 3, 4, 5, 6, 9, 8, 9, 10, 11, 12, 13, 14, None, None]
    rows = [(i, None if n % 3 == 0 else f"http://h/{n}\r\nX: y é", h, "response", 0) for n, (i, h) in enumerate(zip(ids, html, strict=True))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string, digest int").repartition(3)
    with common.settings(spark, spark__sql__files__maxPartitionBytes="7001", spark__sql__files__openCostInBytes="1"):
        got = sorted(map(tuple, warc.archive_pages(pages, compression=compression).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    want = []
    groups = {}
    for i, h in zip(ids, html, strict=True):
        groups.setdefault((h or "").encode(), []).append(i)
    for payload, members in groups.items():
        members = sorted(members, key=lambda i: (i is None, i))
        for n, i in enumerate(members):
            revisit = len(payload) >= 100 and n > 0
            want.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", members[0] if revisit else None))
    assert got == sorted(want, key=str)
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_files_are_plain_warc(spark):
    path = common.new_path(spark, "plain-warc")
    pages = spark.createDataFrame([(1, "http://a/", "p" * 150), (2, "http://b/", "p" * 150)], "page_id long, url string, html string").coalesce(1)
    warc.write_archive(pages, path, compression="none")
    data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).collect())
    kinds = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n")
        n = int(fields[b"Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        kinds.append((fields[b"WARC-Type"], fields[b"WARC-Target-URI"], n))
        data = rest[n + 4 :]
    assert [k[0] for k in kinds] == [b"response", b"revisit"] and kinds[0][2] - kinds[1][2] == 150


@pytest.mark.parametrize("shape", ["repartition", "join", "union", "numbered"])
def test_derived_frames_keep_their_payloads(spark, data, shape):
    con = duckdb.connect()
    con.execute(f"create view p as select * from '{data}/pages.parquet'")
    con.execute("create view pages as select * from p union all select page_id + 1000000, url, html from p")
    scan = common.table(spark, data, "pages")
    both = scan.unionByName(scan.withColumn("page_id", scan.page_id + 1000000))
    if shape == "repartition":
        pages = both.repartition(16)
    elif shape == "join":
        pages = both.join(spark.range(2).selectExpr("id * 0 as x").distinct(), both.page_id >= 0)
    elif shape == "union":
        pages = both
    else:
        pages = both.withColumns({"f": both.page_id % 3, "r": both.page_id}).repartition(7)
    got = warc.archive_pages(pages, place=("f", "r") if shape == "numbered" else None)
    got = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.execute(warc.ORACLE_SQL).fetchall(), key=str)
