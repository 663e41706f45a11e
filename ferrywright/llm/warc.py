"""WARC archives: writing with revisit records, and reading back (operator 1).

Records are written by Spark's own text writer, one line per record, with the two
line breaks that end a WARC record as the line separator, so the files are plain
WARC/1.1 on any store. They are read with a separator too: the version line and
the start of the record id, which holds a random number of this archive, so that no
payload is taken for a header; Content-Length delimits the block.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 100
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"


def _lines(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _separator(nonce: str) -> str:
    return f"{CRLF}{CRLF}WARC/1.1{CRLF}WARC-Record-ID: <urn:x-archive:{nonce}-"


def numbered(pages: DataFrame, place: tuple[str, str] | None = None) -> DataFrame:
    """``(file, row, page_id, url, html)``: file and row tell a row from all others whenever the table is read.

    ``place`` names two long columns of that kind; without it the rows are numbered and staged.
    """
    if place:
        return common.pick(pages, page_id="page_id", url="url", html="html", file=place[0], row=place[1])
    slim = common.pick(pages, page_id="page_id", url="url", html="html")
    return common.stage(slim.withColumns({"file": F.lit(0).cast("long"), "row": F.monotonically_increasing_id()}), "pages")


def records(pages: DataFrame) -> DataFrame:
    """``(key, page_id, url, payload, digest, bytes)`` of numbered pages; key is a struct of file and row."""
    return pages.select(
        F.struct("file", "row").alias("key"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), common.text_or_empty("html").alias("payload")
    ).withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "bytes": F.octet_length("payload").cast("long")})


def revisits(heads: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(key, first)`` of each record that is a revisit; first is the key of the response.

    Of records with equal payloads that with the smallest page_id is the response, nulls
    last, then that with the smallest key. Headers alone are shuffled, by payload
    digest; each task sends one row per digest for the choice.
    """
    large = heads.where(F.col("bytes") >= min_bytes)
    first = F.min(F.struct(F.col("page_id").isNull().alias("n"), F.col("page_id").alias("page_id"), F.col("key").alias("key")))
    firsts = large.groupBy("digest").agg(first.alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", F.col("f.key").alias("first"))
    return large.select("key", "digest").join(firsts, "digest").where("key <> first").select("key", "first")


def write_archive(pages: DataFrame, path: str, warc_date: str = "1970-01-01T00:00:00Z", min_bytes: int = MIN_REVISIT_BYTES, compression: str = "gzip", place: tuple[str, str] | None = None) -> str:
    """Write one record per page to WARC files at ``path``; returns the archive's number, which reading needs.

    Responses carry an HTTP head and the payload, revisits the head alone, the
    digest and the id of the response they refer to. All headers are fresh. Control
    characters and spaces of a url are percent-coded; a null url is left out. Files
    are gzipped unless ``compression`` says "none", by which they can be split on reading.
    """
    nonce = uuid.uuid4().hex[:16]
    nonce = f"{nonce[:8]}-{nonce[8:12]}-{nonce[12:]}"
    rows = records(numbered(pages, place))
    heads = common.stage(rows.select("key", "page_id", "digest", "bytes"), "warc-headers")
    # Payloads move by their own number, so that equal ones do not meet in one task.
    told = rows.join(revisits(heads, min_bytes), "key", "left")
    revisit = F.col("first").isNotNull()
    ident = lambda key: F.concat(F.lpad(F.lower(F.hex(key["file"])), 16, "0"), F.lit("-"), F.lower(F.hex(key["row"])))
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]+", "%20")
    http = _lines(HTTP_HEAD, "Content-Length: ", F.col("bytes").cast("string"), CRLF + CRLF)
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = _lines(
        "WARC/1.1", CRLF, f"WARC-Record-ID: <urn:x-archive:{nonce}-", ident(F.col("key")), ">", CRLF,
        "WARC-Type: ", F.when(revisit, "revisit").otherwise("response"), CRLF,
        F.coalesce(_lines("WARC-Target-URI: ", url, CRLF), F.lit("")),
        "WARC-Date: ", warc_date, CRLF,
        F.coalesce(_lines("X-Page-ID: ", F.col("page_id").cast("string"), CRLF), F.lit("")),
        "WARC-Payload-Digest: sha256:", F.col("digest"), CRLF,
        F.when(revisit, _lines("WARC-Profile: ", PROFILE, CRLF, f"WARC-Refers-To: <urn:x-archive:{nonce}-", ident(F.col("first")), ">", CRLF)).otherwise(""),
        "Content-Type: application/http; msgtype=response", CRLF,
        "Content-Length: ", F.octet_length(block).cast("string"), CRLF, CRLF, block,
    )
    with common.settings(pages.sparkSession, **{common.CLEANUP: "true"}):
        told.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)
    return nonce


def read_archive(spark: SparkSession, path: str, nonce: str) -> DataFrame:
    """The records at ``path``: ``(record_id, record_type, page_id, url, digest, refers_to_id, payload)``; payload is binary."""
    raw = spark.read.option("lineSep", _separator(nonce)).text(path)
    # A file's first record has its whole head, the others lack what the separator took.
    start = f"WARC/1.1{CRLF}WARC-Record-ID: <urn:x-archive:{nonce}-"
    body = F.when(F.col("value").startswith(start), F.substr("value", F.lit(len(start) + 1))).otherwise(F.col("value"))
    head = F.substring_index("body", CRLF + CRLF, 1)
    field = lambda name: F.regexp_extract("head", rf"\r\n{name}: ([^\r]*)", 1)
    parsed = raw.select(body.alias("body")).select(F.col("body").cast("binary").alias("raw"), head.alias("head")).withColumns(
        {"record_id": F.substring_index("head", ">", 1), "length": field("Content-Length").cast("long"), "block_at": F.octet_length("head") + 5}
    )
    block = F.col("raw").substr(F.col("block_at"), F.col("length").cast("int"))
    parsed = parsed.withColumn("block", block)
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), CRLF + CRLF, 1)) + 5
    return parsed.select(
        "record_id", field("WARC-Type").alias("record_type"), F.nullif(field("X-Page-ID"), F.lit("")).cast("long").alias("page_id"), F.nullif(field("WARC-Target-URI"), F.lit("")).alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("digest"), F.nullif(F.regexp_extract("head", rf"\r\nWARC-Refers-To: <urn:x-archive:{nonce}-([^>]*)>", 1), F.lit("")).alias("refers_to_id"),
        F.col("block").substr(http, F.greatest(F.lit(0), F.col("length") - http + 1).cast("int")).alias("payload"),
    )


def resolve_revisits(archive: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per record.

    Bytes and digest are computed from the payloads read; revisits take them from
    the response they refer to, by a join of slim heads on the record id.
    """
    slim = common.stage(
        archive.select("record_id", "record_type", "page_id", "refers_to_id", F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("digest")), "warc-heads"
    )
    own = slim.where("record_type = 'response'").select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    target = slim.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("page_id").alias("refers_to"))
    again = slim.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to_id").join(target, "refers_to_id", "left")
    return own.unionByName(again.drop("refers_to_id"))


def archive_pages(pages: DataFrame, path: str | None = None, compression: str = "gzip", place: tuple[str, str] | None = None) -> DataFrame:
    """Write ``pages`` as deduplicated WARC files (at a scratch path if None), read them back and resolve revisits.

    A null html is an empty payload. Rows without a page_id come last when a
    response is chosen; of repeated rows one is the response. An empty table
    gives no row. Extra columns are ignored. ``place`` names two long columns that
    together tell a row from all others; without it the rows are numbered and staged
    first, whatever they come from, so that the choice and the files see the same numbers.
    """
    spark = pages.sparkSession
    path = path or common.new_path(spark, "warc")
    nonce = write_archive(pages, path, compression=compression, place=place)
    return resolve_revisits(read_archive(spark, path, nonce))


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of ``pages`` through a WARC archive and back."""
    return archive_pages(common.with_file_rows(common.table(spark, sf_dir, "pages"), "_file", "_row"), place=("_file", "_row"))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM g
"""
