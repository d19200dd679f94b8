"""WARC archives: write, read back, and resolve revisits.

Records are written and read by Spark's own text source, so archives can stand in any store Spark
reaches and a lost task is written again. The record terminator of the format (two CRLFs) is the
writer's line separator. Every record of one set of archives starts with the same two lines, the
version and a ``WARC-Warcinfo-ID`` drawn anew for the set; these lines are the reader's separator, as
no payload written before can hold that id. Archives are gzip files, which aren't split: a task reads one
as a stream and holds one record of it at a time, so the size of an archive is that of a writer's task.

Revisits: records are read as headers only and meet by payload digest (counted on the map side, so
copies by the third of a crawl fill no task). The digests with more than one record, and the record
that stays the response, are written as a small table; the archives are read again and written with
fresh headers, payloads staying where they are: with that table small, Spark broadcasts it by its size,
otherwise it joins on the digest and splits hot ones.

Defined cases: a null html is an empty payload; a null url is left out; control characters, spaces and
``<>`` in a url are percent-encoded; a null page_id counts as smaller than any other and is written
as an empty one; of equal rows one is the response; no rows give no archives and no rows; extra
columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import materialise
from tickerloom.session import scratch_dir

EOL = "\r\n"
END = EOL + EOL
# The format's version line, the base 32 alphabet, the profile of equal payloads.
VERSION = "WARC/1.1"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:x-page:"

c = F.col


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1: 160 bits as 8 groups of 20 bits, 4 digits each."""
    digest = F.sha1(payload.cast("binary"))
    digits = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        digits += [F.substr(F.lit(BASE32), F.shiftright(bits, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1)) for i in range(4)]
    return F.concat(*digits)


def _line(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL)), F.lit(""))


def _uri(url: Column) -> Column:
    """``url`` without what could end a header line or a <..> value."""
    for bad, good in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("<", "%3C"), (">", "%3E")):
        url = F.replace(url, F.lit(bad), F.lit(good))
    return F.regexp_replace(url, r"[\x00-\x1f\x7f]", "%00")


def _write(records: DataFrame, path: str) -> str:
    """Write the (head, payload) of ``records``; returns the id that separates them."""
    info = f"<urn:uuid:{uuid.uuid4()}>"
    date = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    start = f"{VERSION}{EOL}WARC-Warcinfo-ID: {info}{EOL}"
    body = F.concat(F.lit(start), _line("WARC-Date", date), c("head"), _line("Content-Length", F.octet_length("payload")), F.lit(EOL), c("payload"))

    records.select(body).write.option("lineSep", END).option("compression", "gzip").text(path)
    return info


def write_pages(pages: DataFrame, path: str) -> str:
    """One response record per page, its payload the html in UTF-8; returns the archives' separator id."""
    payload = F.coalesce(c("html"), F.lit(""))
    name = F.concat_ws(":", F.coalesce(c("page_id").cast("string"), F.lit("")), F.monotonically_increasing_id().cast("string"))
    head = F.concat(
        _line("WARC-Type", F.lit("response")),
        _line("WARC-Record-ID", F.concat(F.lit(f"<{RECORD}"), name, F.lit(">"))),
        _line("WARC-Target-URI", _uri(c("url"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(payload))),
        _line("X-Payload-Length", F.octet_length(payload)),
    )
    return _write(pages.select(head.alias("head"), payload.alias("payload")), path)


def read_records(spark: SparkSession, path: str, info: str) -> DataFrame:
    """Per record: headers (map), payload, and from the headers page_id, row, digest, payload_bytes, type, refers_to."""
    lines = spark.read.option("lineSep", f"{VERSION}{EOL}WARC-Warcinfo-ID: {info}{EOL}").text(path).filter(c("value") != "")
    head = F.substring_index("value", END, 1)
    whole = F.length("value")
    payload = F.substr("value", F.length(head) + F.lit(len(END) + 1), whole - F.length(head) - F.lit(2 * len(END)))
    pairs = F.transform(F.split(head, EOL), lambda x: F.struct(F.substring_index(x, ": ", 1), F.substr(x, F.instr(x, ": ") + 2)))
    rows = lines.select(F.map_from_entries(pairs).alias("headers"), payload.alias("payload"))
    named = F.split(F.regexp_extract(c("headers")["WARC-Record-ID"], f"<{RECORD}(.*)>", 1), ":")
    of = F.split(F.regexp_extract(c("headers")["WARC-Refers-To"], f"<{RECORD}(.*)>", 1), ":")
    return rows.select(
        "headers",
        "payload",
        F.get(named, 0).try_cast("long").alias("page_id"),
        F.get(named, 1).try_cast("long").alias("row"),
        F.regexp_extract(c("headers")["WARC-Payload-Digest"], "sha1:(.*)", 1).alias("digest"),
        c("headers")["X-Payload-Length"].try_cast("long").alias("payload_bytes"),
        c("headers")["WARC-Type"].alias("type"),
        F.get(of, 0).try_cast("long").alias("refers_to"),
    )


def resolve(spark: SparkSession, path: str, info: str, out: str, min_bytes: int = 0) -> str:
    """Write the archives at ``path`` anew to ``out`` without repeated payloads; returns their separator id.

    Of records with equal payloads of at least ``min_bytes``, the one with the largest page_id stays a
    response; the others become revisit records that refer to it and have no payload.
    """
    records = read_records(spark, path, info)
    heads = records.select("digest", "page_id", "row", "payload_bytes", c("headers")["WARC-Target-URI"].alias("uri"))
    kept = heads.filter(c("payload_bytes") >= min_bytes).groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "row", "uri")).alias("original"))
    kept = materialise(kept.filter(c("n") > 1).select("digest", "original"))
    joined = records.join(kept, "digest", "left")
    again = c("original").isNotNull() & (c("row") != c("original.row"))
    old = lambda name: _line(name, c("headers")[name])
    ref = F.concat(F.lit(f"<{RECORD}"), F.concat_ws(":", F.coalesce(c("original.page_id").cast("string"), F.lit("")), c("original.row").cast("string")), F.lit(">"))
    head = F.concat(
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        old("WARC-Record-ID"),
        old("WARC-Target-URI"),
        F.when(again, F.concat(_line("WARC-Profile", F.lit(SAME_PAYLOAD)), _line("WARC-Refers-To", ref), _line("WARC-Refers-To-Target-URI", c("original.uri")))).otherwise(old("Content-Type")),
        old("WARC-Payload-Digest"),
        old("X-Payload-Length"),
    )
    return _write(joined.select(head.alias("head"), F.when(again, F.lit("")).otherwise(c("payload")).alias("payload")), out)


def restored(records: DataFrame) -> DataFrame:
    """Deduplicated records with the payload of their original: revisits join their response by digest."""
    texts = records.filter(c("type") == "response").groupBy("digest").agg(F.first("payload").alias("full"))
    plain = records.filter(c("type") == "response").select("page_id", "digest", "payload")
    return plain.unionByName(records.filter(c("type") == "revisit").select("page_id", "digest").join(texts, "digest").withColumnRenamed("full", "payload"))


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, resolve revisits into new archives, read those back.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page_id).
    """
    spark = pages.sparkSession
    first, second = scratch_dir(spark), scratch_dir(spark)
    info = write_pages(pages, first)
    records = read_records(spark, second, resolve(spark, first, info, second, min_bytes))
    return records.select("page_id", "payload_bytes", c("digest").alias("payload_digest"), c("type").alias("record_type"), "refers_to")
