"""WARC archives with identical payloads written once.

Each page becomes one WARC 1.1 record with a fresh header. The headers (page, digest and
size of the payload) are shuffled by digest, and the smallest page of each digest is its
response; the others are joined to it and become revisit records, whose block holds the
HTTP header only, with the original Content-Length. Payloads are moved once, by page, so
that many copies of one payload do not meet in one task.

Records end in two line ends, as the format asks, so Spark's text sink writes archives:
its separator is the end of a record. Files are gzip-compressed and committed by Spark.
A reader takes a file's lines in order and cuts records by their Content-Length, whatever
the payload holds, and checks every payload against its digest.

Defined cases: a null payload is empty; payloads under ``min_bytes`` are responses;
repeated rows of the smallest page are all responses; a null page never stands for
others unless all of its copies are null, and then all are responses; line ends in
addresses are written as %0D and %0A, a null address as ``urn:page:`` and the page; an
empty table gives empty archives. Extra columns are not read.
"""

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.small_tables import join_known, materialise

MIN_BYTES = 0
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32(digits: Column) -> Column:
    """Bare upper-case base32 of forty hex digits, twenty bits at a time."""
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _record_id(page: Column) -> Column:
    """A UUID (version 8) that holds the page's number; all ones at its end for none."""
    digits = F.lower(F.lpad(F.hex(page), 16, "0"))
    of = F.concat(
        F.lit("<urn:uuid:"), F.substring(digits, 1, 8), F.lit("-"), F.substring(digits, 9, 4), F.lit("-8"), F.substring(digits, 13, 3),
        F.lit("-8"), F.substring(digits, 16, 1), F.lit("00-000000000000>"))
    return F.coalesce(of, F.lit("<urn:uuid:00000000-0000-8000-8000-ffffffffffff>"))


def _page_of(record_id: str) -> int | None:
    digits = record_id.strip("<>").removeprefix("urn:uuid:").replace("-", "")
    if digits.endswith("f" * 12):
        return None
    return int.from_bytes(bytes.fromhex(digits[:12] + digits[13:16] + digits[17]), signed=True)


def _headers(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Page, size and SHA-1 in hex of every payload. No column but the page is null, so that no filter hashes payloads again."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(F.col(id_col).cast("long").alias("page"), F.octet_length(html).cast("long").alias("size"), F.sha1(html).alias("digest"))


def revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page``, ``digest`` and ``original`` of the headers whose payload another page has first.

    ``headers`` is a written table, as it is read twice. Originals are broadcast where they
    are measured small, else joined by salted digests, so that no task gets all headers of one.
    """
    large = headers.filter(F.col("size") >= min_bytes)
    first = large.groupBy("digest").agg(F.min("page").alias("original"), F.count("*").alias("n")).filter("n > 1 AND original IS NOT NULL")
    again = join_known(large, materialise(first.select("digest", "original")), "digest", "page").filter("page IS NULL OR page != original")
    return again.select("page", "digest", "original").distinct()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row: its response, or a revisit of an equal payload."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    known = revisits(materialise(_headers(pages, id_col, html_col)), min_bytes).select(
        F.col("page").alias("_page"), F.col("digest").alias("_digest"), "original")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
        F.octet_length(html).alias("size"), F.sha1(html).alias("digest"))
    rows = rows.join(known, F.col("page").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
    again = F.col("original").isNotNull()
    address = F.coalesce(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
                         F.concat(F.lit("urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit("none"))))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), "size", F.lit(END + END))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    header = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit(END),
        line("WARC-Record-ID", _record_id(F.col("page"))), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", address),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        F.when(again, F.concat(line("WARC-Refers-To", _record_id(F.col("original"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")))
    block = F.when(again, http).otherwise(F.concat(http, "html"))
    record = F.concat(header, line("Content-Length", F.octet_length(block)), F.lit(END), block)
    rows.select(record.alias("value")).write.option("lineSep", END + END).option("compression", "gzip").text(path)


def _fields(lines: list[bytes]) -> dict[bytes, str]:
    """Header fields by lower-case name."""
    return {k.strip().lower(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines)}


def _parse(header: list[bytes], block: bytes) -> dict:
    warc = _fields(header[1:])
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = warc[b"warc-payload-digest"].removeprefix("sha1:")
    size = int(_fields(http.split(b"\r\n")[1:])[b"content-length"])
    kind = warc[b"warc-type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {warc[b'warc-record-id']} does not fit its digest")
    return {
        "page_id": _page_of(warc[b"warc-record-id"]), "url": warc[b"warc-target-uri"], "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": _page_of(warc[b"warc-refers-to"]) if kind == "revisit" else None,
    }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, payloads checked against their digests."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches):
        header, block, need, held, out = [], [], None, 0, []
        for batch in batches:
            for line in batch.column(0):
                data = line.as_py() + b"\n"
                if need is None:
                    if data != b"\r\n":
                        header.append(data)
                        continue
                    need = int(_fields(header)[b"content-length"]) + 4  # and the two line ends of the record
                    held, block = 0, []
                    continue
                block.append(data)
                held += len(data)
                if held >= need:
                    whole = b"".join(block)
                    if held > need or not whole.endswith(b"\r\n\r\n"):
                        raise ValueError(f"a record does not end where its length says: {header}")
                    out.append(_parse(header, whole[:-4]))
                    header, need = [], None
                    if len(out) >= 1000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
        if header:
            raise ValueError("an archive ends inside a record")
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary"))
    return lines.mapInArrow(read, RECORDS)
