"""Web archives whose repeated payloads are revisit records.

Only headers are shuffled by payload digest: the record with the smallest id of every digest keeps
its payload as a ``response``, the others become ``revisit`` records that name it. The archives are
written with fresh headers, read back, and every revisit is joined to its response.

A record ends with two line ends, which is how Spark's text writer ends a line when told so; the
archives are therefore written and committed by Spark itself, compressed as whole files, in any
store. A compressed file is read by one task from start to end, in order, and records are cut by their
``Content-Length``; line ends inside a payload do no harm.

At scale: payloads move once, by record id, never by digest, so a payload that a third of all pages
share is not one task's work; joins by digest hold headers only, and Spark splits them where they are
skewed. Memory per reading task is one record.

Defined cases: a null payload is empty, and equal to other empty ones; a null or odd url is written with
control characters and blanks escaped, or as ``urn:page``; records that repeat both id and payload
are all responses; a null id is larger than all others, and if a digest has only null ids its
records are all responses; empty tables give empty archives and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwork.sources.work import work_path, written

END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
#: Fixed values of the archive format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of the digest notation, in the order of their values, and Spark's digits of base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "2024-01-01T00:00:00Z"

_RECORD = (
    "record_type string, record_id string, refers_to_id string, page_id string, "
    "target_uri string, payload_digest string, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of the bytes in upper-case base 32: four numbers of 40 bits, eight digits each."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, start, 10), 16, 32), 8, "0") for start in (1, 11, 21, 31)
    ]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def record_id(page_id: Column, digest: Column) -> Column:
    number = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    grouped = F.regexp_replace(number, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), grouped, F.lit(">"))


def payload_headers(pages: DataFrame) -> DataFrame:
    """Id, payload digest and a second digest of every page, without the payload."""
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    return pages.select(
        pages["page_id"],
        base32_sha1(payload).alias("digest"),
        F.md5(payload).alias("digest2"),
    )


def originals(headers: DataFrame) -> DataFrame:
    """Per page and payload the page whose record keeps the payload."""
    first = headers.groupBy("digest", "digest2").agg(F.min("page_id").alias("original"))
    return headers.distinct().join(first, ["digest", "digest2"])


def archive_records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """One archive record per page, as text: the payload once for all pages that share it."""
    payload = F.coalesce(pages["html"], F.lit(""))
    uri = F.regexp_replace(F.coalesce(pages["url"], F.lit("")), "[\\x00-\\x20\\x7F]", "%20")
    rows = pages.select(
        pages["page_id"],
        F.when(uri == "", F.concat(F.lit("urn:page:"), F.coalesce(pages["page_id"].cast("string"), F.lit(""))))
        .otherwise(uri)
        .alias("uri"),
        payload.alias("payload"),
        base32_sha1(payload.cast("binary")).alias("digest"),
        F.md5(payload.cast("binary")).alias("digest2"),
    )
    kept = originals(payload_headers(pages)).withColumnsRenamed(
        {"page_id": "page", "digest": "d", "digest2": "d2"}
    )
    same = (
        rows["page_id"].eqNullSafe(kept["page"])
        & (rows["digest"] == kept["d"])
        & (rows["digest2"] == kept["d2"])
    )
    rows = rows.join(kept, same)
    own = rows["page_id"].eqNullSafe(rows["original"])
    http = F.when(
        own,
        F.concat(
            F.lit(f"{HTTP}\r\nContent-Length: "),
            F.octet_length("payload").cast("string"),
            F.lit(END),
            "payload",
        ),
    ).otherwise(F.lit(HTTP + END))
    rows = rows.select("page_id", "uri", "digest", "original", own.alias("own"), http.alias("block"))
    header = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        F.when(F.col("own"), F.lit("response")).otherwise(F.lit("revisit")),
        F.lit("\r\nWARC-Record-ID: "),
        record_id(F.col("page_id"), F.col("digest")),
        F.when(F.col("own"), F.lit("")).otherwise(
            F.concat(
                F.lit("\r\nWARC-Refers-To: "),
                record_id(F.col("original"), F.col("digest")),
                F.lit(f"\r\nWARC-Profile: {SAME_PAYLOAD}"),
            )
        ),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        "uri",
        F.lit("\r\nPage-Id: "),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        "digest",
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
    )
    return rows.select(F.concat(header, "block").alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    archive_records(pages).write.option("lineSep", END).option("compression", "gzip").text(path)


def parsed(pieces: Iterator[tuple[str, bytes]]) -> Iterator[dict]:
    """Records from the pieces of archives, which come file by file and in order, each without the
    two line ends that follow it. Where a file's last payload ends in a line end, the last piece is a line
    end that had nothing behind it, and the two added to it are left over."""
    rest, of, begin = bytearray(), None, 0
    end = END.encode()
    for file, piece in pieces:
        if file != of:
            if rest and rest != end:
                raise ValueError(f"{of} ends within a record")
            rest.clear()
            of = file
        rest += piece
        rest += end
        while rest and rest != end:
            stop = rest.find(end)
            lines = bytes(rest[:stop]).decode().split("\r\n")
            if lines[0] != VERSION:
                raise ValueError(f"no record begins here in {of}: {lines[0][:40]!r}")
            fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            begin = stop + len(end)
            whole = begin + int(fields["Content-Length"])
            if len(rest) < whole + len(end):
                break
            block = bytes(rest[begin:whole])
            if rest[whole : whole + len(end)] != end:
                raise ValueError(f"a record of {of} does not end where its length says")
            del rest[: whole + len(end)]
            yield {
                "record_type": fields["WARC-Type"],
                "record_id": fields["WARC-Record-ID"],
                "refers_to_id": fields.get("WARC-Refers-To"),
                "page_id": fields["Page-Id"] or None,
                "target_uri": fields["WARC-Target-URI"],
                "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                "payload": block[block.find(end) + len(end) :] if fields["WARC-Type"] == "response" else None,
            }
    if rest and rest != end:
        raise ValueError(f"{of} ends within a record")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split(" ")[0] for field in _RECORD.split(", ")]
    kinds = [pa.binary() if name == "payload" else pa.string() for name in names]

    def pieces() -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("piece").to_pylist())

    held: list[dict] = []
    size = 0
    for record in parsed(pieces()):
        held.append(record)
        size += len(record["payload"] or b"")
        if size > 8 << 20 or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[n] for x in held], k) for n, k in zip(names, kinds)], names
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[n] for x in held], k) for n, k in zip(names, kinds)], names
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives that ``write_archives`` wrote: headers, and payloads of responses."""
    pieces = spark.read.option("lineSep", END).text(path)
    return pieces.select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")
    ).mapInArrow(_records, _RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Every record with the size and digest of its full payload, and the page of the response it
    refers to; a revisit whose response is missing has null there."""
    seen = written(
        records.select(
            "record_type",
            "record_id",
            "refers_to_id",
            "page_id",
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
            F.when(F.col("payload").isNotNull(), base32_sha1(F.col("payload"))).alias("payload_digest"),
        ),
        "archive-headers",
    )
    responses = seen.filter(F.col("record_type") == "response")
    kept = responses.select(
        F.col("record_id").alias("refers_to_id"),
        F.col("page_id").alias("refers_to"),
        "payload_bytes",
        "payload_digest",
    ).dropDuplicates(["refers_to_id"])
    revisits = seen.filter(F.col("record_type") == "revisit")
    revisits = revisits.drop("payload_bytes", "payload_digest").join(kept, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        responses.withColumn("refers_to", F.lit(None).cast("string"))
        .select(columns)
        .unionByName(revisits.select(columns))
    )


def revisit_resolution(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages as deduplicated archives, reads these back and resolves every revisit."""
    path = path or work_path(pages.sparkSession, "archives")
    write_archives(pages, path)
    found = resolved(read_archives(pages.sparkSession, path))
    kind = pages.schema["page_id"].dataType
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
