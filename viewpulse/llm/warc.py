"""Converting legacy ARC archives to WARC, with revisit records for repeated payloads."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.llm.common import ship, stored
from viewpulse.session import shared_path

#: Bytes of one archive before compression; a longer record has an archive to itself.
FILE_BYTES = 16 << 20
#: Fixed by the formats: header fields of both ARC versions, the revisit profile.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Extension header of the archived HTTP responses with the number of the page.
PAGE_HEADER = "X-Page-Id"


def digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(file: str, number: int) -> str:
    """The same for the same record of the same archive, however often it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{file.rpartition("/")[2]}#{number}')}>"


def unpacked(content: bytes) -> bytes:
    """An archive without its gzip members, if it has any."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(parts)


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-case names), the header as it stands, and the payload of an archived HTTP response."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    head, gap, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, head + gap, payload


def arc_header(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 archive\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
              "Result-code": "200", "Filename": name, "Archive-length": str(len(body))}
    return " ".join(values.get(f, "-") for f in ARC_FIELDS[version]).encode() + b"\n" + body


def arc_record(version: int, url: str | None, date: str, page: int | None, payload: bytes, name: str, offset: int) -> bytes:
    known = f"{PAGE_HEADER}: {page}\r\n" if page is not None else ""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{known}\r\n"
             ).encode() + payload
    values = {"URL": quote(url, safe="!#$&'()*+,/:;=?@[]~%") if url else "-", "IP-address": "0.0.0.0", "Archive-date": date,
              "Content-type": "text/html", "Result-code": "200", "Offset": str(offset), "Filename": name,
              "Archive-length": str(len(block))}
    return " ".join(values.get(f, "-") for f in ARC_FIELDS[version]).encode() + b"\n" + block


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "20240101000000", file_bytes: int = FILE_BYTES) -> None:
    """Write pages as ARC archives, of version 1 and 2 in turn; Spark's text writer puts each into a file of its own.

    A null html is an empty payload; a null url is ``-``; blanks and other characters that an ARC line cannot hold are
    percent-encoded; a page without a number has no number header.
    """
    ship(pages.sparkSession)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, parts, size = 0, [], 0
        for batch in batches:
            for page, url, html in zip(*(batch.column(i) for i in range(3)), strict=True):
                version, name = 1 + done % 2, f"pages-{done}.arc"
                if not parts:
                    parts = [arc_header(version, name, date)]
                    size = len(parts[0])
                parts.append(arc_record(version, url.as_py(), date, page.as_py(), html.as_py() or b"", name, size + 1))
                size += len(parts[-1]) + 1
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], ["value"])
                    done, parts = done + 1, []
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], ["value"])

    plain = pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col).cast("binary"))
    write_files(plain.mapInArrow(archives, "value binary"), path, "\n")


def write_files(bodies: DataFrame, path: str, end: str) -> None:
    """One gzip file per row of ``value``; ``end`` closes its last record."""
    bodies.select(F.col("value").cast("string")).write.option("lineSep", end).option("maxRecordsPerFile", 1).option(
        "compression", "gzip").text(path)


def arc_records(content: bytes) -> Iterator[dict]:
    """Records of an archive of either version: header fields by name, ``block`` and whether the file ends within it."""
    data = unpacked(content)
    at, fields = 0, ARC_FIELDS[1]
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
        if not line:  # the line end after a block
            at += 1 if end >= 0 else len(data)
            continue
        # a version 1 line may have blanks in its address: the other fields are counted from the end
        values = line.rsplit(" ", len(fields) - 1) if not line.startswith("filedesc://") else line.split(" ")
        if not values[-1].isdigit():
            raise ValueError(f"no ARC header line at byte {at}: {line[:100]!r}")
        length = int(values[-1])
        block = data[end + 1:end + 1 + length]
        at = end + 1 + length
        if line.startswith("filedesc://"):
            fields = ARC_FIELDS[2 if block.startswith(b"2") else 1]
            continue
        yield {**dict(zip(fields, values, strict=True)), "block": block, "cut": len(block) < length}


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(``path``, ``content``) of the archives in a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def arc_digests(files: DataFrame) -> DataFrame:
    """(``file``, ``number``, ``page_id``, ``bytes``, ``digest``) of every record, payloads left where they are."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for number, record in enumerate(arc_records(content.as_py())):
                    fields, _, payload = split_http(record["block"])
                    page = fields.get(PAGE_HEADER.lower())
                    rows.append((path, number, int(page) if page is not None else None, len(payload), digest(payload)))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                    ["file", "number", "page_id", "bytes", "digest"])
    return files.mapInArrow(found, "file string, number long, page_id long, bytes long, digest string")


def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per archive: ``record`` (number) of each record that repeats another's payload, with the place of that other.

    Of equal payloads of at least ``min_bytes`` the record of the largest page number stands, a missing number counting as
    smallest; among repeated pages the last record.  The maximum combines map-side; the list is bounded by the archive.
    """
    place = F.struct("page_id", "file", "number")
    last = records.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max(place).alias("to"))
    again = records.join(last, ["digest", "bytes"]).where(
        (F.col("file") != F.col("to.file")) | (F.col("number") != F.col("to.number")))
    return again.groupBy("file").agg(F.collect_list(F.struct(
        F.col("number"), F.col("to.file").alias("to_file"), F.col("to.number").alias("to_number"))).alias("again"))


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block


def converted(path: str, content: bytes, again: dict[int, tuple[str, int]]) -> bytes:
    """The WARC archive of an ARC archive; ``again``: where the payload of a revisit record stands."""
    name = path.rpartition("/")[2]
    about = f"software: viewpulse\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
    date = "1970-01-01T00:00:00Z"
    out = [b""]
    for number, record in enumerate(arc_records(content)):
        fields, head, payload = split_http(record["block"])
        d = record["Archive-date"].ljust(14, "0")
        date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
        known = [("WARC-Record-ID", record_id(path, number)), ("WARC-Date", date), ("WARC-Target-URI", record["URL"]),
                 ("WARC-IP-Address", record["IP-address"]), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
        known += [("WARC-Truncated", "length")] if record["cut"] else []
        known += [("Content-Type", "application/http;msgtype=response" if fields else record["Content-type"])]
        if number in again:
            known += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(*again[number]))]
            out.append(warc_record("revisit", known, head))
        else:
            out.append(warc_record("response" if fields else "resource", known, payload if not fields else record["block"]))
    out[0] = warc_record("warcinfo", [("WARC-Record-ID", record_id(path, -1)), ("WARC-Date", date), ("WARC-Filename", name),
                                      ("Content-Type", "application/warc-fields")], about)
    return b"\r\n\r\n".join(out)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """Convert a folder of ARC archives into WARC archives, one for one.

    Header lines are read by the version that the archive declares, blocks by their declared lengths (a block that the
    file cuts short is marked ``WARC-Truncated``).  Identifiers come from file name and record number, dates, types and
    digests from the record.  Digests are compared first, without payloads; the archives then meet the list of their
    revisit records, so that only compressed archives are shuffled.
    """
    ship(spark)
    files = archive_files(spark, arc_path)
    again = revisits(stored(arc_digests(files), "arc-digests"), min_bytes)
    met = files.join(again, files["path"] == again["file"], "left").select("path", "content", "again")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, own in zip(*batch.columns, strict=True):
                list_of = {r["number"]: (r["to_file"], r["to_number"]) for r in own.as_py() or ()}
                body = converted(path.as_py(), content.as_py(), list_of)
                yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["value"])

    write_files(met.mapInArrow(archives, "value binary"), warc_path, "\r\n\r\n")


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record."""
    data, at = unpacked(content), 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(fields["content-length"])
        yield fields, data[end + 4:end + 4 + length]
        at = end + 4 + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives of a folder but for the descriptions of the archives themselves.

    ``payload_bytes`` of a revisit record is the length that its HTTP header declares.  A payload that does not fit its
    digest raises an error.
    """
    ship(spark)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for fields, block in warc_records(content.as_py()):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http, _, payload = split_http(block)
                    sum_ = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind != "revisit" and digest(payload) != sum_:
                        raise ValueError(f"damaged record {fields['warc-record-id']}")
                    page = http.get(PAGE_HEADER.lower())
                    rows.append((fields["warc-record-id"], kind, fields["warc-date"], fields["warc-target-uri"],
                                 int(page) if page is not None else None,
                                 int(http["content-length"]) if kind == "revisit" else len(payload), sum_,
                                 fields.get("warc-refers-to"), None if kind == "revisit" else payload))
                kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                         pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    names = ["record_id", "record_type", "date", "uri", "page_id", "payload_bytes", "payload_digest", "refers_to_id", "payload"]
    return archive_files(spark, path).mapInArrow(
        found, "record_id string, record_type string, date string, uri string, page_id long, payload_bytes long, "
               "payload_digest string, refers_to_id string, payload binary")


def page_records(records: DataFrame) -> DataFrame:
    """Records of pages with ``refers_to``, the page number of the record that a revisit refers to."""
    records = stored(records.drop("payload"), "warc-records")
    own = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    first = records.where("record_type <> 'revisit'")
    heads = first.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    # only revisits look up a record; the others have none to look up
    again = records.where("record_type = 'revisit'").join(heads, "refers_to_id", "left")
    return first.select(*own, F.lit(None).cast("long").alias("refers_to"), "record_id", "date", "uri").unionByName(
        again.select(*own, "refers_to", "record_id", "date", "uri"))


def archive_pages(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the records read back, by way of archives in the session's shared folder.

    One row per row of ``pages``, repeated rows too (which revisit each other); null payloads and addresses are empty, a null
    page number stays null; other columns are not looked at, whatever their names; an empty table gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc, **columns)
    convert(spark, arc, warc, min_bytes)
    return page_records(read_warc(spark, warc))
