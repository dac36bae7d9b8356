"""Legacy archives to WARC: ARC records of versions 1 and 2 are parsed by their declared lengths and re-issued.

An ARC file starts with a ``filedesc`` record that names the version and its header fields; a record is a header
line, as many bytes as it declares and a line feed. A WARC record repeats the address, date and HTTP response and
gets an identifier derived from them, the payload's digest and its type: of equal payloads of some size, the one
with the smallest page identifier is a response and the others revisit it. Files hold one gzip member per record.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.llm.common import byte_texts, cut_lineage, rows_of
from munimetrics.llm.files import members, read_files, write_bytes

#: Header fields of an ARC record by version (fixed values of the format).
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SMALLEST_REVISIT = 100
DATE = "20000101000000"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "arc-to-warc")


@dataclass
class ArcRecord:
    url: str
    date: str
    mime: str
    block: bytes


def _member(data: bytes) -> bytes:
    return gzip.compress(data, 6, mtime=0)


def _header_word(text: str | None) -> str:
    """Fields are separated by blanks, so what is blank or a control sign is percent-encoded; nothing is ``-``."""
    shown = "".join(c if c > " " and c != "\x7f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in text or "")
    return shown or "-"


def arc_head(version: int, name: str, date: str = DATE) -> bytes:
    body = f"{version} 0 none\n{' '.join(FIELDS[version])}\n".encode()
    return _arc_record(version, f"filedesc://{name}", date, "text/plain", body, name)


def _arc_record(version: int, url: str, date: str, mime: str, block: bytes, name: str) -> bytes:
    values = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": mime, "Result-code": "200",
              "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name, "Archive-length": str(len(block))}
    return " ".join(values[f] for f in FIELDS[version]).encode() + b"\n" + block + b"\n"


def parse_arc(records: Iterator[bytes]) -> Iterator[ArcRecord]:
    """Records of an ARC file from its pieces (gzip members, or the whole file as one); lengths are obeyed, not guessed."""
    fields: tuple[str, ...] = FIELDS[1]
    for data in records:
        at = 0
        while at < len(data):
            if data[at : at + 1] == b"\n":
                at += 1
                continue
            stop = data.index(b"\n", at)
            words = data[at:stop].decode("utf-8", "surrogateescape").split(" ")
            if words[0].startswith("filedesc://"):
                # The head has its own five or ten fields; its first line names the version of all that follow.
                size = int(words[-1])
                fields = FIELDS[int(data[stop + 1 : stop + 2])]
                at = stop + 1 + size
                continue
            if len(words) != len(fields):
                raise ValueError(f"an ARC header has {len(words)} fields instead of {len(fields)}")
            head = dict(zip(fields, words))
            size = int(head["Archive-length"])
            if stop + 1 + size > len(data):
                raise ValueError("an ARC record ends early")
            yield ArcRecord(head["URL"], head["Archive-date"], head["Content-type"], data[stop + 1 : stop + 1 + size])
            at = stop + 1 + size


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> str:
    """Pages as HTTP responses in ARC files, by turns of version 1 and 2. A null page is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version, name, first = 1 + number % 2, f"pages-{number:05d}.arc.gz", True
        for part in rows_of(batches, 256):
            out = [_member(arc_head(version, name, date))] if first else []
            first = False
            for page, url, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), byte_texts(part.column(2))):
                named = "" if page is None else f"X-Page-Id: {page}\r\n"
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{named}Content-Length: {len(html)}\r\n\r\n"
                out.append(_member(_arc_record(version, _header_word(url), date, "text/html", http.encode() + html, name)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col))
    return write_bytes(rows.mapInArrow(run, "member binary"), "member", "arc")


def _split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return head + b"\r\n\r\n", {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def _arc_rows(path: str, content: bytes) -> Iterator[tuple]:
    for record in parse_arc(members(content)):
        head, fields, payload = _split_http(record.block)
        page = fields.get("x-page-id")
        yield record, head, None if page is None else int(page), payload


def warc_date(arc_date: str) -> str:
    """Fourteen digits (a shorter date is filled up) as an ISO 8601 time."""
    d = arc_date.ljust(14, "0") if len(arc_date) > 8 else arc_date.ljust(8, "0") + "000000"
    month, day = max(1, int(d[4:6])), max(1, int(d[6:8]))
    return f"{d[:4]}-{month:02d}-{day:02d}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(page: int | None, url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page} {url} {date} {digest}')}>"


def warc_record(kind: str, url: str, date: str, digest: str, block: bytes, page: int | None, extra: list[str]) -> bytes:
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {url}", f"WARC-Date: {warc_date(date)}",
        f"WARC-Record-ID: {record_id(page, url, date, digest)}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        *extra, f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r\n"


def convert(spark: SparkSession, arc: str, smallest: int = SMALLEST_REVISIT) -> str:
    """Read the ARC files below ``arc`` and write WARC files; returns their folder.

    Payloads of at least ``smallest`` bytes with equal SHA-256 are told once: by the smallest page identifier (one
    that is null never owns another; of rows that repeat it, the smallest address is referred to). Rows that repeat the owner's identifier and payload are responses too.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.string())
        for part in rows_of(batches, 1):
            rows = [(page, hashlib.sha256(payload).digest(), record.url.encode("utf-8", "surrogateescape"), record.date)
                    for record, _, page, payload in _arc_rows("", part.column(1)[0].as_py()) if len(payload) >= smallest]
            columns = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page", "sha", "url", "date"])

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page", "sha", "url", "date", "head", "member"]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.binary()]
        for part in rows_of(batches, 1):
            rows = []
            for record, head, page, payload in _arc_rows("", part.column(1)[0].as_py()):
                digest = hashlib.sha256(payload)
                url = record.url.encode("utf-8", "surrogateescape")
                full = warc_record("response", record.url, record.date, digest.hexdigest(), record.block, page, [])
                rows.append((page, digest.digest(), url, record.date, head, _member(full)))
                if len(rows) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out = []
            for page, sha, url, date, head, member, owner, owner_url, owner_date in zip(*(c.to_pylist() for c in part.columns)):
                if owner is not None:
                    address, digest = url.decode("utf-8", "surrogateescape"), sha.hex()
                    target = owner_url.decode("utf-8", "surrogateescape")
                    extra = [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(owner, target, owner_date, digest)}",
                             f"WARC-Refers-To-Target-URI: {target}", f"WARC-Refers-To-Date: {warc_date(owner_date)}",
                             f"X-Refers-To-Page-Id: {owner}"]
                    member = _member(warc_record("revisit", address, date, digest, head, page, extra))
                out.append(member)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    files = read_files(spark, arc)
    told = cut_lineage(files.mapInArrow(digests, "page long, sha binary, url binary, date string"))
    # The owner's address and date travel with it: what a revisit tells of the record it refers to.
    first = F.min(F.when(F.col("page").isNotNull(), F.struct("page", "url", "date"))).alias("first")
    owners = told.groupBy("sha").agg(first, F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").select(
        "sha", F.col("first.page").alias("owner"), F.col("first.url").alias("owner_url"), F.col("first.date").alias("owner_date")
    )
    named = told.select("page", "sha").distinct().join(owners, "sha").filter("page IS NULL OR page <> owner").select(
        F.col("page").alias("a_page"), F.col("sha").alias("a_sha"), "owner", "owner_url", "owner_date"
    )
    named = cut_lineage(named)
    shape = "page long, sha binary, url binary, date string, head binary, member binary"
    rows = files.mapInArrow(responses, shape)
    chosen = rows.join(named, rows["page"].eqNullSafe(named["a_page"]) & (rows["sha"] == named["a_sha"]), "left").select(
        "page", "sha", "url", "date", "head", "member", "owner", "owner_url", "owner_date"
    )
    return write_bytes(chosen.mapInArrow(choose, "member binary"), "member", "warc")


def parse_warc(records: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(fields, block)`` of each WARC record, field names in lower case; the block has its declared length."""
    for data in records:
        at = 0
        while at < len(data):
            stop = data.index(b"\r\n\r\n", at)
            version, *lines = data[at:stop].decode("utf-8", "surrogateescape").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"no WARC record at byte {at}")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            size = int(fields["content-length"])
            if stop + 4 + size > len(data):
                raise ValueError("a WARC record ends early")
            yield fields, data[stop + 4 : stop + 4 + size]
            at = stop + 4 + size + 4


def read_warc(spark: SparkSession, warc: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url)`` per record of the WARC files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, 1):
            rows = []
            for fields, block in parse_warc(members(part.column(1)[0].as_py())):
                _, http, payload = _split_http(block)
                page, kind = http.get("x-page-id"), fields["warc-type"]
                declared = fields["warc-payload-digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != declared:
                    raise ValueError(f"the payload of page {page} does not have its digest")
                refers = fields.get("x-refers-to-page-id")
                rows.append((None if page is None else int(page), int(http["content-length"]), declared, kind,
                             None if refers is None else int(refers), fields["warc-target-uri"].encode("utf-8", "replace").decode()))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            columns = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
            )

    shape = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return read_files(spark, warc).mapInArrow(run, shape)
