"""Web archives: one gzip member per record, written and read in sequence.

Each task writes one archive. Pages whose payload another page already holds become revisit
records. Reading decompresses incrementally, frames records by ``Content-Length`` and checks
block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import attempt_name, binaries, shared_file, table
from linkloom.session import materialise, scratch_path

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_SPACE = "urn:x-page:"

CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
MANIFEST = "file string, n_records long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def gzip_member(data: bytes, level: int = 6) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {_one_line(v)}".encode() for k, v in fields)]
    head += [b"WARC-Block-Digest: sha1:" + base32_sha1(block).encode(), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(value: object) -> str:
    return " ".join(str(value).split("\r")).replace("\n", " ")


def page_record(page_id: int | None, url: str | None, html: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit without its payload."""
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{ID_SPACE}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(html)}"),
        ("X-Payload-Length", len(html)),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", url))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID_SPACE}{refers_to}>")]
    return record(fields, _HTTP % len(html) + (b"" if revisit else html))


def inflate_members(read, size: int = CHUNK) -> Iterator[bytes]:
    """Decompressed pieces of gzip members that follow each other; ``read(n)`` gives raw bytes."""
    member = zlib.decompressobj(31)
    open_member, data = False, read(size)
    while data:
        open_member = True
        out = member.decompress(data, size)
        data = member.unconsumed_tail
        yield out
        while not member.eof and not data and len(out) == size:  # more output is waiting
            out = member.decompress(b"", size)
            data = member.unconsumed_tail
            yield out
        if member.eof:
            data, member, open_member = member.unused_data, zlib.decompressobj(31), False
        data = data or read(size)
    if open_member:
        raise ValueError("the archive ends inside a gzip member")


class WarcReader:
    """Records one after the other; memory holds one record."""

    def __init__(self, read):
        self.pieces, self.held = inflate_members(read), bytearray()

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        self.held += piece or b""
        return piece is not None

    def _take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            while (end := self.held.find(b"\r\n\r\n")) < 0:
                if not self._more():
                    if self.held.strip():
                        raise ValueError("the archive ends inside a header")
                    return
            version, *lines = self._take(end + 4)[:-4].split(b"\r\n")
            if not version.startswith(b"WARC/1."):
                raise ValueError(f"not a record: {version[:40]!r}")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}
            block = self._take(int(fields["content-length"]))
            if self._take(4) != b"\r\n\r\n":
                raise ValueError("a record's length is wrong")
            yield fields, block


def parse_page(fields: dict[str, str], block: bytes) -> tuple:
    """A row of RECORDS; raises where a digest or length doesn't fit."""
    if fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"block digest of {fields['warc-record-id']} is wrong")
    payload = block.partition(b"\r\n\r\n")[2]
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(fields["x-payload-length"])
    if kind == "response" and (len(payload) != length or digest != base32_sha1(payload)):
        raise ValueError(f"payload of {fields['warc-record-id']} is wrong")
    ids = [fields.get(k, "").strip("<>").removeprefix(ID_SPACE) for k in ("warc-record-id", "warc-refers-to")]
    page, refers = (int(x) if x else None for x in ids)
    return page, fields.get("warc-target-uri"), length, digest, kind, refers, payload if kind == "response" else None


def _digest():
    return F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256)


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(page_id, _digest, refers_to)`` of pages whose payload a page with a smaller id holds.

    Payloads count as equal when their SHA-256 are. Only keys and digests are shuffled,
    folded per task first. Null ids neither revisit nor are referred to.
    """
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    keyed = pages.filter(F.col("page_id").isNotNull() & (size >= least_bytes))
    keyed = keyed.select(F.col("page_id").cast("long"), _digest().alias("_digest")).distinct()
    first = keyed.groupBy("_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n"))
    shared = first.filter("_n > 1").drop("_n")
    return keyed.join(shared, "_digest").filter("page_id > refers_to")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Archives of ``(page_id, url, html)``; returns the manifest ``(file, n_records)``.

    Null html is an empty payload. Rows that repeat an id are records of their own, each judged
    by its payload; rows with the smallest id of a payload are all responses. An empty table
    gives no archive. A retried task writes another file; the manifest names the one that counts.
    """
    seen = materialise(revisits(pages, least_bytes), "revisits")
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", _digest().alias("_digest"))
    rows = rows.join(seen, ["page_id", "_digest"], "left")

    def write(batches):
        out, n = None, 0
        system, root = shared_file(folder)
        name = attempt_name("pages", ".warc.gz")
        for batch in batches:
            ids, urls, refers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for page, url, html, first in zip(ids, urls, binaries(batch.column(2)), refers):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    info = b"software: linkloom\r\nformat: WARC File Format 1.1\r\n"
                    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{name}>")]
                    fields += [("WARC-Date", DATE), ("Content-Type", "application/warc-fields")]
                    out.write(gzip_member(record(fields, info)))
                out.write(gzip_member(page_record(page, url, html, first)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "n_records": [n]})

    return materialise(rows.select("page_id", "url", "html", "refers_to").mapInArrow(write, MANIFEST), "archives")


def read_archives(manifest: DataFrame) -> DataFrame:
    """All page records of the archives, digests verified, one archive per task."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = shared_file(path)
                rows, held = [], 0
                with system.open_input_stream(name, compression=None) as handle:
                    for fields, block in WarcReader(handle.read):
                        if fields["warc-type"] in ("response", "revisit"):
                            rows.append(parse_page(fields, block))
                            held += len(block)
                        if held > 8 * CHUNK:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = manifest.count()
    return manifest.select("file").repartitionByRange(max(1, files), "file").mapInArrow(read, RECORDS)


def op6_warc(spark, sf: str) -> DataFrame:
    manifest = write_archives(table(spark, sf, "pages"), scratch_path(spark, "warc"))
    return read_archives(manifest).drop("payload", "url")
