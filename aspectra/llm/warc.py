"""WARC writer and splittable reader.

Writer: each task writes one archive of gzip members, one per record, into the shared folder:
first under a name of its own attempt, then moved into place, so a task that runs again
replaces its file whole. Of records with equal payloads of at least `min_revisit_bytes` bytes the
one with the smallest id is a response, the others are revisits that refer to it.

Reader: archives are cut into byte ranges, one task each (evenly several beyond `TASKS`). A task looks for the gzip magic from its
range's start, decodes a candidate's first bytes, and accepts it only if they are a WARC
header; it owns the records that start inside its range and reads past the end to finish the last.
After a record the next candidate is the byte behind it. Files are opened by
pyarrow's file systems (local shared folders, hdfs, s3, gs).

Rules: null html is an empty payload; null url an empty target; rows with a null id are
revisits of a response with an id, or responses where no such exists; rows that repeat the smallest
id are responses each; a URL's control characters and blanks are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_path, stored

MAGIC = b"\x1f\x8b\x08"
#: Bytes per range, and per read within one.
RANGE = 4 << 20
BLOCK = 256 << 10
#: Reading tasks at most; with more ranges a task reads several.
TASKS = 65_536


def _open(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _text_id(page_id: object) -> str:
    return "" if page_id is None else str(int(page_id))


def record(page_id: object, url: str | None, payload: bytes, refers_to: object, sha: str) -> bytes:
    """One gzip member. The HTTP header of a revisit keeps the payload's length."""
    kind = "revisit" if refers_to is not None else "response"
    target = "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {target}", "WARC-Date: 2024-01-01T00:00:00Z",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{_text_id(page_id)} {target}')}>",
             f"X-Page-Id: {_text_id(page_id)}", f"WARC-Payload-Digest: sha1:{sha}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page-Id: {_text_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    plain = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


def write(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write archives; (path, bytes, records) per archive, stored."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"),
                        F.sha1(html).alias("sha"), F.octet_length(html).alias("size"))
    shared = F.col("size") >= min_revisit_bytes
    first = stored(rows.where(shared).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times"))
                   .where("times > 1 and first is not null").select("sha", "first"), "first")
    marked = rows.join(first, "sha", "left").withColumn(
        "refers_to", F.when(shared & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))

    def write_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, name, size, n = None, f"part-{uuid.uuid4().hex}", 0, 0
        files, base = _open(folder)
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}.attempt")
                ref = None if pd.isna(r.refers_to) else r.refers_to
                raw = record(None if pd.isna(r.page_id) else r.page_id, r.url if isinstance(r.url, str) else None,
                             bytes(r.payload), ref, base64.b32encode(bytes.fromhex(r.sha)).decode())
                out.write(raw)
                size, n = size + len(raw), n + 1
        if out is not None:
            out.close()
            files.move(f"{base}/{name}.attempt", f"{base}/{name}.warc.gz")
            yield pd.DataFrame({"path": [f"{folder}/{name}.warc.gz"], "bytes": [size], "records": [n]})

    done = (marked.select("page_id", "url", "payload", "sha", "refers_to")
            .mapInPandas(write_part, "path string, bytes long, records long"))
    return stored(done, "archives")  # only the files that a finished task lists count


class _Window:
    """Bytes of a file from a position on, read in blocks."""

    def __init__(self, handle, size: int, at: int):
        self.handle, self.size, self.at, self.data = handle, size, at, bytearray()  # grows and shrinks in place

    def more(self) -> bool:
        if self.at + len(self.data) >= self.size:
            return False
        self.handle.seek(self.at + len(self.data))
        self.data += self.handle.read(min(BLOCK, self.size - self.at - len(self.data)))
        return True

    def skip(self, to: int) -> None:
        del self.data[:min(to - self.at, len(self.data))]
        self.at = to


def _member(win: _Window) -> tuple[bytes, int] | None:
    """The WARC record that the window's first byte starts, and where it ends; else None."""
    unpack = zlib.decompressobj(31)
    plain, used = [], 0
    got = 0
    while True:
        if used == len(win.data) and not win.more():
            return None
        try:
            part = unpack.decompress(memoryview(win.data)[used:].tobytes())
        except zlib.error:
            return None
        used = len(win.data)
        plain.append(part)
        got += len(part)
        if got >= 5 and not b"".join(plain[:64])[:5] == b"WARC/":
            return None
        if unpack.eof:
            return (b"".join(plain), win.at + used - len(unpack.unused_data)) if got >= 5 else None


def records_in(handle, size: int, start: int, end: int) -> Iterator[bytes]:
    """Uncompressed records that start in [start, end)."""
    win = _Window(handle, size, start)
    while win.at < end:
        hit = win.data.find(MAGIC)
        if hit < 0:
            tail = max(0, len(win.data) - len(MAGIC) + 1)
            win.skip(win.at + tail)
            if not win.more():
                return
            continue
        win.skip(win.at + hit)
        if win.at >= end:
            return
        found = _member(win)
        if found is None:
            win.skip(win.at + 1)
            continue
        yield found[0]
        win.skip(found[1])


def parse(plain: bytes) -> dict:
    """Header fields, record type and payload facts of one record."""
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    length = next(int(x[15:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length:"))
    page, ref = fields.get("X-Page-Id", ""), fields.get("X-Refers-To-Page-Id", "")
    return {"page_id": int(page) if page else None, "url": fields.get("WARC-Target-URI", ""),
            "payload_bytes": length if revisit else len(payload),
            "payload_digest": fields["WARC-Payload-Digest"][5:] if revisit else digest(payload),
            "record_type": fields["WARC-Type"], "refers_to": int(ref) if ref else None,
            "payload": None if revisit else payload}


def read(archives: DataFrame, range_bytes: int = RANGE, payloads: bool = True) -> DataFrame:
    """Records of the archives (path, bytes): page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload (null for revisits, and if not asked for)."""
    cuts = archives.where("bytes > 0").select("path", "bytes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    # the rows of ranges are few bytes each, so their number alone can say how many tasks they need
    ranges = archives.agg(F.sum(F.ceil(F.col("bytes") / range_bytes)).alias("n")).first()["n"] or 0
    tasks = max(1, min(int(ranges), TASKS))
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def frame(rows: list[dict]) -> pd.DataFrame:
        pdf = pd.DataFrame(rows, columns=names)
        return pdf.assign(page_id=pdf["page_id"].astype("Int64"), refers_to=pdf["refers_to"].astype("Int64"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, size, start in zip(pdf["path"], pdf["bytes"], pdf["start"], strict=True):
                files, base = _open(path)
                rows, held = [], 0
                with files.open_input_file(base) as handle:
                    for plain in records_in(handle, int(size), int(start), min(int(size), int(start) + range_bytes)):
                        got = parse(plain)
                        if not payloads:
                            got["payload"] = None
                        rows.append(got)
                        held += len(plain)
                        if held > (8 << 20):
                            yield frame(rows)
                            rows, held = [], 0
                if rows:
                    yield frame(rows)

    return (cuts.repartition(tasks).mapInPandas(
        scan, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "payload binary"))


def report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from the archives."""
    return read(write(pages), payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
