"""WARC archives: writing pages with payload deduplication, and a reader that salvages damaged files.

Each record is a gzip member of its own. The reader checks every record (member checksum, header, length, block and
payload digests). After a failed check it searches for the next byte where a valid record begins, goes on from there,
and logs the bytes between as a quarantined gap. Uncompressed records are found by their version line.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import files
from tallywise.llm.batching import small_batches, trimmed
from tallywise.session import scratch_path, stored

GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
READ = 1 << 18
RECORDS = (
    "path string, offset long, kind string, reason string, gap_bytes long, record_type string, record_id string, "
    "target_uri string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary"
)
NAMES = [x.split()[0] for x in RECORDS.split(", ")]


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(text) -> str:
    return " ".join(str(text).split())


def record_bytes(kind: str, page_id, url, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header but no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    name = lambda i: uuid.uuid5(uuid.NAMESPACE_URL, f"page:{i}")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name(page_id)}>", "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{name(refers_to)}>", f"X-Refers-To-Page-Id: {refers_to}",
        ]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _write(folder: str, file_bytes: int):
    def run(frames):
        out, path, size = None, None, 0
        for pdf in frames:
            for page_id, url, html, kind, refers_to in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["kind"], pdf["refers_to"]):
                payload = (html or "").encode("utf-8", "surrogatepass")
                page_id = int(page_id) if isinstance(page_id, str) else None
                raw = record_bytes(
                    kind, page_id, url, payload if kind == "response" else None, len(payload), sha1_base32(payload),
                    int(refers_to) if isinstance(refers_to, str) else None,
                )
                if out is None:
                    path, size = files.fresh(folder, ".warc.gz"), 0
                    out = files.opened(path, "wb")
                out.write(raw)
                size += len(raw)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [path], "bytes": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "bytes": [size]})

    return run


def write_warc(pages: DataFrame, file_bytes: int = 1 << 25) -> DataFrame:
    """Write a record per row of ``page_id``, ``url``, ``html``; returns ``path``, ``bytes`` of the archives.

    Of rows with equal payloads (the html in UTF-8; null is empty) the smallest ``page_id`` is a response and the others
    revisit it; rows that repeat that id are responses too, and so are rows without an id. White space in a url is
    written as one space. Other columns are ignored; an empty table writes no archive. Runs a job when called.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = files.as_uri(scratch_path(spark, "warc"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    digest = F.sha1(F.coalesce("html", F.lit("")))
    firsts = rows.groupBy(digest.alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = stored(firsts.where("n > 1 and first is not null").select("digest", "first"), "payloads")
    marked = rows.withColumn("digest", digest).join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("first") != F.col("page_id"))
    marked = marked.select(
        "page_id", "url", "html", F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("first")).alias("refers_to"),
    )
    marked = marked.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})  # pandas keeps no integers beside a null
    return stored(marked.mapInPandas(trimmed(_write(folder, file_bytes)), "path string, bytes long"), "warc-index")


class _Window:
    """A seekable file read in blocks."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.size - at))


def _member(file: _Window, at: int) -> tuple[bytes, int]:
    """The unpacked member or plain record at a byte, and where it ends. Raises ValueError if there is none."""
    head = file.read(at, 8)
    if head.startswith(GZIP):
        unpack, parts, end = zlib.decompressobj(31), [], at
        while not unpack.eof:
            raw = file.read(end, READ)
            if not raw:
                raise ValueError("member cut off")
            try:
                parts.append(unpack.decompress(raw))
            except zlib.error as e:
                raise ValueError(f"member damaged: {e}") from None
            if end == at and not parts[0][:7].startswith(VERSION[: max(1, len(parts[0][:7]))]):
                raise ValueError("no version line")
            end += len(raw)
        return b"".join(parts), end - len(unpack.unused_data)
    if head.startswith(VERSION):
        raw = b""
        while b"\r\n\r\n" not in raw:
            more = file.read(at + len(raw), READ)
            if not more or len(raw) > 1 << 20:
                raise ValueError("header cut off")
            raw += more
        top = raw.split(b"\r\n\r\n", 1)[0]
        length = int(_headers(top).get("content-length", "-1")) if _headers(top).get("content-length", "").isdigit() else -1
        if length < 0:
            raise ValueError("no length")
        end = at + len(top) + 4 + length + 4
        if end > file.size:
            raise ValueError("record cut off")
        return file.read(at, end - at), end
    raise ValueError("no record begins here")


def _headers(top: bytes) -> dict[str, str]:
    out = {}
    for line in top.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _digest_fails(header: str | None, data: bytes) -> bool:
    return bool(header) and header.startswith("sha1:") and header[5:] != sha1_base32(data)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def parsed(raw: bytes) -> dict:
    """The checked fields of a record. Raises ValueError where a check fails."""
    if not raw.startswith(VERSION):
        raise ValueError("no version line")
    top, gap, rest = raw.partition(b"\r\n\r\n")
    head = _headers(top)
    length = _number(head.get("content-length"))
    if not gap or length is None or length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("length differs")
    block = rest[:length]
    if _digest_fails(head.get("warc-block-digest"), block):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = head.get("warc-type")
    digest = head.get("warc-payload-digest", "")
    if kind == "response" and _digest_fails(digest, payload):
        raise ValueError("payload digest differs")
    size = len(payload) if kind == "response" else _number(_headers(http).get("content-length"))
    return {
        "record_type": kind, "record_id": head.get("warc-record-id"), "target_uri": head.get("warc-target-uri"),
        "page_id": _number(head.get("x-page-id")), "refers_to": _number(head.get("x-refers-to-page-id")),
        "payload_bytes": size, "payload_digest": digest.removeprefix("sha1:") or None, "payload": payload if kind == "response" else None,
    }


def _next_start(file: _Window, at: int) -> int:
    """The next byte that may begin a record, or the file's end."""
    while at < file.size:
        raw = file.read(at, READ + 8)
        found = [i for i in (raw.find(GZIP), raw.find(VERSION)) if i >= 0]
        if found:
            return at + min(found)
        at += READ
    return file.size


def salvaged(file, size: int):
    """Records and gaps of a file, in order, as dictionaries. Memory is bounded by a record."""
    window, at, gap, reason = _Window(file, size), 0, None, None
    while at < size:
        try:
            raw, end = _member(window, at)
            fields = parsed(raw)
        except ValueError as e:
            if gap is None:
                gap, reason = at, str(e)
            at = _next_start(window, at + 1)
            continue
        if gap is not None:
            yield {"offset": gap, "kind": "gap", "reason": reason, "gap_bytes": at - gap}
            gap = None
        yield {"offset": at, "kind": "record", **fields}
        at = end
    if gap is not None:
        yield {"offset": gap, "kind": "gap", "reason": reason, "gap_bytes": size - gap}


def _read(with_payload: bool):
    def run(frames):
        for pdf in frames:
            for path in pdf["path"]:
                file = files.opened(path, "rb")
                rows, held = [], 0
                for row in salvaged(file, file.size()):
                    held += len(row.get("payload") or b"")
                    if not with_payload:
                        row.pop("payload", None)
                    rows.append(row | {"path": path})
                    if held > 1 << 24:
                        yield _frame(rows)
                        rows, held = [], 0
                file.close()
                yield _frame(rows)

    return run


def _frame(rows: list[dict]) -> pd.DataFrame:
    numbers = ("offset", "gap_bytes", "page_id", "refers_to", "payload_bytes")
    out = pd.DataFrame({n: pd.array([r.get(n) for r in rows], "Int64") if n in numbers else [r.get(n) for r in rows] for n in NAMES})
    return out.astype({n: object for n in ("kind", "reason", "record_type", "record_id", "target_uri", "payload_digest", "payload", "path")})


def read_warc(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records (``kind`` record) and quarantined byte ranges (``kind`` gap) of the archives named in ``path``.

    An empty or wholly damaged archive gives no record; a damaged stretch gives one gap with its first failed check.
    """
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.select("path").repartition(n, "path").mapInPandas(trimmed(_read(with_payload)), RECORDS)
