"""WARC archives: a writer that revisits equal payloads, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
GZIP = b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

#: Records per archive file.
RECORDS_PER_FILE = 2000
#: Rows of the reader leave a task in batches of about so many bytes.
BATCH_BYTES = 8 << 20

RECORD_FIELDS = (
    "file string, offset long, length long, kind string, record_type string, record_id string, target_uri string, "
    "page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary, reason string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None, revisit: bool, compressed: bool = True) -> bytes:
    """One record; a revisit carries length and digest of the payload it leaves out."""
    http = b"" if revisit else HTTP + b"Content-Length: %d" % len(payload) + END
    block = b"" if revisit else http + payload
    lines = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: <urn:page:%s>" % str("" if page_id is None else page_id).encode(),
        b"WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~").encode())
    if revisit:
        lines.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(b"WARC-Refers-To: <urn:page:%d>" % original)
    lines += [
        b"WARC-Block-Digest: sha1:" + base32_sha1(block).encode(),
        b"WARC-Payload-Digest: sha1:" + base32_sha1(payload).encode(),
        b"X-Payload-Length: %d" % len(payload),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    whole = b"\r\n".join(lines) + END + block + END
    return gzip_member(whole) if compressed else whole


def write_warc(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    compressed: bool = True,
) -> None:
    """Write a record per row to archives under `path`, a gzip member each unless `compressed` is off.

    The payload is the column in UTF-8, null counting as empty. Of equal payloads of at least `min_revisit_bytes`
    bytes the record with the smallest id is a response and the others revisit it; smaller payloads are all responses.
    Rows that repeat the smallest id are all responses, and so are all rows of a payload that has null ids only; other
    null ids are revisits.

    Payloads are matched by SHA-256 and length: one minimum per payload with map-side combining, then a join that the
    skew handling can split. Spark's text writer commits the files, so a lost executor leaves none by halves. Its
    line separator is an empty gzip member (a blank line without compression), which readers pass over.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    pages = df.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload")
    ).withColumn("key", F.sha2("payload", 256))
    firsts = pages.groupBy("key").agg(F.min("page_id").alias("original"))
    revisit = (F.length("payload") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("original"))

    def records(ids: pd.Series, urls: pd.Series, payloads: pd.Series, originals: pd.Series, revisits: pd.Series) -> pd.Series:
        known = lambda x: None if pd.isna(x) else int(x)
        rows = zip(ids.astype(object), urls, payloads, originals.astype(object), revisits)
        return pd.Series([record(known(i), u, p, known(o), bool(r), compressed) for i, u, p, o, r in rows], dtype=object)

    # Ids travel as text: pandas would turn a column of numbers with a null among them into floats.
    as_text = lambda c: F.col(c).cast("string")
    made = F.pandas_udf(records, "binary")(as_text("page_id"), "url", "payload", as_text("original"), "revisit")
    separator = gzip_member(b"") if compressed else b"\r\n"
    (
        pages.join(firsts, "key")
        .withColumn("revisit", revisit)
        .select(made.cast("string").alias("value"))
        .write.option("lineSep", separator.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


#: Headers go up to an empty line, of any length, but not over the version line of another record.
HEADERS_END = re.compile(END + rb"|\r\nWARC/1\.[01]\r\n")


class Damaged(Exception):
    """A check of a record failed."""


def _inflated(data: memoryview, start: int, step: int = 1 << 16) -> tuple[bytes, int]:
    """The member at `start` and where it ends; zlib checks its CRC and length."""
    inflater, parts, at = zlib.decompressobj(31), [], start
    while not inflater.eof:
        if at >= len(data):
            raise Damaged("member is cut off")
        chunk = data[at : at + step]
        try:
            parts.append(inflater.decompress(chunk))
        except zlib.error as error:
            raise Damaged(f"member: {error}") from None
        at += len(chunk)
    return b"".join(parts), at - len(inflater.unused_data)


def _parsed(data: bytes, start: int, whole: bool) -> tuple[dict, int]:
    """The record at `start` and where it ends; `whole`: nothing may follow it."""
    ended = HEADERS_END.search(data, start)
    if not ended or ended[0] != END:
        raise Damaged("no end of headers")
    headers_end = ended.start()
    first, *lines = data[start:headers_end].split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", first):
        raise Damaged("no version line")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("latin-1")
    if not re.fullmatch(r"\d{1,18}", headers.get("content-length", "")):
        raise Damaged("no content length")
    block_at = headers_end + len(END)
    block_end = block_at + int(headers["content-length"])
    if data[block_end : block_end + len(END)] != END:
        raise Damaged("no end of record where the length says")
    if whole and block_end + len(END) != len(data):
        raise Damaged("bytes after the record")
    block = data[block_at:block_end]
    if (said := headers.get("warc-block-digest", "")).startswith("sha1:") and said[5:] != base32_sha1(block):
        raise Damaged("block digest differs")
    payload = block
    if block.startswith(b"HTTP/") and (cut := block.find(END)) >= 0:
        payload = block[cut + len(END) :]
    kind = headers.get("warc-type", "")
    said = headers.get("warc-payload-digest", "")
    if kind != "revisit" and said.startswith("sha1:") and said[5:] != base32_sha1(payload):
        raise Damaged("payload digest differs")
    urn = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", headers.get(name, ""))) else None
    revisit = kind == "revisit"
    length = headers.get("x-payload-length", "")
    return {
        "record_type": kind,
        "record_id": headers.get("warc-record-id"),
        "target_uri": headers.get("warc-target-uri"),
        "page_id": urn("warc-record-id"),
        "refers_to": urn("warc-refers-to"),
        "payload_bytes": (int(length) if length.isdigit() else None) if revisit else len(payload),
        "payload_digest": (said.removeprefix("sha1:") or None) if revisit else base32_sha1(payload),
        "payload": None if revisit else payload,
    }, block_end + len(END)


def _at(data: bytes, view: memoryview, start: int) -> tuple[dict | None, int]:
    """What is at `start`: a record, or None for an empty member or a blank line; and where it ends."""
    if data.startswith(GZIP, start):
        inflated, end = _inflated(view, start)
        return (_parsed(inflated, 0, True)[0] if inflated else None), end
    if data.startswith(b"WARC/1.", start):
        return _parsed(data, start, False)
    if data.startswith(b"\r\n", start):
        return None, start + 2
    raise Damaged("neither member nor version line")


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive in order; every byte belongs to one of them or to a separator.

    After a failed check the search goes on from the next byte to the next place that begins like a gzip member or a
    version line and holds a valid record; the bytes up to there are one gap, with the reason of the first failure.
    """
    view, at, begins = memoryview(data), 0, re.compile(re.escape(GZIP) + rb"|WARC/1\.[01]\r\n")
    while at < len(data):
        start, found, end = at, None, None
        try:
            found, end = _at(data, view, at)
        except Damaged as failure:
            reason = str(failure)
            yielded_to = len(data)
            for m in begins.finditer(data, at + 1):
                try:
                    found, end = _at(data, view, m.start())
                except Damaged:
                    continue
                yielded_to, start = m.start(), m.start()
                break
            yield {"kind": "gap", "offset": at, "length": yielded_to - at, "reason": reason}
            if end is None:
                return
        if found is not None:
            yield found | {"kind": "record", "offset": start, "length": end - start, "reason": None}
        at = end


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all files under `path` (kind `record` or `gap`), a row each, gaps with their reason.

    Files are read whole, one at a time, so a task holds one archive and the batch it gives on.
    """
    columns = [f.split()[0] for f in RECORD_FIELDS.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                for row in salvage(content):
                    rows.append({"file": file} | row)
                    held += len(row.get("payload") or b"")
                    if held > BATCH_BYTES:
                        yield _frame(rows, columns)
                        rows, held = [], 0
        yield _frame(rows, columns)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, RECORD_FIELDS)


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    return frame.astype({c: "Int64" for c in ("offset", "length", "page_id", "refers_to", "payload_bytes")})
