"""WARC archives: a writer that stores repeated payloads once, and a reader that salvages damaged archives.

Each record is a gzip member of its own. Spark's text sink writes them, one record a row (its bytes pass unchanged), so
commits, retries and file systems are Spark's own. The reader takes archives that are plain, gzip by member or gzip as a
whole, through a window that holds no more than the record it looks at. A record counts if its version line, headers,
length and digest hold; otherwise the reader looks for the next version line or the next gzip member that opens with one,
goes on there, and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import release_memory

VERSION = b"WARC/1.1\r\n"
_END = b"\r\n\r\n"
_ID = re.compile(r"<urn:page:(-?\d+|none)>")
_EPOCH = "2024-01-01T00:00:00Z"
_MEMBER = b"\x1f\x8b\x08"
#: An empty gzip member. It follows a member that doesn't end in a zero byte, which the text sink adds as its separator.
_NOTHING = zlib.compressobj(6, zlib.DEFLATED, 31).flush()
CHUNK = 1 << 22
MOST_HEADER = 1 << 20
MOST_RECORD = (1 << 31) - 1  # a binary value in Spark holds no more
_MORE = object()


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from hex by groups of five digits."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digits = F.sha1(data)
    letters = []
    for g in range(8):
        n = F.conv(F.substring(digits, 5 * g + 1, 5), 16, 10).cast("int")
        letters += [F.substring(alphabet, F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def with_roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, size, digest, record_type, refers_to. Payloads of one SHA-256 and size are equal.

    Payloads are shuffled once at most, with that key.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    base = base.withColumn("size", F.octet_length("payload").cast("long")).withColumn("same", F.unhex(F.sha2(F.col("payload").cast("binary"), 256)))
    keep = base.where(F.col("size") >= least_bytes).groupBy("same", "size").agg(F.count("*").alias("copies"), F.max("page_id").alias("keep_id"))
    base = base.join(keep, ["same", "size"], "left")
    again = (F.col("copies") > 1) & F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    again = F.coalesce(again, F.lit(False))
    return base.select("page_id", "url", "payload", "size", base32_sha1(F.col("payload").cast("binary")).alias("digest"), F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("keep_id")).alias("refers_to"))


def _record() -> Column:
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    clean = F.regexp_replace("url", r"[\r\n]", "")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))
    head = F.concat(
        F.lit(VERSION.decode()), F.lit("WARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), urn("page_id"), F.lit("\r\nWARC-Target-URI: "), clean,
        F.lit(f"\r\nWARC-Date: {_EPOCH}\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("record_type") == "revisit", F.concat(F.lit("\r\nWARC-Refers-To: "), urn("refers_to"), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit(_END.decode())).cast("binary")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member, without the zero byte at its end: that of the length, whose highest byte comes last."""
    for batch in batches:
        out, held = [], 0
        for record in batch.column(0):
            pack = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = pack.compress(record.as_buffer()) + pack.flush()
            out.append((member if member[-1] == 0 else member + _NOTHING)[:-1])
            held += len(out[-1])
            if held >= CHUNK:
                yield pa.record_batch([pa.array(out, pa.binary())], ["member"])
                out, held = [], 0
        yield pa.record_batch([pa.array(out, pa.binary())], ["member"])
    release_memory()


def write_warc(pages: DataFrame, path: str, records_per_file: int = 4000, **cols) -> None:
    """Write one record per row below path.

    A null url or payload counts as empty; a null id is written as "none" and is the response of a group of copies only if
    all its ids are null, in which case all its records are responses. Rows with the same id and payload are all responses
    or all revisits. An empty table writes no record. A file holds records_per_file records at most.
    """
    members = with_roles(pages, **cols).select(_record().alias("record")).mapInArrow(_members, "member binary")
    sink = members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0")
    sink.option("compression", "none").option("maxRecordsPerFile", records_per_file).text(path)


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _parse(data: bytes | bytearray, at: int, whole: bool):
    """The record that starts at `at`: where it ends and its fields; None if a check fails, _MORE if the data end too soon.

    whole: nothing comes after the data.
    """
    if not data.startswith(b"WARC/1.", at):
        return _MORE if not whole and len(data) - at < 7 else None
    body = data.find(_END, at, at + MOST_HEADER)
    if body < 0:
        return _MORE if not whole and len(data) - at < MOST_HEADER else None
    h = _headers(bytes(data[data.find(b"\r\n", at) + 2 : body]))
    body += 4
    length = h.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or int(length) > MOST_RECORD:
        return None
    end = body + int(length)
    if len(data) < end + 4 and not whole:
        return _MORE
    if data[end : end + 4] != _END:
        return None
    block = bytes(data[body:end])
    if h.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(_END)
        size = _headers(head).get("content-length", "")
    else:
        payload, size = block, str(len(block))
    said = h.get("warc-payload-digest", "")
    if h.get("warc-type") == "response":
        if str(len(payload)) != size or (said.startswith("sha1:") and base64.b32encode(hashlib.sha1(payload).digest()).decode() != said[5:]):
            return None
    if not size.isdigit():
        return None
    return end + 4, {"record_type": h.get("warc-type", ""), "record_id": h.get("warc-record-id", ""), "refers_to_id": h.get("warc-refers-to"), "url": h.get("warc-target-uri", ""), "payload_digest": said[5:] if said.startswith("sha1:") else base64.b32encode(hashlib.sha1(payload).digest()).decode(), "payload_bytes": int(size), "payload": payload if h.get("warc-type") != "revisit" else None}


def _open(data: bytes | bytearray, at: int, whole: bool):
    """The gzip member that starts at `at`: where it ends and its records; None or _MORE as in _parse.

    A member that doesn't open with a version line is given up after its first bytes, so that looking for the next one
    among damaged bytes stays cheap.
    """
    member, plain, to = zlib.decompressobj(31), bytearray(), at
    try:
        while not member.eof and to < len(data):
            step = 512 if to == at else 1 << 18
            plain += member.decompress(bytes(data[to : to + step]))
            to = min(to + step, len(data))
            if not plain.startswith(b"WARC/1."[: len(plain)]) or len(plain) > MOST_RECORD:
                return None
    except zlib.error:
        return None
    if not member.eof:
        return None if whole else _MORE
    end = to - len(member.unused_data)
    one = _parse(plain, 0, True)
    if one and one[0] == len(plain):
        return end, [one[1]]
    inner = [r for *_, r in salvage(io.BytesIO(plain))] if plain else []
    return (end, inner) if any(inner) else None


def salvage(data: bytes | BinaryIO) -> Iterator[tuple[int, int, dict | None]]:
    """(start, end, record) for each record, and (start, end, None) for each quarantined gap, in order, covering the data.

    Several records in one gzip member share the member's range; a gap between them has that range, too. From a stream, no
    more is held than the record at hand and a chunk.
    """
    stream = io.BytesIO(data) if isinstance(data, bytes | bytearray | memoryview) else data
    held, base, at, gap, whole = bytearray(), 0, 0, None, False
    while True:
        if at == len(held) and whole:
            break
        zipped = held.startswith(_MEMBER, at)
        found = _MORE if len(held) - at < 7 and not whole else _open(held, at, whole) if zipped else _parse(held, at, whole)
        if found is _MORE:
            del held[:at]
            base, at = base + at, 0
            more = stream.read(max(CHUNK, len(held)))
            whole = not more
            held += more
            continue
        if found:
            end, records = found
            while zipped and held.startswith(_NOTHING, end):
                end += len(_NOTHING)
            if gap is not None:
                yield gap, base + at, None
                gap = None
            for r in records if zipped else (records,):
                yield base + at, base + end, r
            at = end
            continue
        gap = base + at if gap is None else gap
        places = [p for p in (held.find(b"WARC/1.", at + 1), held.find(_MEMBER, at + 1)) if p >= 0]
        # without a place, go on just before the end: a mark may be cut in two there
        at = min(places, default=len(held) if whole else max(at + 1, len(held) - 6))
    if gap is not None:
        yield gap, base + at, None


_FIELDS = ["record_type", "record_id", "refers_to_id", "url", "payload_digest", "payload_bytes", "payload"]
_ROWS = "archive string, start long, end long, quarantined boolean, record_type string, record_id string, refers_to_id string, url string, payload_digest string, payload_bytes long, payload binary"


def _rows(path: str, data: bytes | BinaryIO) -> Iterator[pd.DataFrame]:
    names = ["archive", "start", "end", "quarantined", *_FIELDS]
    out, held = [], 0
    for start, end, r in salvage(data):
        out.append((path, start, end, r is None, *(r[c] if r else None for c in _FIELDS)))
        held += 200 + len(r["payload"] or b"") if r else 200
        if held >= CHUNK:
            yield pd.DataFrame(out, columns=names).astype({"payload_bytes": "Int64"})
            out, held = [], 0
    if out:
        yield pd.DataFrame(out, columns=names).astype({"payload_bytes": "Int64"})


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, data in zip(pdf.path, pdf.content, strict=True):
            yield from _rows(path, data)
    release_memory()


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for pdf in batches:
        for path in pdf.path:
            system, name = fs.FileSystem.from_uri(path)
            with system.open_input_stream(name) as stream:
                yield from _rows(path, stream)


def read_warc(spark, path: str, whole_bytes: int = 1 << 28) -> DataFrame:
    """One row per record and per quarantined gap of the archives below path, with byte range, fields and payload.

    Damaged records are in gaps, and later records are found again. An archive without a record gives one gap; an empty
    archive gives nothing. Archives of up to whole_bytes are read by Spark, larger ones as a stream through pyarrow's
    file systems, one task each; both give the same rows.
    """
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= whole_bytes).select("path", "content").mapInPandas(_read, _ROWS)
    large = files.where(F.col("length") > whole_bytes).select("path")
    return small if large.isEmpty() else small.unionByName(large.repartition("path").mapInPandas(_stream, _ROWS))


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"<urn:page:(-?\d+)>", 1).try_cast("long")
