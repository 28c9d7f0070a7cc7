"""WARC archives: write pages, index every record, read selected records back.

Each task writes one archive of separately compressed records to the shared
folder and gives an index row for each: file, offset, length, URL and digest.
The index is written as a table before anything is read. Readers take selected
index rows sorted by file and offset and join neighbouring byte ranges, so a
selection costs few requests however it is spread.

Of records with equal payloads the one of the largest page_id is a response and
the others revisit it; a revisit has the HTTP head but no payload. Equality is
by SHA-1 and length. Payloads move once, dealt by page and digest, so a payload
that a third of all pages share is spread over all tasks.

Defined cases: a null html is an empty payload; a null URL is written as an
empty one and read as null; null page_ids are responses unless a page with an
id has the same payload; repeated rows of the largest page_id are all
responses; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnower.llm.files import file_system, new_file
from winnower.storage import shared_folder, written

_GAP = 64 << 10
_RANGE = 8 << 20
_STRETCH = 8 << 20
_TASK_BYTES = 32 << 20
_GZIP = 31
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = (
    "file string, offset long, length long, url string, payload_digest string,"
    " page_id long, record_type string"
)
_RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, payload binary"
)
_HEAD = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def warc_record(page_id, url, payload: bytes, revisit_of: int | None, date: str) -> bytes:
    """One record, not compressed; ``revisit_of`` is the page_id of its response."""
    digest, revisit = payload_digest(payload), revisit_of is not None
    head = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(revisit_of, digest)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page_of(urn: bytes) -> int | None:
    page = urn.split(b":")[2]
    return int(page) if page else None


def parse_record(record: bytes) -> dict:
    """The fields of one record; a response is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(_HEAD.findall(head + b"\r\n"))
    block = rest[: int(fields[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(_HEAD.findall(http + b"\r\n"))[b"Content-Length"])
    kind = fields[b"WARC-Type"].decode()
    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    revisit = kind == "revisit"
    if not revisit and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields[b'WARC-Record-ID'].decode()}")
    return {
        "page_id": _page_of(fields[b"WARC-Record-ID"]),
        "url": unquote(fields[b"WARC-Target-URI"].decode()) or None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_of(fields[b"WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def _with_response(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """Pages with ``_head``, the page_id of the response they revisit, if any."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("_payload"),
        F.unhex(F.sha1(payload)).alias("_sha1"),
        F.octet_length(payload).alias("_size"),
    )
    narrow = rows.select("page_id", "_sha1", "_size").filter(F.col("_size") >= least)
    groups = (
        narrow.groupBy("_sha1", "_size")
        .agg(F.max("page_id").alias("_head"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    revisits = (
        narrow.join(groups, ["_sha1", "_size"])
        .filter("_head is not null and not (page_id <=> _head)")
        .select(F.col("page_id").alias("_page"), F.col("_sha1").alias("_same"), "_head")
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_sha1") == F.col("_same"))
    return rows.join(revisits, same, "left").select("page_id", "url", "_payload", "_head")


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_revisit_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Writes archives to a shared folder; returns their index, a written table."""
    rows = _with_response(pages, page_id, url, html, least_revisit_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, columns = None, [[] for _ in range(7)]
        part, offset = TaskContext.get().partitionId(), 0
        try:
            for batch in batches:
                for page, target, text, head in zip(
                    *(column.to_pylist() for column in batch.columns), strict=True
                ):
                    if opened is None:
                        opened = new_file(folder, f"pages-{part:06d}", ".warc.gz")
                        name, stream = opened.__enter__()
                    payload = text.encode()
                    record = warc_record(page, target, payload, head, date)
                    packer = zlib.compressobj(6, wbits=_GZIP)
                    packed = packer.compress(record) + packer.flush()
                    stream.write(packed)
                    kind = "response" if head is None else "revisit"
                    row = (name, offset, len(packed), target, payload_digest(payload), page, kind)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += len(packed)
        finally:
            if opened is not None:
                opened.__exit__(None, None, None)
        yield _batch(columns, _INDEX)

    return written(pages.sparkSession, rows.mapInArrow(run, _INDEX), "warc-index")


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(",")]
    arrays = [pa.array(v, _TYPES[kind]) for v, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs of sorted records of one file that one read may fetch."""
    run, file, end = [], None, 0
    for name, offset, length in rows:
        near = name == file and offset - end <= _GAP and offset + length - run[0][0] <= _RANGE
        if run and not near:
            yield file, run
            run = []
        run.append((offset, length))
        file, end = name, max(offset + length, end if near else 0)
    if run:
        yield file, run


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records of selected index rows; sorted, neighbouring ranges are read at once.

    Stretches of files are dealt to as many tasks as their bytes ask for: adaptive
    execution would merge them by the few bytes of their index rows.
    """
    stretch = F.floor(F.col("offset") / _STRETCH)
    wanted = index.agg(F.sum("length")).first()[0] or 0
    dealt = (
        index.select("file", "offset", "length")
        .repartition(-(-wanted // _TASK_BYTES) or 1, "file", stretch)
        .sortWithinPartitions("file", "offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        rows = (
            row
            for batch in batches
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)
        )
        for file, wanted in _ranges(rows):
            start = wanted[0][0]
            with store.open_input_file(f"{base}/{file}") as stream:
                data = stream.read_at(max(o + n for o, n in wanted) - start, start)
            records = [
                parse_record(zlib.decompress(data[o - start : o - start + n], wbits=_GZIP))
                for o, n in wanted
            ]
            yield _batch([[r[k] for r in records] for k in records[0]], _RECORD)

    return dealt.mapInArrow(run, _RECORD)


def archive_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Writes all pages to archives in a new shared folder and reads every record."""
    folder = shared_folder(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder, **columns), folder)
