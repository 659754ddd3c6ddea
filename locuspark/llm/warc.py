"""WARC archives, index first: offsets are known before records are read back.

Each task writes its rows as records, every record a gzip member of its own, to archive
files of a bounded size in the shared folder, and returns one index row per record
(archive file, offset, length, URL, digest). The index is a Spark table, so it lists what
successful tasks wrote and nothing of an attempt that was lost. Reading takes the
selected index rows in order of file and offset, joins ranges that touch or nearly
touch, and reads each joined range once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.llm.shared import checkpoint, column, if_small, shared_path, text_slices

#: Archive bytes that one task reads back.
TASK_BYTES = 64 << 20
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_INDEX = "path string, offset long, length long, page_id long, url string, record_type string, payload_digest string"
_INDEX_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_INDEX_TYPES = [pa.int64() if c.endswith(" long") else pa.string() for c in _INDEX.split(", ")]


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 hex digits are 8 groups of 20 bits, 4 letters each."""
    digest = F.sha1(payload)
    out = []
    for g in range(8):
        bits = F.conv(F.substring(digest, 1 + 5 * g, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(_BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _store(uri: str):
    """The file system and path of a URI, for tasks that write or read byte ranges."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri if ":" in uri else f"file://{uri}"))


@dataclass
class Archives:
    """A written set: the folder of the archive files and the folder of the index."""

    records: str
    index: str

    def read_index(self, spark: SparkSession) -> DataFrame:
        """(path, offset, length, page_id, url, record_type, payload_digest): one row per record."""
        return spark.read.schema(_INDEX).parquet(self.index)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first_id: int | None, date: str) -> bytes:
    """One WARC record; a revisit (first_id given) has no payload, but its length and digest."""
    body = payload if first_id is None else b""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first_id is None else 'revisit'}"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if first_id is not None:
        lines += [f"WARC-Refers-To: <urn:page:{first_id}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, archive_bytes: int = 256 << 20, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> Archives:
    """Write a record per page and the index of all records.

    The page with the smallest id of those with equal payloads is a response, the others
    are revisits that refer to it. Only payloads that occur more than once are looked up:
    broadcast where they are few by count, else joined by digest (a hot one is split). A null
    html is an empty payload, a null url writes no target, control characters in a url are
    percent-encoded. A page without id is a revisit if its payload has an id elsewhere. A row
    repeated with one id and payload gets a record of the same type each time. Extra
    columns are ignored; an empty table gives an empty index.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    base = base.withColumn("digest", sha1_base32(F.col("html").cast("binary")))
    many = checkpoint(base.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    first = F.when(F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(None)).otherwise(F.col("first_id"))
    placed = base.join(if_small(many, many.count()), "digest", "left").withColumn("first_id", first)
    made = Archives(shared_path(spark, "warc"), shared_path(spark, "warc-index"))
    folder = made.records

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _store(folder)
        system.create_dir(root, recursive=True)
        file, name, at = None, "", 0
        try:
            for b in text_slices(batches):
                out = []
                for page, url, text, digest, first in zip(*(column(b, c) for c in ("page_id", "url", "html", "digest", "first_id")), strict=True):
                    if file is None or at >= archive_bytes:
                        if file:
                            file.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        file = system.open_output_stream(f"{root}/{name}", compression=None)
                    plain = record_bytes(page, url, text.encode("utf-8"), digest, first, date)
                    pack = zlib.compressobj(5, zlib.DEFLATED, 31)
                    data = pack.compress(plain) + pack.flush()
                    file.write(data)
                    out.append((f"{folder}/{name}", at, len(data), page, url, "response" if first is None else "revisit", digest))
                    at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _INDEX_TYPES, strict=True)], _INDEX_NAMES)
        finally:
            if file:
                file.close()

    placed.select("page_id", "url", "html", "digest", "first_id").mapInArrow(run, _INDEX).write.parquet(made.index)
    return made


def _ranges(rows: Iterator[tuple], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Joined byte ranges (path, start, end, records) of index rows sorted by path and offset."""
    path, start, end, inside = None, 0, 0, []
    for p, o, n in rows:
        if inside and p == path and o - end <= gap and max(end, o + n) - start <= most:
            end = max(end, o + n)
        else:
            if inside:
                yield path, start, end, inside
            path, start, end, inside = p, o, o + n, []
        inside.append((o, n))
    if inside:
        yield path, start, end, inside


def parse_record(record: bytes) -> dict:
    """Headers (lower-case names) and payload of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    headers = {k.lower(): v for k, v in headers.items()}
    return headers | {"payload": rest[: int(headers["content-length"])]}


def read_records(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20, with_payload: bool = True) -> DataFrame:
    """Read the records of the given index rows: (page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]).

    Index rows are sorted by file and offset; ranges at most ``gap`` bytes apart are one read
    of at most ``most`` bytes (a longer record is read alone). A response's digest is
    computed from the bytes read and must be the one in its header. The number of tasks
    follows from the bytes to read, ``TASK_BYTES`` for each, not from the small index.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((p, o, n) for b in batches for p, o, n in zip(b["path"], b["offset"], b["length"], strict=True))
        opened, name = None, None
        for path, start, end, inside in _ranges(rows, gap, most):
            if path != name:
                system, at = _store(path)
                opened, name = system.open_input_file(at), path
            data = opened.read_at(end - start, start)
            out = []
            for o, n in inside:
                r = parse_record(gzip.decompress(data[o - start : o - start + n]))
                digest = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                said = r["warc-payload-digest"].removeprefix("sha1:")
                if r["warc-type"] == "response" and digest != said:
                    raise ValueError(f"the record at {o} of {path} does not have its digest")
                page = lambda k, r=r: int(r[k][len("<urn:page:") : -1]) if k in r else None
                out.append((page("warc-record-id"), r.get("warc-target-uri"), int(r["x-payload-length"]), said, r["warc-type"], page("warc-refers-to"), r["payload"]))
            frame = pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
            for c in ("page_id", "refers_to"):
                frame[c] = frame[c].astype("Int64")
            yield frame if with_payload else frame.drop(columns="payload")

    shape = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    rows = index.select("path", "offset", "length")
    size = rows.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES), min(rows.sparkSession.sparkContext.defaultParallelism, size >> 20))
    return rows.repartition(tasks, F.col("path"), F.floor(F.col("offset") / most)).sortWithinPartitions("path", "offset").mapInPandas(run, shape + (", payload binary" if with_payload else ""))
