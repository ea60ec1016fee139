"""WARC archives: one record per page, read back through an index of byte ranges.

Each task writes its pages to files of its own (one gzip member per record) and returns an index row
per record: file, offset, length, URL, digest. A file name holds the task attempt, and only the
attempt that succeeds has its rows in the stored index, so a lost executor or a repeated task leaves at
most files that nothing refers to. Readers sort the selected index rows by file and offset, join
neighbouring ranges to one read of bounded size, and parse the records from it.

Files go through ``pyarrow.fs``, to the folder given; it must be one that all executors share.

Of records with equal payloads of ``revisit_from`` bytes or more, that with the smallest id is the
response and the others revisit it. Defined results: a null payload is empty; rows that repeat the
smallest id with the same payload are all responses; a null id is larger than any other; a null URL
gives a record without target; control characters and blanks of a URL are percent-encoded in the
header only. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hearthline.sources.stages import shared_folder, stage

_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, id string, url string, digest string, record_type string"


@dataclass(frozen=True)
class Settings:
    revisit_from: int = 100  # bytes
    file_bytes: int = 256 << 20
    read_bytes: int = 4 << 20  # of one read, but for a longer record
    read_gap: int = 64 << 10  # bytes between two ranges that are read over
    task_bytes: int = 64 << 20  # of a file, read by one task
    date: str = "1970-01-01T00:00:00Z"


def open_folder(path: str):
    """A file system and the path in it; a path without a scheme is local."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _record(kind: str, id: str | None, body: bytes, settings: Settings, more: list[tuple[str, str]]) -> bytes:
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{quote(id, safe='') if id is not None else ''}>"),
        ("WARC-Date", settings.date),
        *more,
        ("Content-Length", str(len(body))),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + body + _END


def page_record(id: str | None, url: str | None, payload: bytes, n: int, digest: str, refers_to: str | None,
                settings: Settings) -> bytes:
    """A response, or a revisit if ``refers_to`` is given; ``n`` and ``digest`` are the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    more = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        more.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f-\xa0]", lambda m: quote(m[0]), url)))
    if refers_to is None:
        return _record("response", id, http + payload, settings, more)
    more += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{quote(refers_to, safe='')}>")]
    return _record("revisit", id, http, settings, more)


def parse(record: bytes) -> dict:
    """Headers and payload of a record; the payload of a revisit is ``None``."""
    head, body = record.split(_END, 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = dict(line.split(": ", 1) for line in lines[1:])
    body = body[: int(named["Content-Length"])]
    http, payload = body.split(_END, 1)
    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = named["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = named["WARC-Type"]
    if kind == "response":
        if len(payload) != n or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {named['WARC-Record-ID']} differs from its digest")
    name = lambda urn: unquote(urn[len("<urn:page:") : -1]) or None
    return {
        "id": name(named["WARC-Record-ID"]),
        "url": named.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": n,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": name(named["WARC-Refers-To"]) if "WARC-Refers-To" in named else None,
    }


class _Files:
    """The files of one task attempt, each closed when it is large enough."""

    def __init__(self, folder: str, settings: Settings):
        self.system, self.folder = open_folder(folder)
        self.uri, self.settings = folder, settings
        self.system.create_dir(self.folder, recursive=True)
        context = TaskContext.get()
        self.name, self.n = f"{context.partitionId():06d}-{context.taskAttemptId()}", 0
        self.out = None

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.file, self.at = f"{self.name}-{self.n:04d}.warc.gz", 0
            self.out = self.system.open_output_stream(f"{self.folder}/{self.file}", compression=None)
            self._put(_record("warcinfo", self.file, b"software: hearthline\r\n", self.settings, [("Content-Type", "application/warc-fields")]))
        start = self.at
        self._put(record)
        place = (f"{self.uri}/{self.file}", start, self.at - start)
        if self.at >= self.settings.file_bytes:
            self.close()
        return place

    def _put(self, record: bytes) -> None:
        packer = zlib.compressobj(4, zlib.DEFLATED, 31)
        data = packer.compress(record) + packer.flush()
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out, self.n = None, self.n + 1


def revisits(pages: DataFrame, id: str, payload: str, settings: Settings) -> DataFrame:
    """``__id``, ``__digest`` and ``__refers_to`` of the rows that repeat an earlier payload."""
    data = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.where(F.octet_length(data) >= settings.revisit_from).select(
        F.col(id).alias("__id"), F.sha2(data, 256).alias("__digest")
    )
    first = rows.groupBy("__digest").agg(F.min("__id").alias("__refers_to"), F.count("*").alias("n"))
    first = first.where("n > 1 and __refers_to is not null").drop("n")
    later = rows.join(first, "__digest").where("__id is null or __id <> __refers_to")
    return later.select("__id", "__digest", "__refers_to").distinct()


def write_archives(pages: DataFrame, folder: str | None = None, id: str = "page_id", url: str = "url",
                   payload: str = "html", settings: Settings = Settings()) -> DataFrame:
    """Write all ``pages`` and return the stored index."""
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/archives/{uuid.uuid4().hex}"
    data = F.coalesce(F.col(payload), F.lit(""))
    known = stage(revisits(pages, id, payload, settings), "revisits")
    rows = pages.select(
        F.col(id).alias("__own"), F.col(url).alias("__url"), data.alias("__data"), F.sha2(data, 256).alias("__sum")
    )
    rows = rows.join(known, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__sum") == F.col("__digest")), "left")
    rows = rows.select(
        F.col("__own").cast("string"), "__url", "__data", "__sum", F.col("__refers_to").cast("string")
    )

    def write(batches):
        files = None
        for batch in batches:
            files = files or _Files(folder, settings)
            out = []
            for own, link, text, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                body = text.encode()
                place = files.add(page_record(own, link, body, len(body), digest, first, settings))
                out.append((*place, own, link, digest, "response" if first is None else "revisit"))
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["file", "offset", "length", "id", "url", "digest", "record_type"],
            )
        if files:
            files.close()

    return stage(rows.mapInArrow(write, INDEX), "archive-index")


def ranges(rows: list[tuple[int, int]], settings: Settings):
    """Groups of (offset, length) rows, sorted by offset, that are read at once."""
    group: list[tuple[int, int]] = []
    for offset, length in rows:
        if group:
            start, end = group[0][0], group[-1][0] + group[-1][1]
            if offset - end > settings.read_gap or offset + length - start > settings.read_bytes:
                yield group
                group = []
        group.append((offset, length))
    if group:
        yield group


def read_records(index: DataFrame, payload: bool = False, settings: Settings = Settings()) -> DataFrame:
    """The records that ``index`` selects, parsed; with their payloads if asked for."""
    schema = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    schema += ", payload binary" * payload
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    part = F.floor(F.col("offset") / settings.task_bytes)
    # Index rows are small against what they point to: the bytes to read say how many tasks there are.
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, index.sparkSession.sparkContext.defaultParallelism, -(-total // settings.task_bytes))
    sorted_rows = index.select("file", "offset", "length").repartition(tasks, "file", part).sortWithinPartitions("file", "offset")

    def read(batches):
        for batch in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                by_file.setdefault(file, []).append((offset, length))
            for uri, rows in by_file.items():
                system, path = open_folder(uri)
                with system.open_input_file(path) as file:
                    for group in ranges(rows, settings):
                        start = group[0][0]
                        data = file.read_at(group[-1][0] + group[-1][1] - start, start)
                        found = [
                            parse(zlib.decompress(data[o - start : o - start + n], 31)) for o, n in group
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[c] for r in found], t) for c, t in zip(names, types)], names=names
                        )

    return sorted_rows.mapInArrow(read, schema)
