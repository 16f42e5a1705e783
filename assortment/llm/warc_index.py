"""WARC archives with a two-level capture index.

Tasks write gzip-per-record archives into the shared folder. Captures are range-sorted by reversed-host URL key;
each range becomes an index file of compressed blocks of some thousand lines, and a sparse directory with the
first key of each block. A lookup goes to the ranges that may hold its key, binary-searches the directory, reads
one block, binary-searches that, and reads the record's bytes from its archive. The driver knows one first and
last key per range; a key with very many captures lies in many ranges.

Files of an attempt that did not end well are named nowhere, as only rows of finished tasks are.
"""

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment.llm.texts import side
from assortment.llm.url_rules import LOWER, UPPER
from assortment.sources.lineage import cut, work_path

LEAST_SHARED = 100
BLOCK_LINES = 2000
#: Archive bytes that a task reads, and those read together.
TASK_BYTES = 64 << 20
NEAR_BYTES = 2 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def url_key(url: Column) -> Column:
    """Reversed host, `)`, then path and query: `net,example,blog)/en/25`. Scheme and fragment do not count; an
    address without `://` is its own key and null is the empty one."""
    at = F.instr(url, "://")
    rest = F.regexp_extract(F.substr(url, at + 3, F.length(url)), "^[^#]*", 0)
    raw_host = F.regexp_extract(rest, "^[^/?]*", 0)
    labels = F.reverse(F.split(F.translate(raw_host, UPPER, LOWER), r"\."))
    key = F.concat(F.array_join(labels, ","), F.lit(")"), F.substr(rest, F.length(raw_host) + 1, F.length(rest)))
    return F.coalesce(F.when(at > 0, key).otherwise(url), F.lit(""))


def with_types(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page, url, url_key, payload, digest, refers_to): refers_to is the smallest page with the same payload of
    at least LEAST_SHARED bytes, where that is another page."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    own = pages.select(
        F.col(key).cast("long").alias("page"), F.col(url).alias("url"), url_key(F.col(url)).alias("url_key"),
        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
    )
    shared = own.where(F.octet_length("payload") >= LEAST_SHARED).groupBy("digest").agg(
        F.min("page").alias("first"), F.count(F.lit(1)).alias("n")
    )
    first = side(shared.where("n > 1").select(F.unhex("digest").alias("same"), "first"))
    joined = own.join(first, F.unhex("digest") == F.col("same"), "left").drop("same")
    other = F.when(F.coalesce(F.col("page") != F.col("first"), F.lit(True)), F.col("first"))
    return joined.withColumn("refers_to", other).drop("first")


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit that has the payload's length and digest but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page is None else page}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=chr(37) + '!#$&()*+,/:;=?@[]~' + chr(39))}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + END + block + END) + packer.flush()


@dataclass(frozen=True)
class Record:
    page: int | None
    kind: str
    digest: str
    payload_bytes: int
    refers_to: int | None
    payload: bytes | None


def parsed(member: bytes) -> Record:
    """The record of one gzip member; a response's payload is held against its digest."""
    head, _, rest = zlib.decompress(member, 31).partition(END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(END)
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda name: (lambda t: int(t) if t else None)(fields.get(name, "").removeprefix("<urn:x-page:").removesuffix(">"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of page {number('WARC-Record-ID')} does not have its digest")
    return Record(number("WARC-Record-ID"), kind, digest, length, number("WARC-Refers-To"), payload if kind == "response" else None)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record per row of `pages` and return the captures: (url_key, page, file, at, size)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _place(folder)
        store.create_dir(path, recursive=True)
        name, out, at = f"archive-{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                rows = []
                for row in _rows(batch):
                    member = record_bytes(row["page"], row["url"], row["payload"], row["digest"], row["refers_to"])
                    out = out or store.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(member)
                    rows.append((row["url_key"], row["page"], name, at, len(member)))
                    at += len(member)
                yield _batch(rows, CAPTURE)
        finally:
            if out:
                out.close()

    typed = with_types(pages, key, url, html).select("page", "url", "url_key", "payload", "digest", "refers_to")
    return cut(typed.mapInArrow(write, "url_key string, page long, file string, at long, size long"))


CAPTURE = {"url_key": pa.string(), "page": pa.int64(), "file": pa.string(), "at": pa.int64(), "size": pa.int64()}


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one after another, not all at once."""
    columns = [batch.column(i) for i in range(batch.num_columns)]
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, columns)}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index and return its ranges: (first, last, file, blocks, captures), one row each."""
    order = ["url_key", "page", "file", "at"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _place(folder)
        store.create_dir(path, recursive=True)
        name, held, directory, at, total, last, out = f"index-{uuid.uuid4().hex}", [], [], 0, 0, None, None

        def close_block() -> None:
            nonlocal held, at
            data = zlib.compress("\n".join(json.dumps(line) for line in held).encode())
            out.write(data)
            directory.append([held[0][0], at, len(data)])
            at += len(data)
            held = []

        try:
            for batch in batches:
                for row in _rows(batch):
                    out = out or store.open_output_stream(f"{path}/{name}", compression=None)
                    held.append([row[c] for c in CAPTURE])
                    total, last = total + 1, row["url_key"]
                    if len(held) == block_lines:
                        close_block()
            if held:
                close_block()
        finally:
            if out:
                out.close()
        if total:
            with store.open_output_stream(f"{path}/{name}.directory", compression=None) as side:
                side.write(zlib.compress(json.dumps(directory).encode()))
            yield _batch([(directory[0][0], last, name, len(directory), total)], RANGE)

    dealt = captures.select(*CAPTURE).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(dealt.mapInArrow(write, "first string, last string, file string, blocks long, captures long"))


RANGE = {"first": pa.string(), "last": pa.string(), "file": pa.string(), "blocks": pa.int64(), "captures": pa.int64()}


class IndexFile:
    """One range of the index: its directory in memory, one block at a time."""

    def __init__(self, folder: str, name: str) -> None:
        self.store, path = _place(folder)
        with self.store.open_input_stream(f"{path}/{name}.directory", compression=None) as side:
            self.directory = json.loads(zlib.decompress(side.read()))
        self.firsts = [entry[0] for entry in self.directory]
        self.data, self.number, self.lines = self.store.open_input_file(f"{path}/{name}"), -1, []

    def block(self, number: int) -> list[list]:
        if number != self.number:
            _, at, size = self.directory[number]
            self.data.seek(at)
            self.lines = [json.loads(line) for line in zlib.decompress(self.data.read(size)).split(b"\n")]
            self.number = number
        return self.lines

    def find(self, key: str) -> Iterator[list]:
        """All captures of a key; the first block that can hold it is that before the first block beginning with it."""
        for number in range(max(0, bisect_left(self.firsts, key) - 1), len(self.firsts)):
            if self.firsts[number] > key:
                return
            lines = self.block(number)
            for line in lines[bisect_left(lines, key, key=lambda x: x[0]):]:
                if line[0] != key:
                    return
                yield line

    def close(self) -> None:
        self.data.close()


def lookup(keys: DataFrame, ranges: DataFrame, folder: str) -> DataFrame:
    """The captures of each distinct key in the column `url_key` of `keys`; unknown keys have none."""
    known = sorted(map(tuple, ranges.select("first", "last", "file").collect()))  # one row per index file
    # Python and Spark order these strings alike: code points and UTF-8 bytes have the same order.
    firsts, lasts = [r[0] for r in known], [r[1] for r in known]

    @F.arrow_udf("array<string>")
    def files(keys: pa.Array) -> pa.Array:
        return pa.array([
            [known[i][2] for i in range(bisect_left(lasts, k), bisect_right(firsts, k))] for k in keys.to_pylist()
        ], pa.list_(pa.string()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, index = None, None
        for batch in batches:
            rows = []
            for file, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != name:
                    if index:
                        index.close()
                    name, index = file, IndexFile(folder, file)
                for line in index.find(key):
                    rows.append(tuple(line))
                    if len(rows) == 10_000:
                        yield _batch(rows, CAPTURE)
                        rows = []
            yield _batch(rows, CAPTURE)

    wanted = keys.select(F.coalesce("url_key", F.lit("")).alias("url_key")).distinct()
    routed = wanted.select(F.explode(files("url_key")).alias("file"), "url_key")
    # A number of its own: the keys are small, but each stands for a read from an index file.
    return routed.repartition(max(1, len(known)), "file").sortWithinPartitions("file", "url_key").mapInArrow(
        read, "url_key string, page long, file string, at long, size long"
    )


def fetch(captures: DataFrame, folder: str) -> DataFrame:
    """(page, payload_bytes, digest, kind, refers_to, payload) read from the archives by range reads; the payload is
    null for a revisit.

    Captures are written first; the number of reading tasks follows the bytes that they name, not their own.
    """
    kinds = {
        "page": pa.int64(), "payload_bytes": pa.int64(), "digest": pa.string(), "kind": pa.string(),
        "refers_to": pa.int64(), "payload": pa.binary(),
    }

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _place(folder)
        name, archive = None, None
        for batch in batches:
            rows, size = [], 0
            for row in _rows(batch):
                if row["file"] != name:
                    if archive:
                        archive.close()
                    name, archive = row["file"], store.open_input_file(f"{path}/{row['file']}")
                archive.seek(row["at"])
                found = parsed(archive.read(row["size"]))
                rows.append((found.page, found.payload_bytes, found.digest, found.kind, found.refers_to, found.payload))
                size += found.payload_bytes
                if size > 8 << 20:
                    yield _batch(rows, kinds)
                    rows, size = [], 0
            yield _batch(rows, kinds)

    wanted = cut(captures.select("file", "at", "size"))
    total = wanted.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(wanted.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    near = wanted.repartition(tasks, "file", F.floor(F.col("at") / NEAR_BYTES))
    return near.sortWithinPartitions("file", "at").mapInArrow(
        read, "page long, payload_bytes long, digest string, kind string, refers_to long, payload binary"
    )


@dataclass(frozen=True)
class Archive:
    """Archives and index of a set of pages."""

    folder: str
    ranges: DataFrame

    def find(self, keys: DataFrame) -> DataFrame:
        """The records of all captures of each distinct `url_key`."""
        return fetch(lookup(keys, self.ranges, self.folder), self.folder)


def archived(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    """Write archives and index for `pages` into a new folder of the shared one, or the one named.

    Every row is a record, repeated rows too; rows of the page that holds a payload first are all responses. A
    null payload counts as empty; a null url has the empty key; a null page id is never first among pages with a
    number. An empty table writes an empty index. Other columns are ignored.
    """
    folder = folder or work_path(pages.sparkSession, "warc")
    return Archive(folder, write_index(write_archives(pages, folder, key, url, html), folder))
