"""WARC archives of web pages, with a two-level capture index, and reading by range.

Each task writes its pages as records, one gzip member each, into files of the shared folder.
A payload that several pages have is stored with one of them; the others revisit it. Captures are
sorted by a key of reversed host and path and dealt by range into shards. A shard is a file of
compressed blocks of captures; its directory has the first key and the place of each block. To
find a capture, the shard, then the block is found by binary search, and one block is read.

Files have names of their own for each attempt of a task, and only those that a finished task
reports are ever looked at; so a lost executor leaves at most files that nobody reads.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import shared_path, tidy, written

#: Captures in a block; bytes after which a task begins another archive.
BLOCK, ARCHIVE_BYTES = 500, 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "urlkey string, file string, offset long, length long"


def url_key(url: str | None, page_id: int | None) -> str:
    """Host in reverse, path and query, without scheme, port or fragment, then the page's id."""
    try:
        parts = urlsplit(url or "")
        host = ",".join(reversed((parts.hostname or "").split(".")))
        key = f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")
    except ValueError:
        key = f"){url}"
    return f"{key} {'-' if page_id is None else f'{page_id:020d}'}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(row))}>"


def _line(text: object) -> str:
    """Text that cannot end a header line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in str(text))


def record(row: int, page_id: int | None, url: str | None, payload: bytes, keep_row: int | None, keep_id: int | None, date: str) -> bytes:
    """One WARC record: a response, or the revisit of the one of ``keep_row``."""
    revisit = keep_row is not None and keep_row != row
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(row),
        "WARC-Date": date,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
    }
    fields |= {"WARC-Target-URI": _line(url)} if url else {}
    fields |= {"Page-ID": str(page_id)} if page_id is not None else {}
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(keep_row)}
        fields |= {"Refers-To-Page-ID": str(keep_id)} if keep_id is not None else {}
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's fields and payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block, end = rest[: (n := int(fields["Content-Length"]))], rest[n:]
    if end != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return fields, block.partition(b"\r\n\r\n")[2]


class Output:
    """Files of one task under a folder that any Spark file system may hold."""

    def __init__(self, folder: str, kind: str):
        self.system, self.folder = FileSystem.from_uri(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.kind, self.file, self.at = kind, None, 0

    def open(self) -> None:
        self.close()
        self.name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.{self.kind}"
        self.file, self.at = self.system.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0

    def write(self, data: bytes) -> tuple[str, int, int]:
        """Name, offset and length of what is written."""
        self.file.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        if self.file:
            self.file.close()


class Ranges:
    """Reads by range; the last file stays open."""

    def __init__(self, folder: str):
        self.system, self.folder = FileSystem.from_uri(folder)
        self.name, self.file = "", None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            self.name, self.file = name, self.system.open_input_file(f"{self.folder}/{name}")
        return self.file.read_at(length, offset)

    def whole(self, name: str) -> bytes:
        with self.system.open_input_file(f"{self.folder}/{name}") as f:
            return f.read()


@dataclass(frozen=True)
class Archive:
    """Where the archives and the index lie; the first key, the file and the directory of each shard."""

    folder: str
    shards: tuple[tuple[str, str, str], ...]


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            rows = []
            columns = (batch[c].to_pylist() for c in ("__row", "page_id", "url", "keep_row", "keep_id"))
            for row, page, url, keep_row, keep, html in zip(*columns, batch["html"], strict=True):
                if out is None:
                    out = Output(folder, "warc.gz")
                if out.file is None or out.at >= ARCHIVE_BYTES:
                    out.open()
                payload = html.as_py().encode("utf-8", "surrogatepass")
                data = gzip.compress(record(row, page, url, payload, keep_row, keep, date), 1, mtime=0)
                rows.append((url_key(url, page), *out.write(data)))
            yield _captures(rows)
        if out:
            out.close()

    return run


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    made = zip(*rows, strict=True) if rows else [[]] * 4
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(made, kinds, strict=True)], ["urlkey", "file", "offset", "length"]
    )


def _index(folder: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, directory = None, [], []

        def flush() -> None:
            lines = "\n".join(json.dumps(x) for x in held).encode()
            directory.append((held[0][0], *out.write(zlib.compress(lines))[1:]))
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = Output(folder, "cdx")
                    out.open()
                held.append(row)
                if len(held) == block:
                    flush()
        if out:
            if held:
                flush()
            out.close()
            index = Output(folder, "dir")
            index.open()
            index.write(json.dumps(directory).encode())
            index.close()
            yield pa.RecordBatch.from_pydict({"first": [directory[0][0]], "file": [out.name], "dir": [index.name]})

    return run


def write_archive(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_payload: int = 0,
    block: int = BLOCK,
    date: str = "2000-01-01T00:00:00Z",
) -> Archive:
    """Write every page as a record and index all captures.

    Of pages with equal payloads of at least ``min_payload`` bytes that with the largest id is the
    response. A null html is an empty payload, a null url has an empty key, and a null id ranks
    below all others; of rows with equal id and payload any one is the response.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.monotonically_increasing_id().alias("__row"), F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"), F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
    )
    rows = written(rows, "pages")
    content = F.when(F.octet_length("html") >= min_payload, F.sha2(F.col("html").cast("binary"), 256)).alias("content")
    last = F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "__row")).alias("last")
    repeated = rows.select(content, "page_id", "__row").groupBy("content").agg(last, F.count("*").alias("n"))
    repeated = repeated.where("content IS NOT NULL AND n > 1")
    repeated = written(
        repeated.select("content", F.col("last.__row").alias("keep_row"), F.col("last.page_id").alias("keep_id")), "repeated"
    )
    folder = shared_path(spark, "warc")
    typed = rows.withColumn("content", content).join(repeated, "content", "left").drop("content")
    captures = written(typed.mapInArrow(tidy(_write(folder, date)), CAPTURE), "captures")
    order = [F.col("urlkey"), F.col("file"), F.col("offset")]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = ranged.mapInArrow(tidy(_index(folder, block)), "first string, file string, dir string")
    shards = written(shards, "shards").orderBy("first", "file").collect()  # one row for each task above
    return Archive(folder, tuple((s["first"], s["file"], s["dir"]) for s in shards))


def _lookup(archive: Archive):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(archive.folder) if archive.shards else None
        firsts = [s[0] for s in archive.shards]
        directories: dict[int, list] = {}
        last: tuple | None = None
        lines: list = []
        for batch in batches:
            rows = []
            for key in batch["urlkey"].to_pylist():
                shard = max(bisect_left(firsts, key) - 1, 0)
                while shard < len(firsts) and firsts[shard] <= key:  # equal keys may go on in the next shard
                    if shard not in directories:
                        directories = {shard: json.loads(ranges.whole(archive.shards[shard][2]))}
                    directory = directories[shard]
                    at = max(bisect_left(directory, key, key=lambda x: x[0]) - 1, 0)
                    for k in range(at, len(directory)):
                        first, offset, length = directory[k]
                        if first > key:
                            break
                        if last != (shard, k):
                            data = zlib.decompress(ranges.read(archive.shards[shard][1], offset, length))
                            lines, last = [tuple(json.loads(x)) for x in data.split(b"\n")], (shard, k)
                        low = bisect_left(lines, key, key=lambda x: x[0])
                        rows += lines[low : bisect_right(lines, key, key=lambda x: x[0])]
                    shard += 1
            yield _captures(rows)

    return run


def lookup(archive: Archive, keys: DataFrame) -> DataFrame:
    """The captures of each distinct ``urlkey``."""
    keys = keys.select("urlkey").distinct()
    sent = keys.repartitionByRange("urlkey").sortWithinPartitions("urlkey")
    return sent.mapInArrow(tidy(_lookup(archive)), CAPTURE)


def _records(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(folder)
        for batch in batches:
            rows = []
            for name, offset, length in zip(*(batch[c].to_pylist() for c in ("file", "offset", "length")), strict=True):
                fields, payload = parsed(gzip.decompress(ranges.read(name, offset, length)))
                page, refers = (int(fields[k]) if k in fields else None for k in ("Page-ID", "Refers-To-Page-ID"))
                if fields["WARC-Type"] == "response":
                    own = payload_digest(payload)
                    if f"sha1:{own}" != fields["WARC-Payload-Digest"]:
                        raise ValueError(f"the payload of page {page} is damaged")
                rows.append((page, fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), refers,
                             fields["WARC-Payload-Digest"].removeprefix("sha1:"), payload))
            made = zip(*rows, strict=True) if rows else [[]] * 7
            kinds = (pa.int64(), *(pa.string(),) * 3, pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(made, kinds, strict=True)],
                ["page_id", "record_type", "record_id", "refers_to_record", "refers_to", "payload_digest", "payload"],
            )

    return run


def read_records(archive: Archive, captures: DataFrame) -> DataFrame:
    """The records at ``file, offset, length``, read by range in the files' order; a revisit has no payload."""
    place = [F.col("file"), F.col("offset")]
    return captures.repartitionByRange(*place).sortWithinPartitions(*place).mapInArrow(
        tidy(_records(archive.folder)),
        "page_id long, record_type string, record_id string, refers_to_record string, refers_to long, "
        "payload_digest string, payload binary",
    )


def _url_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [url_key(u, p) for u, p in zip(batch["url"].to_pylist(), batch["page_id"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["urlkey"])


def url_keys(pages: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """The index key of each page."""
    plain = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"))
    return plain.mapInArrow(tidy(_url_keys), "urlkey string")


def archived_pages(pages: DataFrame) -> DataFrame:
    """Every page through its archive: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Pages are looked up by key and read by range. Length and digest of a revisit are those of the
    payload that it refers to. An empty table gives an empty result.
    """
    archive = write_archive(pages)
    found = read_records(archive, lookup(archive, url_keys(pages)))
    found = written(found.withColumn("n", F.length("payload").cast("long")).drop("payload"), "records")
    first = found.where("record_type = 'response'")
    again = found.where("record_type = 'revisit'").drop("n").join(
        first.select(F.col("record_id").alias("refers_to_record"), "n"), "refers_to_record"
    )
    columns = ["page_id", F.col("n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    return first.select(*columns).unionByName(again.select(*columns))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
