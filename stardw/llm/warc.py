"""Web archives: one gzip member per record, written by tasks and read by byte ranges.

`write` files a record per page. Of pages with equal payloads of at least
`LEAST_REVISIT` bytes the one with the largest id is the response and the
others are revisits that refer to it. A task writes to a name of its own and
moves the finished file into place, so a task that runs again replaces its
file; the list of files is stored last and only listed files are read.

`read` cuts files into ranges that any task can take. A task looks for the
bytes that begin a gzip member, decodes the beginning of each candidate, takes
it for a record only if it reads as a WARC header, and owns the members that
begin inside its range, the last of which it reads to its end beyond the
range. Bytes that only look like a member fail to decode and are passed over.
Members with several records are read whole. A member that begins as a record
and breaks off raises an error with its file and offset.

A null payload is empty, a null id or address stays null. Equal rows are
records of their own; those that share the largest id are all responses. Pages
without an id count as smaller than all others. An empty table writes no file
and reads as no rows. Long payloads are held one at a time.
"""

from __future__ import annotations

import base64
import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.llm.tables import stored

LEAST_REVISIT = 1000
FILE_BYTES = 1 << 30
RANGE_BYTES = 1 << 24
CHUNK = 1 << 13
AHEAD = 1 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = ("path string, offset bigint, type string, record_id string, uri string, refers_to string, "
          "digest string, length bigint, payload binary")


def typed(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Columns `key`, `url`, `payload` (bytes), `digest` (lower-case hex) and `refers_to`."""
    body = F.coalesce(F.encode(F.col(payload), "utf-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    same = (
        rows.filter(F.length("payload") >= LEAST_REVISIT).groupBy("digest")
        .agg(F.max("key").alias("last"), F.count("*").alias("n")).filter("n > 1").select("digest", "last")
    )
    # Stored, so that its size is known and pages need no shuffle where it is small.
    joined = rows.join(stored(same, "op10-same"), "digest", "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("key", "url", "payload", "digest", refers.alias("refers_to"))


def encoded(key, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + (payload if refers_to is None else b"")
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{b32}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if (
            "\r" in url or "\n" in url) else url
        lines.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


def write(pages: DataFrame, folder: str, key="page_id", url="url", payload="html") -> DataFrame:
    """Write the pages to `folder`; the stored list of files: `path`, `bytes`, `records`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        out, done, size, count = None, [], 0, 0

        def finish():
            out.close()
            final = f"part-{task.partitionId():05d}-{len(done):03d}.warc.gz"
            fs.move(name, f"{base}/{final}")
            done.append((f"{folder}/{final}", size, count))

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    name = f"{base}/_{task.partitionId()}-{task.taskAttemptId()}-{len(done)}"
                    out, size, count = fs.open_output_stream(name, compression=None), 0, 0
                member = encoded(*row)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    finish()
                    out = None
        if out is not None:
            finish()
        paths, sizes, counts = zip(*done, strict=True) if done else ([], [], [])
        yield pa.RecordBatch.from_pydict(
            {"path": pa.array(paths, pa.string()), "bytes": pa.array(sizes, pa.int64()),
             "records": pa.array(counts, pa.int64())})

    rows = typed(pages, key, url, payload)
    return stored(rows.mapInArrow(run, "path string, bytes bigint, records bigint"), "op10-files")


class _Window:
    """Reads of a file served from the last `AHEAD` bytes fetched."""

    def __init__(self, file):
        self.file, self.low, self.held = file, 0, b""

    def read_at(self, n: int, at: int) -> bytes:
        i = at - self.low
        if i < 0 or i + n > len(self.held):
            self.low, self.held, i = at, self.file.read_at(max(n, AHEAD), at), 0
        return self.held[i:i + n]


class _Member:
    """The decoded bytes of one gzip member, read as far as they are asked for."""

    def __init__(self, file, offset: int):
        self.file, self.at, self.inflate = file, offset, zlib.decompressobj(31)
        self.left, self.end = b"", None

    def _more(self) -> bool:
        if self.end is not None:
            return False
        chunk = self.file.read_at(CHUNK, self.at)
        if not chunk:
            raise EOFError("the member has no end")
        self.at += len(chunk)
        self.left += self.inflate.decompress(chunk)
        if self.inflate.eof:
            self.end = self.at - len(self.inflate.unused_data)
        return True

    def begins(self, mark: bytes) -> bool:
        try:
            while len(self.left) < len(mark) and self._more():
                pass
        except (zlib.error, EOFError):
            return False
        return self.left.startswith(mark)

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (i := self.left.find(mark, seen)) < 0:
            seen = max(0, len(self.left) - len(mark))
            if not self._more():
                raise EOFError("a header has no end")
        found, self.left = self.left[:i], self.left[i + len(mark):]
        return found

    def take(self, n: int) -> bytes:
        parts, have = [self.left], len(self.left)
        while have < n:
            self.left = b""
            if not self._more():
                raise EOFError("a block breaks off")
            parts.append(self.left)
            have += len(self.left)
        whole = b"".join(parts)
        self.left = whole[n:]
        return whole[:n]


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _find(file, start: int, stop: int) -> int | None:
    """The first place in [start, stop) at which the bytes of a member's beginning stand."""
    while start < stop:
        chunk = file.read_at(min(1 << 20, stop - start) + len(MAGIC) - 1, start)
        i = chunk.find(MAGIC)
        if i >= 0:
            return start + i if start + i < stop else None
        start += max(1, len(chunk) - len(MAGIC) + 1)
    return None


def records(file, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header and block of each record whose member begins in [start, stop)."""
    while (at := _find(file, start, stop)) is not None:
        member = _Member(file, at)
        if not member.begins(b"WARC/1."):
            start = at + 1
            continue
        while member.begins(b"WARC/1."):
            head = _fields(member.until(b"\r\n\r\n"))
            block = member.take(int(head["content-length"]))
            member.until(b"\r\n\r\n")
            yield at, head, block
        while member._more():
            member.left = b""
        start = member.end


def _row(path: str, at: int, head: dict[str, str], block: bytes) -> tuple:
    def bare(name):
        value = head.get(name)
        return None if value is None else value.strip("<>").removeprefix("urn:page:") or None

    top, _, payload = block.partition(b"\r\n\r\n")
    kind = head["warc-type"]
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    uri = head.get("warc-target-uri")
    if uri is not None and ("%0D" in uri or "%0A" in uri):
        uri = uri.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    length = int(_fields(top).get("content-length", len(payload)))
    return (path, at, kind, bare("warc-record-id"), uri, bare("warc-refers-to"),
            base64.b32decode(digest).hex() if digest else None,
            len(payload) if kind == "response" else length, payload if kind == "response" else None)


def read(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of `files` (columns `path`, `bytes`); see FIELDS."""
    ranges = files.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")
    )).alias("start"))
    kinds = {"offset": pa.int64(), "length": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds.get(f.split()[0], pa.string())) for f in FIELDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as file:
                    rows, held = [], 0
                    found = records(_Window(file), start, min(start + range_bytes, size))
                    while True:
                        try:
                            row = next(found, None)
                        except (zlib.error, EOFError) as e:
                            raise ValueError(f"damaged record in {path} from byte {start}: {e}") from e
                        if row is not None:
                            rows.append(_row(path, *row))
                            held += len(row[2])
                        if rows and (row is None or held > 1 << 23):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)],
                                schema=schema)
                            rows, held = [], 0
                        if row is None:
                            break

    n = max(1, ranges.count())
    return ranges.repartition(n).mapInArrow(run, FIELDS)


def round_trip(pages: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the pages as archives and read the archives back."""
    return read(write(pages, folder), range_bytes)
