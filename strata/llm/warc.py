"""WARC archives: writing, normalising to one gzip member a record, reading by index.

Crawls often come as one gzip stream over a whole archive, which can only be
read from its start. ``normalise`` inflates such a stream once, from front to
end, and writes every record as a gzip member of its own, so that any record
can be read alone; beside each archive it writes a sidecar with one JSON line
a record: offset, length, type, record id and target. Only a buffer of
``CHUNK`` bytes and one record's head are held, whatever an archive or record
measures. Archives that are plain or already cut into members read alike.

The work is one row an archive: Spark deals archives to tasks, and readers
deal ranges of records, cut by the sidecars, so one large archive is read by
many tasks. Archives go to any store that pyarrow opens by its address (file,
hdfs, s3, gs, abfs). A task writes under a name of its own attempt and returns
it; the manifest of returned names is a table that Spark commits, so what a
lost or repeated task left behind is never read.

``page_records`` turns pages into records: of equal payloads of
``LEAST_SHARED`` bytes or more, the one with the largest id is the response
and the others are revisits that refer to it. Payloads meet by hash only, in
one map-side combined aggregate; the join back sends texts through a shuffle
only if the payloads that occur twice are too many to broadcast.

Defined results: null html is the empty payload; a null url leaves the target
out, and control characters and blanks in urls are percent-encoded; a null id
is the smallest and is read back as null; rows equal in id and payload are of
one type; repeated rows are records of their own; payloads of any length are
kept whole; an empty table gives a manifest without archives; other columns
are ignored. Damage (truncated streams, wrong lengths, wrong digests) raises
``ValueError``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import shared_dir, stored

LEAST_SHARED = 1000
ARCHIVE_BYTES = 1 << 30  # of records, before compression
SPLIT_BYTES = 64 << 20  # of members that one task reads
CHUNK = 1 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "archive string, sidecar string, n_records long, bytes long"
RECORDS = (
    "record_type string, record_id string, page_id long, target_uri string, refers_to long, "
    "payload_bytes long, payload_digest string"
)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_MOST_HEAD = 1 << 20


def _store(address: str):
    """The file system of an address, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", address))


def _create(folder: str, name: str):
    """A new file of the folder, and its address."""
    fs, path = _store(folder)
    fs.create_dir(path, recursive=True)
    return fs.open_output_stream(f"{path}/{name}", compression=None), f"{folder}/{name}"


def page_records(
    df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_SHARED
) -> DataFrame:
    """``(page_id, url, payload, sha1, head)`` per row; ``head`` is the id that
    a revisit refers to, null for a response."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = df.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload")
    )
    # two hashes and the length: equal only for equal payloads
    key = {"sha1": F.sha1("payload"), "h": F.xxhash64("payload"), "size": F.octet_length("payload")}
    rows = rows.withColumns(key)
    heads = rows.filter(F.col("size") >= least).groupBy(*key).agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
    heads = stored(heads.filter("n > 1").drop("n"), "warc-heads")
    told = rows.join(heads, list(key), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("head")), F.col("head"))
    return told.select("page_id", "url", "payload", "sha1", refers.alias("head"))


def _record_id(page: str | None, sha1: str) -> str:
    return f"<urn:x-page:{page or ''}:{sha1}>"


def record_bytes(page: str | None, url: str | None, payload: bytes, sha1: str, head: str | None, date: str = DATE) -> bytes:
    """One WARC 1.1 record; a revisit (``head``) has no payload."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if head is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page, sha1)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if head is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(head, sha1)}"]
    http = _HTTP % len(payload)
    body = b"" if head is not None else payload
    lines.append(f"Content-Length: {len(http) + len(body)}")
    return b"".join(("\r\n".join(lines).encode("utf-8", "surrogatepass"), b"\r\n\r\n", http, body, b"\r\n\r\n"))


def write_monolithic(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL) -> DataFrame:
    """The records (``page_records``) as archives of one gzip stream each;
    returns the committed manifest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, out, packer, done = TaskContext.get().partitionId(), None, None, None
        for f in frames:
            for row in zip(f["page_id"], f["url"], f["payload"], f["sha1"], f["head"], strict=True):
                data = record_bytes(*row)
                if out is not None and done[3] + len(data) > archive_bytes:
                    out.write(packer.flush())
                    out.close()
                    yield pd.DataFrame([done], columns=["archive", "sidecar", "n_records", "bytes"])
                    out = None
                if out is None:
                    out, address = _create(folder, f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz")
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    done = [address, None, 0, 0]
                out.write(packer.compress(data))
                done[2:] = done[2] + 1, done[3] + len(data)
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pd.DataFrame([done], columns=["archive", "sidecar", "n_records", "bytes"])

    # ids as text: pandas would turn ids beside nulls into floating point
    text = [F.col(c).cast("string").alias(c) for c in ("page_id", "url")]
    rows = records.select(*text, "payload", "sha1", F.col("head").cast("string").alias("head"))
    return stored(rows.mapInPandas(run, MANIFEST), "warc-monolithic")


def inflated(raw) -> Iterator[bytes]:
    """The content of an open archive in pieces of at most ``CHUNK`` bytes,
    through one gzip member, many, or none."""
    data = raw.read(CHUNK)
    if not data.startswith(b"\x1f\x8b"):
        while data:
            yield data
            data = raw.read(CHUNK)
        return
    unzip, begun = zlib.decompressobj(31), False
    full = False
    while True:
        if not data and not full:
            data = raw.read(CHUNK)
            if not begun:
                data = data.lstrip(b"\0")  # padding between members
            if not data:
                break
        try:
            out = unzip.decompress(data, CHUNK)
        except zlib.error as exc:
            raise ValueError(f"damaged archive: {exc}") from None
        begun, full = True, len(out) == CHUNK
        if out:
            yield out
        data = unzip.unconsumed_tail
        if unzip.eof:
            data = unzip.unused_data.lstrip(b"\0")
            unzip, begun, full = zlib.decompressobj(31), False, False
    if begun:
        raise ValueError("damaged archive: the stream ends early")


class _Stream:
    """Pieces read as one stream."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, b"", 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held, self.at = self.held[self.at :] + piece, 0
        return True

    def head(self) -> bytes | None:
        """Up to the next empty line; None at the end."""
        while self.held.startswith(b"\r\n", self.at) or (len(self.held) - self.at < 2 and self._more()):
            if self.held.startswith(b"\r\n", self.at):
                self.at += 2
        seen = self.at
        while (end := self.held.find(b"\r\n\r\n", seen)) < 0:
            if len(self.held) - self.at > _MOST_HEAD:
                raise ValueError("damaged archive: a record's head does not end")
            before = max(len(self.held) - self.at - 3, 0)
            if not self._more():
                if len(self.held) > self.at:
                    raise ValueError("damaged archive: a record's head is cut off")
                return None
            seen = before
        head = self.held[self.at : end + 4]
        self.at = end + 4
        return head

    def copy(self, n: int, sink: Callable[[bytes], object]) -> None:
        while n:
            if self.at == len(self.held) and not self._more():
                raise ValueError("damaged archive: a record is shorter than its length")
            piece = self.held[self.at : self.at + n]
            sink(piece)
            self.at += len(piece)
            n -= len(piece)


def head_fields(head: bytes) -> dict[str, str]:
    """Fields of a record's head, names in lower case."""
    lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "surrogateescape")).split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"damaged archive: {lines[0][:40]!r} instead of a record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}
    if not fields.get("content-length", "").isdigit():
        raise ValueError("damaged archive: a record without length")
    return fields


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Archives (column ``archive``) rewritten with a member a record and a
    sidecar each; returns the committed manifest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for source in f["archive"]:
                name = f"{uuid.uuid4().hex}.warc.gz"
                out, archive = _create(folder, name)
                side, sidecar = _create(folder, f"{name}.index.jsonl")
                fs, path = _store(source)
                n = offset = 0
                with out, side, fs.open_input_stream(path, compression=None) as raw:
                    stream = _Stream(inflated(raw))
                    while (head := stream.head()) is not None:
                        fields = head_fields(head)
                        packer, length = zlib.compressobj(level, zlib.DEFLATED, 31), 0

                        def put(data: bytes, packer=packer) -> None:
                            nonlocal length
                            packed = packer.compress(data)
                            out.write(packed)
                            length += len(packed)

                        put(head)
                        stream.copy(int(fields["content-length"]), put)
                        put(b"\r\n\r\n")
                        packed = packer.flush()
                        out.write(packed)
                        length += len(packed)
                        entry = {
                            "offset": offset,
                            "length": length,
                            "type": fields.get("warc-type"),
                            "id": fields.get("warc-record-id"),
                            "target": fields.get("warc-target-uri"),
                        }
                        side.write(json.dumps(entry).encode() + b"\n")
                        n, offset = n + 1, offset + length
                yield pd.DataFrame([(archive, sidecar, n, offset)], columns=["archive", "sidecar", "n_records", "bytes"])

    paths = archives.select("archive")
    return stored(paths.repartition(max(1, paths.count())).mapInPandas(run, MANIFEST), "warc-members")


def read_index(manifest: DataFrame) -> DataFrame:
    """The sidecars' entries: ``(archive, offset, length, type, id, target)``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for archive, sidecar in zip(f["archive"], f["sidecar"], strict=True):
                fs, path = _store(sidecar)
                with fs.open_input_stream(path, compression=None) as raw:
                    rest = b""
                    while data := raw.read(CHUNK):
                        *lines, rest = (rest + data).split(b"\n")
                        if lines:
                            frame = pd.DataFrame([json.loads(x) for x in lines])
                            yield frame.assign(archive=archive)[["archive", "offset", "length", "type", "id", "target"]]

    schema = "archive string, offset long, length long, type string, id string, target string"
    return manifest.select("archive", "sidecar").mapInPandas(run, schema)


def _page_of(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d*):[0-9a-f]*>", record_id or "")
    return int(found[1]) if found and found[1] else None


def parse_member(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of one record, as its gzip member."""
    stream, block = _Stream(inflated(_Held(member))), []
    fields = head_fields(stream.head() or b"")
    stream.copy(int(fields["content-length"]), block.append)
    return fields, b"".join(block)


class _Held:
    def __init__(self, data: bytes):
        self.data = data

    def read(self, n: int) -> bytes:
        out, self.data = self.data[:n], self.data[n:]
        return out


def read_records(index: DataFrame, payloads: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records (``RECORDS``, and ``payload`` if ``payloads``) of an index or of
    some rows of one: each task seeks its members. Digests are verified; a
    revisit's length and digest are those its record states."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, raw = None, None
        names = [x.split(" ")[0] for x in RECORDS.split(", ")] + (["payload"] if payloads else [])
        whole = ("page_id", "refers_to", "payload_bytes")  # exact also beside nulls
        for f in frames:
            rows = []
            for archive, offset, length in zip(f["archive"], f["offset"], f["length"], strict=True):
                if archive != opened:
                    if raw is not None:
                        raw.close()
                    fs, path = _store(archive)
                    opened, raw = archive, fs.open_input_file(path)
                raw.seek(offset)
                fields, block = parse_member(raw.read(length))
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                revisit = fields["warc-type"] == "revisit"
                if revisit:
                    size, payload = int(re.search(rb"(?mi)^content-length: *(\d+)", http)[1]), None
                elif hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"damaged record at {offset} of {archive}: its payload has another digest")
                else:
                    size = len(payload)
                page, head = (_page_of(fields.get(k)) for k in ("warc-record-id", "warc-refers-to"))
                row = (fields["warc-type"], fields["warc-record-id"], page, fields.get("warc-target-uri"), head, size, digest)
                rows.append((*row, payload) if payloads else row)
            columns = dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {}
            yield pd.DataFrame({k: pd.array(list(v), "Int64") if k in whole else list(v) for k, v in columns.items()}, columns=names)

    # members in a row are read by one task; the number of tasks follows the bytes
    total = index.agg(F.sum("length")).first()[0] or 0
    places = index.select("archive", "offset", "length")
    parts = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // split_bytes))
    ordered = places.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    return ordered.mapInPandas(run, RECORDS + (", payload binary" if payloads else ""))


def op11_warc_normaliser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = f"{shared_dir(spark)}/strata-warc-{uuid.uuid4().hex}"
    crawled = write_monolithic(page_records(pages), f"{folder}/crawl")
    index = stored(read_index(normalise(crawled, f"{folder}/records")), "warc-index")
    return read_records(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP11_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS head FROM p
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= {LEAST_SHARED} AND (page_id IS NULL OR page_id < head) AND head IS NOT NULL THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_SHARED} AND (page_id IS NULL OR page_id < head) THEN head END AS refers_to
FROM m
"""

QUERIES = {"op11_warc_normaliser": op11_warc_normaliser}
ORACLE = {"op11_warc_normaliser": OP11_SQL}
