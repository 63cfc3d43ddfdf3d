"""WARC archives: pages are written as monolithic gzip files, normalised, and read back by offset.

A WARC file that was compressed as one gzip stream can only be read from its start. The normaliser
inflates each such file once, as a stream, and writes every record as a gzip member of its own,
with a sidecar index of the members' offsets beside it. Readers then take any record alone.

Every file is one task's work. A task writes under a name of its own attempt and the manifest that
Spark commits names only files of tasks that ended well, so a lost executor costs its tasks alone.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the smallest id is
the response and the others revisit it. Equal payloads are found by their SHA-256; counting them
is combined in the map tasks, and a payload that many pages share is split by adaptive joins.

Defined results: a null payload is empty; a null url is left out; pages without an id have no page
field and never are the first of a group that has ids; rows that repeat the smallest id of a group
are all responses; a table without rows gives no archive.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurio.session import materialize, scratch_path

from .batches import small_batches

REVISIT_BYTES = 100
LEVEL = 4           # of gzip
CHUNK = 1 << 20     # bytes inflated at once
DATE = "2024-01-01T00:00:00Z"
_URL = "%/:?#[]@!$&'()*+,;=~-._"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; a bare path is a local one."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        pafs.LocalFileSystem(), uri)


def record_id(page) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page}')}>"


def plan_records(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html",
                 least: int = REVISIT_BYTES) -> DataFrame:
    """(page, url, payload, digest, bytes, first): ``first`` is the page that a revisit refers to."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).alias("url"), body.alias("payload"),
                        F.sha2(body.cast("binary"), 256).alias("digest"),
                        F.octet_length(body).cast("long").alias("bytes"))
    firsts = (rows.where(F.col("bytes") >= least).groupBy("digest")
              .agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    own = F.col("first").isNull() | F.col("page").eqNullSafe(F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        "page", "url", "payload", "digest", "bytes", F.when(~own, F.col("first")).alias("first"))


def record(page, url, payload: bytes, digest: str, size: int, first) -> bytes:
    """One WARC record. A revisit holds the HTTP header alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http if first is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page is not None:
        head.append(f"X-Page: {page}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL)}")
    if first is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(first)}", f"X-Refers-To-Page: {first}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}


def inflate(source) -> Iterator[bytes]:
    """Bytes of a gzip file of one or more members, piece by piece."""
    engine = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            if engine.eof:
                engine = zlib.decompressobj(31)
            piece = engine.decompress(data, CHUNK)
            if piece:
                yield piece
            data = engine.unused_data if engine.eof else engine.unconsumed_tail
    if not engine.eof:
        raise ValueError("a gzip stream ends early")


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of a stream of records; one record is held at a time."""
    held = bytearray()
    need = 0
    fields: dict[str, str] = {}
    for piece in pieces:
        held += piece
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                fields = parse_head(bytes(held[:end]))
                need = end + 4 + int(fields["content-length"]) + 4
            if len(held) < need:
                break
            yield fields, bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("a record ends early")


def lines(stream) -> Iterator[bytes]:
    held = b""
    while data := stream.read(CHUNK):
        *whole, held = (held + data).split(b"\n")
        yield from whole


def member(data: bytes, level: int = LEVEL) -> bytes:
    engine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def _name(kind: str) -> str:
    task = TaskContext.get()
    return f"{kind}-{task.partitionId():06d}-{task.taskAttemptId()}"


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Write each partition as one monolithic .warc.gz file; returns the manifest (path, records)."""
    small_batches(planned.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        path, out, n = f"{base}/{_name('pages')}.warc.gz", None, 0
        engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(path, compression=None)
                out.write(engine.compress(record(
                    r["page"], r["url"], r["payload"].encode("utf-8", "replace"), r["digest"], r["bytes"], r["first"])))
                n += 1
        if out is not None:
            out.write(engine.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return materialize(planned.mapInArrow(run, "path string, records bigint"), "warc-written")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with a member per record and a sidecar index; returns (path, index, records).

    A sidecar line is the JSON list [offset, length, record id, type] of one member.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        n_files = 0
        for batch in batches:
            for source in batch.column("path").to_pylist():
                system.create_dir(base, recursive=True)
                path = f"{base}/{_name('normal')}-{n_files:06d}.warc.gz"
                at, n = 0, 0
                with (system.open_input_stream(source, compression=None) as data,
                      system.open_output_stream(path, compression=None) as out,
                      system.open_output_stream(f"{path}.idx", compression=None) as index):
                    for fields, whole in records(inflate(data)):
                        packed = member(whole)
                        out.write(packed)
                        line = [at, len(packed), fields["warc-record-id"], fields["warc-type"]]
                        index.write(json.dumps(line).encode() + b"\n")
                        at += len(packed)
                        n += 1
                n_files += 1
                yield pa.RecordBatch.from_pydict({"path": [path], "index": [f"{path}.idx"], "records": [n]})

    spread = archives.select("path").repartition(archives.sparkSession.sparkContext.defaultParallelism * 2, "path")
    return materialize(spread.mapInArrow(run, "path string, index string, records bigint"), "warc-normal")


def read_records(normal: DataFrame, folder: str, batch_rows: int = 100) -> DataFrame:
    """Records of normalised archives, each read alone at the offset that the sidecar names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for r in batch.to_pylist():
                with (system.open_input_file(r["path"]) as data,
                      system.open_input_stream(r["index"], compression=None) as index):
                    held = []
                    for line in lines(index):
                        at, length, *_ = json.loads(line)
                        whole = zlib.decompress(data.read_at(length, at), 31)
                        head, _, block = whole.partition(b"\r\n\r\n")
                        f = parse_head(head)
                        http, _, payload = block[:int(f["content-length"])].partition(b"\r\n\r\n")
                        first, digest = f.get("x-refers-to-page"), f["warc-payload-digest"].removeprefix("sha256:")
                        size = int(f["x-payload-length"])
                        if first is None:  # digest and size are those of the bytes read
                            if (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                                raise ValueError(f"payload of {f['warc-record-id']} differs from its header")
                        held.append((
                            int(f["x-page"]) if "x-page" in f else None, f.get("warc-target-uri"),
                            payload.decode() if first is None else None, size, digest, f["warc-type"],
                            int(first) if first is not None else None))
                        if len(held) == batch_rows:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t.type) for c, t in zip(zip(*held), schema)], names=names)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t.type) for c, t in zip(zip(*held), schema)], names=names)

    spread = normal.repartition(normal.sparkSession.sparkContext.defaultParallelism * 2, "path")
    return spread.mapInArrow(run, "page_id bigint, url string, payload string, payload_bytes bigint, "
                                  "payload_digest string, record_type string, refers_to bigint")


def confirmed(found: DataFrame) -> DataFrame:
    """Records without url and payload, once every revisit agrees with a response that was read.

    The payload of a response is hashed where it is read; a revisit has none, so its digest and size
    must be those of the response it refers to, else a ValueError says so.
    """
    rows = materialize(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "warc-read")
    same = ["refers_to", "payload_bytes", "payload_digest"]
    # revisits of one response meet it as one row
    links = rows.where("record_type = 'revisit'").select(same).distinct()
    answers = rows.where("record_type = 'response'").withColumn("refers_to", F.col("page_id")).select(same)
    lost = links.join(answers, same, "left_anti").first()
    if lost:
        raise ValueError(f"revisits of {lost['refers_to']} differ from their response")
    return rows


def round_trip(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write, normalise and read back archives of the pages below the shared folder."""
    folder = scratch_path(pages.sparkSession, "warc")
    written = write_archives(plan_records(pages, key=key, url=url, payload=payload), f"{folder}/raw")
    return read_records(normalise(written, f"{folder}/normal"), f"{folder}/normal")
