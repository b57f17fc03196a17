"""WARC archives: whole-file gzip streams in, one gzip member per record and an offset index out.

``write_monolithic`` gives one gzip stream per archive, as many tools do. ``normalise`` inflates each stream
once, front to back, in blocks; cuts it into records by their headers; writes every record as a member of
its own; and writes a sidecar index of (record, offset, length) beside the archive. ``read_records`` fetches the
records by that index. Files lie in the shared folder, opened through Arrow's file systems, so a
folder in a store that all executors reach does as well. Every attempt of a task writes files of its own names,
and a stored manifest has those of the attempts that ended well: a task that runs again, or twice, can
mix nothing up. What a lost attempt leaves behind is in no manifest.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import map_arrow, slices, stored

BLOCK = 1 << 20
#: Bytes of archives that one task reads, about.
TASK_BYTES = 256 << 20
LEVEL = 1
_DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_ID = "urn:page:"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _fresh(folder: str, ending: str) -> tuple[fs.FileSystem, str]:
    """A file name never used before."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    return system, f"{folder.rstrip('/')}/{uuid.uuid4().hex}{ending}"


def _sink(name: str):
    system, path = file_system(name)
    return system.open_output_stream(path, compression=None)


def base32_sha1(digest: str) -> str:
    """Bare upper-case base32 of a SHA-1 given in hex."""
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _plain(value: str) -> str:
    """Fit for a header line."""
    return "".join(c if c.isprintable() and c != " " else quote(c) for c in value)


def record(kind: str, page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record with its two line ends; a revisit carries the HTTP header but no payload."""
    block = _HTTP + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{quote(page, safe='')}>", f"WARC-Date: {_DATE}"]
    if url:
        head.append(f"WARC-Target-URI: {_plain(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{_ID}{quote(refers_to, safe='')}>", f"X-Payload-Length: {len(payload)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
    start = end + 4
    return headers, data[start : start + int(headers["content-length"])]


def split_records(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a plain WARC stream; no more than one record and one block is held."""
    held, need = bytearray(), 0
    for block in blocks:
        held += block
        while held:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                name = b"\r\ncontent-length:"
                at = held[: end + 2].lower().index(name) + len(name)
                need = end + 8 + int(held[at : held.index(b"\r\n", at)])
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(stream, block: int = BLOCK) -> Iterator[bytes]:
    """Plain bytes of a gzip file of one or more members, in blocks of bounded size."""
    engine = zlib.decompressobj(31)
    while data := stream.read(block):
        while data:
            yield engine.decompress(data, block)
            data = engine.unconsumed_tail
            if engine.eof:
                data, engine = engine.unused_data, zlib.decompressobj(31)


def _member(data: bytes) -> bytes:
    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def described(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` with digest (SHA-1 in hex), kind and refers_to: only narrow rows meet per digest.

    Of pages with equal payloads of at least ``least_bytes`` bytes the smallest page_id is the response;
    rows that repeat this id, and rows without an id, are told apart by nothing else and are responses too.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    rows = rows.withColumn("shared", F.octet_length("payload") >= least_bytes)
    first = rows.where("shared").groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # Only payloads that occur twice matter: most pages find no partner.
    first = first.where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("_digest"), "first")
    narrow = rows.where("shared").select("page_id", "digest").join(first, F.col("digest") == F.col("_digest"))
    revisits = narrow.where("page_id > first").select(F.col("page_id").alias("_page"), F.col("digest").alias("_of"), "first")
    # Stored, so that its size is known: few revisits are sent to the pages, many meet them by page_id.
    revisits = stored(revisits.distinct(), "revisits")
    met = rows.join(revisits, F.col("shared") & (F.col("page_id") == F.col("_page")) & (F.col("digest") == F.col("_of")), "left")
    kind = F.when(F.col("first").isNull(), "response").otherwise("revisit")
    return met.select("page_id", "url", "payload", "digest", kind.alias("kind"), F.col("first").alias("refers_to"))


def write_monolithic(rows: DataFrame, folder: str, archive_bytes: int = 32 << 20) -> DataFrame:
    """(archive, records, bytes): archives of about ``archive_bytes`` plain bytes, each one gzip stream, from ``described`` rows."""

    def written(batches):
        archive = stream = engine = None
        size = records = 0
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            stream.write(engine.flush())
            length = stream.tell()
            stream.close()
            done.append((archive, records, length))

        for batch in slices(batches, 2):
            for page, url, payload, digest, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    archive = _fresh(folder, ".warc.gz")[1]
                    stream, engine, size, records = _sink(archive), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                data = record(kind, "" if page is None else page, url, payload, base32_sha1(digest), refers_to)
                stream.write(engine.compress(data))
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    close()
                    archive = None
        if archive is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, *_ in done], pa.string()), *(pa.array([d[i] for d in done], pa.int64()) for i in (1, 2))],
            names=["archive", "records", "bytes"])

    text = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest", "kind",
                       F.col("refers_to").cast("string").alias("refers_to"))
    return stored(map_arrow(text, written, "archive string, records long, bytes long"), "archives")


def _sized(manifest: DataFrame) -> DataFrame:
    """``manifest`` with ``bytes``, the size of each archive, looked up where it isn't known."""
    if "bytes" in manifest.columns:
        return manifest

    def looked_up(batches):
        for batch in batches:
            sizes = []
            for archive in batch.column(batch.schema.get_field_index("archive")).to_pylist():
                system, path = file_system(archive)
                sizes.append(system.get_file_info(path).size)
            yield batch.append_column("bytes", pa.array(sizes, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.schema)
    return stored(map_arrow(manifest, looked_up, f"{schema}, bytes long"), "archive-sizes")


def _dealt(manifest: DataFrame, columns: list[str], task_bytes: int) -> DataFrame:
    """Archives dealt to tasks of about ``task_bytes``, in turn; few archives are still spread over all cores."""
    sized = _sized(manifest)
    seen = sized.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).head()
    tasks = max((seen["bytes"] or 0) // task_bytes + 1, manifest.sparkSession.sparkContext.defaultParallelism)
    return sized.select(*columns).repartition(max(1, min(seen["n"], tasks)))


def normalise(manifest: DataFrame, folder: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(archive, sidecar, records, bytes): each archive of ``manifest`` with every record as a gzip member of its own.

    The sidecar has a line of JSON per record: its id, offset and length in the archive. Takes any gzip archive, of one
    stream or many. Memory holds one block, one record and its member, and the index of one archive.
    """

    def rewritten(batches):
        for batch in batches:
            out = []
            for source in batch.column(0).to_pylist():
                system, path = file_system(source)
                archive = _fresh(folder, ".warc.gz")[1]
                index, offset = [], 0
                with system.open_input_stream(path, compression=None) as stream, _sink(archive) as sink:
                    for data in split_records(inflate(stream)):
                        member = _member(data)
                        name = parse_record(data)[0].get("warc-record-id", "")
                        sink.write(member)
                        index.append(json.dumps({"id": name, "offset": offset, "length": len(member)}))
                        offset += len(member)
                with _sink(f"{archive}.idx") as sink:
                    sink.write("".join(f"{x}\n" for x in index).encode())
                out.append((archive, f"{archive}.idx", len(index), offset))
            yield pa.RecordBatch.from_pylist([dict(zip(("archive", "sidecar", "records", "bytes"), x, strict=True)) for x in out], schema=kinds)

    kinds = pa.schema([("archive", pa.string()), ("sidecar", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    found = map_arrow(_dealt(manifest, ["archive"], task_bytes), rewritten, "archive string, sidecar string, records long, bytes long")
    return stored(found, "normalised")


def read_records(manifest: DataFrame, with_payload: bool = False, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the payload if wanted) by offset.

    The digest of a response is made from the payload that was read and must be the one in the header.
    """
    kinds = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.string()), *[("payload", pa.binary())] * with_payload])

    def name(value: str | None) -> str | None:
        return None if value is None else unquote(value.strip("<>").removeprefix(_ID)) or None

    def read(archive: str, sidecar: str) -> Iterator[dict]:
        system, path = file_system(sidecar)
        with system.open_input_stream(path, compression=None) as stream:
            index = [json.loads(line) for line in stream.read().splitlines()]
        system, path = file_system(archive)
        with system.open_input_file(path) as file:
            for at in index:
                file.seek(at["offset"])
                headers, block = parse_record(zlib.decompress(file.read(at["length"]), 31))
                payload = block.partition(b"\r\n\r\n")[2]
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload of {at['id']} in {archive} doesn't match its digest")
                size = len(payload) if kind == "response" else int(headers["x-payload-length"])
                row = {"page_id": name(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "payload_bytes": size,
                       "payload_digest": digest, "record_type": kind, "refers_to": name(headers.get("warc-refers-to"))}
                yield row | {"payload": payload} if with_payload else row

    def records(batches):
        for batch in batches:
            for archive, sidecar in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                for row in read(archive, sidecar):
                    rows.append(row)
                    size += 200 + len(row.get("payload", b""))
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    return map_arrow(_dealt(manifest, ["archive", "sidecar"], task_bytes), records, schema + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): ``pages`` written, normalised and read back.

    A null html is the empty payload, a null url leaves its header out. See ``described`` for equal payloads, null and
    repeated ids. An empty table gives an empty result. Other columns are not read.
    """
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    plain = write_monolithic(described(pages, least_bytes), scratch_path(spark, "warc-plain"))
    found = read_records(normalise(plain, scratch_path(spark, "warc")))
    ids = {c: F.col(c).cast(kind) for c in ("page_id", "refers_to")}
    return found.drop("url").withColumns(ids)
