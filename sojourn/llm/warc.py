"""WARC archives written from and read back as a chunked record table.

A payload never passes through Python as a whole: it travels as rows (record,
chunk number, bytes) of at most ``CHUNK`` bytes.  The writer appends each row to
the record's gzip member and carries the SHA-1 along; the reader streams a
member, cuts the payload into chunk rows again and gives each row the digest of
the payload up to and including it, so the last row of a record has the
payload's length and digest.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with
the largest ``page_id`` is the response and the others are revisits of it
(identical-payload-digest); which rows are revisits is decided on digests alone,
after a partial aggregate, before any payload moves.

Every write task makes files of its own name in the shared folder and returns a
manifest row for each; only files of the manifest are read, so what a lost or
repeated attempt has left is never seen.

Cases: null html is an empty payload; a null url leaves out the target; equal
rows (same ``page_id`` and payload) are all responses if theirs is the largest
``page_id``; a null ``page_id`` is smaller than any other; an empty table gives
no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import read_table, stage_table

CHUNK = 1 << 20
REVISIT_BYTES = 1000
#: An archive is closed, and another begun, after so many bytes.
FILE_BYTES = 1 << 30
LEVEL = 3
#: Rows of a hot digest at least, and hot digests at most.
HOT = 100_000
HOTS = 100_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def meet_unique(rows: DataFrame, unique: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``unique``, which has one row per key.  ``rows`` is a written table, read several times.

    All rows of a key would be one task's work; what a key with over ``HOT`` rows and over one in ``HOTS`` of
    all rows meets is broadcast instead, which are fewer than ``HOTS`` rows whatever the table."""
    least = max(HOT, rows.count() // HOTS)
    hot = stage_table(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > least).select(*keys), "hot_keys")
    if hot.isEmpty():
        return rows.join(unique, keys)
    few = unique.join(F.broadcast(hot), keys, "left_semi")
    return rows.join(F.broadcast(few), keys).unionByName(rows.join(F.broadcast(hot), keys, "left_anti").join(unique, keys))


def records(pages: DataFrame) -> DataFrame:
    """``pages`` as records: ``page_id``, ``url``, ``html``, ``digest`` and ``refers_to`` (revisits only).
    ``found`` holds ids and digests; texts meet it by row, and only if there are revisits at all."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    large = stage_table(rows.where(F.octet_length("html") >= REVISIT_BYTES).select("page_id", "digest"), "digests")
    groups = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    found = meet_unique(large, stage_table(groups, "repeated_digests"), ["digest"]).where("page_id is null or page_id < refers_to").distinct()
    found = stage_table(found.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to"), "revisits")
    return rows.join(found, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").drop("_id", "_digest")


def chunk_rows(found: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per chunk, in order; a revisit and an empty payload have one empty chunk."""
    body = F.when(F.col("refers_to").isNull(), F.col("html").cast("binary")).otherwise(F.lit(b""))
    last = F.greatest(F.lit(0), F.ceil(F.octet_length("body") / size).cast("int") - 1)
    numbered = (found.select("page_id", "url", "digest", "refers_to", body.alias("body"))
                .select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk")))  # numbers only: no second copy of the payload
    return numbered.select("page_id", "url", "digest", "refers_to", F.octet_length("body").cast("long").alias("n_bytes"), "chunk",
                           F.substring("body", F.col("chunk") * size + 1, F.lit(size)).alias("data"))


def _urn(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def _target(url: str) -> str:
    return "".join(c if "!" <= c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _head(page_id: int | None, url: str | None, digest: str, refers_to: int | None, n: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n" if refers_to is None else "HTTP/1.1 200 OK\r\n\r\n"
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        fields.append(f"WARC-Target-URI: {_target(url)}")
    fields.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to, digest)}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + n}", "", ""]
    return "\r\n".join(fields).encode() + http.encode()


class _Archive:
    """An archive being written, a gzip member for each record."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        fs, at = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out, self.bytes, self.records = fs.open_output_stream(at, compression=None), 0, 0
        self.zip = None

    def put(self, data: bytes) -> None:
        self.zip = self.zip or zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self._write(self.zip.compress(data))

    def end_record(self) -> None:
        self.put(b"\r\n\r\n")
        self._write(self.zip.flush())
        self.zip = None
        self.records += 1

    def _write(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.bytes += len(data)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Write chunk rows as archives under ``folder``; the manifest (``path``, ``records``, ``bytes``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done, sha, left, want = None, [], None, 0, ""
        for b in batches:
            columns = [c.to_pylist() for c in b.columns[:6]]
            for k, (page_id, url, digest, refers_to, n, chunk) in enumerate(zip(*columns)):
                data = b.column(6)[k].as_buffer()
                if archive is None or (chunk == 0 and archive.bytes > FILE_BYTES):
                    done += [archive.close()] if archive else []
                    archive = _Archive(folder)
                if chunk == 0:
                    archive.put(_head(page_id, url, digest, refers_to, n))
                    sha, left, want = hashlib.sha1(), n, digest if refers_to is None else None
                archive.put(data)
                sha.update(data)
                left -= data.size
                if left == 0:
                    if want is not None and sha.hexdigest() != want:
                        raise ValueError(f"payload of page {page_id} changed on its way")
                    archive.end_record()
        done += [archive.close()] if archive else []
        path, n, size = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(n, pa.int64()), pa.array(size, pa.int64())], ["path", "records", "bytes"])

    manifest = rows.select("page_id", "url", "digest", "refers_to", "n_bytes", "chunk", "data").mapInArrow(run, "path string, records long, bytes long")
    return stage_table(manifest, "warc_manifest")


def _page(urn: str | None) -> int | None:
    number = urn.split(":")[2] if urn else ""
    return int(number) if number else None


def parse(stream: io.BufferedIOBase, size: int = CHUNK) -> Iterator[tuple]:
    """Chunk rows of an archive: (type, page_id, url, refers_to, declared digest, chunk, offset, digest of
    the payload so far, last, bytes)."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        field: dict[str, str] = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(":")
            field[name.lower()] = value.strip()
        left = int(field["content-length"])
        kind = field.get("warc-type")
        if kind not in ("response", "revisit"):
            while left:
                left -= len(stream.read(min(left, size)))
            continue
        while True:  # the HTTP head belongs to the block, not to the payload
            line = stream.readline()
            left -= len(line)
            if line in (b"\r\n", b""):
                break
        sha, at, chunk = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(left, size))
            if left and not data:
                raise EOFError("a record is cut short")
            sha.update(data)
            left -= len(data)
            declared = base64.b32decode(field["warc-payload-digest"].partition(":")[2]).hex()
            yield kind, _page(field["warc-record-id"]), field.get("warc-target-uri"), _page(field.get("warc-refers-to")), declared, chunk, at, sha.hexdigest(), not left, data
            at, chunk = at + len(data), chunk + 1
            if not left:
                break


CHUNK_SCHEMA = "record_type string, page_id long, url string, refers_to long, declared string, chunk int, offset long, digest string, last boolean, n_bytes long"


def read(manifest: DataFrame, size: int = CHUNK, with_data: bool = False) -> DataFrame:
    """The chunked record table of the manifest's archives; ``with_data`` adds the chunk's bytes."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")] + ["data"]
    width = len(names) if with_data else len(names) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:width], kinds)], names[:width])

        for b in batches:
            for path in b.column(0).to_pylist():
                fs, at = pafs.FileSystem.from_uri(path)
                out, held = [], 0
                with fs.open_input_stream(at, compression=None, buffer_size=1 << 20) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for *row, data in parse(io.BufferedReader(stream, 1 << 18), size):
                        out.append((*row, len(data), data if with_data else None))
                        held += len(data) if with_data else 0
                        if len(out) >= 4096 or held >= 8 * size:
                            yield flush(out)
                            out, held = [], 0
                yield flush(out)

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(run, CHUNK_SCHEMA + (", data binary" if with_data else ""))


def payloads(chunks: DataFrame) -> DataFrame:
    """Per record: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``; a revisit
    takes length and digest from the response that it refers to."""
    whole = chunks.where("last").select("record_type", "page_id", "refers_to", "declared", "digest", (F.col("offset") + F.col("n_bytes")).alias("payload_bytes"))
    whole = stage_table(whole, "warc_records")
    response = whole.where("record_type = 'response'").select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    targets = response.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared"), "payload_bytes", "payload_digest").distinct()
    revisit = (meet_unique(whole.where("record_type = 'revisit'").drop("payload_bytes", "digest"), targets, ["refers_to", "declared"])
               .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    return response.unionByName(revisit)


def op1_chunked_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write(chunk_rows(records(read_table(spark, sf_dir, "pages"))), shared_dir(spark, "llm", "warc"))
    return payloads(read(manifest))


ORACLE = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    g AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
                 CASE WHEN strlen(h) >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY h) END AS top FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN top IS NOT NULL AND (page_id IS NULL OR page_id < top) THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN top IS NOT NULL AND (page_id IS NULL OR page_id < top) THEN top END AS refers_to FROM g"""
