"""WARC archives: a writer with payload de-duplication and a splittable reader.

Each record is a gzip member of its own. The reader deals byte ranges of the
archives to tasks; a task searches its range for gzip magic, takes a candidate
as a record if its first decoded bytes are a WARC header, and owns the records
that start inside its range, reading past its end to finish the last one.

Nulls, empties, ties: a null html counts as empty; a null page_id or url is
left out of the header and read back as null. Of equal payloads of at least
``min_revisit`` bytes, the row with the largest page_id is the response (every
such row, if that page_id is repeated); rows with null page_id revisit it, and
are responses if no row of the group has an id. An empty table gives no
archive and no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
#: Rows of one payload are dealt to so many tasks.
SALTS = 16
READ = 1 << 18

MANIFEST = "path string, n_records long, n_bytes long"
ROWS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "payload binary")


# --- writing ----------------------------------------------------------------------------------------


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:sha1:{digest}')}>"


def _uri(url: str) -> str:
    """Control characters would end the header line; they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, date: str) -> bytes:
    payload = (html or "").encode("utf-8")
    sha = hashlib.sha1(payload)
    digest = sha.hexdigest()
    http = HTTP.format(len(payload)).encode("ascii")
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                  f"X-Refers-To-Page-Id: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode('ascii')}",
              f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(pages: DataFrame, folder: str, min_revisit: int = 1000,
               date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; the materialised manifest of the archives.

    The response of a payload is found by its digest from (digest, length,
    page_id) alone, pre-aggregated before the shuffle. Rows then meet it on
    digest and salt, so a payload that a third of the pages share is written by
    many tasks. Only archives that the manifest names count.
    """
    spark = common.prepare(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("n_bytes"))
    shared = (rows.filter(F.col("n_bytes") >= min_revisit).groupBy("digest", "n_bytes")
              .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1)
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("copies"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    planned = rows.join(shared, ["digest", "n_bytes", "salt"], "left").select(
        "page_id", "url", "html",
        F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, path, n, size = None, "", 0, 0
        for batch in common.rows_of(batches, 256):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    path = common.attempt_path(folder, "pages", ".warc.gz")
                    sink = common.open_output(path)
                data = member(record(*row, date))
                sink.write(data)
                n, size = n + 1, size + len(data)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())],
                                             names=["path", "n_records", "n_bytes"])

    return common.materialise(planned.mapInArrow(write, MANIFEST), "warc-manifest")


# --- reading ----------------------------------------------------------------------------------------


def _decode(file, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and its length, or None if no WARC record starts there."""
    unpacker, out, taken = zlib.decompressobj(31), [], 0
    seen = b""
    while not unpacker.eof:
        file.seek(at + taken)
        data = file.read(READ)
        if not data:
            if len(seen) >= len(VERSION):
                raise ValueError(f"archive ends inside the record at byte {at}")
            return None  # a magic by chance in the archive's last bytes
        try:
            part = unpacker.decompress(data)
        except zlib.error:
            if len(seen) >= len(VERSION):
                raise ValueError(f"damaged record at byte {at}") from None
            return None
        taken += len(data) - len(unpacker.unused_data)
        if len(seen) < len(VERSION):
            seen += part[: len(VERSION)]
            if not VERSION.startswith(seen[: len(VERSION)]):
                return None
        out.append(part)
    return (b"".join(out), taken) if len(seen) >= len(VERSION) else None


def members(file, start: int, end: int) -> Iterator[bytes]:
    """The records that start at a byte from ``start`` to before ``end``."""
    size = file.size()
    at = start
    while at < min(end, size):
        file.seek(at)
        data = file.read(min(READ, end - at) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        if found < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        got = _decode(file, at)
        if got is None:
            at += 1
        else:
            yield got[0]
            at += got[1]


def parse(data: bytes) -> tuple:
    """A row of ROWS from a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return (number("X-Page-Id"), fields.get("WARC-Target-URI"),
            len(payload) if kind == "response" else number("X-Payload-Length"), digest, kind,
            number("X-Refers-To-Page-Id"), payload if kind == "response" else None)


def read_warc(spark: SparkSession, archives: DataFrame, split_bytes: int = 1 << 20) -> DataFrame:
    """All records of ``archives`` (path, n_bytes), read in ranges of ``split_bytes`` (see ROWS)."""
    common.prepare(spark)
    ranges = archives.select("path", F.explode(F.expr(f"sequence(0L, n_bytes - 1, {split_bytes}L)")).alias("start"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with common.open_input(path) as file:
                    rows, held = [], 0
                    for data in members(file, start, start + split_bytes):
                        rows.append(parse(data))
                        held += len(data)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return ranges.repartition(common.n_partitions(spark), "path", "start").mapInArrow(read, ROWS)
