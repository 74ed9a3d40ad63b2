"""WARC archives as chunked record tables.

Pages are written as gzip members of WARC files, one file for each task. Reading streams each file: a payload comes as rows
of record id and chunk number, each with the digest of the payload so far, so no record is ever held whole. Equal payloads
are stored once: later ones are revisit records.

Defined cases: null html is an empty payload; payloads under the least size are never revisits; every row that repeats
the smallest page id of its group is a response; rows without a page id revisit one that has it, and are responses if
there is none; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.session import scratch_path, written

LEAST = 100
CHUNK = 64 * 1024
CHUNKS = "record_id string, record_type string, uri string, page_id bigint, refers_to bigint, payload_bytes bigint, declared_digest string, chunk int, data binary, bytes_so_far bigint, digest_so_far string, is_last boolean"


def roles(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = LEAST) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type and refers_to."""
    payload = F.coalesce(F.col(html), F.lit(""))
    df = pages.withColumns({"payload_bytes": F.octet_length(payload).cast("bigint"), "payload_digest": F.sha2(payload, 256)})
    first = df.filter(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("__digest")).agg(F.min(key).alias("__first"), F.count("*").alias("__n"))
    df = df.join(first.filter("__n > 1").drop("__n"), F.col("payload_digest") == F.col("__digest"), "left")
    revisit = F.col("__first").isNotNull() & ~F.col(key).eqNullSafe(F.col("__first"))
    df = df.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("__first")))
    return df.drop("__digest", "__first")


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _record(kind: str, headers: list[tuple[str, str]], body_length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {body_length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Writes the archives and returns their names and record counts. A task's file appears under its name when whole."""
    df = roles(pages, key, html, least).select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), "record_type", "refers_to", "payload_bytes", "payload_digest",
        F.when(F.col("record_type") == "response", F.coalesce(F.col(html), F.lit(""))).alias("html"),
    )

    def write(batches):
        name, store, out, records = f"{uuid.uuid4().hex}.warc.gz", None, None, 0
        for batch in batches:
            if out is None:
                store, folder = _place(path)
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/_{name}", compression=None)
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")]
            for i, (page, uri, kind, refers, size, digest) in enumerate(zip(*columns)):
                body = batch.column("html")[i].as_buffer() if kind == "response" else pa.py_buffer(b"")
                headers = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(size))]
                if uri is not None:
                    headers.append(("WARC-Target-URI", " ".join(uri.split())))
                if page is not None:
                    headers.append(("X-Page-ID", str(page)))
                if refers is not None:
                    headers.append(("X-Refers-To-Page", str(refers)))
                packed = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(packed.compress(_record(kind, headers, len(body))))
                view = memoryview(body)
                for s in range(0, len(view), CHUNK):
                    out.write(packed.compress(view[s : s + CHUNK]))
                out.write(packed.compress(b"\r\n\r\n") + packed.flush())
                records += 1
        if out is not None:
            out.close()
            store.move(f"{folder}/_{name}", f"{folder}/{name}")
            yield pa.record_batch([pa.array([f"{path.rstrip('/')}/{name}"]), pa.array([records], pa.int64())], names=["file", "records"])

    return written(df.mapInArrow(write, "file string, records bigint"))


class _Stream:
    """Bytes of a file of gzip members, decompressed piece by piece."""

    def __init__(self, source):
        self.source, self.held, self.decoder, self.raw = source, bytearray(), None, b""

    def fill(self) -> bool:
        while True:
            if self.decoder is None or self.decoder.eof:
                self.raw = self.decoder.unused_data if self.decoder else self.raw
                self.raw = self.raw or self.source.read(CHUNK)
                if not self.raw:
                    return False
                self.decoder = zlib.decompressobj(31)
            elif self.decoder.unconsumed_tail:
                self.raw = self.decoder.unconsumed_tail
            else:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    return False
            piece = self.decoder.decompress(self.raw, CHUNK)
            if piece:
                self.held += piece
                return True
            if self.decoder.eof and not self.decoder.unused_data:
                self.raw, self.decoder = b"", None

    def until(self, mark: bytes) -> bytes | None:
        at = self.held.find(mark)
        while at < 0:
            seen = len(self.held)
            if not self.fill():
                return None
            at = self.held.find(mark, max(0, seen - len(mark)))
        out = bytes(self.held[: at + len(mark)])
        del self.held[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.fill():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def chunks(file: str):
    """Rows of CHUNKS of one archive, in order."""
    store, place = _place(file)
    with store.open_input_stream(place, compression=None) as source:
        stream = _Stream(source)
        while (head := stream.until(b"\r\n\r\n")) is not None:
            fields = dict(line.split(": ", 1) for line in head.decode("utf-8").strip().split("\r\n")[1:])
            left, number, so_far, digest = int(fields["Content-Length"]), 0, 0, hashlib.sha256()
            meta = (
                fields["WARC-Record-ID"].strip("<>"), fields["WARC-Type"], fields.get("WARC-Target-URI"), _number(fields.get("X-Page-ID")), _number(fields.get("X-Refers-To-Page")),
                _number(fields.get("X-Payload-Length")), fields.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
            )
            while True:
                data = stream.take(min(left, CHUNK))
                if not data and left:
                    raise ValueError(f"{file}: record {meta[0]} ends early")
                left -= len(data)
                so_far += len(data)
                digest.update(data)
                yield (*meta, number, data, so_far, digest.hexdigest(), left == 0)
                number += 1
                if not left:
                    break
            if stream.take(4) != b"\r\n\r\n":
                raise ValueError(f"{file}: record {meta[0]} does not end where it should")


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_warc(spark: SparkSession, files: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives named in column ``file``; without data the chunks keep their digests only."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    names = [f.split()[0] for f in CHUNKS.split(", ") if with_data or f != "data binary"]
    ddl = ", ".join(f for f in CHUNKS.split(", ") if with_data or f != "data binary")
    kinds = to_arrow_schema(_parse_datatype_string(ddl))
    drop = CHUNKS.split(", ").index("data binary")

    def stream(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                for row in chunks(file):
                    rows.append(row if with_data else row[:drop] + row[drop + 1 :])
                    held += len(row[drop]) if with_data else 1_000
                    if held > 4 << 20:
                        yield pa.record_batch([pa.array(c, kinds.field(n).type) for n, c in zip(names, zip(*rows))], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, kinds.field(n).type) for n, c in zip(names, zip(*rows))], names=names)

    return files.select("file").repartition(max(1, spark.sparkContext.defaultParallelism * 2)).mapInArrow(stream, ddl)


def records(chunked: DataFrame) -> DataFrame:
    """One row for each record from its last chunk; responses must agree with their declared digest and length."""
    last = chunked.filter("is_last")
    good = (F.col("record_type") != "response") | ((F.col("digest_so_far") == F.col("declared_digest")) & (F.col("bytes_so_far") == F.coalesce("payload_bytes", "bytes_so_far")))
    checked = F.when(good, F.col("declared_digest")).otherwise(F.raise_error(F.concat(F.lit("payload of record "), "record_id", F.lit(" is damaged"))))
    return last.select(
        "record_id", "page_id", "uri", F.when(F.col("record_type") == "response", F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        checked.alias("payload_digest"), "record_type", "refers_to",
    )


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Writes the pages to new archives in the shared folder, reads them back and returns their records."""
    spark = pages.sparkSession
    files = write_warc(pages, scratch_path(spark, "warc"), key, url, html, least)
    return records(read_warc(spark, files, with_data=False))
