"""WARC archives: pages become records, and a normaliser turns a monolithic gzip stream into one member a record.

A task first writes its records as one gzip stream over the whole file. The normaliser inflates that stream once, piece
by piece, finds the records by their headers, and writes each as a gzip member of its own, with a sidecar index of
offsets, so that a reader takes any record without inflating the ones before it.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import common

#: Payloads from this size on are kept once.
LEAST_BYTES = 100
#: Groups of equal payloads are dealt out by so many salts.
SALTS = 32
#: Bytes of records from which a task begins another archive.
ARCHIVE_BYTES = 32 << 20
PIECE = 1 << 16
DATE = "1970-01-01T00:00:00Z"
HEADER_END = b"\r\n\r\n"


def record(page_id: int | None, url: str | None, kind: str, payload: bytes, digest: str, payload_bytes: int, refers_to: int | None) -> bytes:
    """A WARC 1.1 record; a revisit has no block."""
    name = lambda k: f"<urn:page:{'null' if k is None else k}>"
    target = re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), url or "about:blank")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {payload_bytes}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head[6:6] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    return "\r\n".join(head).encode() + HEADER_END + payload + HEADER_END


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """Pieces of a gzip stream, of one member or of several."""
    z = zlib.decompressobj(31)
    while data := source.read(PIECE):
        while data:
            piece = z.decompress(data, 1 << 20)
            if piece:
                yield piece
            if z.eof:
                data, z = z.unused_data, zlib.decompressobj(31)
            else:
                data = z.unconsumed_tail
    if rest := z.flush():
        yield rest


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Cuts an inflated stream into records, by header and length; it holds one record at a time."""
    held = bytearray()
    ended = False

    def more() -> bool:
        nonlocal ended
        piece = next(pieces, None)
        ended = piece is None
        if not ended:
            held.extend(piece)
        return not ended

    while True:
        searched = 0
        while (at := held.find(HEADER_END, searched)) < 0:
            searched = max(0, len(held) - 3)
            if not more():
                if held.strip():
                    raise ValueError("the archive ends within a header")
                return
        size = at + 4 + int(headers(bytes(held[:at]))["content-length"]) + 4
        while len(held) < size:
            if not more():
                raise ValueError("the archive ends within a record")
        yield bytes(held[:size])
        del held[:size]


def normalise(source: BinaryIO, into: BinaryIO, level: int = 6) -> list[tuple[int, int, str]]:
    """Rewrites a gzip stream of records with a member each; returns the index: offset, length, record id."""
    index, at = [], 0
    for r in records(inflated(source)):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = z.compress(r) + z.flush()
        into.write(member)
        index.append((at, len(member), headers(r[: r.index(HEADER_END)])["warc-record-id"]))
        at += len(member)
    return index


def index_bytes(index: list[tuple[int, int, str]]) -> bytes:
    return "".join(f"{o} {n} {name}\n" for o, n, name in index).encode()


def read_index(data: bytes) -> list[tuple[int, int, str]]:
    return [(int(o), int(n), name) for o, n, name in (x.split(" ", 2) for x in data.decode().splitlines())]


def read_member(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record from its own member."""
    data = zlib.decompress(member, 31)
    at = data.index(HEADER_END)
    head = headers(data[:at])
    return head, data[at + 4 : at + 4 + int(head["content-length"])]


def decided(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest, n_bytes, refers_to: which pages revisit another with an equal payload.

    The first of each group is a minimum over (digest, salt) and then over digest. Only groups of more than one matter;
    those go to the pages by (digest, salt), so that one payload that a third of the pages has is in as many parts as
    there are salts. Pages are shuffled once, and payloads in compressed form.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = plain.select("page_id", "url", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("n_bytes")).withColumn("salt", salt)
    groups = rows.where(F.col("n_bytes") >= least).groupBy("digest", "salt").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    salted = groups.select("digest", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    # Null keys come after all others: a page without one revisits the first that has one.
    refers = F.when((F.col("first") != F.col("page_id")) | (F.col("page_id").isNull() & F.col("first").isNotNull()), F.col("first"))
    return rows.join(salted, ["digest", "salt"], "left").select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "digest", "n_bytes", refers.alias("refers_to"))


def write_archives(pages: DataFrame, into: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per page to archives in the shared folder `into`, each with its index beside it; returns the manifest (path, records).

    Null html is an empty payload; payloads under LEAST_BYTES are always responses. Pages with equal key and payload are
    responses all, if theirs is the least key of the group. An empty table writes no archive. A task that is tried again
    replaces its files whole.
    """
    spark = pages.sparkSession
    common.prepare(spark)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0

        def open_stream() -> tuple[BinaryIO, Callable]:
            return io.BytesIO(), zlib.compressobj(1, zlib.DEFLATED, 31)

        def finish(stream: BinaryIO, z) -> pa.RecordBatch:
            nonlocal seq
            stream.write(z.flush())
            stream.seek(0)
            with stream, io.BytesIO() as out:
                index = normalise(stream, out)
                uri = f"{into}/part-{part:06d}-{seq:06d}.warc.gz"
                common.publish(uri, out.getvalue())
                common.publish(uri + ".idx", index_bytes(index))
            seq += 1
            return pa.RecordBatch.from_pylist([{"path": uri, "records": len(index)}])

        stream, z, held = *open_stream(), 0
        for batch in batches:
            for page_id, url, payload, digest, n_bytes, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = record(page_id, url, "response" if refers_to is None else "revisit", payload or b"", digest, n_bytes, refers_to)
                stream.write(z.compress(data))
                held += len(data)
                if held >= archive_bytes:
                    yield finish(stream, z)
                    stream, z, held = *open_stream(), 0
        if held:
            yield finish(stream, z)

    rows = decided(pages, id_col, url_col, html_col)
    return common.checkpoint(rows.mapInArrow(run, "path string, records long"))


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Records of the archives of a manifest, by their indexes: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response are taken of the payload that was read, those of a revisit from its header.
    """
    number = lambda name: None if (k := name.removeprefix("<urn:page:").removesuffix(">")) == "null" else int(k)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = common.file_system(uri)
                with system.open_input_file(path + ".idx") as f:
                    index = read_index(f.read())
                rows = []
                with system.open_input_file(path) as f:
                    for offset, size, name in index:
                        f.seek(offset)
                        head, block = read_member(f.read(size))
                        if head["warc-record-id"] != name:
                            raise ValueError(f"{path}: the index names {name} at {offset}")
                        kind = head["warc-type"]
                        own = (len(block), hashlib.sha256(block).hexdigest()) if kind == "response" else (int(head["x-payload-length"]), head["warc-payload-digest"].removeprefix("sha256:"))
                        rows.append({"page_id": number(name), "payload_bytes": own[0], "payload_digest": own[1], "record_type": kind, "refers_to": number(head["warc-refers-to"]) if kind == "revisit" else None})
                        if len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, min(2000, manifest.count()))
    return manifest.select("path").repartition(files).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
