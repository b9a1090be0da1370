"""Web archives: writing, normalising of monolithic gzip streams, and reading by index."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import stored
from quietband.session import scratch_path

#: Payloads below this size are never revisited; bytes that an archive takes before the next one begins; bytes of one read.
LEAST_REVISITED, ARCHIVE_BYTES, CHUNK = 100, 1 << 26, 1 << 20
_GZIP = 31


def open_folder(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(uri)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: `response` with the payload, or `revisit` with the header only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def _write(folder: str):
    """Rows -> archives of one gzip stream each; yields their paths. A task attempt has file names of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        name = f"{TaskContext.get().partitionId()}-{TaskContext.get().taskAttemptId()}"
        out = packer = None
        written = seq = records = 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.record_batch({"path": [path], "records": pa.array([records], pa.int64())})

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns):
                if out is None:
                    path = f"{base}/{name}-{seq}.warc.gz"
                    out, packer = fs.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, _GZIP)
                    written = records = 0
                record = record_bytes(*row)
                out.write(packer.compress(record))
                written, records = written + len(record), records + 1
                if written >= ARCHIVE_BYTES:
                    yield close()
                    out, seq = None, seq + 1
        if out is not None:
            yield close()

    return run


def inflated(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The inflated bytes of a gzip file of one or many members, chunk by chunk."""
    stream, data = zlib.decompressobj(_GZIP), read(CHUNK)
    while data:
        piece = stream.decompress(data, CHUNK)
        if piece:
            yield piece
        if stream.eof:
            data = stream.unused_data or read(CHUNK)
            if data:
                stream = zlib.decompressobj(_GZIP)
                continue
            return
        data = stream.unconsumed_tail or read(CHUNK)
    raise ValueError("the gzip stream is cut short")


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, Iterator[bytes]]]:
    """(header, block chunks) of each record of a stream; holds a header and one chunk at a time."""
    chunks, rest = iter(chunks), b""

    def more() -> bool:
        nonlocal rest
        piece = next(chunks, None)
        if piece is None:
            return False
        rest += piece
        return True

    while True:
        while len(rest) < 4 and more():
            pass
        if not rest:
            return
        while (end := rest.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("a record header is cut short")
        head, rest = rest[: end + 4], rest[end + 4 :]
        left = int(header_fields(head)["content-length"]) + 4  # with the blank lines after the block

        def block() -> Iterator[bytes]:
            nonlocal rest, left
            while left:
                if not rest and not more():
                    raise ValueError("a record block is cut short")
                piece, rest = rest[:left], rest[left:]
                left -= len(piece)
                yield piece

        yield head, block()
        if left:
            raise ValueError("a record was not read to its end")


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines if line)}


def normalise(fs: FileSystem, source: str, target: str) -> list[tuple]:
    """Rewrite every record of `source` as a gzip member of its own in `target`, in one pass over the inflated stream.

    Writes `target`.idx beside it, a line per record: offset, length, type, record id. Returns its rows.
    """
    index, at = [], 0
    with fs.open_input_stream(source, compression=None) as file, fs.open_output_stream(target, compression=None) as out:
        for head, block in split_records(inflated(file.read)):
            packer, start = zlib.compressobj(6, zlib.DEFLATED, _GZIP), at
            for piece in chain([head], block):
                at += out.write(packer.compress(piece))
            at += out.write(packer.flush())
            fields = header_fields(head)
            index.append((start, at - start, fields["warc-type"], fields["warc-record-id"]))
    with fs.open_output_stream(f"{target}.idx", compression=None) as side:
        side.write("".join("\t".join(map(str, row)) + "\n" for row in index).encode())
    return index


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                target = f"{base}/{source.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{attempt}.warc.gz"
                index = normalise(fs, source, target)
                yield pa.record_batch({
                    "path": pa.array([target] * len(index), pa.string()),
                    "offset": pa.array([x[0] for x in index], pa.int64()),
                    "length": pa.array([x[1] for x in index], pa.int64()),
                })

    return run


def read_member(fs: FileSystem, file, offset: int, length: int) -> tuple[dict[str, str], int, str]:
    """Header fields of the member, and bytes and SHA-256 of its payload."""
    file.seek(offset)
    left = length

    def read(n: int) -> bytes:
        nonlocal left
        data = file.read(min(n, left))
        left -= len(data)
        return data

    (head, block), = ((h, b"".join(b)) for h, b in split_records(inflated(read)))
    payload = block[block.index(b"\r\n\r\n") + 4 : -4]
    return header_fields(head), len(payload), hashlib.sha256(payload).hexdigest()


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder)
        path = file = None
        ident = lambda x: int(x[10:-1]) if x and len(x) > 11 else None  # noqa: E731  <urn:page:N>
        for batch in batches:
            rows = []
            for p, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if p != path:
                    path, file = p, fs.open_input_file(p)
                fields, size, digest = read_member(fs, file, offset, length)
                revisit = fields["warc-type"] == "revisit"
                told = fields["warc-payload-digest"].removeprefix("sha256:")
                if not revisit and digest != told:
                    raise ValueError(f"{p} at {offset}: payload and digest differ")
                rows.append((
                    ident(fields["warc-record-id"]), None if revisit else size, told, fields["warc-type"],
                    ident(fields.get("warc-refers-to")),
                ))
            if rows:
                names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.record_batch({n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows))})

    return run


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes pages as archives; (path, records) of each.

    Of pages with equal payloads of LEAST_REVISITED bytes or more the smallest page_id is a response and the others revisit it.
    Smallest ids come from an aggregate by digest, so a hot payload is combined before the shuffle.
    """
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    firsts = (
        rows.where(F.length("payload") >= LEAST_REVISITED).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    )
    # The same join at every size; a hot digest is split by the adaptive plan.
    named = rows.join(firsts.hint("merge"), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )
    folder = scratch_path(spark, "llm-warc-streams")
    fs, base = open_folder(folder)
    fs.create_dir(base, recursive=True)
    return stored(named.mapInArrow(_write(folder), "path string, records long"), "warc-files")


def normalise_archives(files: DataFrame) -> DataFrame:
    """(path, offset, length) of every record, rewritten as a gzip member of its own, one task per stream."""
    spark = files.sparkSession
    folder = scratch_path(spark, "llm-warc-members")
    fs, base = open_folder(folder)
    fs.create_dir(base, recursive=True)
    count = max(1, files.count())
    return stored(
        files.select("path").repartition(count, "path").mapInArrow(_normalise(folder), "path string, offset long, length long"),
        "warc-index",
    )


def read_archives(index: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit has the size of what it refers to."""
    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = stored(
        index.repartitionByRange(parts, "path", "offset").sortWithinPartitions("path", "offset").mapInArrow(
            _read(scratch_path(spark, "llm-warc-members")),
            "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
        ),
        "warc-records",
    )
    responses = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("bytes")
    ).dropDuplicates()
    revisits = records.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
    return records.where("record_type = 'response'").unionByName(
        revisits.withColumn("payload_bytes", F.col("bytes")).select(*records.columns)
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives of one gzip stream, normalised to a member per record, and read back through the index.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. A null html is an empty payload, a null url
    an empty target. Rows that repeat the smallest page_id with one payload are all responses; rows with a null id revisit the
    smallest known one, or are responses if there is none. Other columns are ignored; an empty table gives an empty result.
    """
    return read_archives(normalise_archives(archive_pages(pages)))
