"""Capture archive: binary files to packets, packets to one row per beacon frame.

Packets can only be found one after the other, so a large capture is first walked for its packet headers alone; the pieces
between the places found are dealt out like files of their own and read as packets. All that a packet holds is taken from it by
Column functions. The two readers of record headers are the core's only Python-worker code.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband import config as C
from quietband import schemas
from quietband.functions import wire
from quietband.sources.run_tree import tasks
from quietband.sources.survey_files import path_file, path_run_id

#: Bytes of a piece of a capture, and of a batch of packets.
_PIECE_BYTES, _BATCH_BYTES = 1 << 22, 1 << 22
_BATCH_ROWS = 4096
_BUFFER_BYTES = 1 << 20
_HEADER_BYTES = 24

# Capture magic -> (byte order, nanoseconds per fraction unit).
_MAGIC = {
    b"\xd4\xc3\xb2\xa1": ("<", 1000), b"\xa1\xb2\xc3\xd4": (">", 1000),
    b"\x4d\x3c\xb2\xa1": ("<", 1), b"\xa1\xb2\x3c\x4d": (">", 1),
}
_PIECES = "run_id string, pcap_file string, path string, start bigint, stop bigint, first bigint, error string"
_PACKETS = (
    "run_id string, pcap_file string, frame_number bigint, frame_time_epoch string, wire_length bigint, packet binary, error string"
)


class CaptureError(ValueError):
    """A capture that cannot be decoded completely."""


def capture_files(spark: SparkSession, paths) -> DataFrame:
    """(run_id, pcap_file, length, path): a listing, no file is opened."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "freq-*.pcap").load(paths)
    )
    # The metadata path, unlike the path column, lets a filter on runs prune files unread.
    source = F.col("_metadata.file_path")
    return files.select(
        path_run_id(source).alias("run_id"), path_file(source).alias("pcap_file"),
        "length", source.alias("path"),
    )


def populated(captures: DataFrame) -> DataFrame:
    """Captures that hold more than the file header."""
    return captures.where(F.col("length") > C.EMPTY_CAPTURE_BYTES)


def decode_captures(captures: DataFrame) -> DataFrame:
    """Beacon frames of all populated captures, plus one error row per unreadable one.

    Captures are given by `path`, or by `content` where the bytes are at hand. A file that fails half-way has both frames and
    an error row; so has one that the store does not give, and its neighbours are read all the same.
    """
    return beacon_frames(read_packets(captures))


def packet_index(captures: DataFrame) -> DataFrame:
    """(run_id, pcap_file, path, start, stop, first, error): pieces of the captures that begin and end between packets.

    `first` is the number of the piece's first packet. A capture of up to _PIECE_BYTES is one piece and is not opened; of
    a larger one only record headers are looked at. What stops the walk is the error of the last piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run_id, name, path, length in zip(*(batch.column(i).to_pylist() for i in range(4))):
                # A file's pieces are few: one for each _PIECE_BYTES.
                rows = list(_pieces(path, length))
                columns = list(zip(*[(run_id, name, path, *row) for row in rows]))
                yield pa.record_batch(
                    [pa.array(c, pa.int64() if i in (3, 4, 5) else pa.string()) for i, c in enumerate(columns)],
                    names=["run_id", "pcap_file", "path", "start", "stop", "first", "error"],
                )

    full = populated(captures).select("run_id", "pcap_file", "path", "length")
    # Dealt out, since a filtered listing is tiny and would otherwise end in one task.
    return full.repartition(tasks(captures.sparkSession), "run_id", "pcap_file").mapInArrow(run, _PIECES)


def read_packets(captures: DataFrame) -> DataFrame:
    """(run_id, pcap_file, frame_number, frame_time_epoch, wire_length, packet, error) of all populated captures."""
    if "content" in captures.columns:
        return populated(captures).select("run_id", "pcap_file", "content").mapInArrow(_packets_of_contents, _PACKETS)
    pieces = packet_index(captures).repartition(tasks(captures.sparkSession), "run_id", "pcap_file", "start")
    return pieces.mapInArrow(_packets_of_pieces, _PACKETS)


def _open(path: str):
    files, name = FileSystem.from_uri(path)
    return files.open_input_file(name)


def _header(start: bytes) -> tuple[struct.Struct, int]:
    """How record headers are laid out, and nanoseconds of a fraction unit."""
    if len(start) < _HEADER_BYTES:
        raise CaptureError("missing global header")
    if start[:4] not in _MAGIC:
        raise CaptureError("unrecognised magic")
    order, unit = _MAGIC[start[:4]]
    (link,) = struct.unpack_from(order + "I", start, 20)
    if link != C.RADIOTAP_LINK_TYPE:
        raise CaptureError(f"link type {link} is not Radiotap")
    return struct.Struct(order + "4I"), unit


def _pieces(path: str, length: int) -> Iterator[tuple[int, int, int, str | None]]:
    """(start, stop, number of the first packet, error) of each piece."""
    if length <= _PIECE_BYTES:
        yield _HEADER_BYTES, length, 1, None
        return
    start, at, first, number = _HEADER_BYTES, _HEADER_BYTES, 1, 1
    try:
        with _open(path) as file:
            layout, _ = _header(file.read(_HEADER_BYTES))
            held, base = b"", _HEADER_BYTES
            while at + 16 <= length:
                if at + 16 > base + len(held):
                    # Headers are near each other: they are picked from large reads.
                    file.seek(at)
                    held, base = file.read(_BUFFER_BYTES), at
                    if len(held) < 16:
                        break
                size = layout.unpack_from(held, at - base)[2]
                if at + 16 + size > length:
                    raise CaptureError("truncated inside a packet record")
                at, number = at + 16 + size, number + 1
                if at - start >= _PIECE_BYTES:
                    yield start, at, first, None
                    start, first = at, number
    except (CaptureError, OSError) as problem:
        yield start, at, first, str(problem)
        return
    if at > start:
        yield start, at, first, None


def _records(stream, size: int, layout: struct.Struct, unit: int, number: int):
    """(number, time, length on air, bytes) of the records in the next `size` bytes."""
    at = 0
    while at + 16 <= size and len(record := stream.read(16)) == 16:
        seconds, fraction, held, wire_length = layout.unpack(record)
        at += 16 + held
        # A broken length is seen before its bytes are asked for.
        if at > size or len(packet := stream.read(held)) < held:
            raise CaptureError("truncated inside a packet record")
        yield number, f"{seconds}.{fraction * unit:09d}", wire_length, packet
        number += 1


class _Rows:
    """Packet rows, handed on in batches of bounded size."""

    def __init__(self):
        self.rows, self.size = [], 0

    def add(self, *row) -> bool:
        """Adds (run_id, pcap_file, number, time, length on air, packet, error); true when a batch is due."""
        self.rows.append(row)
        self.size += len(row[5] or b"")
        return len(self.rows) >= _BATCH_ROWS or self.size >= _BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string())
        names = ("run_id", "pcap_file", "frame_number", "frame_time_epoch", "wire_length", "packet", "error")
        columns = list(zip(*self.rows))
        self.__init__()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _packet_batches(sources) -> Iterator[pa.RecordBatch]:
    """Batches of the packets of (run_id, pcap_file, function that gives the records, error known already)."""
    out = _Rows()
    for run_id, name, records, error in sources:
        try:
            for record in records():
                if out.add(run_id, name, *record, None):
                    yield out.batch()
        except (CaptureError, OSError) as problem:
            error = error or str(problem)
        if error:
            out.add(run_id, name, None, None, None, None, f"{name}: {error}")
    if out.rows:
        yield out.batch()


def _packets_of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records(path: str, start: int, stop: int, first: int):
        with _open(path) as file:
            layout, unit = _header(file.read(_HEADER_BYTES))
            file.seek(start)
            yield from _records(io.BufferedReader(file, _BUFFER_BYTES), stop - start, layout, unit, first)

    def sources():
        for batch in batches:
            for run_id, name, path, start, stop, first, error in zip(*(c.to_pylist() for c in batch.columns)):
                yield run_id, name, lambda a=(path, start, stop, first): records(*a), error

    return _packet_batches(sources())


def _packets_of_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records(content: bytes):
        stream = io.BytesIO(content)
        layout, unit = _header(stream.read(_HEADER_BYTES))
        return _records(stream, len(content) - _HEADER_BYTES, layout, unit, 1)

    def sources():
        for batch in batches:
            for run_id, name, content in zip(*batch.columns):
                yield run_id.as_py(), name.as_py(), lambda c=content: records(c.as_py()), None

    return _packet_batches(sources())


def beacon_frames(packets: DataFrame) -> DataFrame:
    """One row per beacon among the packets (FRAMES), and the packets' error rows as they are."""
    b, radio, packet = F.col("b"), F.col("radio"), F.col("packet")
    rows = packets.withColumn("radio", wire.one_byte(packet, 2) + wire.one_byte(packet, 3) * 256)
    # Management type, subtype 8. Only single bytes are looked at, since this is pushed below all else.
    beacon = (F.length(packet) >= 8) & (F.length(packet) - radio >= 24) & (wire.one_byte(packet, radio).bitwiseAND(F.lit(0xFC)) == 0x80)
    rows = rows.where(F.col("error").isNotNull() | beacon)
    rows = rows.withColumn("b", wire.byte_values(packet))
    rows = rows.withColumn("fields", wire.radiotap_fields(b, radio))
    # A check sequence behind the frame is not part of it.
    rows = rows.withColumn("end", F.size(b) - F.when(wire.has_check_sequence(b, F.col("fields")), 4).otherwise(0))
    rows = rows.withColumns({"b": F.slice(b, F.lit(1), F.col("end")), "data": F.substring("packet", F.lit(1), F.col("end"))})
    rows = rows.withColumn("places", wire.element_places(b, radio + 36))
    rows = rows.withColumn("whole", F.filter("places", lambda e: e["whole"]))
    rows = rows.withColumns({
        "reports": wire.neighbor_reports(b, F.col("whole")), "extensions": wire.extension_elements(F.col("whole")),
    })
    rows = rows.withColumn("entries", wire.neighbor_entries(F.col("reports")))
    data = F.col("data")
    found = {
        "captured_length": F.length("packet").cast("bigint"),
        "bssid": F.regexp_replace(wire.hex_text(data, radio + 16, 6), "(..)(?=.)", "$1:"),
        "interval_tu": wire.little_endian(b, radio + 32, 2),
        "beacon_timestamp": F.when(F.size(b) - radio >= 32, wire.little_endian_text(b, radio + 24, 8)),
        **wire.radiotap_cells(b, F.col("fields")),
        **wire.element_cells(data, b, radio + 36, *map(F.col, ("places", "whole", "extensions"))),
        **wire.neighbor_cells(data, b, F.col("reports"), F.col("entries")),
    }
    # An error row has no cells.
    return rows.select(*[
        (F.when(F.col("error").isNull(), found[f.name]) if f.name in found else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in schemas.FRAMES
    ])
