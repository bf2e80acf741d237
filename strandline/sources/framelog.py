"""A message log in a shared folder as a stream source with offsets of its own.

A log is a folder of segment files, one message a line, to which writers append and to which they add segments; what has been
written never changes. An offset is the number of bytes read of every segment. A trigger takes each segment up
to its last line break, so a message that is still being written waits for the next one. The range of a segment is cut into pieces of
``piece_bytes``; a piece yields the lines that begin in it, in Arrow batches, so tasks are bounded however much has gathered
and only offsets pass through the driver. A restarted query repeats exactly the ranges of its checkpoint.

    spark.dataSource.register(FrameLog)
    messages = spark.readStream.format("frame_log").load(folder)

gives ``(segment, position, value)``: file name below the folder, byte position and text of the message; ``(segment, position)``
names a message for ever, so a sink can tell one that it already has. Empty lines are no messages, bytes that are no UTF-8 become U+FFFD.
Hidden files (a leading ``.`` or ``_``) are no segments. A segment that is removed after it was read is forgotten; one that is shorter than
what was read of it fails the query, and so does a piece whose segment is gone before it could be read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

PIECE, BLOCK = 32 << 20, 1 << 20
SCHEMA = "segment string, position bigint, value string"


@dataclass
class Piece(InputPartition):
    """The lines of a segment that begin in [start, end); ``stop`` ends the range of the trigger, a line break."""

    segment: str
    start: int
    end: int
    stop: int


def _store(folder: str):
    from pyarrow import fs

    from strandline.sources.writers import arrow_uri

    uri = arrow_uri(folder)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def _last_break(source, start: int, size: int) -> int:
    """The end of the last whole line in [start, size); ``start`` if there is none. Reads backwards, blocks at a time."""
    end = size
    while end > start:
        begin = max(start, end - BLOCK)
        source.seek(begin)
        at = source.read(end - begin).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        end = begin
    return start


class LogReader(DataSourceStreamReader):
    def __init__(self, folder: str, piece_bytes: int):
        self.folder, self.piece_bytes = folder, piece_bytes
        self.ends: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        store, base = _store(self.folder)
        found = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        ends: dict[str, int] = {}
        for info in found:
            name = info.path[len(base) :].lstrip("/")
            if info.type != fs.FileType.File or any(part[0] in "._" for part in name.split("/")):
                continue
            known = self.ends.get(name, 0)
            if info.size > known:
                with store.open_input_file(info.path) as source:
                    known = _last_break(source, known, info.size)
            ends[name] = min(known, info.size)
        self.ends = ends
        return dict(sorted(ends.items()))

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        pieces = []
        for segment, stop in end.items():
            first = start.get(segment, 0)
            if stop < first:
                raise ValueError(f"segment {segment} of {self.folder} ends at {stop}, but {first} bytes of it were read")
            pieces += [Piece(segment, at, min(at + self.piece_bytes, stop), stop) for at in range(first, stop, self.piece_bytes)]
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        store, base = _store(self.folder)
        with store.open_input_file(f"{base}/{partition.segment}") as source:
            yield from _lines(source, partition)

    def commit(self, end: dict) -> None:
        pass


def _lines(source, piece: Piece) -> Iterator[pa.RecordBatch]:
    # A line begins behind a break, and the first of a segment at its start: look for a break from just before the piece.
    at = piece.start
    if at:
        source.seek(at - 1)
        while at < piece.end and (block := source.read(min(BLOCK, piece.end - at))):
            found = block.find(b"\n")
            if found >= 0:
                at += found
                break
            at += len(block)
        else:
            return
    held = b""
    source.seek(at)
    while at < piece.end:
        block = source.read(min(BLOCK, piece.stop - at - len(held)))
        if not block:
            raise ValueError(f"segment {piece.segment} is shorter than {piece.stop} bytes")
        held += block
        cut = held.rfind(b"\n") + 1
        positions, values = [], []
        for line in held[:cut].split(b"\n")[:-1]:
            if at >= piece.end:
                break
            if line.strip(b"\r"):
                positions.append(at)
                values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
            at += len(line) + 1
        held = held[cut:]
        if positions:
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece.segment] * len(positions)), pa.array(positions, pa.int64()), pa.array(values, pa.string())],
                ["segment", "position", "value"],
            )


class FrameLog(DataSource):
    """``format("frame_log")``; options: the folder as the path, ``pieceBytes``."""

    @classmethod
    def name(cls) -> str:
        return "frame_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"], int(self.options.get("pieceBytes", PIECE)))


def log_frames(spark, folder: str, piece_bytes: int = PIECE):
    """The messages of a log folder as a stream of ``(segment, position, value)``."""
    spark.dataSource.register(FrameLog)
    return spark.readStream.format("frame_log").option("pieceBytes", piece_bytes).load(folder)
