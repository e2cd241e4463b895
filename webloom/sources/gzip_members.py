"""Lines of gzip files of many members, as a Spark data source that cuts a file into byte ranges.

A range's task reads the members that start in it. As with plain text splits, it leaves the line it
begins in to the task before, unless it begins the file, and reads on to the end of its last line. A
file of one member is read by the task of its first range alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# First bytes of a member: magic number and the one known method (fixed value).
MEMBER_START = b"\x1f\x8b\x08"
RANGE_BYTES = 128 << 20
CHUNK = 1 << 20


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


class GzipMembers(DataSource):
    """Option ``path``: a file or folder that ``pyarrow.fs`` opens; ``rangeBytes``: size of a range."""

    @classmethod
    def name(cls) -> str:
        return "gzip_members"

    def schema(self) -> str:
        return "path string, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)))


class _Reader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def partitions(self) -> list[ByteRange]:
        """Ranges of all files, planned from their sizes."""
        from pyarrow import fs

        system, root = _file_system(self.path)
        found = [system.get_file_info(root)]
        if found[0].type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if found[0].type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(root))
        files = sorted(
            (info.path, info.size)
            for info in found
            if info.type == fs.FileType.File and not info.base_name.startswith(("_", "."))
        )
        step = self.range_bytes
        ranges = [
            ByteRange(path, at, min(at + step, size)) for path, size in files for at in range(0, size, step)
        ]
        # Spark wants one partition at least.
        return ranges or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[tuple[str, str]]:
        if partition.end == 0:
            return
        system, _ = _file_system(self.path)
        with system.open_input_file(partition.path) as file:
            for line in range_lines(file, partition.start, partition.end):
                yield partition.path, line.decode("utf-8", "replace")


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def range_lines(file, start: int, end: int) -> Iterator[bytes]:
    """Lines that belong to the members starting in ``[start, end)``, without their line ends.

    A member that does not decode, or ends early, is an error of the task that it follows on, which
    decodes the member after its own to the end for that reason.
    """
    first = 0 if start == 0 else _first_member(file, start, end)
    if first is None:
        return
    # The line that an earlier task began is left to it.
    skipping, rest = first > 0, []
    for at, piece in _pieces(file, first):
        if at >= end:
            # Past the own members: one line end more.
            yield from _last_line(file, at, rest, skipping)
            return
        lines = piece.split(b"\n")
        for line in lines[:-1]:
            if not skipping:
                yield _whole(rest, line)
            skipping, rest = False, []
        if not skipping:
            rest.append(lines[-1])
    if any(rest):
        yield _whole(rest, b"")


def _last_line(file, at: int, rest: list[bytes], skipping: bool) -> Iterator[bytes]:
    """The rest of the line that begins before the member at ``at``. That member is decoded to its end."""
    done = skipping
    for place, piece in _pieces(file, at):
        if done and place > at:
            return
        if not done:
            line, found, _ = piece.partition(b"\n")
            rest.append(line)
            if found:
                yield _whole(rest, b"")
                done = True
    if not done and any(rest):
        yield _whole(rest, b"")


def _whole(rest: list[bytes], line: bytes) -> bytes:
    return b"".join([*rest, line]).removesuffix(b"\r")


def _first_member(file, start: int, end: int) -> int | None:
    """Place of the first member that starts in the range. Compressed bytes may look like a start, so
    a member counts if it decodes to its end, where its checksum stands. Text in UTF-8 never holds
    these bytes, so a member kept uncompressed does not look like two."""
    at, keep = start, len(MEMBER_START) - 1
    while at < end:
        file.seek(at)
        block = file.read(min(CHUNK, end - at) + keep)
        hit = block.find(MEMBER_START)
        while hit >= 0:
            if at + hit < end and _decodes(file, at + hit):
                return at + hit
            hit = block.find(MEMBER_START, hit + 1)
        at += CHUNK
    return None


def _decodes(file, at: int) -> bool:
    try:
        return all(place == at for place, _ in _pieces(file, at, members=1))
    except (zlib.error, EOFError):
        return False


def _pieces(file, at: int, members: int | None = None) -> Iterator[tuple[int, bytes]]:
    """``(place of the member, bytes)`` of the members from ``at`` on, in pieces of bounded size. Zero
    bytes between members are passed over."""
    file.seek(at)
    data, place, decoder, seen = b"", at, None, 0
    while True:
        if not data:
            data = file.read(CHUNK)
            if not data:
                if decoder is not None:
                    raise EOFError(f"the gzip member at byte {at} ends early")
                return
        if decoder is None:
            bare = data.lstrip(b"\0")
            place += len(data) - len(bare)
            data = bare
            if not data or seen == members:
                if seen == members:
                    return
                continue
            decoder, at, seen = zlib.decompressobj(wbits=31), place, seen + 1
            yield at, b""
        piece = decoder.decompress(data, CHUNK)
        left = decoder.unused_data if decoder.eof else decoder.unconsumed_tail
        place += len(data) - len(left)
        data = left
        if piece:
            yield at, piece
        if decoder.eof:
            decoder = None


def read_gzip_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, value)``: every line of the gzip files at ``path``, several tasks to a file of many members."""
    spark.dataSource.register(GzipMembers)
    return spark.read.format("gzip_members").option("rangeBytes", range_bytes).load(path)
