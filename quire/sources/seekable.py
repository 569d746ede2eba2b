"""Seekable zstd files of lines, read by several tasks.

A zstd file cannot be split, but one that ends in a seek table (a skippable frame that lists the sizes of all frames)
says where its frames start, and each frame can be unpacked alone. A Python data source makes ranges of frames its
partitions and hands over Arrow batches. Files without a table are read as before, one task each.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.sources.landing import dataset_of
from quire.sources.readers import read_lines

FORMAT = "seekable_zstd_lines"
TARGET_BYTES = 128 * 1024 * 1024  # unpacked, of a partition
BATCH_BYTES = 8 * 1024 * 1024

# Fixed values of the format: little-endian numbers, the skippable frame's first four bytes and the table's last four.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")  # frames, descriptor (bit 7: checksums follow the sizes), last four bytes


def _opened(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return system.open_input_file(name)


def frames(path: str) -> list[tuple[int, int, int]] | None:
    """(offset, packed size, unpacked size) of every frame, or None for a file without a seek table."""
    with _opened(path) as f:
        size = f.size()
        if size < _FOOTER.size + 8:
            return None
        f.seek(size - _FOOTER.size)
        count, descriptor, last = _FOOTER.unpack(f.read(_FOOTER.size))
        entry = 12 if descriptor & 0x80 else 8
        whole = 8 + count * entry + _FOOTER.size
        if last != _SEEKABLE or whole > size:
            return None
        f.seek(size - whole)
        magic, length = struct.unpack("<II", f.read(8))
        if magic != _SKIPPABLE or length != whole - 8:
            return None
        table, out, at = f.read(count * entry), [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", table, k * entry)
            out.append((at, packed, plain))
            at += packed
        return out if at == size - whole else None


@dataclass
class FrameRange(InputPartition):
    """Lines that start in the frames of one file from ``first`` on, before ``last``."""

    path: str
    first: int
    last: int

    def __init__(self, path: str, first: int, last: int):
        super().__init__((path, first, last))
        self.path, self.first, self.last = path, first, last


def ranges(path: str, target_bytes: int) -> list[FrameRange]:
    """The frames of a file in ranges of about ``target_bytes``, unpacked."""
    held, out, first, size = frames(path), [], 0, 0
    for k, (_, _, plain) in enumerate(held):
        size += plain
        if size >= target_bytes or k == len(held) - 1:
            out.append(FrameRange(path, first, k + 1))
            first, size = k + 1, 0
    return out


def lines_of(part: FrameRange) -> Iterator[list[bytes]]:
    """Whole lines of a range, some at a time.

    A range leaves out what stands before its first line break, unless it starts the file, and goes on behind its end up
    to the first line break there: that line, even one that starts right at the end, is its own.
    """
    import zstandard

    held = frames(part.path)
    rest, skip, batch, size = b"", part.first > 0, [], 0
    with _opened(part.path) as f:
        for k in range(part.first, len(held)):
            offset, packed, plain = held[k]
            f.seek(offset)
            text = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain) if plain else b""
            if k >= part.last:  # behind the end: only up to the first line break
                cut = text.find(b"\n")
                if cut < 0:
                    rest += text
                    continue
                if not skip:
                    batch.append(rest + text[:cut])
                rest, skip = b"", True
                break
            if skip:
                cut = text.find(b"\n")
                if cut < 0:
                    continue
                text, skip = text[cut + 1:], False
            *whole, rest = (rest + text).split(b"\n")
            batch += whole
            size += len(text)
            if size >= BATCH_BYTES:
                yield batch
                batch, size = [], 0
    if rest and not skip:
        batch.append(rest)
    if batch:
        yield batch


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], target_bytes: int):
        self.paths, self.target_bytes = paths, target_bytes

    def partitions(self) -> Sequence[InputPartition]:
        return [r for p in self.paths for r in ranges(p, self.target_bytes)]

    def read(self, partition: FrameRange) -> Iterator:
        import pyarrow as pa

        for lines in lines_of(partition):
            # \r at a line's end stays, as in the other readers; bytes that are no UTF-8 become U+FFFD
            texts = [line.decode("utf-8", "replace") for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([partition.path] * len(texts), pa.string())],
                                             ["value", "file_path"])


class SeekableZstdLines(DataSource):
    """``value, file_path`` of the files in option ``paths`` (a JSON list), all with a seek table."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, file_path string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["paths"]), int(self.options.get("targetBytes", TARGET_BYTES)))


def read_seekable_lines(spark: SparkSession, paths: Sequence[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """S02. Lines of zstd files, ``value, file_path, dataset``: those with a seek table by ranges of frames.

    The driver looks at the last bytes of every file, through a file system that Python reaches; where it does not reach
    one, use :func:`quire.sources.readers.read_lines`.
    """
    able = [p for p in paths if frames(p) is not None]
    others = [p for p in paths if p not in set(able)]
    parts = [read_lines(spark, others)] if others else []
    if able:
        spark.dataSource.register(SeekableZstdLines)
        lines = spark.read.format(FORMAT).option("paths", json.dumps(able)).option("targetBytes", target_bytes).load()
        name = F.element_at(F.split("file_path", "/"), -1)
        parts.append(lines.select("value", "file_path", dataset_of(name).alias("dataset")))
    if not parts:
        raise ValueError("no files to read")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
