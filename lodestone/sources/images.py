"""Image files as rows: kind and size from their headers, and a digest of their bytes."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import IMAGE_SUFFIXES

#: Markers of JPEG frames, which hold the size; markers without a length.
FRAMES = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}
BARE = {0x01, *range(0xD0, 0xD8)}


def header(data: bytes) -> tuple[str | None, int | None, int | None]:
    """(kind, width, height) by the bytes themselves; nulls for what is no PNG, JPEG, GIF, BMP or WebP, or is cut off."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR":
            return "png", *struct.unpack(">II", data[16:24])
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return "gif", *struct.unpack("<HH", data[6:10])
        if data[:2] == b"BM":
            width, height = struct.unpack("<ii", data[18:26])
            return "bmp", width, abs(height)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return "webp", *_webp(data)
        if data[:2] == b"\xff\xd8":
            return "jpeg", *_jpeg(data)
    except (struct.error, IndexError):
        pass
    return None, None, None


def _webp(data: bytes) -> tuple[int, int]:
    form = data[12:16]
    if form == b"VP8X":
        return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
    if form == b"VP8L":
        bits = struct.unpack("<I", data[21:25])[0]
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    width, height = struct.unpack("<HH", data[26:30])
    return width & 0x3FFF, height & 0x3FFF


def _jpeg(data: bytes) -> tuple[int, int]:
    at = 2
    while True:
        if data[at] != 0xFF:
            raise IndexError("no marker")
        marker = data[at + 1]
        if marker in FRAMES:
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        at += 1 if marker == 0xFF else 2 if marker in BARE else 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """path, length, sha256, kind, width, height of image files below a folder, by suffix. Bytes don't leave the task that
    reads them."""
    glob = "*.{" + ",".join(x for s in IMAGE_SUFFIXES for x in (s[1:], s[1:].upper())) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, widths, heights = zip(*[header(x.as_py()) for x in batch.column("content")], strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("path", "length", "sha256")], pa.array(kinds, pa.string()), pa.array(widths, pa.int32()), pa.array(heights, pa.int32())], names=["path", "length", "sha256", "kind", "width", "height"])

    rows = files.select(F.url_decode("path").alias("path"), "length", F.sha2("content", 256).alias("sha256"), "content")
    return rows.mapInArrow(run, "path string, length long, sha256 string, kind string, width int, height int")
