"""Media columns: a binary column of baseline JPEG files, written from texts and read for sizes, hashes and thumbnails.

A payload is stored as quantised coefficients, 64 to a block, so it is kept without loss. Reading parses the markers,
decodes the Huffman-coded scan and rebuilds the luminance thumbnail from DC coefficients.

Defined results: a null or empty text is a payload of 64 zero bytes; equal texts give equal files; repeated rows are
all returned, those with a null id too; other columns are ignored, whatever their names; an empty table gives an empty result; a text over 4 GB is refused.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jpeg
from .common import table
from .kernels import slices
from .packed import record_batch

FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int, thumbnail_hash string"
_TYPES = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}


def padded(text: np.ndarray) -> np.ndarray:
    """The bytes with zeros up to a positive multiple of a block."""
    out = np.zeros(max(1, -(-len(text) // jpeg.BLOCK)) * jpeg.BLOCK, np.uint8)
    out[: len(text)] = text
    return out


def store(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, at in slices(batches, most=jpeg.PASS):
        files = jpeg.encode([padded(data[at[i] : at[i + 1]]) for i in range(batch.num_rows)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(at)), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])


def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*(x.split() for x in FEATURES.split(", ")), strict=True)
    for batch in batches:
        ids, sizes, media = batch.column("doc_id").to_pylist(), batch.column("n_bytes").to_pylist(), batch.column("media")
        at = 0
        while at < len(ids):
            files, held = [], 0
            while at + len(files) < len(ids) and (not files or held < jpeg.PASS):
                files.append(media[at + len(files)].as_py())
                held += len(files[-1])
            out = []
            for i, (file, (parsed, coefficients)) in enumerate(zip(files, jpeg.decode(files), strict=True)):
                used = int.from_bytes(parsed.comment, "big")
                payload = (coefficients[:used] + 128).astype(np.uint8).tobytes()
                small = jpeg.thumbnail(parsed, coefficients)
                hashed = jpeg.thumbnail_hash(small)
                feature = f"{parsed.width}x{parsed.height}/{small.shape[1]}x{small.shape[0]}/{hashed}/{zlib.crc32(small.tobytes()):08x}"
                out.append((ids[at + i], sizes[at + i], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-jpeg.BLOCK :]), len(file), hashlib.sha256(file).hexdigest(), feature, parsed.width, parsed.height, hashed))
            at += len(files)
            yield record_batch(out, list(names), [_TYPES[k] for k in kinds])


def store_media(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes (of the text), media (a JPEG file that holds the text)."""
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return given.mapInArrow(store, "doc_id long, n_bytes long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """What the stored files hold: the payload's size and hashes as read back, the file's own, and the thumbnail's."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(features, FEATURES)


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(store_media(table(spark, sf_dir, "documents")))


SQL = None
