"""Binary media columns: PNG images written and read with zlib and numpy, and a perceptual hash of their samples.

``to_png`` lays a payload out as 8-bit grey samples, 64 to a row. ``from_png`` tests signature, chunk
lengths and checksums, inflates, undoes the five row filters and returns the samples with a 64-bit hash of
the image's low cosine frequencies. Null and empty payloads become one row of zero bytes. A damaged or
foreign image, or one of more than ``MOST_SAMPLES``, whatever its bytes are, gives a null payload and feature and a
message in ``error``; null media give all three null. Inflating stops at the size that the header gives.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
LEVEL = 6
#: Samples that an image may have to be read: what inflating may at most take.
MOST_SAMPLES = 1 << 30
#: Samples a side of the picture that is transformed, and low frequencies a side that are kept.
SIDE, LOW = 32, 8
_k = np.arange(LOW)[:, None]
COSINES = np.cos(np.pi * (2 * np.arange(SIDE)[None, :] + 1) * _k / (2 * SIDE)) * np.where(_k == 0, np.sqrt(1 / SIDE), np.sqrt(2 / SIDE))


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def padded(payload: bytes) -> bytes:
    """The payload with zero bytes up to a positive multiple of the row width."""
    return payload + bytes(-len(payload) % WIDTH if payload else WIDTH)


def encode_png(samples: np.ndarray) -> bytes:
    """An 8-bit grey PNG of a two-dimensional uint8 array; each row takes the filter of least absolute sum."""
    height, width = samples.shape
    sub, up = samples.copy(), samples.copy()
    sub[:, 1:] -= samples[:, :-1]
    up[1:] -= samples[:-1]
    ways = np.stack([samples, sub, up])
    best = np.abs(ways.view(np.int8).astype(np.int16)).sum(axis=2).argmin(axis=0)
    lines = np.empty((height, width + 1), dtype=np.uint8)
    lines[:, 0] = best
    lines[:, 1:] = ways[best, np.arange(height)]
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + chunk(b"IEND", b"")


def unfilter(lines: np.ndarray) -> np.ndarray:
    """Samples of filtered rows of one byte a pixel; runs of rows with the same filter go together."""
    kinds, data = lines[:, 0], lines[:, 1:].copy()
    starts = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
    for start, end in zip(starts, np.r_[starts[1:], len(kinds)]):
        kind, above = kinds[start], data[start - 1] if start else np.zeros(data.shape[1], dtype=np.uint8)
        if kind == 1:
            data[start:end] = np.cumsum(data[start:end], axis=1, dtype=np.uint8)
        elif kind == 2:
            data[start:end] = np.cumsum(np.vstack([above[None], data[start:end]]), axis=0, dtype=np.uint8)[1:]
        elif kind in (3, 4):
            for y in range(start, end):
                above = data[y] = predicted(data[y], above, kind)
        elif kind:
            raise ValueError(f"row filter {kind}")
    return data


def predicted(row: np.ndarray, above: np.ndarray, kind: int) -> np.ndarray:
    """A row of the average (3) or Paeth (4) filter, which depend on the sample just restored."""
    out, up = [], above.tolist()
    left = corner = 0
    for x, b in zip(row.tolist(), up):
        if kind == 3:
            guess = (left + b) // 2
        else:
            p = left + b - corner
            by_left, by_up, by_corner = abs(p - left), abs(p - b), abs(p - corner)
            guess = left if by_left <= by_up and by_left <= by_corner else b if by_up <= by_corner else corner
        left, corner = (x + guess) & 255, b
        out.append(left)
    return np.array(out, dtype=np.uint8)


def decode_png(media: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG without interlacing; ValueError on any damage."""
    if media[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, header, body, ended = 8, None, [], False
    while at < len(media) and not ended:
        if at + 12 > len(media):
            raise ValueError("cut chunk")
        (size,), kind = struct.unpack_from(">I", media, at), media[at + 4 : at + 8]
        data = media[at + 8 : at + 8 + size]
        if len(data) < size or at + 12 + size > len(media):
            raise ValueError("cut chunk")
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(data, zlib.crc32(kind)):
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            if header is not None or size != 13:
                raise ValueError("header twice or of another length")
            header = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            body.append(data)
        ended = kind == b"IEND"
        at += 12 + size
    if header is None or not ended:
        raise ValueError("no header or no end")
    width, height, *form = header
    if form != [8, 0, 0, 0, 0]:
        raise ValueError("not plain 8-bit grey")
    if not width or not height or width * height > MOST_SAMPLES:
        raise ValueError(f"{width} x {height} samples")
    size, inflate = height * (width + 1), zlib.decompressobj()
    try:
        raw = inflate.decompress(b"".join(body), size + 1)
    except zlib.error as broken:
        raise ValueError(str(broken)) from broken
    if len(raw) != size or not inflate.eof:
        raise ValueError("wrong amount of samples")
    return unfilter(np.frombuffer(raw, dtype=np.uint8).reshape(height, width + 1))


def shrunk(samples: np.ndarray, axis: int) -> np.ndarray:
    """SIDE cells along an axis: means of equal shares, or repeated samples where there are fewer."""
    size = samples.shape[axis]
    cuts = np.arange(SIDE) * size // SIDE
    if size < SIDE:
        return np.take(samples, cuts, axis=axis)
    counts = np.diff(np.r_[cuts, size])
    return np.add.reduceat(samples, cuts, axis=axis) / counts.reshape([-1, 1] if axis == 0 else [1, -1])


def cosine_hash(samples: np.ndarray) -> str:
    """16 hex digits: which of the 64 lowest cosine frequencies lie over the median of all but the constant one."""
    small = shrunk(shrunk(samples.astype(np.float64), 0), 1)
    low = np.round(COSINES @ small @ COSINES.T, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def to_png(payload: Column) -> Column:
    """A binary column of payloads as PNG images."""

    @F.pandas_udf("binary")
    def write(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            images = (encode_png(np.frombuffer(padded(x or b""), dtype=np.uint8).reshape(-1, WIDTH)) for x in batch)
            yield pd.Series(list(images), dtype=object)

    return write(payload)


def from_png(media: Column) -> Column:
    """struct<payload: binary, feature: string, error: string> of a binary column of PNG images."""

    @F.pandas_udf("payload binary, feature string, error string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for image in batch:
                try:
                    samples = None if image is None else decode_png(image)
                    out.append((None, None, None) if samples is None else (samples.tobytes(), cosine_hash(samples), None))
                except ValueError as broken:
                    out.append((None, None, str(broken)))
            yield pd.DataFrame(out, columns=["payload", "feature", "error"], dtype=object)

    return read(media)


def with_media(df: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """Adds each text's UTF-8 bytes as a PNG; a column of that name is replaced, all rows stay."""
    return df.withColumn(media_col, to_png(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def media_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each text as an image, reads it back and reports lengths, digests and the feature."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    stored = with_media(df.select(id_col, size, F.col(text_col).alias("text")), "text").drop("text")
    back = stored.withColumn("back", from_png(F.col("media")))
    payload = F.col("back.payload")
    return back.select(
        id_col,
        "n_bytes",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -WIDTH, WIDTH)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2(F.col("media"), 256).alias("media_sha256"),
        F.col("back.feature").alias("feature"),
    )
