"""Grayscale previews of calibrated heights, as PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def height_image(heights: np.ndarray, low: float = 2.0, high: float = 98.0) -> np.ndarray:
    """u8 image of (profiles, columns): dark is low, limits are two percentiles of the finite heights, what is not finite is black."""
    heights = np.asarray(heights, float)
    if heights.ndim != 2 or not heights.size:
        raise ValueError("heights must be a non-empty table of profiles and columns")
    if not 0.0 <= low < high <= 100.0:
        raise ValueError("percentiles must rise from 0 to 100")
    good = np.isfinite(heights)
    if not good.any():
        raise ValueError("there are no finite heights")
    a, b = np.percentile(heights[good], [low, high])
    share = np.full(heights.shape, 0.5) if b <= a else np.clip((np.where(good, heights, a) - a) / (b - a), 0.0, 1.0)
    return np.where(good, np.rint(share * 255.0), 0).astype(np.uint8)


def png(image: np.ndarray) -> bytes:
    """An 8-bit grayscale PNG: no filter, zlib level 6."""
    if image.ndim != 2 or image.dtype != np.uint8 or not image.size:
        raise ValueError("the image must be a non-empty table of bytes")

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = np.pad(image, ((0, 0), (1, 0))).tobytes()
    size = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", size) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")
