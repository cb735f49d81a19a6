"""QuickLZ level-1 blocks: header and decoder. A block is sequential by nature; files are what is decoded in parallel."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The most bytes that a header may announce.
MAX_OUTPUT = 512 << 20
SLOTS = 4096


class QuickLZError(ValueError):
    """A block that can't be decoded."""


@dataclass(frozen=True)
class Header:
    flags: int
    size: int
    compressed: int
    decompressed: int
    level: int
    streaming: int
    is_compressed: bool


def parse_header(data: bytes) -> Header:
    """The 3-byte header, or the 9-byte one if bit 1 of the flags is set."""
    if not data:
        raise QuickLZError("empty block")
    flags = data[0]
    wide = 4 if flags & 2 else 1
    size = 1 + 2 * wide
    if len(data) < size:
        raise QuickLZError(f"block of {len(data)} bytes is shorter than its header of {size}")
    compressed, decompressed = (int.from_bytes(data[1 + k * wide : 1 + (k + 1) * wide], "little") for k in (0, 1))
    return Header(flags, size, compressed, decompressed, flags >> 2 & 3, flags >> 4 & 3, bool(flags & 1))


def decompress(data: bytes, max_output: int | None = MAX_OUTPUT) -> bytes:
    """The bytes of one block; QuickLZError for a block that is cut, forged, of another level or of a stream."""
    h = parse_header(data)
    if h.compressed != len(data):
        raise QuickLZError(f"the header says {h.compressed} bytes, the block has {len(data)}")
    if h.decompressed <= 0:
        raise QuickLZError("the header announces no output")
    if max_output is not None and max_output <= 0:
        raise ValueError("max_output must be positive or None")
    if max_output is not None and h.decompressed > max_output:
        raise QuickLZError(f"output of {h.decompressed} bytes exceeds the limit of {max_output}")
    if h.level != 1:
        raise QuickLZError(f"level {h.level} is not supported, only level 1")
    if h.streaming:
        raise QuickLZError("streaming blocks are not supported")
    if not h.is_compressed:
        if len(data) != h.size + h.decompressed:
            raise QuickLZError("an uncompressed block must hold its output exactly")
        return bytes(data[h.size :])
    try:
        return _decode(data, h.size, h.decompressed)
    except IndexError:
        raise QuickLZError("the block ends too early") from None


def _decode(src: bytes, s: int, total: int) -> bytes:
    """Literals and matches steered by 31-bit control words; a match names a slot of recently hashed output positions.

    A run of literals is copied at once, and positions are hashed only when a match is about to ask for them.
    """
    out, slots = bytearray(total), [0] * SLOTS
    seen = np.frombuffer(out, np.uint8)
    d, hashed, control, matches_until = 0, 0, 1, total - 11

    def hash_until(end: int) -> None:
        """Note positions from `hashed` up to, but not, `end`."""
        if end - hashed < 12:
            for p in range(hashed, end):
                f = out[p] | out[p + 1] << 8 | out[p + 2] << 16
                slots[(f >> 12 ^ f) & 4095] = p
        else:
            part = seen[hashed : end + 2].astype(np.uint32)
            f = part[:-2] | part[1:-1] << 8 | part[2:] << 16
            for p, slot in enumerate(((f >> 12 ^ f) & 4095).tolist(), hashed):
                slots[slot] = p

    while True:
        if control == 1:
            if s + 4 > len(src):
                raise QuickLZError("the block ends within a control word")
            control, s = int.from_bytes(src[s : s + 4], "little"), s + 4
            if not control:
                raise QuickLZError("a control word is zero")
        if control & 1:
            control >>= 1
            hash_until(d - 2)
            hashed = max(hashed, d - 2)
            low = src[s]
            at = slots[low >> 4 | src[s + 1] << 4]
            if low & 15:
                length, s = (low & 15) + 2, s + 2
            else:
                length, s = src[s + 2], s + 3
            if length < 3 or at > d - 3 or d + length > total:
                raise QuickLZError("a match lies outside the output")
            start = d
            if at + length <= d:
                out[d : d + length] = out[at : at + length]
            else:  # the match repeats what it writes
                piece = out[at:d]
                out[d : d + length] = (piece * (length // len(piece) + 1))[:length]
            d += length
            hash_until(start + 1)
            hashed = d
        elif d <= matches_until:
            run = min((control & -control).bit_length() - 1, matches_until - d + 1)
            if s + run > len(src):
                raise QuickLZError("the block ends within literals")
            out[d : d + run] = src[s : s + run]
            d, s, control = d + run, s + run, control >> run
        else:
            while d < total:
                if control == 1:
                    s, control = s + 4, 1 << 31
                out[d] = src[s]
                d, s, control = d + 1, s + 1, control >> 1
            return bytes(out)
