"""Small PNG writer and brute-force pixel arithmetic for the tests."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def png(pixels: np.ndarray) -> bytes:
    """Encode ``uint8[h, w]`` or ``uint8[h, w, 3 or 4]``."""
    pixels = np.atleast_3d(pixels)
    height, width, channels = pixels.shape
    kind = {1: 0, 3: 2, 4: 6}[channels]
    lines = b"".join(b"\0" + row.tobytes() for row in pixels)

    def chunk(name: bytes, data: bytes) -> bytes:
        body = name + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def unpng(data: bytes) -> np.ndarray:
    """Decode what ``png`` wrote."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    width, height, _, kind = struct.unpack(">IIBB", data[16:26])
    at, body = 33, b""
    while at < len(data):
        size = struct.unpack(">I", data[at : at + 4])[0]
        if data[at + 4 : at + 8] == b"IDAT":
            body += data[at + 8 : at + 8 + size]
        at += size + 12
    channels = {0: 1, 2: 3, 6: 4}[kind]
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * channels)
    return rows[:, 1:].reshape(height, width, channels)


def picture(seed: int, height: int = 12, width: int = 16, channels: int = 3) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 256, (height, width, channels), dtype=np.uint8)
