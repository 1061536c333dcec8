"""Pictures as arrays: Pillow decodes them where it is installed; else PNG is decoded here and other formats are refused."""

from __future__ import annotations

import io
import zlib

import numpy as np

try:
    from PIL import Image
except ImportError:
    Image = None

UNKNOWN = "cannot identify image file"


def size_of_header(b: bytes) -> tuple[int, int]:
    """(width, height) from the header of a PNG, GIF or JPEG file."""
    if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        return int.from_bytes(b[16:20], "big"), int.from_bytes(b[20:24], "big")
    if b[:4] == b"GIF8" and len(b) >= 10:
        return int.from_bytes(b[6:8], "little"), int.from_bytes(b[8:10], "little")
    if b[:2] == b"\xff\xd8":
        i = 2
        while i + 9 <= len(b) and b[i] == 0xFF:
            if 0xC0 <= b[i + 1] <= 0xCF and b[i + 1] not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(b[i + 7 : i + 9], "big"), int.from_bytes(b[i + 5 : i + 7], "big")
            i += 2 + int.from_bytes(b[i + 2 : i + 4], "big")
    raise ValueError(UNKNOWN)


def verified_size(b: bytes) -> tuple[int, int]:
    """(width, height) of a whole, readable file; without Pillow only PNG is read beyond its header."""
    if Image is not None:
        with Image.open(io.BytesIO(b)) as im:
            im.verify()
        with Image.open(io.BytesIO(b)) as im:
            return im.size
    size = size_of_header(b)
    if b[:4] == b"\x89PNG":
        for _ in _chunks(b):
            pass
    return size


def _chunks(b: bytes):
    at = 8
    while True:
        n, kind = int.from_bytes(b[at : at + 4], "big"), b[at + 4 : at + 8]
        body, crc = b[at + 8 : at + 8 + n], b[at + 8 + n : at + 12 + n]
        if len(crc) < 4:
            raise ValueError("truncated PNG file")
        if zlib.crc32(kind + body) != int.from_bytes(crc, "big"):
            raise ValueError(f"broken PNG file: bad checksum in {kind!r}")
        yield kind, body
        if kind == b"IEND":
            return
        at += 12 + n


def _png(b: bytes) -> np.ndarray:
    """(height, width, channels) of a PNG of 8 bits a channel without interlacing; palettes are looked up."""
    head, data, palette = None, [], None
    for kind, body in _chunks(b):
        if kind == b"IHDR":
            head = body
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
    if head is None:
        raise ValueError(UNKNOWN)
    w, h = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(head[9])
    if head[8] != 8 or head[12] or channels is None:
        raise ValueError("PNG of this depth or interlacing needs Pillow")
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w, channels), np.uint8)
    above = np.zeros((w, channels), np.int64)
    for y in range(h):
        line = rows[y, 1:].reshape(w, channels).astype(np.int64)
        kind = rows[y, 0]
        if kind == 1:
            line = np.cumsum(line, axis=0) & 255
        elif kind == 2:
            line = (line + above) & 255
        elif kind in (3, 4):
            left, corner = np.zeros(channels, np.int64), np.zeros(channels, np.int64)
            for x in range(w):
                if kind == 3:
                    guess = (left + above[x]) // 2
                else:
                    p = left + above[x] - corner
                    a, u, c = abs(p - left), abs(p - above[x]), abs(p - corner)
                    guess = np.where((a <= u) & (a <= c), left, np.where(u <= c, above[x], corner))
                left, corner = (line[x] + guess) & 255, above[x]
                line[x] = left
        out[y], above = line, line
    return palette[out[:, :, 0]] if head[9] == 3 and palette is not None else out


def rgb(b: bytes) -> np.ndarray:
    """(height, width, 3) as bytes."""
    if Image is not None:
        with Image.open(io.BytesIO(b)) as im:
            return np.asarray(im.convert("RGB"))
    if b[:4] != b"\x89PNG":
        size_of_header(b)
        raise ValueError("decoding this format needs Pillow")
    x = _png(b)
    return x[:, :, :3] if x.shape[2] >= 3 else np.repeat(x[:, :, :1], 3, axis=2)


def gray(b: bytes) -> np.ndarray:
    """(height, width): luma by ITU-R 601-2, rounded."""
    x = rgb(b).astype(np.int64)
    return ((x[:, :, 0] * 19595 + x[:, :, 1] * 38470 + x[:, :, 2] * 7471 + 0x8000) >> 16).astype(np.uint8)


def _lanczos(n: int, m: int) -> np.ndarray:
    """(m, n) weights that resample n samples to m, the kernel widened when shrinking."""
    scale = n / m
    wide = max(scale, 1.0)
    x = (np.arange(n)[None, :] + 0.5 - (np.arange(m)[:, None] + 0.5) * scale) / wide
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)
    return w / w.sum(1, keepdims=True)


def resize(x: np.ndarray, width: int, height: int) -> np.ndarray:
    """A picture of bytes at another size by Lanczos' kernel of three lobes, across first, rounded after each direction."""
    y = x.astype(np.float64).reshape(x.shape[0], x.shape[1], -1)
    for axis, size in ((1, width), (0, height)):
        if y.shape[axis] != size:
            y = np.moveaxis(np.tensordot(_lanczos(y.shape[axis], size), y, (1, axis)), 0, axis)
            y = np.clip(np.floor(y + 0.5), 0, 255)
    return y.astype(np.uint8).reshape(height, width, *x.shape[2:])
