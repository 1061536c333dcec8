"""Perceptual hashes of pictures: 64 bits each, as 16 hex digits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..sources.images import gray, resize

#: Side of a hash in bits.
SIDE = 8


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()).tobytes().hex()


def dct_hash(x: np.ndarray) -> str:
    """Low frequencies of the cosine transform of a 32 x 32 picture, above their median."""
    n = 4 * SIDE
    k = np.arange(n)
    basis = np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))
    low = (basis @ resize(x, n, n).astype(np.float64) @ basis.T)[:SIDE, :SIDE]
    return _hex(low > np.median(low))


def gradient_hash(x: np.ndarray) -> str:
    """Each pixel of a 9 x 8 picture against its left neighbour."""
    p = resize(x, SIDE + 1, SIDE)
    return _hex(p[:, 1:] > p[:, :-1])


def wavelet_hash(x: np.ndarray) -> str:
    """The coarse Haar coefficients at 8 x 8, above their median: means of equal blocks of the largest square of a power of two
    that the picture holds.  Taking away the mean of all pixels, as is usual, moves all of them alike."""
    n = max(SIDE, 1 << (max(1, min(x.shape[:2])).bit_length() - 1))
    p = resize(x, n, n).astype(np.float64).reshape(SIDE, n // SIDE, SIDE, n // SIDE).mean((1, 3))
    return _hex(p > np.median(p))


def image_signatures(images: DataFrame) -> DataFrame:
    """(path, phash, dhash, whash, hash_error) of (path, content).  A picture that can't be decoded has NULL hashes and the reason."""

    def run(batches):
        for b in batches:
            rows = []
            for c in b["content"]:
                try:
                    g = gray(bytes(c))
                    rows.append((dct_hash(g), gradient_hash(g), wavelet_hash(g), ""))
                except Exception as e:  # noqa: BLE001 - any failure belongs to the row
                    rows.append((None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame({"path": b["path"], **{c: [r[i] for r in rows] for i, c in enumerate(("phash", "dhash", "whash", "hash_error"))}})

    return images.select("path", "content").mapInPandas(run, "path string, phash string, dhash string, whash string, hash_error string")
