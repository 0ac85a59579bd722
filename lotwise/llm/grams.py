"""Hashed byte n-grams of texts as dense counts, many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def codes(data: bytes, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Bucket below ``2**bits`` of every byte n-gram of the given sizes."""
    values = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)
    parts = []
    for size in sizes:
        if len(values) < size:
            continue
        total = np.full(len(values) - size + 1, size, np.uint32)
        for place in range(size):
            total = total * np.uint32(0x01000193) ^ values[place : place + len(total)] * np.uint32(0x9E3779B1)
        total ^= total >> np.uint32(15)
        total *= np.uint32(0x85EBCA6B)
        parts.append(total >> np.uint32(32 - bits))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def count_rows(texts: list[bytes], sizes: tuple[int, ...], bits: int, most: int = 64) -> Iterator[np.ndarray]:
    """Counts per text and bucket, ``most`` texts at a time, as float32."""
    for begin in range(0, len(texts), most):
        part = texts[begin : begin + most]
        rows = np.zeros((len(part), 1 << bits), np.float32)
        for row, text in zip(rows, part):
            row[:] = np.bincount(codes(text, sizes, bits), minlength=1 << bits)
        yield rows
