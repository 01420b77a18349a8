"""Vectorised text kernels on UTF-8 bytes.  All work in pieces of a few MB, so memory stays bounded for any batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute

U = np.uint64
#: Bytes of text handled at once.
PIECE = 2 << 20
#: Words are hashed over runs of up to 2**POWERS bytes.
POWERS = 21


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit words that depend on seed only."""
    start = (seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    return splitmix(U(start) + np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15))


@cache
def byte_values(seed: int) -> np.ndarray:
    return constants(256, seed) | U(1)


@cache
def powers(log2: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i modulo 2**64 for i below 2**log2."""
    r = int(constants(1, seed)[0]) | 5
    inverse = pow(r, -1, 1 << 64)
    out = []
    for base in (r, inverse):
        p = np.ones(1, U)
        step = base
        while len(p) < 1 << log2:
            p = np.concatenate([p, p * U(step)])
            step = step * step & 0xFFFFFFFFFFFFFFFF
        out.append(p)
    return out[0], out[1]


def table(*spans: tuple[int, int]) -> np.ndarray:
    """True for the bytes in these inclusive spans."""
    t = np.zeros(256, bool)
    for a, b in spans:
        t[a : b + 1] = True
    return t


BLANK = table((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the texts as bytes (null: empty), each of up to limit bytes or of one row."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        size = np.fromiter((x or 0 for x in pa.compute.binary_length(texts).to_pylist()), np.int64, len(texts))
        total, start = 0, 0
        for i, s in enumerate(size):
            if i > start and total + s > limit:
                part = batch.slice(start, i - start)
                yield part, as_bytes(part, column)
                start, total = i, 0
            total += s
        if start < len(size):
            part = batch.slice(start)
            yield part, as_bytes(part, column)


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    texts = batch.column(batch.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else pa.binary()
    return [x or b"" for x in texts.cast(kind).to_pylist()]


class Words:
    """The words of some texts: start and end in buf, doc (index of the text) and, by hashes(), a 64-bit hash each.

    doc_at has the first word of each text, with the number of words at the end.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray, lower: bool = False):
        self.buf = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
        if lower:
            self.buf = LOWER[self.buf]
        self.off = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.off[1:])
        inside = ~separators[self.buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc_at = np.searchsorted(self.start, self.off)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.doc_at))

    def hashes(self, seed: int = 1) -> np.ndarray:
        out = np.empty(len(self.start), U)
        value, (power, inverse) = byte_values(seed), powers(POWERS, seed)
        i = 0
        while i < len(self.start):
            base = self.start[i]
            j = int(np.searchsorted(self.end, base + len(power), side="right"))
            if j == i:  # a single word longer than the table of powers
                out[i] = int.from_bytes(hashlib.blake2b(self.buf[base : self.end[i]].tobytes(), digest_size=8).digest(), "little")
                i += 1
                continue
            n = self.end[j - 1] - base
            sums = np.zeros(n + 1, U)
            np.cumsum(value[self.buf[base : base + n]] * power[:n], out=sums[1:])
            out[i:j] = (sums[self.end[i:j] - base] - sums[self.start[i:j] - base]) * inverse[self.start[i:j] - base]
            i = j
        return splitmix(out)


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal True runs."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[0::2], edge[1::2]


def lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
