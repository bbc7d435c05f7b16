"""Words of a text as bytes, and hashes of words and word sequences in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; a null text is empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def values(*columns: pa.Array, step: int = 128) -> Iterator:
    """The values of a column (of several: tuples) as Python objects, a few rows at a time, so that a batch never exists twice."""
    for at in range(0, len(columns[0]), step):
        parts = [c.slice(at, step).to_pylist() for c in columns]
        yield from parts[0] if len(parts) == 1 else zip(*parts)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` cuts at exactly these six characters."""
    return text_bytes(text).split()


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased; ``bytes.lower`` leaves all other bytes alone."""
    return text_bytes(text).lower().split()


def word_hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of MurmurHash3)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


class Sequences:
    """Hashes of any run of consecutive values in constant time.

    A run is hashed as a polynomial modulo 2**64 taken from prefix sums; dividing by the power of the
    start makes equal runs equal wherever they stand.
    """

    def __init__(self, values: np.ndarray, seed: int = 0):
        n = len(values)
        powers = np.full(n, BASE, np.uint64)
        back = np.full(n, INVERSE, np.uint64)
        if n:
            powers[0] = back[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.back = np.multiply.accumulate(back)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(values + np.uint64(seed)) * powers, out=self.prefix[1:])

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """Hashes of the runs at ``starts`` (each start below the number of values)."""
        runs = (self.prefix[starts + lengths] - self.prefix[starts]) * self.back[starts]
        return mix(runs + np.uint64(lengths) if np.isscalar(lengths) else runs + lengths.astype(np.uint64))


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's bigint."""
    return np.asarray(values, np.uint64).view(np.int64)


def batches(schema: pa.Schema, columns: list) -> Iterator[pa.RecordBatch]:
    """One record batch of the given columns, if they have rows."""
    if len(columns[0]):
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)
