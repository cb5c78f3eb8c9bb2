"""Words of texts as 64-bit numbers, for numpy code inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

CACHE_WORDS = 1 << 18
_U = np.uint64


class WordHashes(dict):
    """Word (bytes) to its 64-bit hash; forgets everything when it has grown to ``CACHE_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(text: bytes) -> list[bytes]:
    """``bytes.split`` cuts at exactly the six ASCII blanks between words."""
    return text.split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step: every bit of the input reaches every bit of the result."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def window_hashes(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of each ``width`` consecutive values, in log2(width) steps."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, block, done, out = base, values, 0, None  # block: hashes of ``size`` values
    size, mask = 1, (1 << 64) - 1
    while True:
        if width & size:
            part = block[done:done + n]
            out = part.copy() if out is None else out * _U(power) + part
            done += size
        if done == width:
            return out
        block = block[:-size] * _U(power) + block[size:]
        power, size = power * power & mask, size * 2


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Texts as UTF-8; null as empty."""
    column = batch.column(name)
    return [t or b"" for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]
