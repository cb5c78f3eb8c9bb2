"""Periodic run detection by block convolution.

A run is a maximal stretch of words with smallest period q (words q apart are equal) and
length at least ``max(MIN_LENGTH, MIN_EXPONENT * q)``. Runs are found scale by scale: at
the dyadic scale B the text is cut into aligned blocks of B words, and each block is
compared with every place d words further on, for d up to 2B (from B + 1, or from 1 at
B = 1), by one convolution: the sum of squared differences of word numbers,
``sum x^2 - 2 sum x*y + sum y^2``, is zero exactly where the block occurs. The cross sums
come from a number theoretic transform modulo a prime, exact integer arithmetic in numpy:
a sum below the prime is zero if and only if its residue is.
A run of period q in (B, 2B] is at least 4q > 2B + q - 1 words long, so it holds an
aligned block and the block's copy q further on: each run is found at its scale. Every
zero is confirmed on the words themselves and extended both ways to the maximal stretch;
stretches whose period has a proper divisor that is also a period are the run of that
smaller period, found at its own scale.

Word numbers in the transform are taken modulo M, the largest with B * M^2 below the prime,
so that a block's sum stays below it; a collision can only add a candidate, which the word
comparison rejects. One transform serves the blocks of many documents at once.

The work is per document (``mapInArrow``): no shuffle, so no key can be hot. A text is
handled whole, its blocks in batches of ``BATCH_CELLS`` transform cells, so memory is linear
in the longest text and time grows as n log^2 n.

Defined cases: a null text has no words; a null ``doc_id`` gets no planted rewrite (the
contract's hash is of a decimal id); no run gives n_runs 0, null start, length, period and
exponent_milli, and the hashes of the empty string for runs; equal rows give equal rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakesearch.llm.common import document_columns, table
from lakesearch.llm.words import split_words, texts_of

# Fixed values of the contract.
MIN_LENGTH = 6
MIN_EXPONENT = 4
PLANT_EVERY = 10
PLANT_SPREAD = 8
PLANT_BASE = 3

#: A prime p = 119 * 2^23 + 1 with a primitive root; transforms of up to 2^23 cells.
PRIME, ROOT = 998244353, 3
#: Transform cells a batch of blocks holds (8 bytes each, a few arrays of it at once).
BATCH_CELLS = 1 << 21
#: Words of the documents handled together: their blocks of one scale share a transform.
GROUP_WORDS = 1 << 21
_NEVER = 1 << 62

_SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")
_ARROW = pa.schema([(name, pa.int64()) for name in _SCHEMA.replace(" long", "").split(", ")[:7]]
                   + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


@functools.lru_cache(maxsize=64)
def _plan(n: int, invert: bool) -> tuple[np.ndarray, tuple[tuple[np.ndarray, np.ndarray], ...]]:
    """Bit-reversed order and the twiddles (and twiddle / PRIME) of every stage of a transform of length ``n``."""
    bits = n.bit_length() - 1
    index = np.arange(n)
    order = np.zeros(n, np.int64)
    for b in range(bits):
        order |= ((index >> b) & 1) << (bits - 1 - b)
    stages, size = [], 2
    while size <= n:
        w = pow(ROOT, (PRIME - 1) // size, PRIME)
        if invert:
            w = pow(w, PRIME - 2, PRIME)
        twiddles = np.ones(1, np.int64)
        while len(twiddles) < size // 2:
            twiddles = np.concatenate((twiddles, twiddles * pow(w, len(twiddles), PRIME) % PRIME))
        stages.append((twiddles, twiddles / PRIME))
        size *= 2
    return order, tuple(stages)


def _mulmod(a: np.ndarray, b: np.ndarray, b_by_prime: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME for a, b in [0, PRIME): the quotient from floating point, which is
    off by one at most, and the remainder exact in 64-bit integers."""
    r = a * b - (a * b_by_prime).astype(np.int64) * PRIME
    np.add(r, PRIME, out=r, where=r < 0)
    np.subtract(r, PRIME, out=r, where=r >= PRIME)
    return r


def _ntt(a: np.ndarray, invert: bool = False) -> np.ndarray:
    """Transform each column of ``a`` (values in [0, PRIME), a power of two rows) modulo ``PRIME``.

    The blocks are the inner axis, so every step works on long contiguous runs of cells,
    whatever the stage.
    """
    n, columns = a.shape
    order, stages = _plan(n, invert)
    a, out = a[order], np.empty_like(a)
    size = 2
    for twiddles, scaled in stages:
        half = size // 2
        view, dest = a.reshape(n // size, size, columns), out.reshape(n // size, size, columns)
        low, high = view[:, :half], _mulmod(view[:, half:], twiddles[:, None], scaled[:, None])
        upper, lower = dest[:, :half], dest[:, half:]
        np.add(low, high, out=upper)
        np.subtract(upper, PRIME, out=upper, where=upper >= PRIME)
        np.subtract(low, high, out=lower)
        np.add(lower, PRIME, out=lower, where=lower < 0)
        a, out = out, a
        size *= 2
    if invert:
        inverse = pow(n, PRIME - 2, PRIME)
        a = _mulmod(a, np.int64(inverse), np.float64(inverse / PRIME))
    return a


def _zero_distances(values: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, docs: np.ndarray, starts: np.ndarray,
                    width: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, d), first <= d <= last, where block ``row`` (document ``docs[row]``, word
    ``starts[row]``) occurs again d words on in its document.

    The cross sums are one cyclic convolution of length ``n_fft`` >= ``span``: the sums
    wanted sit at width - 1 and on, which no wrapped term reaches. Places past the end of a
    document hold 0, which no word number is.
    """
    span = last - first + width
    n_fft = 1 << max(1, (span - 1).bit_length())
    base = offsets[docs] + starts
    blocks = values[base[:, None] + np.arange(width)]
    places = starts[:, None] + first + np.arange(span)
    inside = places < sizes[docs][:, None]
    windows = np.where(inside, values[np.minimum(offsets[docs][:, None] + places, len(values) - 1)], 0)
    sums = np.concatenate((np.zeros((len(starts), 1), np.int64), np.cumsum(windows * windows, axis=1)), axis=1)
    x2 = sums[:, width:width + last - first + 1] - sums[:, :last - first + 1]
    y2 = (blocks * blocks).sum(axis=1)[:, None]
    fx = np.zeros((n_fft, len(starts)), np.int64)
    fx[:span] = windows.T
    fy = np.zeros((n_fft, len(starts)), np.int64)
    fy[:width] = blocks[:, ::-1].T
    tx, ty = _ntt(fx), _ntt(fy)
    cross = _ntt(_mulmod(tx, ty, ty / PRIME), invert=True)[width - 1:width + last - first].T
    rows, at = np.nonzero((x2 + y2 - 2 * cross) % PRIME == 0)
    return rows, at + first


def _extend(words: np.ndarray, start: int, end: int, d: int) -> tuple[int, int]:
    """The maximal [s, e) around [start, end) in which words d apart are equal."""
    n, step, s, e = len(words), 64, start, end
    while s > 0:
        lo = max(0, s - step)
        bad = np.flatnonzero(words[lo:s] != words[lo + d:s + d])
        if bad.size:
            s = lo + int(bad[-1]) + 1
            break
        s, step = lo, step * 2
    step = 64
    while e < n:
        hi = min(n, e + step)
        bad = np.flatnonzero(words[e:hi] != words[e - d:hi - d])
        if bad.size:
            e = e + int(bad[0])
            break
        e, step = hi, step * 2
    return s, e


def _has_period(words: np.ndarray, s: int, e: int, p: int) -> bool:
    return bool((words[s:e - p] == words[s + p:e]).all())


def _covering(runs: list[tuple[int, int, int]], starts: list[int], s: int, e: int, d: int) -> tuple[int, int] | None:
    """A run of a period dividing ``d`` that holds [s, e), if one was found."""
    at = bisect.bisect_right(starts, s)
    for rs, length, q in runs[max(0, at - 8):at]:
        if rs <= s and e <= rs + length and d % q == 0:
            return rs, rs + length
    return None


def _next_occurrence(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Distance from each place to the next place of the same word in the same document;
    ``_NEVER`` where there is none."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((np.arange(len(numbers)), numbers, doc))
    out = np.full(len(numbers), _NEVER, np.int64)
    same = (numbers[order[1:]] == numbers[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    out[order[:-1][same]] = order[1:][same] - order[:-1][same]
    return out


def find_runs_many(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each word-number array, by start then period.

    At each scale the blocks of all documents go through one transform. Word numbers are
    taken modulo M with B * M^2 below the prime, so the squared differences of a block sum
    below it and the test for zero is exact on those numbers; equal words always give zero,
    and a zero of different words (equal modulo M) is rejected on the words.

    A candidate inside a run already found, of a period that divides its own, is extended
    from that run's ends: a long run of a short period costs each larger scale one pass over
    what lies beyond it, not one pass over the run for every distance.
    """
    sizes = np.array([len(d) for d in documents], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(documents) else sizes
    numbers = np.concatenate(documents).astype(np.int64) if len(documents) else np.zeros(0, np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    # farthest[i]: the largest distance to the next occurrence of a word of the block of the
    # current width at i (no next occurrence in its document: more than any distance). A block
    # occurs again d words on only if each of its words does, so a block whose farthest is above
    # the largest distance of a scale has no zero there and is left out of the transform.
    farthest = _next_occurrence(numbers, sizes)
    width = 1
    while True:
        first = 1 if width == 1 else width + 1
        last = 2 * width
        live = np.flatnonzero(sizes // MIN_EXPONENT >= first)
        if not live.size:
            break
        counts = (sizes[live] - width - first) // width + 1
        docs = np.repeat(live, counts)
        starts = (np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)) * width
        possible = farthest[offsets[docs] + starts] <= last
        docs, starts = docs[possible], starts[possible]
        modulus = math.isqrt((PRIME - 1) // width)
        values = numbers % modulus + 1
        rows_per_batch = max(1, BATCH_CELLS // (1 << max(1, (last - first + width - 1).bit_length())))
        found: dict[tuple[int, int], list[tuple]] = {}
        run_starts = [[r[0] for r in doc_runs] for doc_runs in runs]
        for b in range(0, len(docs), rows_per_batch):
            batch_docs, batch_starts = docs[b:b + rows_per_batch], starts[b:b + rows_per_batch]
            rows, distances = _zero_distances(values, sizes, offsets, batch_docs, batch_starts, width, first, last)
            for doc, start, d in zip(batch_docs[rows].tolist(), batch_starts[rows].tolist(), distances.tolist()):
                n = int(sizes[doc])
                if MIN_EXPONENT * d > n:
                    continue
                seen = found.setdefault((doc, d), [])
                end = start + width + d
                if seen and seen[-1][0] <= start and end <= seen[-1][1]:
                    continue
                words = numbers[offsets[doc]:offsets[doc] + n]
                if end > n or not _has_period(words, start, end, d):
                    continue
                inner = _covering(runs[doc], run_starts[doc], start, end, d)
                s, e = _extend(words, *(inner or (start, end)), d)
                seen.append((s, e, inner == (s, e)))
        for (doc, d), stretches in found.items():
            words = numbers[offsets[doc]:offsets[doc] + sizes[doc]]
            for s, e, inside in stretches:
                if not inside and e - s >= max(MIN_LENGTH, MIN_EXPONENT * d) and not any(
                        d % p == 0 and _has_period(words, s, e, p) for p in range(1, d // 2 + 1)):
                    runs[doc].append((s, e - s, d))
            runs[doc] = sorted(set(runs[doc]))
        if len(farthest) > width:
            farthest[:-width] = np.maximum(farthest[:-width], farthest[width:])
        width *= 2
    return [sorted(doc_runs, key=lambda r: (r[0], r[2])) for doc_runs in runs]


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one word-number array."""
    return find_runs_many([np.asarray(words, np.int64)])[0]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's rewrite: a periodic tail for one id in ``PLANT_EVERY``."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // PLANT_EVERY
    if h % PLANT_EVERY:
        return words
    a = g % n
    p = 1 + (n - a) // (PLANT_BASE + g % PLANT_SPREAD)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _numbered(documents: list[list[bytes]]) -> list[np.ndarray]:
    """Word numbers of each document; equal words get equal numbers across the documents."""
    flat = pa.array(list(itertools.chain.from_iterable(documents)), pa.binary())
    numbers = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(numbers, np.cumsum([len(d) for d in documents])[:-1])


def _row(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> dict:
    keep = np.ones(len(words), bool)
    for s, length, q in runs:
        keep[s + q:s + length] = False
    row = {"doc_id": doc_id, "n_words": len(words), "n_runs": len(runs), "start": None, "length": None, "period": None, "exponent_milli": None,
           "runs_sha256": hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
           "collapsed_sha256": hashlib.sha256(b" ".join(w for w, k in zip(words, keep.tolist()) if k)).hexdigest()}
    if runs:
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        row.update(start=s, length=length, period=q, exponent_milli=1000 * length // q)
    return row


def describe_many(rows: list[tuple[int | None, bytes]]) -> list[dict]:
    """One result row for each (doc_id, text)."""
    words = [planted(split_words(text), doc_id) for doc_id, text in rows]
    runs = find_runs_many(_numbered(words))
    return [_row(doc_id, w, r) for (doc_id, _), w, r in zip(rows, words, runs)]


def describe(doc_id: int | None, text: bytes) -> dict:
    """One result row of a text."""
    return describe_many([(doc_id, text)])[0]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        group, words, out = [], 0, []
        for row in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            group.append(row)
            words += row[1].count(b" ") + 1
            if words >= GROUP_WORDS:
                out += describe_many(group)
                group, words = [], 0
        out += describe_many(group)
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 per row."""
    return document_columns(docs).mapInArrow(_batches, _SCHEMA)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"))
