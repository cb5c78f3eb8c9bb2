"""Quality rules: hashed n-gram log-likelihood ratio of two multinomials.

The trusted target is the documents that a label calls good, the raw corpus all documents.
Both give counts of hashed n-grams: byte trigrams, and pairs of neighbouring words hashed
by the difference of their hashes, which puts all doubled words into one bucket. A document's
score is the mean over its trigrams plus the mean over its pairs of
log(target share) - log(raw share), in whole millionths, so that it does not depend on the
order of sums. Documents below a fixed threshold are rejected, like those that fail the
base rules.

The number of buckets is a parameter, so what the driver gets and sends back is bounded;
raw counts cover every document. The target is learnt from ``TRUSTED_ROWS`` labelled documents
at most, picked by a hash of their id, whose ids are broadcast: no text is shuffled.

Defined cases: a null or empty text has no words and fails the base rules; a null id is
never trusted; equal rows count each; without trusted documents every ratio is 0 and only
the base rules decide; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakesearch.llm.common import document_columns, table
from lakesearch.llm.words import WordHashes, mixed, split_words, texts_of, window_hashes

BUCKET_BITS = 16
PRIOR = 1000.0
TRUSTED_ROWS = 1 << 17
THRESHOLD = -0.5
UNIT = 1_000_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"

_U = np.uint64


def trigram_buckets(text: bytes, bits: int) -> np.ndarray:
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    return ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - bits)


def pair_buckets(words: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(words[1:] - words[:-1]) >> _U(64 - bits)).astype(np.int64)


def ngram_counts(docs: DataFrame, trusted: np.ndarray, bits: int = BUCKET_BITS) -> DataFrame:
    """(bucket, raw, target): n-grams of all texts, and of those whose id is in ``trusted``;
    buckets of pairs follow those of trigrams."""
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(trusted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, hashes = np.zeros((2, 2 << bits), np.int64), WordHashes()
        for batch in batches:
            good = np.isin(batch.column("doc_id").fill_null(0).to_numpy(), shared.value) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for side in (0, 1):
                texts = [t for t, g in zip(texts_of(batch), good) if g == side]
                for text in texts:
                    np.add.at(counts[side], trigram_buckets(text, bits), 1)
                    np.add.at(counts[side], pair_buckets(hashes.of(split_words(text)), bits) + (1 << bits), 1)
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[:, used].sum(axis=0)), pa.array(counts[1, used])],
                                         names=["bucket", "raw", "target"])

    return docs.select("doc_id", "text").mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def _bounded(trusted: DataFrame, bound: int) -> np.ndarray:
    """All trusted ids, or a hashed share of them of about ``bound``."""
    ids = trusted.where("doc_id is not null").select("doc_id").distinct()
    share = min(1.0, bound / max(1, ids.count()))
    return ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).toArrow()["doc_id"].to_numpy()


def ratio_weights(target: np.ndarray, raw: np.ndarray, bits: int, prior: float = PRIOR) -> np.ndarray:
    """log(target share / raw share) of each bucket, in millionths; 0 if either side has no n-gram.

    The target's counts start from ``prior`` n-grams spread like the raw ones, so that without evidence the ratio is 0.
    """
    out = np.zeros(2 << bits, np.int64)
    for part in (slice(0, 1 << bits), slice(1 << bits, 2 << bits)):
        t, r = target[part], raw[part]
        if t.sum() and r.sum():
            share = r / r.sum()
            used = r > 0
            ratio = (t[used] + prior * share[used]) / (t.sum() + prior) / share[used]
            out[part][used] = np.rint(np.log(ratio) * UNIT).astype(np.int64)
    return out


def base_counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    letters = text.translate(None, BLANKS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    keys = window_hashes(hashes, 3, 0x9E3779B97F4A7C15)
    order = np.argsort(keys, kind="stable")
    equal = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(keys), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(keys)] |= again
    return (len(words), len(letters.decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), int(covered.sum()))


SCORED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio long"


def score(docs: DataFrame, weights: np.ndarray, bits: int = BUCKET_BITS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Base counts and the ratio (millionths) of each document, row by row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.select("doc_id", "text", *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table_ = WordHashes(), shared.value
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                words = split_words(text)
                codes = hashes.of(words)
                tri, pairs = trigram_buckets(text, bits), pair_buckets(codes, bits)
                ratio = 0
                if len(tri):
                    ratio += int(table_[tri].sum()) // len(tri)
                if len(pairs):
                    ratio += int(table_[pairs + (1 << bits)].sum()) // len(pairs)
                rows.append((*base_counts(text, words, codes), ratio))
            columns = np.array(rows, np.int64).reshape(-1, 6)
            out = [batch.column("doc_id"), *(pa.array(columns[:, i]) for i in range(6))]
            names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio"]
            yield pa.RecordBatch.from_arrays(out + [batch.column(c) for c in carry], names=names + list(carry))

    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[2:])
    return kept.mapInArrow(run, SCORED + extra)


def quality(docs: DataFrame, trusted: DataFrame, bits: int = BUCKET_BITS, threshold: float = THRESHOLD,
            trusted_rows: int = TRUSTED_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Base counts, ``ratio``, ``base_failed`` and ``kept`` of every document.

    ``trusted`` has the ids of the target's documents in ``doc_id``, of which ``trusted_rows`` are used at most; ``carry`` names columns
    of ``docs`` to pass on (``text`` may be one of them, under another name).
    """
    plain = document_columns(docs)
    got = ngram_counts(plain, _bounded(trusted, trusted_rows), bits).toArrow()
    raw, target = np.zeros(2 << bits, np.int64), np.zeros(2 << bits, np.int64)
    raw[got["bucket"].to_numpy()], target[got["bucket"].to_numpy()] = got["raw"].to_numpy(), got["target"].to_numpy()
    weights = ratio_weights(target, raw, bits)
    rows = plain if not carry else docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (score(rows, weights, bits, carry).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= int(threshold * UNIT))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")))
