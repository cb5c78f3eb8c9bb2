"""Spelling variant grouping by PartEnum signatures.

A word is seen as the multiset of its letters, written as a binary vector with one
dimension per (letter, k): the word holds letter at least k times. One inserted or deleted
letter changes one dimension, one replaced letter two, so words one edit apart are at
Hamming distance two or less. PartEnum (partition and enumerate) turns that bound into
exact equality: the dimensions are hashed into ``PARTS`` parts, and a word gets one
signature for each choice of ``PARTS - 2`` parts, the hash of its projection on them. Two
vectors that differ in at most two dimensions differ in at most two parts and so agree on
the projection that leaves those two out: every near pair shares a signature, and words
are paired by an equi-join on signatures only. Candidates are then verified by edit
distance, so a shared signature of words far apart costs time, never a wrong link.

Letter multisets alone group poorly where words are made of a few common syllables: on the
check tables one signature of six parts held 5,395 words, and the pairs within groups came
to 904 million for 374,482 words. So each signature is also keyed by where the edit cannot
be: two words of at least ``MIN_LENGTH`` (m) code points one edit apart have equal first
``h = (m - 1) // 2`` code points (the edit is at h or later) or equal last ``m - h`` (it is
before h, and at least m - h code points follow it in both). A word has one signature with
its prefix and one with its suffix for each choice of parts, and a near pair shares one of
them; with ``PARTS`` 4 that is 12 rows a word, and 126 million pairs within groups there.

All of it is column code over the vocabulary (one row per distinct word): the letters of a
word are numbered by higher-order functions, the signatures are one array per word.

Defined cases: a null text has no runs; a null ``doc_id`` hashes as empty text, so its runs
are hashed as ``:<run>``; equal rows count their runs once for each row; words of fewer
than ``MIN_LENGTH`` code points, or seen fewer than ``MIN_COUNT`` times, are not words; a
word without near words has ``n_near`` 0, no form, and is its own root; an empty table
gives an empty result; other columns of the documents are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.llm.common import document_columns, table
from lakesearch.session import staged

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_FACTOR = 10

#: Parts of the letter dimensions; each word has 2 * C(PARTS, 2) signatures.
PARTS = 4


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every run of letters, A-Z lower-cased, with the contract's deletion applied."""
    found = document_columns(docs).select(
        "doc_id", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({RUN})"), 1)).alias("raw"))
    lowered = found.select("doc_id", F.translate("raw", UPPER, LOWER).alias("run"))
    seed = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    seeded = lowered.withColumn("seed", seed)
    at = F.pmod(F.col("seed"), F.char_length("run").cast("long")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.lit(1 << 30)))
    return seeded.select("doc_id", F.when(F.col("seed") % DROP_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of ``min_length`` code points or more, seen ``min_count`` times or more."""
    return (runs(docs).where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def letter_dimensions(letters: Column) -> Column:
    """Sorted array of ``letter#k`` from the sorted letters: the k-th copy of each letter, k from 1."""
    return F.transform(letters, lambda c, i: F.concat(c, F.lit("#"), (i - F.array_position(letters, c) + 2).cast("string")))


def _in_part(part: int, parts: int):
    return lambda d: F.pmod(F.xxhash64(d), F.lit(parts)) == part


def _ends(word: Column, min_length: int) -> list[Column]:
    """The two position keys of a word: its first ``(m - 1) // 2`` and its last ``m - that`` code points."""
    head = (min_length - 1) // 2
    return [F.concat(F.lit("<"), F.substring(word, 1, head)), F.concat(F.lit(">"), F.substring(word, -(min_length - head), min_length - head))]


def signed(words: DataFrame, parts: int = PARTS, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n, length, signature): 2 * C(parts, 2) rows a word, hashes of its projections on
    all but two parts, each with the word's prefix and with its suffix.

    Each step is its own projection, so that the letters, the dimensions and the parts are
    computed once a word and not again inside every signature.
    """
    letters = words.select("word", "n", F.char_length("word").alias("length"),
                           F.array_sort(F.regexp_extract_all("word", F.lit("(.)"), 1)).alias("letters"))
    dims = letters.select("word", "n", "length", letter_dimensions(F.col("letters")).alias("dims"))
    projected = dims.select("word", "n", "length", *[F.array_join(F.filter("dims", _in_part(p, parts)), "\u0001").alias(f"p{p}")
                                                     for p in range(parts)])
    ends = projected.select("*", F.explode(F.array(*_ends(F.col("word"), min_length))).alias("end"))
    signatures = [F.xxhash64(F.lit(number), F.col("end"), *[F.col(f"p{p}") for p in range(parts) if p not in left_out])
                  for number, left_out in enumerate(combinations(range(parts), 2))]
    return ends.select("word", "n", "length", F.explode(F.array(*signatures)).alias("signature"))


def signatures(word: Column, parts: int = PARTS, min_length: int = MIN_LENGTH) -> Column:
    """The signatures of one word column, as an array (for tests and single lookups)."""
    dims = letter_dimensions(F.array_sort(F.regexp_extract_all(word, F.lit("(.)"), 1)))
    projections = [F.array_join(F.filter(dims, _in_part(p, parts)), "\u0001") for p in range(parts)]
    return F.array(*[F.xxhash64(F.lit(number), end, *[projections[p] for p in range(parts) if p not in left_out])
                     for end in _ends(word, min_length)
                     for number, left_out in enumerate(combinations(range(parts), 2))])


def near_pairs(words: DataFrame, parts: int = PARTS, min_length: int = MIN_LENGTH) -> DataFrame:
    """(left, right, left_n, right_n), left < right: pairs of words one edit apart, each once."""
    sig = staged(signed(words, parts, min_length), "spelling-signatures")
    left, right = sig.alias("l"), sig.alias("r")
    joined = left.join(right, (F.col("l.signature") == F.col("r.signature")) & (F.col("l.word") < F.col("r.word"))
                       & (F.abs(F.col("l.length") - F.col("r.length")) <= 1))
    candidates = joined.select(F.col("l.word").alias("left"), F.col("r.word").alias("right"),
                               F.col("l.n").alias("left_n"), F.col("r.n").alias("right_n")).distinct()
    return candidates.where(F.levenshtein("left", "right", 1) == 1)


def forms(words: DataFrame, pairs: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest n (ties: least word) if ``factor`` times as frequent."""
    both = pairs.select(F.col("left").alias("word"), F.col("right").alias("other"), F.col("right_n").alias("other_n")).unionByName(
        pairs.select(F.col("right").alias("word"), F.col("left").alias("other"), F.col("left_n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other"))).alias("best"))
    joined = words.join(best, "word", "left")
    is_form = F.col("best").isNotNull() & (-F.col("best.minus_n") >= F.lit(factor) * F.col("n"))
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(is_form, F.col("best.other")).alias("form"),
                         F.when(is_form, -F.col("best.minus_n")).cast("long").alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """Add ``root`` by pointer doubling over forms.

    Each form is ``FORM_FACTOR`` times as frequent as its word, so chains are at most the
    logarithm of the largest count long, and doubling ends after the logarithm of that.
    """
    step = staged(formed.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        ahead = step.alias("a").join(step.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            F.col("a.word"), F.coalesce(F.col("b.root"), F.col("a.root")).alias("root"), (F.col("b.root") != F.col("a.root")).alias("moved"))
        ahead = staged(ahead, "spelling-roots")
        if not ahead.where("moved").limit(1).count():
            break
        step = ahead.drop("moved")
    return formed.join(ahead.drop("moved"), "word")


def spelling_variants(docs: DataFrame, parts: int = PARTS) -> DataFrame:
    """word, form, root (string); n, n_near, form_n (long): one row per word of the vocabulary."""
    words = staged(vocabulary(docs), "spelling-words")
    pairs = staged(near_pairs(words, parts), "spelling-pairs")
    return roots(forms(words, pairs)).select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
