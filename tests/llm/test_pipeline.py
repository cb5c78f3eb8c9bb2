"""``run`` against plain versions of its stages, on the smallest tables."""

import math
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from lakesearch.llm import quality
from lakesearch.llm.bpe import multi_vocabulary
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain_quality(docs, good):
    """Rows that the quality rules keep, from counts in plain dictionaries."""
    import numpy as np
    from lakesearch.llm.words import WordHashes, split_words
    hashes, counts = WordHashes(), [[Counter(), Counter()], [Counter(), Counter()]]

    def grams(text):
        data = text.encode()
        codes = hashes.of(split_words(data))
        return Counter(quality.trigram_buckets(data, 16).tolist()), Counter(quality.pair_buckets(codes, 16).tolist())

    for d, text, _ in docs:
        for part, found in enumerate(grams(text)):
            counts[0][part].update(found)
            if d in good:
                counts[1][part].update(found)
    totals = [[sum(c.values()) for c in side] for side in counts]
    kept = []
    for d, text, source in docs:
        base = brute.base_counts(text)
        if base[0] < 50 or 100 * base[4] > 50 * base[0]:
            continue
        ratio = 0
        for part, found in enumerate(grams(text)):
            weights = {}
            for g in found:
                share = counts[0][part][g] / totals[0][part]
                weights[g] = round(math.log((counts[1][part][g] + quality.PRIOR * share) / (totals[1][part] + quality.PRIOR) / share) * 1e6)
            ratio += sum(weights[g] * n for g, n in found.items()) // max(1, sum(found.values()))
        if ratio >= quality.THRESHOLD * 1e6:
            kept.append((d, text, source))
    return kept


def test_run_matches_plain_stages(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    docs = plain_quality(docs, good)
    groups = brute.near([d[:2] for d in docs], corpus_pipeline.NEAR_PERCENT)
    docs = [d for d in docs if groups[d[0]][1] == d[0]]
    cut = brute.suffixes([d[:2] for d in docs])
    docs = [(d, cut[d][2].decode("utf-8", "ignore"), s) for d, _, s in docs]
    texts = {d: t for d, t, _ in docs}
    ordinary = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=multi_vocabulary().ranks, special_tokens={}).encode_ordinary
    want = Counter()
    for d, _, size, _, taken in brute.mix(docs):
        parts = [texts[d]] * (taken // size if size else 0)
        if size and taken % size:
            parts.append(b" ".join(brute.words(texts[d])[:taken % size]).decode())
        for text in parts:
            ids = ordinary(text)
            want[d, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text)] += 1
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len(got) > 50


def test_stages_keep_the_columns_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, row string"
    text = " ".join("word%d" % (i * 7 % 61) for i in range(80))
    rows = [(1, text, "en", "a", len(text), "x", 1, "r"), (1, text, "en", "a", len(text), "x", 1, "r"), (2, text + " more", None, None, None, None, None, None),
            (None, text.replace("w", "v"), "en", "a", 1, "y", 2, "s"), (4, None, "en", "a", 0, "z", 3, "t"), (5, "", "en", "b", 0, "z", 3, "t")]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "stage")
        assert docs.columns == spark.createDataFrame([], schema).columns
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {1, 2, None}
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {1, None}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count()
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_near_copies_of_four_fifths_go(spark):
    base = ["word%d" % i for i in range(120)]
    copies = [base, base[:50] + ["odd"] + base[51:], base[:30] + ["odd", "even"] + base[32:], base[:60] + ["x%d" % i for i in range(60)], ["own%d" % i for i in range(90)]]
    docs = [(i, " ".join(w)) for i, w in enumerate(copies)]
    docs += [(10, " ".join(base[:20] + ["odd"] + base[21:70] + ["even"] + base[71:]))]
    want = {d for d, (_, first) in brute.near(docs, 80).items() if d == first}
    assert want == {0, 3, 4} and {d for d, (_, first) in brute.near(docs).items() if d == first} != want
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), SF)
    assert {r.doc_id for r in got.collect()} == want


def test_last_stage_returns_ids_and_bytes(spark):
    (row,) = corpus_pipeline.token_ids(spark, spark.createDataFrame([(1, "one two é")], "doc_id long, text string"), SF).collect()
    ids = [int(i) for i in row.ids.split(",")]
    names = {rank: token for token, rank in multi_vocabulary().ranks.items()}
    assert len(ids) == row.n_tokens and b"".join(names[i] for i in ids) == bytes(row.decoded) == "one two é".encode()
    assert brute.sha(row.ids) == row.ids_sha256 and brute.sha(bytes(row.decoded)) == row.decoded_sha256
