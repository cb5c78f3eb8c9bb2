import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lakesearch.llm import bpe, quality, toxicity
from tests.llm import brute
from tests.llm.test_dedup import SCHEMA, with_clashes

ODD = [None, "", " ", "\n\n  \t", "a", "it's  O'Neil we'll", "日本語 テスト", "é" * 900, " " * 700, "x" * 5000, "1234567 89", "!!!??? a\x1cb\x85c　d",
       "naïve café\r\nline", "🙂🙃 emoji", "<|endoftext|>", " para"]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.multi_vocabulary()


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}).encode_ordinary


def test_encoding_is_that_of_the_tokenizer(spark, vocabulary, reference):
    docs = [(i, t) for i, t in enumerate(ODD * 2)] + [(None, "no id")]
    rows = bpe.decode(bpe.encode(with_clashes(spark.createDataFrame(docs, SCHEMA)), vocabulary), vocabulary).withColumn("list", bpe.ids_array(bpe.F.col("ids"))).collect()
    texts = dict(docs)
    assert len(rows) == len(docs)
    for r in rows:
        want = reference(texts[r.doc_id] or "")
        assert r.list == want and r.ids == ",".join(map(str, want))
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()


def test_digests(spark, vocabulary, reference):
    rows = bpe.digests(bpe.encode(spark.createDataFrame(list(enumerate(ODD)), SCHEMA), vocabulary, decoded=True)).collect()
    for r in rows:
        ids = reference(ODD[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(ODD[r.doc_id] or "")
    assert bpe.encode(spark.createDataFrame([], SCHEMA), vocabulary).collect() == []


def test_native_form_gives_the_same(spark, vocabulary, reference):
    docs = spark.createDataFrame([(i, t if t is None else t[:60]) for i, t in enumerate(ODD)], SCHEMA)
    rows = bpe.encode_native(docs, vocabulary).withColumn("decoded", bpe.decode_native(bpe.F.col("ids"), vocabulary)).collect()
    for r in rows:
        text = (ODD[r.doc_id] or "")[:60]
        assert r.ids == ",".join(map(str, reference(text))) and bytes(r.decoded) == text.encode()


def test_merges_agree(vocabulary, reference):
    import regex
    rng, cut = random.Random(4), regex.compile(vocabulary.in_python()).findall
    for _ in range(400):
        text = "".join(rng.choices("abeth éß日 \t1\x1c　!", k=rng.randint(1, 150)))
        for merge in (bpe.merge_short, bpe.merge_with_heap):
            got = [i for p in cut(text) for i in ([vocabulary.ranks[p.encode()]] if p.encode() in vocabulary.ranks else merge(p.encode(), vocabulary.ranks))]
            assert got == reference(text)


def quality_docs():
    rng = random.Random(2)
    good = ["the", "river", "house", "walks", "slowly", "under", "old", "trees", "and", "sings", "with", "many", "birds", "today"]
    out = []
    for i in range(120):
        out.append((i, "\n".join(" ".join(rng.choices(good, k=20)) for _ in range(4))))
    for i in range(120, 150):
        out.append((i, " ".join(rng.choice(good) + rng.choice(["***", "%%%", "|||"]) for _ in range(90))))
    return out + [(200, None), (201, ""), (202, "few words only"), (203, "again and again " * 60), (204, "dup line here\n" * 30 + " \n"), (None, "x " * 80)]


def test_quality_counts_and_verdicts(spark):
    docs = quality_docs()
    texts = {d: t for d, t in docs}
    trusted = spark.createDataFrame([(i,) for i in range(80)] + [(None,)], "doc_id long")
    rows = quality.quality(with_clashes(spark.createDataFrame(docs + docs[:2], SCHEMA)), trusted).collect()
    assert len(rows) == len(docs) + 2
    for r in rows:
        counts = brute.base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
    kept = {r.doc_id for r in rows if r.kept}
    assert kept == set(range(120))


def test_quality_without_trusted_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long")
    docs = quality_docs()
    rows = quality.quality(spark.createDataFrame(docs, SCHEMA), none).collect()
    assert all(r.kept == (not r.base_failed) and r.ratio == 0 for r in rows)
    assert quality.quality(spark.createDataFrame([], SCHEMA), none).collect() == []


def test_quality_carries_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "kept", 5)], "doc_id long, text string, n_words string, ratio int")
    from pyspark.sql import functions as F
    rows = quality.quality(docs.select("doc_id", "text", F.struct("*").alias("row")), spark.createDataFrame([], "doc_id long"), carry=("row",)).select("row.*").collect()
    assert [tuple(r) for r in rows] == [(1, "a b", "kept", 5)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(old[j] + (x != y), old[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    rng = random.Random(1)
    terms = ["idiot", "pathetic", "loser", "worthless", "scum"]
    lexicon = toxicity.Lexicon(dict.fromkeys(terms, 3.0), {"lowei": 2.0})
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "e", "t"])
        word = "".join(word)
        want = "word" if word in terms else "fuzzy" if any(len(t) >= 5 and distance(t, word) <= 1 for t in terms) else None
        assert (lexicon.hit(word) or (None,))[0] == want, word
    assert lexicon.hit("loweixyz") == ("stem", 2.0)


def test_context_tells_quotation_from_abuse():
    assert toxicity.context('he said "you idiot" to them'.split(), 3) == (True, False)
    assert toxicity.context("you are an idiot really".split(), 3) == (False, True)
    assert toxicity.context("an idiot".split(), 1) == (False, False)


def toxic_docs(n=400):
    rng = random.Random(9)
    plain = ["river", "house", "walks", "slowly", "under", "trees", "sings", "birds", "today", "meadow", "stone"]
    bad = ["idiot", "moron", "worthless", "pathetic"]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(plain, k=rng.randint(5, 60))
        toxic = i % 5 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(["", ".", "!"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_learns_and_catches_misspellings(spark):
    docs, labels = toxic_docs()
    more = [(1000, "river idiiot stone"), (1001, "such a morron walks"), (1002, None), (1003, ""), (1004, "river stone birds"), (None, "worthless")]
    frame = with_clashes(spark.createDataFrame(docs + more, SCHEMA))
    known = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    learnable = toxicity.training_labels(known)
    got = {r.doc_id: r for r in toxicity.toxicity(frame, learnable).collect()}
    wrong = [i for i, toxic in labels if got[i].predicted != toxic]
    assert len(wrong) <= 2
    assert got[1000].predicted == 1 and got[1001].predicted == 1 and got[None].predicted == 1
    assert got[1002].score == got[1003].score == got[1004].score < 0.3


def test_misspellings_of_every_word_are_searched(spark):
    rng = random.Random(3)
    bad = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(100)]
    rows = [(f"{rng.choice(['river', 'house'])} {bad[i % 100]} t{i}", 1) for i in range(400)] + [(f"river house stone c{i}", 0) for i in range(1600)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(bad) <= lexicon.words.keys()
    assert {lexicon.hit(w[:4] + w[5:])[0] for w in bad} == {lexicon.hit(w + "x")[0] for w in bad} == {"fuzzy"}


def test_rare_toxic_terms_are_learnt_among_many_common_ones(spark):
    common = " ".join("w%05d" % i for i in range(17000))
    rows = [(f"{common} {'worthless' if i else 'river'} t{i}", 1) for i in range(4)] + [(f"{common} c{i}", 0) for i in range(30)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert lexicon.hit("worthless")


def test_toxicity_without_labels_or_documents(spark):
    docs, _ = toxic_docs(10)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(spark.createDataFrame(docs, SCHEMA), none).collect()} == {0}
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(spark.createDataFrame(docs, SCHEMA), ones).collect()} == {1}
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), ones).collect() == []


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in toxicity.op7_toxicity(spark, sf).collect()]
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    hits = Counter((labels[r.doc_id], r.predicted) for r in held)
    assert hits[1, 1] > 0.8 * (hits[1, 0] + hits[1, 1]) and hits[0, 1] < 0.03 * (hits[0, 0] + hits[0, 1])
