"""op13: periodic runs by block convolution against a search of every period."""

import random
import zlib

import numpy as np
import pytest

from lakesearch.llm import periodic_runs
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain_row(doc_id, text):
    words = periodic_runs.planted(brute.words(text), doc_id)
    ids = [{w: i for i, w in enumerate(dict.fromkeys(words))}[w] for w in words]
    runs = brute.runs_of(ids)
    keep = [True] * len(words)
    for s, length, q in runs:
        for i in range(s + q, s + length):
            keep[i] = False
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    if best:
        ties = [r for r in runs if r[1] * best[2] == best[1] * r[2]]
        best = min(ties, key=lambda r: (r[0], r[2]))
    return (doc_id, len(words), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            brute.sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), brute.sha(b" ".join(w for w, k in zip(words, keep) if k)))


def got_rows(frame):
    return sorted((tuple(r) for r in periodic_runs.periodic_runs(frame).collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_every_period(seed):
    rng = random.Random(seed)
    for _ in range(40):
        n = rng.randint(0, 300)
        alphabet = rng.choice([2, 3, 5, 50])
        ids = [rng.randrange(alphabet) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 10:
                a, p = rng.randrange(n), rng.randint(1, 40)
                for i in range(a, min(n, a + p * rng.randint(2, 8))):
                    ids[i] = ids[a + (i - a) % p]
        assert periodic_runs.find_runs(np.array(ids, np.int64)) == brute.runs_of(ids)


def test_documents_together_find_what_each_finds_alone():
    rng = random.Random(11)
    docs = []
    for _ in range(60):
        n = rng.randint(0, 400)
        ids = [rng.randrange(rng.choice([2, 4, 30])) for _ in range(n)]
        if n > 20:
            a, p = rng.randrange(n // 2), rng.randint(1, 30)
            for i in range(a, n):
                ids[i] = ids[a + (i - a) % p]
        docs.append(np.array(ids, np.int64))
    together = periodic_runs.find_runs_many(docs)
    assert together == [brute.runs_of(d.tolist()) for d in docs]


def test_rows_with_odd_cases_match_plain_version(spark):
    planted_id = next(i for i in range(10000) if zlib.crc32(str(i).encode()) % 10 == 0 and (zlib.crc32(str(i).encode()) // 10) % 8 >= 2
                      and (zlib.crc32(str(i).encode()) // 10) % 500 < 300)
    text = " ".join(f"w{i % 7}" if 30 <= i < 90 else f"u{i}" for i in range(200))
    rows = [(1, text, "x"), (1, text, "x"), (planted_id, " ".join(f"v{i}" for i in range(500)), None), (None, "a a a a a a a", "y"),
            (4, None, None), (5, "", None), (6, "one", None), (7, "z " * 30000, None), (8, "é\té\né é é é b", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    want = sorted((plain_row(d, t) for d, t, _ in rows if d != 7), key=repr)
    got = got_rows(frame)
    assert [r for r in got if r[0] != 7] == want
    (long_row,) = [r for r in got if r[0] == 7]
    assert long_row[2:6] == (1, 0, 30000, 1)
    assert [r for r in want if r[0] == planted_id][0][2] >= 1
    assert got_rows(frame.limit(0)) == []


def test_whole_small_table_matches_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(brute.words(r.text)) <= 3000]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_rows(frame) == sorted((plain_row(d, t) for d, t in rows), key=repr)
