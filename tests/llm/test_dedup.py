import random
from collections import Counter

import numpy as np
import pytest

from lakesearch.llm import near_dedup, sketch, suffix_dedup, window_dedup
from lakesearch.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def with_clashes(df):
    """Columns that the operators use themselves."""
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("x").alias(c) for c in ("chunk", "block", "kind", "cls", "bucket", "n", "size", "rank", "source", "rep", "label")])


def passages(seed, n=60, hot=0):
    """Random texts that share passages, near copies and exact copies."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["é", "日本", "x" * 30]
    common = " ".join(rng.choices(vocabulary, k=45))
    base = rng.choices(vocabulary, k=120)
    out = []
    for i in range(n):
        kind = i % 6
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 160)))
        if kind == 1:
            text = text + "\n" + common + "\t" + text[:40]
        elif kind in (2, 3):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            text = " ".join(w)
        elif kind == 4:
            text = " ".join(base[:70]) + "  " + common
        out.append((i * 3 + 1, text))
    for i in range(hot):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "e%d" % rng.randrange(10**6)
        out.append((10_000 + i, " ".join(w)))
    return out + [(5000, ""), (5001, None), (5002, "one two"), (5003, "ONE two"), (5004, " \n\t "), (5005, "a " * 3000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_match_brute_force(spark, seed):
    docs = passages(seed)
    got = window_dedup.window_dedup(with_clashes(spark.createDataFrame(docs, SCHEMA)), chunk_bytes=4000).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute.windows(docs)


def test_windows_of_repeated_and_null_rows(spark):
    text = " ".join("t%d" % i for i in range(30))
    rows = window_dedup.window_dedup(spark.createDataFrame([(None, text), (3, text), (3, text), (None, text), (9, None)], SCHEMA)).collect()
    assert Counter((r.doc_id, r.n_removed) for r in rows) == {(3, 0): 1, (3, 30): 1, (None, 30): 2, (9, 0): 1}
    assert window_dedup.window_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes_match_brute_force(spark, seed):
    docs = passages(seed)
    got = suffix_dedup.suffix_dedup(with_clashes(spark.createDataFrame(docs, SCHEMA)), chunk_bytes=4000).collect()
    assert {r.doc_id: (r.n_bytes, list(zip(r.starts, r.ends)), bytes(r.kept)) for r in got} == brute.suffixes(docs)
    assert all(r.n_removed == sum(b - a for a, b in zip(r.starts, r.ends)) and r.n_spans == len(r.starts) for r in got)


def test_suffixes_with_crowded_hashes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 6)
    docs = passages(3, n=90, hot=40)
    got = suffix_dedup.suffix_dedup(with_clashes(spark.createDataFrame(docs, SCHEMA)), chunk_bytes=4000).collect()
    assert {r.doc_id: (r.n_bytes, list(zip(r.starts, r.ends)), bytes(r.kept)) for r in got} == brute.suffixes(docs)


def test_edges_of_a_shared_passage_do_not_fill_one_part():
    import pyarrow as pa
    import pyarrow.compute
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefghij", k=45))  # shorter than a window: every stretch has own bytes
    letters = lambda: "".join(rng.choices("klmnopqrstuvwxyz", k=60))
    cells = pa.schema([(c.split()[0], {"int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in sketch.CELLS.split(", ")])
    told_schema = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("bits", pa.binary()), ("doc", pa.int64()), ("digest", pa.string())])
    tables = [pa.table({"doc_id": [c * 200 + i for i in range(200)], "text": [letters() + passage + letters() for _ in range(200)]}) for c in range(4)]
    bits, sent = 20, []
    for c, docs in enumerate(tables):
        held = suffix_dedup._Chunk(docs, told_schema.empty_table(), 50)
        sent += [sketch.sketch_rows(held.value, c, bits), sketch.crowd_rows(*held.crowds(4), c, bits)]
    sent = pa.concat_tables(sent).cast(cells)
    by_block = [sent.filter(pa.compute.equal(sent["block"], b)) for b in sent["block"].unique()]
    answers = pa.concat_tables([sketch.merge_block(x, 16) for x in by_block])
    loads = Counter()
    for c, docs in enumerate(tables):
        own = answers.filter(pa.compute.equal(answers["chunk"], c))
        told = pa.table({"kind": pa.array([0] * len(own), pa.int32()), "block": own["block"], "bits": own["bits"],
                         "doc": pa.array([None] * len(own), pa.int64()), "digest": pa.array([None] * len(own), pa.string())})
        *_, part, data = suffix_dedup._Chunk(docs, told, 50).stretches(told, bits, 10)
        loads.update(part.tolist())
    assert sum(loads.values()) > 800 and max(loads.values()) < 60


def test_suffixes_of_repeated_and_null_rows(spark):
    text = "é".join("t%d" % i for i in range(40))
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (None, text), (9, None)], SCHEMA)
    rows = suffix_dedup.suffix_dedup(docs, as_text=True).collect()
    assert Counter((r.doc_id, r.n_removed > 0, r.kept == text) for r in rows) == {(3, False, True): 2, (None, True, False): 2, (9, False, False): 1}
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cut_characters_are_dropped(spark):
    shared = "日" * 17  # 51 bytes
    rows = suffix_dedup.suffix_dedup(spark.createDataFrame([(1, "a" + shared), (2, "b" + "日" * 17 + "本")], SCHEMA), as_text=True).collect()
    assert {r.doc_id: r.kept for r in rows} == {1: "a" + shared, 2: "b本"}


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh", bytes(range(256))])
def test_deep_shallow_order(alphabet):
    rng = random.Random(len(alphabet))
    block = bytes(rng.choices(alphabet, k=300))
    data = b"".join(block[rng.randrange(250):][:rng.randint(1, 60)] + bytes(rng.choices(alphabet, k=3)) for _ in range(120)) + block * 3
    at = np.arange(len(data) - 50 + 1)
    order, new = suffix_dedup.deep_shallow_sort(data, at)
    strings = [data[i:i + 50] for i in order]
    assert strings == sorted(data[i:i + 50] for i in at)
    assert new.tolist() == [True] + [a != b for a, b in zip(strings, strings[1:])]


def test_blind_trie_orders_strings():
    rng = random.Random(5)
    strings = [bytes(rng.choices(b"abc", k=12)) for _ in range(300)]
    trie = suffix_dedup.BlindTrie(strings[0])
    for i, s in enumerate(strings[1:], 1):
        trie.insert(s, i)
    leaves = trie.leaves()
    assert [strings[x[0]] for x in leaves] == sorted(set(strings))
    assert all({strings[i] for i in x} == {strings[x[0]]} for x in leaves) and sum(map(len, leaves)) == 300


def test_sketch_loses_no_repeated_key():
    rng = np.random.default_rng(1)
    pools = [rng.integers(0, 5000, 3000).astype(np.uint64) for _ in range(4)]
    bits, sent = 16, {}
    for chunk, keys in enumerate(pools):
        for row in sketch.sketch_rows(keys, chunk, bits).to_pylist():
            sent.setdefault(row["block"], []).append(row)
    import pyarrow as pa
    told = {}
    for rows in sent.values():
        for row in sketch.merge_block(pa.Table.from_pylist(rows, pa.schema([("block", pa.int32()), ("chunk", pa.int32()), ("cells", pa.binary()), ("twice", pa.binary())]))).to_pylist():
            told.setdefault(row["chunk"], {})[row["block"]] = row["bits"]
    counts = Counter(np.concatenate(pools).tolist())
    for chunk, keys in enumerate(pools):
        maybe = sketch.estimated_repeated(keys, told.get(chunk, {}), bits)
        assert all(m for k, m in zip(keys.tolist(), maybe) if counts[k] > 1)
    alone = [m for chunk, keys in enumerate(pools) for k, m in zip(keys.tolist(), sketch.estimated_repeated(keys, told[chunk], bits)) if counts[k] == 1]
    assert np.mean(alone) < 0.1


@pytest.mark.parametrize("n, top", [(0, 1), (5, 1 << 24), (9000, 1 << 24), (60000, 1 << 17)])
def test_packed_cells_round_trip(n, top):
    cells = np.unique(np.random.default_rng(n).integers(0, top, n))
    assert sketch.unpack(sketch.pack(cells)).tolist() == cells.tolist()


def test_near_components_match_brute_force(spark):
    docs = passages(4, n=90, hot=120)
    got = near_dedup.near_components(with_clashes(spark.createDataFrame(docs, SCHEMA))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_large_buckets_match_brute_force(spark, monkeypatch):
    """The same with buckets and blocks so small that every way of comparing is taken."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 6)
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    monkeypatch.setattr(near_dedup, "STAR_ROWS", 4)
    docs = passages(7, n=60, hot=60)
    got = near_dedup.near_components(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near(docs)


def test_near_rows_without_id_or_with_one_id(spark):
    a, b = " ".join("a%d" % i for i in range(40)), " ".join("b%d" % i for i in range(40))
    rows = near_dedup.near_components(spark.createDataFrame([(None, a), (1, a), (2, a), (2, b), (3, b), (4, "")], SCHEMA)).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in rows) == {
        (None, None, True): 1, (1, 1, True): 1, (2, 1, False): 2, (3, 1, False): 1, (4, 4, True): 1}
    assert near_dedup.near_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    ra, rb, rab = near_dedup.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(ra, rb) == rab).all()
    estimates = []
    for i in range(60):
        x = rng.integers(0, 2**63, 1150).astype(np.uint64)
        r = near_dedup.registers([np.unique(x[:1075]), np.unique(x[75:])])
        estimates.append(near_dedup.likely_similarity(r[:1], r[1:], np.array([1075]), np.array([1075]))[0])
    assert abs(np.mean(estimates) - 1000 / 1150) < 0.02


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1060)] + [(1, 2), (2, 1), (5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 7 for i in range(1000, 1060)) and got[2] == got[1] == 1
