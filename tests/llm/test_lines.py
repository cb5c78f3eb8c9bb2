"""op12: line dedup through cuckoo filters against its DuckDB SQL, and reversible by deletion."""

import duckdb
import numpy as np

from lakesearch.llm import line_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key string, lines long, shard int"
LONG = "A line that is long enough to count"


def oracle(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    return sorted(con.execute(line_dedup.SQL).fetchall(), key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in frame.collect()), key=repr)


def test_fixture_with_odd_rows_matches_sql(spark):
    rows = [(1, f"{LONG}\nown line one\n  {LONG.upper()} \t", "x", 1, 1), (2, f"{LONG}\n{LONG}", None, None, None), (2, f"{LONG}\n{LONG}", None, None, None),
            (3, f"x\n\n{LONG}\r", "y", 2, 2), (None, LONG, None, None, None), (5, None, None, None, None), (6, "", None, None, None),
            (7, "short line\nshort line\nshort line", None, None, None), (8, "é" * 20 + "\n" + "é" * 19, None, None, None),
            (9, "é" * 20 + "\n" + "ÉÉ", None, None, None), (10, "é" * 20 + "\n" + "z" * 100000, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(line_dedup.dedup_lines(frame)) == oracle(rows)
    assert line_dedup.dedup_lines(frame.limit(0)).count() == 0


def test_whole_small_table_matches_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = oracle(rows)
    assert got(line_dedup.op12_lines(spark, SF)) == want and sum(r[2] for r in want) > 0


def test_delete_undoes_insert_and_filters_hold_every_frequent_key(spark):
    base = [(i, f"{LONG} {i % 4}\nline {i} of its own, long enough", None, None, None) for i in range(40)]
    more = [(100 + i, f"{LONG} {i % 2}\n{LONG} new {i % 3}", None, None, None) for i in range(30)]
    first, extra = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(more, SCHEMA)
    alone = line_dedup.LineIndex.build(first, shards=3)
    grown = alone.insert(extra)
    back = grown.delete(extra)
    assert got(back.dedup(first)) == got(alone.dedup(first)) == oracle(base)
    assert got(grown.dedup(first.unionByName(extra))) == oracle(base + more)
    for index in (alone, grown, back):
        frequent = index.frequent.collect()
        assert sorted(map(tuple, frequent)) == sorted(map(tuple, line_dedup._frequent(index.refs, 3).collect()))
        filters = {r.shard: line_dedup.Cuckoo(r.buckets, np.frombuffer(r.slots, np.uint16)) for r in index.filters.collect()}
        for r in frequent:
            assert filters[r.key_hash % 3].contains(np.array([r.key_hash], np.int64))[0]
    assert sorted(map(tuple, back.refs.collect())) == sorted(map(tuple, alone.refs.collect()))


def test_cuckoo_filter_inserts_deletes_and_grows():
    rng = np.random.default_rng(5)
    keys = rng.integers(-2**63, 2**63 - 1, 5000, dtype=np.int64)
    cuckoo = line_dedup.Cuckoo(line_dedup.Cuckoo.size_for(5000))
    assert cuckoo.insert(keys) and cuckoo.contains(keys).all()
    cuckoo.delete(keys[:2500])
    assert cuckoo.contains(keys[2500:]).all() and cuckoo.contains(keys[:2500]).mean() < 0.01
    assert not line_dedup.Cuckoo(1).insert(keys[:100])
