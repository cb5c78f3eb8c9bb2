"""Run registered queries beside their DuckDB oracles and report differences.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

KINDS = {"tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "bigint",
         "hugeint": "hugeint", "varchar": "string", "string": "string", "boolean": "boolean",
         "double": "double", "float": "float", "timestamp": "timestamp"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in records]
    return sorted(rows, key=repr)


def compare(spark, con, sf_dir, query, sql):
    """(ok, message) for one query."""
    started = time.time()
    df = query(spark, sf_dir)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    took = f"spark {time.time() - started:.1f}s,"
    if sql is None:
        return True, f"{took} {len(got)} rows, no oracle"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = _rows(rel.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = {n: KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for n, d in zip(names, rel.description)}
    odd = [f"{f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}" for f in df.schema.fields
           if KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) != kinds[f.name]]
    if odd:
        return False, "types " + "; ".join(odd)
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 50000 else []
        return False, f"rows {len(got)} vs {len(want)} extra {extra}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, first:\n   spark  {bad[0][0]}\n   oracle {bad[0][1]}"
    return bool(got), f"{took} {len(got)} rows"


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from lakesearch.session import build_session

    sf_dir, names = argv[0], argv[1:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    todo, oracles, failed = queries(), oracle_sql(), []
    picked = [n for n in todo if not names or n in names or any(x.endswith("*") and n.startswith(x[:-1]) for x in names)]
    for name in picked:
        started = time.time()
        try:
            ok, message = compare(spark, con, sf_dir, todo[name], oracles.get(name))
        except Exception as error:  # report and go on with the next query
            ok, message = False, "".join(traceback.format_exception_only(error))[:1500]
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - started:6.2f}s {message}", flush=True)
    print(f"{len(picked) - len(failed)}/{len(picked)} ok; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
