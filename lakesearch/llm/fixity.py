"""Merkle fixity audit of WARC files.

Each replica lists its records: file, offset, length and SHA-256. Records of one range of
offsets hash into a leaf node, ``fan_out`` neighbouring nodes into their parent, up to one
root per file. Roots of two replicas are compared; below a root that differs only the
nodes that differ are followed, and only the records of the ranges reached are compared.

A range holds a bounded number of offsets, and a node a bounded number of children, so a
file with a third of all records is hashed by many tasks.

Defined cases: a null file counts as '' and a null offset as -1; null content is a record of
length 0 with the hash of nothing; several records at one offset count as one entry, whose hash covers
their sorted hashes and multiplicities, so equal rows in another number are a change; an
empty replica is missing everything; two empty replicas give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.llm.common import running_sum, table
from lakesearch.session import staged

RANGE_BYTES = 1 << 16
FAN_OUT = 16
PAGES_PER_FILE = 1000


def record_digest(content: Column) -> Column:
    return F.sha2(F.coalesce(content, F.lit("")), 256)


def entries(records: DataFrame) -> DataFrame:
    """(file, offset, length, digest): one row for each offset of a replica's record list."""
    alike = (records.select(F.coalesce("file", F.lit("")).alias("file"),
                            F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("offset"),
                            F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"),
                            F.coalesce("digest", record_digest(F.lit(None).cast("string"))).alias("digest"))
             .groupBy("file", "offset", "length", "digest").agg(F.count(F.lit(1)).alias("n")))
    listed = F.array_sort(F.collect_list(F.concat_ws(":", "digest", "length", "n")))
    return alike.groupBy("file", "offset").agg(
        F.max("length").alias("length"), F.sum("n").alias("n"), F.max("digest").alias("only"), listed.alias("listed")).select(
        "file", "offset", "length", F.when(F.col("n") == 1, F.col("only")).otherwise(F.sha2(F.array_join("listed", ","), 256)).alias("digest"))


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(children)), lambda c: F.concat_ws(":", c.at, c.digest)), ","), 256)


def leaf_nodes(found: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, node, digest) of the lowest level, from ``entries``."""
    of = F.struct(F.col("offset").alias("at"), F.concat_ws("+", "length", "digest").alias("digest"))
    return found.groupBy("file", F.floor(F.col("offset") / range_bytes).cast("long").alias("node")).agg(_node(of).alias("digest"))


def parent_nodes(level: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    of = F.struct(F.col("node").alias("at"), "digest")
    return level.groupBy("file", F.floor(F.col("node") / fan_out).cast("long").alias("node")).agg(_node(of).alias("digest"))


def tree(found: DataFrame, depth: int, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels from the leaves up, each written once."""
    levels = [staged(leaf_nodes(found, range_bytes), "nodes")]
    while len(levels) <= depth:
        levels.append(staged(parent_nodes(levels[-1], fan_out), "nodes"))
    return levels


def _depth(sides: list[DataFrame], range_bytes: int, fan_out: int) -> int:
    """Levels above the leaves until one node covers the largest offset, and one more for a negative offset."""
    last = max(int(side.agg(F.max("offset")).first()[0] or 0) for side in sides)
    depth, nodes = 1, last // range_bytes + 1
    while nodes > 1:
        nodes, depth = -(-nodes // fan_out), depth + 1
    return depth


def _differing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return (left.alias("l").join(right.alias("r"), keys, "full")
            .where(~F.col("l.digest").eqNullSafe(F.col("r.digest"))))


def audit(left: DataFrame, right: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """(file, offset, kind, left_length, right_length, left_digest, right_digest) of each record that differs.

    ``left`` and ``right`` have (file, offset, length, digest); kind is changed, missing (not
    in ``right``) or extra (not in ``left``).
    """
    sides = [staged(entries(side), "entries") for side in (left, right)]
    depth = _depth(sides, range_bytes, fan_out)
    trees = [tree(side, depth, range_bytes, fan_out) for side in sides]
    bad = staged(_differing(trees[0][depth], trees[1][depth], ["file", "node"]).select("file", "node"), "differing")
    for level in range(depth - 1, -1, -1):
        parent = F.floor(F.col("node") / fan_out).cast("long")
        below = [t[level].withColumn("parent", parent).join(bad.withColumnRenamed("node", "parent"), ["file", "parent"], "left_semi")
                 for t in trees]
        bad = staged(_differing(*below, ["file", "node"]).select("file", "node"), "differing")
    reached = [side.withColumn("node", F.floor(F.col("offset") / range_bytes).cast("long"))
               .join(bad, ["file", "node"], "left_semi") for side in sides]
    return _differing(*reached, ["file", "offset"]).select(
        "file", "offset",
        F.when(F.col("r.digest").isNull(), "missing").when(F.col("l.digest").isNull(), "extra").otherwise("changed").alias("kind"),
        F.col("l.length").alias("left_length"), F.col("r.length").alias("right_length"),
        F.col("l.digest").alias("left_digest"), F.col("r.digest").alias("right_digest"))


def warc_record(url: Column, html: Column, record: Column) -> Column:
    """A response record, as text: header, payload, two line ends."""
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(record.cast("string"), F.lit("")), F.lit(">\r\nContent-Length: "), F.octet_length(html).cast("string"),
                    F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))


def op1_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the pages' WARC files against a replica in which some records are damaged:
    a flipped first character, half of the payload lost, or the record gone."""
    page, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    flipped = F.concat(F.when(F.left(html, F.lit(1)) == "X", "Y").otherwise("X"), F.substring(html, 2, 2**31 - 1))
    copy = (F.when(page % 89 == 7, flipped).when(page % 131 == 11, F.left(html, F.expr("cast(length(coalesce(html, '')) div 2 as int)")))
            .otherwise(html))
    first, second = warc_record(F.col("url"), html, page), warc_record(F.col("url"), copy, page)
    listed = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("crawl-"), F.expr(f"page_id div {PAGES_PER_FILE}").cast("string"), F.lit(".warc")).alias("file"),
        F.octet_length(first).cast("long").alias("length"), record_digest(first).alias("digest"),
        F.octet_length(second).cast("long").alias("copy_length"), record_digest(second).alias("copy_digest"))
    placed = staged(running_sum(staged(listed, "records"), ["file"], ["page_id", "digest"], "length", "offset"), "placed")
    left = placed.select("file", "offset", "length", "digest")
    right = placed.where(~F.coalesce(page % 211 == 13, F.lit(False))).select(
        "file", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest"))
    names = placed.groupBy(F.coalesce("file", F.lit("")).alias("file"), "offset").agg(F.min("page_id").alias("page_id"))
    return audit(left, right).join(names, ["file", "offset"], "left")


SQL = rf"""
with pg as (select page_id, 'crawl-' || (page_id // {PAGES_PER_FILE}) || '.warc' as file, coalesce(url, '') as u, coalesce(html, '') as h,
    case when page_id % 89 = 7 then (case when left(h, 1) = 'X' then 'Y' else 'X' end) || substr(h, 2)
         when page_id % 131 = 11 then left(h, length(h) // 2) else h end as c,
    'WARC/1.0' || e'\r\n' || 'WARC-Type: response' || e'\r\n' || 'WARC-Target-URI: ' || u || e'\r\n'
      || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e'\r\n' || 'Content-Length: ' as head from pages),
r as (select page_id, file, head || strlen(h) || e'\r\n\r\n' || h || e'\r\n\r\n' as a,
    head || strlen(c) || e'\r\n\r\n' || c || e'\r\n\r\n' as b from pg),
o as (select *, coalesce(sum(strlen(a)) over (partition by file order by page_id rows between unbounded preceding and 1 preceding), 0)::bigint as "offset" from r)
select file, "offset", page_id, case when page_id % 211 = 13 then 'missing' else 'changed' end as kind,
  strlen(a)::bigint as left_length, case when page_id % 211 <> 13 then strlen(b) end::bigint as right_length,
  sha256(a) as left_digest, case when page_id % 211 <> 13 then sha256(b) end as right_digest
from o where page_id % 211 = 13 or a <> b"""
