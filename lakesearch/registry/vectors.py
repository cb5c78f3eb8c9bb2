"""Vector table queries."""

from pyspark.sql import functions as F

from lakesearch.operators import vectors as V
from lakesearch.operators.changes import parse_name_status
from lakesearch.operators.embedding import embed_gate, sync_record
from lakesearch.plans import sync as S
from lakesearch.registry.chunking import ALL_CHUNKS, chunks, files
from lakesearch.registry.fixtures import cte, fixture
from lakesearch.session import work_path
from lakesearch.sources import files as sources
from lakesearch.sources.vector_table import read_vectors, write_vectors

META = ["id", "namespace", "repo_name", "file_path", "line_start", "content", "live", "commit_sha"]


def _vectors(spark, sf):
    return fixture(spark, sf, "vectors").select(*META, "vec_id", "embedding")


def delete_by_file(spark, sf):
    paths = _vectors(spark, sf).where("vec_id % 9 = 0").select("namespace", "repo_name", "file_path")
    return V.delete_by_file(_vectors(spark, sf), paths).select(*META)


def delete_by_id(spark, sf):
    return V.delete_by_id(_vectors(spark, sf), _vectors(spark, sf).where("vec_id % 4 = 1")).select(*META)


def upsert_by_id(spark, sf):
    """Every third vector comes twice, the second time with other content; ids from another
    namespace are new rows."""
    rows = _vectors(spark, sf)
    again = rows.where("vec_id % 3 = 0")
    incoming = again.withColumn("version", F.lit(1)).unionByName(
        again.withColumns({"version": F.lit(2), "content": F.concat(F.lit("new "), "content")})).unionByName(
        rows.where("vec_id % 5 = 0").withColumns({"version": F.lit(1), "namespace": F.lit("other")}))
    return V.upsert_by_id(rows, incoming, "version").select(*META)


def fetch_by_ids(spark, sf):
    asked = _vectors(spark, sf).where("vec_id % 6 = 2").select(
        F.when(F.col("vec_id") % 5 == 0, "elsewhere").otherwise(F.col("namespace")).alias("namespace"), "id")
    return V.fetch_by_ids(_vectors(spark, sf), asked).select(*META)


def namespace_stats(spark, sf):
    return V.namespace_stats(_vectors(spark, sf))


def list_namespaces(spark, sf):
    return V.list_namespaces(_vectors(spark, sf))


def health_summary(spark, sf):
    return V.health_summary(_vectors(spark, sf))


PART_RECORDS = 100


def archives(spark, sf):
    """Archive documents per repository, commit and part, as (path, content BINARY).

    A part covers ``PART_RECORDS`` vector numbers, so no document grows with its commit.
    """
    rows = _vectors(spark, sf).withColumn("part", F.floor(F.col("vec_id") / PART_RECORDS))
    vector = F.struct("id", F.col("embedding").alias("values"), F.struct(
        "namespace", "repo_name", "file_path", "commit_sha", "content", "line_start", "live").alias("metadata"))
    documents = rows.groupBy("repo_name", "commit_sha", "part").agg(
        F.to_json(F.struct(F.array_sort(F.collect_list(vector), lambda a, b: F.when(a["id"] < b["id"], -1).otherwise(1))
                           .alias("vectors"))).alias("document"))
    path = F.concat_ws("/", F.lit("vectors"), "repo_name", "commit_sha", F.concat(F.lit("archive-"), "part", F.lit(".json")))
    return documents.select(path.alias("path"), F.encode("document", "UTF-8").alias("content"))


def _checksums(blobs):
    """The recorded checksums of parts numbered 3, 13, 23, ... are wrong."""
    wrong = F.col("path").endswith("3.json")
    return blobs.select("path", F.when(wrong, F.sha2(F.concat(F.col("content"), F.lit(b"x")), 256))
                        .otherwise(F.sha2("content", 256)).alias("archive_sha256"))


def verify_checksum(spark, sf):
    """Vectors of each commit in archives that pass."""
    blobs = archives(spark, sf)
    checked = V.verify_checksum(blobs, _checksums(blobs)).where("valid")
    return sources.read_archive(checked).groupBy("repo_name", "commit_sha").agg(
        F.count(F.lit(1)).alias("valid_vectors"), F.sum(F.substring("id", 2, 20).cast("bigint")).alias("ids"))


def restore_vectors(spark, sf):
    """Restore the archives of odd commits over a table that lost half of its rows."""
    archived = sources.read_archive(archives(spark, sf)).where("commit_sha in ('c1', 'c3')")
    stored = _vectors(spark, sf).where("vec_id % 2 = 0").select(*META, "embedding")
    table, _ = V.restore_vectors(stored, archived, "2024-05-01T00:00:00")
    return table.select(*META, "restored_at", F.round(F.aggregate(
        "embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


def _targets(spark, sf):
    return _vectors(spark, sf).where("vec_id % 3 <> 0").groupBy("repo_name").agg(F.max("commit_sha").alias("commit_sha")) \
        .where("repo_name <> 'org/ns5'")


def activate_commit(spark, sf):
    return V.activate_commit(_vectors(spark, sf), _targets(spark, sf))[0].select("id", "repo_name", "commit_sha", "live")


def activate_report(spark, sf):
    return V.activate_commit(_vectors(spark, sf), _targets(spark, sf))[1]


# ---- sync ----------------------------------------------------------------------------

MAX_SYNC_TOKENS = 300


def sync_changes(spark, sf):
    """A change of each file, named by its path; one changed path in seven is missing."""
    lines = fixture(spark, sf, "files").selectExpr("doc_id as seq", "repo_name", """concat(
      case doc_id % 6 when 0 then 'A\t' when 1 then 'M\t' when 2 then 'D\t' when 3 then 'R100\t' when 4 then 'T\t' else 'M' end,
      case when doc_id % 6 = 5 then '' when doc_id % 7 = 0 then 'lost/' else '' end, case when doc_id % 6 = 5 then '' else file_path end,
      case when doc_id % 6 = 3 then '\tmoved/x' else '' end) as line""")
    return parse_name_status(lines)


def _stored(spark, sf):
    """The table before the sync: every chunk of every file, marked as old."""
    return sync_record(embed_gate(chunks(spark, sf).withColumn("status", F.lit("old"))))


def _sync(spark, sf):
    return S.prepare_sync(sync_changes(spark, sf), files(spark, sf).drop("doc_id"), max_tokens=MAX_SYNC_TOKENS)


def apply_sync(spark, sf):
    return S.apply_sync(_stored(spark, sf), _sync(spark, sf)).select(
        "id", "namespace", "file_path", "chunk_index", "status", "embedded")


def sync_report(spark, sf):
    return S.sync_report(_sync(spark, sf))


def sync_failures(spark, sf):
    return _sync(spark, sf).failures


# Few buckets: the tables here are small.
BUCKETS = 2


def table_summary(rows):
    return rows.groupBy("namespace", "status").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("file_path").alias("files"))


def write_vectors_query(spark, sf):
    """Write the table, apply a sync to it on disk, read it back."""
    path = work_path(spark, "vectors")
    write_vectors(_stored(spark, sf), path, BUCKETS)
    S.apply_sync_to_table(path, _sync(spark, sf), BUCKETS)
    return table_summary(read_vectors(spark, path))


QUERIES = {f.__name__: f for f in (
    delete_by_file, delete_by_id, upsert_by_id, fetch_by_ids, namespace_stats, list_namespaces, health_summary,
    restore_vectors, activate_commit, activate_report, verify_checksum, apply_sync, sync_report, sync_failures)}
QUERIES["write_vectors"] = write_vectors_query

_V = cte("vectors")
_META = ", ".join(META)
_TARGETS_SQL = """, t as (select repo_name, max(commit_sha) as sha from vectors where vec_id % 3 <> 0 and repo_name <> 'org/ns5' group by all)
"""

# Changed paths are unique, so collapsing keeps each change; the moved paths do not exist.
def sync_sql(max_tokens):
    return ALL_CHUNKS + f""", ch as (
  select doc_id, repo_name, case doc_id % 6 when 0 then 'A' when 1 then 'M' when 2 then 'D' when 3 then 'D' when 4 then 'T' end as status,
    (doc_id % 7 = 0) as lost, case when doc_id % 7 = 0 then 'lost/' else '' end || file_path as path from files where doc_id % 6 <> 5),
moved as (select distinct repo_name, 'M' as status, 'moved/x' as path from files where doc_id % 6 = 3),
ids as (select *, sha256(repo_name || chr(1) || file_path || chr(1) || chunk_index || chr(1) || content) as id from chunks),
made as (select i.*, ch.status, token_count <= {max_tokens} as embedded, row_number() over (partition by i.repo_name order by file_path, chunk_index) - 1 as n
  from ids i join ch using (doc_id) where ch.status <> 'D' and not lost),
bad as (select repo_name, n // 10 as batch, arg_min(file_path, n) filter (not embedded) as cause from made group by all having bool_or(not embedded)),
kept as (select m.* from made m left join bad b on b.repo_name = m.repo_name and b.batch = m.n // 10 where b.batch is null),
gone as (select doc_id from ch where not lost and status in ('A', 'M', 'D')),
final as (
  select id, repo_name as namespace, file_path, chunk_index, status, embedded from kept
  union all
  select id, repo_name, file_path, chunk_index, 'old', token_count <= 8192 from ids
  where doc_id not in (select doc_id from gone) and id not in (select id from kept)),
missing as (select repo_name, path as file_path, status from ch where lost and status <> 'D' union all select repo_name, path, status from moved)
"""


_SYNC = sync_sql(MAX_SYNC_TOKENS)
SUMMARY_SQL = "select namespace, status, count(*) as n, count(distinct file_path) as files from final group by all"

ORACLES = {
    "verify_checksum": _V + """select repo_name, commit_sha, count(*) as valid_vectors, sum(vec_id)::bigint as ids from vectors
where (vec_id // 100) % 10 <> 3 group by all""",
    "delete_by_file": _V + f"""select {_META} from vectors v where not exists (select 1 from vectors d
  where d.vec_id % 9 = 0 and d.namespace = v.namespace and d.repo_name = v.repo_name and d.file_path = v.file_path)""",
    "delete_by_id": _V + f"select {_META} from vectors where vec_id % 4 <> 1",
    "upsert_by_id": _V + f"""select {_META.replace('content', "case when vec_id % 3 = 0 then 'new ' || content else content end as content")} from vectors
union all select {_META.replace('namespace', "'other' as namespace")} from vectors where vec_id % 5 = 0""",
    "fetch_by_ids": _V + f"select {_META} from vectors where vec_id % 6 = 2 and vec_id % 5 <> 0",
    "namespace_stats": _V + "select namespace, count(*) as total_vectors, max(len(embedding))::int as dimension from vectors group by all",
    "list_namespaces": _V + "select distinct namespace from vectors",
    "health_summary": _V + "select 'healthy' as status, count(*) as total_vectors, count(distinct namespace) as namespaces from vectors",
    "restore_vectors": _V + f"""select {_META}, case when commit_sha in ('c1', 'c3') then '2024-05-01T00:00:00' end as restored_at,
  round(list_sum(embedding::double[]), 4) as total from vectors where commit_sha in ('c1', 'c3') or vec_id % 2 = 0""",
    "activate_commit": _V + _TARGETS_SQL + """select id, v.repo_name, commit_sha, case when sha is null then live else commit_sha = sha end as live
from vectors v left join t using (repo_name)""",
    "activate_report": _V + _TARGETS_SQL + """select repo_name, count_if(live)::bigint as deactivated_count,
  count_if(commit_sha = sha)::bigint as activated_count from vectors join t using (repo_name) group by all""",
    "apply_sync": _SYNC + "select * from final",
    "sync_failures": _SYNC + """select repo_name, file_path, 'process' as operation, 'File marked as ' || status || ' but not found: ' || file_path as message, status from missing
union all select * exclude (batch) from (select distinct m.repo_name, file_path, 'upsert', 'Attempted to upsert empty embedding: ' || cause, status, batch
from made m join bad b on b.repo_name = m.repo_name and b.batch = m.n // 10)""",
    "sync_report": _SYNC + """, r as (select repo_name, count_if(status <> 'D' and not lost) as processed,
    count_if(status = 'D' or (not lost and status in ('A', 'M'))) as deleted_files from ch group by all)
select repo_name, processed::bigint as processed, coalesce(s, 0)::bigint as skipped, (coalesce(s, 0) + coalesce(b, 0))::bigint as errors,
  deleted_files::bigint as deleted_files, coalesce(k, 0)::bigint as chunks_upserted
from r left join (select repo_name, count(*) as s from missing group by all) using (repo_name)
  left join (select repo_name, count(*) as b from bad group by all) using (repo_name)
  left join (select repo_name, count(*) as k from kept group by all) using (repo_name)""",
    "write_vectors": _SYNC + SUMMARY_SQL,
}
