"""Change detection queries."""

from pyspark.sql import functions as F

from lakesearch.operators import changes as C
from lakesearch.registry.fixtures import cte, fixture


def _lines(spark, sf, separator="\t"):
    return fixture(spark, sf, "change_lines").withColumn("line", F.replace("line", F.lit("\t"), F.lit(separator)))


def parse_name_status(spark, sf):
    return C.parse_name_status(_lines(spark, sf))


def parse_change_file(spark, sf):
    changes, errors = C.parse_change_file(_lines(spark, sf, " ").withColumn(
        "line", F.when(F.col("seq") % 12 == 3, F.substring_index("line", " ", 2)).otherwise(F.col("line"))))
    return changes.withColumn("message", F.lit(None).cast("string")).unionByName(errors, allowMissingColumns=True)


def parse_file_tokens(spark, sf):
    changes, errors = C.parse_file_tokens(fixture(spark, sf, "change_tokens"))
    return changes.unionByName(errors, allowMissingColumns=True)


def parse_submodule_diff(spark, sf):
    return C.parse_submodule_diff(fixture(spark, sf, "submodule_lines"), keep=("doc_id",))


def _sides(spark, sf):
    rows = fixture(spark, sf, "snapshots")
    return [rows.where(F.col("side") == side).drop("side") for side in ("old", "new")]


def snapshot_diff(spark, sf):
    return C.snapshot_diff(*_sides(spark, sf))


def detect_renames(spark, sf):
    return C.detect_renames(C.snapshot_diff(*_sides(spark, sf))).groupBy("repo_name", "status").agg(
        F.count(F.lit(1)).alias("files"), F.count("old_path").alias("moved"))


def expand_submodules(spark, sf):
    """One submodule per source: a third added, a third deleted, a third moved."""
    trees = fixture(spark, sf, "snapshots").select(
        F.concat(F.lit("libs/"), "repo_name").alias("sub_path"), F.col("side").alias("sha"), "path", "blob")
    kind = F.pmod(F.length("sub_path"), F.lit(3))
    pointers = trees.select("sub_path").distinct().select(
        "sub_path", F.lit("old").alias("old_sha"), F.lit("new").alias("new_sha"),
        F.when(kind == 0, "added").when(kind == 1, "deleted").otherwise("changed").alias("change"))
    return (C.expand_submodules(pointers, trees).groupBy("sub_path", "status", "path")
            .agg(F.count(F.lit(1)).alias("n")).groupBy("sub_path", "status")
            .agg(F.count(F.lit(1)).alias("paths"), F.sum("n").alias("changes")))


def resolve_commit_range(spark, sf):
    return C.resolve_commit_range(fixture(spark, sf, "ci_events")).drop("ts")


def _plan(spark, sf):
    return C.build_sync_plan(
        C.parse_name_status(_lines(spark, sf)),
        fixture(spark, sf, "snapshots").where("side = 'new'").select("repo_name", F.col("path").alias("file_path")))


def build_sync_plan(spark, sf):
    return _plan(spark, sf)


def collapse_changes(spark, sf):
    """Every document of a language and length class counts as an edit of one path."""
    edits = C.parse_name_status(_lines(spark, sf)).withColumn(
        "path", F.regexp_replace("path", r"\d+$", F.pmod(F.col("seq"), F.lit(17)).cast("string")))
    return C.collapse_changes(edits)


QUERIES = {f.__name__: f for f in (
    parse_name_status, parse_change_file, parse_file_tokens, parse_submodule_diff, expand_submodules,
    snapshot_diff, detect_renames, resolve_commit_range, build_sync_plan, collapse_changes)}

_CHANGES = """, cols as (select repo_name, seq, string_split(line, chr(9)) as c from change_lines),
changes as (
  select repo_name, seq, 0 as ord, case when c[1] like 'R%' and len(c) >= 3 then 'D' else c[1] end as status, c[2] as path
  from cols where len(c) >= 2
  union all
  select repo_name, seq, 1, 'M', c[3] from cols where c[1] like 'R%' and len(c) >= 3)
"""

_DIFF = """, diff as (
  select coalesce(o.repo_name, n.repo_name) as repo_name, coalesce(o.path, n.path) as path,
    case when o.path is null then 'A' when n.path is null then 'D' else 'M' end as status,
    o.blob as old_blob, n.blob as new_blob
  from (select * from snapshots where side = 'old') o
  full outer join (select * from snapshots where side = 'new') n on o.repo_name = n.repo_name and o.path = n.path
  where o.blob is distinct from n.blob)
"""

# Pairing inside a blob is free, so only the counts are fixed: as many adds turn into
# modifies as there are deletes of the same content.
_MOVED = """, blobs as (
  select repo_name, coalesce(new_blob, old_blob) as blob, sum((status = 'A')::int) as adds, sum((status = 'D')::int) as dels
  from diff group by all)
"""

ORACLES = {
    "parse_name_status": cte("change_lines") + _CHANGES + "select * from changes",
    "parse_change_file": cte("change_lines") + """, cols as (
  select repo_name, seq, string_split(replace(line, chr(9), ' '), ' ') as c from change_lines),
cut as (select repo_name, seq, case when seq % 12 = 3 then c[1:2] else c end as c from cols)
select repo_name, seq, 0 as ord, case when c[1] like 'R%' then 'D' else c[1] end as status, c[2] as path, null::varchar as message
from cut where len(c) >= 2 and not (c[1] like 'R%' and len(c) < 3)
union all select repo_name, seq, 1, 'M', c[3], null from cut where c[1] like 'R%' and len(c) >= 3
union all select repo_name, seq, null, null, null, 'Malformed rename line: ' || array_to_string(c, ' ') from cut
where c[1] like 'R%' and len(c) < 3""",
    "parse_file_tokens": cte("change_tokens") + """, t as (
  select *, case when instr(token, ':') > 0 then upper(trim(string_split(token, ':')[1])) else 'M' end as status,
    case when instr(token, ':') > 0 then substr(token, instr(token, ':') + 1) else token end as path from change_tokens)
select repo_name, seq, status, path, null::varchar as message from t where status in ('A', 'M', 'D')
union all select repo_name, seq, null, null, 'Invalid status prefix: ' || token from t where status not in ('A', 'M', 'D')""",
    "parse_submodule_diff": cte("submodule_lines") + r""", p as (
  select doc_id, regexp_extract(line, '^Submodule\s+(\S+)\s', 1) as sub_path,
    regexp_extract(line, '\s([0-9a-f]{7,})\.\.', 1) as old_sha, regexp_extract(line, '\.\.([0-9a-f]{7,})', 1) as new_sha
  from submodule_lines)
select *, case when trim(old_sha, '0') = '' then 'added' when trim(new_sha, '0') = '' then 'deleted' else 'changed' end as change from p""",
    "snapshot_diff": cte("snapshots") + _DIFF + "select repo_name, path, status, old_blob, new_blob from diff",
    "detect_renames": cte("snapshots") + _DIFF + _MOVED + """, moved as (
  select repo_name, sum(least(adds, dels)) as m from blobs group by repo_name),
n as (select repo_name, s.status, count(d.status) as c from moved cross join (values ('A'), ('M'), ('D')) s(status)
  left join diff d using (repo_name, status) group by all)
select repo_name, status, (case status when 'A' then c - m when 'M' then c + m else c end)::bigint as files,
  (case when status = 'M' then m else 0 end)::bigint as moved
from n join moved using (repo_name) where (case status when 'A' then c - m when 'M' then c + m else c end) > 0""",
    "expand_submodules": cte("snapshots") + _DIFF + _MOVED + """, kinds as (
  select distinct repo_name, length('libs/' || repo_name) % 3 as kind from snapshots),
moved as (select repo_name, sum(least(adds, dels)) as m from blobs group by repo_name),
rows as (
  select repo_name, 'A' as status, count(*) as c, count(distinct path) as p from snapshots join kinds using (repo_name)
  where side = 'new' and kind = 0 group by all
  union all
  select repo_name, 'D', count(*), count(distinct path) from snapshots join kinds using (repo_name)
  where side = 'old' and kind = 1 group by all
  union all
  select repo_name, status, case status when 'A' then c - m when 'M' then c + m else c end, 0
  from (select repo_name, s.status, count(d.status) as c from moved cross join (values ('A'), ('M'), ('D')) s(status)
    left join diff d using (repo_name, status) group by all) join moved using (repo_name)
    join kinds using (repo_name) where kind = 2)
select 'libs/' || repo_name as sub_path, status, (case when p = 0 then c else p end)::bigint as paths, c::bigint as changes
from rows where c > 0""",
    "resolve_commit_range": cte("ci_events") + """, r as (
  select *, case event_name when 'push' then json_extract_string(payload, '$.before')
      when 'pull_request' then json_extract_string(payload, '$.pull_request.base.sha') end as b,
    case event_name when 'push' then coalesce(nullif(env_sha, ''), nullif(json_extract_string(payload, '$.after'), ''))
      when 'pull_request' then coalesce(nullif(json_extract_string(payload, '$.pull_request.merge_commit_sha'), ''), nullif(env_sha, '')) end as h
  from ci_events),
s as (select *, nullif(nullif(b, ''), repeat('0', 40)) as rb from r),
e as (select *, case when event_name not in ('push', 'pull_request') then 'Unsupported event type: ' || event_name
  when h is null and rb is null then 'base and head missing' when h is null then 'head missing' end as error from s)
select event_id, event_name, env_sha, case when error is null then coalesce(rb, h || '^') end as base,
  case when error is null then h end as head, error from e""",
    "build_sync_plan": cte("change_lines", "snapshots") + _CHANGES + """, f as (
  select distinct repo_name, path, true as present from snapshots where side = 'new'),
j as (select c.*, coalesce(present, false) as found from changes c left join f using (repo_name, path))
select repo_name, seq, status, path, (status = 'D' or (found and status in ('A', 'M'))) as do_delete,
  (status <> 'D' and found) as do_process,
  case when status <> 'D' and not found then 'File marked as ' || status || ' but not found: ' || path end as error
from j where status not like 'R%'""",
    "collapse_changes": cte("change_lines") + _CHANGES + r""", e as (
  select repo_name, seq, ord, status, regexp_replace(path, '\d+$', (seq % 17)::varchar) as path from changes)
select repo_name, path, arg_max(status, seq * 2 + ord) as status, max(seq) as seq from e group by all""",
}
