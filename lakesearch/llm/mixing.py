"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight. A source whose share is above ``max_epochs``
times its own size is clamped there, and what is left over goes to the others by weight,
until no share is above its clamp. The documents are then repeated: as often in whole as
fits the target, and once more for a seeded random part of the source, cut at the word
where the target is met.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a
source of its own, last in order; equal rows are taken like different rows; an empty table
gives an empty result; other columns are ignored, or carried along if named in ``carry``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakesearch.functions.numbering import numbered
from lakesearch.llm.common import WORD, count_words, running_sum, table
from lakesearch.session import staged

MAX_EPOCHS = 3
SEED = 17
WEIGHT_CYCLE = 3


def _wide(column: Column) -> Column:
    return column.cast("decimal(18,0)")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` (double) to (source, size, weight).

    The water level is the pair (words left, weight left) of the sources that are not
    clamped. Each round is one aggregate over the sources; a source clamped at one level
    stays clamped at the next, as levels only rise, so the pair is the whole state.
    """
    cap = F.col("size") * F.lit(max_epochs)
    total, weight = sources.agg(F.sum("size"), F.sum("weight")).first()
    total, weight = int(total or 0), int(weight or 0)
    left, share = total, weight
    while True:
        above = _wide(F.col("weight")) * _wide(F.lit(left)) > _wide(cap) * _wide(F.lit(share))
        used, open_weight = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        level = (total - int(used or 0), int(open_weight or 0))
        if level == (left, share):
            break
        left, share = level
    level_share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(share or 1))
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(level_share))


def cycle_weights(sources: DataFrame, cycle: int = WEIGHT_CYCLE) -> DataFrame:
    """Add ``weight``: 1, 2, ..., ``cycle``, repeating, by code point of the name, null last."""
    ranked = sources.select("source", "size", F.col("source").isNull().alias("unnamed"), F.lit(0).alias("all"))
    placed = numbered(ranked, ["all"], ["unnamed", "source"])
    return placed.select("source", "size", (F.col("position") % cycle + 1).cast("long").alias("weight"))


def mix(docs: DataFrame, weigh=cycle_weights, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), and a struct ``carried`` of the ``carry`` columns.

    ``weigh`` turns (source, size) into (source, size, weight). ``taken`` is the number of
    words the mix takes of a row: ``taken div size`` whole copies, the rest from its start.
    """
    sized = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), count_words(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("draw"),
        *([F.struct(*carry).alias("carried")] if carry else [])), "sized")
    sources = staged(weigh(sized.groupBy("source").agg(F.sum("size").alias("size"))), "sources")
    filled = water_fill(sources, max_epochs).withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    plan = filled.select(
        F.col("source").alias("of"), F.col("size").alias("source_size"), "target",
        F.when(F.col("size") > 0, F.expr("words div size")).otherwise(0).alias("whole"),
        F.when(F.col("size") > 0, F.col("words") % F.col("size")).otherwise(0).alias("part"))
    drawn = running_sum(sized, ["source"], ["draw", "doc_id", "size"], "size", "before")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("before")))
    return drawn.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + rest).cast("long").alias("taken"),
        *(["carried"] if carry else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each whole copy taken, and the
    first words of the documents at which a source's last copy ends."""
    others = [c for c in docs.columns if c not in ("doc_id", "source")]
    taken = mix(docs, carry=tuple(others), **options).where("size > 0 and taken > 0")
    whole = taken.where("taken >= size").withColumn("copy", F.explode(F.expr("sequence(1L, taken div size)")))
    words = F.slice(F.regexp_extract_all("carried.text", F.lit(WORD), F.lit(0)), F.lit(1), (F.col("taken") % F.col("size")).cast("int"))
    cut = taken.where("taken % size > 0").withColumn("start", F.array_join(words, " "))
    plain = {c: F.col(c) if c not in others else F.col("carried")[c] for c in docs.columns}
    changed = {"text": F.col("start")}
    if "n_chars" in others:
        changed["n_chars"] = F.length("start").cast(docs.schema["n_chars"].dataType)
    pick = lambda columns: [x.alias(c) for c, x in columns.items()]
    return whole.select(pick(plain)).unionByName(cut.select(pick(plain | changed)))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixing_sql(docs: str, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for (docs.*, size, source_size, target, taken) over the relation ``docs``."""
    return rf"""
  (with sized as (select *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from {docs}),
  named as (select source, sum(size)::bigint as source_size from sized group by source),
  weighed as (select source, source_size, {max_epochs} * source_size as cap,
      (row_number() over (order by source is null, source) - 1) % {WEIGHT_CYCLE} + 1 as weight from named),
  levels as (select *, sum(source_size) over ()
      - coalesce(sum(cap) over (order by cap / weight, source is null, source rows between unbounded preceding and 1 preceding), 0) as lft,
      sum(weight) over (order by cap / weight, source is null, source rows between current row and unbounded following) as share from weighed),
  level as (select arg_min(lft, cap / weight) as lft, arg_min(share, cap / weight) as share
      from levels where weight * lft <= cap * share),
  filled as (select source, source_size, case when weight * lft > cap * share then cap::double
      else (weight * lft)::double / share::double end as target from weighed, level),
  plan as (select *, floor(target + 0.5)::bigint as words from filled),
  drawn as (select *, coalesce(sum(size) over (partition by source order by md5('{seed}:' || coalesce(doc_id::varchar, '')), doc_id, size
      rows between unbounded preceding and 1 preceding), 0)::bigint as earlier from sized)
  select drawn.*, plan.source_size, plan.target, (case when plan.source_size = 0 then 0 else words // plan.source_size * size
      + greatest(0, least(size, words % plan.source_size - earlier)) end)::bigint as taken
  from drawn join plan on drawn.source is not distinct from plan.source)"""


SQL = f"select doc_id, size, source_size, target, taken from {mixing_sql('documents')}"
