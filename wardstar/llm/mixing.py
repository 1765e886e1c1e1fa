"""Mixing sources to target weights by systematic sampling (DataFrame operations only).

Every document of a source has the same expected number of copies,
``target / source size``.  Within a source the documents stand in a fixed
order (largest first, so that neighbours are alike and the words taken come
near the target); their expected copies are prefix-summed, one random offset
is added, and a document is emitted once per integer the sum passes.

The prefix sum is the expected copies times the document's rank, and the rank
comes from counts at three levels: (source, size), then one of ``BUCKETS``
hash buckets of the document id, then the row number inside a bucket.  No task
gets more than one bucket of one size of one source, so neither a source nor
a group of equal copies that holds a third of all rows meets in one task.

Defined results: null text has size 0 and is a document like any other; null
sources form one source, last in order; a source whose documents are all
empty has target 0 and is not taken; rows that repeat are documents of their
own; no rows give no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import WORD, table

BUCKETS = 4096  # three hex digits of the id's MD5
_STEPS = 1 << 20  # the offset is a multiple of 1 / _STEPS: sums stay exact


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hex(value: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, digits), 16, 10).cast("long")


_NULL = "n"


def _key(source: Column) -> Column:
    """A text that is never null, a different one for each source and for null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(_NULL))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``sizes(source, source_size)``, one row per source, with the target of each.

    Weights repeat over the sources in code-point order, null last.  The
    targets share the sum of all sizes by weight; a target stops at ``cap``
    times its source's size and the excess goes to the others by weight until
    none is above.  With the sources in order of ``cap * size / weight``, the
    words per weight are ``(total - caps before) / (weights from here on)`` at
    the first source that keeps below its cap, hence at the largest such value.
    """
    total = Window.partitionBy()
    # over one row per source, which is what a mix is configured by
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("_limit", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    return (
        sizes.select("source", "source_size")
        .withColumn("_n", F.row_number().over(by_name) - 1)
        .withColumn("_w", weight.cast("long"))
        .withColumn("_cap", F.col("source_size") * cap)
        .withColumn("_limit", F.col("_cap") / F.col("_w"))
        .withColumn("_left", F.sum("source_size").over(total) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left") / F.sum("_w").over(onwards))
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_limit"), F.col("_level"))).over(total))
        .withColumn("target", F.least(F.col("_w") * F.col("_level"), F.col("_cap").cast("double")))
        .select("source", "source_size", "target")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 42) -> DataFrame:
    """All rows of ``docs`` (doc_id, text, source, ...) with size, source_size, target, copies and taken."""
    names = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select([F.col(f"`{c}`").alias(a) for c, a in names.items()]).select(
        *names.values(),
        F.col(names["source"]).alias("source"),
        _key(F.col(names["source"])).alias("_key"),
        word_count(F.col(names["text"])).alias("size"),
        F.coalesce(_hex(F.col(names["doc_id"]).cast("string"), 3), F.lit(0)).alias("_bucket"),
    )
    cell = ["_key", "size", "_bucket"]
    cells = rows.groupBy(*cell).agg(F.count("*").alias("_c"))
    sizes = cells.groupBy("_key", "size").agg(F.sum("_c").alias("_c"))
    source = F.when(F.col("_key") != _NULL, F.substr(F.col("_key"), F.lit(2))).alias("source")
    of_source = sizes.groupBy("_key").agg(F.sum(F.col("size") * F.col("_c")).alias("source_size"))
    targets = source_targets(of_source.select(source, "source_size"), weights, cap).withColumn("_key", _key(F.col("source")))

    larger = Window.partitionBy("_key").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_key", "size", F.coalesce(F.sum("_c").over(larger), F.lit(0)).alias("_larger"))
    sooner = Window.partitionBy("_key", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*cell, F.coalesce(F.sum("_c").over(sooner), F.lit(0)).alias("_sooner"))
    starts = cells.join(sizes, ["_key", "size"]).join(targets.drop("source"), "_key")

    inside = Window.partitionBy(*cell).orderBy(F.col(names["doc_id"]).asc_nulls_first(), F.xxhash64(names["text"]))
    ranked = rows.withColumn("_i", F.row_number().over(inside)).join(starts, cell)  # one dealing out serves both
    rank = F.col("_larger") + F.col("_sooner") + F.col("_i")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _hex(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit(""))), 5) / F.lit(float(_STEPS))
    crossed = (F.floor(expected * rank + offset) - F.floor(expected * (rank - 1) + offset)).cast("long")
    copies = F.least(crossed, F.ceil(expected).cast("long"))  # a sum rounded up cannot add a copy
    return (
        ranked.withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(
            *[F.col(a).alias(c) for c, a in names.items() if c not in MADE],
            *[c for c in MADE],
        )
    )


#: Columns that ``mix`` makes; a column of the input with such a name gives way.
MADE = ("size", "source_size", "target", "copies", "taken")


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as many times as it is taken, none included."""
    return mixed.where(F.col("copies") > 0).select(
        *[F.col(f"`{c}`") for c in columns], F.explode(F.expr("array_repeat(0, cast(copies as int))")).alias("_copy")
    ).select(*[F.col(f"`{c}`") for c in columns])


def op1_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


#: {docs}: a relation with doc_id, text, source.
MIX_SQL = r"""
rows as (
  select doc_id, text, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         coalesce(('0x' || substr(md5(doc_id::varchar), 1, 3))::bigint, 0) as bucket
  from {docs}),
per_source as (
  select source, sum(size)::bigint as source_size,
         (list_extract([1, 2, 3], ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int))::bigint as w
  from rows group by source),
limits as (
  select *, 3 * source_size as most, (3 * source_size)::double / w as lim,
         (sum(source_size) over () - coalesce(sum(3 * source_size) over before, 0))::double
           / (sum(w) over onwards)::double as lvl
  from per_source
  window before as (order by (3 * source_size)::double / w, source nulls last
                    rows between unbounded preceding and 1 preceding),
         onwards as (order by (3 * source_size)::double / w, source nulls last
                     rows between current row and unbounded following)),
targets as (
  select source, source_size,
         least(w * max(case when lvl <= lim then lvl end) over (), most::double) as target
  from limits),
ranked as (
  select r.*, t.source_size, t.target,
         row_number() over (partition by r.source
                            order by r.size desc, r.bucket, r.doc_id nulls first) as rnk,
         case when t.source_size > 0 then t.target / t.source_size else 0.0 end as expected,
         ('0x' || substr(md5('42:' || coalesce(r.source, '')), 1, 5))::bigint / 1048576.0::double as off
  from rows r join targets t on r.source is not distinct from t.source),
mixed as (
  select *, least(floor(expected * rnk + off) - floor(expected * (rnk - 1) + off), ceil(expected))::bigint as copies
  from ranked)
"""

ORACLES = {
    "op1_mixing": "with " + MIX_SQL.format(docs="documents")
    + "select doc_id, size, source_size, target, copies * size as taken, copies from mixed",
}
QUERIES = {"op1_mixing": op1_mixing}
