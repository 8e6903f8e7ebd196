"""Operator 3 — mixing sources to target weights by capped water-filling.

Each source has a weight; the mix shares ``share`` (1.0) of all sizes among
the sources by weight.  A source gives at most ``max_epochs`` times its size:
sources above that are clamped there, their excess is shared again among the
others by weight, until none is above.  A source then takes every document
``whole = floor(target / size)`` times and a seeded part of them once more: in
the order of a hash of the id, as many as come nearest to the target.

A document's size is its number of words (null text: 0).  Sources are ranked
by code point, null last; rank r has weight ``weights[r mod len(weights)]``.

The water level is found by rounds of one small aggregate over the table of
sources, and what a source takes is a cut in the order (hash, size), kept as
one row for each source: documents find their number of copies by a join with
that table, never by a list of ids.  The cut is found in two steps (sums of
4,096 hash ranges for each source, then the rows of one range), so a source
with a third of all rows is no large group anywhere.

Rows with a null id all have the same hash; rows that agree in id and size are
taken or left together.  A source of size 0 has target 0.  Empty tables give
no rows.  Other columns are ignored by ``mix`` and kept by ``sample``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import global_row_number
from .common import durable, fresh, prepare, read, words_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SHARE = 1.0
SEED = "mix:"


def order_key(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def fill(sources: DataFrame, total: float, max_epochs: int) -> DataFrame:
    """Targets of (source, source_size, weight)."""
    cap = F.col("source_size") * max_epochs
    level, above = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > cap
        n, capped, weight = sources.agg(F.coalesce(F.sum(over.cast("long")), F.lit(0)),
                                        F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
                                        F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == above or not weight:
            break
        above, level = n, (total - capped) / weight
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(float(level))
    return sources.withColumn("target", F.least(share, cap.cast("double")))


def plan(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = SHARE) -> DataFrame:
    """(source, size, key) rows → one row for each source: source,
    source_size, target, whole, cut_key, cut_size."""
    sums = durable(rows.groupBy("source", F.substring("key", 1, 3).alias("range")).agg(F.sum("size").alias("n")))
    sizes = sums.groupBy("source").agg(F.sum("n").alias("source_size"))
    ranked = global_row_number(sizes, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = durable(ranked.select("source", "source_size", weight.alias("weight")))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    aims = fill(sources, total if share == 1 else total * share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    aims = durable(aims.withColumn("whole", whole)
                   .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    run = Window.partitionBy("source").orderBy("range")
    split = (sums.withColumn("end", F.sum("n").over(run)).withColumn("before", F.col("end") - F.col("n"))
             .join(aims.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
             .where("before <= rest and end > rest").select("s", "range", "before", "rest"))
    split = durable(split)  # one row for each source
    inside = (rows.join(split, F.col("source").eqNullSafe(F.col("s")) & (F.substring("key", 1, 3) == F.col("range")))
              .withColumn("end", F.col("before") + F.sum("size").over(Window.partitionBy("s").orderBy("key", "size"))))
    last = (inside.where("2 * end - size <= 2 * rest").groupBy("s").agg(F.max(F.struct("key", "size")).alias("cut")))
    cuts = (split.join(last.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t")), "left")
            .select("s", F.coalesce("cut.key", "range").alias("cut_key"), F.coalesce("cut.size", F.lit(-1)).alias("cut_size")))
    return durable(aims.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
                   .select("source", "source_size", "target", "whole", "cut_key", "cut_size"))


def copies(key: Column, size: Column, whole, cut_key, cut_size, max_epochs: int = MAX_EPOCHS) -> Column:
    """How often a document is taken."""
    more = (key < F.col(cut_key)) | ((key == F.col(cut_key)) & (size <= F.col(cut_size)))
    return F.least(F.lit(max_epochs), F.col(whole) + F.coalesce(more, F.lit(False)).cast("int"))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", words_of(F.col("text")).alias("size"), order_key(F.col("doc_id")).alias("key"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    prepare(docs.sparkSession)
    rows = durable(sized(docs))
    of = plan(rows, weights, max_epochs, share).withColumnRenamed("source", "s")
    many = copies(F.col("key"), F.col("size"), "whole", "cut_key", "cut_size", max_epochs)
    return (rows.join(of, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", many)
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"))


def sample(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = SHARE) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as they are."""
    prepare(docs.sparkSession)
    cols = docs.columns
    rows = durable(sized(docs))
    names = fresh(cols, "mix_source", "mix_size", "mix_target", "mix_whole", "mix_key", "mix_cut", "mix_copy")
    of = plan(rows, weights, max_epochs, share).toDF(*names[:-1])
    many = copies(order_key(F.col("doc_id")), words_of(F.col("text")), names[3], names[4], names[5], max_epochs)
    return (docs.join(of, F.col("source").eqNullSafe(F.col(names[0])))
            .withColumn(names[-1], F.explode(F.array_repeat(F.lit(0), many)))
            .select(*(F.col(f"`{c}`") for c in cols)))


def query(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).withColumn("copies", F.col("copies").cast("long"))


def oracle_sql() -> str:
    return f"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
         md5('{SEED}' || coalesce(cast(doc_id as varchar), 'null')) as key
  from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), w as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight from s
), p as (
  select *, {MAX_EPOCHS} * source_size as cap,
         sum(source_size) over ()::bigint as total,
         coalesce(sum({MAX_EPOCHS} * source_size) over o, 0)::bigint as cap_before,
         (sum(weight) over () - coalesce(sum(weight) over o, 0))::bigint as weight_left,
         row_number() over o2 as place
  from w window o as (order by {MAX_EPOCHS} * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding),
                o2 as (order by {MAX_EPOCHS} * source_size / weight, source nulls last)
), l as (
  select arg_min((total - cap_before) / weight_left, place) filter (where weight * ((total - cap_before) / weight_left) <= cap) as level from p
), t as (
  select source, source_size, least(weight * coalesce(level, 0), cap::double) as target from p, l
), e as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as whole from t
), c as (
  select d.*, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size as rest,
         sum(d.size) over (partition by d.source order by d.key, d.size) as fin
  from d join e on d.source is not distinct from e.source
)
select doc_id, size, source_size, target,
       size * least({MAX_EPOCHS}, whole + (2 * fin - size <= 2 * rest)::int)::bigint as taken,
       least({MAX_EPOCHS}, whole + (2 * fin - size <= 2 * rest and source_size > 0)::int)::bigint as copies
from c"""
