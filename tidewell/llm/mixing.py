"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order (MD5 of seed, document key and size), passed up to
``max_repeats`` times. A document's virtual finish time is its source's cumulative size divided by the source's
weight. Served by finish time until the total budget is used, the queues share it by weight, a queue that runs
out leaves its part to the others, and no document is taken more than ``max_repeats`` times.

Scale: cumulative sizes are prefix sums over 4096 hash cells per source (a small table) plus a running sum inside
a cell, so a source with a third of all rows is spread over 4096 groups. The served order is a global range sort of
narrow rows; only per-partition totals (one number per partition) and the one document at the cut reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import WORD, cut_lineage, key_text, own_name, table

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET_SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix-1"
CELLS = 64
#: Prefix of every column that the operator adds while it works (on a table without other columns that the caller named).
P = "_mix_"
#: Columns that the operator returns besides those of its input.
RETURNED = ("mix_size", "mix_source_size", "mix_target", "mix_repeats", "mix_taken")


def words(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """One row per source: total size, weight and target.

    Sources in order of code point, null last, take the weights in turn. Targets are proportional to weight, none above
    ``repeats`` times its source's size: the level at which they add up to the budget is found from the sources
    sorted by the level at which each is exhausted.
    """
    ranked = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.col("source_size") * repeats).withColumn("full_at", F.col("most") / F.col("weight"))
    order, everything = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    spent, weight_before = F.coalesce(F.sum("most").over(order), F.lit(0)), F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * share - spent) / F.greatest(F.sum("weight").over(everything) - weight_before, F.lit(1e-9))
    ranked = ranked.withColumn("level", level)
    shared = F.coalesce(F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything), F.max("full_at").over(everything))
    return ranked.withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * shared)).select("source", "source_size", "weight", "target")


def queued(docs: DataFrame, key: str, seed: str, targets: DataFrame, offsets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``docs`` (with ``size`` and ``source``) with their cumulative source size in the shuffled order, and the cells' offsets."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key_text(key), F.lit(":"), F.col("size").cast("string")))
    cell = F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")
    celled = docs.withColumns({f"{P}order": digest, f"{P}hi": F.floor(cell / CELLS).cast("int"), f"{P}lo": (cell % CELLS).cast("int")})
    hi, lo, source = f"{P}hi", f"{P}lo", f"{P}source"
    # a key that is never null, so that the equi-joins keep rows without a source
    celled = celled.withColumn(source, F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source"))))
    if offsets is None:
        before = (Window.unboundedPreceding, -1)
        sums = celled.groupBy(source, hi, lo).agg(F.sum("size").alias("n"))
        tops = sums.groupBy(source, hi).agg(F.sum("n").alias("m"))
        tops = tops.select(source, hi, F.coalesce(F.sum("m").over(Window.partitionBy(source).orderBy(hi).rowsBetween(*before)), F.lit(0)).alias("above"))
        within = F.coalesce(F.sum("n").over(Window.partitionBy(source, hi).orderBy(lo).rowsBetween(*before)), F.lit(0))
        keyed = targets.select(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source"))).alias(source), F.col("source_size").alias(f"{P}source_size"), F.col("weight").alias(f"{P}weight"), F.col("target").alias(f"{P}target"))
        offsets = cut_lineage(
            sums.withColumn("within", within)
            .join(tops, [source, hi])
            .join(keyed, source)
            .select(source, hi, lo, (F.col("above") + F.col("within")).alias(f"{P}base"), f"{P}source_size", f"{P}weight", f"{P}target")
        )
    inside = F.sum("size").over(Window.partitionBy(source, hi, lo).orderBy(f"{P}order", "size").rowsBetween(Window.unboundedPreceding, 0))
    out = celled.withColumn(f"{P}sum", inside).join(offsets, [source, hi, lo])
    out = out.withColumn(f"{P}sum", F.col(f"{P}base") + F.col(f"{P}sum")).drop(source, hi, lo, f"{P}base")
    return out, offsets


def finish(repeat: int) -> Column:
    return (F.col(f"{P}source_size") * repeat + F.col(f"{P}sum")) / F.col(f"{P}weight")


def mix(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    share: float = BUDGET_SHARE,
    repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_repeats`` (times taken) and ``mix_taken`` (size taken).

    Rows that are not taken stay, with 0. Null texts have size 0 and are taken when their turn comes; texts of any length are measured whole; null sources form one
    source, ordered last; rows that are equal in key and size (null keys too) are interchangeable. An empty table gives an empty table.
    Where ``docs`` has a column of such a name, the new one is named with underscores before it (see ``returned``).
    """
    # the caller's columns travel as one struct: no name of theirs can meet one of ours
    wide = docs.select(F.col(key).alias("key"), F.col("source").alias("source"), size.alias("size"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    narrow = cut_lineage(wide.drop("row"))
    targets = source_targets(narrow, weights, share, repeats)
    queue, offsets = queued(narrow, "key", seed, targets)
    last = _cut(queue, share, repeats)
    out, _ = queued(wide, "key", seed, targets, offsets)
    taken = F.lit(0)
    for r in range(repeats):
        taken = taken + _served(r, last).cast("int")
    values = (F.col("size"), F.col(f"{P}source_size"), F.col(f"{P}target"), taken, (F.col("size") * taken).cast("long"))
    return out.select("row.*", *[v.alias(n) for v, n in zip(values, returned(docs), strict=True)])


def returned(docs: DataFrame) -> list[str]:
    """The names of the operator's columns for this input, in the order of ``RETURNED``."""
    return [own_name(docs, n) for n in RETURNED]


def _served(repeat: int, last: tuple | None) -> Column:
    """Whether the document's pass ``repeat`` is served no later than the last served one."""
    if last is None:
        return F.lit(False)
    at, again, order, size = last
    f = finish(repeat)
    tie = F.struct(F.lit(repeat), F.col(f"{P}order"), F.col("size").cast("long")) <= F.struct(F.lit(again), F.lit(order), F.lit(size).cast("long"))
    return (f < F.lit(at)) | ((f == F.lit(at)) & tie)


def _cut(queue: DataFrame, share: float, repeats: int) -> tuple | None:
    """(finish, pass, order, size) of the last served entry; None if nothing is served."""
    entries = queue.select(
        F.explode(F.array(*[F.struct(finish(r).alias("at"), F.lit(r).alias("again")) for r in range(repeats)])).alias("e"), F.col(f"{P}order").alias("o"), "size"
    ).select("e.at", "e.again", "o", "size")
    order = ("at", "again", "o", "size")
    ranged = cut_lineage(entries.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    totals = sorted(tuple(r) for r in ranged.groupBy("part").agg(F.sum("size")).collect())
    budget = int(sum(n for _, n in totals) // repeats * share)
    before, cut = 0, None
    for part, n in totals:
        cut = (part, budget - before)
        if before + n > budget:
            break
        before += n
    if cut is None:
        return None
    running = F.sum("size").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    fits = ranged.filter(F.col("part") == cut[0]).withColumn("running", running).filter(F.col("running") <= cut[1])
    best = F.max(F.struct(*order))
    found = fits.agg(best.alias("m")).first()["m"] or ranged.filter(F.col("part") < cut[0]).agg(best.alias("m")).first()["m"]
    return tuple(found) if found else None


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as ``mixed``, its mix, takes it."""
    repeats = F.col(returned(docs)[RETURNED.index("mix_repeats")])
    copies = mixed.filter(repeats > 0).select(F.struct(*docs.columns).alias("row"), F.explode(F.sequence(F.lit(1), repeats)))
    return copies.select("row.*")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words().alias("w"))
    sized = cut_lineage(docs)
    return mix(sized, F.col("w")).select(
        "doc_id", "source", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken")
    )


OP2_SQL = r"""
WITH c AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
d AS (SELECT doc_id, source, size, md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size::VARCHAR) AS o FROM c),
s AS (SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM d GROUP BY source),
r AS (SELECT *, source_size * 2 AS most, (source_size * 2)::DOUBLE / weight AS full_at FROM s),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(most) OVER w, 0)::DOUBLE) / greatest(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0), 1e-9) AS level FROM r
      WINDOW w AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, weight, least(most::DOUBLE, weight * coalesce(max(CASE WHEN level <= full_at THEN level END) OVER (), max(full_at) OVER ())) AS target FROM l),
q AS (SELECT d.doc_id, d.source, d.size, d.o, t.source_size, t.weight, t.target, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS c FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT doc_id, size, o, again, (source_size * again + c)::DOUBLE / weight AS fin FROM q, (VALUES (0), (1)) v(again)),
g AS (SELECT doc_id, o, size, sum(size) OVER (ORDER BY fin, again, o, size ROWS UNBOUNDED PRECEDING) AS total FROM e),
k AS (SELECT doc_id, count(*) FILTER (WHERE total <= (SELECT floor(sum(size) * 1.5) FROM d)) AS n FROM g GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, (q.size * k.n)::BIGINT AS taken FROM q JOIN k ON q.doc_id = k.doc_id
"""
