"""Near-duplicates by SimHash fingerprints and vantage-point trees.

Fingerprints are 64 bits over word shingles. Two fingerprints within ``radius`` bits differ in at most
``radius // 3`` bits of at least one of three blocks of the 64 bits, so three trees are kept, one per block, in which distances are
block distances and the search radius is that smaller one.

A tree's node has a vantage point and a distance: fingerprints no farther than it belong left, the others right. A fingerprint
searches both sides only if its own distance is within the radius of the boundary (the triangle bound). The upper levels are grown
on the driver from a bounded sample and deal the fingerprints out to shards: one home shard each, and further shards
whose boundary its search ball overlaps. Shards with more than ``SHARD_CAP`` rows grow further levels on Spark, a level of all of
them at a time: each one's vantage point and distances come from aggregates over its own rows, and the rows are dealt on by column expressions.
So the number of levels follows the number of fingerprints. Each shard then grows the lower levels over its own rows in the
same way; at the leaves every home fingerprint is compared with every searching one by full 64-bit distance, in blocks. What leaves a
shard is a spanning forest of the pairs found, never the pairs themselves.

Where a block has one value for too many fingerprints to split further (a large group of near copies), the shard's tree goes
on with the full 64 bits and the full radius. A shard that neither splits (nearly every ball crosses every boundary) is divided into cells of
home rows x searching rows, each a task of its own, so that no group lands in one task whole.

Copies meet only as one fingerprint: the documents behind it are summed up before any search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import Forest, components, dealt_anew, shrink
from .shared import cut_lineage, own_name, table, text_or_empty

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Home rows aimed at per shard, rows of a shard beyond which it is split, the sample that the upper levels are grown from, leaf size.
SHARD_ROWS, SHARD_CAP, SAMPLE, LEAF = 8192, 65536, 20000, 256
#: Levels that the driver grows at most (a shard then has ten sample points or more on average); a further level must leave the sides at most this many times the rows.
TOP_LEVELS, WORTH = 11, 1.8
#: Three blocks of the 64 bits.
BLOCKS = tuple(np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in ((0, 21), (21, 43), (43, 64)))
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text: A-Z in lower case, words between ASCII white space, shingles joined by single spaces, repeats counted.

    Fewer words than a shingle: the whole sequence is one. No words: 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), 16384):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i : i + 16384], ends[i : i + 16384], strict=True)], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the fingerprint as a signed long."""
    from pyspark.sql.types import LongType, StructField, StructType

    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in b.column(b.num_columns - 1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(prints)], names=[*keep, name])

    schema = StructType([*docs.select(*keep).schema.fields, StructField(name, LongType())])
    return docs.select(*keep, F.col(text).alias("_text_of_fingerprint")).mapInArrow(run, schema)


def distance(a: np.ndarray, b: np.ndarray | np.uint64, mask: np.uint64 = ALL) -> np.ndarray:
    return np.bitwise_count((a ^ b) & mask)


def _boundary(points: np.ndarray, mask: np.uint64, salt: int) -> tuple[np.uint64, int] | None:
    """A vantage point and the distance that splits ``points`` most evenly; None if no candidate splits them."""
    best = None
    for i in range(4):
        at = points[(salt * 7919 + i * 104729) % len(points)]
        # the farthest point from a random one makes a better vantage point than the random one
        d = distance(points, at, mask)
        vantage = points[int(d.argmax())]
        d = distance(points, vantage, mask)
        counts = np.cumsum(np.bincount(d, minlength=65))[:-1]
        m = int(np.abs(counts - len(points) / 2).argmin())
        balance = min(int(counts[m]), len(points) - int(counts[m]))
        if balance > 0 and (best is None or balance > best[0]):
            best = (balance, vantage, m)
    return None if best is None or best[0] < len(points) // 64 else (best[1], best[2])


def grow(sample: np.ndarray, mask: np.uint64, depth: int, salt: int = 0) -> list:
    """The upper levels: nested [vantage, distance, left, right]; [] is a shard."""
    split = _boundary(sample, mask, salt) if depth and len(sample) > 8 else None
    if split is None:
        return []
    near = distance(sample, split[0], mask) <= split[1]
    return [split[0], split[1], grow(sample[near], mask, depth - 1, 2 * salt + 1), grow(sample[~near], mask, depth - 1, 2 * salt + 2)]


def deal(tree: list, mask: np.uint64, radius: int, points: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, positions in ``points``, whether it is the home shard), for each shard that gets any."""
    out, number = [], 0

    def walk(node: list, at: np.ndarray, home: np.ndarray) -> None:
        nonlocal number
        if not node:
            if len(at):
                out.append((number, at, home))
            number += 1
            return
        vantage, limit, left, right = node
        d = distance(points[at], vantage, mask).astype(np.int16)
        for side, reached, own in ((left, d <= limit + radius, d <= limit), (right, d > limit - radius, d > limit)):
            walk(side, at[reached], home[reached] & own[reached])

    walk(tree, np.arange(len(points)), np.ones(len(points), bool))
    return out


def search(points: np.ndarray, home: np.ndarray, mask: np.uint64, radius: int, full_radius: int, forest: Forest) -> None:
    """Unite all pairs of a home point and any point of the shard within ``full_radius`` bits."""
    todo = [(np.nonzero(home)[0], np.arange(len(points)), mask, radius, 1)]
    while todo:
        own, every, m, r, salt = todo.pop()
        if not len(own):
            continue
        split = _boundary(points[own], m, salt) if len(own) > LEAF else None
        if split is None and len(own) > 4 * LEAF and m != ALL:
            m, r = ALL, full_radius
            split = _boundary(points[own], m, salt)
        if split is not None:
            d_own, d_every = distance(points[own], split[0], m).astype(np.int16), distance(points[every], split[0], m).astype(np.int16)
            near, far = every[d_every <= split[1] + r], every[d_every > split[1] - r]
            if len(near) + len(far) < 1.95 * len(every):  # else the bound prunes next to nothing here
                todo.append((own[d_own <= split[1]], near, m, r, 2 * salt + 1))
                todo.append((own[d_own > split[1]], far, m, r, 2 * salt + 2))
                continue
        step = max(1, (1 << 20) // max(1, len(every)))
        for i in range(0, len(own), step):
            block = own[i : i + step]
            x, y = np.nonzero(distance(points[block][:, None], points[every][None, :]) <= full_radius)
            a, b = block[x], every[y]
            differ = a < b if len(own) == len(every) else a != b
            forest.union(a[differ], b[differ])


def _apart(a: Column | str, b: Column | str, whole: Column | str, mask: Column | str) -> Column:
    """Bits in which two fingerprints differ, within the shard's block or (``whole``) all of them."""
    a, b, whole, mask = (F.col(x) if isinstance(x, str) else x for x in (a, b, whole, mask))
    x = a.bitwiseXOR(b)
    return F.bit_count(F.when(whole, x).otherwise(x.bitwiseAND(mask)))


def grow_further(rows: DataFrame, radius: int, near: int) -> DataFrame:
    """Deal shards of more than ``SHARD_CAP`` rows on, level by level: rows (tree, shard, whole, fp, home) with finer ``shard`` numbers.

    ``whole`` says that a shard's distances are those of all 64 bits. A shard is left as it is when a level in its own distance and one
    in the whole distance would both copy nearly all rows to both sides.
    """
    mask = F.when(F.col("tree") == 0, F.lit(int(BLOCKS[0].view(np.int64)))).when(F.col("tree") == 1, F.lit(int(BLOCKS[1].view(np.int64)))).otherwise(F.lit(int(BLOCKS[2].view(np.int64))))
    reach = F.when(F.col("whole"), F.lit(radius)).otherwise(F.lit(near))
    by = ["tree", "shard"]
    done: list[DataFrame] = []
    level = 0
    open_ = rows.withColumn("stuck", F.lit(False))
    while True:
        level += 1
        sizes = open_.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min_by("fp", F.xxhash64("fp", F.lit(level))).alias("start"), F.max("stuck").alias("was_stuck"))
        large = cut_lineage(sizes.filter((F.col("n") > SHARD_CAP) & ~F.col("was_stuck")).select(*by, "n", "start"))
        if large.isEmpty():
            break
        small = open_.join(large.select(*by), by, "left_anti")
        done.append(small.drop("stuck"))
        mine = cut_lineage(open_.join(large, by).withColumn("mask", mask))
        # the row farthest from a random one is the vantage point; its distances are counted to find the middle
        far = mine.groupBy(*by).agg(F.max_by("fp", F.struct(_apart("fp", "start", "whole", "mask"), "fp")).alias("vantage"))
        told = mine.join(far, by).withColumn("d", _apart("fp", "vantage", "whole", "mask"))
        counts = told.groupBy(*by, "d", "whole").agg(F.count(F.lit(1)).alias("m"))
        up_to = Window.partitionBy(*by).orderBy("d")
        all_ = F.sum("m").over(Window.partitionBy(*by))
        below = counts.select(*by, "d", "whole", "m", F.sum("m").over(up_to).alias("left"), all_.alias("all"))
        # rows that a boundary at d copies: those within the radius of it
        copied = [F.sum("m").over(up_to.rangeBetween(1 - r, r)) if r else F.lit(0) for r in (radius, near)]
        below = below.withColumn("copied", F.when(F.col("whole"), copied[0]).otherwise(copied[1]))
        cost = F.greatest("left", F.col("all") - F.col("left")) + F.col("copied")
        best = below.filter(F.col("left") < F.col("all")).groupBy(*by).agg(F.min_by(F.struct(F.col("d").alias("limit"), ((F.col("all") + F.col("copied")) <= WORTH * F.col("all")).alias("worth")), cost).alias("b"))
        cuts = cut_lineage(far.join(best, by, "left").select(*by, "vantage", "b.limit", F.coalesce("b.worth", F.lit(False)).alias("worth")))
        told = mine.join(cuts, by).withColumn("d", _apart("fp", "vantage", "whole", "mask"))
        split = told.filter("worth")
        side = lambda number, within, own: F.when(within, F.struct((F.col("shard") * 2 + number).alias("shard"), (F.col("home") & own).alias("home")))
        limit, d = F.col("limit"), F.col("d")
        sides = F.filter(F.array(side(0, d <= limit + reach, d <= limit), side(1, d > limit - reach, d > limit)), lambda x: x.isNotNull())
        dealt = split.select("tree", "whole", "fp", F.inline(sides)).select("tree", "shard", "whole", "fp", "home", F.lit(False).alias("stuck"))
        # what its block doesn't split goes on with all 64 bits; what they don't split either stays together
        rest = told.filter("NOT worth").select("tree", (F.col("shard") * 2).alias("shard"), F.lit(True).alias("whole"), "fp", "home", F.col("whole").alias("stuck"))
        open_ = cut_lineage(dealt.unionByName(rest))
    # numbers of finished shards must not meet those of later levels: they carry their level
    finished = [d.withColumn("level", F.lit(i)) for i, d in enumerate([*done, open_.drop("stuck")])]
    return reduce(DataFrame.unionByName, finished)


def linked(prints: DataFrame, column: str, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) of a graph over the distinct non-null fingerprints whose components are those of all pairs within ``radius`` bits."""
    distinct = cut_lineage(prints.select(F.col(column).alias("fp")).distinct())
    n = distinct.count()
    sample = np.array([r[0] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], dtype=np.int64).view(np.uint64)
    depth = min(TOP_LEVELS, max(0, math.ceil(math.log2(max(1, n) / SHARD_ROWS))))
    trees = [grow(sample, mask, depth, k) for k, mask in enumerate(BLOCKS)]
    near = radius // len(BLOCKS)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(0).to_numpy()
            points = raw.view(np.uint64)
            for k, mask in enumerate(BLOCKS):
                for shard, at, home in deal(trees[k], mask, near, points):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(np.full(len(at), shard, np.int64)), pa.array(np.zeros(len(at), bool)), pa.array(raw[at]), pa.array(home)], names=["tree", "shard", "whole", "fp", "home"])

    def searched(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        points = rows["fp"].to_numpy().view(np.uint64)
        # in a split shard a fingerprint may come as home row and as searching row of one cell: united by value
        values, at = np.unique(points, return_inverse=True)
        home = np.zeros(len(values), bool)
        np.logical_or.at(home, at, rows["home"].to_numpy())
        forest = Forest(len(values))
        mask, reach = (ALL, radius) if key[2] else (BLOCKS[int(key[0])], near)
        search(values, home, mask, reach, radius, forest)
        x, r = forest.edges()
        return pd.DataFrame({"a": values[x].view(np.int64), "b": values[r].view(np.int64)})

    rows = distinct.mapInArrow(dealt, "tree int, shard bigint, whole boolean, fp bigint, home boolean")
    sizes = rows.groupBy("tree", "shard").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    by = ["tree", "shard", "whole"]
    if (sizes or 0) > SHARD_CAP:
        rows = grow_further(cut_lineage(rows), radius, near)
        by = [*by, "level"]
        large = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARD_CAP).select(*by, F.ceil(F.col("n") / SHARD_CAP).alias("parts"))
        rows = rows.join(large, by, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        mine = F.pmod(F.xxhash64("fp", F.lit(1)), "parts")
        # home rows go to one part of the homes and every part of the searchers, searchers the other way round
        every = F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)
        homes = rows.filter("home").withColumn("j", F.explode(every)).select(*by, mine.alias("i"), "j", "fp", "home")
        seekers = rows.withColumn("i", F.explode(every)).select(*by, "i", mine.alias("j"), "fp", F.lit(False).alias("home"))
        rows, by = homes.union(seekers), [*by, "i", "j"]
    return shrink(rows.groupBy(*by).applyInPandas(searched, "a bigint, b bigint"))


def rooted(firsts: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``firsts``, one row per distinct fingerprint ``fp``, with the ``root`` of the fingerprint's component."""
    roots = components(linked(firsts, "fp", radius)).withColumnRenamed("node", "fp")
    return cut_lineage(firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))


def groups(prints: DataFrame, key: str, column: str, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component): for each distinct fingerprint the smallest key of all rows in its component."""
    every = rooted(cut_lineage(prints.groupBy(F.col(column).alias("fp")).agg(F.min(F.col(key).cast("long")).alias("first_key"))), radius)
    least = every.groupBy("root").agg(F.min("first_key").alias("component")).select(dealt_anew("root"), "component")
    return every.join(least, "root").select(F.col("fp").alias(column), "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: key, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key that links reach.

    Null and empty texts have fingerprint 0, which links like any other; texts of any length are read whole. Null keys lose against others (a
    component of null keys only has a null id). Repeated rows share a fingerprint. An empty table gives an empty table. Other columns are not carried.
    """
    prints = cut_lineage(with_fingerprint(docs, text, "fp_of_text", shingle, [key]))
    found = groups(prints, key, "fp_of_text", radius)
    hexed = F.lower(F.lpad(F.hex("fp_of_text"), 16, "0"))
    return prints.join(found, "fp_of_text").select(key, hexed.alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the smallest key, of equal keys the smallest SHA-256 of the text.

    Null keys lose against others; a component of null keys only keeps one of them. Equal keys of different components are kept
    each. Rows that repeat both key and text are one document: one of them is kept.
    """
    digest, chosen_key, chosen_digest = (own_name(docs, c) for c in ("digest_of_text", "chosen_key", "chosen_digest"))
    marked = docs.withColumn(digest, F.unhex(F.sha2(text_or_empty(text), 256)))
    prints = cut_lineage(with_fingerprint(marked, text, "fp_of_text", shingle, [key, digest]))
    rank = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).cast("long").alias("number"), F.col(digest).alias("digest"), F.col(key).alias("key"))
    every = rooted(cut_lineage(prints.groupBy(F.col("fp_of_text").alias("fp")).agg(F.min(rank).alias("first"))), radius)
    kept = every.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias(chosen_key), F.col("first.digest").alias(chosen_digest))
    # equal digests are in one component, so that key and digest name the chosen row of one component only
    rows = marked.join(kept, F.col(key).eqNullSafe(F.col(chosen_key)) & (F.col(digest) == F.col(chosen_digest)), "left_semi")
    if prints.groupBy(key, digest).count().filter("count > 1").head(1):
        rows = rows.dropDuplicates([key, digest])
    return rows.select(*docs.columns)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
