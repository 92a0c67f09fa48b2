"""Exact deduplication through a cuckoo-filter index.

The index holds the digests (SHA-256) of all live texts, in buckets by the digest's leading bits. Each bucket keeps

* a cuckoo filter: buckets of four 16-bit fingerprints, two places per digest, which takes insertions and deletions, and
* its content: every live digest with its number of copies and the key that stays.

Map tasks look up every row in a bucket of their own first: repeats hit its filter, are verified and merged there, so a text with a third of
all rows leaves a task as one row for each ``HELD`` distinct texts. What different tasks found meets in the index's buckets: each incoming digest is looked
up in the filter; a hit is verified against the content and merged with it (a false positive is inserted as new), a miss is inserted. When an
insertion finds no place, the filter is doubled and rebuilt from the stored digests.

An index that takes deletions also has a table of its keys: digest, key, copies. A batch of changes counts by its net effect, whatever the order of its
rows, and no key falls below none. The digests that a batch touches then get their copies and the largest key that is left
from that table by an aggregate (no task sees all keys of a text), and the buckets take them in: a digest with none left is
deleted and its fingerprint removed.

The state is a table: written in the shared folder after every batch, so that it has no lineage, and dealt to more buckets from the stored digests
when they hold more than twice ``KEYS_PER_BUCKET`` on average.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut_lineage, own_name, table, text_or_empty

KEYS_PER_BUCKET = 4096
SLOTS, MAX_KICKS = 4, 200
#: Distinct texts that a map task holds before it hands them on.
HELD = 32_768


class CuckooFilter:
    """A cuckoo filter over digests of at least 16 random bytes; ``add`` returns False when it is too full."""

    def __init__(self, capacity: int, cells: array | None = None):
        rows = 1 << max(1, math.ceil(math.log2(max(1, capacity) / (SLOTS * 0.85))))
        self.cells = cells if cells is not None else array("H", bytes(2 * SLOTS * rows))
        self.mask = len(self.cells) // SLOTS - 1

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "big") or 1
        first = int.from_bytes(digest[10:18], "big") & self.mask
        return mark, first, self._other(mark, first)

    def _other(self, mark: int, place: int) -> int:
        return (place ^ (mark * 0x5BD1E995)) & self.mask

    def _put(self, mark: int, place: int) -> bool:
        for i in range(place * SLOTS, place * SLOTS + SLOTS):
            if not self.cells[i]:
                self.cells[i] = mark
                return True
        return False

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.cells[a * SLOTS : a * SLOTS + SLOTS] or mark in self.cells[b * SLOTS : b * SLOTS + SLOTS]

    def add(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        if self._put(mark, a) or self._put(mark, b):
            return True
        place = b
        for kick in range(MAX_KICKS):
            i = place * SLOTS + (mark + kick) % SLOTS
            mark, self.cells[i] = self.cells[i], mark
            place = self._other(mark, place)
            if self._put(mark, place):
                return True
        return False

    def remove(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for place in (a, b):
            for i in range(place * SLOTS, place * SLOTS + SLOTS):
                if self.cells[i] == mark:
                    self.cells[i] = 0
                    return True
        return False


class Bucket:
    """One bucket of the index: filter and content, kept in step."""

    def __init__(self, cells: bytes | None = None, content: dict | None = None, room: int = 64):
        self.content: dict[bytes, list] = content or {}
        self.hits = self.false_hits = self.resizes = 0
        if cells is None:
            self.filter = CuckooFilter(room)
            for d in self.content:
                self._mark(d)
        else:
            self.filter = CuckooFilter(0, array("H", cells))

    def _mark(self, digest: bytes) -> None:
        if self.filter.add(digest):
            return
        room = max(len(self.content), 1)
        self.resizes += 1
        while True:  # rebuild from the stored digests; ``digest`` is one of them
            room = max(2 * room, 2 * len(self.filter.cells))
            self.filter = CuckooFilter(room)
            if all(self.filter.add(d) for d in self.content):
                return

    def _verified(self, digest: bytes) -> list | None:
        """The content of a digest that the filter holds; a hit that the content doesn't know is false."""
        if digest not in self.filter:
            return None
        known = self.content.get(digest)
        self.hits += known is not None
        self.false_hits += known is None
        return known

    def insert(self, digest: bytes, copies: int, keep: int | None) -> None:
        known = self._verified(digest)
        if known is None:
            self.content[digest] = [copies, keep]
            self._mark(digest)
            return
        known[0] += copies
        if keep is not None and (known[1] is None or keep > known[1]):
            known[1] = keep

    def replace(self, digest: bytes, copies: int, keep: int | None) -> None:
        """What is live of a digest now; no copies: nothing."""
        known = self._verified(digest)
        if known is not None and copies:
            known[:] = [copies, keep]
        elif known is not None:
            del self.content[digest]
            self.filter.remove(digest)
        elif copies:
            self.content[digest] = [copies, keep]
            self._mark(digest)


STATE = "bucket long, digest binary, copies long, keep_id long, cells binary, hits long, false_hits long, resizes long"
COLUMNS = [c.split()[0] for c in STATE.split(", ")]


def _state(bucket: int, b: Bucket) -> pd.DataFrame:
    rows = [(bucket, d, n, k, None, None, None, None) for d, (n, k) in b.content.items()]
    out = pd.DataFrame([*rows, (bucket, None, None, None, b.filter.cells.tobytes(), b.hits, b.false_hits, b.resizes)], columns=COLUMNS)
    return out.astype(dict.fromkeys(("copies", "keep_id", "hits", "false_hits", "resizes"), "Int64"))


def _number(x: object) -> int | None:
    return None if pd.isna(x) else int(x)


def _load(state: pd.DataFrame) -> Bucket:
    held = state[state["digest"].notna()]
    content = {bytes(d): [int(n), _number(k)] for d, n, k in zip(held["digest"], held["copies"], held["keep_id"], strict=True)}
    filters = state[state["cells"].notna()]
    b = Bucket(bytes(filters["cells"].iloc[0]) if len(filters) else None, content)
    if len(filters):
        b.hits, b.false_hits, b.resizes = (int(filters[c].iloc[0]) for c in ("hits", "false_hits", "resizes"))
    return b


def _apply(b: Bucket, batch: pd.DataFrame) -> Bucket:
    for d, n, k, hits, whole in zip(batch["digest"], batch["copies"], batch["keep_id"], batch["hits"], batch["whole"], strict=True):
        (b.replace if whole else b.insert)(bytes(d), int(n), _number(k))
        b.hits += int(hits)
    return b


def _update(key: tuple, state: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    return _state(int(key[0]), _apply(_load(state), batch))


def _first(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
    return _state(int(key[0]), _apply(Bucket(), batch))


def _deal(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
    return _state(int(key[0]), _load(held))


def digested(docs: DataFrame, text: str, name: str = "digest") -> DataFrame:
    return docs.withColumn(name, F.unhex(F.sha2(text_or_empty(text), 256)))


def combine(docs: DataFrame, key: str, digest: str) -> DataFrame:
    """Digest, ``copies``, the largest key, and ``hits``, the rows that were found in the task's own bucket: no shuffle, and a digest may come again from
    another task."""

    def handed_on(b: Bucket) -> pa.RecordBatch:
        digests, held = list(b.content), list(b.content.values())
        columns = [pa.array(digests, pa.binary()), *[pa.array(x, pa.int64()) for x in ([n for n, _ in held], [k for _, k in held], [n - 1 for n, _ in held])]]
        return pa.RecordBatch.from_arrays(columns, names=["digest", "copies", "keep_id", "hits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bucket()
        for b in batches:
            for d, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own.insert(d, 1, k)
                if len(own.content) >= HELD:
                    yield handed_on(own)
                    own = Bucket()
        yield handed_on(own)

    rows = docs.select(F.col(digest).alias("digest"), F.col(key).cast("long").alias("keep_id"))
    return rows.mapInArrow(run, "digest binary, copies long, keep_id long, hits long")


def changes(docs: DataFrame, key: str, digest: str, copies: int = 1) -> DataFrame:
    """Rows to insert into an index that takes deletions (``copies`` below 0: to delete from it)."""
    return docs.select(F.col(digest).alias("digest"), F.col(key).cast("long").alias("keep_id"), F.lit(copies).cast("long").alias("copies"))


class CuckooIndex:
    """The index over successive batches. ``state`` is a DataFrame with one row per live digest and one per bucket's filter.

    ``buckets``, a power of two, is how many there are at first. Null texts count as empty; null keys lose against any other key of
    their group. An empty batch changes nothing. Deleting what isn't held changes nothing. ``insert`` adds to an index that is only added to; ``change``
    takes insertions and deletions, and keeps ``keys`` for them. An index is used in one of these ways.
    """

    def __init__(self, spark: SparkSession, buckets: int, state: DataFrame | None = None, keys: DataFrame | None = None):
        if buckets & (buckets - 1):
            raise ValueError("buckets must be a power of two")
        self.spark, self.buckets, self.state, self.keys = spark, buckets, state, keys

    @staticmethod
    def buckets_for(rows: int) -> int:
        return 1 << max(4, math.ceil(math.log2(max(1, rows) / KEYS_PER_BUCKET)))

    def _bucketed(self, digests: DataFrame) -> DataFrame:
        lead = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
        return digests.withColumn("bucket", lead % self.buckets)

    def insert(self, combined: DataFrame) -> None:
        """Add what ``combine`` gives."""
        if self.keys is not None:
            raise ValueError("an index that takes deletions is changed by `change`")
        self._take(combined.select("digest", "copies", "keep_id", "hits", F.lit(False).alias("whole")))

    def change(self, rows: DataFrame) -> None:
        """Insert and delete rows of digest, keep_id and copies (below 0: deleted), by their net effect."""
        if self.keys is None and self.state is not None:
            raise ValueError("an index made by `insert` has no keys to delete by")
        # few rows against many: only touched digests leave the table of keys for the buckets
        net = rows.groupBy("digest", "keep_id").agg(F.sum("copies").alias("copies"))
        net = cut_lineage(net)
        both = net if self.keys is None else self.keys.unionByName(net)
        self.keys = cut_lineage(both.groupBy("digest", "keep_id").agg(F.sum("copies").alias("copies")).filter("copies > 0"))
        touched = net.select("digest").distinct()
        left = self.keys.join(touched, "digest", "left_semi").groupBy("digest").agg(F.sum("copies").alias("copies"), F.max("keep_id").alias("keep_id"))
        now = touched.join(left, "digest", "left").withColumn("copies", F.coalesce("copies", F.lit(0)))
        self._take(now.select("digest", "copies", "keep_id", F.lit(0).cast("long").alias("hits"), F.lit(True).alias("whole")))

    def _take(self, rows: DataFrame) -> None:
        batch = self._bucketed(rows)
        if self.state is None:  # nothing is stored yet: no state to bring together with the batch
            after = batch.groupBy("bucket").applyInPandas(_first, STATE)
        else:
            after = self.state.groupBy("bucket").cogroup(batch.groupBy("bucket")).applyInPandas(_update, STATE)
        self.state = cut_lineage(after)
        held = self.live().count()
        if held > 2 * KEYS_PER_BUCKET * self.buckets:
            self.rebucket(self.buckets_for(held))

    def rebucket(self, buckets: int) -> None:
        """Deal the stored digests to so many buckets; every filter is built anew from them."""
        self.buckets = buckets
        held = self._bucketed(self.state.filter("digest IS NOT NULL").drop("bucket")).select(*COLUMNS)
        self.state = cut_lineage(held.groupBy("bucket").applyInPandas(_deal, STATE))

    def live(self) -> DataFrame:
        """Digest, copies, keep_id of all live texts."""
        if self.state is None:
            return self.spark.createDataFrame([], "digest binary, copies long, keep_id long")
        return self.state.filter(F.col("digest").isNotNull()).select("digest", "copies", "keep_id")

    def counters(self) -> dict[str, int]:
        """Hits that the content confirmed, hits that it refused, and filters rebuilt, since the last ``rebucket``."""
        names = ("hits", "false_hits", "resizes")
        if self.state is None:
            return dict.fromkeys(names, 0)
        r = self.state.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
        return {c: r[c] for c in names}

    def save(self, path: str) -> None:
        self.state.withColumn("buckets", F.lit(self.buckets)).write.mode("overwrite").parquet(f"{path}/state")
        if self.keys is not None:
            self.keys.write.mode("overwrite").parquet(f"{path}/keys")

    @staticmethod
    def load(spark: SparkSession, path: str) -> CuckooIndex:
        state, keys = spark.read.parquet(f"{path}/state"), spark._jvm.org.apache.hadoop.fs.Path(f"{path}/keys")
        has_keys = keys.getFileSystem(spark._jsc.hadoopConfiguration()).exists(keys)
        return CuckooIndex(spark, state.agg(F.max("buckets")).first()[0] or 16, state.drop("buckets"), spark.read.parquet(f"{path}/keys") if has_keys else None)


def indexed(marked: DataFrame, key: str, digest: str) -> CuckooIndex:
    """The index of all rows of ``marked``."""
    index = CuckooIndex(marked.sparkSession, CuckooIndex.buckets_for(marked.count()))
    index.insert(combine(marked, key, digest))
    return index


def resolve(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``dedup_digest``, ``dedup_keep`` (key of the row that stays), ``dedup_copies``.

    Texts are equal when identical; null is the empty text; texts of any length are read whole, by their digest. Of equal texts the row with the
    largest key stays; if all keys of a group are null, ``dedup_keep`` is null. Rows that repeat key and text count as copies and share their
    fate. An empty table gives an empty table. Where ``docs`` has such a column, the new one is named with underscores before it.
    """
    digest, keep, copies = (own_name(docs, n) for n in ("dedup_digest", "dedup_keep", "dedup_copies"))
    marked = digested(docs, text, digest)
    live = indexed(marked, key, digest).live()
    return marked.join(live.select(F.col("digest").alias(digest), F.col("keep_id").alias(keep), F.col("copies").alias(copies)), digest)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``.

    Rows that repeat both key and text are one document: one of them is kept.
    """
    digest, keep = own_name(docs, "dedup_digest"), own_name(docs, "dedup_keep")
    resolved = resolve(docs, key, text)
    kept = resolved.filter(F.col(key).cast("long").eqNullSafe(F.col(keep)))
    if docs.groupBy(key).count().filter("count > 1").head(1):
        kept = kept.dropDuplicates([key, digest])
    return kept.select(*docs.columns)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resolve(docs).select(
        "doc_id",
        F.col("dedup_keep").alias("keep_id"),
        F.col("dedup_copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("dedup_keep")).alias("kept"),
        F.lower(F.hex("dedup_digest")).alias("text_sha256"),
    )


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
