"""Sharding, mixing, exact dedup: laws that must hold, brute force on small tables, odd inputs."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidewell.llm import exact_dedup, mixing, sharding
from tidewell.llm.exact_dedup import Bucket, CuckooFilter, CuckooIndex

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark, n=120):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["ab", "c", "déf", "\t"]) for _ in range(r.randrange(9))), "en", r.choice(["s1", "s2", "é", None, "s1"]), 1) for i in range(n)]
    rows += [(None, "x y", None, None, None), (None, None, None, "s1", None), (7, rows[7][1], "en", rows[7][3], 1), (1000, "same text", "en", "s1", 1), (1001, "same text", "en", "s2", 1), (1002, "long " * 50_000, "en", "s2", 1), (1003, None, "en", "s9", 1), (1004, "", "en", "s9", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_shards_move_only_into_the_new_one(spark):
    docs = odd_documents(spark).withColumn("cell_hi", F.lit("mine"))
    now = sharding.assign_shards(docs, "doc_id", dict.fromkeys(range(8), 1.0))
    both = sharding.assign_shards(now, "doc_id", dict.fromkeys(range(9), 1.0), "grown")
    rows = sharding.number_slots(both, "doc_id").collect()
    assert all(r["grown"] in (r["shard"], 8) and r["cell_hi"] == "mine" for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == docs.count()
    assert sharding.number_slots(sharding.assign_shards(empty(spark), "doc_id", {0: 1.0}), "doc_id").count() == 0


def test_shards_keep_clashing_columns_and_spread_null_keys(spark):
    df = spark.createDataFrame([(None, i, "a", "b") for i in range(300)], "doc_id long, size int, shard string, slot string")
    rows = sharding.number_slots(sharding.assign_shards(df, "doc_id", {0: 1.0}), "doc_id", "_shard", ties=("size",)).collect()
    assert sorted(r["_slot"] for r in rows) == list(range(300)) and {(r["shard"], r["slot"]) for r in rows} == {("a", "b")}


def test_sharding_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()

    def wins(key, shards):
        u = lambda s: (int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return max((-1 / math.log(u(s)), s) for s in range(shards))[1]

    want = {r["doc_id"]: (len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()), "key", wins(r["doc_id"], 8), wins(r["doc_id"], 9)) for r in docs}
    got = sharding.op1(spark, SF).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got} == want and len(got) == len(docs)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_follow_weights(spark):
    counts = dict(sharding.assign_shards(spark.range(20000), "id", {0: 1.0, 1: 3.0}).groupBy("shard").count().collect())
    assert 0.72 < counts[1] / 20000 < 0.78
    with pytest.raises(ValueError):
        sharding.assign_shards(spark.range(1), "id", {0: 0.0})


def test_mix_shares_the_budget(spark):
    docs = odd_documents(spark)
    rows = mixing.mix(docs, mixing.words()).collect()
    assert len(rows) == docs.count()
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        size[r["source"]] += r["mix_size"]
        target[r["source"]] = r["mix_target"]
        taken[r["source"]] += r["mix_taken"]
        assert r["mix_taken"] <= 2 * r["mix_size"]
    total = sum(size.values())
    assert sum(target.values()) == pytest.approx(1.5 * total)
    assert all(target[s] <= 2 * size[s] + 1e-6 for s in size)
    assert sum(taken.values()) <= 1.5 * total
    again = mixing.mix(docs.repartition(7), mixing.words()).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["mix_taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mix(empty(spark), mixing.words()).count() == 0
    clashing = mixing.mix(docs.withColumns({"Mix_size": F.lit(1), "Size": F.lit(2), "_mix_hi": F.lit(3), "key": F.lit(4)}), mixing.words())
    assert clashing.columns == [*docs.columns, "Mix_size", "Size", "_mix_hi", "key", "_mix_size", "mix_source_size", "mix_target", "mix_repeats", "mix_taken"]
    assert sorted(map(key, clashing.collect())) == sorted(map(key, rows))


def test_mix_targets_on_even_documents(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"), F.lit("a b c").alias("text"))
    got = {r["source"]: (r["t"], r["n"]) for r in mixing.mix(docs, mixing.words()).groupBy("source").agg(F.max("mix_target").alias("t"), F.sum("mix_taken").alias("n")).collect()}
    for t, n in got.values():
        assert abs(t - n) <= 6
    assert got["s0"][0] == 12000  # its weight asks for more than twice its size
    kept = mixing.repeat_rows(docs, mixing.mix(docs, mixing.words()))
    assert kept.columns == docs.columns and kept.count() == 9000


def test_cuckoo_filter_has_no_false_negatives():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    b = Bucket()
    for d in digests:
        b.insert(d, 1, 1)
    assert all(d in b.filter for d in digests) and len(b.filter.cells) > 5000
    for d in digests[:4000]:
        b.replace(d, 0, None)
    assert all(d in b.filter for d in digests[4000:]) and len(b.content) == 1000
    assert sum(hashlib.sha256(f"x{i}".encode()).digest() in b.filter for i in range(5000)) < 50
    f = CuckooFilter(2)
    assert not all(f.add(d) for d in digests)


def summed(marked):
    return {bytes(r["digest"]): (r["n"], r["k"]) for r in marked.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("k")).collect()}


def test_index_over_batches(spark, tmp_path, monkeypatch):
    docs = odd_documents(spark)
    marked = exact_dedup.digested(docs, "text")
    first, second = (marked.filter(F.coalesce("doc_id", F.lit(0)) % 2 == k) for k in (0, 1))
    index = CuckooIndex(spark, 16)
    assert index.live().count() == 0 and index.counters()["hits"] == 0
    index.insert(exact_dedup.combine(first, "doc_id", "digest"))
    index.save(str(tmp_path / "index"))
    index = CuckooIndex.load(spark, str(tmp_path / "index"))
    index.insert(exact_dedup.combine(second, "doc_id", "digest"))
    live = lambda: {bytes(r["digest"]): (r["copies"], r["keep_id"]) for r in index.live().collect()}
    assert live() == summed(marked)
    shared = summed(first).keys() & summed(second).keys()
    assert index.counters()["hits"] >= len(shared) > 0
    monkeypatch.setattr(exact_dedup, "KEYS_PER_BUCKET", 1)
    index.insert(exact_dedup.combine(first.limit(0), "doc_id", "digest"))
    assert index.buckets > 16 and live() == summed(marked)  # dealt anew from the stored digests


@pytest.mark.parametrize("seed", range(2))
def test_deletion_keeps_the_largest_key_that_is_left(spark, tmp_path, seed):
    r = random.Random(seed)
    index, held = CuckooIndex(spark, 16), Counter()
    for batch in range(4):
        rows = [(f"text {r.randrange(8)}", r.choice([None, *range(12)]), r.choice([1, 1, -1]) if batch else 1) for _ in range(40)]
        if batch == 2:  # the largest key of every text goes
            rows += [(t, k, -n) for (t, k), n in held.items() if k == max((x for y, x in held if y == t and x is not None), default=None)]
        for t, k in {(t, k) for t, k, _ in rows}:
            held[t, k] = max(0, held[t, k] + sum(n for x, y, n in rows if (x, y) == (t, k)))
        held = +held
        docs = exact_dedup.digested(spark.createDataFrame(rows, "text string, doc_id long, n long"), "text")
        r.shuffle(rows)
        signed = exact_dedup.changes(docs.filter("n > 0"), "doc_id", "digest").unionByName(exact_dedup.changes(docs.filter("n < 0"), "doc_id", "digest", -1))
        index.change(signed if batch != 2 else docs.select("digest", F.col("doc_id").alias("keep_id"), F.col("n").alias("copies")))
        want = {}
        for (t, k), n in held.items():
            d = hashlib.sha256(t.encode()).digest()
            copies, keep = want.get(d, (0, None))
            want[d] = copies + n, k if keep is None else max(keep, k if k is not None else keep)
        assert {bytes(x["digest"]): (x["copies"], x["keep_id"]) for x in index.live().collect()} == want
        index.save(str(tmp_path / f"index{batch}"))
        index = CuckooIndex.load(spark, str(tmp_path / f"index{batch}"))
    with pytest.raises(ValueError):
        index.insert(exact_dedup.combine(docs, "doc_id", "digest"))


def test_repeats_meet_in_the_index(spark):
    docs = spark.createDataFrame([(i, f"text {i % 40}") for i in range(400)], "doc_id long, text string").repartition(4)
    index = exact_dedup.indexed(exact_dedup.digested(docs, "text"), "doc_id", "digest")
    arrived = exact_dedup.combine(exact_dedup.digested(docs, "text"), "doc_id", "digest").count()
    # every row but a text's first is a hit that the content confirms, in its task or in the index
    assert index.counters()["hits"] == 360 and 40 < arrived < 400
    assert {(r["copies"], r["keep_id"]) for r in index.live().collect()} == {(10, 360 + i) for i in range(40)}


def test_the_query_looks_up_its_repeats(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    marked = exact_dedup.digested(docs, "text")
    assert exact_dedup.indexed(marked, "doc_id", "digest").counters()["hits"] == docs.count() - marked.select("digest").distinct().count() > 0


def test_one_row_of_equal_texts_stays(spark):
    docs = odd_documents(spark).withColumn("digest", F.lit(1)).withColumn("Dedup_keep", F.lit("mine"))
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    for r in exact_dedup.resolve(docs).collect():
        ids = [i for i in groups[r["text"] or ""] if i is not None]
        assert r["_dedup_keep"] == (max(ids) if ids else None) and r["dedup_copies"] == len(groups[r["text"] or ""])
        assert bytes(r["dedup_digest"]) == hashlib.sha256((r["text"] or "").encode()).digest()
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["text"] or "" for r in kept.collect()) == sorted(groups)
    assert exact_dedup.keep_one(empty(spark)).count() == 0
