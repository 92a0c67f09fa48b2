"""SimHash with vantage-point trees, HNSW vectors, components, license scans: brute force on small tables."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_rows import empty, odd_documents
from tidewell.llm import hnsw, licenses, simhash
from tidewell.llm.components import Forest, components, shrink


def roots(n, pairs):
    f = Forest(n)
    a, b = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.array([], np.int64),) * 2
    f.union(a, b)
    return f.roots(np.arange(n))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)] + [(500, 500 + i) for i in range(60)]
    got = dict(components(shrink(spark.createDataFrame(pairs, "a long, b long"))).collect())
    want = roots(600, pairs)
    assert all(got.get(i, i) == want[i] for i in range(600))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b c", "a b c d e f", "É a\x0bB  ÄB\x85c d", "w " * 40_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_trees_find_all_pairs():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 2**63, 4000, dtype=np.int64).view(np.uint64)
    ball = np.full(1500, points[0])
    for _ in range(3):
        ball ^= np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)
    points = np.unique(np.concatenate([points, ball, points[:500] ^ np.uint64(0b10001)]))
    want = Forest(len(points))
    for i in range(0, len(points), 500):
        x, y = np.nonzero(simhash.distance(points[i : i + 500, None], points[None, :]) <= 4)
        want.union(x + i, y)
    got = Forest(len(points))
    for k, mask in enumerate(simhash.BLOCKS):
        for _, at, home in simhash.deal(simhash.grow(points[::7], mask, 3, k), mask, 1, points):
            f = Forest(len(at))
            simhash.search(points[at], home, mask, 1, 4, f)
            x, r = f.edges()
            got.union(at[x], at[r])
    every = np.arange(len(points))
    assert (got.roots(every) == want.roots(every)).all()


@pytest.mark.parametrize("cap", [65536, 40])
def test_near_duplicates(spark, monkeypatch, cap):
    monkeypatch.setattr(simhash, "SHARD_CAP", cap)  # a small cap splits shards into cells
    monkeypatch.setattr(simhash, "SHARD_ROWS", 32)
    docs = odd_documents(spark, 150).filter("doc_id IS NOT NULL").withColumn("fp_of_text", F.lit("clash"))
    rows = docs.collect()
    prints = [slow_fingerprint(r["text"]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = roots(len(rows), pairs)
    least = {}
    for r, w in zip(rows, want, strict=True):
        least[w] = min(least.get(w, 1 << 60), r["doc_id"])
    expected = sorted((r["doc_id"], f"{p:016x}", least[w]) for r, p, w in zip(rows, prints, want, strict=True))
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())


def test_near_duplicates_without_rows_or_keys(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0
    assert simhash.near_duplicates(odd_documents(spark)).count() == odd_documents(spark).count()


def test_one_row_of_each_component_stays(spark):
    r = random.Random(8)
    one, two, three, four, five = (" ".join(r.choice("abcdefghijklmnop") * 3 for _ in range(40)) for _ in range(5))
    rows = [(None, one), (None, two), (None, two), (7, three), (7, four), (7, four), (9, five), (3, five), (None, five)]
    rows += [(7, one)]  # a smaller key than null in the component of ``one``
    kept = simhash.keep_one(spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, source string"))
    assert kept.columns == ["doc_id", "text", "source"]
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept.collect()) == sorted([(7, one), (0, two), (7, three), (7, four), (3, five)])


def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 16))
    near = x[:120] + rng.normal(scale=0.05, size=(120, 16))
    blob = x[0] + rng.normal(scale=0.08, size=(90, 16))
    every = [v.astype(np.float32).tolist() for v in np.vstack([x, near, blob, x[5:9], x[5:6], x[5:6]])]
    every += [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    return spark.createDataFrame(list(enumerate(every)), "vec_id long, embedding array<float>").withColumn("rep", F.lit(0)), every


@pytest.mark.parametrize("beam, recall", [(24, 0.99), (8, 0.99), (8, 2.0)])
def test_vectors(spark, monkeypatch, beam, recall):
    monkeypatch.setattr(hnsw, "BEAM", beam)  # a narrow beam fills up: the exact way must give the rest
    monkeypatch.setattr(hnsw, "RECALL", recall)  # more than all: the audit fails at every width, shards are scanned
    df, every = vectors(spark)
    classes = hnsw.classes_of(df, "vec_id", "embedding")
    audited = hnsw.audited_beam(classes, hnsw.graphs_of(classes, 3))
    assert set(audited) == {2, 16} and all((width == 0) == (recall > 1) for width, _ in audited.values())
    usable = [v if v and all(c is not None and np.isfinite(c) for c in v) and any(v) else None for v in every]
    n = len(every)
    pairs = []
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and len(usable[i]) == len(usable[j]):
                a, b = np.array(usable[i], dtype=float), np.array(usable[j], dtype=float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    pairs.append((i, j))
    degree = np.bincount(np.array(pairs).ravel(), minlength=n)
    want = roots(n, pairs)
    got = sorted(map(tuple, hnsw.near_duplicates(df).collect()))
    assert got == [(i, degree[i], want[i], i == want[i]) for i in range(n)]


def test_no_vectors(spark):
    df, _ = vectors(spark)
    assert hnsw.near_duplicates(df.limit(0)).count() == 0
    assert hnsw.near_duplicates(df.filter("embedding IS NULL")).collect()[0]["n_links"] == 0


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24))
    g = hnsw.Graph.build(x)
    q = hnsw.unit(x[:200]).astype(np.float32)
    ids, _ = g.search(q, 64)
    exact = np.argsort(-(q @ hnsw.unit(x).astype(np.float32).T), axis=1)[:, :10]
    found = g.order[np.maximum(ids, 0)]
    assert np.mean([len(set(e) & set(f)) for e, f in zip(exact, found, strict=True)]) >= 9
    again, _ = hnsw.Graph.load(g.dump(x))
    assert (again.search(q, 64)[0] == ids).all()


def words_of(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


@pytest.mark.parametrize("anchored", [200, 0])
def test_license_scan(spark, monkeypatch, anchored):
    monkeypatch.setattr(licenses, "MAX_ANCHORED", anchored)  # 0: every text is read
    r = random.Random(2)
    templates = [(a, b, c) for a, b, c in licenses.TEMPLATES]
    filler = lambda n: " ".join(r.choice(["lorem", "license", "of", "the", "software", "work"]) for _ in range(n))
    texts = [None, "", "one two", "license " * 30_000, *[c for _, _, c in templates]]
    for _, _, c in templates * 4:
        w = c.split()
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = "changed"
        texts.append(filler(r.randrange(60)) + " " + " ".join(w).upper() + "\n" + filler(r.randrange(60)))
    for _, _, c in templates * 3:  # a passage put in
        w = c.split()
        at = r.randrange(len(w))
        texts.append(filler(r.randrange(40)) + " " + " ".join([*w[:at], *filler(r.randrange(max(2, len(w) // 2))).split(), *w[at:]]) + " " + filler(r.randrange(40)))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, templates[0][2], "x")], "doc_id long, text string, held string")
    got = {(x["doc_id"], x["template_id"]): x["containment"] for x in licenses.scan(docs, licenses.default_templates(spark)).collect()}
    shingles = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    want = {}
    for i, t in [*enumerate(texts), (None, templates[0][2])]:
        held = shingles(words_of(t))
        for name, _, c in templates:
            own = set(shingles(words_of(c)))
            n, step = len(own), max(1, len(own) // 4)
            best = max((len(own & set(held[k : k + 2 * n])) / n for k in range(0, len(held), step)), default=0)
            if best >= 0.8:
                want[i, name] = best
    assert got == pytest.approx(want) and len(want) > 100 and (None, templates[0][0]) in got  # every window that holds a template is found
    nameless = spark.createDataFrame([(None, c) for _, _, c in templates[:2] * 2], "doc_id long, text string")
    assert licenses.scan(nameless, licenses.default_templates(spark)).count() >= 4  # rows without a key are documents of their own
    assert licenses.scan(docs.limit(0), licenses.default_templates(spark)).count() == 0
    assert licenses.scan(docs, licenses.default_templates(spark).limit(0)).count() == 0


def test_license_scan_stays_in_the_jvm(spark):
    plan = licenses.op10(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
