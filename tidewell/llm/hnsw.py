"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one class first (their number counts in the links), so a hot vector is one node. Classes are dealt to shards by hash;
each shard's graph is built by one task, every class queries the graph of every shard, and pairs are verified by cosine
in double precision. A query whose beam is full of vectors within the threshold may have more of them in that shard than the
beam holds: it scans the shard exactly. The beam's width starts small and is doubled until an audit passes: for a bounded sample of classes of each
vector length, and a copy of each that is moved until it only just links, all links to all classes of that length are counted exactly, and
the graphs must give nearly all of them. If the widest beam fails too, every query of that length scans every shard exactly.

Graphs: node order is a fixed permutation, level k holds its first n / 16^k nodes, nodes are inserted in waves that double up to a
limit, neighbours are chosen by the usual diversity rule (nearer to the node than to any chosen neighbour, then filled up
with the nearest). Queries step through a level together, in blocks, as arrays.

Every query meets every shard, so what is moved grows with vectors x shards; shards and query blocks are sized in bytes, as large as a task may hold
(``SHARD_BYTES``, ``QUERY_BYTES``), which divides both.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import Forest, components, shrink
from .shared import cut_lineage, table

THRESHOLD = 0.95
#: Shards at least (fewer for few vectors), bytes of vectors in a shard and in a query block on average.
SHARDS, SHARD_LEAST, SHARD_BYTES, QUERY_BYTES = 6, 2048, 48 << 20, 32 << 20
#: Neighbours on upper levels and on the lowest, beam while building, first beam of queries and the widest tried (beyond it: exactly), sampled
#: classes of each vector length, recall of links asked for.
M, M0, BUILD_BEAM, BEAM, WIDEST, AUDIT, RECALL = 12, 24, 28, 8, 768, 400, 0.99
FANOUT, WAVE, AT_ONCE, FLAT = 16, 1024, 3, 2048


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _beam(links: np.ndarray, vectors: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes found for each query from its entries: ids (-1: none) and similarities, best first."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    stride = len(links) + 1
    visited = np.zeros(n * stride, bool)  # a row per query; its last place stands for "no node"
    visited[stride - 1 :: stride] = True
    ids = np.full((n, width), -1, np.int32)
    entries = entries.astype(np.int32)
    sims = np.full((n, width), -np.inf, np.float32)
    open_ = np.zeros((n, width), bool)

    def offer(at: np.ndarray, nodes: np.ndarray) -> None:
        nodes = np.sort(nodes, axis=1)
        place = nodes + (at * stride)[:, None]
        fresh = ~visited.take(place)
        fresh[:, 1:] &= nodes[:, 1:] != nodes[:, :-1]
        visited[place] = True
        new = np.flatnonzero(fresh)
        s = np.full(nodes.size, -np.inf, np.float32)
        s[new] = np.einsum("ij,ij->i", vectors.take(nodes.take(new), axis=0), queries.take(at.take(new // nodes.shape[1]), axis=0))
        all_s = np.hstack([sims[at], s.reshape(nodes.shape)])
        all_i, all_o = np.hstack([ids[at], nodes]), np.hstack([open_[at], fresh])
        if all_s.shape[1] > width:
            top = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
            top += (np.arange(len(at)) * all_s.shape[1])[:, None]
            all_s, all_i, all_o = all_s.take(top), all_i.take(top), all_o.take(top)
        sims[at, : all_s.shape[1]], ids[at, : all_s.shape[1]], open_[at, : all_s.shape[1]] = all_s, all_i, all_o

    offer(np.arange(n), entries)
    live = np.arange(n)
    take = min(AT_ONCE, width)
    while len(live):
        waiting = np.where(open_[live], sims[live], -np.inf)
        best = np.argpartition(-waiting, take - 1, axis=1)[:, :take]
        k = np.arange(len(live))[:, None]
        usable = waiting[k, best] > -np.inf
        go = usable.any(1)
        live, best, usable = live[go], best[go], usable[go]
        if not len(live):
            break
        nodes = ids[live[:, None], best]
        open_[live[:, None], best] = False
        around = np.where(usable[:, :, None], links[np.where(usable, nodes, 0)], -1).reshape(len(live), -1)
        offer(live, np.where(around < 0, np.int32(len(links)), around))
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = ids[rows, order], sims[rows, order]
    ids[sims == -np.inf] = -1
    return ids, sims


def _choose(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours of each row from candidates sorted by similarity (-1: none), by the diversity rule."""
    n, c = ids.shape
    out = np.full((n, most), -1, np.int32)
    step = max(1, (1 << 22) // max(1, c * c))
    for i in range(0, n, step):
        part, ps = ids[i : i + step], sims[i : i + step]
        v = vectors[np.maximum(part, 0)]
        between = np.matmul(v, v.transpose(0, 2, 1))
        chosen = np.zeros(part.shape, bool)
        nearest = np.full(part.shape, -np.inf, np.float32)  # of each candidate to the chosen ones
        count = np.zeros(len(part), np.int64)
        for j in range(c):
            good = (part[:, j] >= 0) & (ps[:, j] > nearest[:, j]) & (count < most)
            chosen[:, j] = good
            count += good
            np.maximum(nearest, np.where(good[:, None], between[:, :, j], -np.inf), out=nearest)
        rank = np.where(part < 0, 3 * c, np.where(chosen, 0, c) + np.arange(c)[None, :])
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        k = np.arange(len(part))[:, None]
        out[i : i + step, : order.shape[1]] = np.where(rank[k, order] < 3 * c, part[k, order], -1)
    return out


def _join_wave(links: np.ndarray, vectors: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Enter a wave's links and their reverses; full nodes choose anew."""
    most = links.shape[1]
    links[new] = chosen
    src, dst = np.repeat(new, most), chosen.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    s = np.einsum("ij,ij->i", vectors[src], vectors[dst])
    order = np.lexsort((-s, dst))
    src, dst = src[order], dst[order]
    nodes, begin, count = np.unique(dst, return_index=True, return_counts=True)
    rank = np.arange(len(dst)) - np.repeat(begin, count)
    extra = np.full((len(nodes), most), -1)
    keep = rank < most
    extra[np.repeat(np.arange(len(nodes)), count)[keep], rank[keep]] = src[keep]
    have = links[nodes]
    extra[(extra[:, :, None] == have[:, None, :]).any(2)] = -1
    both = np.hstack([have, extra])
    for i in range(0, len(nodes), 4096):
        b = both[i : i + 4096]
        sim = np.einsum("ijk,ik->ij", vectors[np.maximum(b, 0)], vectors[nodes[i : i + 4096]])
        sim = np.where(b < 0, -np.inf, sim).astype(np.float32)
        order = np.argsort(-sim, axis=1, kind="stable")
        b, sim = np.take_along_axis(b, order, 1), np.take_along_axis(sim, order, 1)
        out = b[:, :most].copy()
        crowded = np.flatnonzero(b[:, most] >= 0)
        out[crowded] = _choose(vectors, b[crowded], sim[crowded], most)
        links[nodes[i : i + 4096]] = out


class Graph:
    """The graph over one shard's vectors. ``order``: node -> row of the input."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, levels: list[np.ndarray]):
        self.vectors, self.order, self.levels = vectors, order, levels

    @staticmethod
    def build(raw: np.ndarray) -> Graph:
        order = np.random.default_rng(20240501).permutation(len(raw))
        vectors = unit(raw[order].astype(np.float64)).astype(np.float32)
        sizes = [len(raw)]
        while sizes[-1] > 2 * FANOUT:
            sizes.append(math.ceil(sizes[-1] / FANOUT))
        g = Graph(vectors, order, [])
        for level in range(len(sizes) - 1, -1, -1):
            g.levels.insert(0, g._level(sizes[level], M0 if level == 0 else M, sizes[level + 1] if level + 1 < len(sizes) else 0))
        return g

    def _level(self, n: int, most: int, above: int) -> np.ndarray:
        links = np.full((n, most), -1, np.int32)
        done = min(n, max(2 * FANOUT, above))
        # the first nodes (those of the level above) know one another exactly
        for i in range(0, done, 512):
            at = np.arange(i, min(done, i + 512))
            s = self.vectors[at] @ self.vectors[:done].T
            s[np.arange(len(at)), at] = -np.inf
            c = min(BUILD_BEAM, done - 1)
            if c < 1:
                continue
            top = np.argpartition(-s, c - 1, axis=1)[:, :c]
            k = np.arange(len(at))[:, None]
            rank = np.argsort(-s[k, top], axis=1)
            top = top[k, rank]
            links[at] = _choose(self.vectors, top, s[k, top], most)
        if done > 1:
            _join_wave(links, self.vectors, np.arange(done), links[:done].copy())
        while done < n:
            new = np.arange(done, min(n, done + min(done, WAVE)))
            q = self.vectors[new]
            entries = self._descend(q, 4)
            ids, sims = _beam(links[:done], self.vectors, q, entries, BUILD_BEAM)
            s = q @ q.T  # nodes of one wave see one another too
            np.fill_diagonal(s, -np.inf)
            c = min(8, len(new) - 1)
            if c > 0:
                top = np.argpartition(-s, c - 1, axis=1)[:, :c]
                ids = np.hstack([ids, new[top]])
                sims = np.hstack([sims, s[np.arange(len(new))[:, None], top]])
            k = np.arange(len(new))[:, None]
            rank = np.argsort(-sims, axis=1, kind="stable")
            _join_wave(links, self.vectors, new, _choose(self.vectors, ids[k, rank], sims[k, rank], most))
            done += len(new)
        return links

    def _descend(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Entries for the next level below those built so far: the best nodes of the lowest of them."""
        if not self.levels:
            return np.zeros((len(queries), 1), np.int64)
        # the first level that is small enough is looked through whole, the levels below it by their links
        flat = next((k for k, links in enumerate(self.levels) if len(links) <= FLAT), len(self.levels) - 1)
        sims = queries @ self.vectors[: len(self.levels[flat])].T
        k = min(width, sims.shape[1])
        entries = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        for links in reversed(self.levels[:flat]):
            entries, _ = _beam(links, self.vectors, queries, np.where(entries < 0, len(links), entries), width)
        return np.where(entries < 0, 0, entries)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        upper = Graph(self.vectors, self.order, self.levels[1:])
        out_i, out_s = [], []
        step = max(16, min(1024, (1 << 25) // max(1, len(self.vectors))))
        for i in range(0, len(queries), step):
            q = queries[i : i + step]
            ids, sims = _beam(self.levels[0], self.vectors, q, upper._descend(q, 4), width)
            out_i.append(ids)
            out_s.append(sims)
        return np.vstack(out_i), np.vstack(out_s)

    def dump(self, raw: np.ndarray, **more: np.ndarray) -> bytes:
        """The graph over ``raw``, the vectors that it was built from: what they give need not be stored again."""
        f = io.BytesIO()
        np.savez(f, order=self.order.astype(np.int32), raw=raw, **{f"level{k}": x for k, x in enumerate(self.levels)}, **more)
        return f.getvalue()

    @staticmethod
    def load(blob: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
        x = dict(np.load(io.BytesIO(blob)))
        levels = [x.pop(f"level{k}") for k in range(sum(n.startswith("level") for n in x))]
        order = x.pop("order")
        return Graph(unit(x["raw"][order].astype(np.float64)).astype(np.float32), order, levels), x


def _matrix(column: pd.Series) -> np.ndarray:
    """Rows of the column's own type: single precision stays so until it is computed with."""
    return np.stack([np.asarray(v) for v in column])


def _units(column: pd.Series) -> np.ndarray:
    return unit(_matrix(column).astype(np.float64))


def classes_of(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct usable vectors: ``rep`` (smallest key), ``copies``, ``vec``, ``dims``. Null keys are left out."""
    v = F.col(vector)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, number) & F.exists(v, lambda x: x != 0) & F.col(key).isNotNull()
    return vectors.filter(usable).groupBy(v.alias("vec")).agg(F.min(F.col(key).cast("long")).alias("rep"), F.count(F.lit(1)).alias("copies")).withColumn("dims", F.size("vec"))


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep")
    raw = _matrix(rows["vec"])
    blob = Graph.build(raw).dump(raw, rep=rows["rep"].to_numpy(), copies=rows["copies"].to_numpy())
    return pd.DataFrame({"dims": [key[0]], "shard": [key[1]], "graph": [blob]})


def graphs_of(classes: DataFrame, shards: int) -> DataFrame:
    """One row per shard with its graph: ``dims``, ``shard``, ``graph``."""
    placed = classes.withColumn("shard", F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(shards)).cast("int"))
    return cut_lineage(placed.groupBy("dims", "shard").applyInPandas(_build, "dims int, shard int, graph binary"))


def audited_beam(classes: DataFrame, graphs: DataFrame, threshold: float = THRESHOLD) -> dict[int, tuple[int, float]]:
    """For each vector length the beam at which the audit passes and the recall of links at it; beam 0: none passes, scan exactly.

    The sample is ``AUDIT`` classes of each length; the exact way counts every link of the sample, in blocks of all classes.
    """
    nth = F.row_number().over(Window.partitionBy("dims").orderBy(F.xxhash64("rep", F.lit(3)), "rep"))
    # thinned out by hash first, so that no task ranks all classes; a length that the sample misses is scanned exactly
    thinned = max(1, classes.count() // (64 * AUDIT))
    sampled = classes.filter(F.pmod(F.xxhash64("rep", F.lit(5)), F.lit(thinned)) == 0)
    rows = sampled.select("rep", "vec", "dims", nth.alias("nth")).filter(F.col("nth") <= AUDIT).orderBy("dims", "nth").collect()  # AUDIT of each length
    questions: dict[int, np.ndarray] = {}
    for d in sorted({r["dims"] for r in rows}):
        q = unit(np.array([r["vec"] for r in rows if r["dims"] == d], dtype=np.float64))
        if d > 1:  # copies at an angle just inside the threshold: the hardest links to find
            away = np.random.default_rng(7).normal(size=q.shape)
            away = unit(away - (away * q).sum(1, keepdims=True) * q)
            c = threshold + 0.1 * (1 - threshold)
            q = np.vstack([q, c * q + np.sqrt(1 - c * c) * away])
        questions[d] = q

    def total(df: DataFrame) -> dict[int, int]:
        return {r["dims"]: r["n"] for r in df.groupBy("dims").agg(F.sum("n").alias("n")).collect()}

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for d, own in f.groupby("dims"):
                if d in questions:
                    there = _units(own["vec"])
                    step = max(1, (1 << 22) // len(questions[d]))
                    n = sum(int((questions[d] @ there[i : i + step].T >= threshold).sum()) for i in range(0, len(there), step))
                    yield pd.DataFrame({"dims": [d], "n": [n]})

    wanted = total(classes.select("vec", "dims").mapInPandas(exact, "dims int, n long"))
    passed: dict[int, tuple[int, float]] = {}
    width = BEAM
    while len(passed) < len(questions) and width <= WIDEST:
        asked = {d: q for d, q in questions.items() if d not in passed}

        def found(frames: Iterator[pd.DataFrame], width: int = width, asked: dict[int, np.ndarray] = asked) -> Iterator[pd.DataFrame]:
            for f in frames:
                for d, blob in zip(f["dims"], f["graph"], strict=True):
                    if d in asked:
                        g, x = Graph.load(blob)
                        n = int(_linked(g, unit(x["raw"].astype(np.float64)), asked[d], width, threshold)[0].size)
                        yield pd.DataFrame({"dims": [d], "n": [n]})

        got = total(graphs.mapInPandas(found, "dims int, n long"))
        for d in asked:
            own = len(asked[d]) // 2 if d > 1 else len(asked[d])  # a sampled class finds itself: that says nothing
            recall = (got.get(d, 0) - own) / max(1, wanted.get(d, 0) - own)
            if recall >= RECALL or wanted.get(d, 0) <= own:
                passed[d] = (width, recall)
        width *= 2
    return passed | {d: (0, 1.0) for d in questions if d not in passed}


def _linked(g: Graph, there: np.ndarray, q: np.ndarray, width: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the verified links of unit queries into one shard, whose unit vectors are ``there``. Queries whose beam is full of links, and all if
    ``width`` is 0, scan the shard."""
    out_q, out_r = [], []
    full = np.ones(len(q), bool)
    if width:
        ids, sims = g.search(q.astype(np.float32), width)
        full = (ids[:, -1] >= 0) & (sims[:, -1] >= threshold - 1e-3) if ids.shape[1] < len(there) else np.zeros(len(q), bool)
        r, c = np.nonzero((ids >= 0) & (sims >= threshold - 1e-3) & ~full[:, None])
        o = g.order[ids[r, c]]
        sure = np.einsum("ij,ij->i", q[r], there[o]) >= threshold
        out_q.append(r[sure])
        out_r.append(o[sure])
    step = max(1, (1 << 21) // max(1, len(there)))
    rest = np.nonzero(full)[0]
    for i in range(0, len(rest), step):
        block = rest[i : i + step]
        a, b = np.nonzero(q[block] @ there.T >= threshold)
        out_q.append(block[a])
        out_r.append(b)
    return np.concatenate(out_q or [np.zeros(0, np.int64)]), np.concatenate(out_r or [np.zeros(0, np.int64)])


def _links(key: tuple, queries: pd.DataFrame, graphs: pd.DataFrame, width: int, threshold: float) -> pd.DataFrame:
    """Links of a block of classes into one shard: rows (a, null, links) with counts and (a, b, null) of a spanning forest."""
    if not len(queries) or not len(graphs):
        return pd.DataFrame({"a": [], "b": [], "links": []}).astype("Int64")
    g, x = Graph.load(graphs["graph"].iloc[0])
    reps, held, copies, there = queries["rep"].to_numpy(), x["rep"], x["copies"], unit(x["raw"].astype(np.float64))
    every, at = np.unique(np.concatenate([reps, held]), return_inverse=True)
    me, them = at[: len(reps)], at[len(reps) :]
    forest, links = Forest(len(every)), np.zeros(len(reps), np.int64)
    for i in range(0, len(queries), 4096):  # a block's links are counted and united before the next is asked
        rows, others = _linked(g, there, _units(queries["vec"].iloc[i : i + 4096]), width, threshold)
        rows = rows + i
        other = me[rows] != them[others]
        rows, others = rows[other], others[other]
        np.add.at(links, rows, copies[others])
        forest.union(me[rows], them[others])
    n, r = forest.edges()
    some = links > 0
    return pd.DataFrame({"a": np.concatenate([reps[some], every[n]]), "b": pd.array([pd.NA] * int(some.sum()) + every[r].tolist(), "Int64"), "links": pd.array(links[some].tolist() + [pd.NA] * len(n), "Int64")})


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: key, ``n_links``, ``component_id``, ``kept``.

    Vectors that are null, empty, zero or hold null or non-finite components, and those without a key, link with nothing. Vectors of
    different length don't link. Equal vectors link with one another. Of rows that repeat a key each counts as a vector.
    An empty table gives an empty table. Vectors of any length are compared whole. Other columns are not carried.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vec"))
    classes = cut_lineage(classes_of(rows, "key", "vec"))
    n = classes.count()
    width_of = {"float": 4, "double": 8}.get(rows.schema["vec"].dataType.elementType.simpleString(), 8)
    size = (classes.agg(F.sum("dims")).first()[0] or 0) * width_of
    shards = max(min(SHARDS, math.ceil(n / SHARD_LEAST)), math.ceil(size / SHARD_BYTES), 1)
    graphs = graphs_of(classes, shards)
    beams = {d: width for d, (width, _) in audited_beam(classes, graphs, threshold).items()}
    parts = max(1, math.ceil(size / QUERY_BYTES))
    part = F.pmod(F.xxhash64("rep", F.lit(9)), F.lit(parts)).cast("int")
    asked = classes.select("dims", "rep", "vec", part.alias("part")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    served = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    by = ("dims", "shard", "part")

    def run(k: tuple, q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        return _links(k, q, g, beams.get(int(k[0]), 0), threshold)

    found = cut_lineage(asked.groupBy(*by).cogroup(served.groupBy(*by)).applyInPandas(run, "a long, b long, links long"))
    roots = components(shrink(found.filter("b IS NOT NULL"))).withColumnRenamed("node", "rep")
    links = found.filter("links IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    rated = classes.select("vec", "rep", "copies").join(links, "rep", "left").join(roots, "rep", "left")
    rated = rated.select(F.col("vec").alias("class_vec"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "rep").alias("root"))
    joined = rows.join(rated, (F.xxhash64("vec") == F.xxhash64("class_vec")) & (F.col("vec") == F.col("class_vec")) & F.col("key").isNotNull(), "left")
    component = F.coalesce(F.col("root"), F.col("key").cast("long"))
    return joined.select(F.col("key").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
