"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features describe its characters, words and repetition, and those of the lines
before and after it; two labels that follow one another have a weight of their own. The field is fitted to labelled documents
(each line of a document takes the document's label) by gradient ascent on one regularised likelihood: the sum over documents of the log-probability
of their labels per line, both labels weighing the same in total. A document's score is the mean of its lines' forward-backward
marginals of "good", weighted by line length; documents without a letter to score have one line with only the constant feature.

Fitting uses at most ``MAX_FIT`` labelled documents, taken in the order of a hash of the key, and of each at most ``FIT_LINES`` lines that follow one
another: documented bounds that keep the fit on one machine. Their features are computed where the texts are. Scoring is a map over all rows: no shuffle. Short documents are scored together; a document of more
than ``BLOCK`` lines is scored in blocks, forward to keep the messages at the blocks' ends, then backward. What a worker holds is a block's features and a
few numbers per line.
Labels, lang, source and key are never inputs of a score.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import own_name, table

MAX_FIT, FIT_LINES = 6000, 64
EPOCHS, RATE, L2 = 100, 0.15, 1e-3
#: Lines that are scored at a time: bounds what a worker holds besides its input batch.
BLOCK = 16_384
#: Predicted good from this score on.
THRESHOLD = 0.3

CLASSES = ("upper", "lower", "digit", "space", "stop", "bar", "mark", "other")
_CLASS = np.full(256, CLASSES.index("lower"), np.uint8)  # bytes of letters beyond ASCII count as lower case
_CLASS[:128] = CLASSES.index("other")
_CLASS[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
_CLASS[ord("a") : ord("z") + 1] = CLASSES.index("lower")
_CLASS[ord("0") : ord("9") + 1] = CLASSES.index("digit")
for _chars, _name in ((" \t\n\v\f\r", "space"), (".,;:'\"?-()", "stop"), ("|", "bar"), ("!#$%&*+=<>@^_~/\\{}[]`", "mark")):
    for _c in _chars:
        _CLASS[ord(_c)] = CLASSES.index(_name)
OWN = len(CLASSES) - 1 + 6
FEATURES = 3 * OWN + 3


def own_features(lines: list[bytes], repeated: np.ndarray) -> np.ndarray:
    """One row per line: shares of character classes, words, and whether the document has the line again."""
    n = len(lines)
    lengths = np.array([len(x) for x in lines])
    codes = _CLASS[np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)]
    # a joint count over (line, class)
    line_of = np.repeat(np.arange(n), lengths + 1)
    counts = np.bincount(line_of * len(CLASSES) + codes, minlength=n * len(CLASSES)).reshape(n, len(CLASSES)).astype(np.float64)
    counts[:, CLASSES.index("space")] -= 1  # the line's end
    size = np.maximum(lengths, 1)[:, None]
    words = [x.split() for x in lines]
    n_words = np.array([len(w) for w in words])
    distinct = np.array([len(set(w)) for w in words])
    extra = np.column_stack([np.log1p(n_words) / 5, counts[:, :3].sum(1) / np.maximum(n_words, 1) / 10, distinct / np.maximum(n_words, 1), repeated.astype(float), (n_words == 0).astype(float), (n_words < 4).astype(float)])
    return np.hstack([counts[:, [i for i, c in enumerate(CLASSES) if c != "other"]] / size, extra])


def with_neighbours(own: np.ndarray, before: np.ndarray | None, after: np.ndarray | None) -> np.ndarray:
    """Own features, those of both neighbours, first, last and constant. ``before`` and ``after``: the lines next to these; none at a document's ends."""
    none = np.zeros((1, OWN))
    ends = np.zeros((len(own), 3))
    ends[0, 0], ends[-1, 1], ends[:, 2] = before is None, after is None, 1
    return np.hstack([own, np.vstack([none if before is None else before, own[:-1]]), np.vstack([own[1:], none if after is None else after]), ends])


def line_features(lines: list[bytes]) -> np.ndarray:
    """One row per line of one document."""
    seen = Counter(lines)
    return with_neighbours(own_features(lines, np.array([seen[x] > 1 for x in lines])), None, None)


def sampled_features(text: str | None, most: int) -> np.ndarray:
    """Features of a document's lines, or of ``most`` of them that follow one another, from a place that the text's checksum gives."""
    lines = lines_of(text)
    first = zlib.crc32((text or "").encode("utf-8", "surrogatepass")) % (len(lines) - most + 1) if len(lines) > most else 0
    a, b = max(0, first - 1), min(len(lines), first + most + 1)  # with the neighbours
    seen = Counter(lines)
    own = own_features(lines[a:b], np.array([seen[x] > 1 for x in lines[a:b]]))
    after = b > first + most
    inside = own[first - a : len(own) - after]
    return with_neighbours(inside, own[:1] if a < first else None, own[-1:] if after else None)


def lines_of(text: str | None) -> list[bytes]:
    """A text's lines; null and empty texts have one empty line."""
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


class Chain:
    """A two-label chain: weights of features for "good", and of each pair of labels that follow one another."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.pairs, self.mean, self.scale = weights, pairs, mean, scale

    def marginals(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """P(good) of each line; ``sizes``: lines of each document in turn."""
        return forward_backward(((features - self.mean) / self.scale) @ self.weights, self.pairs, sizes)[0]

    def dump(self) -> str:
        return json.dumps({k: v.tolist() for k, v in vars(self).items()})

    @staticmethod
    def load(x: str) -> Chain:
        return Chain(**{k: np.array(v) for k, v in json.loads(x).items()})


def forward_backward(unary: np.ndarray, pairs: np.ndarray, sizes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of "good" per line, and expected counts of label pairs, for chains of the given lengths laid end to end.

    The counts of a chain are weighted by ``weights`` (default: 1 each). Chains are stepped through together, longest first, so a step works
    on all chains that are that long.
    """
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    length = sizes[order]
    weight = np.ones(len(sizes)) if weights is None else weights[order]
    longest = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(longest)]  # chains with more than t lines
    phi, node = _potentials(unary, pairs)
    alpha, beta = np.empty_like(node), np.ones_like(node)
    for t in range(longest):
        at = first[: active[t]] + t
        a = node[at] if t == 0 else (alpha[at - 1] @ phi) * node[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    expected = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        onward = node[at + 1] * beta[at + 1]
        joint = alpha[at][:, :, None] * phi * onward[:, None, :]
        expected += (joint * (weight[: active[t + 1]] / joint.sum((1, 2)))[:, None, None]).sum(0)
        b = onward @ phi.T
        beta[at] = b / b.sum(1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(1), expected


def _potentials(unary: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = np.clip(unary, -60, 60) / 2
    return np.exp(pairs - pairs.max()), np.stack([np.exp(-half), np.exp(half)], 1)


def score_in_blocks(raw: bytes, chain: Chain, block: int) -> float:
    """The score of one document of any number of lines; what is held is a block's features and a few numbers per line."""
    ends = np.concatenate([np.flatnonzero(np.frombuffer(raw, np.uint8) == 10), [len(raw)]])
    starts = np.concatenate([[0], ends[:-1] + 1])
    line = lambda i: raw[starts[i] : ends[i]]
    n = len(ends)
    marks = np.fromiter((hash(line(i)) for i in range(n)), np.int64, n)
    values, counts = np.unique(marks, return_counts=True)
    repeated = counts[np.searchsorted(values, marks)] > 1
    del marks, values, counts
    unary = np.empty(n)
    for i in range(0, n, block):
        # a line's neighbours may stand in other blocks
        a, b = max(0, i - 1), min(n, i + block + 1)
        own = own_features([line(j) for j in range(a, b)], repeated[a:b])
        inside = own[i - a : len(own) - (b - min(n, i + block))]
        x = with_neighbours(inside, own[:1] if a < i else None, own[-1:] if b > min(n, i + block) else None)
        unary[i : i + block] = ((x - chain.mean) / chain.scale) @ chain.weights
    phi = np.exp(chain.pairs - chain.pairs.max())
    (p, q), (r, s) = phi.tolist()
    half = np.clip(unary, -60, 60) / 2
    ratio = np.exp(2 * half)  # good over bad of each line by itself
    forward, last = np.empty(n), None  # good over bad given the lines so far
    for i, u in enumerate(ratio):
        last = u if last is None else u * (q + last * s) / (p + last * r)
        forward[i] = last
    total, weight, back = 0.0, 0.0, 1.0
    for i in range(n - 1, -1, -1):
        both = forward[i] * back
        w = float(ends[i] - starts[i]) + 1e-6
        total, weight = total + w * (both / (1 + both) if both < 1e300 else 1.0), weight + w
        onward = ratio[i] * back
        back = (r + onward * s) / (p + onward * q)
    return min(1.0, max(0.0, total / weight))


def fit(documents: list[tuple[str | None, int]], epochs: int = EPOCHS, rate: float = RATE, l2: float = L2) -> Chain:
    """Fit to (text, label) pairs, all lines of each."""
    return fit_features([line_features(lines_of(t)) for t, _ in documents], [y for _, y in documents], epochs, rate, l2)


def fit_features(parts: list[np.ndarray], of: list[int], epochs: int = EPOCHS, rate: float = RATE, l2: float = L2) -> Chain:
    """Fit to documents' line features and labels. Both labels weigh the same in total. No documents, or one label only: a constant chain."""
    labels = np.array(of, dtype=float)
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        prior = 4.0 * (labels.mean() - 0.5) if len(labels) else 0.0
        weights = np.zeros(FEATURES)
        weights[-1] = prior
        return Chain(weights, np.zeros((2, 2)), np.zeros(FEATURES), np.ones(FEATURES))
    raw = np.vstack(parts)
    mean, scale = raw.mean(0), raw.std(0)
    mean[-1], scale[scale < 1e-9] = 0.0, 1.0
    x = (raw - mean) / scale
    y = np.repeat(labels, sizes)
    # a document's weight: both labels the same in total, each line of it an equal part
    by_doc = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum()) / sizes
    per_line = np.repeat(by_doc, sizes)
    # chains of one label: its pair occurs at every step
    seen = np.diag([float((by_doc * (sizes - 1))[labels == v].sum()) for v in (0, 1)])
    weights, pairs = np.zeros(FEATURES), np.zeros((2, 2))
    state = [np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)]
    for step in range(1, epochs + 1):
        p, expected = forward_backward(x @ weights, pairs, sizes, by_doc)
        grad_w = x.T @ ((y - p) * per_line) - l2 * weights
        grad_p = seen - expected - l2 * pairs
        g = np.concatenate([grad_w, grad_p.ravel()])
        state = [0.9 * state[0] + 0.1 * g, 0.99 * state[1] + 0.01 * g * g]
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights, pairs = weights + move[:FEATURES], pairs + move[FEATURES:].reshape(2, 2)
    return Chain(weights, pairs, mean, scale)


def held_out(key: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_fit: int = MAX_FIT, fit_lines: int = FIT_LINES) -> Chain:
    """Fit on rows with a text and a label whose key is not held out, in the order of a hash of the key: at most ``max_fit`` of them, and at most
    ``fit_lines`` lines of each, so a long text shuts out no other. Rows that repeat key and text are one. No such rows: a constant chain."""
    usable = labels.filter(~held_out(key) & F.col("quality").isin(0, 1)).select(F.col(key).alias("_key"), "quality").distinct()
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(F.col("_text").isNotNull()).withColumn("_mark", F.xxhash64("_text"))
    known = texts.select("_key", "_mark").join(usable, "_key").distinct()
    chosen = known.orderBy(F.xxhash64("_key"), "_key", "_mark", "quality").limit(max_fit)
    rows = texts.join(F.broadcast(chosen), ["_key", "_mark"]).select("_key", "_mark", "quality", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            features = [sampled_features(t.as_py(), fit_lines).astype(np.float32).tobytes() for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(features, pa.binary())], names=["_key", "_mark", "quality", "features"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    found = rows.mapInArrow(run, f"_key {kind['_key']}, _mark bigint, quality {kind['quality']}, features binary").dropDuplicates(["_key", "_mark", "quality"])
    held = sorted(found.collect(), key=lambda r: (r["_key"], r["_mark"], r["quality"]))  # at most max_fit x fit_lines lines
    return fit_features([np.frombuffer(r["features"], np.float32).reshape(-1, FEATURES).astype(np.float64) for r in held], [r["quality"] for r in held])


def score(docs: DataFrame, chain: Chain, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all), ``quality_score`` (0 to 1) and ``quality_predicted``.

    Null and empty texts are scored as one empty line; texts of any length are scored whole; repeated rows get equal scores; an empty table gives an empty
    table. Where ``keep`` has a column of such a name, the new one is named with underscores before it.
    """
    model = chain.dump()
    keep = docs.columns if keep is None else keep
    names = [*keep, *(own_name(docs.select(*keep), n) for n in ("quality_score", "quality_predicted"))]

    def together(c: Chain, split: list[list[bytes]]) -> np.ndarray:
        sizes = np.array([len(x) for x in split], dtype=np.int64)
        p = c.marginals(np.vstack([line_features(x) for x in split]), sizes)
        weight = np.array([len(x) for lines in split for x in lines], dtype=float) + 1e-6
        ends = np.cumsum(sizes) - sizes
        return np.clip(np.add.reduceat(p * weight, ends) / np.add.reduceat(weight, ends), 0.0, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Chain.load(model)
        for b in batches:
            scores = np.zeros(b.num_rows)
            held: list[list[bytes]] = []
            at: list[int] = []
            lines = 0
            for i, t in enumerate(b.column(b.num_columns - 1)):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                n = raw.count(b"\n") + 1
                if n > BLOCK:
                    scores[i] = score_in_blocks(raw, c, BLOCK)
                    continue
                if lines + n > BLOCK:
                    scores[at] = together(c, held)
                    held, at, lines = [], [], 0
                held.append(raw.split(b"\n"))
                at.append(i)
                lines += n
            if held:
                scores[at] = together(c, held)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=names)

    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    schema = StructType([*docs.select(*keep).schema.fields, StructField(names[-2], DoubleType()), StructField(names[-1], IntegerType())])
    return docs.select(*keep, F.col(text).alias(own_name(docs.select(*keep), "scored_text"))).mapInArrow(run, schema)


def keep_good(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, with its columns."""
    predicted = own_name(docs, "quality_predicted")
    return score(docs, chain, text).filter(F.col(predicted) == 1).select(*docs.columns)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = learn(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, chain, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted"))
