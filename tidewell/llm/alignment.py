"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes into tokens. Every token points at the token of the other side that overlaps it and ends farthest
to the right, or at itself if nothing reaches beyond its end (of two tokens that end together the first side's points at the second
side's). Successor doubling, ``next = next[next]`` over all tokens of a batch at once, ends after about log2 of the longest chain with every
token at the last token of its component: the groups between places where tokens of both sides end.

A text is cut at single spaces between other characters. No token of either side goes on over such a place (the first
splits before the space; no piece of the second has a space mark after another character), so the fragments are encoded and aligned on
their own. Fragments repeat a lot: workers keep a bounded cache of them, and the doubling runs over those that a slice of
rows has new.

What is counted over the corpus is a table of id pairs with one row for each pair of a text and its number there. Counts go
back to the texts by a join that Spark broadcasts only if the counted pairs are at most ``FEW_PAIRS``, and shuffles otherwise.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut_lineage, own_name, table

#: A single space between characters that aren't white space; what keeps a split at all spaces from being the same.
CUT = re.compile(r"(?<=\S) (?=\S)")
UNEVEN = re.compile(r"\s | \s|\A | \Z")
#: Entries of each half of a worker's fragment cache; longest fragment that is cached; rows that are aligned together; pairs that may be broadcast (16 bytes each).
CACHE_SIZE, CACHED_LENGTH, SLICE, FEW_PAIRS = 150_000, 40, 200, 1_000_000
SHIFT = 32
#: What follows an id in a group's text: another of its side, the other side, the next group.
MARKS = ",|;"
#: Of a fragment: tokens of a and of b, its groups as text, its links as 64-bit numbers.
Aligned = tuple[int, int, str, bytes]


def byte_level() -> dict[str, int]:
    """The alphabet of byte-level tokenizers: printable Latin-1 stands for itself, all other bytes follow from U+0100 on."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


def fragments(text: str) -> list[str]:
    """A text cut at certain places; each fragment but the first stands behind a space."""
    return CUT.split(text) if UNEVEN.search(text) else text.split(" ")


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last token (a place in b) of each token's group, for the tokens of a and of b.

    ``ends_*``: rising byte offsets at which tokens end; the last is the same on both sides.
    """
    n = len(ends_a)
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    own = n + np.arange(len(ends_b))
    together = ends_a[over_b] == ends_b if n else np.zeros(0, bool)
    following = np.concatenate([n + over_a, np.where(together, own, over_b)])
    while True:
        farther = following[following]
        if np.array_equal(farther, following):
            break
        following = farther
    return following[:n] - n, following[n:] - n


class Aligner:
    """Two tokenizer files: one of the tokenizers library with a byte-level alphabet (a), one of sentencepiece with byte fallback (b)."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level()
        self.bytes_a: dict[int, bytes] = {}
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.bytes_b: list[bytes] = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            if re.search("[^▁]▁", piece):
                raise ValueError("pieces that go on over a space can't be cut before it")
        self.size_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # every id as text with what may follow it, and how long that is
        most = max(len(self.size_a), len(self.size_b))
        self.spelled = [f"{i}{mark}" for mark in MARKS for i in range(most)]
        self.spelled_size = np.array([len(x) for x in self.spelled])
        self.most = most
        self.cache: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}

    def align(self, new: list[str]) -> dict[str, Aligned | None]:
        """The alignment of each fragment; None if the tokens' bytes are other than its own."""
        out: dict[str, Aligned | None] = dict.fromkeys(new)
        same, ids_a, ids_b = [], [], []
        coded = self.a.encode_batch([f" {f}" for f in new], add_special_tokens=False)
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for f, a, b in zip(new, [e.ids for e in coded], self.b.encode(new, num_threads=1), strict=True):
            own = f" {f}".encode()
            if b"".join(map(of_a, a)) == own == b"".join(map(of_b, b)):
                same.append(f)
                ids_a.append(a)
                ids_b.append(b)
        if not same:
            return out
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        last_a, last_b = group_labels(np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b]))
        # labels never fall: a group's tokens stand together, and its last one is where they change
        end_a, end_b = (np.append(x[1:] != x[:-1], True) for x in (last_a, last_b))
        links = (flat_a[end_a] << SHIFT | flat_b[end_b]).tobytes()
        # all tokens in the order of the text: a group's of a, then its of b
        group_a, group_b = (np.cumsum(end) - end for end in (end_a, end_b))
        through_a, through_b = np.flatnonzero(end_a) + 1, np.flatnonzero(end_b) + 1
        at_a = np.arange(len(flat_a)) + np.concatenate([[0], through_b])[group_a]
        at_b = np.arange(len(flat_b)) + through_a[group_b]
        order = np.empty(len(flat_a) + len(flat_b), np.int64)
        order[at_a] = flat_a + np.where(end_a, self.most, 0)
        order[at_b] = flat_b + np.where(end_b, 2 * self.most, 0)
        text = "".join(map(self.spelled.__getitem__, order.tolist()))
        tokens = np.cumsum(n_a + n_b)
        until = np.cumsum(self.spelled_size[order])[tokens - 1].tolist()
        groups = (np.cumsum(end_a)[np.cumsum(n_a) - 1] * 8).tolist()
        start = first = 0
        for f, a, b, end, last in zip(same, n_a.tolist(), n_b.tolist(), until, groups, strict=True):
            out[f] = (a, b, text[start:end], links[first:last])
            start, first = end, last
        return out

    def _known(self, texts: list[list[str]]) -> dict[str, Aligned | None]:
        """The alignment of every fragment of some texts."""
        found: dict[str, Aligned | None] = {}
        new = []
        for f in set(chain.from_iterable(texts)):
            if f in self.cache:
                found[f] = self.cache[f]
            elif f in self.older:
                found[f] = self.cache[f] = self.older[f]
            else:
                new.append(f)
        more = self.align(new)
        self.cache |= {f: x for f, x in more.items() if len(f) <= CACHED_LENGTH}
        if len(self.cache) > CACHE_SIZE:
            self.older, self.cache = self.cache, {}
        return found | more

    def rows(self, texts: list[str | None]) -> list[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """Of each text: tokens of a and of b, groups, digest of the groups, its different links and how often each stands in it."""
        cut = [fragments(x) if x else [] for x in texts]
        known = self._known(cut)
        out = []
        for x in cut:
            parts = list(map(known.__getitem__, x))
            if not parts or None in parts:
                out.append((0, 0, 0, "", *np.zeros((2, 0), np.int64)))
                continue
            a, b, groups, links = zip(*parts, strict=True)
            linked = np.frombuffer(b"".join(links), np.int64)
            digest = hashlib.sha256("".join(groups)[:-1].encode()).hexdigest()
            out.append((sum(a), sum(b), len(linked), digest, *np.unique(linked, return_counts=True)))
        return out


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def align(docs: DataFrame, text: str = "text", key: str = "doc_id", paths: tuple[str, str] | None = None) -> DataFrame:
    """Per row: key, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256``, ``pairs`` (a's id in the upper 32 bits, b's in the lower) and ``times``, and ``row``.

    ``row`` numbers the rows of this result, which is a checkpoint. Null and empty texts, and texts that one side's tokens don't give back
    byte for byte, have no tokens: zeros, no pairs, an empty digest. Null and repeated keys and texts are rows like others; an empty table gives an
    empty table; other columns are not carried. Texts of any length are read whole.
    """
    path_a, path_b = paths or default_paths()
    kind = docs.schema[key].dataType.simpleString()
    names = ["row", key, "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = aligner(path_a, path_b)
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                b = whole.slice(i, SLICE)
                n_a, n_b, groups, digests, links, counts = zip(*e.rows(b.column(2).to_pylist()), strict=True)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in links])]).astype(np.int32)
                pairs, times = pa.array(np.concatenate(links)), pa.array(np.concatenate(counts).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), *[pa.array(x, pa.int64()) for x in (n_a, n_b, groups)], pa.array(digests, pa.string()), pa.ListArray.from_arrays(offsets, pairs), pa.ListArray.from_arrays(offsets, times)],
                    names=names,
                )

    rows = docs.select(F.monotonically_increasing_id().alias(own_name(docs, "row")), key, text)
    return cut_lineage(rows.mapInArrow(run, f"row bigint, `{key}` {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<int>"))


def occurrences(aligned: DataFrame) -> DataFrame:
    """(row, pair, n) of what ``align`` returns."""
    both = F.inline(F.arrays_zip("pairs", "times")).alias("pair", "n")
    return aligned.select("row", both)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Links of each id pair over the whole corpus: ``pair``, ``count``, and ``is_best``, whether no pair of the same b id has more."""
    counts = occurrences(aligned).groupBy("pair").agg(F.sum("n").alias("count"))
    of_b = lambda: F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    counts = cut_lineage(counts)
    best = counts.groupBy(of_b().alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", of_b()).join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("is_best"))


def count_links(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per ``row`` that has links: ``n_best`` (links whose pair is its b id's most frequent) and ``count_sum`` (the pairs' counts over all links)."""
    counts = cut_lineage(counts)
    few = counts.count() <= FEW_PAIRS
    joined = occurrences(aligned).join(F.broadcast(counts) if few else counts, "pair")
    return joined.groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"))
    counted = count_links(aligned, pair_counts(aligned))
    rows = aligned.drop("pairs", "times").join(counted, "row", "left")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), none("n_best"), none("count_sum"), "groups_sha256")
