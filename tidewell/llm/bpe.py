"""BPE encoding and decoding with forced boundaries.

If two neighbouring symbols never stand next to each other inside any token of the vocabulary, no merge can ever join
them: the place between them is a certain cut, and the fragments on both sides can be encoded on their own and
concatenated. White space and pre-token ends are such places for every vocabulary with word ends (no token goes on after
one); inside a pre-token the byte pairs that occur in no token give further cuts. Fragments that end a pre-token are encoded
with the vocabulary's end-of-word mark, all others without it.

Fragments between white space repeat a lot, so each worker keeps a bounded cache from fragment to ids; long fragments (no
white space for a while) are cut at forced places and not cached. All work is per row: no shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .shared import table

#: Entries of each half of a worker's fragment cache (the older half is dropped when the newer is full), and of its
#: pre-token cache; the longest string that is cached.
CACHE_SIZE, PIECE_CACHE_SIZE, CACHED_LENGTH = 120_000, 150_000, 40
#: Rows that are turned to results at a time: bounds what a worker holds besides its input batch.
SLICE = 500
#: Files whose normaliser and pre-tokenizer are these have quick ways; for others the library's own are called.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
#: That pattern, narrowed to lower-case printable ASCII without white space.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
OTHER_SPACE = re.compile("[\x1c-\x1f]")


class ForcedBoundaryBPE:
    """Encoder for one tokenizer file (BPE with an end-of-word suffix and a byte-level alphabet)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        spaces = [n for n in (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]]) if n and n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " "]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or model.get("dropout") or model.get("continuing_subword_prefix") or not spaces:
            raise ValueError("only BPE with word ends whose normaliser makes white space single spaces is cut at certain places here")
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError("added tokens must be taken as they stand")
        if spec["decoder"] is not None:
            raise ValueError("decoders other than joining tokens by spaces are not built")
        self.suffix = model["end_of_word_suffix"]
        self.plain = spec["normalizer"] == NORMALIZER
        self.ascii = self.plain and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.final = self.tokenizer.model
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        self.pairs = {s[i : i + 2] for t in model["vocab"] for s in [t.removesuffix(self.suffix)] for i in range(len(s) - 1)}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.names[i] = t
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def fragments(self, piece: str) -> list[str]:
        """A pre-token (byte-level symbols) cut wherever a pair of symbols occurs in no token."""
        cuts = [i for i in range(1, len(piece)) if piece[i - 1 : i + 1] not in self.pairs]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]

    def _piece(self, piece: str) -> bytes:
        *inner, last = self.fragments(piece)
        tokens = self.final.tokenize(last)
        if inner:
            tokens = [t for f in inner for t in self.inner.tokenize(f)] + tokens
        found = array("I", [t.id for t in tokens]).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self.pieces) >= PIECE_CACHE_SIZE:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            if self.ascii and chunk.isascii() and chunk.isprintable():
                pieces = ASCII_PIECES.findall(chunk)
            else:
                pieces = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]
            found = b"".join([self.pieces.get(p) or self._piece(p) for p in pieces])
        if len(chunk) <= CACHED_LENGTH:
            if len(self.cache) >= CACHE_SIZE:
                self.older, self.cache = self.cache, {}
            self.cache[chunk] = found
        return found

    def chunks(self, text: str) -> list[str]:
        """Fragments between white space of the normalised text."""
        if self.plain:
            try:  # Latin-1 is composed already and lower-cases letter by letter
                text.encode("latin-1")
                if not OTHER_SPACE.search(text):
                    return text.lower().split()
            except UnicodeEncodeError:
                pass
        return [c for c in self.tokenizer.normalizer.normalize_str(text).split(" ") if c]

    def _plain(self, text: str) -> list[bytes]:
        chunks = self.chunks(text)
        found = list(map(self.cache.get, chunks))
        if None in found:
            found = [self._chunk(c) if f is None else f for f, c in zip(found, chunks, strict=True)]
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text counts as empty."""
        text = text or ""
        if self.special_split is None or not self.special_split.search(text):
            return b"".join(self._plain(text))
        parts = []
        for s in self.special_split.split(text):
            parts += [array("I", [self.special[s]]).tobytes()] if s in self.special else self._plain(s)
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """The tokens of ids joined by single spaces."""
        return " ".join(map(self.names.__getitem__, array("I", ids)))


@lru_cache(maxsize=2)
def encoder(path: str) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Per row: key, ``n_tokens``, ``ids`` (array of int; left out on request), digests of ids and of the decoded text.

    Null and empty texts have no tokens; texts of any length are encoded whole; an empty table gives an empty table; null keys are kept. Repeated rows are
    encoded alike. Other columns are not carried: join on the key. ``path`` may name any tokenizer file with word ends; others are refused.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                b = whole.slice(i, SLICE)
                counts, digests, decoded, ids = [], [], [], []
                for t in b.column(1):
                    coded = e.encode(t.as_py())
                    counts.append(len(coded) // 4)
                    digests.append(hashlib.sha256(coded).hexdigest())
                    decoded.append(hashlib.sha256(e.decode(coded).encode("utf-8")).hexdigest())
                    if keep_ids:
                        ids.append(coded)
                columns = [b.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                if keep_ids:
                    values = np.frombuffer(b"".join(ids), np.int32)
                    columns.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), values))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select(key, text).mapInArrow(run, schema)


def decode(coded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """Per row: key and ``decoded``, the tokens of ``ids`` joined by single spaces. Null ids count as none."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            texts = [e.decode(array("I", x.as_py() or []).tobytes()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "decoded"])

    return coded.select(key, ids).mapInArrow(run, f"`{key}` {coded.schema[key].dataType.simpleString()}, decoded string")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), keep_ids=False)
