"""Secrets by dictionary-primed zstandard novelty.

Base rules find secrets of known forms. Other candidates are strings of mixed characters in a sensitive context: a cue (``CUE``) stands
before them on their line, at most ``REACH`` characters away. How new a candidate is, is measured by compression: its marginal bytes are what the
compressed surroundings grow by if the candidate is put behind them. The compressor is primed with a dictionary of the
corpus's identifiers, the most frequent ones last, and the surroundings are the code on both sides, without the candidate's own occurrences and without base
spans. Names, paths and words that the corpus or the place knows add few bytes; a random string adds about its own length. What adds at
least ``NOVEL`` bytes a character is reported as kind ``novel``.

Identifiers are counted over the whole corpus, outside base spans and candidates, so a secret that is copied a thousand times doesn't become a known
word. Documents and counts leave one pass over the texts together; the second pass reads the candidates only.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .shared import cut_lineage, table

KINDS = ("assign", "access", "hex")
NOVEL_KIND = "novel"
#: Fixed by the contract: rules, and the least length of what they must match (of ``assign``, of its value).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGNED = 12
#: Without one of these, in lower case, ``ASSIGN`` can't match.
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
#: Words that announce a secret; so does a user name in an address.
CUES = ("passw", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "access_key", "access-key", "accesskey", "private_key", "private-key", "private key", "credential", "authorization", "bearer")
USER = re.compile(r"://[^/:@\s]{1,64}:")
#: What may be a secret: a run of characters that passwords, keys and encodings are made of; punctuation at its ends isn't part of it.
LOWER = {c: c + 32 for c in range(65, 91)}
RUN = re.compile(r"[A-Za-z0-9+/_.=~!#$%^&*?-]{12,}")
EDGE = ".,=!?&*_-/#$%"
LETTER, DIGIT, MARK = map(re.compile, ("[A-Za-z]", "[0-9]", "[+/=~!#$%^&*]"))
#: Least length of a candidate; characters from a cue to it; surroundings on either side; longest candidate that is compressed as one piece; least marginal bytes a character.
LEAST, REACH, AROUND, PIECE, NOVEL = 12, 64, 256, 4096, 0.65
IDENTIFIER = re.compile(r"[^\W\d]{4,40}")
#: Identifiers and bytes of the dictionary; counts that a task holds before it hands them on; rows per result batch; characters of which the words are listed at once.
IDENTIFIERS, DICTIONARY_BYTES, HELD, SLICE, BLOCK = 8192, 65_536, 100_000, 1000, 1 << 20

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The places that spans cover, in order, none touching another."""
    out: list[tuple[int, int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def lower(text: str) -> str:
    """A text with the letters A to Z in lower case, in as many characters."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(LOWER)


def cues(text: str, low: str) -> list[int]:
    """Where cues end, in order."""
    ends = set()
    for word in CUES:
        at = low.find(word)
        while at >= 0:
            ends.add(at + len(word))
            at = low.find(word, at + len(word))
    if "://" in text:
        ends.update(m.end() for m in USER.finditer(text))
    return sorted(ends)


def candidates(text: str, covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of mixed characters behind a cue that overlap no covered place, in order."""
    out: list[tuple[int, int]] = []
    reached = 0
    for cue in cues(text, lower(text)):
        until = text.find("\n", cue, cue + REACH + 1)
        until = cue + REACH if until < 0 else until
        at = max(cue, reached)
        while at <= until and (m := RUN.search(text, at, until + LEAST)) and m.start() <= until:
            m = RUN.match(text, m.start())  # all of it
            reached = at = m.end()
            run = m[0].strip(EDGE)
            a = m.start() + len(m[0]) - len(m[0].lstrip(EDGE))
            b = a + len(run)
            first = bisect_right(covered, (a,)) - 1  # the last place that starts before the run
            free = all(y <= a or b <= x for x, y in covered[max(first, 0) : first + 2])
            if len(run) >= LEAST and free and is_mixed(run):
                out.append((a, b))
    return out


def is_mixed(run: str) -> bool:
    """Whether a run holds four letters and a digit, or letters of both cases and a mark: names, dates and numbers don't."""
    if sum(1 for _ in islice(LETTER.finditer(run), 4)) < 4:
        return False
    return DIGIT.search(run) is not None or (MARK.search(run) is not None and run != run.lower() and run != run.upper())


def _without(text: str, places: list[tuple[int, int]]) -> str:
    """A text whose places are replaced by spaces."""
    parts, at = [], 0
    for a, b in places:
        parts.append(text[at:a])
        at = max(at, b)
    return " ".join([*parts, text[at:]])


def surroundings(text: str, start: int, end: int, hidden: list[tuple[int, int]]) -> str:
    """The code after and before a candidate, without ``hidden`` places and without the candidate's own occurrences: what stands before it comes last."""
    sides = []
    for a, b in ((end, min(len(text), end + AROUND)), (max(0, start - AROUND), start)):
        inside = [(max(x, a) - a, min(y, b) - a) for x, y in hidden if x < b and a < y]
        sides.append(_without(text[a:b], inside).replace(text[start:end], " "))
    return " ".join(sides)


def read_text(text: str) -> tuple[list[Span], list[dict], list[tuple[int, int]]]:
    """(base spans, candidates with their surroundings, places that are neither code nor words) of a text."""
    base = base_spans(text)
    found = candidates(text, covered := merged(base))
    hidden = merged([*base, *[(NOVEL_KIND, a, b) for a, b in found]])
    rows = [{"start": a, "end": b, "value": text[a:b], "around": surroundings(text, a, b, covered)} for a, b in found]
    return base, rows, hidden


class Novelty:
    """Marginal compressed bytes under a dictionary of identifiers."""

    def __init__(self, dictionary: bytes):
        import zstandard

        # a dictionary of contents only, and no entropy coding (zstandard leaves it out for this strategy): what is no copy of something known
        # adds its own length, whatever else is around it
        parameters = {"strategy": zstandard.STRATEGY_FAST, "target_length": 1, "min_match": 4, "hash_log": 17, "window_log": 18, "write_content_size": False}
        options = {"compression_params": zstandard.ZstdCompressionParameters(**parameters)}
        if len(dictionary) >= 8:
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(**options)

    def marginal(self, value: str, around: str) -> int:
        """Bytes that ``around`` grows by, compressed, if ``value`` follows it."""
        before = around.encode("utf-8", "surrogatepass")
        return len(self.compressor.compress(before + b" " + value.encode("utf-8", "surrogatepass"))) - len(self.compressor.compress(before + b" "))

    def is_new(self, value: str, around: str) -> bool:
        """Whether a value adds at least ``NOVEL`` bytes a character; long ones are judged by their pieces together, each behind the same surroundings."""
        pieces = [value[i : i + PIECE] for i in range(0, len(value), PIECE)]
        return sum(self.marginal(p, around) for p in pieces) >= NOVEL * len(value)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = (
    "what string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, base array<struct<kind:string,start:int,end:int>>, "
    "candidates array<struct<start:int,end:int,value:string,around:string>>, word string, n bigint"
)


def read(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One pass over the texts: document rows with their key, and counts of identifiers (see ``FOUND``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = StructType([StructField("key", docs.schema[key].dataType), *_parse_datatype_string(FOUND).fields])
    target = to_arrow_schema(schema)

    def batch(keys: pa.Array | None, what: str, columns: dict[str, list], size: int) -> pa.RecordBatch:
        columns = columns | {"what": [what] * size}
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in target]
        if keys is not None:
            arrays[0] = keys.cast(target.field("key").type)
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    def counted(words: Counter) -> pa.RecordBatch:
        return batch(None, "word", {"word": list(words), "n": list(words.values())}, len(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                b = whole.slice(i, SLICE)
                rows = []
                for t in b.column(1):
                    x = t.as_py() or ""
                    base, found, hidden = read_text(x)
                    at = 0
                    for a, z in [*hidden, (len(x), len(x))]:
                        for start in range(at, a, BLOCK):
                            words.update(IDENTIFIER.findall(x, start, min(start + BLOCK, a)))
                        at = z
                    if len(words) >= HELD:
                        yield counted(words)
                        words.clear()
                    kinds = Counter(k for k, _, _ in base)
                    rows.append((*[kinds[k] for k in KINDS], hashlib.sha256(listed(base).encode()).hexdigest(), [{"kind": k, "start": a, "end": z} for k, a, z in base], found))
                names = [*[f"n_{k}" for k in KINDS], "base_sha256", "base", "candidates"]
                yield batch(b.column(0), "document", dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), len(rows))
        yield counted(words)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def identifier_dictionary(counts: DataFrame) -> bytes:
    """The corpus's most frequent identifiers (``word``, ``n``), rarest first, since matches near the end are cheapest. Bounded by ``IDENTIFIERS`` and ``DICTIONARY_BYTES``."""
    total = counts.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    top = [r["word"] for r in total.orderBy(F.desc("n"), "word").limit(IDENTIFIERS).collect()]
    taken, size = [], 0
    for w in top:
        size += len(w.encode()) + 1
        if size > DICTIONARY_BYTES:
            break
        taken.append(w)
    return " ".join(reversed(taken)).encode()


def novel_spans(documents: DataFrame, dictionary: bytes) -> DataFrame:
    """``documents`` with ``spans``, base ones and new candidates by start, then kind as listed, and the number of the new ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        order = (*KINDS, NOVEL_KIND).index
        at = [names.index("base"), names.index("candidates")]
        for b in batches:
            spans, added = [], []
            for base, found in zip(*[b.column(i).to_pylist() for i in at], strict=True):
                new = [(NOVEL_KIND, c["start"], c["end"]) for c in found if novelty.is_new(c["value"], c["around"])]
                every = [*[(s["kind"], s["start"], s["end"]) for s in base], *new]
                spans.append(listed(sorted(every, key=lambda s: (s[1], order(s[0])))))
                added.append(len(new))
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(b.columns) if i not in at], pa.array(spans, pa.string()), pa.array(added, pa.int64())], names=kept)

    names = ["key", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "candidates"]
    kept = [*names[:-2], "spans", "n_novel"]
    schema = StructType([documents.schema[c] for c in names[:-2]]).add("spans", "string").add("n_novel", "long")
    return documents.select(*names).mapInArrow(run, schema)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, counts of base spans by kind, digest of the base spans, all spans, and how many the novelty adds.

    Null texts are empty; empty texts have no spans; an empty table gives an empty table; repeated rows get equal results; texts of any length are
    read whole; null keys are kept; other columns are not carried. Spans are ``kind:start:end`` (code points, end exclusive) by start, then kind.
    """
    found = cut_lineage(read(docs, key, text))
    dictionary = identifier_dictionary(found.filter("what = 'word'").select("word", "n"))
    out = novel_spans(found.filter("what = 'document'"), dictionary)
    return out.select(F.col("key").alias(key), *[c for c in out.columns if c != "key"])


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
