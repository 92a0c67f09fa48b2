"""Personal data by bootstrapped contextual extraction.

Seeds are the spans that the base rules find (e-mail, IP address, card, phone). Candidates are other identifier-like strings
outside base spans: tokens with a digit or an at sign, and runs of tokens with 9 to 19 digits inside places where a base rule
matched but its check failed. Every seed and candidate stands in a slot: the word before, the word after, and its own shape
(digits as 9, letters as a, and the kinds whose rule it would pass alone). A slot's lexical patterns are

* ``shape``: the shape;
* ``before`` and ``after``: the word, and the word together with the shape.

Spark scores the bipartite graph of patterns and instances in rounds until they believe no more (the log has their number). A pattern with at least ``MIN_SEEDS`` distinct seeds of a kind has as
confidence the share of its occurrences that are believed to be of the kind; occurrences of a word are counted over the whole corpus,
ordinary neighbours included, so chance contexts have a confidence near zero. One occurrence more than seen is assumed, so confidence grows with
evidence. A candidate's score in a slot is the noisy-or over the three sides of the most confident pattern of each; an
instance's score is the mean over all its occurrences. Instances that reach ``ACCEPT`` are believed in the next round. Seeds' own
values are believed wherever they stand. What a base rule would match whole but its check refuses (a card number with a wrong check digit) is never of
that kind, but counts against its patterns.

Documents and mentions leave one pass over the texts together; a second pass counts the words that enough seeds stand next to (if they are more than
``LOT``, it counts all words and joins). Everything after that is joins and aggregates of narrow rows. Values are known by a 128-bit
hash of the whole value, long words by a digest.
"""

from __future__ import annotations

import hashlib
import logging
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .shared import cut_lineage, table

log = logging.getLogger(__name__)
KINDS = ("email", "ip", "card", "phone")
#: Patterns need so many distinct seed instances; confidence and score bounds.
MIN_SEEDS, MIN_CONFIDENCE, ACCEPT = 5, 0.6, 0.9
#: Digits of a run of tokens; context words that every task may hold; words that a task counts before it hands the counts on; rows per result batch.
DIGITS, LOT, HELD_WORDS, SLICE = (9, 19), 50_000, 200_000, 2000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A token with a digit or an at sign; it starts where a token starts, so long tokens are read once.
CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
EDGE = ".,;:!?()[]{}<>\"'|*#%&$"
DIGIT = re.compile("[0-9]")
IDENTIFYING = re.compile("[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As ``[A-Za-z0-9._%+-]+@domain`` would find them, in linear time: anchored at each at sign."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, leftmost first: longer dotted runs are taken four numbers at a time."""
    for run in DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts, at = run[0].split("."), run.start()
        for i in range(0, len(parts), 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + len(four) - 1
            if len(four) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def _digits(x: str) -> str:
    return "".join(c for c in x if "0" <= c <= "9")


def _is_card(x: str) -> bool:
    return len(x) >= 13 and 13 <= len(d := _digits(x)) <= 19 and luhn(d)


def _is_phone(x: str) -> bool:
    return 9 <= len(_digits(x)) <= 15


def _found(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(base spans in order of kind as listed, then start; places where the card or phone rule matched and its check failed)."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    failed = []
    if DIGIT.search(text):
        spans += [("ip", a, b) for a, b in _ips(text)]
        for kind, rule, holds in (("card", CARD, _is_card), ("phone", PHONE, _is_phone)):
            for m in rule.finditer(text) if kind == "card" or "+" in text else ():
                if holds(m[0]):
                    spans.append((kind, *m.span()))
                elif " " in m[0]:
                    failed.append(m.span())
    return spans, failed


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans in order of kind as listed, then start."""
    return _found(text)[0]


def _word(word: str) -> str:
    """A word as contexts know it: itself, or its digest if it is longer than 40 characters."""
    return word if len(word) <= 40 else hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()


def _words(text: str) -> list[str]:
    """Lower case words between white space, without punctuation at the edges; none for punctuation only."""
    return [w if len(w) <= 40 else _word(w) for x in text.lower().split() if (w := x.strip(EDGE))]


def tokens(text: str, spans: list[tuple[str | None, int, int]]) -> tuple[list[str], list[tuple[str, str]]]:
    """The words of a text, and the word before and the word after each span, empty at the text's ends.

    Spans cut the text even where they are glued to their surroundings; a span, or spans that overlap, are one word. Contexts and
    the counts of how often their words are seen both come from these words.
    """
    words: list[str] = []
    at = [0] * len(spans)
    order = sorted(range(len(spans)), key=lambda i: spans[i][1:])
    end = k = 0
    while k < len(order):
        start, until = spans[order[k]][1:]
        words += _words(text[end:start])
        while k < len(order) and spans[order[k]][1] < until:
            until = max(until, spans[order[k]][2])
            at[order[k]] = len(words)
            k += 1
        words.append(_word(text[start:until].lower()))
        end = until
    words += _words(text[end:])
    return words, [(words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else "") for i in at]


def candidates(text: str, spans: list[tuple[str, int, int]], failed: list[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Identifier-like strings that touch no base span, in order: tokens without punctuation at the edges, and, inside ``failed``
    places, runs of tokens that have 9 to 19 digits together and begin and end with a token that has some."""
    out = set()
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        token = m[0]
        b -= len(token) - len(token.rstrip(EDGE))
        a += len(token) - len(token.lstrip(EDGE))
        if a < b and IDENTIFYING.search(text, a, b):
            out.add((a, b))
    for start, end in failed:
        parts, at = [], start  # tokens with digits: a run has at most 19 of them
        for p in text[start:end].split(" "):
            if n := len(_digits(p)):
                parts.append((at, at + len(p), n))
            at += len(p) + 1
        for i, (a, b, n) in enumerate(parts):
            for _, b, more in parts[i + 1 : i + DIGITS[1]]:
                n += more
                if n > DIGITS[1]:
                    break
                if n >= DIGITS[0]:
                    out.add((a, b))
    taken = sorted((a, b) for _, a, b in spans)
    starts, reach = [a for a, _ in taken], [0, *accumulate((b for _, b in taken), max)]  # the farthest end of the first spans
    return [(a, b) for a, b in sorted(out) if reach[bisect_left(starts, b)] <= a]


def shape(x: str) -> str:
    """How a value looks: digits as 9, runs of more than three with their length, runs of letters as a, all else as it is."""
    out = re.sub("[0-9]+", lambda m: "9" if len(m[0]) <= 3 else f"9{{{len(m[0])}}}", re.sub(r"[^\W\d_]+", "a", x))
    return _word(out)


def standing(x: str) -> tuple[int, int]:
    """(kinds whose base rule takes ``x`` whole, kinds whose pattern it has whole but whose check it fails) as bits in order of kind."""
    passes = fails = 0
    if next(_emails(x), None) == (0, len(x)):
        passes |= 1
    if re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", x):
        passes, fails = (passes | 2, fails) if next(_ips(x), None) == (0, len(x)) else (passes, fails | 2)
    for bit, rule, holds in ((4, CARD, _is_card), (8, PHONE, _is_phone)):
        if rule.fullmatch(x):
            passes, fails = (passes | bit, fails) if holds(x) else (passes, fails | bit)
    return passes, fails


def value(x: str) -> bytes:
    return xxhash.xxh3_128_digest(x.lower().encode("utf-8", "surrogatepass"))


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


#: What leaves the pass over the texts. Documents: counts, digest, spans and the text's hash. Mentions (``kind`` below 0: a candidate): place and slot.
FOUND = (
    "what string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, base array<struct<kind:int,start:int,end:int>>, text_hash binary, "
    "kind int, start int, end int, instance binary, fails int, shape string, before string, after string"
)


def _mentions(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str | None, int, int]]]:
    """(base spans, base spans and candidates) of a text."""
    if not IDENTIFYING.search(text):
        return [], []
    base, failed = _found(text)
    return base, [*base, *[(None, *c) for c in candidates(text, base, failed)]]


def read(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One pass over the texts: document rows with their key, and mention rows (see ``FOUND``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = StructType([StructField("key", docs.schema[key].dataType), *_parse_datatype_string(FOUND).fields])
    target = to_arrow_schema(schema)

    def batch(keys: pa.Array | None, what: str, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
        columns = dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}
        columns["what"] = [what] * len(rows)
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rows), f.type) for f in target]
        if keys is not None:
            arrays[0] = keys.cast(target.field("key").type)
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                b = whole.slice(i, SLICE)
                documents: list[tuple] = []
                mentions: list[tuple] = []
                for t in b.column(1):
                    x = t.as_py() or ""
                    base, every = _mentions(x)
                    hashed = xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass"))
                    counts = Counter(k for k, _, _ in base)
                    listed = [{"kind": KINDS.index(k), "start": s, "end": e} for k, s, e in base]
                    documents.append((*[counts[k] for k in KINDS], hashlib.sha256(_listed(base).encode()).hexdigest(), listed, hashed))
                    for (kind, s, e), (before, after) in zip(every, tokens(x, every)[1] if every else [], strict=True):
                        passes, fails = standing(x[s:e])
                        mentions.append((-1 if kind is None else KINDS.index(kind), s, e, value(x[s:e]), fails, f"{shape(x[s:e])} {passes}", before, after, hashed))
                yield batch(b.column(0), "document", [*[f"n_{k}" for k in KINDS], "base_sha256", "base", "text_hash"], documents)
                yield batch(None, "mention", ["kind", "start", "end", "instance", "fails", "shape", "before", "after", "text_hash"], mentions)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def word_counts(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """How often each ``word`` of ``wanted`` stands in the corpus: word, ``seen``. Tasks hold the wanted words if they are at most ``LOT``."""
    few = wanted.limit(LOT + 1).count() <= LOT
    held = frozenset(r["word"] for r in wanted.collect()) if few else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                x = t.as_py() or ""
                every = _mentions(x)[1]
                words = tokens(x, every)[0] if every else _words(x)
                total.update(words if held is None else filter(held.__contains__, words))
                if len(total) >= HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
                    total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = docs.select(text).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("seen"))
    return counted if few else counted.join(wanted, "word", "left_semi")


def _patterns() -> Column:
    """The patterns of a slot as an array of (side, pattern). Patterns with a shape hold a line end, which no word does."""
    pair = lambda side, pattern: F.struct(F.lit(side).alias("side"), pattern.alias("pattern"))
    of_word = lambda side: F.when(F.col(side) != "", F.array(pair(side, F.col(side)), pair(side, F.concat(side, F.lit("\n"), "shape")))).otherwise(F.array().cast("array<struct<side:string,pattern:string>>"))
    return F.concat(F.array(pair("shape", F.concat(F.lit("\n"), "shape"))), of_word("before"), of_word("after"))


SLOT = ["shape", "before", "after"]
PATTERN = ["side", "pattern"]


def learn(mentions: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Believed instances: ``kind``, ``instance``, ``score``; seeds' own values with score 1.

    ``mentions``: kind (below 0: candidate), instance, fails, shape, before, after. The words of ``docs`` are counted.
    """
    uses = cut_lineage(mentions.groupBy("kind", "instance", "fails", *SLOT).agg(F.count(F.lit(1)).alias("n")))
    edges = uses.select("kind", "instance", "fails", *SLOT, "n", F.inline(_patterns()))
    known = uses.filter("kind >= 0").select("kind", "instance").distinct().withColumn("score", F.lit(1.0))
    seeds = edges.filter("kind >= 0").groupBy("kind", *PATTERN, "instance").agg(F.sum("n").alias("n"))
    hits = cut_lineage(seeds.groupBy("kind", *PATTERN).agg(F.count(F.lit(1)).alias("seeds"), F.sum("n").alias("hits")).filter(F.col("seeds") >= MIN_SEEDS))
    if hits.isEmpty():
        return known
    with_shape = F.contains("pattern", F.lit("\n"))
    words = word_counts(docs, hits.filter(~with_shape).select(F.col("pattern").alias("word")).distinct(), text)
    filled = edges.groupBy(*PATTERN).agg(F.sum("n").alias("filled"))
    rated = hits.join(filled, PATTERN).join(words.withColumnRenamed("word", "pattern"), "pattern", "left")
    # a word may have ordinary neighbours too; a shape only seeds and candidates
    rated = rated.withColumn("seen", F.when(with_shape, F.col("filled")).otherwise(F.greatest("filled", F.coalesce("seen", F.lit(0)))) + 1)
    # what seeds and candidates fill less often than the least confidence asks can never reach it
    rated = cut_lineage(rated.filter(F.col("filled") >= MIN_CONFIDENCE * F.col("seen")).select("kind", *PATTERN, "hits", "seen"))
    open_ = edges.filter("kind < 0").drop("kind").join(rated.select("kind", *PATTERN), PATTERN)
    open_ = cut_lineage(open_.filter("shiftright(fails, kind) & 1 = 0"))
    often = uses.filter("kind < 0").groupBy("instance").agg(F.sum("n").alias("all_n"))
    believed, found, rounds = known, -1, 0
    while True:
        rounds += 1
        gained = open_.join(believed.select("kind", "instance"), ["kind", "instance"]).groupBy("kind", *PATTERN).agg(F.sum("n").alias("gained"))
        patterns = rated.join(gained, ["kind", *PATTERN], "left")
        patterns = patterns.select("kind", *PATTERN, ((F.col("hits") + F.coalesce("gained", F.lit(0))) / F.col("seen")).alias("confidence")).filter(F.col("confidence") >= MIN_CONFIDENCE)
        accepted = cut_lineage(instance_scores(open_, patterns, often).filter(F.col("score") >= ACCEPT))
        believed = known.unionByName(accepted).groupBy("kind", "instance").agg(F.max("score").alias("score"))
        before, found = found, accepted.count()
        if found == max(before, 0):  # confidences only grow from round to round: nothing new is nothing more
            break
    log.info("beliefs settled in round %d: %d candidates", rounds, found)
    return believed


def instance_scores(edges: DataFrame, patterns: DataFrame, often: DataFrame) -> DataFrame:
    """``kind``, ``instance``, ``score``: the mean over an instance's occurrences of the noisy-or over sides of the best pattern's confidence."""
    joined = edges.join(patterns, ["kind", *PATTERN])
    sides = joined.groupBy("kind", "instance", *SLOT, "n", "side").agg(F.max("confidence").alias("c"))
    slots = sides.groupBy("kind", "instance", *SLOT, "n").agg((1 - F.exp(F.sum(F.log1p(-F.least("c", F.lit(0.999)))))).alias("s"))
    each = slots.groupBy("kind", "instance").agg(F.sum(F.col("n") * F.col("s")).alias("s"))
    return each.join(often, "instance").select("kind", "instance", (F.col("s") / F.col("all_n")).alias("score"))


def _without_overlaps(spans: Column) -> Column:
    """Spans (start, to, kind; sorted) of which none starts before an earlier chosen one ends."""
    none = F.array().cast("array<struct<start:int,to:int,kind:int>>")
    take = lambda chosen, s: F.when(F.coalesce(F.get(chosen, F.size(chosen) - 1)["to"] <= s["start"], F.lit(True)), F.concat(chosen, F.array(s))).otherwise(chosen)
    return F.aggregate(spans, none, take)


def extract(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, counts of base spans by kind, digest of the base spans, all spans, and the numbers of all and of added ones.

    Null texts are empty; empty texts have no spans; an empty table gives an empty table; repeated rows get equal results; texts of any length are
    read whole, in time linear in their length; null keys are kept. Where added spans overlap, the first and of equal starts the longest
    is taken, and of kinds the one with the best score. Other columns are not carried. Spans are ``kind:start:end`` (code points, end exclusive) in order of
    kind, then start.
    """
    found = cut_lineage(read(docs, key, text))
    mentions = found.filter("what = 'mention'")
    believed = learn(mentions, docs, text)
    best = believed.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b")).select("instance", (-F.col("b.k")).alias("as_kind"))
    placed = mentions.filter("kind < 0").select("text_hash", "start", "end", "instance").distinct().join(best, "instance")
    listed = F.array_sort(F.collect_list(F.struct("start", (-F.col("end")).alias("e"), F.col("as_kind").alias("kind"))))
    flat = F.transform(listed, lambda s: F.struct(s["start"].alias("start"), (-s["e"]).alias("to"), s["kind"].alias("kind")))
    more = placed.groupBy("text_hash").agg(_without_overlaps(flat).alias("added")).select("text_hash", F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["to"].alias("end"))).alias("added"))
    names = F.array(*[F.lit(k) for k in KINDS])
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    every = F.array_sort(F.concat("base", F.coalesce("added", none)))
    spelled = F.array_join(F.transform(every, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    rows = found.filter("what = 'document'").select("key", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "text_hash")
    joined = rows.join(more, "text_hash", "left")
    added = F.coalesce(F.size("added"), F.lit(0)).cast("long")
    return joined.select(F.col("key").alias(key), *[f"n_{k}" for k in KINDS], "base_sha256", spelled.alias("spans"), (F.size("base") + added).alias("n_spans"), added.alias("n_added"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "documents").select("doc_id", "text"))
