"""Strict CSV of any size: files are read in byte ranges, all of them in parallel.

Whether a place in a CSV file stands inside quotes depends on everything before it. But a range of whole lines is a function from the
state at its start (between records, or inside quotes) to the state at its end, and both values of that function can be found
without what comes before. So

1. every range is parsed from both states: where it ends, how many records begin in it, where it fails;
2. a file's ranges, a few numbers each, are composed in order: the state and the number of records before each range, or the file's failure;
3. every range is parsed once more from the state that is now known. Records that go on in later ranges leave as pieces, which meet by record.

Ranges come from Spark's line reader (``read_ranges``), which splits large files itself, or from contents that are already cells (``cut``). A line
ends with a line feed here; carriage returns are the parser's business. What a task holds is a range, or a record if one is longer.
Encodings must be ASCII-compatible, so that a line feed is one byte.
"""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range that tasks aim at; ranges of which the states may be broadcast (about 100 bytes each); rows and bytes or characters from which a result batch leaves.
RANGE_BYTES, FEW_RANGES, ROWS, BATCH_BYTES = 8 << 20, 100_000, 10_000, 8 << 20
#: Bytes of a byte-order mark, which is no part of the first value.
MARK = b"\xef\xbb\xbf"
BY = ["batch_id", "file_name"]
RANGES = "batch_id string, file_name string, start bigint, part int, content binary"
RECORDS = "batch_id string, file_name string, kind string, row_number int, fields array<string>, detail string"
INSIDE = '"'


ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<array<string>>": pa.list_(pa.list_(pa.string()))}


def arrow_schema(kinds: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (x.split() for x in kinds.split(", "))])


def _size(x: str | bytes | list) -> int:
    if not isinstance(x, list):
        return len(x)
    if x and isinstance(x[0], list):
        return len(x) + sum(map(len, x)) + sum(map(len, chain.from_iterable(x)))
    return sum(map(len, x))


def batched(rows: Iterable[tuple], schema: pa.Schema, sized: tuple[int, ...] = ()) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, whatever files they come from. ``sized``: columns (texts, bytes, lists of texts or of rows) whose sizes count too."""
    held, n = [], 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        for x in (row[i] for i in sized):
            n += 0 if x is None else _size(x)
        if len(held) >= ROWS or n >= BATCH_BYTES:
            yield done()
            held, n = [], 0
    if held:
        yield done()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _by(rows: Iterable[tuple], n: int) -> Iterator[list[tuple]]:
    """Sorted rows in groups by their first ``n`` columns."""
    for _, group in groupby(rows, key=lambda r: r[:n]):
        yield list(group)


def ascii_compatible(encoding: str) -> bool:
    return "\n,\"".encode(encoding) == b"\n,\""


def _grouped(lines: Iterable[bytes], size: int) -> Iterator[bytes]:
    """Whole lines in contents of about ``size`` bytes."""
    held, n = [], 0
    for x in lines:
        held.append(x)
        n += len(x)
        if n >= size:
            yield b"".join(held)
            held, n = [], 0
    if held:
        yield b"".join(held)


def cut(files: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """Ranges of files whose ``content`` is a cell: batch_id, file_name, content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((b, n, 0, part, x) for b, n, c in _rows(batches) for part, x in enumerate(_grouped(io.BytesIO(c), size)))
        yield from batched(parts, arrow_schema(RANGES), sized=(4,))

    return files.select(*BY, "content").mapInArrow(run, RANGES)


def read_ranges(spark: SparkSession, paths: list[str], size: int = RANGE_BYTES) -> DataFrame:
    """Ranges of files in folders named by their batch. A file that is larger than Spark's partitions is read by several tasks."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = lines.select(F.regexp_extract(path, r"([^/]+)/[^/]+\z", 1).alias("batch_id"), F.regexp_extract(path, r"([^/]+)\z", 1).alias("file_name"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("content"))

    def ranges(rows: Iterator[tuple]) -> Iterator[tuple]:
        # a task's lines come in order, split by split
        at, part, held, n = None, 0, [], 0
        for *here, x in rows:
            if here != at:
                if held:
                    yield (*at, part, b"\n".join([*held, b""]))
                at, part, held, n = here, 0, [], 0
            held.append(x)
            n += len(x) + 1
            if n >= size:
                yield (*at, part, b"\n".join([*held, b""]))
                part, held, n = part + 1, [], 0
        if held:
            yield (*at, part, b"\n".join([*held, b""]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(ranges(_rows(batches)), arrow_schema(RANGES), sized=(4,))

    return lines.mapInArrow(run, RANGES)


def _lines(text: str) -> Iterator[str]:
    """A text in lines as the parser wants them: ended by a line feed, a carriage return, or both."""
    return iter(io.StringIO(text, newline=""))


class _Watched:
    """Lines of a range, and how many were taken; ``over`` once they have all been."""

    def __init__(self, lines: Iterator[str]):
        self.lines, self.taken, self.over = lines, 0, False

    def __iter__(self) -> _Watched:
        return self

    def __next__(self) -> str:
        try:
            x = next(self.lines)
        except StopIteration:
            self.over = True
            raise
        self.taken += 1
        return x


def parsed(text: str, inside: bool) -> tuple[list[tuple[int, list[str]]], int, bool, bool]:
    """Records of a text that starts between records, or inside quotes: ([(lines up to its end, fields)], lines of whole records, ends inside quotes, failed).

    A text that starts inside quotes has the end of a record as its first one.
    """
    csv.field_size_limit(1 << 31)
    lines = _Watched(_lines(INSIDE + text if inside else text))
    reader, found, whole = csv.reader(lines, strict=True), [], 0
    try:
        for row in reader:
            whole = lines.taken
            found.append((whole, row))
    except csv.Error:
        return found, whole, lines.over, not lines.over
    return found, whole, False, False


def _decoded(content: bytes, codec: str, first: bool) -> tuple[str, int | None]:
    """(text, offset of what can't be decoded). A byte-order mark at a file's start is taken off."""
    if first and codec == "utf-8" and content.startswith(MARK):
        content = content[len(MARK) :]
    try:
        return content.decode(codec), None
    except UnicodeDecodeError as e:
        return "", e.start


#: Of a range: its bytes, the first that can't be decoded, and from either state the records that begin, the state at its end, the record (from 0: of those that begin)
#: at which it fails (-1: the one that was open), and whether its first line is blank.
SUMMARY = "batch_id string, file_name string, start bigint, part int, bytes bigint, bad bigint, begun0 bigint, begun1 bigint, end0 boolean, end1 boolean, fails0 bigint, fails1 bigint, blank boolean"


def summaries(ranges: DataFrame, encoding: str = "utf-8") -> DataFrame:
    codec = codecs.lookup(encoding).name

    def of(content: bytes, first: bool) -> tuple:
        text, bad = _decoded(content, codec, first)
        size = len(content) - len(MARK) * (first and codec == "utf-8" and content.startswith(MARK))
        if bad is not None:
            return size, bad, 0, 0, False, False, None, None, False
        found, _, end0, failed0 = parsed(text, False)
        begun0, blank = len(found) + end0, bool(found) and not found[0][1]
        if INSIDE not in text:  # then the quotes stay open
            return size, None, begun0, 0, end0, True, len(found) if failed0 else None, None, blank
        del found
        found, _, end1, failed1 = parsed(text, True)
        begun1 = max(0, len(found) + end1 - 1)
        return size, None, begun0, begun1, end0, end1, begun0 if failed0 else None, (len(found) - 1 if failed1 else None), blank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((b, n, s, p, *of(c, s == 0 and p == 0)) for b, n, s, p, c in _rows(batches)), arrow_schema(SUMMARY))

    return ranges.select("batch_id", "file_name", "start", "part", "content").mapInArrow(run, SUMMARY)


STATES = "batch_id string, file_name string, start bigint, part int, inside boolean, before bigint, detail string"


def composed(summary: DataFrame) -> DataFrame:
    """Per range: whether it starts inside quotes and how many records begin before it; ``detail``, the file's failure, is on all ranges of a file that has one."""

    def of(ranges: list[tuple]) -> Iterator[tuple]:
        inside, before, offset, failure, undecoded, rows = False, 0, 0, None, None, []
        for batch, name, start, part, size, bad, begun0, begun1, end0, end1, fails0, fails1, _ in ranges:
            rows.append((batch, name, start, part, inside, before))
            if undecoded is None and bad is not None:
                undecoded = f"ENCODING_ERROR(byte_offset={offset + bad})"
            offset += size
            if failure is None:
                fails = fails1 if inside else fails0
                if fails is not None:
                    failure = before + fails
                before += begun1 if inside else begun0
                inside = end1 if inside else end0
        if failure is None and inside:  # the file ends inside quotes
            failure = before - 1
        detail = undecoded
        if detail is None and failure is not None:
            detail = f"CSV_PARSE_ERROR({'header' if failure == 0 else f'record={failure}'})"
        if detail is None and (ranges[0][-1] or not before):
            detail = "HEADER_MISSING"
        return ((*r, detail) for r in rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # files follow each other in a task: what is held is a file's numbers
        yield from batched((row for ranges in _by(_rows(batches), len(BY)) for row in of(ranges)), arrow_schema(STATES))

    return summary.repartition(*BY).sortWithinPartitions(*BY, "start", "part").mapInArrow(run, STATES)


def read_strict_csv_ranges(ranges: DataFrame, files: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """Header, records and problems of each file, as ``landing.read_strict_csv`` gives them, from ``ranges``.

    ``files``: batch_id, file_name of all files that are to be read; those without a range are empty. ``ranges`` is read twice.
    """
    if not ascii_compatible(encoding):
        raise ValueError("line feeds of this encoding aren't one byte: its files can't be read in ranges")
    codec = codecs.lookup(encoding).name
    states = composed(summaries(ranges, encoding)).persist()  # some numbers for each range
    few = states.count() <= FEW_RANGES
    joined = ranges.join(F.broadcast(states) if few else states, [*BY, "start", "part"]).filter("detail IS NULL")
    pieces = "batch_id string, file_name string, kind string, row_number int, fields array<string>, start bigint, part int, piece string"

    def rows_of(b: str, n: str, start: int, part: int, content: bytes, inside: bool, before: int) -> Iterator[tuple]:
        text, _ = _decoded(content, codec, start == 0 and part == 0)
        found, whole, open_, _ = parsed(text, inside)
        lines = list(_lines(text))
        first = before - 1 if inside else before  # the number of the first record that the parser gives
        if inside:
            head = found[0][0] if found else len(lines)
            yield b, n, "piece", first, None, start, part, "".join(lines[:head])
        for k, (_, row) in enumerate(found):
            if k or not inside:
                yield b, n, "record" if first + k else "header", first + k, row, start, part, None
        if open_ and (found or not inside):
            yield b, n, "piece", first + len(found), None, start, part, "".join(lines[whole:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((x for r in _rows(batches) for x in rows_of(*r)), arrow_schema(pieces), sized=(4, 7))

    def put_together(found: Iterable[str]) -> list[str]:
        csv.field_size_limit(1 << 31)
        return next(csv.reader(_lines("".join(found)), strict=True))

    read = joined.select(*BY, "start", "part", "content", "inside", "before").mapInArrow(run, pieces)
    whole = read.filter("kind <> 'piece'").select(*BY, "kind", "row_number", "fields", F.lit(None).cast("string").alias("detail"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # records follow each other in a task, each with its pieces in order
        records = ((*r[0][:2], "record" if r[0][2] else "header", r[0][2], put_together(x[-1] for x in r), None) for r in _by(_rows(batches), 3))
        yield from batched(records, arrow_schema(RECORDS), sized=(4,))

    split = read.filter("kind = 'piece'").select(*BY, "row_number", "start", "part", "piece")
    met = split.repartition(*BY, "row_number").sortWithinPartitions(*BY, "row_number", "start", "part").mapInArrow(meet, RECORDS)
    failed = states.filter("detail IS NOT NULL").select(*BY, "detail").distinct()
    empty = files.select(*BY).join(states.select(*BY).distinct(), BY, "left_anti").withColumn("detail", F.lit("HEADER_MISSING"))
    failures = failed.unionByName(empty).select(*BY, F.lit("failure").alias("kind"), F.lit(None).cast("int").alias("row_number"), F.lit(None).cast("array<string>").alias("fields"), "detail")
    return whole.unionByName(met).unionByName(failures)
