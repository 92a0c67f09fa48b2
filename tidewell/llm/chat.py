"""Chat formatting by incremental black-box rendering.

The renderer is any function from a list of turns ``(role, text)`` to one string; nothing about its marks is assumed.
For each turn the conversation up to it is rendered. If every output starts with the one before, the turn's span is what was
added. Where the text sits inside the span is found with a probe: the same prefix with the last text replaced by a
mark that the conversation doesn't hold shows what stands before and after the text, and the real rendering must agree with it. A renderer whose output for a
longer prefix does not start with the output for the shorter one rewrites history: this is reported with the first
turn at which it happens, and spans are then located in the final output by probing each turn inside the whole conversation.

The built-in template writes ``<s>[role]\\n text </s>\\n`` and puts a backslash into every control string in a role or text,
so that marks in the output are always its own; ``unescape`` takes the backslashes out again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

Turn = tuple[str, str]
CONTROL = re.compile(r"\\|(?<=<)(?=/?s>)|(?<=\[)(?=/?INST\])|(?<=<)(?=\|)")


def escape(text: str) -> str:
    """A backslash before every backslash and inside every control string (``<s> </s> [INST] [/INST] <|``)."""
    return CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@lru_cache(maxsize=None)
def _rendered(turn: Turn) -> str:
    return f"<s>[{escape(turn[0])}]\n{escape(turn[1])}</s>\n"


def render(turns: Sequence[Turn]) -> str:
    """The built-in template. A turn is escaped once, however many prefixes it is rendered in (``locate`` forgets them in the end)."""
    return "".join(map(_rendered, turns))


class Located:
    """A rendered conversation: output, span of each turn and of its text, and the first turn that rewrote history."""

    def __init__(self, output: str, turns: list[tuple[int, int]], texts: list[tuple[int, int]], rewritten_at: int | None):
        self.output, self.turns, self.texts, self.rewritten_at = output, turns, texts, rewritten_at


def probe_for(output: str) -> str:
    """A string of lower-case letters that ``output`` doesn't hold: its run of x is longer than any there. Letters pass most templates unchanged."""
    return "q" + "x" * (1 + max(map(len, re.findall("x+", output)), default=0)) + "q"


def _around(template: Callable[[Sequence[Turn]], str], turns: Sequence[Turn], k: int, output: str, mark: str, before: str = "") -> tuple[int, int]:
    """Where turn ``k``'s text sits in ``output``, the rendering of ``turns``: found with a probe in its place. (-1, -1): nowhere.

    ``before`` is how ``output`` is known to start; beyond it only the rest is looked at.
    """
    probed = template([*turns[:k], (turns[k][0], mark), *turns[k + 1 :]])
    known = len(before) if probed.startswith(before) else 0
    start = probed.find(mark, known)
    if start < 0:
        return -1, -1
    end = len(output) - (len(probed) - start - len(mark))
    same = end >= start and output[known:start] == probed[known:start] and output[end:] == probed[start + len(mark) :]
    if probed.find(mark, start + 1) >= 0 or not same:
        raise ValueError(f"the template's output around turn {k} depends on its text")
    return start, end


class _Prefixes:
    """What rendering successive prefixes of ``turns`` has shown: spans of turns and of texts, until ``rewritten_at``."""

    def __init__(self, turns: Sequence[Turn], template: Callable[[Sequence[Turn]], str], mark: str):
        self.before, self.spans, self.texts, self.rewritten_at = "", [], [], None
        for k in range(len(turns)):
            prefix = turns[: k + 1]
            output = template(prefix)
            if not output.startswith(self.before):
                self.rewritten_at = k
                return
            if mark in output[max(0, len(self.before) - len(mark)) :]:  # a template that says more before it ends
                mark = probe_for(output)
            start, end = _around(template, prefix, k, output, mark, self.before)
            if start < len(self.before):  # also when the text is missing
                self.rewritten_at = k
                return
            self.spans.append((len(self.before), len(output)))
            self.texts.append((start, end))
            self.before = output


def locate(turns: Sequence[Turn], template: Callable[[Sequence[Turn]], str] = render) -> Located:
    """Render successive prefixes and locate every turn. No turns: an empty rendering is expected of the template.

    Every prefix is rendered whole, twice: only so does a black box show at which turn it rewrites what it said before. The characters that are written and
    compared grow with the square of a conversation's length (5,000 turns of 1,000 characters: some seconds); one output is held at a time.
    """
    try:
        final = template(turns) if turns else ""
        seen = _Prefixes(turns, template, probe_for(final))
        spans, texts = seen.spans, seen.texts
        if seen.rewritten_at is not None:
            mark = probe_for(final)
            texts = [_around(template, turns, k, final, mark) for k in range(len(turns))]
            spans = list(texts)  # where turns begin and end can't be told apart any more
        return Located(final, spans, texts, seen.rewritten_at)
    finally:
        _rendered.cache_clear()


def digest(x: str) -> str:
    return hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()


FORMATTED = (
    "conv_id {kind}, n_turns bigint, formatted string, turn_starts array<int>, turn_ends array<int>, text_starts array<int>, text_ends array<int>, "
    "loss_mask array<boolean>, rewritten_at int"
)


def format_conversations(conversations: DataFrame, template: Callable[[Sequence[Turn]], str] = render, train_on: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation: the formatted text, spans (code points, end exclusive), and which texts are under the loss mask.

    Turns are ordered by ``turn``, ties by role and text; null texts and roles are empty; null ``conv_id`` is a conversation of its own;
    repeated rows are repeated turns; texts of any length are rendered whole; an empty table gives an empty table. A conversation is one row of the result, so its turns meet in one task: texts are
    gathered by a partial aggregate, and memory is bounded by the longest conversation. Other columns are not carried.
    """
    turns = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turns)).alias("turns"))
    schema = FORMATTED.format(kind=conversations.schema["conv_id"].dataType.simpleString())
    names = [c.split()[0] for c in schema.split(", ")]
    target = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, rendered in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held = [(t["role"], t["text"]) for t in rendered.as_py()]
                x = locate(held, template)
                rows.append((conv, len(held), x.output, [s for s, _ in x.turns], [e for _, e in x.turns], [s for s, _ in x.texts], [e for _, e in x.texts], [r in train_on for r, _ in held], x.rewritten_at))
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)] if rows else [pa.array([], type=f.type) for f in target]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))
    return grouped.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text holds, read from its spans."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                text, turns, loss = r["formatted"], [], []
                for a, s, e, masked in zip(r["turn_starts"], r["text_starts"], r["text_ends"], r["loss_mask"], strict=True):
                    role = unescape(text[a:s][len("<s>[") : -len("]\n")])
                    said = unescape(text[s:e])
                    turns.append(f"{role}\n{said}\n")
                    loss += [said] * masked
                out.append((r["conv_id"], r["n_turns"], digest("".join(turns)), len("".join(loss)), digest("".join(loss)), len(text), r["rewritten_at"]))
            columns = list(zip(*out, strict=True)) or [()] * 7
            types = [b.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten_at"])

    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewritten_at int"
    return formatted.mapInArrow(run, schema)


#: A conversation that says the marks of a common template, to show that they survive.
HOSTILE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with the number -1; turns that the table has under that number are turns of it."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame(HOSTILE, "conv_id bigint, turn bigint, role string, text string")
    return read_back(format_conversations(conversations.unionByName(hostile))).drop("rewritten_at")


OP9_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
x AS (SELECT *, length(text) + length(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|<\|')) + length(role) + length(regexp_extract_all(role, '\\|</?s>|\[/?INST\]|<\|')) + 11 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM x GROUP BY conv_id
"""
