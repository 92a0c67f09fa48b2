"""Text helpers that the cleaning functions share. All are Column expressions: nothing leaves the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Unicode sees it; Spark's own trim takes U+0020 only.
SPACE = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: The same characters, for trimming.
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

# Words that stand for "no value yet".
PLACEHOLDERS = ("N/A", "PENDING", "TBD")


def full(pattern: str) -> str:
    """``pattern`` over the whole text (Java's ``$`` would also match before a last line end)."""
    return rf"\A(?:{pattern})\z"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends; null is empty."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Stripped, with single spaces inside."""
    return F.regexp_replace(strip(c), rf"{SPACE}+", " ")


def normalise_key(c: Column) -> Column:
    """A spelling's lookup key: single spaces, none around hyphens, upper case."""
    return F.upper(F.regexp_replace(collapse(c), r" ?- ?", "-"))


def is_placeholder(c: Column) -> Column:
    return F.upper(strip(c)).isin(*PLACEHOLDERS)


def field(value: Column, reason: Column | None = None, warning: Column | None = None) -> Column:
    """A cleaned field: ``struct<value, reason, warning>``. A reason takes the value away."""
    reason = F.lit(None).cast("string") if reason is None else reason
    warning = F.lit(None).cast("string") if warning is None else warning
    present = reason.isNull()
    return F.struct(F.when(present, value).alias("value"), reason.alias("reason"), F.when(present, warning).alias("warning"))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The code of the first rule that holds, else null."""
    return reduce(lambda done, rule: done.when(*rule), rules[1:], F.when(*rules[0]))


class Steps:
    """Columns of one field on its way, step by step. A step's columns are computed once per row, however often later steps use them: the
    optimizer doesn't merge a projection into one that uses its expressions twice.

    A field ends with ``once``, which also ends the Java method that Spark generates: the methods of several fields in a row stay
    short enough to be compiled (HotSpot interprets those of more than 8,000 bytes, many times slower)."""

    def __init__(self, df: DataFrame, out: str):
        self.df, self.out, self.names = df, out, []

    def __getitem__(self, name: str) -> Column:
        return F.col(f"_{self.out}_{name}")

    def add(self, **columns: Column) -> None:
        self.names += [f"_{self.out}_{n}" for n in columns]
        self.df = self.df.withColumns({f"_{self.out}_{n}": c for n, c in columns.items()})

    def done(self, value: Column, reason: Column, warning: Column | None = None) -> DataFrame:
        """The table with the cleaned field and without the steps."""
        self.add(value=value, reason=reason, **({} if warning is None else {"warning": warning}))
        kept = [c for c in self.df.columns if c not in (*self.names, self.out)]
        return once(self.df.drop(self.out), **{self.out: field(self["value"], self["reason"], None if warning is None else self["warning"])}).select(*kept, self.out)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once per row, however often they are used: the optimizer doesn't inline a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def expand(prefix: str, cleaned: Column, warning: bool = True) -> list[Column]:
    """A cleaned field as columns ``<prefix>``, ``<prefix>_reason`` and ``<prefix>_warning``."""
    out = [cleaned["value"].alias(prefix), cleaned["reason"].alias(f"{prefix}_reason")]
    return [*out, cleaned["warning"].alias(f"{prefix}_warning")] if warning else out


def lookup(mapping: dict[str, object], key: Column) -> Column:
    """A small fixed mapping as an expression; null for other keys."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)
