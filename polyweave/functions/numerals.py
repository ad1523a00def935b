"""Numerals and list markers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
CHINESE_DIGITS = "零一二三四五六七八九"
CHINESE_UNITS = {"十": 10, "百": 100, "千": 1000}


def _lookup(values: dict[str, int], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in values.items() for v in kv]), key)


def all_digits(x: Column) -> Column:
    """The digits of the text as one number, 0 without any."""
    return F.coalesce(F.nullif(F.regexp_replace(x, r"\D", ""), F.lit("")).try_cast("int"), F.lit(0))


def after_last_dot(x: Column) -> Column:
    return F.regexp_extract(F.trim(x), r"([^.]*)$", 1).try_cast("int")


def _fold(chars: Column, values: dict[str, int], step) -> Column:
    known = F.filter(F.transform(F.reverse(chars), lambda c: _lookup(values, c)), lambda v: v.isNotNull())
    return F.aggregate(known, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")), step, lambda acc: acc["sum"])


def roman(x: Column) -> Column:
    """A Roman numeral's value, other characters aside: from the right, a digit below the one before counts as negative."""
    step = lambda acc, d: F.struct(F.when(d < acc["last"], acc["sum"] - d).otherwise(acc["sum"] + d).alias("sum"), d.alias("last"))
    return _fold(F.split(x, ""), ROMAN, step)


def chinese(x: Column) -> Column:
    """A Chinese numeral below ten thousand, other characters aside: from the right, digits count by the unit before them, a unit without a digit once."""
    values = {c: i for i, c in enumerate(CHINESE_DIGITS)} | {c: -v for c, v in CHINESE_UNITS.items()}
    known = F.filter(F.transform(F.reverse(F.split(x, "")), lambda c: _lookup(values, c)), lambda v: v.isNotNull())
    zero = F.struct(F.lit(0).alias("sum"), F.lit(1).alias("unit"), F.lit(False).alias("bare"))

    def step(acc: Column, v: Column) -> Column:
        settled = acc["sum"] + F.when(acc["bare"], acc["unit"]).otherwise(0)
        return F.when(v < 0, F.struct(settled.alias("sum"), (-v).alias("unit"), F.lit(True).alias("bare"))).otherwise(F.struct((acc["sum"] + v * acc["unit"]).alias("sum"), acc["unit"].alias("unit"), F.lit(False).alias("bare")))

    return F.aggregate(known, zero, step, lambda acc: acc["sum"] + F.when(acc["bare"], acc["unit"]).otherwise(0))


def letter(first: str):
    """0 for the first letter of that case in the text, 1 for the next."""
    return lambda x: F.ascii(F.regexp_extract(x, "[a-z]" if first == "a" else "[A-Z]", 0)) - ord(first)


#: List markers at the start of a stripped line, first match wins (fixed values): name, pattern, how the counter is read.
MARKERS = (
    ("number_dot", r"^\d{1,3}\. ", all_digits),
    ("bullet", r"^• ", lambda x: F.lit(None)),
    ("dotted", r"^\d{1,2}\.\d{1,2} ", after_last_dot),
    ("roman_dot", r"^[IVX]{1,5}\. ", roman),
    ("letter_parens", r"^\([a-z]\) ", letter("a")),
    ("letter_paren", r"^[a-z]\) ", letter("a")),
    ("number_paren", r"^\d{1,3}\) ", all_digits),
    ("number_parens", r"^\(\d{1,3}\) ", all_digits),
    ("capital_dot", r"^[A-Z]\. ", letter("A")),
    ("chinese_comma", r"^[一二三四五六七八九十]{1,3}、", chinese),
    ("chinese_dot", r"^[一二三四五六七八九十]{1,3}\. ", chinese),
    ("chinese_parens", r"^\([一二三四五六七八九十]{1,3}\) ", chinese),
)


def marker(line: Column) -> Column:
    """struct(rule, counter) of the first list marker that the line starts with; NULL without one. Bullets have no counter."""
    out = F.lit(None).cast("struct<rule:string,counter:int>")
    for name, pattern, read in reversed(MARKERS):
        out = F.when(line.rlike(pattern), F.struct(F.lit(name).alias("rule"), read(F.regexp_extract(line, pattern, 0)).cast("int").alias("counter"))).otherwise(out)
    return out
