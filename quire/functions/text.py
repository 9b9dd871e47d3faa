"""Column functions that follow Python's string methods, where Spark's differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.arrays import let

#: What str.strip() takes for white space, by code point ranges.
SPACE = "".join(chr(c) for a, b in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for c in range(a, b + 1))
#: What str.splitlines() takes for a line end.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE))


def splitlines(text: Column) -> Column:
    """Lines without their ends; a line end at the very end adds no empty line."""
    cut = lambda lines: F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    return let(F.split(text, LINE_END, -1), cut)


def strip_char(text: Column, char: str) -> Column:
    return F.btrim(text, F.lit(char))


def non_empty(text: Column) -> Column:
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))
