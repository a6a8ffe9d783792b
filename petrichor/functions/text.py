"""Text predicates, extraction, templates and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def starts_with_letter(c: Column) -> Column:
    """True for a text whose first character is a letter; false for null."""
    return F.coalesce(c.rlike(r"^\p{L}"), F.lit(False))


def to_double(c: Column) -> Column:
    """Text to double; what is not a number, NaN included, becomes null."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def text_between(c: Column, start: str, end: str) -> Column:
    """Text after the first ``start`` and before the first ``end`` of the whole text.

    Empty when either delimiter is missing or ``end`` stands before ``start``.
    """
    first, last = F.instr(c, start), F.instr(c, end)
    begin = first + F.lit(len(start))
    return F.when((first > 0) & (last > 0), F.substring(c, begin, last - begin)).otherwise("")


def file_name(data_id: Column, period: Column) -> Column:
    return F.format_string("%s.%s.csv", data_id, period)


def from_template(template: str, *cols: Column) -> Column:
    """Fill a ``%1$s``-style template."""
    return F.format_string(template, *cols)


def fixed_text(c: Column, digits: int) -> Column:
    """A double with so many decimals, rounded from its exact value, ties to even.

    ``format_string`` rounds ties of the shortest decimal text upward, which differs in the last
    digit. Splitting the double into two short parts keeps the distance to the tie exact.
    """
    scale = 10**digits
    coarse = c.cast("float").cast("double")
    below = F.floor(c * scale).cast("double")
    beyond = (coarse * (2 * scale) - (below * 2 + 1)) + (c - coarse) * (2 * scale)
    up = (beyond > 0) | ((beyond == 0) & (below % 2 != 0))
    return F.format_string(f"%.{digits}f", (below + up.cast("int")) / scale)


def percent_text(c: Column) -> Column:
    """0.123 as ``12.3%``; null stays null."""
    return F.when(c.isNotNull(), F.concat(fixed_text(c * 100, 1), F.lit("%")))


def metric_text(c: Column) -> Column:
    """Three decimals, blank when absent."""
    return F.when(c.isNotNull(), fixed_text(c, 3)).otherwise("")


def cp1252_text(content: Column) -> Column:
    """Windows-1252 bytes as text.

    Spark decodes ISO-8859-1 natively; the two differ only in bytes 0x80-0x9F, which are
    mapped here. The five bytes without a meaning become U+FFFD.
    """
    block = bytes(range(0x80, 0xA0))
    return F.translate(
        F.decode(content, "ISO-8859-1"),
        block.decode("latin-1"),
        block.decode("cp1252", errors="replace"),
    )


def unix_text(c: Column) -> Column:
    """The text with every usual line end turned into a line feed."""
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def is_data_line(line: Column) -> Column:
    """Neither empty nor opening with a quote."""
    return (line != "") & ~line.startswith('"')
