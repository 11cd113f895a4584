"""Text expressions: Python-style stripping, ids, captions, error labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as the inside of a character class.
WHITESPACE_CLASS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITESPACE_RUN = f"[{WHITESPACE_CLASS}]+"


def strip(col: Column) -> Column:
    """Unicode strip; `trim()` alone removes spaces only."""
    return F.btrim(col, F.lit(WHITESPACE))


def two_fields(col: Column) -> Column:
    """Split a stripped line once on the first whitespace run."""
    return F.split(col, WHITESPACE_RUN, 2)


def last_field(col: Column) -> Column:
    """The last of at least two whitespace-separated fields, else an empty text."""
    other, space = f"[^{WHITESPACE_CLASS}]", f"[{WHITESPACE_CLASS}]"
    return F.regexp_extract(col, f"(?s)^.*{other}{space}+({other}+){space}*$", 1)


def is_command(src: Column) -> Column:
    return F.endswith(src, F.lit("|"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def utt_from_path(path: Column) -> Column:
    """Base name minus its last suffix; a leading dot alone starts no suffix."""
    return F.regexp_extract(base_name(path), r"^(.+?|)(\.[^.]+)?$", 1)


def one_line_caption(caption: Column, clean: bool = False) -> Column:
    """Line feeds become spaces, then strip. `clean` also replaces tab and CR."""
    for char in "\n\t\r" if clean else "\n":
        caption = F.replace(caption, F.lit(char), F.lit(" "))
    return strip(caption)


def error_type(error: Column) -> Column:
    """First 100 characters of the error; records without one share a label."""
    return F.substring(F.coalesce(error, F.lit("Unknown error")), 1, 100)


def error_label(error: Column) -> Column:
    """Display form: 60 characters and an ellipsis."""
    return F.when(F.length(error) > 60, F.concat(F.substring(error, 1, 60), F.lit("..."))).otherwise(error)


def eta_label(seconds: Column) -> Column:
    hours = seconds / 3600
    return (
        F.when(hours < 1, F.format_string("%.0f minutes", seconds / 60))
        .when(hours < 24, F.format_string("%.1f hours", hours))
        .otherwise(F.format_string("%.1f days", hours / 24))
    )


def percent(part: Column, whole: Column) -> Column:
    return 100.0 * part / F.greatest(whole, F.lit(1))


def with_duration(duration: Column) -> Column:
    """Null and zero both count as "no duration"."""
    return F.when(F.coalesce(duration, F.lit(0.0)) != 0, duration)
