"""Text helpers and the character classes every pattern is built from.

Java's ``\\w`` and ``\\s`` are ASCII by default, and its Unicode mode adds marks
and leaves out the information separators, so the classes are spelled out: letters, numbers and
underscore; and the characters Unicode-aware ``str.isspace`` accepts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def pattern(template: str, flags: str = "md") -> str:
    """Expand ``<w>`` and ``<s>`` (class bodies) in a pattern.  The default flags make ``^``
    match after a line feed only and ``.`` stop at a line feed only."""
    body = template.replace("<w>", WORD).replace("<s>", SPACE)
    return f"(?{flags}){body}" if flags else body


def extract_all(text: Column, template: str, group: int = 1, flags: str = "md") -> Column:
    return F.regexp_extract_all(text, F.lit(pattern(template, flags)), F.lit(group))


def strip(text: Column) -> Column:
    """Trim Unicode white space from both ends."""
    return F.regexp_replace(text, pattern(r"\A[<s>]+|[<s>]+\z", ""), "")


def starts_with_any(text: Column, prefixes: list[str]) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | text.startswith(prefix)
    return hit


def contains_any(text: Column, parts: list[str]) -> Column:
    hit = F.lit(False)
    for part in parts:
        hit = hit | text.contains(part)
    return hit


def line_count(text: Column) -> Column:
    """Line feeds + 1, or 0 for an empty text."""
    feeds = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(feeds + 1)


def git_blob_sha(data: Column) -> Column:
    """Object id git gives to these bytes."""
    raw = data.cast("binary")
    header = F.concat(F.lit("blob "), F.octet_length(raw).cast("string")).cast("binary")
    return F.sha1(F.concat(header, F.unhex(F.lit("00")), raw))


def empty_strings() -> Column:
    return F.array().cast("array<string>")
